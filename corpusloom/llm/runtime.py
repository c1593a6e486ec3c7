"""What the operators share: table reading, Arrow batch maps, and tables in the cluster's shared folder."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}

#: Bytes in one Arrow batch, about; a longer row is a batch of its own. This bounds a Python worker's memory.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """What every Arrow operator relies on: this checkout on the workers' path, and batches of bounded bytes. The bound
    is the session's, is only ever lowered, and changes no result of any other query."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    if int(re.match(r"\d+", spark.conf.get(_BATCH_SETTING))[0]) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share; it goes when the application
    ends, unless it goes before.

    Only where that setting is absent and driver and executors are one process, as in local tests, a folder of this
    machine is used; on a cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file:///tmp/checkpoints/corpusloom"
    path = f"{base.rstrip('/')}/loom-{uuid.uuid4().hex}"
    fs, p = _at(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


_SMALL_GROUPS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.block.size": str(16 << 20)}


class Scratch:
    """Tables of one phase of one call, in the shared folder; all but the kept ones go when the phase ends, also on errors."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.tables = spark, {}  # by identity: a table and its path

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for _, path in self.tables.values():
            delete_path(self.spark, path)

    def write(self, df: DataFrame) -> DataFrame:
        """``df`` as a Parquet table: lineage ends there, and lost executors cost no recomputation.

        Row groups are small and not read by ranges: such reads copy whole column chunks through native buffers, which
        each thread keeps, so an executor's memory beyond its heap would grow with the size of a row group."""
        path = shared_dir(self.spark)
        df.write.mode("append").options(**_SMALL_GROUPS).parquet(path)
        out = self.spark.read.schema(df.schema).option("parquet.hadoop.vectored.io.enabled", "false").parquet(path)
        self.tables[id(out)] = out, path
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, a table of this phase, for results that are read later; it lives as long as the application."""
        del self.tables[id(df)]
        return df

    def drop(self, df: DataFrame) -> None:
        """A table of this phase that nothing reads any more goes now."""
        delete_path(self.spark, self.tables.pop(id(df))[1])


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table that a later result reads; see ``Scratch.keep``."""
    tmp = Scratch(df.sparkSession)
    return tmp.keep(tmp.write(df))


class Memo:
    """A worker's memory of computed values in two generations: when the recent one is full it becomes the old one, and
    what is asked for again returns from there. So frequent keys stay, rare ones go, and ``2 * size`` entries (and those
    of one batch) are the most that is held."""

    def __init__(self, size: int, make: Callable[[list], Iterable]) -> None:
        self.size, self.make, self.recent, self.old = size, make, {}, {}

    def fetch(self, keys: set) -> dict:
        """A dictionary with all ``keys`` (and others)."""
        if len(self.recent) > self.size:
            self.old, self.recent = self.recent, {}
        recent, old = self.recent, self.old
        missing = keys.difference(recent)
        if missing and old:
            for k in missing:
                if k in old:
                    recent[k] = old[k]
            missing = missing.difference(recent)
        if missing:
            order = list(missing)
            recent.update(zip(order, self.make(order), strict=True))
        return recent


def ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)


def arrow_schema(fields: list[tuple[str, str]]) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in fields])


def map_columns(
    df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, object]]], fields: list[tuple[str, str]]
) -> DataFrame:
    """``df`` through Arrow batches: ``make()`` runs once a task and gives a function from a batch's columns
    (name -> list) to the columns of ``fields``."""
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                got = step({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
                out = pa.RecordBatch.from_arrays(
                    [x if isinstance(x := got[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema
                )
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, ddl(fields))


def with_columns(
    df: DataFrame, cols: list[str], make: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    fields: list[tuple[str, str]],
) -> DataFrame:
    """``df`` with columns of ``fields`` appended, computed from ``cols`` in Arrow batches; the rest passes through.

    A column of ``df`` that has the name of a new one is replaced.
    """
    new = {n for n, _ in fields}
    keep = df.select(*[f"`{c}`" for c in df.columns if c not in new or c in cols])
    out = T.StructType([f for f in keep.schema if f.name not in new] + list(T._parse_datatype_string(ddl(fields))))
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                got = step({c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in cols})
                rest = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n not in new]
                rest += [(f.name, pa.array(got[f.name], f.type)) for f in schema]
                yield pa.RecordBatch.from_arrays([x for _, x in rest], names=[n for n, _ in rest])

    return keep.mapInArrow(run, out)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files that no table of the next phase reads; it does so when garbage is collected."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
