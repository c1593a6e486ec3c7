"""Sinks: artifacts by path template, and append-only journals."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_segment(c: Column) -> Column:
    """A path segment without separators, control or reserved characters, and without runs of dots."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[<>:\"|?*/\\\\\\x00-\\x1F]", ""), "\\.{2,}", "."))


def templated(template: str, columns: list[str]) -> Column:
    """``template`` with ``{name}`` replaced by columns; a null or empty one is an error that names it."""
    names = re.findall(r"\{(\w+)\}", template)
    if missing := sorted(set(names) - set(columns)):
        raise ValueError(f"no value for {', '.join(missing)} in {template}")
    out = F.lit(template)
    for n in names:
        v = safe_segment(F.col(n).cast("string"))
        out = F.replace(out, F.lit("{" + n + "}"), F.when(F.coalesce(v, F.lit("")) == "", F.raise_error(F.lit(f"empty {n} in {template}"))).otherwise(v))
    return out


def write_artifacts(df: DataFrame, root: str, template: str, content: str = "content", existing: str = "skip", dry_run: bool = False) -> DataFrame:
    """Text artifacts below ``root``, one folder a path of the template; returns ``path, bytes, written`` of all of them,
    kept as a table below ``spark.checkpoint.dir`` before they are written. ``existing`` is ``skip``, ``overwrite`` or ``fail``. Files go through Spark's commit protocol, so half-written ones never show."""
    rows = df.select(templated(template, df.columns).alias("path"), F.regexp_replace(content, "\\s+$", "").alias("value"))  # the writer ends the line
    spark = df.sparkSession
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    there = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path)
    old = spark.read.option("wholetext", "true").option("recursiveFileLookup", "false").text(root).select(F.col("path").alias("old")).distinct() if there else spark.createDataFrame([], "old string")
    marked = rows.join(old, rows["path"] == old["old"], "left")
    if existing == "fail" and marked.where("old is not null").limit(1).count():
        raise FileExistsError(f"artifacts exist below {root}")
    todo = (marked if existing == "overwrite" else marked.where("old is null")).select("path", "value")
    report = marked.select("path", (F.octet_length("value") + 1).alias("bytes"), (F.lit(existing == "overwrite") | F.col("old").isNull()).alias("written"))
    if dry_run:
        return report
    kept = f"{spark.conf.get('spark.checkpoint.dir', None) or 'file:///tmp/checkpoints/corpusloom'}/artifacts-{uuid.uuid4().hex}"
    report.write.parquet(kept)  # once the artifacts are written, all of them exist
    todo.write.mode("overwrite" if existing == "overwrite" else "append").partitionBy("path").option("partitionOverwriteMode", "dynamic").text(root)
    return spark.read.schema(report.schema).parquet(kept)


def append_journal(events: DataFrame, path: str, run_id: str) -> None:
    """Events appended as JSON lines, with the run and their time."""
    events.withColumn("runId", F.lit(run_id)).write.mode("append").json(path)
