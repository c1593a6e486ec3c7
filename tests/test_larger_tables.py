"""What only shows in tables larger or odder than the smallest ones, on small tables made for it."""

from contextlib import contextmanager

import duckdb
from pyspark.sql import functions as F

from corpusloom.operators import catalogue
from corpusloom.plans import QUERIES, SQL, Tables


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def both(spark, folder, name, **tables):
    """Sorted rows of a query and of its SQL over ``tables``, DuckDB SELECTs that are written to ``folder``."""
    con = duckdb.connect()
    for t, select in tables.items():
        con.execute(f"copy ({select}) to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    df = QUERIES[name](Tables(spark, str(folder)))
    want = con.execute(f"select {', '.join(df.columns)} from ({SQL[name]})").fetchall()
    return sorted(map(repr, map(tuple, df.collect()))), sorted(map(repr, want))


def test_rows_are_numbered_once_however_partitions_are_merged(spark):
    df = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 3).alias("pad"))
    with settings(spark, spark__sql__shuffle__partitions="16", spark__sql__adaptive__advisoryPartitionSizeInBytes="600k",
                  spark__sql__adaptive__coalescePartitions__parallelismFirst="false"):
        got = catalogue.number_rows(df, ["k"]).collect()  # with the pad, which counts of parts don't read
    assert [r["k"] for r in sorted(got, key=lambda r: r["n"])] == sorted(r["k"] for r in df.select("k").collect())
    assert sorted(r["n"] for r in got) == list(range(1, 20001))


def test_numbering_with_few_keys_many_times_and_none(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("a"), F.when(F.col("id") > 0, F.col("id")).alias("b"))
    got = catalogue.number_rows(df, ["a", "b"]).orderBy("n").collect()
    assert [(r["a"], r["b"]) for r in got] == [(i % 3, i or None) for k in range(3) for i in range(k, 300, 3)]
    assert catalogue.number_rows(df.where("a > 5"), ["a", "b"]).count() == 0


def most_join_rows(df):
    """Rows that the largest join of ``df`` makes."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from walk(node.plan())
        if "Join" in name and node.metrics().contains("numOutputRows"):
            yield node.metrics().apply("numOutputRows").value()
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return max(walk(df._jdf.queryExecution().executedPlan()))


ROUTING, TURNS = "O5_O6_O7_O9_O10_O11_J11_J12_routing", "O8_W6_round_robin"
#: Two pools: 300 targets and one of little room, which most requests don't fit; 400 requests.
PARTS = "select i::bigint as p_partkey, (i % 2)::int as p_size from range(400) r(i)"
SUPPLIERS = "select i::bigint as s_suppkey, (case when i = 216 then 1 else 0 end)::int as s_nationkey from range(300) r(i)"


def test_requests_do_not_meet_all_targets_of_their_pool(spark, tmp_path):
    for name in (ROUTING, TURNS):
        got, want = both(spark, tmp_path, name, part=PARTS, supplier=SUPPLIERS)
        assert got == want and len(got) == 400
        assert most_join_rows(QUERIES[name](Tables(spark, str(tmp_path)))) <= 800


def test_routing_where_nothing_fits_or_keys_are_missing(spark, tmp_path):
    parts = f"{PARTS} union all select null, 0 union all select null, 1 union all select 7, 0 union all select 8, null union all select 9, 3 union all select 11, 4"
    suppliers = f"{SUPPLIERS} where i % 50 = 16 union all select null, 0 union all select null, 1 union all select 5, null union all select null, 4"
    got, want = both(spark, tmp_path, ROUTING, part=parts, supplier=suppliers)
    assert got == want


def test_turns_where_keys_are_missing(spark, tmp_path):
    parts = f"{PARTS} union all select null, 0 union all select 408, null union all select 409, 3 union all select 411, 4"
    suppliers = f"{SUPPLIERS} where i % 50 = 16 union all select null, 0 union all select null, 1 union all select 5, null union all select null, 4"
    got, want = both(spark, tmp_path, TURNS, part=parts, supplier=suppliers)
    assert got == want


def test_title_of_an_id_is_the_first_that_a_row_has(spark, tmp_path):
    # Customer 276 has no title, and 277 has its id.
    customer = "select i::bigint as c_custkey, 'Customer#' || i as c_name, 1 as c_nationkey, 'X' as c_mktsegment from range(270, 280) r(i)"
    got, want = both(spark, tmp_path, "V12_V13_V14_V28_J2_name_rules", customer=customer, supplier="select i::bigint as s_suppkey, 'Supplier#' || i as s_name from range(136, 140) r(i)")
    assert got == want and "('ru', '276', 'INV-12', 'error')" not in got


#: Two lines whose keys are the same, beginning with a digit; and lines between white space of several kinds.
DOCUMENTS = """select i::bigint as doc_id, t as text, 'en' as lang, 's' as source, 1::bigint as n_chars from (values (1, 'line 92517' || chr(10) || 'line 161541' || chr(10) || '12'), (2, 'line 161541'),
    (3, chr(160) || 'x ' || chr(12288) || chr(10) || 'x' || chr(13) || chr(10) || chr(9) || 'x' || chr(10) || '  x'), (4, null), (5, '')) v(i, t)"""


def test_units_with_the_same_key_or_other_white_space(spark, tmp_path):
    for name in ("J8_J9_A13_S10_K9_U23_translation_memory", "U22_A12_string_table", "W5_unit_batches"):
        got, want = both(spark, tmp_path, name, documents=DOCUMENTS)
        assert got == want, name


def test_half_a_millisecond_of_waiting_is_rounded_up(spark, tmp_path):
    # Three calls take the burst; the fourth comes 62.5 ms before the next token.
    events = """select i::bigint as event_id, timestamp '2024-01-01' + interval (case when i = 3 then 29937500 else 0 end) microsecond as ts, 25::bigint as user_id, 'view' as event_type, 1.0::double as value,
        '{"k": 1}' as props from range(4) r(i)"""
    got, want = both(spark, tmp_path, "W9_token_bucket", events=events)
    assert got == want and "(0, 3, 63)" in got
