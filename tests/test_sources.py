import json

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import files, sinks
from corpusloom.streaming import journal


def test_scan_corpus(spark, tmp_path):
    for path, body in {"ru/a.bio.md": "Гитара", "en/b.md": "text", "en/.hidden.md": "x", "en/c.txt": "x"}.items():
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text(body)
    got = {r.id: r for r in files.scan_corpus(spark, str(tmp_path)).collect()}
    assert set(got) == {"ru/a", "en/b"} and got["ru/a"].bytes == 12 and got["ru/a"].language == "ru"
    assert files.scan_corpus(spark, str(tmp_path), limit=1).count() == 1
    with pytest.raises(FileNotFoundError):
        files.scan_corpus(spark, str(tmp_path), include="*.none")


def test_read_catalogue(spark, tmp_path):
    (tmp_path / "ru").mkdir()
    for path, body in {"index.json": "﻿[]", "index-en.json": "{}", "ru/x.json": "{bad", "other.json": "{}"}.items():
        (tmp_path / path).write_text(body)
    got = {r.path: r for r in files.read_catalogue(spark, str(tmp_path)).select("path", "kind", "lang", F.col("value").isNotNull().alias("ok")).collect()}
    assert {p: (r.kind, r.ok) for p, r in got.items()} == {"index.json": ("index", True), "index-en.json": ("names", True), "ru/x.json": ("dossier", False)}


def test_image_index(spark, tmp_path):
    p = tmp_path / "i.json"
    p.write_text(json.dumps({"schemaVersion": 1, "images": [{"relPath": "photo/a.jpg", "image": {"width": 100, "height": 103}, "ai": {"class": "odd", "confidence": 3}, "meta": {"title": "{junk", "keywords": ["ab", "1"]}}, {"image": {}}]}))
    (r,) = files.read_image_index(spark, str(p)).collect()
    assert (r.orientation, r["class"], r.confidence, r.title, r.keywords) == ("square", "unknown", 1.0, None, ["ab"])
    p.write_text('{"schemaVersion": 2}')
    with pytest.raises(ValueError):
        files.read_image_index(spark, str(p))


def test_memory_last_line_wins(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"k":"en:a","v":"1"}\nbroken{\n{"k":"en:a","v":"2"}\n')
    assert [tuple(r) for r in files.read_memory(spark, str(p)).collect()] == [("en", "a", "2")]


def test_config():
    assert files.interpolate({"a": ["${X}", "${Y:-d}"]}, {"X": "1"}) == {"a": ["1", "d"]}
    with pytest.raises(KeyError):
        files.interpolate("${X}", {})
    assert files.deep_merge({"a": {"b": 1, "c": [1]}}, {"a": {"c": [2], "d": None}}) == {"a": {"b": 1, "c": [2]}}
    assert files.redact({"apiKey": "s", "x": [{"Authorization": "t"}]}) == {"apiKey": "***", "x": [{"Authorization": "***"}]}


def test_artifacts(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([("en", "a", "body \n\n"), ("ru", "b", "x")], "lang string, slug string, content string")
    assert sinks.write_artifacts(df, root, "{lang}-{slug}", dry_run=True).count() == 2
    assert sum(r.written for r in sinks.write_artifacts(df, root, "{lang}-{slug}").collect()) == 2
    assert sum(r.written for r in sinks.write_artifacts(df, root, "{lang}-{slug}").collect()) == 0
    got = {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("part-*.txt")}
    assert got == {"path=en-a": "body\n", "path=ru-b": "x\n"}
    with pytest.raises(FileExistsError):
        sinks.write_artifacts(df, root, "{lang}-{slug}", existing="fail")
    with pytest.raises(ValueError):
        sinks.templated("{none}", ["a"])


def test_skipped_artifacts_are_reported_at_any_size(spark, tmp_path):
    n = 10_001
    (tmp_path / "path=a0").mkdir()
    (tmp_path / "path=a0/part-0.txt").write_text("x\n")
    df = spark.range(n).select(F.concat(F.lit("a"), F.when(F.col("id") < n - 1, 0).otherwise(1)).alias("slug"), F.lit("x").alias("content"))
    got = sinks.write_artifacts(df, str(tmp_path), "{slug}").groupBy("written").count().collect()
    assert {r["written"]: r["count"] for r in got} == {False: n - 1, True: 1}


def test_streams(spark, sf, tmp_path):
    src = str(tmp_path / "events")
    spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).orderBy("ts").coalesce(1).write.json(src)
    batch = spark.read.schema(journal.EVENT).json(src)
    for name, make in (("rates", journal.error_rates), ("sessions", journal.sessions), ("distinct", journal.distinct_events), ("breaker", journal.breaker)):
        out = make(journal.read(spark, src))
        q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("distinct").count() == batch.count() == spark.table("breaker").count()
    assert {r.state for r in spark.table("breaker").collect()} <= {"closed", "open", "half-open"}
    closed = spark.table("rates").agg(F.sum("events")).first()[0]
    assert 0 < closed <= batch.count() and spark.table("sessions").count() > 0
