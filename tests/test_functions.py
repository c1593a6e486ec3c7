import pytest
from pyspark.sql import functions as F

from corpusloom.functions import dates, similarity, text, values


def one(spark, column, **given):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()]).select(column.alias("x")).first()
    return row["x"]


@pytest.mark.parametrize("raw, value", [
    ("1893-02-21", "21.02.1893"), ("21.2.1893", "21.02.1893"), ("21 февраля 1893 г.", "21.02.1893"), ("May 1885", "05.1885"), ("c. 1885", "1885"),
    ("1885-1890", None), ("31.02.1900", None), ("29.02.1900", None), ("29.02.2000", "29.02.2000"), ("21 de marzo de 1893", "21.03.1893"),
    ("circa about", None), ("", None), ("13.1900", None), ("3rd of June, 1901", "03.06.1901"),
])
def test_dates(spark, raw, value):
    assert one(spark, dates.parse_date(F.col("r"))["value"], r=raw) == value


def test_date_rules(spark):
    assert one(spark, dates.is_valid_date(F.col("r")), r="31.02.1900")  # a reader only checks the grammar
    assert one(spark, dates.refines(F.col("a"), F.col("b")), a="1893", b="21.02.1893")
    assert not one(spark, dates.refines(F.col("a"), F.col("b")), a="1893", b="21.02.1894")
    assert one(spark, dates.normalize_date(F.col("r"), "day"), r="05.1885") is None


def test_text(spark):
    c = F.col("r")
    assert one(spark, text.fold_ascii(c), r="Łódź Straße Ærø") == "Lodz Strasse Aero"
    assert one(spark, text.romanize(c), r="Щука Юрий") == "Shchuka Yuriy"
    assert one(spark, text.romanize(c), r="Latin") is None
    assert one(spark, text.phonetic_key(c), r="Schmidt") == one(spark, text.phonetic_key(c), r="Shmidt")
    assert one(spark, text.csv_list(c), r=" rock, Pop ,rock,, ROCK ,jazz") == "rock,Pop,jazz"
    assert one(spark, text.deslug(c), r="ludwig-van-beethoven") == "Ludwig van Beethoven"
    assert one(spark, text.text_or_null(c), r="  \t") is None


def test_values(spark):
    c = F.col("r")
    assert one(spark, values.ranking(c), r="") == 0 and one(spark, values.ranking(c), r="x") is None and one(spark, values.ranking(c), r="99.5") == 100
    assert one(spark, values.target(c), r="de/a.mp3") == "a.mp3" and one(spark, values.target(c), r="EMBEDDED") == "embedded"
    assert one(spark, values.extension(c), r="/x/.hidden") == "" and one(spark, values.extension(c), r="a.b.MP3?x") == ".mp3"
    assert one(spark, values.entry_type(c), r="Guitarist and Composer") == "musician"
    assert one(spark, values.gender(c), r="Женщина") == "f"


def test_alignment_counts_a_swap_once():
    assert similarity.alignment("segoiva", "segovia") == 1
    assert similarity.alignment("ca", "abc") == 3
    assert similarity.alignment("abcdefgh", "x") == 4
