from corpusloom.operators import catalogue


def test_a_new_entry_keeps_all_aliases(spark):
    s = "lang string, id string, aliases array<string>"
    (r,) = catalogue.merge_names(spark.createDataFrame([], s), spark.createDataFrame([("en", "1", ["x", *[f"name {i}" for i in range(1500)]])], s)).collect()
    assert len(r.aliases) == 1501 and r.aliases[0] == "x" and r.changed
