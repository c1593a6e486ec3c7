from corpusloom.operators import catalogue, dossiers, journal


def test_rows_are_normalized_on_read(spark):
    s = "position int, id string, title string, lang string, type string, gender string, country string, md string, json string, img string"
    rows = [(0, " 1 ", None, "EN , xx,en", " Composer", "F", "es", "/a.md", None, None), (1, "1", "t", None, None, None, None, "/b.md", None, None), (2, "2", "t", None, None, None, None, "/a.md", None, None),
            (3, " ", "t", None, None, None, None, "/c.md", None, None), (4, "4", "t", None, None, None, None, None, None, None), (5, "5", " t ", "xx", None, "odd", "esp", "/b.md", " ", None)]
    got = [tuple(r) for r in catalogue.read_rows(spark.createDataFrame(rows, s)).orderBy("position").select("id", "title", "lang", "type", "gender", "country", "json").collect()]
    assert got == [("1", "1", ["en"], "composer", "f", "ES", None), ("5", "t", ["ru"], "", None, None, None)]


def test_chain_of_a_pool(spark):
    rows = [("a", 10_000, 5.0), ("b", 10_000, 1.0), ("c", 2_000, 0.1), ("d", 3_000, 0.2)]
    t = spark.createDataFrame([(1, x, w, 512, p, 0, i) for i, (x, w, p) in enumerate(rows)], "pool int, target string, window_size int, most_out int, price double, weight int, pos int")
    assert [(r.target, r.overflows) for r in journal.routed_chain(t, 4000).orderBy("rank").collect()] == [("b", False), ("a", False), ("d", True), ("c", True)]


def test_places(spark):
    want = {("Melbourne, au", "AU"): "Melbourne, Australia", ("Adelaide, SA", "au"): "Adelaide, SA", ("Perth, AUS", None): "Perth, Australia", ("au", "au"): "Australia", ("au", None): "au",
            (", au", "au"): ", au", ("x" * 121, None): None, ("x" * 120, None): "x" * 120}
    countries = spark.createDataFrame([("au", "aus", "Australia"), ("sa", "sau", "Saudi Arabia")], "code string, code3 string, name string")
    got = dossiers.spelled_places(spark.createDataFrame(list(want), "raw string, known string"), countries).collect()
    assert {(r.raw, r.known): r.place for r in got} == want
