from corpusloom.operators import dossiers


def test_all_words_must_match(spark):
    names = spark.createDataFrame([(1, 1, "John Smith"), (2, 1, "Paul Smith"), (3, 2, "Иванов")], "id int, weight int, name string")
    queries = spark.createDataFrame([("j smith",), ("p",), ("ivanov",), ("иванов",)], "query string")
    got = {(r["query"], r.id): r.score for r in dossiers.search(names, queries).collect()}
    assert got == {("j smith", 1): 120, ("p", 2): 70, ("ivanov", 3): 20, ("иванов", 3): 200}
