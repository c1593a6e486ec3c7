from pyspark.sql import functions as F

from corpusloom.operators import linkage

IMAGES = """rel_path string, width int, height int, mp double, orientation string, color string, class string, confidence double, faces int, coverage double,
    title string, description string, ocr string, keywords array<string>, people array<string>"""


def linked(spark, paths, names, **meta):
    """Candidates of names among good portraits, and the names. ``meta``: what every record says besides its path."""
    looks = (400, 600, 0.24, "portrait", "color", "portrait", 0.9, 1, 0.4)
    records = spark.createDataFrame([(p, *looks, *[meta.get(c) for c in linkage.METADATA]) for p in paths], IMAGES)
    r = linkage.suitability(linkage.index(records))
    q = linkage.name_query(spark.createDataFrame([(n, n) for n in names], "query string, name string"))
    pairs = linkage.shortlist(linkage.inverted(r), q)
    return linkage.identity(pairs.join(r.withColumnsRenamed({"joined": "r_joined", "phonetics": "r_phonetics", "initials": "r_initials"}), "rel_path").join(q, "query")), q


def test_choice_has_a_row_for_every_name(spark):
    got = {r["query"]: r for r in linkage.choose(*linked(spark, ["photo/s/andres_segovia.jpg"], ["andres segovia", "ida presti"])).collect()}
    assert got["andres segovia"].chosen == "photo/s/andres_segovia.jpg" and got["andres segovia"].declined is None
    assert (got["ida presti"].chosen, got["ida presti"].candidates, got["ida presti"].declined) == (None, 0, "the image index holds nothing under this name")


def test_misspelled_names_are_scored(spark):
    """A swap of letters in the name: 7/8 of likeness, over a threshold of 0.86."""
    pairs, q = linked(spark, ["photo/x/bratland.jpg", "photo/bratland/x1.jpg"], ["ole bratladn"])
    got = {r.rel_path: (r.kind, r.identity, r.foreign) for r in pairs.collect()}
    assert got == {"photo/x/bratland.jpg": ("fuzzy", 0.65, []), "photo/bratland/x1.jpg": ("fuzzy", 0.61, [])}
    (r,) = linkage.choose(pairs, q).collect()
    assert (r.chosen, r.candidates, r.declined) == (None, 2, "identity is below the threshold")


def test_metadata_is_evidence(spark):
    for meta, want in (({"people": ["Segovia, Andres", "Ida Presti"]}, ("meta-people", 1.0)), ({"title": "Segovia, 1922"}, None), ({"title": "Ida Presti in Paris"}, ("meta-title", 0.9)),
                       ({"keywords": ["presti"]}, ("meta-keywords", 0.75)), ({"title": "Ida at home", "ocr": "PRESTI"}, ("meta-text", 0.62))):
        rows = linked(spark, ["photo/001.jpg"], ["ida presti"], **meta)[0].select("kind", "identity").collect()
        assert [tuple(r) for r in rows] == ([want] if want else [])
