import pytest
from pyspark.sql import types as T

from quotewell.llm.licenses import TEMPLATES, license_matches

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("license", "own", "width", "bands", "shingles", "places"))])
FILL = " ".join(f"fill{i}" for i in range(400))


def table(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 6) for i, t in rows], SCHEMA).repartition(3)


def test_every_template_anywhere(spark):
    rows, want = [], set()
    for i, (name, body) in enumerate(TEMPLATES.items()):
        for j, text in enumerate((body, FILL + "\n" + body.upper() + "\n" + FILL, f"x {body} y", FILL[: 40 * i] + " " + body)):
            rows.append((10 * i + j, text))
            want.add((10 * i + j, name))
    found = {(r.ident, r.license): r for r in license_matches(table(spark, rows)).collect()}
    assert want <= set(found) and all(found[x].containment == 1.0 for x in want)
    # A text that holds the words of another template as well has both; so have those of clauses that say nearly the same.
    alike = {"apache-2.0-line", "mit-line", "gpl", "gpl-2", "agpl", "lgpl", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0", "mit", "bsl-1.0", "gpl-copy", "agpl-copy", "lgpl-copy", "bsd-source", "bsd-binary"}
    assert {b for a, b in set(found) - want} <= alike


def test_licenses_by_any_clause(spark):
    """A text that is cut at the top is found by what follows, and a notice of three words by all of them."""
    assert len({name.split("-")[0] for name in TEMPLATES}) >= 14
    rows = [
        (1, FILL + " " + TEMPLATES["mit-warranty"].lower()), (2, TEMPLATES["bsd-binary"] + "\n" + TEMPLATES["bsd-warranty"]), (3, "Copyright 2020 Nobody. All Rights reserved"),
        (4, "all rights are reserved"), (5, FILL + " all RIGHTS\nreserved. " + FILL), (6, TEMPLATES["cc0-1.0"]), (7, TEMPLATES["agpl-copy"]), (8, "reserved all rights"),
    ]
    found = {(r.ident, r.license) for r in license_matches(table(spark, rows)).collect()}
    assert found >= {(1, "mit-warranty"), (2, "bsd-binary"), (2, "bsd-warranty"), (3, "all-rights-reserved-line"), (5, "all-rights-reserved-line"), (6, "cc0-1.0"), (7, "agpl-copy")}
    assert {i for i, name in found if name == "all-rights-reserved-line"} == {3, 5}


def test_edited_and_broken_notices(spark):
    words = TEMPLATES["gpl"].split()
    near = " ".join([*words[:-1], "Club"])  # all runs but the last
    far = " ".join(w if i % 4 else "other" for i, w in enumerate(words))
    rows = [(1, FILL + " " + near), (2, FILL + " " + far), (3, None), (4, ""), (5, "MIT License."), (6, FILL), (None, near), (7, near), (7, near)]
    found = {(r.ident, r.license): r.containment for r in license_matches(table(spark, rows)).collect()}
    assert set(found) == {(1, "gpl"), (None, "gpl"), (7, "gpl")} and all(0.8 <= c < 1 for c in found.values())


def test_own_templates(spark):
    with pytest.raises(ValueError):
        license_matches(table(spark, []), {"none": "... !"})
    short = {"one": "Unlicensed!", "three": "too few words", "four": "now there are four"}
    rows = [(1, "it is unlicensed"), (2, "too FEW words"), (3, "there are four"), (4, "now, there are four: too few words")]
    assert sorted((r.ident, r.license, r.containment) for r in license_matches(table(spark, rows), short).collect()) == [(1, "one", 1.0), (2, "three", 1.0), (4, "four", 1.0), (4, "three", 1.0)]
    long = {"long": " ".join(f"t{i}" for i in range(300))}
    rows = [(1, FILL + " " + long["long"] + " " + FILL), (2, FILL + " ".join(f"t{i}" for i in range(150)))]
    assert [(r.ident, r.license) for r in license_matches(table(spark, rows), long).collect()] == [(1, "long")]
    assert license_matches(table(spark, [])).count() == 0
