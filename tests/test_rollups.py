"""Summaries against values counted by hand, with nulls and empty tables."""

from quillgrid.operators import rollups


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_corpus_summary(spark):
    files = spark.createDataFrame([("a", 3, "ok", True), ("b", 2, "ok", None), ("c", 0, "truncated", False), ("d", 1, None, False)], "file string, pages int, health string, rotated boolean")
    assert rows(rollups.corpus_summary(files)) == {("ok", 2, 5, 1, 0), ("truncated", 1, 0, 0, 0), (None, 1, 1, 0, 0), (None, 4, 6, 1, 1)}


def test_planset_counts_and_report(spark):
    of = lambda *p: spark.createDataFrame([(x,) for x in p], "planset int")
    items = spark.createDataFrame([(1, True), (1, None), (2, False), (1, True)], "planset int, needs_review boolean")
    counts = rollups.planset_counts(of(1, 2, 3), of(1, 1, 2), of(1, 2, 2, 2), items)
    assert rows(counts) == {(1, 2, 1, 3, 2), (2, 1, 3, 1, 0), (3, 0, 0, 0, 0)}
    assert rows(rollups.extract_report(counts)) == {(3, 2, 4, 2, 0.5)}
    assert rows(rollups.extract_report(counts.where("false"))) == {(0, 0, 0, 0, None)}


def test_detection_summary(spark):
    got = spark.createDataFrame([(1, True, "sheet"), (1, False, "block"), (2, None, None)], "page int, in_block boolean, source string")
    assert rows(rollups.detection_summary(got)) == {(1, 2, 1, 1, 1, 1, 0), (2, 1, 0, 1, 0, 0, 0), (None, 3, 1, 2, 1, 1, 1)}


def test_legends_as_items(spark):
    blocks = spark.createDataFrame(
        [(1, 1, "type_legend", "door", "pictorial"), (1, 2, "schedule", "door", "tabular"), (1, 3, "type_legend", "window", "tabular"), (2, 4, "type_legend", "door", "tabular"), (2, 5, "schedule", "door", "pictorial"), (2, 6, "notes", "door", "tabular"), (3, 7, "type_legend", None, None), (3, 8, "schedule", None, "tabular")],
        "page int, block int, kind string, category string, genre string",
    )
    assert {r.block for r in rollups.legends_as_items(blocks).collect()} == {3, 4, 7}
    assert {r.block for r in rollups.parseable(blocks).collect()} == {1, 2, 3, 4, 5, 7, 8}
