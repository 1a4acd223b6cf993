"""Stages over small hand-made layouts, sources, sinks and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import spatial
from quillgrid.plans import stages
from quillgrid.sources import readers, sinks
from quillgrid.streaming import registry as stream


def words_frame(spark, rows):
    """rows of (text, x0, y0); eight points high, six a character wide."""
    return spark.createDataFrame([("f", 1, i, t, float(x), float(y), float(x + 6 * len(t)), float(y + 8)) for i, (t, x, y) in enumerate(rows)], "file string, page int, word int, text string, x0 double, y0 double, x1 double, y1 double")


TABLE = [("DOOR", 100, 100), ("SCHEDULE", 130, 100)] + [
    (t, x, 130 + 20 * r) for r, line in enumerate([("MARK", "WIDTH", "HEIGHT", "REMARKS"), ("101", "3'-0\"", "7'-0\"", "HM"), ("102", "2'-8\"", "7'-0\"", "WD"), ("103", "6'-0\"", "8'-0\"", "PR")]) for t, x in zip(line, (100, 180, 260, 340), strict=True)
]


def test_locate_segment_and_read_a_table(spark):
    words = words_frame(spark, TABLE)
    pages = spark.createDataFrame([("f", 1, 1000.0, 800.0, 0, "ok"), ("g", 1, 1000.0, 800.0, 0, "truncated")], "file string, page int, width double, height double, rotation int, health string")
    edges = pages.select("file", "page", (F.col("width") * 0.88).alias("tb_x"))
    lines = spark.createDataFrame([("f", 1, 0, 0, "DOOR SCHEDULE", 14.0, 100.0, 100.0, 180.0, 108.0), ("f", 1, 1, 1, "MARK WIDTH HEIGHT REMARKS and so on", 8.0, 100.0, 130.0, 380.0, 138.0)], "file string, page int, ord int, block int, text string, size double, x0 double, y0 double, x1 double, y1 double")
    toc = spark.createDataFrame([], "file string, page_index int, title string")
    found, titles = stages.locate(lines, pages, edges, toc, words)
    (page,) = found.collect()
    assert (page.file, page.score, page.signals) == ("f", 0.6, ["title"])
    named = titles.withColumn("title_id", F.col("ord").cast("long")).checkpoint()  # stages hand on tables
    assert [(t.title, t.category, t.kind) for t in named.collect()] == [("DOOR SCHEDULE", "door", "schedule")]
    blocks = stages.genre(words, stages.segment(words, named, pages, edges).checkpoint()).checkpoint()
    (block,) = blocks.collect()
    assert (block.block_id, block.genre, block.category, block.word_count) == ("p1_b0", "tabular", "door", 18)
    rows = stages.unruled_rows(words, blocks)
    got = sorted((tuple(tuple(c) for c in r.cells)) for r in rows.collect())
    assert got[0] == (("MARK", "101"), ("WIDTH", "3'-0\""), ("HEIGHT", "7'-0\""), ("REMARKS", "HM")) and len(got) == 3
    legend = spark.createDataFrame([], "category string, code string, caption string")
    items = {r.mark: r for r in stages.items_of_rows(rows, blocks, legend).collect()}
    assert (items["103"].width_in, items["103"].height_in, items["103"].canonical.category, items["103"].canonical.operation) == (72.0, 96.0, "door", "swing_pair")


def test_ruled_table(spark):
    grid = [["", "SIZE", "", ""], ["MARK", "WIDTH", "HEIGHT", "TYPE"], ["A1", "3'-0\"", "7'-0\"", "F"], ["see notes", "", "", ""]]  # four letters alone would read as a mark
    cells = spark.createDataFrame([(7, r, c, t) for r, line in enumerate(grid) for c, t in enumerate(line)], "table_id long, row int, col int, text string")
    tables = spark.createDataFrame([(7, "b", 0.0, 0.0, 100.0, 100.0)], "table_id long, block_id string, x0 double, y0 double, x1 double, y1 double")
    blocks = tables.drop("table_id")
    (row,) = stages.ruled_rows(cells, tables, blocks).collect()
    assert [c.value for c in row.cells] == ["A1", "3'-0\"", "7'-0\"", "F"]
    assert [c.name for c in row.cells][:2] == ["MARK", "WIDTH"]


def test_pictorial_items(spark):
    text = ["A 3'-0\" x 6'-8\" FLUSH", "• HOLLOW METAL", "painted", "• 90 MIN", "B LOUVER"]
    ys = [0, 12, 24, 36, 200]
    lines = spark.createDataFrame([("b", i, t, 0.0, float(y), 50.0, float(y + 8)) for i, (t, y) in enumerate(zip(text, ys, strict=True))], "block_id string, ord int, text string, x0 double, y0 double, x1 double, y1 double")
    (item,) = stages.pictorial_items(lines).collect()
    assert item.mark == "A" and item.specs == ["HOLLOW METAL painted", "90 MIN"]


def test_legend(spark):
    rows = [("A", 0, 0), ("FLUSH PANEL", -30, 12), ("B", 100, 0), ("HALF LITE", 76, 12), ("SEE NOTE", 76, 60)]
    lines = spark.createDataFrame([("k", i, t, float(x), float(y), float(x + 6 * len(t)), float(y + 8)) for i, (t, x, y) in enumerate(rows)], "block_id string, ord int, text string, x0 double, y0 double, x1 double, y1 double")
    assert {r.code: r.caption for r in stages.legend_entries(lines).collect()} == {"A": "FLUSH PANEL", "B": "HALF LITE"}


def sheet(key, areas, openings):
    return {"sheet_key": key, "planset_key": key[:1], "page": 1, "status": "verified", "rev": 1, "areas": areas, "openings": openings, "strange": 1}


def test_annotations_from_json_to_labels(spark, tmp_path):
    area = lambda i, t, r: {"id": i, "type": t, "rect": r, "seed": {}}
    box = lambda i, r, cls: {"id": i, "rect": r, "cls": cls, "state": "accepted", "cls_source": "inherited", "area_id": "a1", "confidence": 0.9}
    one = sheet("s1", [area("a1", "door_area", [0, 0, 100, 100]), area("a2", "exclude", [0, 0, 50, 50]), area("a3", "window_area", [200.0, 0, 300, 100])], [box("o1", [10, 10, 30.5, 50], "door"), box("o2", [90, 90, 200, 200], "door")])
    (tmp_path / "one.json").write_text(json.dumps(one, indent=1))
    (tmp_path / "bad.json").write_text("{ no json")
    sheets = readers.annotations(spark, str(tmp_path))
    assert [r.sheet_key for r in sheets.collect()] == ["s1"]
    areas, boxes = readers.areas(sheets), readers.openings(sheets)
    got = spatial.smallest_container(boxes.withColumn("box", F.col("box_ord").cast("long")), areas, "sheet_key", "box").collect()
    assert {r.box_id: r.area_ord for r in got} == {"o1": 0, "o2": None}
    ex, labels = stages.dataset(boxes, areas)
    assert [(r.area_id, r.boxes) for r in ex.collect()] == [("a1", 1)]
    (label,) = labels.collect()
    assert (label.cls, label.cx, label.h) == (1, pytest.approx(0.2025), pytest.approx(0.4))
    sinks.write_labels(labels.withColumn("image", F.col("sheet_key")), str(tmp_path / "labels"))
    (line,) = spark.read.text(str(tmp_path / "labels")).select("value").collect()
    assert line.value == "1 0.202500 0.300000 0.205000 0.400000"
    kept, reasons = stages.regions(areas, spark.createDataFrame([("s1", 400.0, 400.0)], "sheet_key string, width double, height double"))
    assert {r.area_id for r in kept.collect()} == {"a1", "a2", "a3"} and reasons.collect() == []


@pytest.mark.skipif("QUILLGRID_GOLDEN" not in os.environ, reason="no folder of annotated sheets named")
def test_stored_assignments(spark):
    sheets = readers.annotations(spark, os.environ["QUILLGRID_GOLDEN"]).cache()
    areas, boxes = readers.areas(sheets), readers.openings(sheets).withColumnRenamed("containment", "stored").withColumn("box", F.col("box_ord").cast("long"))
    got = spatial.smallest_container(boxes, areas, "sheet_key", "box").join(areas.select("sheet_key", "area_ord", F.col("area_id").alias("found")), ["sheet_key", "area_ord"], "left")
    assert got.count() == 1121
    assert got.where(F.coalesce("found", F.lit("")) != F.coalesce("area_id", F.lit(""))).count() == 0
    assert got.where("found is not null and abs(containment - stored) > 0.0011").count() == 0


def test_triage_and_outline(spark):
    pages = spark.createDataFrame([("a", 1, "x" * 300, 0, 0, 10.0, 20.0), ("a", 2, None, 0, 90, 10.0, 20.0), ("b", 1, "", 2, 0, 5.0, 5.0), ("c", 1, "few", 0, 0, 5.0, 5.0)], "file string, page int, text string, images int, rotation int, width double, height double")
    got = {r.file: r for r in readers.triage(pages).collect()}
    assert {f: r.health for f, r in got.items()} == {"a": "ok", "b": "unreadable_scan", "c": "no_text_layer"}
    assert got["a"].rotations == {0: 1, 90: 1} and got["a"].page_sizes == {"10x20": 2}
    toc = spark.createDataFrame([("a", 3, " Door  ", 0), ("a", 3, "DOOR", 1), ("a", 4, " ", 2)], "file string, page int, title string, ord int")
    assert [(r.page_index, r.title) for r in readers.outline(toc).collect()] == [(2, "Door")]


def test_lines_and_edges(spark):
    spans = spark.createDataFrame([("f", 1, 0, 0, 0, "DOOR ", 10.0, 0.0, 0.0, 20.0, 8.0), ("f", 1, 0, 0, 1, " ", 10.0, 0.0, 0.0, 0.0, 0.0), ("f", 1, 0, 0, 2, " TYPES", 12.0, 22.0, 0.0, 50.0, 9.0)], "file string, page int, block int, line int, span int, text string, size double, x0 double, y0 double, x1 double, y1 double")
    (line,) = readers.lines(spans).collect()
    assert (line.text, line.size, line.x1, line.y1) == ("DOOR TYPES", 12.0, 50.0, 9.0)
    pages = spark.createDataFrame([("f", 1, 1000.0, 500.0), ("g", 1, 1000.0, 500.0)], "file string, page int, width double, height double")
    seg = spark.createDataFrame([("f", 1, 850.0, 10.0, 850.5, 400.0), ("f", 1, 500.0, 0.0, 500.0, 500.0)], "file string, page int, x0 double, y0 double, x1 double, y1 double")
    edges = readers.titleblock_edge(seg, pages)
    assert {r.file: r.tb_x for r in edges.collect()} == {"f": 850.0, "g": 880.0}


def decode(file, page):
    for p in (1, 2):
        if page is None or p == page:
            yield file, p, 0, f"{file}-{p}", 0.0, 0.0, 1.0, 1.0


def test_page_source_takes_filters(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(readers.PageSource)
    df = spark.read.format("layout_pages").option("files", "a,b").option("decoder", "tests.test_stages:decode").load()
    assert df.count() == 4
    assert [r.text for r in df.where("file = 'b' and page = 2").collect()] == ["b-2"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["x", "y"], True, None), ("b", [], False, 2.5)], "k string, tags array<string>, ok boolean, n double")
    sinks.write_takeoff(rows, str(tmp_path / "csv"))
    back = {r.k: r for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()}
    assert (back["a"].tags, back["a"].ok, back["a"].n, back["b"].n) == ("x|y", "1", None, "2.5")
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "img1.txt").write_text("0 0.5 0.5 0.1 0.1\nbroken line\n")
    assert [(r.image, r.cls, r.cx) for r in readers.label_files(spark, str(tmp_path / "l")).collect()] == [("img1", 0, 0.5)]
    (tmp_path / "s.txt").write_text("./images/a.png  ./b.png\n\n../c.png")
    assert {r.name for r in readers.split_list(spark, str(tmp_path / "s.txt")).collect()} == {"images/a.png", "b.png", "c.png"}


def test_upload_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"%PDF-1 hello")
    (tmp_path / "in" / "b.pdf").write_bytes(b"no pdf")
    seen = []
    q = stream.run_stages(stream.uploads(spark, str(tmp_path / "in")), lambda df, n: seen.extend(df.collect()), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert [r.size_bytes for r in seen] == [12] and len(seen[0].id) == 8


def test_write_stream(spark, tmp_path):
    (tmp_path / "w").mkdir()
    writes = [("s", 1, None, "save"), ("s", 2, 1, "save"), ("s", 3, 1, "save"), ("t", 4, 0, "save")]
    (tmp_path / "w" / "1.json").write_text("\n".join(json.dumps(dict(zip(("sheet_key", "seq", "base_rev", "op"), w, strict=True))) for w in writes))
    df = spark.readStream.schema("sheet_key string, seq long, base_rev long, op string").json(str(tmp_path / "w"))
    seen = []
    q = stream.run_stages(stream.write_outcomes(df), lambda d, n: seen.extend(d.collect()), str(tmp_path / "ck2"))
    q.awaitTermination(90)
    assert sorted((r.sheet_key, r.base_rev, r.rev, r.accepted) for r in seen if r.base_rev is not None) == [("s", 1, 2, False), ("s", 1, 2, True), ("t", 0, 1, True)]
    assert sum(r.accepted for r in seen) == 3


def test_evaluation(spark):
    truths = spark.createDataFrame([("s", 1, 0.0, 0.0, 10.0, 10.0, "door"), ("s", 2, 50.0, 50.0, 60.0, 60.0, "door"), ("t", 3, 0.0, 0.0, 9.0, 9.0, "door")], "sheet string, truth_id long, x0 double, y0 double, x1 double, y1 double, cls string")
    preds = spark.createDataFrame([("s", 1, 0.0, 0.0, 10.0, 10.0, "door", 0.9), ("s", 2, 80.0, 80.0, 90.0, 90.0, "door", 0.8)], "sheet string, pred_id long, x0 double, y0 double, x1 double, y1 double, cls string, conf double")
    got = stages.evaluate(preds, truths, ["sheet"]).first()
    assert (got.ap, got.precision, got.recall) == (pytest.approx(1 / 3), 0.5, pytest.approx(1 / 3))
    assert (got.exact_rate, got.within_one_rate) == (0.5, 1.0)


def test_detections_weak_labels_and_index(spark):
    box = "sheet string, box_id long, x0 double, y0 double, x1 double, y1 double, conf double, cls string"
    a = spark.createDataFrame([("s", 1, 0.0, 0.0, 40.0, 40.0, 0.9, "door"), ("s", 2, 1.0, 1.0, 41.0, 41.0, 0.5, "door")], box)
    b = spark.createDataFrame([("s", 3, 10.0, 10.0, 20.0, 20.0, 0.8, "window"), ("s", 4, 42.0, 0.0, 80.0, 40.0, 0.7, "window")], box)
    got = stages.detections([a, b], "sheet", "box_id").collect()
    assert {r.box_id: r.group_no for r in got} == {1: 1, 4: 1}
    areas = spark.createDataFrame([("s", 0, "door_area", -10.0, -10.0, 100.0, 100.0)], "sheet string, area_ord int, area_type string, x0 double, y0 double, x1 double, y1 double")
    (weak,) = stages.weak_labels(a, areas, "sheet", "box_id").collect()
    assert (weak.label, weak.split, weak.n) == ("door", "train", 2)
    sheets = spark.createDataFrame([("s",), ("u",)], "sheet_key string")
    blocks = spark.createDataFrame([("s", "b1", "DOORS", "door", 0.0, 0.0, 10.0, 10.0)], "sheet_key string, block_id string, title string, category string, x0 double, y0 double, x1 double, y1 double")
    index = {r.sheet_key: r for r in stages.viewer_index(sheets, blocks, a.withColumnRenamed("sheet", "sheet_key")).collect()}
    assert index["s"].blocks[0].rect == [0.0, 0.0, 18.0, 18.0] and len(index["s"].boxes) == 2 and index["u"].boxes is None


def test_merge_and_duplicates(spark):
    old = spark.createDataFrame([("s", 1, 0.0, 0.0, 10.0, 10.0, True), ("s", 2, 50.0, 50.0, 60.0, 60.0, False)], "sheet string, old_id long, x0 double, y0 double, x1 double, y1 double, edited boolean")
    new = spark.createDataFrame([("s", 1, 1.0, 0.0, 11.0, 10.0), ("s", 2, 51.0, 50.0, 61.0, 60.0), ("s", 3, 80.0, 0.0, 90.0, 10.0)], "sheet string, new_id long, x0 double, y0 double, x1 double, y1 double")
    areas = spark.createDataFrame([("s", 0, "door_area", 0.0, 0.0, 40.0, 40.0)], "sheet string, area_ord int, area_type string, x0 double, y0 double, x1 double, y1 double")
    reviewed = spark.createDataFrame([("s", True)], "sheet string, reviewed boolean")
    got = {(r.old_id, r.new_id): (r.outcome, r.x0, r.area_ord) for r in stages.merge_sheets(old, new, areas, "sheet", reviewed).collect()}
    assert got == {(1, 1): ("kept_human", 0.0, 0), (2, 2): ("refreshed", 51.0, None), (None, 3): ("added_pending", 80.0, None)}
    words = spark.createDataFrame([(i, f"WORD{k}") for i in (1, 2, 3) for k in range(30 if i < 3 else 20)] + [(4, "aa")], "sheet long, text string")
    assert [tuple(r) for r in stages.deduplicate(words).collect()] == [(1, 2)]
