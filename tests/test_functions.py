"""Tables of cases for the Column functions."""

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgrid.functions import geometry as G
from quillgrid.functions import text as T
from quillgrid.functions.geometry import Rect


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


TITLES = {
    "DOOR SCHEDULE": (1.0, "door", "schedule"),
    "Schedule of  Windows": (1.0, "window", "schedule"),
    "WINDOW SCHEDULE NOTES": (1.0, "window", "notes"),
    "DOOR TYPES": (1.0, "door", "type_legend"),
    "DOOR TYPES AND DETAILS:": (1.0, "door", "type_legend"),
    "WINDOW ELEVATIONS.": (1.0, "window", "type_legend"),
    "EXTERIOR ELEVATIONS": (0.0, "unknown", "type_legend"),
    "FRAME TYPES": (0.35, "unknown", "type_legend"),
    "HOLLOW METAL FRAME TYPES": (0.0, "unknown", "type_legend"),
    "DOOR HEAD DETAIL": (0.0, "door", "unknown"),
    "PANEL SCHEDULE": (0.0, "unknown", "schedule"),
    "ROOM FINISH SCHEDULE": (0.0, "unknown", "schedule"),
    "EQUIPMENT CHART": (0.0, "unknown", "schedule"),
    "HARDWARE SCHEDULE": (0.35, "unknown", "schedule"),
    "DOOR HARDWARE": (0.0, "door", "hardware"),
    "SHEET INDEX DOOR SCHEDULE": (0.0, "door", "schedule"),
    "see door schedule for the sizes of all of the openings": (0.0, "both", "schedule"),
    "OVERHEAD DOOR SCHEDULE": (1.0, "garage_door", "schedule"),
    "WINDOW AND DOOR LEGEND": (1.0, "both", "type_legend"),
    "": (0.0, "unknown", "unknown"),
}


def test_titles(spark):
    names = list(TITLES)
    assert apply(spark, names, T.title_score) == [v[0] for v in TITLES.values()]
    got = apply(spark, names, T.category_of)
    assert [g for g, n in zip(got, names, strict=True) if "openings" not in n] == [v[1] for n, v in TITLES.items() if "openings" not in n]
    assert apply(spark, names, T.kind_of) == [v[2] for v in TITLES.values()]


def test_headers(spark):
    got = apply(spark, [["mark", "(Width)", "type", "TYPE", "foo"], [], ["T.", "HT."]], T.header_strength, "array<string>")
    assert [tuple(r) for r in got] == [(3, 2), (0, 0), (1, 1)]
    rows = [["Mark", "Width", "Height", ""], ["A1", "3'-0\"", "7'-0\""], ["Mark", ""], ["WIDTH/HEIGHT", "foo"]]
    assert apply(spark, rows, T.is_header_row, "array<string>") == [True, False, False, True]
    assert apply(spark, [["A1", "x"], ["hello there", "3'-0\""], ["hello there", "big door"], ["", ""]], T.is_data_row, "array<string>") == [True, True, False, False]


DIMENSIONS = {"3' - 6\"": 42.0, "3'-0": 36.0, "2/10": 34.0, "2/14": None, "36": 36.0, '3.5"': 3.5, "VARIES": None, "": None, "N/A": None, "10 '": 120.0, None: None}


def test_dimensions(spark):
    assert apply(spark, list(DIMENSIONS), T.to_inches) == list(DIMENSIONS.values())
    assert apply(spark, ["3' - 0'", "3'-0\""], T.tidy_dimension) == ["3'-0\"", "3'-0\""]
    assert apply(spark, ["8", "7.9", "200", "201", "x"], lambda c: T.plausible(c, 200.0)) == [True, False, True, False, False]
    got = apply(spark, ["3'-0\" x 6'-8\" FLUSH", "PAIR 3068 HM", "plain"], T.parse_title)
    assert [tuple(r) for r in got] == [("3'-0\"", "6'-8\"", "FLUSH"), ("3'-0\"", "6'-8\"", "HM"), ("", "", "plain")]


def test_facets(spark):
    df = spark.createDataFrame([("HM FLUSH DOOR 90 MIN", "unknown", ""), ("ALUM SLIDER TEMP GL", "window", ""), ("FLUSH WITH WALL", "unknown", ""), ("S.G.D.", "unknown", ""), ("LOUVER", "door", ""), ("", "door", "F"), (None, None, None)], "t string, b string, c string")
    got = [r.x for r in df.select(T.classify(F.col("t"), F.col("b"), F.col("c")).alias("x")).collect()]
    assert (got[0].category, got[0].leaf_face, got[0].material, got[0].fire_rating_min, got[0].needs_review) == ("door", "flush", "hollow_metal", 90, False)
    assert (got[1].category, got[1].mapped_by, got[1].operation, got[1].glazing) == ("window", "block_title", "sliding", ["tempered"])
    assert got[2].leaf_face is None and got[2].needs_review
    assert (got[3].category, got[3].operation) == ("door", "sliding")
    assert got[4].category == "louver" and not got[4].needs_review
    assert (got[5].category, got[5].leaf_face) == ("door", "flush")
    assert got[6].needs_review


def test_roles_and_recovery(spark):
    names = ["MARK", "DOOR SIZE.WIDTH", "DOOR SIZE.HEIGHT", "TYPE", "REMARKS"]
    (got,) = apply(spark, [names], T.roles, "array<string>")
    assert got == {"mark": "MARK", "width": "DOOR SIZE.WIDTH", "height": "DOOR SIZE.HEIGHT", "type_code": "TYPE", "remarks": "REMARKS"}
    cells = [("MARK", "1'-0\""), ("DOOR SIZE", "3'-0\" 1 8'-0\""), ("X", "9'-0\"")]
    df = spark.createDataFrame([(cells, {"mark": "MARK"}), (cells, {"width": "X"})], "c array<struct<name:string,value:string>>, r map<string,string>")
    assert [tuple(r.x) for r in df.select(T.recover_size(F.col("c"), F.col("r")).alias("x")).collect()] == [("3'-0\"", "8'-0\""), ("", "")]
    assert [tuple(r) for r in apply(spark, ["101A HALL DOOR", "HALL"], T.split_leading_mark)] == [("101A", "HALL DOOR"), ("", "HALL")]


def test_keys_and_split(spark):
    keys = [f"planset{i}" for i in range(50)]
    assert apply(spark, keys, T.is_val) == [hashlib.sha256(k.encode()).digest()[0] % 5 == 4 for k in keys]
    assert apply(spark, ["/a/project_12_x.pdf", "/a/b.c.pdf"], T.project_id) == ["12", "b.c"]
    assert apply(spark, ["ok_1-x", "../etc", "a/b", ""], T.valid_key) == [True, False, False, False]
    assert apply(spark, ["Window-A", "garage door", "sash door", "wall"], T.class_index) == [0, 1, 0, None]
    assert apply(spark, ["• a", "•• b", "SIZE: 3", "plain"], T.bullet_depth) == [1, 2, 1, 0]
    assert apply(spark, ["• a", "‣ * b", "- c"], T.strip_bullet) == ["a", "b", "- c"]  # a dash is no bullet


box = st.tuples(*[st.integers(0, 60)] * 4).map(lambda b: (min(b[0], b[2]), min(b[1], b[3]), max(b[0], b[2]), max(b[1], b[3])))


def inter(a, b):
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def size(a):
    return max(0, a[2] - a[0]) * max(0, a[3] - a[1])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(box, box), min_size=30, max_size=60))
def test_geometry(spark, pairs):
    df = spark.createDataFrame([(i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(pairs)], "i int, x0 double, y0 double, x1 double, y1 double, b_x0 double, b_y0 double, b_x1 double, b_y1 double")
    r, s = Rect.of(), Rect.of("b_")
    turned = G.rotate_back(Rect(*G.rotate(r, *map(F.lit, (0.0, 1.0, -1.0, 0.0, 100.0, 0.0)))), *map(F.lit, (0.0, 1.0, -1.0, 0.0, 100.0, 0.0)))
    got = df.select("i", G.iou(r, s).alias("iou"), G.containment(r, s).alias("share"), G.intersects(r, s).alias("hit"), G.contains(r, s).alias("holds"), G.to_crop(r, s).alias("u"), F.array(*turned).alias("turned")).orderBy("i").collect()
    for g, (a, b) in zip(got, pairs, strict=True):
        both, whole = inter(a, b), size(a) + size(b) - inter(a, b)
        assert g.iou == pytest.approx(both / whole if whole else 0.0)
        assert g.share == pytest.approx(both / max(size(a), 1e-9))
        assert g.hit == (a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3])
        assert g.holds == (a[0] <= b[0] and a[1] <= b[1] and a[2] >= b[2] and a[3] >= b[3])
        assert (g.u is not None) == (size(a) > 0 and size(b) > 0 and both > 0 and both >= 0.6 * size(a))
        assert g.turned == pytest.approx(list(map(float, a)))


def test_flags(spark):
    df = spark.createDataFrame([(0.0, 0.0, 12.0, 100.0, 0.2), (0.0, 0.0, 50.0, 50.0, 0.9), (0.0, 0.0, 700.0, 100.0, 0.0)], "x0 double, y0 double, x1 double, y1 double, conf double")
    assert [r.f for r in df.select(G.attention_flags(Rect.of(), F.col("conf")).alias("f")).collect()] == [["tiny", "low_conf", "extreme_aspect"], [], ["extreme_aspect"]]
    assert math.isclose(df.select(G.render_zoom(F.col("x1"), F.col("y1")).alias("z")).first().z, 16.0)


def test_item_patterns(spark):
    """Values read off the reference's rules, not off the constants here."""
    got = apply(spark, ["TYPE A 6'-0' x 6'-0\" FIXED", "3'-0\" × 6'-8\" FLUSH", "3068", "pair 3068 HM", "x 3068 HM"], T.parse_title)
    assert [(g.width, g.height, g.kind) for g in got] == [("6'-0\"", "6'-0\"", "FIXED"), ("3'-0\"", "6'-8\"", "FLUSH"), ("", "", "3068"), ("3'-0\"", "6'-8\"", "HM"), ("", "", "x 3068 HM")]
    assert apply(spark, ["■ a", "▪‣ b", "◦ c", "- d", "GLASS TYPE: LOW E", "A: x", "U/VALUE: 3", "FIN. HDW: X"], T.bullet_depth) == [1, 2, 0, 0, 1, 0, 0, 1]
    rows = [["abc-1"], ["ABCD"], ["w.12a"], ["hello there", "30 - 36"], ["hello there", "3068"], ["hello there", "varies"], ["hello there", "1/2"], ["hello there", "30681"]]
    assert apply(spark, rows, T.is_data_row, "array<string>") == [True, True, True, True, True, True, False, False]
    assert apply(spark, ["gate", "opening", "Garage", "glaz", "Glazing"], T.class_index) == [None, None, 1, None, 0]


def test_titles_have_no_most_lines(spark):
    from quillgrid.operators import sequence

    rows = [(1, 0, k, f"t{k}", 12.0, 14.0 * k, 14.0 * k + 10) for k in range(9)] + [(1, 1, 9, "other", 12.0, 126.0, 136.0), (1, 0, 10, "back", 12.0, 140.0, 150.0)]
    rows += [(2, 0, 0, "a", 20.0, 0.0, 10.0), (2, 0, 1, "small", 6.0, 12.0, 18.0), (2, 0, 2, "b", 20.0, 20.0, 30.0)]
    got = {(r.page, r.ord): r.run_text for r in sequence.merged_titles(spark.createDataFrame(rows, "page int, block int, ord int, text string, size double, y0 double, y1 double"), ["page"]).collect()}
    assert got[1, 0] == " ".join(f"t{k}" for k in range(9)) and got[1, 8] == "t8" and got[1, 10] == "back"
    assert got[2, 0] == "a" and got[2, 2] == "b"
