"""Operators against naive Python on random whole-number boxes."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.operators import graph, greedy, registry, sequence, similarity, spatial


def boxes(seed, n, pages=3, span=120):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x, y = r.randint(0, span), r.randint(0, span)
        out.append((i, r.randint(1, pages), float(x), float(y), float(x + r.randint(5, 40)), float(y + r.randint(5, 40)), r.randint(1, 9) / 10, r.choice(["door", "window"])))
    return out


BOX = "box_id long, page long, x0 double, y0 double, x1 double, y1 double, conf double, cls string"


def iou(a, b):
    both = max(0, min(a[4], b[4]) - max(a[2], b[2])) * max(0, min(a[5], b[5]) - max(a[3], b[3]))
    size = lambda q: (q[4] - q[2]) * (q[5] - q[3])
    return both / (size(a) + size(b) - both)


def overlap(a, b, g=0.0):
    def grow(q):
        w, h = (q[4] - q[2]) * g, (q[5] - q[3]) * g
        return q[2] - w, q[3] - h, q[4] + w, q[5] + h

    a, b = grow(a), grow(b)
    return a[0] < b[2] and b[0] < a[2] and a[1] < b[3] and b[1] < a[3]


@pytest.mark.parametrize("seed", range(3))
def test_suppress(spark, seed):
    rows = boxes(seed, 80)
    want = set()
    for page in {r[1] for r in rows}:
        kept = []
        for a in sorted((r for r in rows if r[1] == page), key=lambda r: (-r[6], r[0])):
            if all(iou(a, b) < 0.3 for b in kept):
                kept.append(a)
        want |= {a[0] for a in kept}
    got = greedy.suppress(spark.createDataFrame(rows, BOX).repartition(5), ["page"], "box_id", 0.3).collect()
    assert {r.box_id for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rows = boxes(seed, 60, span=300)
    root = {r[0]: r[0] for r in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1] and overlap(a, b, 0.07):
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    got = graph.component_ids(spark.createDataFrame(rows, BOX), ["page"], "box_id").collect()
    assert {r.box_id: r.comp for r in got} == {r[0]: find(r[0]) for r in rows}
    merged = graph.merge_boxes(spark.createDataFrame(rows, BOX), ["page"], "box_id").collect()
    assert sum(m.n for m in merged) == len(rows)
    for m in merged:
        best = max((r for r in rows if find(r[0]) == m.comp), key=lambda r: (r[6], -r[0]))
        assert (m.conf, m.cls) == (best[6], best[7])


@pytest.mark.parametrize("seed", range(4))
def test_mask_components(spark, seed):
    """The box algebra against a painted and dilated mask."""
    r = random.Random(seed)
    rows = [(i, 1, float(x := r.randint(-20, 180)), float(y := r.randint(-20, 130)), float(x + r.randint(1, 30)), float(y + r.randint(1, 12)), 0.5, "door") for i in range(14)]
    got = {q.box_id: q.comp for q in graph.mask_components(spark.createDataFrame(rows, BOX), ["page"], "box_id", 100, 70, 6, 2).collect()}
    mask, place = np.zeros((70, 100), dtype=bool), {}
    for q in rows:
        x0, y0 = int(np.floor(q[2] * 0.5)), int(np.floor(q[3] * 0.5))
        x1, y1 = max(int(np.ceil(q[4] * 0.5)), x0 + 1), max(int(np.ceil(q[5] * 0.5)), y0 + 1)
        x0, x1, y0, y1 = (int(np.clip(v, 0, m)) for v, m in ((x0, 100), (x1, 100), (y0, 70), (y1, 70)))
        if x1 > x0 and y1 > y0:
            mask[max(0, y0 - 2) : min(70, y1 + 2), max(0, x0 - 6) : min(100, x1 + 6)] = True
            place[q[0]] = (y0, x0)
    label, n = np.zeros(mask.shape, dtype=int), 0
    for y, x in zip(*np.nonzero(mask), strict=True):
        if not label[y, x]:
            n += 1
            todo = [(y, x)]
            while todo:
                a, b = todo.pop()
                if 0 <= a < 70 and 0 <= b < 100 and mask[a, b] and not label[a, b]:
                    label[a, b] = n
                    todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    assert set(got) == set(place)
    for a in place:
        for b in place:
            assert (got[a] == got[b]) == (label[place[a]] == label[place[b]])


def test_match_truths(spark):
    rows = boxes(5, 60)
    preds, truths = rows[:40], [(i, p, x0 + 2, y0, x1 + 2, y1, c, k) for i, p, x0, y0, x1, y1, c, k in rows[20:]]
    want = {}
    used = set()
    for a in sorted(preds, key=lambda q: (q[1], -q[6], q[0])):
        best = max((t for t in truths if t[1] == a[1] and t[0] not in used), key=lambda t: (iou(a, t), -t[0]), default=None)
        hit = best is not None and iou(a, best) >= 0.5
        want[a[0]] = best[0] if hit else None
        if hit:
            used.add(best[0])
    p = spark.createDataFrame(preds, BOX).withColumnRenamed("box_id", "pred_id")
    t = spark.createDataFrame(truths, BOX).withColumnRenamed("box_id", "truth_id")
    got = {r.pred_id: r.truth_id for r in greedy.match_truths(p, t, ["page"]).collect()}
    assert got == want
    strict = greedy.match_truths(p, t, ["page"], agnostic=False).collect()
    kind = {r[0]: r[7] for r in rows}
    assert all(kind[r.pred_id] == kind[r.truth_id] for r in strict if r.hit)


def test_grid_pairs_equal_plain_pairs(spark):
    df = spark.createDataFrame(boxes(9, 150), BOX)
    plain = spatial.overlapping_pairs(df, "page", "box_id").select("a_box_id", "b_box_id")
    cells = spatial.overlapping_pairs(df, "page", "box_id", 25.0).select("a_box_id", "b_box_id")
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, cells.collect()))


def test_resolved_blocks_do_not_overlap(spark):
    rows = [(1, 1, 0.0, 0.0, 100.0, 100.0, 10.0, 0.0, 20.0, 8.0), (2, 1, 60.0, 0.0, 160.0, 100.0, 120.0, 0.0, 130.0, 8.0), (3, 1, 0.0, 80.0, 90.0, 200.0, 10.0, 150.0, 20.0, 158.0)]
    df = spark.createDataFrame(rows, "b long, page long, x0 double, y0 double, x1 double, y1 double, t_x0 double, t_y0 double, t_x1 double, t_y1 double")
    got = {r.b: r for r in greedy.resolve_overlaps(df, ["page"], "b").collect()}
    assert (got[1].x1, got[2].x0) == (70.0, 70.0) and (got[1].y1, got[3].y0) == (79.0, 80.0)


def test_grow_to_strokes(spark):
    reg = spark.createDataFrame([(1, 1, 0.0, 0.0, 50.0, 50.0)], "r long, page long, x0 double, y0 double, x1 double, y1 double")
    s = spark.createDataFrame([(1, 52.0, 10.0, 60.0, 20.0), (1, 62.0, 10.0, 70.0, 60.0), (1, 200.0, 200.0, 210.0, 210.0)], "page long, x0 double, y0 double, x1 double, y1 double")
    (got,) = graph.grow_to_strokes(reg, s, ["page"], "r").collect()
    assert (got.x0, got.y0, got.x1, got.y1) == (0.0, 0.0, 70.0, 60.0)


def test_keep_first(spark):
    pairs = spark.createDataFrame([(1, 2, 0.99), (2, 3, 0.96), (4, 5, 1.0), (4, 6, 1.0), (5, 6, 1.0)], "a long, b long, jaccard double")
    got = similarity.keep_first(pairs, similarity.components(pairs)).collect()
    assert sorted(map(tuple, got)) == [(1, 2), (4, 5), (4, 6)]


def test_jaccard_pairs_against_all(spark):
    r = random.Random(8)
    sets = []
    for i in range(120):
        base = sets[r.randrange(len(sets))][1] if sets and r.random() < 0.6 else [f"W{r.randint(0, 300):03d}" for _ in range(r.randint(0, 25))]
        sets.append((i, sorted({*base[r.randint(0, 1) :], *(["NEW"] if r.random() < 0.2 else [])})))
    want = {(a, b) for a, x in sets for b, y in sets if a < b and x and y and len({*x} & {*y}) / len({*x} | {*y}) >= 0.8}
    got = similarity.jaccard_pairs(spark.createDataFrame(sets, "i long, tokens array<string>"), "i", 0.8).collect()
    assert {(g.a, g.b) for g in got} == want and len(got) == len(want)


def test_title_merging_and_columns(spark):
    rows = [("f", 0, 1, "DOOR", 12.0, 0.0, 12.0), ("f", 1, 1, "SCHEDULE", 12.0, 14.0, 26.0), ("f", 2, 1, "small", 8.0, 28.0, 36.0), ("f", 3, 2, "OTHER", 12.0, 40.0, 52.0)]
    df = spark.createDataFrame(rows, "file string, ord int, block int, text string, size double, y0 double, y1 double")
    got = {r.ord: (r.run_text, r.run_lines) for r in sequence.merged_titles(df, ["file"]).collect()}
    assert got == {0: ("DOOR SCHEDULE", 2), 1: ("SCHEDULE", 1), 2: ("small", 1), 3: ("OTHER", 1)}
    anchors = spark.createDataFrame([("b", float(x)) for x in (0, 2, 100, 103, 200)], "k string, x0 double")
    bands = sequence.column_bands(anchors, ["k"]).orderBy("band").collect()
    assert [(b.lo, b.hi) for b in bands] == [(None, 50.0), (50.0, 150.0), (150.0, None)]


def test_trimming(spark):
    words = [(0.0, 10.0), (12.0, 30.0), (500.0, 520.0), (530.0, 560.0)]
    df = spark.createDataFrame([("b", lo, hi, 15.0) for lo, hi in words], "k string, x0 double, x1 double, t double")
    assert {r.x0 for r in sequence.trimmed_axis(df, ["k"], "x0", "x1", "t").collect()} == {0.0, 12.0}
    assert {r.x0 for r in sequence.trimmed_axis(df.where("x0 in (0.0, 500.0)"), ["k"], "x0", "x1", "t").collect()} == {0.0, 500.0}


def test_average_precision_edges(spark):
    scored = spark.createDataFrame([("a", 1, 0.9, True), ("a", 2, 0.8, False), ("a", 3, 0.7, True), ("b", 4, 0.9, False), ("c", 5, 0.5, False)], "g string, i long, conf double, hit boolean")
    truths = spark.createDataFrame([("a", 2), ("b", 0), ("c", 3), ("d", 4)], "g string, n_truth long")
    got = {r.g: r.ap for r in sequence.average_precision(scored, truths, ["g"], "i").collect()}
    assert got["a"] == pytest.approx(0.5 + 0.5 * 2 / 3) and np.isnan(got["b"]) and got["c"] == 0.0 and got["d"] == 0.0


def test_registry(spark):
    rev = spark.createDataFrame([("a", 1, "save", "x"), ("a", 2, "save", "y"), ("b", 1, "save", "z"), ("b", 2, "delete", "")], "sheet_key string, rev long, op string, payload string")
    assert {r.sheet_key: r.payload for r in registry.latest(rev).collect()} == {"a": "y"}
    assert {r.sheet_key: r.payload for r in registry.latest(rev, as_of=1).collect()} == {"a": "x", "b": "z"}
    writes = spark.createDataFrame([("a", 2), ("a", 1), ("a", None), ("c", 5)], "sheet_key string, base_rev long")
    got = registry.write_outcomes(writes, registry.latest(rev)).collect()
    assert {(r.sheet_key, r.base_rev): (r.accepted, r.rev_after) for r in got} == {("a", 2): (True, 3), ("a", 1): (False, 2), ("a", None): (True, 3), ("c", 5): (True, 1)}


def test_merging_twice_keeps_human_boxes(spark):
    rows = boxes(3, 50)
    old = spark.createDataFrame(rows, BOX).withColumnRenamed("box_id", "old_id").withColumn("edited", F.col("old_id") % 3 == 0)
    new = spark.createDataFrame(rows[10:], BOX).withColumnRenamed("box_id", "new_id")
    for _ in range(2):
        got = registry.merge_snapshots(old, new, ["page"], F.lit(True)).collect()
        assert {r.old_id for r in got if r.old_id is not None} == {r[0] for r in rows}
        assert all(r.outcome in ("kept_human", "kept_unmatched") for r in got if r.old_id is not None and r.old_id % 3 == 0)


def test_order_of_rows_and_partitions_does_not_matter(spark):
    df = spark.createDataFrame(boxes(4, 90), BOX)
    a = greedy.suppress(df.repartition(1), ["page"], "box_id").collect()
    b = greedy.suppress(df.orderBy(F.desc("box_id")).repartition(7), ["page"], "box_id").collect()
    assert Counter(a) == Counter(b)
