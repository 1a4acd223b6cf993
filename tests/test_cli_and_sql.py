"""The command line over table folders, SQL functions, registry helpers."""

import pytest
from pyspark.sql import functions as F

from quillgrid import cli
from quillgrid.operators import registry, similarity
from quillgrid.plans import sql

from .conftest import SMALL


def test_sql_functions(spark):
    sql.register(spark, SMALL)
    r = "named_struct('x0', {}D, 'y0', 0D, 'x1', {}D, 'y1', 10D)".format
    row = spark.sql(f"select rect_area({r(0, 10)}) a, rect_iou({r(0, 10)}, {r(5, 15)}) i, rect_containment({r(0, 10)}, {r(5, 15)}) c, rect_iou({r(0, 0)}, {r(0, 0)}) z, is_val('k') v").first()
    assert (row.a, row.c, row.z) == (100.0, 0.5, 0.0) and row.i == pytest.approx(1 / 3)
    assert spark.sql("select count(*) n from boxes join areas using (page)").first().n > 0


def test_commands(spark, tmp_path):
    save = lambda df, name: df.write.parquet(str(tmp_path / "in" / name))
    save(spark.createDataFrame([("a.pdf", 1, "x" * 300, 0, 0, 10.0, 20.0)], "file string, page int, text string, images int, rotation int, width double, height double"), "pages")
    box = "sheet_key string, box_id long, x0 double, y0 double, x1 double, y1 double, conf double, cls string"
    save(spark.createDataFrame([("s", 1, 0.0, 0.0, 40.0, 40.0, 0.9, "door"), ("s", 2, 1.0, 1.0, 41.0, 41.0, 0.5, "door")], box), "detections")
    save(spark.createDataFrame([("s", "door", 0.0, 0.0, 100.0, 100.0)], "sheet_key string, cls string, x0 double, y0 double, x1 double, y1 double"), "regions")
    args = ["--tables", str(tmp_path / "in"), "--out", str(tmp_path / "out")]
    cli.main(["manifest", *args])
    cli.main(["detect", *args, "--csv"])
    cli.main(["coverage", *args])
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name)).collect()
    assert [r.health for r in read("manifest")] == ["ok"]
    assert [r.box_id for r in read("openings")] == [1]
    assert [(r.bucket, r.n) for r in read("coverage")] == [("right", 1)]
    with pytest.raises(SystemExit):
        cli.main(["nonsense", *args])


def test_merging_areas(spark):
    cols = "sheet string, ord long, block_id string, area_type string, edited boolean, human boolean, x0 double, y0 double, x1 double, y1 double"
    old = spark.createDataFrame([("s", 0, "b1", "door_area", False, True, 0.0, 0.0, 10.0, 10.0), ("s", 1, None, "unknown", True, False, 50.0, 0.0, 60.0, 10.0), ("s", 2, "b9", "mixed", False, False, 200.0, 0.0, 210.0, 10.0)], cols)
    new = spark.createDataFrame([("s", 0, "b1", "window_area", False, False, 5.0, 0.0, 15.0, 10.0), ("s", 1, "b2", "door_area", False, False, 51.0, 0.0, 61.0, 10.0), ("s", 2, "b3", "exclude", False, False, 90.0, 0.0, 99.0, 9.0)], cols)
    got = {(r.old_ord, r.new_ord): (r.x0, r.area_type, r.outcome) for r in registry.merge_areas(old, new, ["sheet"]).collect()}
    assert got == {(0, 0): (5.0, "door_area", "matched"), (1, 1): (50.0, "door_area", "matched"), (2, None): (200.0, "mixed", "kept"), (None, 2): (90.0, "exclude", "new_since_seed")}


def test_bulk_states_and_journal(spark):
    one = "array<struct<id:string,cls:string,cls_source:string,state:string,area_id:string,flags:array<string>>>"
    rows = [("s", 3, [("door_area",)], [("a", "door", "inherited", "pending", "x", ["tiny"]), ("b", "", "required", "pending", "", []), ("c", "door", "inherited", "accepted", "x", [])])]
    df = spark.createDataFrame(rows, f"sheet_key string, rev long, areas array<struct<type:string>>, openings {one}")
    states = lambda fn: [o.state for o in df.select(fn(F.col("openings")).alias("o")).first().o]
    assert states(registry.accept_pending) == ["accepted", "pending", "accepted"]
    assert states(registry.reject_unassigned) == ["pending", "rejected", "accepted"]
    assert states(lambda o: registry.set_class(o, "b", "window")) == ["pending", "accepted", "accepted"]
    j = registry.journal(df).first()
    assert (j.n_areas, j.n_openings, j.n_accepted, j.n_rejected) == (1, 3, 1, 0)
    assert not registry.may_verify(df).first().ok
    flat = df.select("sheet_key", F.explode("openings").alias("o")).select("sheet_key", "o.cls", "o.flags")
    got = {r.sheet_key: (r.openings, r.flagged, r.unknown, r.difficulty) for r in registry.progress(flat, df.select("sheet_key")).collect()}
    assert got == {"s": (3, 1, 1, 4.6), None: (3, 1, 1, 4.6)}


def test_duplicate_groups(spark):
    pairs = spark.createDataFrame([(1, 2, 1.0), (1, 3, 1.0), (3, 4, 1.0), (7, 8, 1.0)], "a long, b long, jaccard double")
    sheets = spark.createDataFrame([(i, "p" if i < 3 else "q") for i in range(1, 9)], "node long, project string")
    got = [(r["first"], r.members, r.across) for r in similarity.duplicate_groups(pairs, sheets, similarity.components(pairs)).collect()]
    assert got == [(1, [1, 2, 3], True), (7, [7, 8], False)]
