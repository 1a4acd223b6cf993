"""A revisioned registry of sheets: current state, conflicts, tombstones, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions.geometry import Rect
from quillgrid.operators.greedy import match_pairs
from quillgrid.operators.spatial import smallest_container


def latest(revisions: DataFrame, key: str = "sheet_key", as_of: int | None = None) -> DataFrame:
    """The last revision of each key, up to as_of; tombstones (op delete) leave none. A partial aggregate, no sort."""
    rows = revisions if as_of is None else revisions.where(F.col("rev") <= as_of)
    cols = [c for c in revisions.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*cols), "rev").alias("r")).select(key, "r.*")
    return best.where("op != 'delete'") if "op" in cols else best


def write_outcomes(writes: DataFrame, current: DataFrame, key: str = "sheet_key") -> DataFrame:
    """writes (base_rev) plus accepted and the rev that stands after: a base older than the current revision is a conflict, a null base is accepted."""
    now = current.select(key, F.col("rev").alias("now"))
    ok = F.col("base_rev").isNull() | F.col("now").isNull() | (F.col("base_rev") >= F.col("now"))
    return writes.join(now, key, "left").withColumn("accepted", ok).withColumn("rev_after", F.when(ok, F.coalesce("now", F.lit(0)) + 1).otherwise(F.col("now"))).drop("now")


def to_seed(sheets: DataFrame, known: DataFrame, tombstones: DataFrame, key: str = "sheet_key", force: bool = False) -> DataFrame:
    """Sheets with neither an annotation nor a tombstone; all with force."""
    return sheets if force else sheets.join(known.select(key), key, "left_anti").join(tombstones.select(key), key, "left_anti")


def triage(boxes: DataFrame, areas: DataFrame, key: str, box_id: str, accept: float = 0.5) -> DataFrame:
    """boxes with state: rejected where an exclude area holds 70 % of it, accepted where clean, classed and confident, else pending."""
    inside = smallest_container(boxes.select(key, box_id, *Rect._fields), areas.where("area_type = 'exclude'").withColumn("area_type", F.lit("shut")), key, box_id)
    out = smallest_container(boxes, areas, key, box_id).join(inside.select(key, box_id, F.col("area_ord").alias("shut")), [key, box_id])
    clean = F.least(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) >= 13
    state = F.when(F.col("shut").isNotNull(), "rejected").when(clean & F.col("area_ord").isNotNull() & ~F.col("area_type").isin("mixed", "unknown") & (F.col("conf") >= accept), "accepted").otherwise("pending")
    return out.withColumn("state", state).drop("shut")


def merge_snapshots(old: DataFrame, new: DataFrame, by: list[str], reviewed: Column, limit: float = 0.5) -> DataFrame:
    """(by, old_id, new_id, outcome) of a merge of fresh boxes into stored ones.

    Matched pairs are refreshed, or kept where a human has edited them; stored
    boxes without a match stay; fresh ones are added, pending on reviewed sheets.
    """
    pairs = match_pairs(old, new, by, limit).drop("overlap")
    o, n = old.select(*by, "old_id", "edited"), new.select(*by, "new_id", reviewed.alias("reviewed"))
    both = pairs.join(o, [*by, "old_id"]).withColumn("outcome", F.when(F.col("edited"), "kept_human").otherwise("refreshed")).select(*by, "old_id", "new_id", "outcome")
    left = o.join(pairs, [*by, "old_id"], "left_anti").select(*by, "old_id", F.lit(None).cast("long").alias("new_id"), F.lit("kept_unmatched").alias("outcome"))
    fresh = n.join(pairs, [*by, "new_id"], "left_anti").select(*by, F.lit(None).cast("long").alias("old_id"), "new_id", F.when(F.col("reviewed"), "added_pending").otherwise("added").alias("outcome"))
    return both.unionByName(left).unionByName(fresh)


def journal(sheets: DataFrame) -> DataFrame:
    """Counts for each saved sheet (areas, openings as arrays)."""
    in_state = lambda s: F.size(F.filter(F.col("openings")["state"], lambda x: x == s))
    return sheets.select("sheet_key", "rev", F.size("areas").alias("n_areas"), F.size("openings").alias("n_openings"), in_state("accepted").alias("n_accepted"), in_state("rejected").alias("n_rejected"))


def may_verify(sheets: DataFrame) -> DataFrame:
    """(sheet_key, ok): no unknown or mixed area, no pending box, no accepted box without a class."""
    bad_area = F.exists("areas", lambda a: a["type"].isin("unknown", "mixed"))
    bad_box = F.exists("openings", lambda o: (o["state"] == "pending") | ((o["state"] == "accepted") & (F.coalesce(o["cls"], F.lit("")) == "")))
    return sheets.select("sheet_key", (~bad_area & ~bad_box).alias("ok"))


def rank_first(df: DataFrame, by: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each group in a total order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k")


def merge_areas(old: DataFrame, new: DataFrame, by: list[str], limit: float = 0.5) -> DataFrame:
    """(by, old_ord, new_ord, x0, y0, x1, y1, area_type, outcome) of a merge of fresh areas into stored ones.

    An area is matched by its block first, else by the first free one in order that
    overlaps by limit. A matched rectangle is refreshed unless edited, its type
    unless a human set it; stored areas stay, fresh ones are added as new.
    """
    import pandas as pd

    from quillgrid.operators.greedy import SIDES, _grouped, iou_matrix

    cols = ["ord", "block_id", "area_type", "edited", "human"]
    a = old.select(*by, F.lit(0).alias("side"), *cols, *SIDES)
    b = new.select(*by, F.lit(1).alias("side"), *cols, *SIDES)

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        o, n = (g[g.side == s].sort_values("ord").reset_index(drop=True) for s in (0, 1))
        over = iou_matrix(o[SIDES].to_numpy(float), n[SIDES].to_numpy(float))
        used, out = set(), []
        for i, x in o.iterrows():
            same = [j for j in n.index if j not in used and x.block_id and n.block_id[j] == x.block_id]
            near = [j for j in n.index if j not in used and over[i, j] >= limit]
            j = (same or near or [None])[0]
            rect, kind, outcome = x[SIDES].tolist(), x.area_type, "kept"
            if j is not None:
                used.add(j)
                rect = rect if x.edited else n.loc[j, SIDES].tolist()
                kind, outcome = x.area_type if x.human else n.area_type[j], "matched"
            out.append((x.ord, None if j is None else n.ord[j], *rect, kind, outcome))
        out += [(None, n.ord[j], *n.loc[j, SIDES].tolist(), n.area_type[j], "new_since_seed") for j in n.index if j not in used]
        frame = pd.DataFrame(out, columns=["old_ord", "new_ord", *SIDES, "area_type", "outcome"])
        return frame.astype({"old_ord": "Int64", "new_ord": "Int64"})

    return _grouped(a.unionByName(b), by, ["side", *cols, *SIDES], fn, "old_ord long, new_ord long, x0 double, y0 double, x1 double, y1 double, area_type string, outcome string")


def accept_pending(openings: Column) -> Column:
    """Pending openings that have a class become accepted."""
    return F.transform(openings, lambda o: o.withField("state", F.when((o["state"] == "pending") & (F.coalesce(o["cls"], F.lit("")) != ""), "accepted").otherwise(o["state"])))


def reject_unassigned(openings: Column) -> Column:
    """Openings without an area become rejected."""
    return F.transform(openings, lambda o: o.withField("state", F.when(F.coalesce(o["area_id"], F.lit("")) == "", "rejected").otherwise(o["state"])))


def set_class(openings: Column, ident: str, cls: str) -> Column:
    """A class set by a human, which accepts the opening."""
    mine = lambda o: o["id"] == ident
    return F.transform(openings, lambda o: o.withField("cls", F.when(mine(o), cls).otherwise(o["cls"])).withField("cls_source", F.when(mine(o), "human").otherwise(o["cls_source"])).withField("state", F.when(mine(o), "accepted").otherwise(o["state"])))


def progress(openings: DataFrame, areas: DataFrame, key: str = "sheet_key") -> DataFrame:
    """(sheet, openings, flagged, unknown, difficulty) with a total row (null key): flagged + 3 unknown + 5 without areas + 0.2 a box, one decimal."""
    o = openings.groupBy(key).agg(F.count("*").alias("openings"), F.count_if(F.size("flags") > 0).alias("flagged"), F.count_if(F.coalesce("cls", F.lit("")) == "").alias("unknown"))
    a = areas.select(key).distinct().withColumn("has", F.lit(1))
    s = o.join(a, key, "left").withColumn("difficulty", F.round(F.col("flagged") + 3 * F.col("unknown") + F.when(F.col("has").isNull(), 5).otherwise(0) + 0.2 * F.col("openings"), 1))
    return s.rollup(key).agg(F.sum("openings").alias("openings"), F.sum("flagged").alias("flagged"), F.sum("unknown").alias("unknown"), F.round(F.sum("difficulty"), 1).alias("difficulty"))
