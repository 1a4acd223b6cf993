"""Spatial joins: an equality on the page, with rectangle predicates as residual.

Pages bound the number of rectangles that meet. For pages with very many, grid()
deals them to cells, so that the equality is on page and cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions import geometry as G
from quillgrid.functions.geometry import Rect


def grid(df: DataFrame, cell: float, prefix: str = "", pad: float = 0.0) -> DataFrame:
    """df with a row for each grid cell (gx, gy) that its rectangle, padded, touches."""
    r = Rect.of(prefix)
    span = lambda lo, hi: F.explode(F.sequence(F.floor((lo - pad) / cell).cast("int"), F.floor((hi + pad) / cell).cast("int")))
    return df.withColumn("gx", span(r.x0, r.x1)).withColumn("gy", span(r.y0, r.y1))


def overlapping_pairs(df: DataFrame, key: str, ident: str, cell: float | None = None) -> DataFrame:
    """Pairs (a_ , b_ columns) of one key whose rectangles overlap, a's ident the smaller.

    With cell, pairs meet in grid cells and count in the cell of their overlap's
    first corner only.
    """
    cols = [key, ident, "x0", "y0", "x1", "y1"]
    base = df.select(*cols) if cell is None else grid(df.select(*cols), cell)
    on = ["gx", "gy"] if cell is not None else []
    a = base.select(F.col(key), *on, *(F.col(c).alias(f"a_{c}") for c in cols[1:]))
    b = base.select(F.col(key), *on, *(F.col(c).alias(f"b_{c}") for c in cols[1:]))
    ra, rb = Rect.of("a_"), Rect.of("b_")
    out = a.join(b, [key, *on]).where((F.col(f"a_{ident}") < F.col(f"b_{ident}")) & G.intersects(ra, rb))
    if cell is not None:
        out = out.where((F.floor(F.greatest(ra.x0, rb.x0) / cell) == F.col("gx")) & (F.floor(F.greatest(ra.y0, rb.y0) / cell) == F.col("gy"))).drop("gx", "gy")
    return out


def smallest_container(boxes: DataFrame, areas: DataFrame, key: str, box_id: str, share: float = 0.70) -> DataFrame:
    """boxes (with conf, cls columns kept) plus area_ord, area_type, containment of the smallest area that holds share of it.

    Areas of type exclude hold nothing; between equals the first (area_ord) wins.
    Boxes without an area have nulls. areas: key, area_ord, area_type, rectangle.
    """
    box, area = Rect.of(), Rect.of("a_")
    a = areas.where("area_type != 'exclude'").select(F.col(key), "area_ord", "area_type", *Rect.of().named("a_"))
    got = G.containment(box, area)
    hit = boxes.join(a, key).withColumn("containment", got).where(F.col("containment") >= share)
    best = hit.groupBy(key, box_id).agg(F.min_by(F.struct("area_ord", "area_type", "containment"), F.struct(G.area(area), F.col("area_ord"))).alias("best"))
    return boxes.join(best, [key, box_id], "left").select(*boxes.columns, "best.area_ord", "best.area_type", "best.containment")


def contained_words(words: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Words with the block_id of each block that holds them wholly."""
    b = blocks.select(F.col(key), "block_id", *Rect.of().named("b_"))
    return words.join(b, key).where(G.contains(Rect.of("b_"), Rect.of())).select(*words.columns, "block_id")


def nearest_below(upper: DataFrame, lower: DataFrame, key: str, upper_id: str, least: float, most: Column | float, reach: Column | float, label: bool = False) -> DataFrame:
    """upper plus the lower row (l_ columns) that starts over least, up to most under it, its centre within reach; the highest wins.

    Between equals the left one, then the one of smaller ident. For labels, the
    drop is from top to top, and the reach is from the label's sides.
    """
    low = lower.select(F.col(key), *(F.col(c).alias(f"l_{c}") for c in lower.columns if c != key))
    r, s = Rect.of(), Rect.of("l_")
    drop = s.y0 - (r.y0 if label else r.y1)
    beside = s.cx.between(r.x0 - reach, r.x1 + reach) if label else F.abs(s.cx - r.cx) <= reach
    hit = upper.join(low, key).where((drop > least) & (drop <= most) & beside)
    cols = [c for c in low.columns if c != key]
    best = hit.groupBy(key, upper_id).agg(F.min_by(F.struct(*cols), F.struct("l_y0", "l_x0", "l_id")).alias("best"))
    return upper.join(best, [key, upper_id], "left").select(*upper.columns, *(F.col(f"best.{c}").alias(c) for c in cols))


def nearest_above(items: DataFrame, marks: DataFrame, key: str, item_id: str, most: float = 260.0, reach: float = 60.0) -> DataFrame:
    """items plus the mark (m_ columns) that ends nearest above it, within a column of max(0.75 width, reach)."""
    m = marks.select(F.col(key), *(F.col(c).alias(f"m_{c}") for c in marks.columns if c != key))
    r, s = Rect.of(), Rect.of("m_")
    gap = r.y0 - s.y1
    hit = items.join(m, key).where((gap >= 0) & (gap <= most) & (F.abs(s.cx - r.cx) <= F.greatest(r.width * 0.75, F.lit(reach))))
    cols = [c for c in m.columns if c != key]
    best = hit.groupBy(key, item_id).agg(F.min_by(F.struct(*cols), F.struct(gap, F.col("m_id"))).alias("best"))
    return items.join(best, [key, item_id], "left").select(*items.columns, *(F.col(f"best.{c}").alias(c) for c in cols))


def assign_by_cost(components: DataFrame, titles: DataFrame, key: str, weight: float = 0.8, limit: float = 1500.0, low_title: float = 0.65) -> DataFrame:
    """components (comp_id, rectangle, page_h) with the title_id of least cost; null where none is eligible.

    Cost: the gap between the rectangles plus weight times the distance of their
    left edges. A component above a title may go to it only where the title begins
    below low_title of the page's height. A title is ruled out where a rival's
    centre lies between it and the component in the title's band.
    """
    c, t, v = Rect.of(), Rect.of("t_"), Rect.of("v_")
    ts = titles.select(F.col(key), F.col("title_id"), *Rect.of().named("t_"))
    dx = F.greatest(F.lit(0.0), F.greatest(t.x0 - c.x1, c.x0 - t.x1))
    dy = F.greatest(F.lit(0.0), F.greatest(t.y0 - c.y1, c.y0 - t.y1))
    cost = dx + dy + F.abs(c.x0 - t.x0) * weight
    pairs = components.join(ts, key).withColumn("cost", cost).where((F.col("cost") < limit) & ((c.cy >= t.cy) | (t.y0 >= low_title * F.col("page_h"))))
    rivals = titles.select(F.col(key).alias("v_key"), F.col("title_id").alias("v_id"), *Rect.of().named("v_"))
    between = (v.cx > F.least(c.cx, t.cx)) & (v.cx < F.greatest(c.cx, t.cx))
    band = (v.y0 < t.y1) & (t.y0 < v.y1)
    free = pairs.join(rivals, (F.col(key) == F.col("v_key")) & (F.col("title_id") != F.col("v_id")) & band & between, "left_anti")
    best = free.groupBy(key, "comp_id").agg(F.min_by("title_id", F.struct("cost", "title_id")).alias("title_id"))
    return components.join(best, [key, "comp_id"], "left")


def row_tails(words: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, row_id, tail): words right of a row's grid whose middle lies in its band, joined in x order."""
    r = rows.select(F.col(key), "row_id", *Rect.of().named("r_"))
    hit = words.join(r, key).where((F.col("x0") >= F.col("r_x1")) & (Rect.of().cy >= F.col("r_y0")) & (Rect.of().cy < F.col("r_y1")))
    sorted_text = F.transform(F.array_sort(F.collect_list(F.struct("x0", "word_id", "text"))), lambda s: s["text"])
    return hit.groupBy(key, "row_id").agg(F.array_join(sorted_text, " ").alias("tail"))


def coverage_buckets(boxes: DataFrame, regions: DataFrame, key: str, box_id: str, share: float = 0.70, small: float = 0.20) -> DataFrame:
    """boxes plus a bucket: right, ambiguous, wrong, too_small, outside or no_region.

    regions hand down cls (null for mixed and unknown, which still counts as one
    more class). outside: on a page with regions, small or less of it in any.
    """
    box, reg = Rect(*(F.col(c) for c in Rect._fields)), Rect.of("r_")
    rs = regions.select(F.col(key), F.col("cls").alias("r_cls"), *Rect.of().named("r_"))
    part = boxes.join(rs, key, "left").withColumn("part", F.when(F.col("r_x0").isNotNull(), G.containment(box, reg)))
    held = F.col("part") >= share
    name = F.coalesce("r_cls", F.lit(""))
    got = part.groupBy(key, box_id, "cls").agg(
        F.count("r_x0").alias("regions"),
        F.max("part").alias("most"),
        F.collect_set(F.when(held, name)).alias("classes"),
    )
    return got.select(
        key,
        box_id,
        F.when(F.col("regions") == 0, "no_region")
        .when(F.size("classes") > 1, F.when(F.array_contains("classes", F.col("cls")), "ambiguous").otherwise("wrong"))
        .when(F.size("classes") == 1, F.when(F.array_contains("classes", F.col("cls")), "right").otherwise("wrong"))
        .when(F.col("most") > small, "too_small")
        .otherwise("outside")
        .alias("bucket"),
    )
