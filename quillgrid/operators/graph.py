"""Connected components of rectangles, and what grows from them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions import geometry as G
from quillgrid.functions.geometry import Rect
from quillgrid.operators.greedy import SIDES, _grouped


def least_of(links: np.ndarray) -> np.ndarray:
    """The least node reachable from each over a symmetric link matrix."""
    n = len(links)
    root = np.arange(n)
    while True:
        new = np.minimum(root, np.where(links, root[None, :], n).min(axis=1, initial=n))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def component_ids(boxes: DataFrame, by: list[str], ident: str, grow: float = 0.07) -> DataFrame:
    """(by, ident, comp): the least ident among the boxes that a box reaches over overlaps after growing each by a share of its sides."""

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(ident).reset_index(drop=True)
        r = g[SIDES].to_numpy(float)
        w, h = (r[:, 2] - r[:, 0]) * grow, (r[:, 3] - r[:, 1]) * grow
        r = np.stack([r[:, 0] - w, r[:, 1] - h, r[:, 2] + w, r[:, 3] + h], axis=1)
        hit = (r[:, None, 0] < r[None, :, 2]) & (r[None, :, 0] < r[:, None, 2]) & (r[:, None, 1] < r[None, :, 3]) & (r[None, :, 1] < r[:, None, 3])
        ids = g[ident].to_numpy()
        return pd.DataFrame({ident: ids, "comp": ids[least_of(hit)]})

    return _grouped(boxes, by, [ident, *SIDES], fn, f"`{ident}` long, comp long")


def merge_boxes(boxes: DataFrame, by: list[str], ident: str, grow: float = 0.07) -> DataFrame:
    """(by, comp, rectangle, conf, cls, n): one box for each component, with the class of its most confident member."""
    c = boxes.join(component_ids(boxes, by, ident, grow), [*by, ident])
    best = F.struct(F.col("conf"), -F.col(ident))
    return c.groupBy(*by, "comp").agg(*G.union_agg(Rect.of()), F.max("conf").alias("conf"), F.max_by("cls", best).alias("cls"), F.count("*").alias("n"))


def mask_components(words: DataFrame, by: list[str], ident: str, width: int, height: int, kx: int = 12, ky: int = 4, scale: float = 0.5) -> DataFrame:
    """(by, ident, comp) of words whose boxes, on a mask of width x height and dilated by kx, ky, touch (8 neighbours).

    The mask is never painted: clipped integer boxes are grown and compared.
    """

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(ident).reset_index(drop=True)
        r = g[SIDES].to_numpy(float) * scale
        lo, hi = np.floor(r[:, :2]).astype(int), np.maximum(np.ceil(r[:, 2:]).astype(int), np.floor(r[:, :2]).astype(int) + 1)
        size, k = np.array([width, height]), np.array([kx, ky])
        lo, hi = np.clip(lo, 0, size), np.clip(hi, 0, size)
        on = (hi > lo).all(axis=1)
        lo, hi, ids = np.clip(lo - k, 0, size)[on], np.clip(hi + k, 0, size)[on], g[ident].to_numpy()[on]
        hit = (lo[:, None] <= hi[None, :]).all(axis=2) & (lo[None, :] <= hi[:, None]).all(axis=2)
        return pd.DataFrame({ident: ids, "comp": ids[least_of(hit)] if len(ids) else ids})

    return _grouped(words, by, [ident, *SIDES], fn, f"`{ident}` long, comp long")


def grow_to_strokes(regions: DataFrame, strokes: DataFrame, by: list[str], ident: str, reach: float = 4.0, most: float = 3.5) -> DataFrame:
    """(by, ident, rectangle): each region takes in strokes that touch it within reach, until none does or it would grow past most times its area."""
    a = regions.select(*by, F.lit(0).alias("side"), F.col(ident).alias("ident"), *SIDES)
    b = strokes.select(*by, F.lit(1).alias("side"), F.lit(0).cast("long").alias("ident"), *SIDES)

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        out, s = [], g[g.side == 1][SIDES].to_numpy(float)
        for row in g[g.side == 0].sort_values("ident").itertuples():
            r = np.array([row.x0, row.y0, row.x1, row.y1])
            limit = most * max(0.0, r[2] - r[0]) * max(0.0, r[3] - r[1])
            while len(s):
                touch = (s[:, 0] <= r[2] + reach) & (s[:, 2] >= r[0] - reach) & (s[:, 1] <= r[3] + reach) & (s[:, 3] >= r[1] - reach)
                new = np.concatenate([np.minimum(r[:2], s[touch, :2].min(axis=0, initial=np.inf)), np.maximum(r[2:], s[touch, 2:].max(axis=0, initial=-np.inf))])
                if (new == r).all() or (new[2] - new[0]) * (new[3] - new[1]) > limit:
                    break
                r = new
            out.append((row.ident, *r))
        return pd.DataFrame(out, columns=["ident", *SIDES])

    return _grouped(a.unionByName(b), by, ["side", "ident", *SIDES], fn, "ident long, x0 double, y0 double, x1 double, y1 double").withColumnRenamed("ident", ident)
