"""Order-dependent greedy operators, a page at a time in grouped pandas.

Their order is total: confidence or overlap, then the identifiers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions import geometry as G
from quillgrid.functions.geometry import Rect

SIDES = ["x0", "y0", "x1", "y1"]


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of every rectangle in a with every one in b."""
    w = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
    h = np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])
    both = np.maximum(w, 0) * np.maximum(h, 0)
    size = lambda r: np.maximum(r[:, 2] - r[:, 0], 0) * np.maximum(r[:, 3] - r[:, 1], 0)
    whole = size(a)[:, None] + size(b)[None, :] - both
    return np.divide(both, whole, out=np.zeros_like(both), where=whole > 0)


def _grouped(df: DataFrame, by: list[str], cols: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    keys = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = fn(group.reset_index(drop=True))
        for i, k in enumerate(by):
            out.insert(i, k, group[k].iloc[0])
        return out

    return df.select(*by, *(c for c in cols if c not in by)).groupBy(*by).applyInPandas(run, f"{keys}, {schema}")


def suppress(boxes: DataFrame, by: list[str], ident: str, limit: float = 0.55) -> DataFrame:
    """(by, ident) of the boxes that greedy suppression keeps: by falling confidence, dropped at limit overlap with a kept one."""

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["conf", ident], ascending=[False, True])
        r = g[SIDES].to_numpy(float)
        kept: list[int] = []
        for i in range(len(r)):
            if not kept or iou_matrix(r[i : i + 1], r[kept]).max() < limit:
                kept.append(i)
        return pd.DataFrame({ident: g[ident].to_numpy()[kept]})

    return _grouped(boxes, by, [ident, "conf", *SIDES], fn, f"`{ident}` long")


def drop_nested(boxes: DataFrame, by: list[str], ident: str, share: float = 0.85) -> DataFrame:
    """Boxes that no strictly larger box of their group holds by share; an anti-join."""
    big = boxes.select(*by, *Rect.of().named("o_"), F.col(ident).alias("o_id"))
    o = Rect.of("o_")
    hit = [boxes[k] == big[k] for k in by]
    cond = hit[0]
    for h in hit[1:]:
        cond = cond & h
    cond = cond & (big["o_id"] != boxes[ident]) & (G.area(o) > G.area(Rect.of())) & (G.containment(Rect.of(), o) >= share)
    return boxes.join(big, cond, "left_anti")


def match_truths(preds: DataFrame, truths: DataFrame, by: list[str], limit: float = 0.5, agnostic: bool = True) -> DataFrame:
    """(by, pred_id, conf, truth_id, hit): predictions by falling confidence take the best free truth; a hit from limit overlap up."""
    p = preds.select(*by, F.lit(0).alias("side"), F.col("pred_id").alias("ident"), "cls", "conf", *SIDES)
    t = truths.select(*by, F.lit(1).alias("side"), F.col("truth_id").alias("ident"), "cls", F.lit(0.0).alias("conf"), *SIDES)

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        p = g[g.side == 0].sort_values(["conf", "ident"], ascending=[False, True])
        t = g[g.side == 1].sort_values("ident")
        over = iou_matrix(p[SIDES].to_numpy(float), t[SIDES].to_numpy(float))
        if not agnostic:
            over = np.where(p.cls.to_numpy()[:, None] == t.cls.to_numpy()[None, :], over, 0.0)
        ids, found = t.ident.to_numpy(), []
        for row in over:
            j = int(row.argmax()) if len(row) else -1
            hit = j >= 0 and row[j] >= limit
            found.append(int(ids[j]) if hit else None)
            if hit:
                over[:, j] = -1.0
        return pd.DataFrame({"pred_id": p.ident.to_numpy(), "conf": p.conf.to_numpy(), "truth_id": pd.array(found, "Int64"), "hit": [x is not None for x in found]})

    return _grouped(p.unionByName(t), by, ["side", "ident", "cls", "conf", *SIDES], fn, "pred_id long, conf double, truth_id long, hit boolean")


def match_pairs(old: DataFrame, new: DataFrame, by: list[str], limit: float = 0.5) -> DataFrame:
    """(by, old_id, new_id, overlap): one-to-one by falling overlap; between equals the larger old, then new id."""
    o = old.select(*by, F.lit(0).alias("side"), F.col("old_id").alias("ident"), *SIDES)
    n = new.select(*by, F.lit(1).alias("side"), F.col("new_id").alias("ident"), *SIDES)

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        o, n = g[g.side == 0], g[g.side == 1]
        over = iou_matrix(o[SIDES].to_numpy(float), n[SIDES].to_numpy(float))
        i, j = np.nonzero(over >= limit)
        a, b, v = o.ident.to_numpy()[i], n.ident.to_numpy()[j], over[i, j]
        used_a, used_b, out = set(), set(), []
        for k in np.lexsort((-b, -a, -v)):
            if a[k] not in used_a and b[k] not in used_b:
                used_a.add(a[k])
                used_b.add(b[k])
                out.append((a[k], b[k], v[k]))
        return pd.DataFrame(out, columns=["old_id", "new_id", "overlap"])

    return _grouped(o.unionByName(n), by, ["side", "ident", *SIDES], fn, "old_id long, new_id long, overlap double")


def resolve_overlaps(blocks: DataFrame, by: list[str], ident: str) -> DataFrame:
    """Blocks (ord, rectangle, title rectangle t_) cut so that no two overlap, pair by pair in order.

    A pair is split midway between its titles' centres on the axis on which these
    lie farther apart, never above the upper title's lower edge and a point.
    """

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(ident).reset_index(drop=True)
        r, t = g[SIDES].to_numpy(float), g[[f"t_{c}" for c in SIDES]].to_numpy(float)
        cx, cy = (t[:, 0] + t[:, 2]) / 2, (t[:, 1] + t[:, 3]) / 2
        for i in range(len(r)):
            for j in range(i + 1, len(r)):
                if min(r[i, 2], r[j, 2]) <= max(r[i, 0], r[j, 0]) or min(r[i, 3], r[j, 3]) <= max(r[i, 1], r[j, 1]):
                    continue
                if abs(cx[i] - cx[j]) >= abs(cy[i] - cy[j]):
                    a, b = (i, j) if cx[i] <= cx[j] else (j, i)
                    at = (cx[a] + cx[b]) / 2
                    r[a, 2], r[b, 0] = min(r[a, 2], at), max(r[b, 0], at)
                else:
                    a, b = (i, j) if cy[i] <= cy[j] else (j, i)
                    at = max((cy[a] + cy[b]) / 2, t[a, 3] + 1)
                    r[a, 3], r[b, 1] = min(r[a, 3], at), max(r[b, 1], at)
        out = pd.DataFrame(r, columns=SIDES)
        out.insert(0, ident, g[ident])
        return out

    return _grouped(blocks, by, [ident, *SIDES, *(f"t_{c}" for c in SIDES)], fn, f"`{ident}` long, x0 double, y0 double, x1 double, y1 double")
