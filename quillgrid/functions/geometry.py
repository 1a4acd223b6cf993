"""Rectangle geometry as Column functions (display points, y downwards)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rect(NamedTuple):
    """Four double columns."""

    x0: Column
    y0: Column
    x1: Column
    y1: Column

    @classmethod
    def of(cls, prefix: str = "") -> Rect:
        return cls(*(F.col(f"{prefix}{c}") for c in cls._fields))

    def named(self, prefix: str = "") -> list[Column]:
        return [c.alias(f"{prefix}{n}") for n, c in zip(self._fields, self, strict=True)]

    @property
    def width(self) -> Column:
        return self.x1 - self.x0

    @property
    def height(self) -> Column:
        return self.y1 - self.y0

    @property
    def cx(self) -> Column:
        return (self.x0 + self.x1) / 2

    @property
    def cy(self) -> Column:
        return (self.y0 + self.y1) / 2


def rotate(r: Rect, a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> Rect:
    """The rectangle under the affine (a b c d e f), corners put in order again."""
    xs = [a * x + c * y + e for x, y in ((r.x0, r.y0), (r.x1, r.y1))]
    ys = [b * x + d * y + f for x, y in ((r.x0, r.y0), (r.x1, r.y1))]
    return Rect(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))


def rotate_back(r: Rect, a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> Rect:
    """The inverse of rotate."""
    det = a * d - b * c
    return rotate(r, d / det, -b / det, -c / det, a / det, (c * f - d * e) / det, (b * e - a * f) / det)


def union_agg(r: Rect) -> list[Column]:
    """Aggregates for the box around all rectangles; null over none."""
    return [F.min(r.x0).alias("x0"), F.min(r.y0).alias("y0"), F.max(r.x1).alias("x1"), F.max(r.y1).alias("y1")]


def band_below(r: Rect, width: float, height: float, pad_left: float = 40.0, pad_top: float = 5.0) -> Rect:
    """The probe band under a title."""
    return Rect(r.x0 - pad_left, r.y1 - pad_top, r.x0 - pad_left + width, r.y1 - pad_top + height)


def area(r: Rect) -> Column:
    return F.greatest(F.lit(0.0), r.width) * F.greatest(F.lit(0.0), r.height)


def intersection(r: Rect, s: Rect) -> Column:
    w = F.least(r.x1, s.x1) - F.greatest(r.x0, s.x0)
    h = F.least(r.y1, s.y1) - F.greatest(r.y0, s.y0)
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def iou(r: Rect, s: Rect) -> Column:
    """Intersection over union; 0 where the union is not positive."""
    both = intersection(r, s)
    whole = area(r) + area(s) - both
    return F.when(whole > 0, both / whole).otherwise(0.0)


def containment(box: Rect, other: Rect) -> Column:
    """The share of box that lies in other."""
    return intersection(box, other) / F.greatest(area(box), F.lit(1e-9))


def contains(outer: Rect, inner: Rect) -> Column:
    return (outer.x0 <= inner.x0) & (outer.y0 <= inner.y0) & (outer.x1 >= inner.x1) & (outer.y1 >= inner.y1)


def intersects(r: Rect, s: Rect) -> Column:
    """Open overlap: touching edges don't count."""
    return (r.x0 < s.x1) & (s.x0 < r.x1) & (r.y0 < s.y1) & (s.y0 < r.y1)


def scaled(r: Rect, zoom: float, digits: int = 1) -> Rect:
    return Rect(*(F.round(c * zoom, digits) for c in r))


def grown(r: Rect, share: float = 0.07) -> Rect:
    """Each edge moved out by a share of its side."""
    w, h = r.width * share, r.height * share
    return Rect(r.x0 - w, r.y0 - h, r.x1 + w, r.y1 + h)


def clipped(r: Rect, to: Rect) -> Rect:
    return Rect(F.greatest(r.x0, to.x0), F.greatest(r.y0, to.y0), F.least(r.x1, to.x1), F.least(r.y1, to.y1))


def to_crop(r: Rect, crop: Rect, retained: float = 0.6) -> Column:
    """struct(cx, cy, w, h) of a box within a crop, 0 to 1; null for a flat crop, no overlap, or too little of the box."""
    c = clipped(r, crop)
    ok = (crop.width > 0) & (crop.height > 0) & (c.x1 > c.x0) & (c.y1 > c.y0) & (area(r) > 0) & (intersection(r, crop) >= retained * area(r))
    w, h = F.nullif(crop.width, F.lit(0.0)), F.nullif(crop.height, F.lit(0.0))
    return F.when(ok, F.struct(((c.cx - crop.x0) / w).alias("cx"), ((c.cy - crop.y0) / h).alias("cy"), (c.width / w).alias("w"), (c.height / h).alias("h")))


def to_page(r: Rect, width: Column, height: Column, least: float = 1.0) -> Column:
    """struct(cx, cy, w, h) of a rectangle clipped to its page; null where a clipped side is under a point."""
    zero = F.lit(0.0)
    c = clipped(r, Rect(zero, zero, width, height))
    return F.when((c.width >= least) & (c.height >= least), F.struct((c.cx / width).alias("cx"), (c.cy / height).alias("cy"), (c.width / width).alias("w"), (c.height / height).alias("h")))


def from_unit(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Rect:
    """Pixel corners of a centre-and-size box in 0 to 1."""
    return Rect((cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height)


def render_zoom(width: Column, height: Column, long_side: float = 1600.0) -> Column:
    return F.lit(long_side) / F.greatest(width, height)


def attention_flags(r: Rect, conf: Column, tiny: float = 13.0, low: float = 0.35, narrow: float = 0.15, wide: float = 6.0) -> Column:
    """array of tiny, low_conf, extreme_aspect, as far as they hold."""
    aspect = r.width / F.nullif(r.height, F.lit(0.0))
    return F.array_compact(
        F.array(
            F.when(F.least(r.width, r.height) < tiny, "tiny"),
            F.when((conf > 0) & (conf < low), "low_conf"),
            F.when((aspect < narrow) | (aspect > wide), "extreme_aspect"),
        )
    )
