"""Sort-and-scan operators as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sessions(df: DataFrame, by: list[str], value: str, gap: Column | float, order: list[str] | None = None, name: str = "session", end: str | None = None) -> DataFrame:
    """df with a session number from 0 within each by-group: a new one where the step from before is over gap.

    end: a column whose running maximum is what the step is measured from.
    """
    w = Window.partitionBy(*by).orderBy(value, *(order or []))
    before = F.lag(value).over(w) if end is None else F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    step = F.when(F.col(value) - before > gap, 1).otherwise(0)
    return df.withColumn("__new", step).withColumn(name, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def gutters(words: DataFrame, by: list[str], least: float = 4.0) -> DataFrame:
    """(by, g0, g1, middle): inner x-runs of least width that no word covers."""
    w = Window.partitionBy(*by).orderBy("x0", "x1").rowsBetween(Window.unboundedPreceding, -1)
    g0 = F.max("x1").over(w)
    return words.select(*by, g0.alias("g0"), F.col("x0").alias("g1")).where(F.col("g1") - F.col("g0") >= least).withColumn("middle", (F.col("g0") + F.col("g1")) / 2)


def forward_fill(df: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """The last value that isn't blank, in order."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last_value(F.nullif(F.col(value), F.lit("")), ignoreNulls=True).over(w))


def header_names(cells: DataFrame, by: list[str]) -> DataFrame:
    """(by, col, name) of header cells (tier, col, text): all tiers but the last are filled forward, unlike neighbours joined by dots."""
    last = F.max("tier").over(Window.partitionBy(*by))
    filled = forward_fill(cells.withColumn("last", last), [*by, "tier"], "col", "text", "fill")
    text = F.when(F.col("tier") == F.col("last"), F.nullif(F.col("text"), F.lit(""))).otherwise(F.col("fill"))
    got = filled.withColumn("__text", text).groupBy(*by, "col").agg(F.array_compact(F.transform(F.array_sort(F.collect_list(F.struct("tier", "__text"))), lambda s: s["__text"])).alias("parts"))
    joined = F.array_join(F.filter("parts", lambda p, i: (i == 0) | (p != F.get("parts", i - 1))), ".")
    return got.select(*by, "col", F.when(joined == "", F.concat(F.lit("col"), F.col("col"))).otherwise(joined).alias("name"))


def bounds(words: DataFrame, by: list[str], gap: float = 7.0) -> DataFrame:
    """(by, cell, lo, hi): header words in cells by gaps over gap; bounds lie midway, the outer ones are open (null)."""
    s = sessions(words, by, "x0", gap, ["x1"], "cell", end="x1")
    cells = s.groupBy(*by, "cell").agg(F.min("x0").alias("c0"), F.max("x1").alias("c1"))
    w = Window.partitionBy(*by).orderBy("cell")
    return cells.select(*by, "cell", ((F.lag("c1").over(w) + F.col("c0")) / 2).alias("lo"), ((F.col("c1") + F.lead("c0").over(w)) / 2).alias("hi"))


def mullion_groups(boxes: DataFrame, by: list[str], ident: str, gap: float = 0.15, tolerance: float = 0.10) -> DataFrame:
    """boxes with group_no: neighbours in x order share one where close, of like height and overlapping in y."""
    w = Window.partitionBy(*by).orderBy("x0", ident)
    p = {c: F.lag(c).over(w) for c in ("x0", "y0", "x1", "y1")}
    step = F.col("x0") - p["x1"]
    h, ph = F.col("y1") - F.col("y0"), p["y1"] - p["y0"]
    near = (step >= 0) & (step <= gap * F.greatest(F.col("x1") - F.col("x0"), p["x1"] - p["x0"]))
    like = F.abs(h - ph) <= tolerance * F.greatest(h, ph)
    over = F.least(F.col("y1"), p["y1"]) > F.greatest(F.col("y0"), p["y0"])
    out = boxes.withColumn("__new", F.when(F.coalesce(near & like & over, F.lit(False)), 0).otherwise(1))
    return out.withColumn("group_no", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def merged_titles(lines: DataFrame, by: list[str], size_tolerance: float = 0.10, gap: float = 1.6) -> DataFrame:
    """From each line: its text and those of the lines after it, up to another block, another size or a wide gap.

    lines: block, ord, text, size, y0, y1. Runs overlap. A run ends with its block's
    lines, so only those of one block on end are looked at together.
    """
    inner = Window.partitionBy(*by).orderBy("ord")
    lines = lines.withColumn("__turn", F.when(F.lag("block").over(inner) == F.col("block"), 0).otherwise(1)).withColumn("__turn", F.sum("__turn").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    w = Window.partitionBy(*by, "__turn").orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    after = F.collect_list(F.struct("block", "text", "size", "y0", "y1")).over(w)
    start = F.struct(F.col("text").alias("text"), F.col("y1").alias("y1"), F.lit(0).alias("lines"), F.lit(False).alias("stop"))

    def step(acc: Column, x: Column) -> Column:
        ok = ~acc["stop"] & (x["block"] == F.col("block")) & (F.abs(x["size"] - F.col("size")) <= size_tolerance * F.col("size")) & (x["y0"] - acc["y1"] <= gap * F.col("size"))
        return F.struct(F.when(ok, F.concat(acc["text"], F.lit(" "), x["text"])).otherwise(acc["text"]).alias("text"), F.when(ok, F.greatest(acc["y1"], x["y1"])).otherwise(acc["y1"]).alias("y1"), (acc["lines"] + ok.cast("int")).alias("lines"), (~ok).alias("stop"))

    return lines.withColumn("run", F.aggregate(after, start, step)).withColumns({"run_text": F.col("run.text"), "run_lines": F.col("run.lines") + 1}).drop("run", "__turn")


def column_bands(anchors: DataFrame, by: list[str], x: str = "x0", share: float = 0.35, same: float = 4.0) -> DataFrame:
    """(by, band, lo, hi): left edges collapsed within same, cut where a step is over share of the median step."""
    one = sessions(anchors.select(*by, x).distinct(), by, x, same, name="edge").groupBy(*by, "edge").agg(F.min(x).alias("x"))
    w = Window.partitionBy(*by).orderBy("x")
    stepped = one.withColumn("step", F.col("x") - F.lag("x").over(w))
    pitch = stepped.groupBy(*by).agg(F.median("step").alias("pitch"))
    cut = stepped.join(pitch, by).withColumn("new", F.when(F.col("step") > share * F.col("pitch"), 1).otherwise(0))
    banded = cut.withColumn("band", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    edges = banded.groupBy(*by, "band").agg(F.min("x").alias("left"), F.max("x").alias("right"))
    v = Window.partitionBy(*by).orderBy("band")
    return edges.select(*by, "band", ((F.lag("right").over(v) + F.col("left")) / 2).alias("lo"), ((F.col("right") + F.lead("left").over(v)) / 2).alias("hi"))


def spec_items(lines: DataFrame, by: list[str], factor: float = 2.5) -> DataFrame:
    """(by, item, spec_no, spec): bulleted lines with the plain lines that go on from them.

    lines: ord, text, depth, y0, y1. An item ends where the gap is over factor
    times the median height; what stands before its first bullet is its title.
    """
    height = lines.groupBy(*by).agg((factor * F.median(F.col("y1") - F.col("y0"))).alias("limit"))
    s = sessions(lines.join(height, by), by, "y0", F.col("limit"), ["ord"], "item", end="y1")
    w = Window.partitionBy(*by, "item").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    numbered = s.withColumn("spec_no", F.sum((F.col("depth") > 0).cast("int")).over(w))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ")
    return numbered.groupBy(*by, "item", "spec_no").agg(text.alias("spec"))


def trimmed_axis(words: DataFrame, by: list[str], lo: str, hi: str, title_at: str, least: float = 150.0, ratio: float | None = 3.0) -> DataFrame:
    """Words of the band that holds the title, where wide gaps cut the axis.

    A gap cuts from least up; with ratio only the widest does, and only from ratio
    times the next on (alone it doesn't).
    """
    w = Window.partitionBy(*by).orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, -1)
    gaps = words.select(*by, title_at, F.max(hi).over(w).alias("g0"), F.col(lo).alias("g1")).where(F.col("g1") > F.col("g0"))
    if ratio is not None:
        rank = Window.partitionBy(*by).orderBy(F.desc(F.col("g1") - F.col("g0")), "g0")
        gaps = gaps.withColumn("__k", F.row_number().over(rank)).withColumn("__next", F.lead(F.col("g1") - F.col("g0")).over(rank)).where("__k = 1").where((F.col("g1") - F.col("g0")) >= ratio * F.col("__next"))
    gaps = gaps.where((F.col("g1") - F.col("g0")) >= least)
    cut = gaps.groupBy(*by).agg(F.max(F.when(F.col("g1") <= F.col(title_at), F.col("g1"))).alias("low"), F.min(F.when(F.col("g0") >= F.col(title_at), F.col("g0"))).alias("high"))
    mid = (F.col(lo) + F.col(hi)) / 2
    return words.join(cut, by, "left").where((F.col("low").isNull() | (mid >= F.col("low"))) & (F.col("high").isNull() | (mid <= F.col("high")))).select(*words.columns)


def average_precision(scored: DataFrame, truths: DataFrame, by: list[str], ident: str) -> DataFrame:
    """(by, n_truth, n_pred, ap): all-point average precision of scored (conf, hit) rows.

    NaN where there is no truth, 0 where nothing is predicted. truths: by, n_truth.
    """
    w = Window.partitionBy(*by).orderBy(F.desc("conf"), ident)
    run = scored.withColumns({"__k": F.row_number().over(w), "tp": F.sum(F.col("hit").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    run = run.join(truths, by).withColumns({"recall": F.col("tp") / F.nullif(F.col("n_truth"), F.lit(0)), "precision": F.col("tp") / F.col("__k")})
    v = Window.partitionBy(*by).orderBy("__k")
    run = run.withColumns({"envelope": F.max("precision").over(v.rowsBetween(0, Window.unboundedFollowing)), "step": F.col("recall") - F.lag("recall", 1, 0.0).over(v)})
    got = run.groupBy(*by).agg(F.count("*").alias("n_pred"), F.sum(F.col("step") * F.col("envelope")).alias("a"))
    return truths.join(got, by, "left").select(*by, "n_truth", F.coalesce("n_pred", F.lit(0)).alias("n_pred"), F.when(F.col("n_truth") == 0, float("nan")).otherwise(F.coalesce("a", F.lit(0.0))).alias("ap"))
