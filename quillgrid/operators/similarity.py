"""Exact set-similarity joins and keep-first de-duplication."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def word_sets(df: DataFrame, ident: str, text: str, pattern: str = "[^A-Z0-9]+", least: int = 3) -> DataFrame:
    """(ident, tokens): distinct upper-case tokens of least characters and more, sorted."""
    words = F.filter(F.split(F.upper(F.col(text)), pattern), lambda w: F.length(w) >= least)
    return df.select(F.col(ident), F.array_sort(F.array_distinct(words)).alias("tokens"))


def jaccard_pairs(sets: DataFrame, ident: str, threshold: float = 0.95) -> DataFrame:
    """(a, b, jaccard), a < b, of all pairs of likeness threshold and more; empty sets pair with nothing.

    Equal sets are joined once. The others meet on the rarest tokens only: of n
    tokens, two sets so alike share one of the n - ceil(threshold n) + 1 rarest;
    lengths prune before the comparison.
    """
    full = sets.where(F.size("tokens") > 0).withColumn("key", F.xxhash64("tokens"))
    one = full.groupBy("key").agg(F.first("tokens").alias("tokens")).withColumn("n", F.size("tokens"))
    words = one.select("key", "n", F.explode("tokens").alias("token"))
    rare = words.groupBy("token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("key").orderBy("df", "token")
    prefix = words.join(rare, "token").withColumn("k", F.row_number().over(order)).where(F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1).select("key", "n", "token")
    left, right = prefix.select("token", F.col("key").alias("ka"), F.col("n").alias("na")), prefix.select("token", F.col("key").alias("kb"), F.col("n").alias("nb"))
    met = left.join(right, "token").where((F.col("ka") < F.col("kb")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb"))).select("ka", "kb").distinct()
    ta, tb = one.select(F.col("key").alias("ka"), F.col("tokens").alias("ta")), one.select(F.col("key").alias("kb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    like = met.join(ta, "ka").join(tb, "kb").withColumn("jaccard", both / (F.size("ta") + F.size("tb") - both)).where(F.col("jaccard") >= threshold)
    keys = full.select(F.col(ident).alias("id"), "key")
    ends = like.select("ka", "kb", "jaccard").unionByName(one.select(F.col("key").alias("ka"), F.col("key").alias("kb"), F.lit(1.0).alias("jaccard")))
    a, b = keys.select(F.col("id").alias("ia"), F.col("key").alias("ka")), keys.select(F.col("id").alias("ib"), F.col("key").alias("kb"))
    same = F.col("ka") == F.col("kb")
    out = ends.join(a, "ka").join(b, "kb").where(~same | (F.col("ia") < F.col("ib")))
    return out.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "jaccard")


def keep_first(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """(kept, dropped): in order of id, one is dropped that pairs with a kept one, the first such.

    comps: (node, root) of the pairs' components; each is folded in one task.
    """

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, list[int]] = {}
        for a, b in zip(g.a, g.b, strict=True):
            near.setdefault(b, []).append(a)
            near.setdefault(a, [])
        kept, out = set(), []
        for i in sorted(near):
            first = min((x for x in near[i] if x in kept), default=None)
            if first is None:
                kept.add(i)
            else:
                out.append((first, i))
        return pd.DataFrame(out, columns=["kept", "dropped"])

    return pairs.join(comps.select(F.col("node").alias("a"), "root"), "a").groupBy("root").applyInPandas(fn, "kept long, dropped long")


def components(pairs: DataFrame, rounds: int = 30) -> DataFrame:
    """(node, root): the least id reachable, by rounds of least neighbours and pointer jumps.

    Each round is cut off by checkpoint(), in the folder that the cluster names.
    """
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    label = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node")
    for _ in range(rounds):
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        new = label.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("root", "near").alias("root"))
        jump = new.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = new.join(jump, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("root").alias("was")).checkpoint()
        changed = new.join(label.withColumnRenamed("root", "old"), "node").where("root != old").limit(1).count()
        label = new.select("node", "root")
        if not changed:
            return label
    raise RuntimeError("components did not settle")


def duplicate_groups(pairs: DataFrame, sheets: DataFrame, comps: DataFrame) -> DataFrame:
    """(first, members, n, across): stars around the first free member of each group, the largest first.

    sheets: (node, project); across tells whether a group spans projects.
    """

    def fn(g: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, set[int]] = {}
        for a, b in zip(g.a, g.b, strict=True):
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
        used, out = set(), []
        for i in sorted(near):
            star = [j for j in sorted(near[i]) if j > i and j not in used]
            if i not in used and star:
                used.update([i, *star])
                out += [(i, j) for j in [i, *star]]
        return pd.DataFrame(out, columns=["first", "node"])

    stars = pairs.join(comps.select(F.col("node").alias("a"), "root"), "a").groupBy("root").applyInPandas(fn, "first long, node long")
    grouped = stars.join(sheets, "node").groupBy("first").agg(F.sort_array(F.collect_list("node")).alias("members"), F.count("*").alias("n"), (F.count_distinct("project") > 1).alias("across"))
    return grouped.orderBy(F.desc("n"), "first")
