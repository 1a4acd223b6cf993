"""Summaries of a corpus, of what was extracted from it and of detections; which legends are items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of blocks whose rows are read; others are kept for their abbreviations.
PARSEABLE = ["schedule", "type_legend"]


def _count(condition: Column, name: str) -> Column:
    """How many rows hold; null does not."""
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def corpus_summary(files: DataFrame) -> DataFrame:
    """files: file, pages, health, rotated. Files, pages and rotated files of each health, and of all (total is 1)."""
    sets = files.groupingSets([[F.col("health")], []], F.col("health"))
    return sets.agg(F.count("*").alias("files"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), _count(F.col("rotated"), "rotated"), F.grouping("health").cast("int").alias("total"))


def planset_counts(plansets: DataFrame, sheets: DataFrame, blocks: DataFrame, items: DataFrame) -> DataFrame:
    """Sheets, blocks, items and items to review of each planset, also of those with none.

    All take planset, items also needs_review. The rows meet in one aggregate, which
    combines before its one shuffle.
    """
    names = ["schedule_sheets", "blocks", "items", "needs_review"]

    def told(df: DataFrame, **ones: Column) -> DataFrame:
        return df.select("planset", *(ones.get(n, F.lit(0)).cast("long").alias(n) for n in names))

    review = F.coalesce(F.col("needs_review").cast("boolean"), F.lit(False))
    rows = told(plansets).unionByName(told(sheets, schedule_sheets=F.lit(1))).unionByName(told(blocks, blocks=F.lit(1)))
    rows = rows.unionByName(told(items, items=F.lit(1), needs_review=review))
    return rows.groupBy("planset").agg(*(F.sum(n).alias(n) for n in names))


def extract_report(counts: DataFrame) -> DataFrame:
    """One row over planset_counts(): plansets, those with items, items, items to review and their share (null without items)."""
    total, review = F.coalesce(F.sum("items"), F.lit(0)), F.coalesce(F.sum("needs_review"), F.lit(0))
    share = F.when(total > 0, review / total)
    return counts.agg(F.count("*").alias("plansets"), _count(F.col("items") > 0, "with_items"), total.alias("items"), review.alias("needs_review"), share.alias("review_share"))


def detection_summary(openings: DataFrame, sheet: str = "page") -> DataFrame:
    """openings: a sheet, in_block, source. Openings in and outside of blocks and by source, of each sheet and of all (total is 1)."""
    sets = openings.groupingSets([[F.col(sheet)], []], F.col(sheet))
    inside = F.col("in_block")
    return sets.agg(F.count("*").alias("openings"), _count(inside, "in_block"), _count(~F.coalesce(inside, F.lit(False)), "outside"), _count(F.col("source") == "sheet", "by_sheet"), _count(F.col("source") == "block", "by_block"), F.grouping(sheet).cast("int").alias("total"))


def parseable(blocks: DataFrame) -> DataFrame:
    """Blocks whose rows are read as items or vocabulary."""
    return blocks.where(F.col("kind").isin(PARSEABLE))


def legends_as_items(blocks: DataFrame, sheet: str = "page") -> DataFrame:
    """Legend blocks that are themselves the list of types: those of a category for which their sheet has no tabular schedule."""
    scheduled = blocks.where((F.col("kind") == "schedule") & (F.col("genre") == "tabular")).select(sheet, "category").distinct()
    return parseable(blocks).where("kind = 'type_legend'").join(scheduled, [sheet, "category"], "left_anti")
