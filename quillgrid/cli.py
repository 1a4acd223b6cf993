"""Command line: each stage over folders of Parquet layout tables.

    python -m quillgrid.cli locate --tables in --out out
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.operators import registry
from quillgrid.plans import stages
from quillgrid.sources import readers, sinks

Tables = Callable[[str], DataFrame]


def manifest(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    return {"manifest": readers.triage(t("pages"))}


def locate(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    pages = t("pages").join(t("manifest").select("file", "health"), "file", "left")
    found, titles = stages.locate(t("lines"), pages, readers.titleblock_edge(t("segments"), t("pages")), readers.outline(t("toc")), t("words"))
    return {"candidates": found, "titles": titles.withColumn("title_id", F.xxhash64("file", "page", "ord", "title"))}


def segment(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    edges = readers.titleblock_edge(t("segments"), t("pages"))
    return {"blocks": stages.genre(t("words"), stages.segment(t("words"), t("titles"), t("pages"), edges))}


def extract(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    blocks = t("blocks")
    tabular = stages.unruled_rows(t("words"), blocks.where("genre = 'tabular'"))
    return {"items": stages.items_of_rows(tabular, blocks, t("legends"))}


def detect(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    return {"openings": stages.detections([t("detections")], "sheet_key", "box_id")}


def annotate(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    fresh = registry.to_seed(t("sheets"), t("known"), t("tombstones"), force=a.force)
    boxes = t("openings").join(fresh.select("sheet_key"), "sheet_key", "left_semi")
    return {"seeded": registry.triage(boxes, t("areas"), "sheet_key", "box_id")}


def annotate_merge(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    return {"merged": stages.merge_sheets(t("stored"), t("fresh"), t("areas"), "sheet_key", t("reviewed"))}


def export_dataset(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    examples, boxes = stages.dataset(t("openings"), t("areas"))
    return {"examples": examples, "boxes": boxes}


def export_regions(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    boxes, reasons = stages.regions(t("areas"), t("sheets"))
    return {"regions": boxes, "reasons": reasons}


def coverage(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    from quillgrid.operators.spatial import coverage_buckets

    got = coverage_buckets(t("openings"), t("regions"), "sheet_key", "box_id")
    return {"coverage": got.groupBy("bucket").agg(F.count("*").alias("n"))}


def evaluate(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    preds = t("predictions")
    if a.merge:
        preds = stages.graph.merge_boxes(preds, ["image"], "pred_id").withColumnRenamed("comp", "pred_id")
    return {"evaluation": stages.evaluate(preds, t("truths"), ["image"])}


def viewer(t: Tables, a: argparse.Namespace) -> dict[str, DataFrame]:
    return {"index": stages.viewer_index(t("sheets"), t("blocks"), t("openings"))}


COMMANDS = {f.__name__.replace("_", "-"): f for f in (manifest, locate, segment, extract, detect, annotate, annotate_merge, export_dataset, export_regions, coverage, evaluate, viewer)}
ALL = ["manifest", "locate", "segment", "extract"]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillgrid", description=__doc__)
    parser.add_argument("command", choices=[*COMMANDS, "all", "one"])
    parser.add_argument("--tables", required=True, help="folder of the input tables")
    parser.add_argument("--out", required=True, help="folder of the results, which later commands also read")
    parser.add_argument("--file", help="only this file's pages")
    parser.add_argument("--page", type=int, help="only this page")
    parser.add_argument("--force", action="store_true", help="seed anew what is annotated or deleted")
    parser.add_argument("--merge", action="store_true", help="merge overlapping predictions before evaluating")
    parser.add_argument("--csv", action="store_true", help="also write the results as CSV")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()

    def read(name: str) -> DataFrame:
        last = None
        for folder in (a.out, a.tables):
            try:
                df = spark.read.parquet(f"{folder}/{name}")
                break
            except Exception as e:  # the table is in the other folder
                last = e
        else:
            raise last
        if a.file and "file" in df.columns:
            df = df.where(F.col("file") == a.file)
        return df.where(F.col("page") == a.page) if a.page is not None and "page" in df.columns else df

    for name in ALL if a.command in ("all", "one") else [a.command]:
        for out, df in COMMANDS[name](read, a).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{out}")
            if a.csv:
                sinks.write_takeoff(df, f"{a.out}/{out}.csv")


if __name__ == "__main__":
    main()
