"""Writers of results: takeoff CSV, detector label files, COCO rows, JSON per planset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions import text as T
from quillgrid.functions import vocabulary as V


def running_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with 1, 2, 3 ... in order, nulls last, without gathering the rows in one task: ranges are sorted, their sizes give each its start.

    Spark cuts ranges anew, by another sample, for each use of a plan; the checkpoint has sizes and rows see one cut.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    first = ranged.groupBy("__part").agg(F.count("*").alias("n"), F.min("__at").alias("low"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = first.select("__part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return ranged.join(F.broadcast(starts), "__part").withColumn(name, F.col("base") + F.col("__at") - F.col("low") + 1).drop("__part", "__at", "low", "base")


def coco_annotations(boxes: DataFrame) -> DataFrame:
    """One row per box: 1-based ids, category = class + 1, top-left corner and size."""
    cls = T.looked_up(F.col("cls"), V.CLASS_INDEX) + 1
    numbered = running_number(boxes.select("page", "box_id", "cls", "x0", "y0", "x1", "y1"), ["page", "box_id"], "id")
    return numbered.select("id", F.col("page").alias("image_id"), cls.alias("category_id"), F.col("x0").alias("bx"), F.col("y0").alias("by_"), (F.col("x1") - F.col("x0")).alias("bw"), (F.col("y1") - F.col("y0")).alias("bh"))


def write_coco(boxes: DataFrame, images: DataFrame, path: str) -> None:
    """JSON lines of images and annotations, a folder each."""
    images.write.mode("overwrite").json(f"{path}/images")
    coco_annotations(boxes).select("id", "image_id", "category_id", F.array("bx", "by_", "bw", "bh").alias("bbox")).write.mode("overwrite").json(f"{path}/annotations")


def write_labels(boxes: DataFrame, path: str) -> None:
    """Label lines (class and unit box, six digits), a folder for each image."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "cls", "cx", "cy", "w", "h")
    boxes.select("image", line.alias("value")).write.mode("overwrite").partitionBy("image").text(path)


def write_takeoff(rows: DataFrame, path: str) -> None:
    """CSV with a header: arrays joined by a pipe, null as empty, booleans as 0 and 1."""
    cols = []
    for name, kind in rows.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), "|")
        elif kind == "boolean":
            c = c.cast("int")
        cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
    rows.select(*cols).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_plansets(rows: DataFrame, path: str, key: str = "planset_key") -> None:
    """JSON, a folder for each planset."""
    rows.write.mode("overwrite").partitionBy(key).json(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
