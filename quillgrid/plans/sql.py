"""Reaching the engine from spark.sql: temporary SQL functions and views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillgrid.plans.fixtures import TABLES, table

RECT = "struct<x0:double,y0:double,x1:double,y1:double>"
#: SQL functions, in an order in which each uses only those before it.
FUNCTIONS = {
    f"rect_area(r {RECT})": "greatest(0.0D, r.x1 - r.x0) * greatest(0.0D, r.y1 - r.y0)",
    f"rect_intersection(r {RECT}, s {RECT})": "greatest(0.0D, least(r.x1, s.x1) - greatest(r.x0, s.x0)) * greatest(0.0D, least(r.y1, s.y1) - greatest(r.y0, s.y0))",
    f"rect_iou(r {RECT}, s {RECT})": "coalesce(rect_intersection(r, s) / nullif(greatest(0.0D, rect_area(r) + rect_area(s) - rect_intersection(r, s)), 0.0D), 0.0D)",
    f"rect_containment(r {RECT}, s {RECT})": "rect_intersection(r, s) / greatest(rect_area(r), 1e-9D)",
}


def register(spark: SparkSession, sf_dir: str | None = None) -> None:
    """Create the functions in the session; with a folder, also the layout tables as views."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {head} returns double return {body}")
    spark.sql("create or replace temporary function is_val(k string) returns boolean return cast(conv(substring(sha2(k, 256), 1, 2), 16, 10) as int) % 5 = 4")
    if sf_dir is not None:
        for name in TABLES:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
