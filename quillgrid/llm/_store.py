"""Shared-folder tables, worker set-up and key helpers for the llm operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch. Texts can be long, so batches stay small.
BATCH_ROWS = 256
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows without a doc_id are ordered after all others.
NO_ID = 2**63 - 1
#: Bits of the filter of wanted texts, which is broadcast (1 MB): what it lets through is joined exactly.
FILTER_BITS = 1 << 23

_written: list[tuple[SparkSession, str]] = []


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound the Arrow batches."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def rest() -> None:
    """At the end of a task in a Python worker, which Spark uses again: give freed memory back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def resting(run):
    """run, a step over Arrow batches, with rest() behind the last one."""

    def whole(batches):
        yield from run(batches)
        rest()

    return whole


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where the setting is absent (tests in local mode), a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.mkdtemp(prefix="quillgrid-")
    return shared_dir.own


def _drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def drop_written() -> None:
    """Delete the intermediate tables of sessions that are still up."""
    while _written:
        spark, path = _written.pop()
        try:
            _drop(spark, path)
        except Exception:  # the session has ended before
            continue


def keep(df: DataFrame, name: str, rows: int = BATCH_ROWS) -> DataFrame:
    """Write df to the shared folder and read it back; its Python steps get so many rows in an Arrow batch.

    This cuts the lineage: what follows survives the loss of any executor. The
    shuffle files behind it are then of no use; a collection lets Spark's cleaner
    delete them at once rather than when the driver's heap happens to be full.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillgrid-{name}-{uuid.uuid4().hex}"
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    _written.append((spark, path))
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete tables made by keep() that nothing reads any more."""
    paths = {p.split("/part-")[0] for df in frames for p in df.inputFiles()}
    names = {p.rsplit("/", 1)[-1] for p in paths}
    for item in [x for x in _written if x[1].rsplit("/", 1)[-1] in names]:
        _written.remove(item)
        _drop(*item)


def forget_since(before: int, *stay: DataFrame) -> None:
    """Delete all tables made by keep() after the first so many, but for those that stay."""
    names = {p.split("/part-")[0].rsplit("/", 1)[-1] for df in stay for p in df.inputFiles()}
    for item in [x for x in _written[before:] if x[1].rsplit("/", 1)[-1] not in names]:
        _written.remove(item)
        _drop(*item)


def written() -> int:
    """How many tables made by keep() there are."""
    return len(_written)


def text_of(name: str = "text") -> Column:
    """The text column; null is the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def text_keys(name: str = "text") -> dict[str, Column]:
    """t1 and t2, hashes of the text from two seeds: they tell texts apart."""
    return {"t1": F.xxhash64(text_of(name)), "t2": F.xxhash64(F.lit(1), text_of(name))}


def marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """rows with may: whether their t1 may be among wanted's, by a bit for each in bitmaps of a fixed size.

    It is true for all that are wanted, and for the more others the more are
    wanted; only these need a shuffle of their texts.
    """
    number = F.pmod("t1", F.lit(FILTER_BITS)) + 1
    bucket, place = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    bits = wanted.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))  # FILTER_BITS / 32768 rows of 4 KB at most
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("bucket", bucket).withColumn("place", place).join(F.broadcast(bits), "bucket", "left")
    may = byte.bitwiseAND(F.pow(F.lit(2), F.col("place") % 8).cast("int")) != 0
    return found.select(*rows.columns, F.coalesce(may, F.lit(False)).alias("may"))


def id_of(name: str = "doc_id") -> Column:
    return F.col(f"`{name}`").cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_first(docs: DataFrame) -> DataFrame:
    """docs (id, t1, t2, a table) with first, the least id of each text.

    Only texts that are repeated are joined, by a join of two plain shuffles,
    which Spark can split where one text is very many rows.
    """
    copies = docs.groupBy("t1", "t2").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = docs.join(keep(copies, "copies"), ["t1", "t2"], "left")
    return out.withColumn("first", F.coalesce("first", "id"))
