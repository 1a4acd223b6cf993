"""Streaming: uploads as a file stream, annotation writes with optimistic concurrency."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTCOMES = "sheet_key string, base_rev long, rev long, accepted boolean, op string"


def uploads(spark: SparkSession, landing: str, pattern: str = "*.pdf", per_trigger: int = 100) -> DataFrame:
    """(id, path, sha256, size_bytes) of files that arrive; what doesn't begin like a PDF is left out."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger).load(landing)
    good = raw.where(F.substring("content", 1, 4) == F.lit(b"%PDF"))
    return good.select(F.substring(F.sha2("content", 256), 1, 8).alias("id"), "path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def _write(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rev = state.get[0] if state.exists else 0
    out = []
    for batch in batches:
        for r in batch.sort_values("seq").itertuples():
            base = None if pd.isna(r.base_rev) else int(r.base_rev)
            ok = base is None or base >= rev
            rev += ok
            out.append((key[0], base, rev, bool(ok), r.op))
    state.update((rev,))
    frame = pd.DataFrame(out, columns=["sheet_key", "base_rev", "rev", "accepted", "op"])
    frame["base_rev"] = frame["base_rev"].astype("Int64")
    yield frame


def write_outcomes(writes: DataFrame) -> DataFrame:
    """A row for each write (sheet_key, seq, base_rev, op) of a stream: accepted with its new revision, or a conflict with the standing one.

    The state is a sheet's last revision; it has no end, so there is no watermark.
    """
    return writes.groupBy("sheet_key").applyInPandasWithState(_write, OUTCOMES, "rev long", "append", GroupStateTimeout.NoTimeout)


def run_stages(stream: DataFrame, stage: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Each micro-batch through the batch stages, from where the checkpoint stands."""
    writer = stream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
