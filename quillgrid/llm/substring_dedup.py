"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

A window is counted only where it may repeat. Each window has an anchor, the
least hash among its shorter runs of words; equal windows have equal anchors, so
a window whose anchor occurs in one text only cannot occur in another. Anchors
are a small part of all windows, and the rest follows for those that are left:
two Rabin-Karp hashes of every window, modulo the prime 2 ** 61 - 1 with
independent bases over independently seeded words, are counted over all
documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store

WINDOW = 50


def _anchors(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, anchor) of each window of width words that lies in one row."""
    if len(row) < width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    short = max(1, width // 2)
    runs = _kernel.mix(_kernel.run_sums(hashes, short))
    least = _kernel.sliding_min(runs, width - short + 1)
    whole = np.flatnonzero(row[: len(row) - width + 1] == row[width - 1 :])
    return whole, least[whole]


def _joined(words: list[bytes], keep: np.ndarray | None = None) -> str:
    kept = words if keep is None else [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def survey(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, t1, t2, n_words, sha256 of the words, anchors) of each row; t1 and t2 hash the text from two seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, sha, lists = [], [], []
            for a, b in _kernel.slices(batch.column(3)):
                part = batch.column(3).slice(a, b - a)
                words = _kernel.words_of(part)
                at, anchor = _anchors(words.hashes(), words.row, width)
                fresh = np.ones(len(at), dtype=bool)
                fresh[1:] = (anchor[1:] != anchor[:-1]) | (words.row[at[1:]] != words.row[at[:-1]])
                at, anchor = words.row[at[fresh]], anchor[fresh]
                cut = np.searchsorted(at, np.arange(b - a + 1))
                lists += [np.unique(anchor[s:e]).view(np.int64) for s, e in zip(cut[:-1], cut[1:], strict=True)]
                count += np.diff(words.first).tolist()
                sha += [_joined(t.encode("utf-8").split()) for t in part.to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            values = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["id", "t1", "t2", "n_words", "sha", "anchors"])

    return _keyed(df, id_col, text_col).mapInArrow(_store.resting(run), "id long, t1 long, t2 long, n_words long, sha string, anchors array<long>")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = _store.text_of(text_col)
    return df.select(F.coalesce(_store.id_of(id_col), F.lit(_store.NO_ID)).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def _window_hashes(joined: DataFrame, width: int) -> DataFrame:
    """(id, t1, t2, text, at, h1, h2): the windows of each text whose anchor is in its wanted list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            texts, wanted = batch.column(3), batch.column(4)
            for a, b in _kernel.slices(texts):
                words = _kernel.words_of(texts.slice(a, b - a))
                hashes = words.hashes()
                at, anchor = _anchors(hashes, words.row, width)
                hit = np.isin(anchor, np.asarray(wanted.slice(a, b - a).flatten()).view(np.uint64))
                at = at[hit]
                one, two = (_kernel.rabin_karp(words.hashes(seed), width, base)[at] if len(at) else np.zeros(0, dtype=np.uint64) for seed, base in zip(_kernel.SEEDS, _kernel.BASES, strict=True))
                cut = np.searchsorted(words.row[at], np.arange(b - a + 1))
                place = at - words.first[words.row[at]]
                lists += [(place[s:e], one[s:e].view(np.int64), two[s:e].view(np.int64)) for s, e in zip(cut[:-1], cut[1:], strict=True)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x[0]) for x in lists])]).astype(np.int32))
            cols = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[i] for x in lists]) if lists else np.zeros(0), kind)) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *cols], ["id", "t1", "t2", "text", "at", "h1", "h2"])

    return joined.mapInArrow(_store.resting(run), "id long, t1 long, t2 long, text string, at array<int>, h1 array<long>, h2 array<long>")


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, at in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = text.encode("utf-8").split()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                start = np.asarray(at.values)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + width, -1)
                keep = np.cumsum(edge[:-1]) == 0
                bounds = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]])))
                kept = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)
                rows.append((len(words), int((~keep).sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8"), bounds.tolist()))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["id", "t1", "t2", "n_words", "n_removed", "sha", "kept", "bounds"])

    return run


def dedup_substrings(df: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of df: id, n_words, n_removed, kept_sha256, spans; with_text adds kept_text.

    A word goes where a window of width words covers it whose words also start
    in a row of smaller id; windows are judged on the input. spans holds the
    maximal removed runs of words as (start, end). kept_text is the remaining
    words joined by one space where words went, else null: the text stays as it is;
    t1 and t2, hashes of the whole text by Spark's xxhash64, then tell repeated ids apart.
    Null and short texts lose nothing; rows of equal id don't affect each other; a
    row without an id comes after all others. Only id and text are read.
    """
    spark = df.sparkSession
    _store.prepare(spark)
    before = _store.written()
    docs = _store.keep(survey(df, id_col, text_col, width), "windows-survey")
    first = _store.keep(_store.with_first(docs.select("id", "t1", "t2", "n_words", "sha")), "windows-first")
    # anchors in two texts at least; of equal texts only the first is looked at
    own = first.where("id = first and n_words >= %d" % width).select("id", "t1", "t2").distinct()
    anchors = docs.where("n_words >= %d" % width).select("id", "t1", "t2", F.explode("anchors").alias("anchor"))
    many = anchors.groupBy("anchor").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).where("lo != hi").select("anchor")
    many = _store.keep(many, "windows-anchors")  # a join of two plain shuffles is one that Spark can split
    wanted = anchors.join(many, "anchor").groupBy("id", "t1", "t2").agg(F.collect_set("anchor").alias("wanted"))
    wanted = _store.keep(wanted.join(own, ["id", "t1", "t2"], "left_semi"), "windows-wanted")
    _store.forget_since(before, first, wanted)
    texts = _store.marked(_keyed(df, id_col, text_col), wanted).where("may")  # texts of others aren't shuffled
    joined = texts.join(wanted.hint("shuffle_hash"), ["id", "t1", "t2"]).select("id", "t1", "t2", "text", "wanted")
    found = _store.keep(_window_hashes(joined, width), "windows-hashes")
    rows = found.select("id", "t1", "t2", F.explode(F.arrays_zip("at", "h1", "h2")).alias("w")).select("id", "t1", "t2", "w.at", "w.h1", "w.h2")
    least = rows.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h1", "h2", "least")
    least = _store.keep(least, "windows-least")
    gone = rows.join(least, ["h1", "h2"]).where("id > least").groupBy("id", "t1", "t2").agg(F.collect_set("at").alias("gone"))
    gone = _store.keep(gone, "windows-gone")
    _store.forget_since(before, first, found, gone)
    key = ["id", "t1", "t2"]
    cut = found.select(*key, "text").join(gone.hint("shuffle_hash"), key).select("id", "text", "gone", "t1", "t2").mapInArrow(_store.resting(_cut(width)), "id long, t1 long, t2 long, n_words long, n_removed long, sha string, kept string, bounds array<long>")
    pairs = F.transform(F.sequence(F.lit(0), F.size("bounds") - 2, F.lit(2)), lambda i: F.struct(F.get("bounds", i).alias("start"), F.get("bounds", i + 1).alias("end")))
    cut = cut.select("id", "n_words", "n_removed", F.col("sha").alias("kept_sha256"), pairs.alias("spans"), *([F.col("kept").alias("kept_text"), "t1", "t2"] if with_text else []))
    whole = F.col("id") > F.col("first")
    whole = whole & (F.col("n_words") >= width)  # a later copy: every window starts in the first one
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    rest = first.join(gone.select(*key), key, "left_anti")
    rest = rest.select(
        "id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))).otherwise(none).alias("spans"),
        *([F.when(whole, F.lit("")).alias("kept_text"), "t1", "t2"] if with_text else []),
    )
    out = cut.unionByName(rest)
    return out.withColumn("id", F.when(F.col("id") != _store.NO_ID, F.col("id"))).withColumnRenamed("id", id_col)
