"""The corpus pipeline: stages over documents, each written and read again as the next one's input.

All stages take nulls in any column, empty and very long texts, ties, repeated
rows, empty tables and extra columns of any name; each says what comes of them.
A row's own columns travel as one struct, so no name can clash with a stage's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm import _store, language_id, near_copies, packing, secret_scan, substring_dedup
from quillgrid.llm.queries import held_out, vocabulary

#: Documents whose calibrated language probability is below go.
LEAST_SCORE = 0.4
KEY = ["id", "t1", "t2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows as structs, with id (that of no id after all others) and two hashes of the text."""
    keys = _store.text_keys()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(row.alias("row"), F.coalesce(_store.id_of(), F.lit(_store.NO_ID)).alias("id"), *(c.alias(n) for n, c in keys.items()))


def _columns(docs: DataFrame, **new) -> list:
    """The columns of docs out of the rows' structs, some of them anew."""
    return [new.get(c, F.col("row")[c]).alias(c) for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language, by the model trained on the stage's own input.

    Those whose text is null, empty or without a letter go, and those no language
    fits. Every row is judged for itself, so repeated rows stay or go together;
    very long texts are read whole. Of an empty table nothing is learnt or left.
    """
    model = language_id.train(docs, ~held_out())
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text"))
    score = language_id.score_of(spark, model, F.col("text"))
    return rows.where(score >= LEAST_SCORE).select(*_columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, those with a Jaccard likeness of 0.8 in five-word shingles.

    It is the one of smallest id; among rows of that id, the text of least hash,
    once. Rows without an id come after all others. Null and empty texts are one
    group. Texts of any length are compared whole. An empty table stays one.
    """
    before = _store.written()
    groups = near_copies.near_duplicates(docs, with_keys=True).withColumnRenamed("doc_id", "id")
    groups = _store.keep(groups.withColumn("id", F.coalesce("id", F.lit(_store.NO_ID))).groupBy("root", *KEY).agg(F.count("*").alias("n")), "pipeline-groups")
    _store.forget_since(before, groups)
    stays = groups.groupBy("root").agg(F.min(F.struct(*KEY, "n")).alias("best")).select("best.*")
    # times: how often rows are there that stay once, 0 for those that go; all others stay as they are
    touched = groups.select(*KEY).join(stays.withColumnRenamed("n", "times"), KEY, "left").withColumn("times", F.coalesce("times", F.lit(0)))
    touched = _store.keep(touched.where("times != 1"), "pipeline-touched")
    rows = _store.marked(_keyed(docs), touched)  # the texts of most rows aren't shuffled
    judged = rows.where("may").join(touched.hint("shuffle_hash"), KEY, "left")
    once = judged.where("times > 1").dropDuplicates(KEY)  # pre-aggregated before the shuffle: repeated rows may be very many
    return reduce(DataFrame.unionAll, (x.select(*_columns(docs)) for x in (rows.where("not may"), judged.where("times is null"), once)))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier document has; those of which nothing is left go.

    Earlier is of smaller id; rows without an id come after all others, and rows of
    one id don't affect each other. Null and short texts stay as they are, as does
    an empty table; repeated rows stay repeated.
    """
    before = _store.written()
    cut = substring_dedup.dedup_substrings(docs, with_text=True).where("n_removed > 0")
    cut = cut.select(F.coalesce("doc_id", F.lit(_store.NO_ID)).alias("id"), "t1", "t2", "kept_text").dropDuplicates(KEY)
    cut = _store.keep(cut, "pipeline-cut")
    _store.forget_since(before, cut)
    rows = _store.marked(_keyed(docs), cut)  # the texts of most rows aren't shuffled
    out = rows.where("may").join(cut, KEY, "left").where("kept_text is null or kept_text != ''")
    length = F.when(F.col("kept_text").isNull(), F.col("row.n_chars")).otherwise(F.length("kept_text").cast("long"))
    out = out.select(*_columns(docs, text=F.coalesce("kept_text", "row.text"), n_chars=length))
    return rows.where("not may").select(*_columns(docs)).unionAll(out)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret.

    Null, empty and clean texts stay as they are, repeated rows stay repeated, and
    texts of any length are scanned whole.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text"))
    length = F.when(F.col("text").isNull(), F.col("row.n_chars")).otherwise(F.length("text").cast("long"))
    return secret_scan.redact_documents(rows).select(*_columns(docs, text=F.col("text"), n_chars=length))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, one row per piece.

    A null or empty text is the end id alone; longer documents are cut; repeated
    rows are packed each for itself; an empty table gives no sequence.
    """
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

#: The learned model and the packing can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over sf_dir's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = _store.keep(docs, f"pipeline-{name}")
    return docs
