"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader and elastic-net penalties, then
calibrated by one temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm import _store

#: Hashed n-gram features, as a power of two.
BITS = 15
#: The model is fitted on about so many labelled documents of each language.
ROWS_PER_LANGUAGE = 400
#: Bytes of a model that is broadcast, at most (128 KB for each language).
MODEL_BYTES = 64 << 20
#: Characters of one batch of documents that are worked on at once.
SLICE_CHARS = 1 << 19
UNKNOWN = "und"

_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower case, whether a letter) of each code point; what isn't a letter becomes a blank."""
    if not _TABLES:
        points = range(0x110000)
        letter = np.fromiter((chr(c).isalpha() for c in points), dtype=bool, count=0x110000)
        lower = np.where(letter, np.arange(0x110000, dtype=np.uint32), np.uint32(32))
        for c in np.flatnonzero(letter):
            low = chr(c).lower()
            lower[c] = ord(low) if len(low) == 1 else c
        _TABLES.update(letter=letter, lower=lower)
    return _TABLES["lower"], _TABLES["letter"]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, offsets, letters): hashed n-grams of 1 to 3 characters, three a position.

    offsets: position range of each text; letters: how many it has. Texts are
    walled off by blanks, so that no n-gram holds characters of two texts.
    """
    lower, letter = _tables()
    points = np.frombuffer("".join(f"  {t}" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])]).astype(np.int64)
    c = lower[points]
    sums = np.concatenate([[0], np.cumsum(letter[points])])
    k = np.uint32(2654435761)
    one = c * k
    two = one * np.uint32(31) + np.uint32(0x85EBCA6B)
    two[1:] ^= one[:-1] * np.uint32(40503)
    three = two * np.uint32(31) + np.uint32(0xC2B2AE35)
    three[2:] ^= one[:-2] * np.uint32(0x27D4EB2F)
    out = np.empty((len(c), 3), dtype=np.uint32)
    for i, x in enumerate((one, two, three)):
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out[:, i] = x >> np.uint32(32 - BITS)
    return out, offsets, sums[offsets[1:]] - sums[offsets[:-1]]


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS or i == len(texts) - 1:
            yield at, i + 1
            at, size = i + 1, 0


@dataclass
class Model:
    """Languages, the folded weights idf * w of each feature, the bias and the temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    losses: list[float] = field(default_factory=list)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        for a, b in _pieces(texts):
            feats, offsets, letters[a:b] = grams(texts[a:b])
            for k in range(len(self.languages)):  # one table at a time stays in the cache
                w = self.weights[:, k]
                each = w[feats[:, 0]] + w[feats[:, 1]] + w[feats[:, 2]]
                out[a:b, k] = np.add.reduceat(each, offsets[:-1])
            out[a:b] = out[a:b] / (3 * np.diff(offsets))[:, None]
        return (out + self.bias) / self.temperature, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """(language, probability) of each text; without letters und with 0.0."""
        if not texts or not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        z, letters = self.logits([t or "" for t in texts])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        known = letters > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, p.max(axis=1), 0.0).tolist()


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, idf: np.ndarray, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.002, epochs: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with L1 and L2 over sparse rows (features, term frequencies): (weights, bias)."""
    z, n = np.zeros((len(idf) + 1, classes)), np.zeros((len(idf) + 1, classes))

    def solved(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            feats, tf = rows[r]
            at, x = np.append(feats, len(idf)), np.append(tf * idf[feats], 1.0)
            w = solved(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[r]] -= 1
            g = x[:, None] * p[None, :]
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    w = solved(np.arange(len(idf) + 1))
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden sections of its logarithm."""

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]))

    lo, hi, g = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all texts (one string column) have each feature; the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, dtype=np.int64)
        total = 0
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for a, b in _pieces(rows):
                feats, offsets, _ = grams(rows[a:b])
                for s, e in zip(offsets[:-1], offsets[1:], strict=True):
                    mark = np.zeros(1 << BITS, dtype=bool)
                    mark[feats[s:e].ravel()] = True
                    seen += mark
            total += len(rows)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(seen[at], total), pa.int64())], ["feature", "n"])

    found = texts.mapInArrow(_store.resting(count), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # at most 2 ** BITS + 1 rows
    out = np.zeros(1 << BITS)
    for r in found:
        if r.feature >= 0:
            out[r.feature] = r.n
    return out, sum(r.n for r in found if r.feature < 0)


def train(df: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the rows where learns holds and text and language are not null.

    Inverse document frequencies come from all of them; weights from a sample by
    id hash of about ROWS_PER_LANGUAGE each, of which every fifth only calibrates.
    Without such rows the model knows no language and predicts und.
    """
    _store.prepare(df.sparkSession)
    rows = df.select(_store.id_of(id_col).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), learns.alias("learns"))
    rows = rows.where(F.col("learns") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    most = MODEL_BYTES // (4 << BITS)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError("the model of so many languages is too large to broadcast")
    if not counts:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    languages = sorted(r.lang for r in counts)
    share = F.create_map(*(F.lit(x) for r in counts for x in (r.lang, min(1 << 30, (ROWS_PER_LANGUAGE << 30) // r.n))))
    drawn = F.pmod(F.xxhash64(F.coalesce("id", F.lit(0)), F.lit(11)), F.lit(1 << 30)) < F.try_element_at(share, F.col("lang"))
    bound = 2 * ROWS_PER_LANGUAGE * len(languages)  # never met but by rows of one repeated id
    sample = rows.where(drawn).select("id", "text", "lang").limit(bound).collect()
    seen, total = document_frequencies(rows.select("text"))
    idf = np.log((1 + total) / (1 + seen))
    sample.sort(key=lambda r: (r.id if r.id is not None else _store.NO_ID, r.lang))
    features, labels = [], []
    for r in sample:
        feats, _, letters = grams([r.text])
        if not letters[0]:
            continue
        at, n = np.unique(feats.ravel(), return_counts=True)
        features.append((at, n / n.sum()))
        labels.append(languages.index(r.lang))
    labels = np.array(labels, dtype=np.int64)
    if not len(labels):
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    held = np.arange(len(labels)) % 5 == 4
    fit = np.flatnonzero(~held)
    weights, bias = fit_ftrl([features[i] for i in fit], labels[fit], len(languages), idf)
    model = Model(languages, (weights * idf[:, None]).astype(np.float32), bias)
    if held.any():
        logits = np.array([tf @ model.weights[at] + bias for (at, tf), h in zip(features, held, strict=True) if h])
        model.temperature = temperature(logits, labels[held])
    return model


def shared_model(spark: SparkSession, model: Model):
    """The model as a broadcast of checked size."""
    if model.weights.nbytes > MODEL_BYTES:
        raise ValueError("the model is too large to broadcast")
    return spark.sparkContext.broadcast(model)


def score_of(spark: SparkSession, model: Model, text: Column) -> Column:
    """The probability of the likeliest language of a text; 0 where it is null or has no letter.

    Only the text goes to Python: whatever else a row has stays in the JVM.
    """
    _store.prepare(spark)
    shared = shared_model(spark, model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.predict(texts.to_pylist())[1], pa.float64())

    return score(text.cast("string"))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of df: the id, the columns in carry, lang_pred, score (calibrated probability, 0 to 1).

    A text that is null or has no letter is und with score 0. Only the text
    decides. Repeated rows are judged each for itself; columns not named are not
    read, whatever their names.
    """
    spark = df.sparkSession
    _store.prepare(spark)
    shared = shared_model(spark, model)
    names = list(dict.fromkeys([id_col, *carry]))
    if clash := {"lang_pred", "score"} & set(names):
        raise ValueError(f"carried columns have the names of results: {sorted(clash)}")
    narrow = df.select(*(F.col(f"`{n}`").alias(n) for n in names), *([] if text_col in names else [F.col(f"`{text_col}`").alias(text_col)]))
    narrow = narrow.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    at = narrow.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    kinds = ", ".join(f"`{n}` {narrow.schema[n].dataType.simpleString()}" for n in names)
    return narrow.mapInArrow(_store.resting(run), f"{kinds}, lang_pred string, score double")
