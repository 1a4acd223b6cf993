"""Document fingerprints: SpotSigs, partitioned by set length and compared through pruned Jaccard."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store
from quillgrid.llm.components import connected_components
from quillgrid.llm.quality_rules import STOP_WORDS
from quillgrid.llm.simhash import forest

#: Content words of a chain, and the distance from one to the next in content words.
CHAIN, DISTANCE = 2, 1
THRESHOLD = 0.8
#: Sets of a tile, about, in comparing.
TILE_SETS = 2_048

# Words that start no chain, being links or endings of a template rather than running text.
NOT_ANCHORS = {"it", "que", "se", "si"}

_SPLIT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_U = np.uint64


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.unique(_kernel.words_of(pa.array(words), _SPLIT).hashes())


_STOP = _word_hashes(sorted(set(STOP_WORDS)))
_ANCHOR = _word_hashes(sorted(set(STOP_WORDS) - NOT_ANCHORS))


def _lowered(column: pa.Array) -> pa.Array:
    """ASCII letters in lower case."""
    data, offsets = _kernel.buffer_of(column)
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low))


def _chains(anchor: np.ndarray, content: np.ndarray, h: np.ndarray, row: np.ndarray, chain: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of each anchor that has a whole chain of content words after it in its row."""
    at = np.searchsorted(content, anchor, side="right") + (distance - 1)
    ok = at + (chain - 1) * distance < len(content)
    anchor, at = anchor[ok], at[ok]
    sig = _kernel.mix(h[anchor])
    last = anchor
    for k in range(chain):
        last = content[at + k * distance]
        sig = _kernel.mix(sig * _U(31) + h[last])
    ok = row[last] == row[anchor]
    return row[anchor][ok], sig[ok]


def signatures(column: pa.Array, chain: int = CHAIN, distance: int = DISTANCE) -> list[np.ndarray]:
    """The set of each text's signatures, as sorted 32-bit numbers.

    Where no anchor has a whole chain, every word is an anchor; where there are
    too few words for that, the whole text is the one signature. An empty text's
    set is empty.
    """
    out: list[np.ndarray] = []
    for a, b in _kernel.slices(column):
        part = column.slice(a, b - a)
        words = _kernel.words_of(_lowered(part), _SPLIT)
        h, row = words.hashes(), words.row
        content = np.flatnonzero(~np.isin(h, _STOP))
        rows, sigs = _chains(np.flatnonzero(np.isin(h, _ANCHOR)), content, h, row, chain, distance)
        has = np.zeros(b - a, dtype=bool)
        has[rows] = True
        every = np.arange(len(h))
        rows2, sigs2 = _chains(every[~has[row]], every, h, row, chain, distance)
        rows, sigs = np.concatenate([rows, rows2]), np.concatenate([sigs, sigs2])
        order = np.argsort(rows, kind="stable")
        rows, sigs = rows[order], (sigs[order] >> _U(32)).astype(np.uint32)
        cut = np.searchsorted(rows, np.arange(b - a + 1))
        for i, (s, e) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if s < e:
                out.append(np.unique(sigs[s:e]))
            else:
                text = part[i].as_py() or ""
                whole = hashlib.sha256(text.encode("utf-8")).digest()[:4]
                out.append(np.frombuffer(whole if text else b"", dtype="<u4"))
    return out


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Likeness of two sets; 0.0 as soon as their lengths rule out least. Two empty sets are equal."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    value = both / (len(a) + len(b) - both)
    return value if value >= least else 0.0


def written(sigs: np.ndarray) -> str:
    """The set as text: base64 of its little-endian numbers."""
    return base64.b64encode(sigs.astype("<u4").tobytes()).decode()


def edited(text: str, after: str) -> str:
    """The text, its last third replaced by the first as many characters of another."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def _bucket(bounds: list[int]):
    """How many of the descending bounds are above id, by halving."""
    steps = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    table = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda lo, s: F.when(F.coalesce(F.get(table, lo + s - 1) > F.col("id"), F.lit(False)), lo + s).otherwise(lo))


def fingerprint_documents(df: DataFrame, chain: int = CHAIN, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each row and of its edited text, with their likeness and that to the next row's.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next row is that of the next smaller id, after
    the last the first. Rows of equal id follow each other by a hash of their
    text; rows without an id come last. Null texts are empty; two empty sets have
    likeness 1. A single row is its own next. Only id and text are read.

    Rows go by ranges of ids, with one shuffle; the first row of a range also goes
    to the range before it, as that one's last neighbour.
    """
    spark = df.sparkSession
    _store.prepare(spark)
    least = -(2**63)
    schema = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    docs = df.select(F.coalesce(_store.id_of(id_col), F.lit(least)).alias("id"), _store.text_of(text_col).alias("text"))
    ranges = 4 * max(_store.partitions(spark), 8)
    cuts = docs.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 20 * ranges)).first()[0]
    if cuts is None:
        return spark.createDataFrame([], schema)
    docs = docs.withColumn("bucket", _bucket(sorted(set(cuts), reverse=True)))
    heads = {r.bucket: r.head for r in docs.groupBy("bucket").agg(F.max("id").alias("head")).collect()}  # a row for each range
    order = sorted(heads)
    to = {heads[b]: before for b, before in zip(order, [order[-1], *order[:-1]], strict=True)}
    goal = F.element_at(F.create_map(*(F.lit(x) for kv in to.items() for x in kv)), F.col("id"))
    own = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    both = F.array(own, F.struct(goal.alias("bucket"), F.lit(1).alias("guest")))
    rows = docs.withColumn("to", F.explode(F.when(F.col("id").isin(*to), both).otherwise(F.array(own)))).select("to.bucket", "to.guest", "id", "text")
    rows = rows.repartition(_store.partitions(spark), "bucket").sortWithinPartitions("bucket", "guest", F.desc("id"), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before: (bucket, guest, id, text, signatures)
        for batch in batches:
            sigs = signatures(batch.column(3), chain, distance)
            seq = list(zip(*(batch.column(i).to_pylist() for i in range(4)), sigs, strict=True))
            if last is not None:
                seq.insert(0, last)
            last = seq[-1]
            pairs = [(x, y) for x, y in zip(seq, seq[1:], strict=False) if not x[1] and x[0] == y[0]]
            texts = [edited(x[3], y[3]) for x, y in pairs]
            news = signatures(pa.array(texts, pa.large_string()), chain, distance)
            cols = [
                pa.array([x[2] if x[2] != least else None for x, _ in pairs], pa.int64()),
                pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts], pa.string()),
                pa.array([written(x[4]) for x, _ in pairs], pa.string()),
                pa.array([written(n) for n in news], pa.string()),
                pa.array([jaccard(x[4], n) for (x, _), n in zip(pairs, news, strict=True)], pa.float64()),
                pa.array([jaccard(x[4], y[4]) for x, y in pairs], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(_store.resting(run), schema)


def _links(sets: list[np.ndarray], split: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between sets[:split] and sets[split:]; within all of them where split is 0.

    Sets are read by rising length through an inverted index of the prefixes that
    similar sets must share; lengths and then counts prune before the comparison.
    """
    index: dict[int, list[int]] = defaultdict(list)
    a, b = [], []
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        s = sets[i]
        prefix = s[: len(s) - math.ceil(threshold * len(s)) + 1]
        seen = set()
        for x in prefix.tolist():
            seen.update(index[x])
            index[x].append(i)
        for j in seen:
            if (not split or (i < split) != (j < split)) and jaccard(s, sets[j], threshold):
                a.append(i)
                b.append(j)
    root = forest(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), len(sets))
    at = np.flatnonzero(root != np.arange(len(sets)))
    return at, root[at]


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, chain: int = CHAIN, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id) of each row: classes linked by likeness of threshold or more; class_id is their smallest id.

    Equal sets are compared once. Sets fall into partitions of lengths, each
    reaching up to its least length over the threshold, so that similar sets lie
    in one partition or two neighbours; large partitions are dealt to tiles of
    bounded size, and every pair of tiles of such partitions is compared. Null ids
    belong to classes but never name them, unless alone. Empty sets form one class.
    """
    spark = df.sparkSession
    _store.prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = signatures(batch.column(1), chain, distance)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32())], ["id", "sigs", "n"])

    docs = df.select(_store.id_of(id_col).alias("id"), _store.text_of(text_col).alias("text")).mapInArrow(_store.resting(run), "id long, sigs binary, n int")
    docs = _store.keep(docs.withColumn("key", F.xxhash64("sigs")), "spotsigs")
    nodes = docs.groupBy("key").agg(F.min("id").alias("first"), F.first("sigs").alias("sigs"), F.first("n").alias("n"))
    nodes = nodes.withColumn("band", F.when(F.col("n") > 0, F.floor(F.log(F.greatest(F.col("n"), F.lit(1))) / F.lit(-math.log(threshold)))).otherwise(-2).cast("int"))
    nodes = _store.keep(nodes, "spotsigs-nodes")
    tiles = F.ceil(F.col("bn") / TILE_SETS).cast("int")
    sizes = nodes.groupBy("band").agg(F.count("*").alias("bn")).select("band", tiles.alias("m"))
    mine = nodes.join(F.broadcast(sizes), "band").withColumn("part", F.pmod("key", F.col("m")))  # a row for each band: a few dozen
    parts = mine.select("key", "sigs", "band", "part", "m").withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("band2", F.col("band") + F.col("step"))
    parts = parts.join(F.broadcast(sizes.select(F.col("band").alias("band2"), F.col("m").alias("m2"))), "band2").withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("m2") - 1)))
    one, two = F.struct("band", "part"), F.struct(F.col("band2").alias("band"), F.col("part2").cast("long").alias("part"))
    pairs = parts.withColumn("side", F.when(one < two, 0).when(one == two, 1).otherwise(2)).select(F.concat_ws("/", F.when(one > two, F.concat_ws("/", "band2", "part2", "band", "part")).otherwise(F.concat_ws("/", "band", "part", "band2", "part2"))).alias("pair"), "side", "key", "sigs")
    pairs = pairs.repartition(_store.partitions(spark), "pair").sortWithinPartitions("pair", "side")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def end() -> pa.RecordBatch:
            at, root = _links(sets, 0 if same else split, threshold)
            names = np.array(keys, dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(names[root])], ["a", "b"])

        now, keys, sets, split, same = None, [], [], 0, False
        for batch in batches:
            for pair, side, key, sigs in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if pair != now:
                    if keys:
                        yield end()
                    now, keys, sets, split, same = pair, [], [], 0, side == 1
                keys.append(key)
                sets.append(np.frombuffer(sigs, dtype=np.uint32))
                split += side == 0
        if keys:
            yield end()

    roots = connected_components(pairs.mapInArrow(_store.resting(join), "a long, b long"))
    named = nodes.select("key", "first").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = _store.keep(named, "spotsigs-roots")
    of = named.join(named.groupBy("root").agg(F.min("first").alias("class_id")), "root").select("key", "class_id")
    return docs.join(of, "key").select(F.col("id").alias(id_col), "class_id")
