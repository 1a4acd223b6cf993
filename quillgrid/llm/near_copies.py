"""Near copies: documents linked by SimHash and an exact Jaccard likeness of their word shingles.

A set of shingles has a SimHash of 256 bits. Two sets of the threshold differ in
a bit by a chance that the threshold bounds, so a radius is known within which
all but LOST of such pairs lie. Fingerprints are compared in tiles by length, and
each pair within the radius by its whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store
from quillgrid.llm.components import connected_components
from quillgrid.llm.simhash import set_fingerprints
from quillgrid.llm.spotsigs import _lowered, jaccard

WIDTH, THRESHOLD = 5, 0.8
#: 64-bit words of a fingerprint; those that are compared first; the part of pairs of the threshold that may lie beyond a radius.
PRINT, FIRST_WORDS, LOST = 4, 2, 1e-9
#: 64-bit words of a sketch.
SKETCH = 8
#: Fingerprints of a tile: so many at least, and at most, and between these so that there are about TILES.
TILE_SETS, MOST_SETS, TILES = 1_024, 1 << 18, 24
#: Rows that reach Python at once where tiles are compared.
TILE_BATCH = 4_096
#: Candidates of one fingerprint in one tile before its pair of tiles is put off until these are joined.
EACH = 8
#: Sets below this size have radii of their own.
SHORT = 48

_U = np.uint64


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Each text's distinct lower-cased word shingles as sorted 64-bit hashes; fewer words are one shingle, none an empty set."""
    out: list[np.ndarray] = []
    for a, b in _kernel.slices(column):
        words = _kernel.words_of(_lowered(column.slice(a, b - a)))
        h, first = words.hashes(), words.first
        count = np.diff(first)
        n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        cut = np.concatenate([[0], np.cumsum(n)])
        base = np.repeat(first[:-1], n) + np.arange(cut[-1]) - np.repeat(cut[:-1], n)
        size = np.repeat(np.minimum(count, width), n)
        sig = np.zeros(len(base), dtype=_U)
        for k in range(width):
            on = k < size
            sig[on] = _kernel.mix(sig[on] * _U(31) + h[base[on] + k])
        out += [np.unique(sig[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
    return out


def prints(sets: list[np.ndarray]) -> np.ndarray:
    """The SimHash of each set, a row of PRINT words; sets are gathered up to some MB."""
    out, at = [np.zeros((0, PRINT), dtype=_U)], 0
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    while at < len(sets):
        end = max(at + 1, int(np.searchsorted(first, first[at] + (1 << 18), side="right")) - 1)
        out.append(set_fingerprints(np.concatenate(sets[at:end]), first[at : end + 1] - first[at], PRINT))
        at = end
    return np.concatenate(out)


def _binomial(n: int) -> np.ndarray:
    return np.array([math.comb(n, k) / 2**n for k in range(n + 1)])


def flip(n: int, threshold: float) -> float:
    """The greatest chance that a bit differs between a set of n shingles and another as large or larger, unlike, of the threshold."""
    worst = 0.0
    for m in range(n, math.floor(n / threshold + 1e-9) + 1):
        for c in range(math.ceil(threshold / (1 + threshold) * (n + m) - 1e-9), n + (m > n)):  # shingles in both
            common, ones = _binomial(c), []
            for size in (n, m):
                rest = np.concatenate([np.cumsum(_binomial(size - c)[::-1])[::-1], [0]])  # of so many or more
                ones.append(rest[np.clip(size // 2 + 1 - np.arange(c + 1), 0, size - c + 1)])
            p, q = ones
            worst = max(worst, float((common * (p * (1 - q) + q * (1 - p))).sum()))
    return worst


def radius(p: float, bits: int, lost: float = LOST) -> int:
    """So many of the bits, each different by the chance p, are exceeded by the part lost at most."""
    tail, k = 0.0, bits
    while k > 0 and (tail := tail + math.comb(bits, k) * p**k * (1 - p) ** (bits - k)) <= lost:
        k -= 1
    return k


@lru_cache(maxsize=8)
def radii(threshold: float) -> np.ndarray:
    """Rows of the radius over FIRST_WORDS and over all PRINT words, by the size of the smaller set (the last row: SHORT or more)."""
    each = [flip(n, threshold) for n in range(SHORT + 16)]
    limit = math.acos(2 * threshold / (1 + threshold)) / math.pi  # of very large sets
    chances = [*each[:SHORT], max(limit, *each[SHORT:])]
    return np.array([[radius(p, 64 * w) for w in (FIRST_WORDS, PRINT)] for p in chances])


def bands(threshold: float, most: int = 1 << 40) -> np.ndarray:
    """Least sizes of bands of sizes: sets of the threshold are of one band or of neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(max(math.floor(out[-1] / threshold + 1e-9) + 1, out[-1] + out[-1] // 64))
    return np.array(out)


def sketch(sigs: np.ndarray, bits: int = 64 * SKETCH) -> bytes:
    """The parity of the hashes at each bit; two sketches differ in no more bits than their sets in hashes."""
    odd = np.bincount((sigs % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def wide_sketch(sigs: np.ndarray) -> bytes:
    """A sketch of two bits or more for each hash: a power of two, so that it folds to any shorter one."""
    return sketch(sigs, max(64 * SKETCH, 1 << (2 * len(sigs) - 1).bit_length() if len(sigs) else 0))


def apart(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """In how many bits each pair of wide sketches differs, the longer one folded to the shorter."""
    sizes = np.array([(len(x), len(y)) for x, y in zip(one, two, strict=True)], dtype=np.int64).reshape(-1, 2)
    out = np.zeros(len(sizes), dtype=np.int64)
    for p, q in np.unique(sizes, axis=0).tolist():
        at = np.flatnonzero((sizes[:, 0] == p) & (sizes[:, 1] == q))
        least = min(p, q) // 8
        x, y = (np.bitwise_xor.reduce(np.frombuffer(b"".join(side[i] for i in at), dtype=_U).reshape(len(at), -1, least), axis=1) for side in (one, two))
        out[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def candidates(n: np.ndarray, fp: np.ndarray, sketches: np.ndarray, roots: np.ndarray, split: int, threshold: float, each: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs of places, between the first split sets and the rest (within all where split is 0), of different roots within the radius.

    Both parts are ordered by n. Lengths and sketches never exclude a pair of the
    threshold. At most so many are made of each set of the first part; the flag
    says whether any more were left out.
    """
    limits, block, across = radii(threshold), 32, 2048
    shift = split or 0
    left, other = (n[:split], n[split:]) if split else (n, n)
    right = [np.ascontiguousarray(fp[shift:, w]) for w in range(FIRST_WORDS)]
    for top in range(0, len(left), block):
        low, high = left[top], left[min(top + block, len(left)) - 1]
        begin = int(np.searchsorted(other, threshold * low - 1e-9))
        end = int(np.searchsorted(other, high / threshold + 1e-9, side="right"))
        begin = begin if split else max(begin, top + 1)
        loose = limits[min(max(int(min(low, other[begin] if begin < end else low)), 0), SHORT) : min(int(high), SHORT) + 1, 0].max()
        rows = [fp[top : min(top + block, len(left)), w, None] for w in range(FIRST_WORDS)]
        had = np.zeros(len(rows[0]), dtype=np.int64)
        for at in range(begin, end, across):
            to = min(at + across, end)
            far = np.bitwise_count(rows[0] ^ right[0][None, at:to])
            for w in range(1, FIRST_WORDS):
                far += np.bitwise_count(rows[w] ^ right[w][None, at:to])
            near = np.flatnonzero((far <= loose).ravel())
            if not len(near):
                continue
            a, b = near // (to - at), near % (to - at)
            far = far.ravel()[near].astype(np.int64)
            a, b = a + top, b + at + shift
            na, nb = n[a], n[b]
            limit = limits[np.minimum(np.minimum(na, nb), SHORT)]
            ok = (roots[a] != roots[b]) & (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9) & (far <= limit[:, 0])
            if not split:
                ok &= a < b
            a, b, far, limit = a[ok], b[ok], far[ok], limit[ok]
            far += np.bitwise_count(fp[a, FIRST_WORDS:] ^ fp[b, FIRST_WORDS:]).sum(axis=1, dtype=np.int64)
            a, b = (x[far <= limit[:, 1]] for x in (a, b))
            apart = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int64)
            ok = apart <= (1 - threshold) / (1 + threshold) * (n[a] + n[b]) + 1e-9
            a, b, more = a[ok], b[ok], False
            if each is not None and len(a):
                of, count = np.unique(a - top, return_counts=True)  # a is in order
                place = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(had[of], count)
                had[of] += count
                more = bool((place >= each).any())
                a, b = a[place < each], b[place < each]
            if len(a) or more:
                yield a, b, more


def _likely(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) that lengths and sketches allow."""
    side = lambda c: known.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"s{c}"))
    both = pairs.join(side("a").hint("shuffle_hash"), "a").join(side("b").hint("shuffle_hash"), "b")
    both = both.where(F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9).select("a", "b", "na", "nb", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = apart(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(far <= (1 - threshold) / (1 + threshold) * n + 1e-9))

    return both.mapInArrow(_store.resting(run), "a long, b long")


def _tiles(known: DataFrame) -> DataFrame:
    """known with the number of its tile and low and high, those of the first and the last that it is compared with.

    A tile holds sets of one band of sizes, dealt by hash.
    """
    sizes = {r.band: r.n for r in known.groupBy("band").agg(F.count("*").alias("n")).collect()}  # a row for each band
    tile = min(MOST_SETS, max(TILE_SETS, -(-sum(sizes.values()) // TILES)))
    parts = [-(-sizes.get(k, 0) // tile) for k in range(max(sizes, default=0) + 2)]
    first = [0, 0]  # of the band before, of each band, of those after
    for x in parts:
        first.append(first[-1] + x)
    of = lambda shift: F.get(F.array(*(F.lit(x) for x in first)), F.col("band") + 1 + shift)
    many = F.greatest(F.lit(1), F.get(F.array(*(F.lit(x) for x in parts)), F.col("band")))
    return known.withColumn("tile", (of(0) + F.pmod(F.xxhash64("key"), many)).cast("int")).withColumn("low", of(-1)).withColumn("high", of(2) - 1)


def _met(rows: DataFrame, threshold: float, each: int | None) -> DataFrame:
    """Rows (a, b, i, j) of rows (key, root, n, fp, sketch, tile, other): candidate pairs a, b of different roots in a tile and another, or pairs of tiles i, j that have more."""
    rows = rows.select(F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") > F.col("other")).alias("side"), "key", "root", "n", "fp", "sketch")
    rows = rows.repartition(_store.partitions(rows.sparkSession), "i", "j").sortWithinPartitions("i", "j", "side", "n")

    def words(column: pa.Array, many: int) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=_U).reshape(-1, many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def end() -> Iterator[pa.RecordBatch]:
            i, j = now
            side, keys, roots, n, fp, sketches = (np.concatenate(x) for x in zip(*held, strict=True))
            split = int((~side).sum()) if i != j else 0
            if i != j and not 0 < split < len(keys):
                return
            put_off, a, b = False, [], []
            for x, y, more in candidates(n, fp, sketches, roots, split, threshold, each):
                put_off |= more
                a.append(keys[x])
                b.append(keys[y])
                if sum(map(len, a)) >= 1 << 16:
                    yield made(np.concatenate(a), np.concatenate(b))
                    a, b = [], []
            if a:
                yield made(np.concatenate(a), np.concatenate(b))
            if put_off:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([i], pa.int32()), pa.array([j], pa.int32())], ["a", "b", "i", "j"])

        def made(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(len(a), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), none, none], ["a", "b", "i", "j"])

        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            i, j = (batch.column(k).to_numpy() for k in (0, 1))
            cols = [batch.column(2).to_numpy(zero_copy_only=False), *(batch.column(k).to_numpy() for k in (3, 4, 5)), words(batch.column(6), PRINT), words(batch.column(7), SKETCH)]
            cuts = [0, *(np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist(), len(i)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if (pair := (int(i[s]), int(j[s]))) != now:
                    if held:
                        yield from end()
                    now, held = pair, []
                held.append([c[s:e] for c in cols])
        if held:
            yield from end()

    return rows.mapInArrow(_store.resting(run), "a long, b long, i int, j int")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets have a likeness of threshold or more."""
    one = sets.select(F.col("key").alias("a"), F.col("sigs").alias("sa"))
    two = sets.select(F.col("key").alias("b"), F.col("sigs").alias("sb"))
    both = pairs.join(one.hint("shuffle_hash"), "a").join(two.hint("shuffle_hash"), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [jaccard(np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U), threshold) >= threshold for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(like, pa.bool_()))

    return both.mapInArrow(_store.resting(run), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, with_keys: bool = False) -> DataFrame:
    """(id, component_id) of each row: rows linked by a likeness of threshold or more; component_id is the smallest id reachable.

    Equal sets are one node. Sets whose fingerprints are within the radius are
    candidates; every link is an exact comparison. The first candidates of each
    set are compared first, which joins groups of near copies by few links; then
    all candidates not joined yet, those of tiles with very many last.
    Empty sets are one group. A row without an id never names a component, unless
    all of it has none. with_keys adds root, which tells components apart, and t1
    and t2, two hashes of the text.
    """
    spark = df.sparkSession
    _store.prepare(spark)
    least = bands(threshold)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            keys = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=_U).view(np.int64)
            band = (np.searchsorted(least, n, side="right") - 1).astype(np.int32)
            cols = [*batch.columns[0:1], *batch.columns[2:], pa.array(keys), pa.array(n), pa.array(band), pa.array([p.tobytes() for p in prints(sets)], pa.binary()), *(pa.array([f(s) for s in sets], pa.binary()) for f in (sketch, wide_sketch))]
            yield pa.RecordBatch.from_arrays(cols, ["id", "t1", "t2", "key", "n", "band", "fp", "sketch", "wide"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), width)], pa.binary())], ["key", "sigs"])

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The sets of the pairs' keys, made again from one text of each."""
        need = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        need = _store.keep(known.join(need.hint("shuffle_hash"), "key", "left_semi").select("rep.*", "key"), "copies-need")
        texts = df.select(F.coalesce(_store.id_of(id_col), F.lit(_store.NO_ID)).alias("id"), _store.text_of(text_col).alias("text")).withColumns(_store.text_keys())
        texts = _store.marked(texts, need).where("may").join(need.hint("shuffle_hash"), ["id", "t1", "t2"]).select("key", "text")
        sets = _store.keep(texts.mapInArrow(_store.resting(whole), "key long, sigs binary").dropDuplicates(["key"]), "copies-sets")
        _store.forget(need)
        return sets

    def likely(met: DataFrame) -> DataFrame:
        return _store.keep(_likely(met.where("a is not null").select("a", "b"), known, threshold), "copies-pairs")

    def rooted(links: DataFrame) -> DataFrame:
        return _store.keep(connected_components(links).withColumnRenamed("node", "key"), "copies-roots")

    def unjoined(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        side = lambda c: roots.select(F.col("key").alias(c), F.col("root").alias(f"r{c}")).hint("shuffle_hash")
        both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
        return both.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")

    docs = df.select(_store.id_of(id_col).alias("id"), _store.text_of(text_col).alias("text")).withColumns(_store.text_keys())
    docs = docs.mapInArrow(_store.resting(read), "id long, t1 long, t2 long, key long, n long, band int, fp binary, sketch binary, wide binary")
    docs = _store.keep(docs, "copies")
    same = [F.first(c).alias(c) for c in ("n", "band", "fp", "sketch", "wide")]
    known = _store.keep(docs.groupBy("key").agg(F.min("id").alias("first"), *same, F.min(F.struct(F.coalesce("id", F.lit(_store.NO_ID)).alias("id"), "t1", "t2")).alias("rep")), "copies-nodes")
    tiles = _tiles(known.where("n > 0").select("key", F.col("key").alias("root"), "n", "band", "fp", "sketch"))

    met = _store.keep(_met(tiles.withColumn("other", F.explode(F.sequence("low", "high"))), threshold, EACH), "copies-met", TILE_BATCH)
    pairs = likely(met)
    sets = sets_of(pairs)
    first = pairs.groupBy("a").agg(F.min("b").alias("b")).unionByName(pairs.groupBy("b").agg(F.min("a").alias("a"))).distinct()
    links = _store.keep(_verified(first, sets, threshold), "copies-links")
    rest = _store.keep(unjoined(pairs, rooted(links)), "copies-rest")
    links = _store.keep(links.unionByName(_verified(rest, sets, threshold)), "copies-links")
    roots = rooted(links)
    _store.forget(sets)

    put_off = met.where("a is null").select("i", "j").distinct()
    if put_off.take(1):
        ends = put_off.select(F.col("i").alias("tile"), F.col("j").alias("other")).union(put_off.select("j", "i"))
        ends = ends.groupBy("tile").agg(F.collect_set("other").alias("others"))  # a row for each tile
        again = tiles.drop("root").join(roots.hint("shuffle_hash"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        again = again.join(F.broadcast(ends), "tile").withColumn("other", F.explode("others"))
        met = _store.keep(_met(again, threshold, None), "copies-met", TILE_BATCH)
        pairs = likely(met)
        sets = sets_of(pairs)
        links = _store.keep(links.unionByName(_verified(pairs, sets, threshold)), "copies-links")
        roots = rooted(links)
        _store.forget(sets)

    named = known.select("key", "first").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    named = _store.keep(named, "copies-roots")
    of = named.join(named.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("key", "root", "component_id")
    extra = ["root", "t1", "t2"] if with_keys else []
    return docs.select("id", "t1", "t2", "key").join(of, "key").select(F.col("id").alias(id_col), "component_id", *extra)
