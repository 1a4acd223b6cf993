"""SimHash near-duplicates: fingerprints of word shingles, compared exactly tile by tile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store
from quillgrid.llm.components import connected_components

WIDTH, RADIUS, SEED = 4, 4, 42
#: Fingerprints of a tile, about; those of one population count are dealt to as many tiles as it takes.
TILE_ROWS = 16_384
#: Fingerprints of a block within a tile.
BLOCK = 256
#: Links that a task gathers before it reduces them to a forest.
LINKS = 1 << 20

#: The eight bits of a byte as eight bytes of one number.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(column: pa.Array, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """SimHash of each text's lower-cased word shingles, as uint64; 0 without words."""
    out = np.zeros(len(column), dtype=np.uint64)
    for a, b in _kernel.slices(column):
        words = _kernel.words_of(column.slice(a, b - a))
        first = words.first
        count = np.diff(first)
        # words, with one space between those of a row
        kept = np.zeros(len(words.data) + 1, dtype=np.int8)
        np.add.at(kept, words.start, 1)
        np.add.at(kept, words.end, -1)
        inside = np.cumsum(kept[:-1]) > 0
        joint = np.ones(len(words.start), dtype=bool)
        joint[first[:-1][count > 0]] = False
        take = inside.copy()
        take[words.start[joint] - 1] = True
        raw = np.where(inside, _LOWER[words.data], np.uint8(32))[take].tobytes()
        place = np.concatenate([[0], np.cumsum(take)])
        begin, end = place[words.start], place[words.end]
        # shingles; a row of fewer words is one shingle
        n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        base = np.repeat(first[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        last = np.minimum(base + width, np.repeat(first[1:], n)) - 1
        h = np.fromiter((xxhash.xxh64_intdigest(raw[s:e], seed) for s, e in zip(begin[base].tolist(), end[last].tolist(), strict=True)), dtype=np.uint64, count=len(base))
        rows = np.flatnonzero(n)
        if len(rows):
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, (np.cumsum(n) - n)[rows], axis=0, dtype=np.int32)
            out[a + rows] = np.packbits(2 * sums > n[rows, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def set_fingerprints(sigs: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
    """SimHash of 64 * words bits of each set of 64-bit hashes: sets lie behind each other in sigs, from first on; 0 of an empty one."""
    n = np.diff(first)
    out = np.zeros((len(n), 8 * words), dtype=np.uint8)
    groups = -(-n // 255)  # of one set, so that a byte of a sum counts a bit
    rows, start = np.flatnonzero(n), np.cumsum(groups) - groups
    if len(rows):
        begin = np.repeat(first[:-1], groups) + 255 * (np.arange(groups.sum()) - np.repeat(start, groups))
        for w in range(words):
            each = _kernel.mix(sigs + np.uint64(w * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.uint8).reshape(-1, 8)
            for k in range(8):
                counts = np.add.reduceat(_LANES[each[:, k]], begin).view(np.uint8).reshape(-1, 8)
                sums = np.add.reduceat(counts, start[rows], axis=0, dtype=np.int64)
                out[rows, 8 * w + k] = np.packbits(2 * sums > n[rows, None], axis=1, bitorder="little")[:, 0]
    return out.view(np.uint64)


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(id, fp): the 64-bit fingerprint of each row as a signed long."""
    _store.prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(batch.column(1), width, seed).view(np.int64))], ["id", "fp"])

    return df.select(_store.id_of(id_col).alias("id"), _store.text_of(text_col).alias("text")).mapInArrow(_store.resting(run), "id long, fp long")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node reachable from each of n nodes over the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, root):
            return root
        root = new


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(x).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def compare(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links within left (right is None) or between left and right, reduced to a forest's.

    Fingerprints are ordered by the population counts of their quarters; pairs of
    blocks whose counts differ beyond the radius are skipped, all others compared
    by exclusive-or and bit counts.
    """

    def blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q = _quarters(x)
        order = np.lexsort(q.T[::-1])
        x, q = x[order], q[order]
        at = np.arange(0, len(x), BLOCK)
        return x, np.minimum.reduceat(q, at), np.maximum.reduceat(q, at)

    x, low, high = blocks(left)
    y, low2, high2 = (x, low, high) if right is None else blocks(right)
    shift = 0 if right is None else len(x)
    nodes = x if right is None else np.concatenate([x, y])
    far = np.zeros((len(low), len(low2)), dtype=np.int32)
    for d in range(4):
        far += np.maximum(0, np.maximum(low[:, None, d] - high2[None, :, d], low2[None, :, d] - high[:, None, d]))
    a, b, held = [], [], 0

    def reduce() -> None:
        nonlocal a, b, held
        root = forest(np.concatenate(a), np.concatenate(b), len(nodes))
        at = np.flatnonzero(root != np.arange(len(nodes)))
        a, b, held = [at], [root[at]], 0

    for i, j in zip(*np.nonzero(far <= radius), strict=True):
        if right is None and j < i:
            continue
        near = np.bitwise_count(x[i * BLOCK : (i + 1) * BLOCK, None] ^ y[None, j * BLOCK : (j + 1) * BLOCK]) <= radius
        if right is None and i == j:
            near = np.triu(near, 1)
        s, t = np.nonzero(near)
        if len(s):
            a.append(s + i * BLOCK)
            b.append(t + j * BLOCK + shift)
            held += len(s)
            if held > LINKS:
                reduce()
    if not a:
        return nodes[:0], nodes[:0]
    reduce()
    return nodes[a[0]], nodes[b[0]]


def near_links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fp of prints that are radius or fewer bits apart.

    A tile holds fingerprints of one population count, dealt by hash to tiles of
    bounded size. Only pairs of tiles whose counts are within the radius are made;
    each is compared exactly and gives a spanning forest of its links, so a group
    of near copies gives as many rows as it has members and not their square.
    """
    spark = prints.sparkSession
    _store.prepare(spark)
    n = prints.withColumn("pop", F.bit_count("fp"))
    sizes = {r.pop: r.n for r in n.groupBy("pop").agg(F.count("*").alias("n")).collect()}  # at most 65 rows
    parts = F.array(*(F.lit(-(-sizes.get(p, 0) // tile_rows)) for p in range(65)))
    tiles = n.withColumn("part", F.pmod(F.xxhash64("fp"), F.greatest(F.lit(1), F.get(parts, F.col("pop"))))).groupBy("pop", "part").agg(F.collect_list("fp").alias("fps"))
    key = lambda p, i, q, j: F.concat_ws("/", p, i, q, j)
    near = tiles.withColumn("q", F.explode(F.sequence(F.greatest(F.lit(0), F.col("pop") - radius), F.least(F.lit(64), F.col("pop") + radius))))
    near = near.withColumn("m", F.get(parts, F.col("q"))).where("m > 0").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long") - 1)))
    own = F.struct("pop", "part")
    other = F.struct(F.col("q").alias("pop"), F.col("j").alias("part"))
    near = near.withColumn("side", F.when(own < other, 0).when(own == other, 1).otherwise(2))
    near = near.select(F.when(F.col("side") < 2, key("pop", "part", "q", "j")).otherwise(key("q", "j", "pop", "part")).alias("pair"), "side", "fps")
    near = near.repartition(max(_store.partitions(spark), 2), "pair").sortWithinPartitions("pair", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, np.ndarray] | None = None
        for batch in batches:
            for pair, side, fps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                x = np.asarray(fps.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                if side == 0:
                    held = pair, x
                    continue
                if side == 2 and (held is None or held[0] != pair):  # its fellow tile is empty
                    continue
                a, b = compare(x, None, radius) if side == 1 else compare(held[1], x, radius)
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (a, b)], ["a", "b"])

    return near.mapInArrow(_store.resting(run), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row per row of df: id, fingerprint (16 hex digits), component_id.

    Rows link where their fingerprints differ in radius bits or fewer;
    component_id is the smallest id reachable. Null and empty texts have
    fingerprint zero and link like any other. A row without an id belongs to its
    component but never names it, unless all of it has none (null). Repeated rows
    stay repeated; other columns are not read, whatever their names.
    """
    prints = _store.keep(fingerprint_documents(df, id_col, text_col, width, seed), "simhash")
    nodes = _store.keep(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = _store.keep(named, "simhash-roots")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.join(least, "root").select("fp", "component_id")
    return prints.join(of, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
