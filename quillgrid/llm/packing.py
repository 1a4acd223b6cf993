"""Best-fit packing of tokenized documents into sequences.

Bulk-synchronous best-fit. Pieces are sorted by length with a rank among those
of their length; a round takes the longest length left and sweeps the gaps in
ascending order from its successor (the smallest gap that holds it) upwards.
Conflicts are resolved by rank: the gap of rank r takes the pieces of the next
ranks. Then gaps are updated and the next round begins.

Lengths and gaps lie in 1..sequence length, so however large the corpus, the
state of a round is a table of runs: so many pieces of one length, so many
sequences with one gap. The rounds work on these runs, and Spark matches every
piece to its run by length and rank.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store, _word_ids

SEQUENCE = 1024
END_ID = 2
#: Runs of a plan that are broadcast, at most (about 32 bytes each).
MAX_RUNS = 1 << 21


#: Words of ASCII and Latin letters, of which both libraries have the same notion.
PLAIN = "^[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"
#: One in so many joined texts of plain words is encoded by the tokenizers library too.
PROBE = 32
#: Last bytes of the characters of white space.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[chr(c).encode("utf-8")[-1] for c in range(0x3001) if chr(c).isspace()]] = True


class ChunkTokenizer:
    """Ids of a byte-level BPE of the tokenizers library, a chunk between blanks at a time.

    A blank belongs to the word after it, so a text falls into chunks that start
    with a blank, and no token reaches from one into the next; each different
    chunk of a batch is encoded once. Only runs of white space around a blank and the file's
    added tokens are read across chunks; such texts are encoded whole, as are all
    texts of a vocabulary whose text rule is another.

    Chunks of ASCII and Latin letters are encoded from the same vocabulary by
    tiktoken, a part of them also by the tokenizers library: as soon as one
    differs, that library does all. It does all other chunks.
    """

    _spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]

    def __init__(self, path: str):
        _word_ids.bounded_threads()
        from tokenizers import Tokenizer

        self.backend = Tokenizer.from_file(path)
        self.added = [t.content for t in self.backend.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        before = data.get("pre_tokenizer") or {}
        self.whole = bool(data.get("normalizer")) or before.get("type") != "ByteLevel" or before.get("add_prefix_space", True) or not before.get("use_regex", True)
        vocabulary = self.backend.get_vocab()
        self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.leads[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True  # how byte-level vocabularies write a blank

        self.memory = _word_ids.Memory()
        self.fast = None if self.whole else self._same_vocabulary(data)

    @staticmethod
    def _same_vocabulary(data: dict) -> Callable[[str], list[int]] | None:
        """tiktoken's encoder of the vocabulary; None where its ids aren't the order of its merges."""
        model = data["model"]
        if model.get("type", "BPE") != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            return None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; others are written from 256 on
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        special = {t["content"] for t in data.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if [model["vocab"].get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))) or len(ranks) != 256 + len(merges):
            return None
        import tiktoken

        # Fixed value: the text rule of byte-level vocabularies.
        rule = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("own", pat_str=rule, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _quick(self, texts: list[str]) -> list[list[int]]:
        """The library's ids of plain words, by tiktoken, which takes a quarter of the time; a part is held against the library, which does all where one differs."""
        if self.fast is not None:
            ids = [self.fast(t) for t in texts]
            if [list(x) for x in self._encode(texts[::PROBE])] == ids[::PROBE]:
                return ids
            self.fast = None
        return self._encode(texts)

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.fast is None:
            return _word_ids.learn(words, self._encode, self.leads)
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        quick, quick_n, _ = _word_ids.learn(words.filter(pa.array(plain)), self._quick, self.leads)
        flat, count, _ = _word_ids.learn(words.filter(pa.array(~plain)), self._encode, self.leads)
        number = np.where(plain, np.cumsum(plain) - 1, len(quick_n) + np.cumsum(~plain) - 1)
        each = np.concatenate([quick_n, count])
        return _word_ids.gather(np.concatenate([quick, flat]), each, number)[0], each[number], np.zeros(len(number), dtype=np.uint8)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.backend.encode_batch_fast(texts, add_special_tokens=False)]

    def _across(self, text: str) -> bool:
        """Whether white space or an added token may be read over a chunk's end."""
        return self.whole or "  " in text or any(f"{s} " in text for s in self._spaces) or any(t in text for t in self.added)

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """_across() of each text; asked only where a byte that may end white space is before a blank, or an added token is near."""
        if self.whole:
            return np.ones(len(texts), dtype=bool)
        data, offsets = _kernel.buffer_of(texts)
        near = _ENDS[data[:-1]] & (data[1:] == 32)
        row = np.searchsorted(offsets, np.flatnonzero(near), side="right") - 1
        ask = np.zeros(len(texts), dtype=bool)
        ask[row] = True
        for t in self.added:
            ask |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(ask)
        ask[at] = [self._across(t) for t in texts.take(pa.array(at)).to_pylist()]
        return ask

    def batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, each as four little-endian bytes."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        odd = self._odd(texts)
        parts, cut = _word_ids.split(texts.filter(pa.array(~odd)))
        head = np.zeros(len(parts), dtype=bool)
        head[cut[:-1]] = True
        coded = parts.filter(pa.array(~head)).dictionary_encode()
        place = self.memory.of(coded.dictionary, self._learn)
        alone, many = _word_ids.flattened(self._encode(parts.filter(pa.array(head)).to_pylist()))  # the first word of each text, which no blank precedes
        numbers = np.empty(len(parts), dtype=np.int64)
        numbers[~head] = place[coded.indices.to_numpy()] if len(place) else 0
        numbers[head] = len(self.memory.count) + np.arange(len(many))
        flat, begin = _word_ids.gather(np.concatenate([self.memory.flat, alone]), np.concatenate([self.memory.count, many]), numbers)
        raw, bounds = flat.astype("<u4").tobytes(), (4 * begin[cut]).tolist()
        plain = (raw[s:e] for s, e in zip(bounds, bounds[1:], strict=False))
        whole = iter(self._encode(texts.filter(pa.array(odd)).to_pylist()))
        return [np.array(next(whole), dtype="<u4").tobytes() if o else next(plain) for o in odd.tolist()]

    def ids(self, text: str) -> bytes:
        return self.batch([text])[0]


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One for each process."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def cut_pieces(df: DataFrame, vocabulary: str, length: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and the end id, cut from the end into full pieces."""
    _store.prepare(df.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tokenizer(vocabulary)
        for batch in _word_ids.units(batches, 1):
            rows: list[tuple[int, int, int, int, int]] = []
            for doc, ids in zip(batch.column(0).to_pylist(), tool.batch(batch.column(1)), strict=True):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % length or length, n + 1, length)]
                rows += [(doc, k, s, e - s, zlib.crc32(ids[4 * s : 4 * e])) for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["id", "piece", "start", "length", "ids_crc32"])
        tool.memory.clear()

    return df.select(_store.id_of(id_col).alias("id"), _store.text_of(text_col).alias("text")).mapInArrow(_store.resting(run), "id long, piece int, start long, length long, ids_crc32 long")


@dataclass(frozen=True)
class Run:
    """Pieces of one length from rank on: each of the sequences from sequence on takes so many, from offset on."""

    length: int
    rank: int
    sequence: int
    each: int
    offset: int


def best_fit(counts: Iterable[tuple[int, int]], size: int = SEQUENCE) -> list[Run]:
    """The plan for so many pieces of each length.

    Rounds go down the lengths. The pieces of a round fill the smallest gaps that
    hold them, all a gap can hold at once, as one piece after the other would.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count)
    order: list[int] = []
    out: list[Run] = []
    opened = 0

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    for length, count in sorted(counts, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} does not fit into {size}")
        rank = 0
        while rank < count:
            at = bisect_left(order, length)
            if at == len(order):  # no gap holds it: open new sequences
                each = size // length
                first, n, gap = opened, -(-(count - rank) // each), size
                opened += n
            else:
                gap = order[at]
                each = gap // length
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            full, some = divmod(min(count - rank, n * each), each)
            out.append(Run(length, rank, first, each, size - gap))
            rank += full * each + some
            free(gap - each * length, first, full)
            if some:
                free(gap - some * length, first + full, 1)
            free(gap, first + full + bool(some), n - full - bool(some))
        if len(out) > MAX_RUNS:
            raise ValueError("the plan has more runs than are broadcast")
    return out


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """pieces (with id, piece, length; a table, not recomputed) plus sequence_id and offset.

    Ranks within a length are made in buckets by hash, so that a length that most
    pieces have is no single task's; the buckets' sizes give each its first rank.
    """
    spark = pieces.sparkSession
    _store.prepare(spark)
    buckets = 4 * max(_store.partitions(spark), 8)
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "start"), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    plan = best_fit([(r.length, r.n) for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()], size)  # a row for each length at most
    key = np.array([r.length for r in plan], dtype=np.int64) << 44 | np.array([r.rank for r in plan], dtype=np.int64)
    by = np.argsort(key)
    table = spark.sparkContext.broadcast((key[by], *(np.array([getattr(r, k) for r in plan], dtype=np.int64)[by] for k in ("length", "rank", "sequence", "each", "offset"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lengths, ranks, sequences, each, offsets = table.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            behind = rank - ranks[at]
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequences[at] + behind // each[at]), pa.array(offsets[at] + behind % each[at] * length)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    from pyspark.sql import Window

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("id", "piece", "start")
    ranked = rows.withColumn("k", F.row_number().over(within)).join(starts, ["length", "bucket"]).withColumn("rank", (F.col("base") + F.col("k") - 1).cast("long"))
    names = [c for c in pieces.columns if c != "rank"]
    ranked = ranked.select(*names, "rank")
    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)
    return ranked.mapInArrow(_store.resting(run), f"{kinds}, sequence_id long, offset long")


def pack_documents(df: DataFrame, vocabulary: str, size: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids and the end id; a null or empty text is the end
    id alone. Documents of more than size tokens are cut into pieces of size; the
    first may be shorter. Repeated rows are packed each for itself. No rows, no
    sequences. Only id and text are read.
    """
    pieces = _store.keep(cut_pieces(df, vocabulary, size, end_id, id_col, text_col), "pieces")
    return pack(pieces, size).withColumnRenamed("id", id_col)
