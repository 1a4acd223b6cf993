"""Token ids of the words of a column of texts, each different word encoded once."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words are encoded at once.
UNIT_BYTES = 4 << 20
#: Words that are encoded as one text.
JOINED = 512
#: Words that a task remembers, at most (about 150 bytes each); then it starts anew.
REMEMBERED = 600_000
#: Threads of the tokenizers library in a worker, where the environment names no number.
THREADS = "2"


def bounded_threads() -> None:
    """Before the tokenizers library is loaded: executors have few cores each."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", THREADS)


def units(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about UNIT_BYTES in the text column: small ones are joined, large ones cut."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = min(max(int(np.searchsorted(ends, before + UNIT_BYTES - size, side="right")), at + (not held)), batch.num_rows)
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(ends[to - 1]) - before
            if to < batch.num_rows or size >= UNIT_BYTES:
                yield joined()
                held, size = [], 0
            at = to
    if held:
        yield joined()


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the parts between blanks of all texts, where each text's begin, with the total at the end)."""
    lists = pc.split_pattern(texts, " ")
    return lists.flatten(), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths(), dtype=np.int64))])


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids one after the other, how many each list has)."""
    count = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(count.sum())), count


def gather(flat: np.ndarray, count: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of these words, where each word's begin, with the total at the end), of all words' ids and how many each has."""
    n = count[numbers]
    cut = np.concatenate([[0], np.cumsum(n)])
    return flat[np.repeat((np.cumsum(count) - count)[numbers] - cut[:-1], n) + np.arange(cut[-1])], cut


def learn(words: pa.Array, encode: Callable[[list[str]], list[list[int]]], leads: np.ndarray, judge: Callable[[list[str], list[list[int]]], list[int]] | None = None, good: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all words, how many each has, each word's flags), of words that follow a blank; many are encoded as one text.

    leads: of each id, whether its token begins with a blank; each word must have
    one such token, its first. judge gives flags of texts and their ids; good ones
    hold for all words of a text. Else the text's words are encoded one by one.
    """
    at = np.append(np.arange(0, len(words), JOINED), len(words))
    texts = [f" {t}" for t in pc.binary_join(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), words), pa.scalar(" ", words.type)).to_pylist()]
    found = encode(texts)
    flags = judge(texts, found) if judge else [good] * len(texts)
    ids, count, out = [], [], []
    for one, flag, s, e in zip(found, flags, at[:-1].tolist(), at[1:].tolist(), strict=True):
        each = np.fromiter(one, dtype=np.uint32, count=len(one))
        first = np.flatnonzero(leads[each])
        if len(first) == e - s and flag == good and first[0] == 0:
            ids.append(each)
            count.append(np.diff(np.append(first, len(each))))
            out.append(np.full(e - s, flag, dtype=np.uint8))
            continue
        alone = [f" {w}" for w in words[s:e].to_pylist()]
        parts = encode(alone)
        ids += [np.array(p, dtype=np.uint32) for p in parts]
        count.append(np.array([len(p) for p in parts]))
        out.append(np.array(judge(alone, parts) if judge else [good] * len(alone), dtype=np.uint8))
    return np.concatenate([np.zeros(0, dtype=np.uint32), *ids]), np.concatenate([np.zeros(0, dtype=np.int64), *count]), np.concatenate([np.zeros(0, dtype=np.uint8), *out])


class Memory:
    """The ids of words that a task has met."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.count = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def of(self, words: pa.Array, unknown: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The number of each of the (different) words; flat and count then hold all ids and how many each number has."""
        if len(self.index) + len(words) > self.limit:
            self.clear()
        names = words.to_numpy(zero_copy_only=False).tolist()
        out = np.fromiter(map(self.index.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        new = np.flatnonzero(out < 0)
        if len(new):
            flat, count, _ = unknown(words.take(pa.array(new)))
            out[new] = len(self.count) + np.arange(len(new))
            self.index.update(zip(map(names.__getitem__, new.tolist()), out[new].tolist(), strict=True))
            self.flat, self.count = np.concatenate([self.flat, flat]), np.concatenate([self.count, count])
        return out
