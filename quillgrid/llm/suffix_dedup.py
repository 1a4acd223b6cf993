"""Suffix-array dedup: bytes covered by strings that occur earlier go.

Suffixes are sorted by the difference-cover method: triples at sampled positions
are sorted and named, the names are recursed on, the remaining suffixes are
merged in, and neighbours in the order compare their prefixes.

The sort is dealt to tasks by content. Each string of the given length has an
anchor, the least hash among its short runs of bytes, and equal strings have
equal anchors at equal places. So suffixes with equal prefixes always lie in the
task of their anchor, and strings whose anchor occurs only once need no sort.
Every task sorts the suffixes of its anchors' surroundings, in pieces of bounded
size; an anchor with very many of these is first dealt to several tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store

LENGTH = 100
#: Bytes of the runs whose hashes are anchors.
RUN = 24
#: Bytes whose suffixes are sorted at once (one anchor's surroundings can be more).
PIECE = 1 << 19
#: Places of an anchor from which on it is dealt to several tasks.
HOT = 2_048
#: Strings whose anchors are found at once, and the bits that hold a place among them.
SEGMENT = 1 << 20

_U = np.uint64
_PLACE = _U((1 << 21) - 1)


# The difference cover, in memory: characters are of eight bytes, so that the
# classes 0, 1, 2 of a position change by one from one character to the next.
STEP = 8


def _characters(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros after the end."""
    padded = np.concatenate([data, np.zeros(160, dtype=np.uint8)])
    out = np.zeros(len(data) + 152, dtype=_U)
    for k in range(STEP):
        out |= padded[k : k + len(out)].astype(_U) << _U(8 * (STEP - 1 - k))
    return out


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, the keys in it); a sort of plain numbers where key and index fit into one, which is far faster."""
    width = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + width > 64:
        order = np.argsort(key)
        return order, key[order]
    both = np.sort(key << _U(width) | np.arange(len(key), dtype=_U))
    return (both & _U((1 << width) - 1)).astype(np.int64), both >> _U(width)


def _dense(key: np.ndarray) -> np.ndarray:
    """Dense rank of each number, from 0."""
    order, ordered = _sorted(key)
    new = np.zeros(len(key), dtype=_U)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:], casting="unsafe")
    out = np.empty(len(key), dtype=_U)
    out[order] = np.cumsum(new)
    return out


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense rank of each row of keys, which are small numbers themselves, the first weighing most."""
    out = keys[0]
    for k in keys[1:]:
        width = int(k.max(initial=0)).bit_length()
        if int(out.max(initial=0)).bit_length() + width + len(k).bit_length() > 64:
            out = _dense(out)
        out = out << _U(width) | k
    return _dense(out)


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffixes of data in order of their first 120 bytes at least.

    Sampled are the positions of classes 1 and 2. The recursion on names ends
    when they are all different or reach that far.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    c = _dense(_characters(data))
    kind = np.arange(n + 128) // STEP % 3
    sample = np.flatnonzero(kind[: n + 48] != 0)
    # sort the sampled triples: names of 24 bytes
    name = np.zeros(n + 400, dtype=_U)
    name[sample] = _U(1) + _ranks(c[sample], c[sample + STEP], c[sample + 2 * STEP])
    # recurse on names: triples of names reach 72 bytes, then two of these 120
    for reach in ((24, 48), (48,)):
        if name[sample].max() == len(sample):
            break
        new = _U(1) + _ranks(name[sample], *(name[sample + r] for r in reach))
        name[:] = 0
        name[sample] = new
    # merge the remaining suffixes: each pair of classes has a shift at which both are sampled
    rest, one, two = (np.flatnonzero(kind[:n] == k) for k in (0, 1, 2))
    with_one, with_two = np.concatenate([rest, one]), np.concatenate([rest, two])
    by_one = _ranks(c[with_one], name[with_one + STEP])
    by_two = _ranks(c[with_two], c[with_two + STEP], name[with_two + 2 * STEP])
    r1, r2 = by_one[: len(rest)], by_two[: len(rest)]
    ordered = _sorted(r1)[0]
    rest, r1, r2 = rest[ordered], r1[ordered], np.maximum.accumulate(r2[ordered])
    out = np.empty(n, dtype=np.int64)
    place = np.arange(len(rest)) + np.searchsorted(np.sort(by_one[len(ordered) :]), r1) + np.searchsorted(np.sort(by_two[len(ordered) :]), r2)
    taken = np.zeros(n, dtype=bool)
    taken[place] = True
    out[place] = rest
    sampled = np.concatenate([one, two])
    out[~taken] = sampled[_sorted(name[sampled])[0]]
    return out


def equal_groups(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A number for each start: equal where the strings of length from there on are equal."""
    order = suffix_order(data)
    wanted = np.full(len(data), -1, dtype=np.int64)
    wanted[starts] = np.arange(len(starts))
    order = order[wanted[order] >= 0]
    c = _characters(data)
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for k in [*range(0, length - STEP, STEP), length - STEP]:
        same &= c[order[1:] + k] == c[order[:-1] + k]
    out = np.empty(len(starts), dtype=np.int64)
    out[wanted[order]] = np.concatenate([[0], np.cumsum(~same)]) if len(order) else 0
    return out


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, last, row, hash): each maximal run of strings, starting at begin to last, of one row and one anchor's place.

    Strings are read in segments, so that a text's length sets no bound.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (*(np.zeros(0, dtype=np.int64) for _ in range(3)), np.zeros(0, dtype=_U))
    edge = np.zeros(len(data) + 1, dtype=np.int8)  # starts whose string would reach over the row's end
    np.add.at(edge, np.maximum(offsets[1:] - length + 1, offsets[:-1]), 1)
    np.add.at(edge, offsets[1:], -1)
    inside = np.cumsum(edge[:n], dtype=np.int8) == 0
    c = _kernel.eights(data)
    firsts, lasts, places, hashes = [], [], [], []
    for s in range(0, n, SEGMENT):
        e = min(s + SEGMENT, n)
        h = _kernel.run_hashes(c, slice(s, e + length - RUN), RUN)
        least = _kernel.sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=_U), length - RUN + 1)
        place = (least & _PLACE).astype(np.int64)
        ok = inside[s:e]
        edge = np.ones(e - s + 1, dtype=bool)  # between a start and the one before
        edge[1:-1] = (place[1:] != place[:-1]) | ~ok[1:] | ~ok[:-1]
        first, last = np.flatnonzero(ok & edge[:-1]), np.flatnonzero(ok & edge[1:])
        firsts.append(first + s)
        lasts.append(last + s)
        places.append(place[first] + s)
        hashes.append(h[place[first]])
    begin, last, place, h = (np.concatenate(x) for x in (firsts, lasts, places, hashes))
    row = np.searchsorted(offsets, begin, side="right") - 1
    fresh = np.ones(len(begin), dtype=bool)  # a run may go on in the next segment
    fresh[1:] = (place[1:] != place[:-1]) | (begin[1:] != last[:-1] + 1) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    return begin[at], last[np.append(at[1:], len(last)) - 1] if len(at) else last, row[at], h[at]


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = _store.text_of(text_col)
    return df.select(F.coalesce(_store.id_of(id_col), F.lit(_store.NO_ID)).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def survey(df: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(id, t1, t2, n_bytes, sha, anchors, twice): the text's different anchors, and those at two places or more with their places' number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, sha, rows, names, times = [], [], [], [], []
            for a, b in _kernel.slices(batch.column(3)):
                data, offsets = _kernel.buffer_of(batch.column(3).slice(a, b - a))
                _, _, row, h = _anchors(data, offsets, length)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                rows.append(row[at] + a)
                names.append(h[at].view(np.int64))
                times.append(np.diff(np.append(at, len(h))))
                count += np.diff(offsets).tolist()
                raw = data.tobytes()
                sha += [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            rows, names, times = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (rows, names, times))
            cut = lambda r: pa.array(np.searchsorted(r, np.arange(batch.num_rows + 1)).astype(np.int32))
            more = times > 1
            again = pa.StructArray.from_arrays([pa.array(names[more]), pa.array(times[more])], ["anchor", "n"])
            lists = [pa.ListArray.from_arrays(cut(rows), pa.array(names)), pa.ListArray.from_arrays(cut(rows[more]), again)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(count, pa.int64()), pa.array(sha, pa.string()), *lists], ["id", "t1", "t2", "n_bytes", "sha", "anchors", "twice"])

    return _keyed(df, id_col, text_col).mapInArrow(_store.resting(run), "id long, t1 long, t2 long, n_bytes long, sha string, anchors array<long>, twice array<struct<anchor:bigint,n:bigint>>")


SURROUNDINGS = "task long, id long, t1 long, start int, end int, bytes binary"


def _surroundings(joined: DataFrame, length: int) -> DataFrame:
    """A row for each wanted anchor's place: the bytes of all strings that have it as theirs, and where they start.

    task names the anchor, in an odd number where it is hot (salts over 0) and
    dealt to so many tasks. Bytes that a text has had before go without saying:
    they are null, and end tells where they end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, t1, texts, wanted = batch.columns
            for a, b in _kernel.slices(texts):
                data, offsets = _kernel.buffer_of(texts.slice(a, b - a))
                begin, last, row, h = _anchors(data, offsets, length)
                items = wanted.slice(a, b - a).flatten()
                names, at = np.unique(np.asarray(items.field("anchor")).view(_U), return_index=True)
                salts = np.asarray(items.field("salts"))[at].astype(_U)
                found = np.minimum(np.searchsorted(names, h), max(len(names) - 1, 0))
                hit = np.flatnonzero(names[found] == h if len(names) else np.zeros(len(h), dtype=bool))
                if not len(hit):
                    continue
                begin, end, row, h, salt = begin[hit], last[hit] + length, row[hit], h[hit], salts[found[hit]]
                raw = data.tobytes()
                pieces: list[bytes | None] = [raw[s:e] for s, e in zip(begin.tolist(), end.tolist(), strict=True)]
                order = np.lexsort((begin, h, row))  # an anchor's places in one text, by place
                same = (row[order][1:] == row[order][:-1]) & (h[order][1:] == h[order][:-1])
                had: set[bytes] = set()
                for i, j, more in zip(order[:-1][same].tolist(), order[1:][same].tolist(), np.append(same, False)[1:][same].tolist(), strict=True):
                    had.add(pieces[i] or b"")
                    if pieces[j] in had:
                        pieces[j] = None
                    if not more:
                        had = set()
                copy = np.array([p is None for p in pieces])
                dealt = _U(1) + _kernel.mix((begin - offsets[row]).astype(_U) ^ np.asarray(t1.slice(a, b - a)).view(_U)[row]) % np.maximum(salt, _U(1))
                task = _kernel.mix(h + np.where(salt > 0, dealt, _U(0)) + np.where(copy, begin.astype(_U), _U(0)))
                task = (task & ~_U(1)) | (salt > 0).astype(_U)
                keys = [c.slice(a, b - a).take(pa.array(row)) for c in (ids, t1)]
                place = [pa.array((x - offsets[row]).astype(np.int32)) for x in (begin, end)]
                yield pa.RecordBatch.from_arrays([pa.array(task.view(np.int64)), *keys, *place, pa.array(pieces, pa.binary())], ["task", "id", "t1", "start", "end", "bytes"])

    return joined.mapInArrow(_store.resting(run), SURROUNDINGS)


def _gone(ids: np.ndarray, docs: np.ndarray, data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, whether it occurs earlier) of each string of rows of so many bytes of data, which are in order of document and place."""
    base = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    of = np.repeat(np.arange(len(sizes)), count)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    order, g = _sorted(equal_groups(data, base[of] + inner, length).astype(_U))
    new = np.ones(len(g), dtype=bool)
    new[1:] = g[1:] != g[:-1]
    mine, doc = ids[of][order], docs[of][order]
    again = np.zeros(len(g), dtype=bool)
    again[1:] = ~new[1:] & (doc[1:] == doc[:-1])
    out = np.empty(len(g), dtype=bool)
    out[order] = (mine > mine[new][np.cumsum(new) - 1]) | again
    return of, inner, out


def _settled(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Whole anchors' surroundings to removed spans; of hot ones also the strings that stay, by two hashes of 64 bits."""
    copies = rows.filter(rows["bytes"].is_null())
    rows = rows.filter(rows["bytes"].is_valid()).combine_chunks()
    task, ids, t1, start, end = (rows[c].to_numpy() for c in ("task", "id", "t1", "start", "end"))
    raw = rows["bytes"].combine_chunks() if rows.num_rows else pa.array([], pa.binary())
    raw = raw.chunk(0) if isinstance(raw, pa.ChunkedArray) else raw
    code = raw.dictionary_encode().indices.to_numpy()
    order = np.lexsort((code, start, t1, ids))
    fresh = np.ones(len(order), dtype=bool)  # a table's repeated rows count once
    fresh[1:] = np.any([x[order][1:] != x[order][:-1] for x in (ids, t1, start, code)], axis=0)
    order = order[fresh]
    first = np.zeros(int(code.max(initial=-1)) + 1, dtype=np.int64)
    first[code[order][::-1]] = order[::-1]
    known = first[code[order]]
    whole = (ids[known] < ids[order]) | ((known != order) & (ids[known] == ids[order]) & (t1[known] == t1[order]))  # all its strings are in an earlier row
    gone, left = order[whole], order[~whole]
    cols = [[copies["id"].to_numpy(), ids[gone]], [copies["t1"].to_numpy(), t1[gone]], [copies["start"].to_numpy(), start[gone]], [copies["end"].to_numpy(), end[gone]]]
    stay = np.zeros(0, dtype=np.int64)
    one = two = np.zeros(0, dtype=_U)
    if len(left):
        data = np.frombuffer(b"".join(raw.take(pa.array(left)).to_pylist()), dtype=np.uint8)
        mine, t, at = ids[left], t1[left], start[left].astype(np.int64)
        docs = np.cumsum(np.append(False, (mine[1:] != mine[:-1]) | (t[1:] != t[:-1])))
        sizes = (end[left] - start[left]).astype(np.int64)
        of, inner, out = _gone(mine, docs, data, sizes, length)
        edge = np.append(True, of[1:] != of[:-1])
        begin = np.flatnonzero(out & (edge | ~np.append(False, out[:-1])))
        last = np.flatnonzero(out & (np.append(edge[1:], True) | ~np.append(out[1:], False)))
        row = of[begin]
        for col, more in zip(cols, (mine[row], t[row], at[row] + inner[begin], at[row] + inner[last] + length), strict=True):
            col.append(more)
        stay = np.flatnonzero(~out & ((task[left] & 1) == 1)[of])
        row = of[stay]
        c = _kernel.eights(data)
        one, two = (_kernel.run_hashes(c, (np.cumsum(sizes) - sizes)[row] + inner[stay], length, seed) for seed in _kernel.SEEDS)
        for col, more in zip(cols, (mine[row], t[row], at[row] + inner[stay], at[row] + inner[stay] + length), strict=True):
            col.append(more)
    arrays = [pa.array(np.concatenate(c), k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
    hashes = [pa.concat_arrays([pa.nulls(len(arrays[0]) - len(stay), pa.int64()), pa.array(h.view(np.int64))]) for h in (one, two)]
    return pa.RecordBatch.from_arrays([*arrays, *hashes], ["id", "t1", "s", "e", "h1", "h2"])


def _sort(length: int):
    """Rows sorted by task, some tasks' at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > PIECE:
                rows = pa.Table.from_batches(held)
                task = rows["task"].to_numpy()
                cut = int(np.searchsorted(task, task[-1]))  # the last task may go on
                if cut:
                    yield _settled(rows.slice(0, cut), length)
                    held = rows.slice(cut).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
        if held:
            yield _settled(pa.Table.from_batches(held), length)

    return run


def _cut(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _kernel.buffer_of(batch.column(1))
            gone = batch.column(2)
            items = gone.flatten()
            s, e = (np.asarray(items.field(k)).astype(np.int64) for k in ("s", "e"))
            row = np.repeat(np.arange(batch.num_rows), np.asarray(gone.value_lengths()))
            s, e = s + offsets[row], e + offsets[row]  # rows don't touch: a removed run ends within its own
            order = np.lexsort((s, row))
            s, e, row = s[order], np.maximum.accumulate(e[order]) if len(e) else e, row[order]
            new = np.ones(len(s), dtype=bool)
            new[1:] = (s[1:] > e[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            s, e, row = s[at], e[np.append(at[1:], len(e)) - 1] if len(at) else e, row[at]
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            raw, out, kept = data.tobytes(), [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                starts, ends = s[cut[i] : cut[i + 1]].tolist(), e[cut[i] : cut[i + 1]].tolist()
                left = b"".join([raw[x:y] for x, y in zip([a, *ends], [*starts, b], strict=True)])
                out.append((b - a, b - a - len(left), len(starts), hashlib.sha256(left).hexdigest()))
                kept.append(left if with_bytes else None)
            spans = pa.StructArray.from_arrays([pa.array(x - offsets[row]) for x in (s, e)], ["start", "end"])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            cols = [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, pa.array(kept, pa.binary()), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), spans)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return run


def dedup_bytes(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = False) -> DataFrame:
    """One row per row of df: id, n_bytes, n_removed, n_spans, kept_sha256, spans; with_bytes adds kept.

    A byte of the text's UTF-8 goes where a string of length bytes covers it that
    also starts earlier: in a row of smaller id, or before in the same row. Strings
    are judged on the input and don't reach over rows. spans are the maximal
    removed runs (start, end). Null and short texts lose nothing; rows of equal id
    don't affect each other; a row without an id comes after all others. Only id
    and text are read. length is 24 at least and 120 at most.
    """
    if length < RUN or length > 120:
        raise ValueError("length must be between 24 and 120")
    spark = df.sparkSession
    _store.prepare(spark)
    key = ["id", "t1"]
    docs = _store.keep(survey(df, id_col, text_col, length), "suffix-survey")
    first = _store.keep(_store.with_first(docs.select(*key, "t2", "n_bytes", "sha")), "suffix-first")
    # anchors in two texts or twice in one; of equal texts only the first is looked at
    own = first.where(f"id = first and n_bytes >= {length}").select(*key, F.xxhash64("id", "t1").alias("doc")).distinct()
    anchors = docs.where(f"n_bytes >= {length}").select(F.xxhash64("id", "t1").alias("doc"), "t1", F.explode("anchors").alias("anchor"))
    inner = docs.select("t1", F.explode("twice").alias("x")).select(F.col("x.anchor").alias("anchor"), (-F.col("t1") - 1).alias("t1"), F.col("x.n").alias("n"))
    rows = anchors.select("anchor", "t1", F.lit(1).cast("long").alias("n")).unionByName(inner)
    many = rows.groupBy("anchor").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi"), F.sum("n").alias("n")).where("lo != hi")
    many = many.select("anchor", F.when(F.col("n") >= HOT, F.ceil(F.col("n") / HOT)).otherwise(0).cast("int").alias("salts"))
    many = _store.keep(many, "suffix-anchors")
    wanted = anchors.select("doc", "anchor").join(many, "anchor").groupBy("doc").agg(F.collect_list(F.struct("anchor", "salts")).alias("wanted"))
    wanted = _store.keep(wanted.join(own, "doc").select(*key, "wanted"), "suffix-wanted")
    texts = _keyed(df, id_col, text_col).select(*key, "text").join(wanted.hint("shuffle_hash"), key)
    found = _store.keep(texts.select(*key, "text", "wanted"), "suffix-texts")
    around = _surroundings(found, length).repartition(4 * _store.partitions(spark), "task").sortWithinPartitions("task")
    settled = _store.keep(around.mapInArrow(_store.resting(_sort(length)), "id long, t1 long, s int, e int, h1 long, h2 long"), "suffix-spans", rows=1_024)
    spans = settled.where("h1 is null").select(*key, "s", "e")
    if many.where("salts > 0").limit(1).count():  # strings of a hot anchor that stay in their own tasks meet over all of them
        stay = settled.where("h1 is not null")
        met = stay.groupBy("h1", "h2").agg(F.min(F.struct("id", "t1", "s")).alias("f"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "f")
        met = stay.join(_store.keep(met, "suffix-least"), ["h1", "h2"])
        other = met.where("id = f.id and t1 != f.t1")  # a text of the same id as the first: only its own strings count
        other = other.withColumn("k", F.row_number().over(Window.partitionBy("h1", "h2", *key).orderBy("s"))).where("k > 1")
        late = met.where("id > f.id or t1 = f.t1 and s > f.s").select(*key, "s", "e").unionByName(other.select(*key, "s", "e"))
        spans = spans.unionByName(late)
    gone = spans.groupBy(*key).agg(F.collect_list(F.struct("s", "e")).alias("gone"))
    gone = _store.keep(gone, "suffix-gone")
    kind = "array<struct<start:bigint,end:bigint>>"
    cut = found.select(*key, "text").join(gone.hint("shuffle_hash"), key).select("id", "text", "gone").mapInArrow(_store.resting(_cut(with_bytes)), f"id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans {kind}")
    whole = (F.col("id") > F.col("first")) & (F.col("n_bytes") >= length)  # a later copy
    rest = first.join(gone.select(*key), key, "left_anti").select(
        "id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(whole, F.lit("").cast("binary")).alias("kept"),
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.array().cast(kind)).alias("spans"),
    )
    out = cut.unionByName(rest)
    out = out if with_bytes else out.drop("kept")
    return out.withColumn("id", F.when(F.col("id") != _store.NO_ID, F.col("id"))).withColumnRenamed("id", id_col)
