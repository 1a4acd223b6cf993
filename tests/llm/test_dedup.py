"""SimHash, substring and suffix-array dedup, SpotSigs and components against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgrid.llm import simhash, spotsigs, substring_dedup, suffix_dedup
from quillgrid.llm.components import connected_components


def order(i):
    return i if i is not None else 2**63 - 1


def groups(n, linked):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(n)]


def least_ids(rows, roots):
    out = []
    for r in roots:
        ids = [i for (i, _), q in zip(rows, roots, strict=True) if q == r and i is not None]
        out.append(min(ids) if ids else None)
    return out


def slow_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_all_pairs(odd, odd_rows):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect())
    prints = [slow_print(t) for _, t in odd_rows]
    roots = groups(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    want = Counter((i, f"{f:016x}", c) for (i, _), f, c in zip(odd_rows, prints, least_ids(odd_rows, roots), strict=True))
    assert got == want


def test_simhash_of_no_rows(nothing):
    assert simhash.near_duplicates(nothing).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 700), st.booleans())
def test_tiles_find_every_link(seed, n, two):
    r = np.random.default_rng(seed)
    x = r.integers(0, 2**63, n, dtype=np.uint64)
    near = x[r.integers(0, n, n)] ^ (np.uint64(1) << r.integers(0, 64, n, dtype=np.uint64))
    x = np.unique(np.concatenate([x, near]))
    left, right = (x[::2], x[1::2]) if two else (x, None)
    a, b = simhash.compare(left, right)
    nodes = np.concatenate([left, right]) if two else x
    place = {int(v): i for i, v in enumerate(nodes)}
    far = np.bitwise_count(nodes[:, None] ^ nodes[None, :]) <= 4
    if two:
        far[: len(left), : len(left)] = False
        far[len(left) :, len(left) :] = False
    want = groups(len(nodes), lambda i, j: far[i, j])
    links = {(place[int(p)], place[int(q)]) for p, q in zip(a, b, strict=True)}
    got = groups(len(nodes), lambda i, j: (i, j) in links or (j, i) in links)
    assert got == want


def test_tiles_of_bounded_size_agree(spark, odd):
    prints = simhash.fingerprint_documents(odd).select("fp").distinct()
    wide = {tuple(sorted(map(int, r))) for r in connected_components(simhash.near_links(prints)).collect()}
    narrow = {tuple(sorted(map(int, r))) for r in connected_components(simhash.near_links(prints, tile_rows=2)).collect()}
    assert wide == narrow


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + k) for k in range(1, 300)] + [(7, 7), (400, 50), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in [*range(51), 400]) and all(got[100 + k] == 100 for k in range(300))
    assert len(got) == 352
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def slow_words(rows, width):
    split = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, split, strict=True):
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, order(None)), order(i))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        keep = [True] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < order(i):
                keep[k : k + width] = [False] * width
        out.append((i, len(w), keep.count(False), hashlib.sha256(b" ".join(x for x, y in zip(w, keep, strict=True) if y)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("width", [50, 7])
def test_substrings_against_all_windows(odd, odd_rows, width):
    got = substring_dedup.dedup_substrings(odd, width, with_text=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow_words(odd_rows, width)
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert (r.kept_text is None) == (r.n_removed == 0)


def test_substrings_of_no_rows(nothing):
    assert substring_dedup.dedup_substrings(nothing).collect() == []


def slow_bytes(rows, length):
    first = {}
    raw = [(t or "").encode() for _, t in rows]
    for n, ((i, _), w) in enumerate(zip(rows, raw, strict=True)):
        for k in range(len(w) - length + 1):
            first.setdefault(w[k : k + length], []).append((order(i), n, k))
    out = []
    for n, ((i, _), w) in enumerate(zip(rows, raw, strict=True)):
        edge = np.zeros(len(w) + 1, dtype=int)
        for k in range(len(w) - length + 1):
            if any(a < order(i) or (m == n and b < k) for a, m, b in first[w[k : k + length]][:50]):
                edge[k] += 1
                edge[k + length] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(w), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(w, np.uint8)[~gone].tobytes()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [2048, 2])
def test_suffixes_against_all_strings(odd, odd_rows, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = suffix_dedup.dedup_bytes(odd, with_bytes=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_bytes(odd_rows, 100)
    for r in got:
        assert len(r.spans) == r.n_spans and sum(s.end - s.start for s in r.spans) == r.n_removed


def test_suffixes_of_no_rows(nothing):
    assert suffix_dedup.dedup_bytes(nothing).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(0, 3), max_size=60), st.integers(1, 40))
def test_suffix_order(block, letters, times):
    data = np.frombuffer((block * times + bytes(letters) + block)[:2500], dtype=np.uint8)
    got = suffix_dedup.suffix_order(data).tolist()
    raw = data.tobytes()
    assert sorted(got) == list(range(len(raw)))
    heads = [(raw[i:] + bytes(200))[:120] for i in got]
    assert heads == sorted(heads)


def test_spotsigs_rows(odd, odd_rows):
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in spotsigs.fingerprint_documents(odd).collect())
    # rows of equal id: any order among them is one of two; only the order by id is fixed
    assert sum(got.values()) == len(odd_rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r[0], []).append(r)
    unique = sorted((i, t or "") for i, t in odd_rows if i is not None and sum(j == i for j, _ in odd_rows) == 1)
    for i, text in unique:
        below = [t or "" for j, t in odd_rows if j is not None and j < i and j == max(k for k, _ in odd_rows if k is not None and k < i)]
        if i == 1 or len(set(below)) != 1:
            continue
        new = spotsigs.edited(text, below[0])
        a, b, c = spotsigs.signatures(pa.array([text, new, below[0]]))
        ((_, n, sha, one, two, near, after),) = by_id[i]
        assert (n, sha) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (one, two) == (spotsigs.written(a), spotsigs.written(b))
        assert (near, after) == (spotsigs.jaccard(a, b), spotsigs.jaccard(a, c))
    prints = {}
    for i, t in odd_rows:
        for r in by_id[i]:
            if sum(j == i for j, _ in odd_rows) == 1:
                assert prints.setdefault(t or "", r[3]) == r[3]


def test_spotsigs_wraps_around(spark, nothing):
    from .conftest import frame

    assert spotsigs.fingerprint_documents(nothing).collect() == []
    (r,) = spotsigs.fingerprint_documents(frame(spark, [(5, "abcdef")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1.0
    rows = {r.doc_id: r for r in spotsigs.fingerprint_documents(frame(spark, [(1, "aaaaaa"), (9, "bbb"), (4, "cccccc")])).collect()}
    assert rows[1].edited_sha256 == hashlib.sha256(b"aaaabb").hexdigest()
    assert rows[9].edited_sha256 == hashlib.sha256(b"bbc").hexdigest()


def test_spotsigs_classes_against_all_pairs(odd, odd_rows):
    got = Counter((r.doc_id, r.class_id) for r in spotsigs.near_duplicates(odd).collect())
    sets = spotsigs.signatures(pa.array([t for _, t in odd_rows]))
    roots = groups(len(sets), lambda a, b: spotsigs.jaccard(sets[a], sets[b], 0.8) > 0)
    assert got == Counter((i, c) for (i, _), c in zip(odd_rows, least_ids(odd_rows, roots), strict=True))


def test_unlike_words_of_balanced_letters(spark):
    """A word and its complement that polynomials modulo 2 ** 64 can't tell apart."""
    from .conftest import frame

    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{k}" for k in range(49))
    got = substring_dedup.dedup_substrings(frame(spark, [(1, f"{rest} {one}"), (2, f"{rest} {other}"), (3, f"x {rest} {one}")])).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 50}
