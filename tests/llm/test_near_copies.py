"""Near copies by SimHash: fingerprints against a plain version, radii, tiles put off, and what is written on the way."""

import random

import numpy as np
import pyarrow as pa

from quillgrid.llm import _kernel, _store, near_copies

from .conftest import frame
from .test_dedup import groups


def planted(bases, seed=11):
    r = random.Random(seed)
    rows = []
    for k in range(bases):
        base = [f"w{r.randrange(3000)}" for _ in range(r.choice((9, 40, 300)))]
        for changes in (0, 1, 1, 2, 3, 6):
            copy = list(base)
            for _ in range(changes):
                copy[r.randrange(len(copy))] = f"w{r.randrange(3000)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_prints_against_a_plain_version():
    g = np.random.default_rng(1)
    sets = [np.unique(g.integers(0, 2**63, k).astype(np.uint64)) for k in (0, 1, 5, 254, 255, 256, 511, 0, 3)]
    for s, row in zip(sets, near_copies.prints(sets), strict=True):
        for w in range(near_copies.PRINT):
            h = _kernel.mix(s + np.uint64(w * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).tolist()
            assert int(row[w]) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(s))


def test_pairs_of_the_threshold_lie_within_the_radius():
    sets = near_copies.shingle_sets(pa.array([t for _, t in planted(60)]))
    fp, limits = near_copies.prints(sets), near_copies.radii(0.8)
    found = 0
    for i in range(len(sets)):
        for j in range(i - i % 6, i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                found += 1
                far = np.bitwise_count(fp[i] ^ fp[j])
                half, whole = limits[min(len(sets[i]), len(sets[j]), near_copies.SHORT)]
                assert far[: near_copies.FIRST_WORDS].sum() <= half and far.sum() <= whole
    assert found > 100
    assert limits[-1, 1] < 96  # unlike sets differ in 128 of 256 bits, with a deviation of 8


def test_tiles_with_too_many_candidates_are_done_later(spark, monkeypatch):
    rows = planted(12) + [(72 + k, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2 + f"end{k}") for k in range(30)]
    sets = near_copies.shingle_sets(pa.array([t for _, t in rows]))

    def like(a, b):
        common = len(np.intersect1d(sets[a], sets[b]))
        return common >= 0.8 * (len(sets[a]) + len(sets[b]) - common)

    monkeypatch.setattr(near_copies, "EACH", 1)
    monkeypatch.setattr(near_copies, "TILE_SETS", 7)
    got = near_copies.near_duplicates(frame(spark, rows)).collect()
    assert {x.doc_id: x.component_id for x in got} == dict(enumerate(groups(len(rows), like)))


def test_no_table_holds_a_row_for_each_shingle(spark, monkeypatch):
    """What is written grows with the documents, not with the shingles that they share."""
    r = random.Random(2)
    line = [f"shared{r.randrange(900)}" for _ in range(250)]
    rows = [(k, " ".join([*(f"w{r.randrange(5000)}" for _ in range(60)), *line])) for k in range(40)]
    kept, keep = {}, _store.keep

    def counted(df, name, *more):
        out = keep(df, name, *more)
        kept[name] = max(kept.get(name, 0), out.count())
        return out

    monkeypatch.setattr(_store, "keep", counted)
    near_copies.near_duplicates(frame(spark, rows)).collect()
    pairs = len(rows) * (len(rows) - 1) // 2
    assert kept and max(kept.values()) <= pairs, kept
