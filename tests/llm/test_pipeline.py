"""The corpus pipeline against a brute-force version of every stage."""

import re
from collections import Counter

import corpus_pipeline
from quillgrid.llm import language_id, queries, secret_scan

from ..conftest import SMALL
from .test_dedup import groups
from .test_text import slow_pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def slow_substrings(rows, width=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") for r in rows]
    first = {}
    for r, w in zip(rows, words, strict=True):
        for k in range(len(w) - width + 1):
            first[tuple(w[k : k + width])] = min(first.get(tuple(w[k : k + width]), r["doc_id"]), r["doc_id"])
    out = []
    for r, w in zip(rows, words, strict=True):
        keep = [True] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < r["doc_id"]:
                keep[k : k + width] = [False] * width
        if all(keep):
            out.append(r)
        elif any(keep):
            text = " ".join(x for x, y in zip(w, keep, strict=True) if y)
            out.append(r | {"text": text, "n_chars": len(text)})
    return out


def as_rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["doc_id"])


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def alike(x, y):
    return len(x & y) >= 0.8 * len(x | y)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = as_rows(docs)
    model = language_id.train(docs, ~queries.held_out())
    langs, scores = model.predict([r["text"] for r in rows])
    kept = [r for r, x, s in zip(rows, langs, scores, strict=True) if x != "und" and s >= corpus_pipeline.LEAST_SCORE]
    sets = [shingles(r["text"]) for r in kept]
    roots = groups(len(kept), lambda a, b: alike(sets[a], sets[b]))
    unique = [r for i, r in enumerate(kept) if roots[i] == i]
    cut = slow_substrings(unique)
    red = []
    for r in cut:
        text = secret_scan.redact(r["text"])
        red.append(r | {"text": text, "n_chars": len(text)})
    want = [kept, unique, cut, red]
    at = docs
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        at = stage(spark, at, SMALL).checkpoint()
        assert at.columns == COLUMNS, name
        assert as_rows(at) == rows, name
    last = corpus_pipeline.STAGES[-1][1](spark, at, SMALL).collect()
    pieces = slow_pieces([(r["doc_id"], r["text"]) for r in red], 1024)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in last) == Counter(pieces)
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == Counter(pieces)


CLASHES = "row id t1 t2 kept_text score lang_pred root n best component_id key __text".split()


def test_stages_of_odd_and_no_rows(spark, odd_rows):
    """Extra columns of any name keep their values; repeated rows stay where the stage says so."""
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(i, t, None if t is None else "en", None, None if t is None else len(t)) for i, t in odd_rows], "doc_id long, text string, lang string, source string, n_chars long")
    table = table.select("*", *(F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES)).repartition(3).checkpoint()
    for df in (table, table.where("false")):
        at = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, at = at, stage(spark, at, SMALL).checkpoint()
            assert at.columns == df.columns, name
            rows = at.collect()
            for r in rows:
                assert all(r[c] == f"{c}-{'none' if r.doc_id is None else r.doc_id}" for c in CLASHES), name
            had = Counter(r.doc_id for r in before.collect())
            assert not Counter(r.doc_id for r in rows) - had, name
            if name == "secret_scan":
                assert Counter(r.doc_id for r in rows) == had
        assert corpus_pipeline.STAGES[-1][1](spark, at, SMALL).count() >= at.count()


def test_one_of_each_group_stays(spark):
    from .conftest import frame

    base = " ".join(f"w{k}" for k in range(120))
    rows = [(2, base), (4, base + " more"), (4, "other text here"), (4, "other text here"), (None, "lone words of no id"), (None, "lone words of no id"), (None, base), (9, None), (8, "")]
    got = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(2, base), (4, "other text here"), (None, "lone words of no id"), (8, "")])


def test_near_copies_and_repeated_ids(spark):
    from .conftest import frame

    say = " ".join(f"w{i}" for i in range(200))
    rows = [(5, say), (3, say + " more"), (9, None), (9, None), (4, "other words here"), (4, "other words here"), (None, say)]
    got = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), SMALL).collect()
    assert sorted(r.doc_id for r in got) == [3, 4, 9]


def test_planted_near_copies_are_linked(spark):
    import random

    from quillgrid.llm import near_copies

    from .conftest import frame

    r = random.Random(3)
    word = lambda: f"w{r.randrange(5000)}"
    line = [word() for _ in range(30)]  # in many documents
    rows = []
    for k in range(40):
        base = [word() for _ in range(r.choice((8, 60, 200, 900)))] + line * (k % 2)
        rows.append((len(rows), " ".join(base)))
        for changes in (0, 1, 1, 2, 3, 5, 12):
            copy = list(base)
            for _ in range(changes * len(base) // 200 + (changes > 0)):
                copy[r.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for _, t in rows)]
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    roots = groups(len(rows), lambda a, b: like(a, b) >= 0.8)
    assert 40 < len(set(roots)) < 200
    for tile in (2048, 5):
        near_copies.TILE_SETS = tile
        got = near_copies.near_duplicates(frame(spark, rows)).collect()
        assert {x.doc_id: x.component_id for x in got} == dict(enumerate(roots))
    near_copies.TILE_SETS = 2048
    kept = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), SMALL).collect()
    assert sorted(x.doc_id for x in kept) == sorted(set(roots))


def shuffled(spark):
    """Bytes written to shuffles so far."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    each = context.statusStore().executorList(False)
    return sum(each.apply(i).totalShuffleWrite() for i in range(each.size()))


def test_texts_that_stay_are_not_shuffled(spark):
    """Both stages that drop or cut some texts leave the others where they are, and keep few tables."""
    import random

    from quillgrid.llm import _store

    from .conftest import frame

    r = random.Random(8)
    say = lambda n: [f"{r.getrandbits(240):060x}" for _ in range(n)]
    texts = [say(200) for _ in range(200)]
    passage = say(60)
    texts += [[*t[:-1], "end"] for t in texts[:5]] + [say(100) + passage for _ in range(3)]
    docs = frame(spark, [(k, " ".join(t)) for k, t in enumerate(texts)]).checkpoint()
    size = sum(len(r.text) for r in docs.collect())
    for k, stay, cut in ((1, set(range(208)) - set(range(200, 205)), set()), (2, set(range(208)), {*range(200, 205), 206, 207})):
        before, tables = shuffled(spark), len(_store._written)
        got = {x.doc_id: x.text for x in corpus_pipeline.STAGES[k][1](spark, docs, SMALL).collect()}
        assert shuffled(spark) - before < size / 2, corpus_pipeline.STAGES[k][0]
        assert len(_store._written) - tables <= 2, corpus_pipeline.STAGES[k][0]
        assert got.keys() == stay and {i for i in got if got[i] != " ".join(texts[i])} == cut
