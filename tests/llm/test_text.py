"""URL filters, quality rules, secrets, language ID, tokenization and packing."""

import hashlib
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from quillgrid.llm import language_id, packing, quality_rules, queries, secret_scan, sentencepiece_codec, url_filter

from ..conftest import SMALL
from .conftest import frame

BPE = queries.vocabulary("byte_bpe_50k.json")
PIECES = queries.vocabulary("piece_bpe_32k.model")


def slow_verdict(url, rules):
    host, path = url_filter.split_url(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.text), r.action == "block"), default=None)
    return host, path, best and best.text, best.action if best else "allow"


def test_urls_against_every_rule(spark):
    r = random.Random(1)
    rules = [url_filter.UrlRule(r.choice(["allow", "block"]), ".".join(r.choice("abc") for _ in range(r.randint(1, 3))), r.choice(["", "/"]) + "".join(r.choice("ab/") for _ in range(r.randint(0, 3)))) for _ in range(40)]
    rules = [x if x.path.startswith("/") or not x.path else url_filter.UrlRule(x.action, x.host, "/" + x.path) for x in rules]
    urls = [r.choice(["http://", "HTTPS://", ""]) + ".".join(r.choice("abcA") for _ in range(r.randint(1, 4))) + "".join(r.choice("ab/?#:") for _ in range(r.randint(0, 7))) for _ in range(600)]
    urls += [None, "", "://", "x://", "http://a?b/", "http://a.b#c", "http://a.b.:80/a"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*urls, *urls[:3]])], "page_id long, url string, host string, rule string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter.judge_urls(df, rules).collect()}
    assert got == {i: slow_verdict(u, rules) for i, u in enumerate([*urls, *urls[:3]])}
    assert url_filter.judge_urls(df.limit(0), rules).collect() == []


def test_odd_urls(spark):
    cases = {"http://WWW.Example.com/en/x": "allow", "https://m.example.com/en/": "block", "http://example.com/en": "allow", "http://a.net/es/1": "block", "http://net/fr/": "block", "http://notexample.com/en/": "allow"}
    df = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(df, queries.URL_RULES).collect()} == dict(enumerate(cases.values()))


def slow_quality(text):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    lines = [x for x in t.split("\n") if x.encode().split()]
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = {p for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
    base = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), base


def test_quality_against_counting(odd, odd_rows, nothing):
    got = quality_rules.judge_quality(odd).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter((i, *slow_quality(t)) for i, t in odd_rows)
    assert all(not (r.base_failed and r.kept) for r in got)
    assert quality_rules.judge_quality(nothing).collect() == []


def test_quality_uses_no_python(odd):
    plan = quality_rules.judge_quality(odd.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(cur.fetchall())


BASE = {
    "nothing here": [],
    'password = "abcdefghijkl"': [("assign", 0, 24)],
    "token: secret: abcdefghijklmnop": [],
    "API_KEY=abc.def-ghi_jk": [("assign", 0, 22)],
    "apikey : short": [],
    "é AKIAABCDEFGHIJKLMN x": [("access", 2, 20)],
    "AKIAABCDEFGHIJKLM": [],
    "xAKIA1 AKIA00000000000000": [("access", 7, 25)],
    "deadbeefdeadbeef0": [("hex", 0, 17)],
    "DEADBEEFdeadbeefdeadbee": [],
    "SECRET==abcdefghijklmnop": [("assign", 0, 24)],
}


def test_base_secrets():
    for text, want in BASE.items():
        assert [x for x in secret_scan.scan(text) if x[0] != "literal"] == want, text


def test_named_literals():
    def found(text):
        return [text[s:e] for k, s, e in secret_scan.scan(text) if k == "literal"]

    assert found('db_password = "Tr0ub4dor&3xy"') == ["Tr0ub4dor&3xy"]
    assert found('A = "Tr0ub4dor&3xy"\nB = A\nclient.secretKey = B') == ["Tr0ub4dor&3xy"]
    assert found('{"accessToken": "q8Zr-19xLmP0"}') == ["q8Zr-19xLmP0"]
    assert found('colour = "Tr0ub4dor&3xy"') == []
    assert found('password = "changeme"\ntoken = "${TOKEN_FROM_ENV}"') == []
    assert found('password == "Tr0ub4dor&3xy"') == []


def test_every_part_of_a_name_is_looked_at():
    value = "Tr0ub4dor&3xy-Qm7LpZ"
    assert secret_scan.scan('dsn = "postgres://svc:Tr0ub4dor3xy@db.internal/main"') == [("literal", 7, 51)]
    names = [*secret_scan.NAME_PARTS, *(f"{p[:k]}_{p[k:]}" for p in secret_scan.NAME_PARTS for k in range(1, len(p)))]
    for name in names:
        text = f'{name} = "{value}"'
        strong = secret_scan.name_score(name) and secret_scan.name_score(name) + secret_scan.literal_score(value) >= secret_scan.SCORE_LEAST
        assert (("literal", len(name) + 4, len(text) - 1) in secret_scan.scan(text)) == bool(strong), name


def test_unquoted_values_and_typed_declarations():
    def found(text):
        return [text[s:e] for k, s, e in secret_scan.scan(text) if k == "literal"]

    assert found("DB_PWD=Tr0ub4dor3xyz") == ["Tr0ub4dor3xyz"]
    assert found("client_credential: q8Zr-19xLmP0") == ["q8Zr-19xLmP0"]
    assert found("user: bob\n  db_passphrase: Tr0ub4dor&3xy # for tests\nport: 80") == ["Tr0ub4dor&3xy"]
    assert found("[db]\r\npwd = Tr0ub4dor&3xy\r\nhost = h\r\n") == ["Tr0ub4dor&3xy"]
    assert found("export DB_PWD=CorrectHorseBattery\n") == ["CorrectHorseBattery"]
    assert found("{user: bob, pwd: Tr0ub4dor3xyz, port: 80}") == ["Tr0ub4dor3xyz"]
    assert found("DB_PWD=a/b+Tr0ub4dor3==") == ["a/b+Tr0ub4dor3=="]
    assert found('KEEP = "Tr0ub4dor&3xy"\ndb_pwd = KEEP') == ["Tr0ub4dor&3xy"]
    for kind in ("string", "str", "Optional[str]", "string | null", "&'static str", "Map<String, String>", "String?"):
        assert found(f'let apiKey: {kind} = "q8Zr-19xLmP0"') == ["q8Zr-19xLmP0"], kind
    assert found('else: password = "Tr0ub4dor&3xy"') == ["Tr0ub4dor&3xy"]
    for code in ("password = getPassword(userName1)", "secretKey = config.secretKey", "pwd=os.environ[NAME_1]", "f(password=userPassword, token=nextToken)", "pwd = userPassword", "pwd: ${DB_PASSWORD_1}"):
        assert found(code) == [], code


def test_elements_subscripts_and_joined_literals():
    def found(text):
        return [text[s:e] for k, s, e in secret_scan.scan(text) if k == "literal"]

    value = "Tr0ub4dor&3xy"
    for text in (
        f"<password>{value}</password>",
        f'<db:password kind="x">\n  {value}\n</db:password>',
        f"<password><![CDATA[{value}]]></password>",
        f'<add key="DbPassword" value="{value}"/>',
        f"os.environ['DB_PASSWORD'] = '{value}'",
        f'config["db"]["password"] = "{value}"',
        f'db_password = """{value}"""',
        f"db_password = '''\n  {value}\n'''",
        f'db_password = b"{value}"',
        f"db_password: str = r'{value}'",
        f'KEEP = """{value}"""\ndb_password = KEEP',
    ):
        assert found(text) == [value], text
    assert found('db_password = "Tr0ub" + "4dor&3xy"') == ['Tr0ub" + "4dor&3xy']
    assert found('db_password = ("Tr0ub"\n "4dor&3xy")') == []
    assert found('db_password = "Tr0ub" \\\n    "4dor&3xy"; x = "Tr0ub4dor&3xy"') == ['Tr0ub" \\\n    "4dor&3xy']
    assert found('f(["password", "Tr0ub4dor&3xy"])\nx["password"] == "Tr0ub4dor&3xy"') == []
    assert found("<password>two words here</password><colour>Tr0ub4dor&3xy</colour>") == []
    assert found('password = """two words\nhere"""\ndb_password = ""') == []


def test_lexing_takes_time_in_proportion():
    for text in ('"""' * 20_000, "a='" + "\\'" * 30_000, "<a " * 20_000, "x=" + '"a"+' * 20_000, 'x="""' + " " * 50_000, "<a>" * 20_000, "'''\\''" * 10_000, '"a" ' * 20_000):
        begin = time.process_time()
        secret_scan.scan(text)
        assert time.process_time() - begin < 5, text[:20]


def test_secret_rows(odd, odd_rows, nothing):
    got = secret_scan.scan_secrets(odd).collect()
    assert Counter((r.doc_id, tuple(map(tuple, r.spans))) for r in got) == Counter((i, tuple(secret_scan.scan(t or ""))) for i, t in odd_rows)
    assert secret_scan.scan_secrets(nothing).collect() == []


def test_hex_runs_at_the_ends_of_rows(spark):
    rows = [(1, "z" + "a" * 15), (2, "a" * 15), (3, "f" * 16), (4, "x " + "0" * 16), (5, None), (6, "0" * 40)]
    got = {r.doc_id: len(r.spans) for r in secret_scan.scan_secrets(frame(spark, rows).coalesce(1)).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 0, 6: 1}


def test_redaction(spark):
    df = frame(spark, [(1, 'x password = "abcdefghijkl" y'), (2, "clean"), (3, None)])
    out = secret_scan.redact_documents(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: 'x [SECRET]" y', 2: "clean", 3: None}


def test_every_language_is_learnt(spark, monkeypatch):
    from pyspark.sql import functions as F

    names = [f"l{k:02}" for k in range(70)]
    rows = [(10 * k + i, f"{chr(0x4E00 + k)} " * 9, n) for k, n in enumerate(names) for i in range(1 + (k < 64))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    assert language_id.train(df, F.lit(True)).languages == names
    monkeypatch.setattr(language_id, "MODEL_BYTES", 69 * (4 << language_id.BITS))
    with pytest.raises(ValueError):
        language_id.train(df, F.lit(True))


def test_languages_on_held_out_rows(spark):
    rows = queries.op8_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark, odd, nothing):
    from pyspark.sql import functions as F

    texts = [(i, t) for i in range(60) for t in ("the cat and the dog", "le chat et le chien")]
    df = spark.createDataFrame([(k, t, t[:2]) for k, (_, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.train(df, F.lit(True))
    got = language_id.predict(frame(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "le chien et le chat"), (4, "the dog")]), model).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in got) == Counter({(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (4, "le"): 1, (4, "th"): 1})
    assert language_id.predict(nothing, model).collect() == []
    empty = language_id.train(nothing, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(odd, empty).collect()} == {"und"}


def slow_pieces(rows, size):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(BPE)
    out = []
    for i, t in rows:
        ids = tk.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
        out += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


@pytest.mark.parametrize("size", [1024, 37])
def test_packing(odd, odd_rows, nothing, size):
    got = packing.pack_documents(odd, BPE, size).collect()
    want = slow_pieces(odd_rows, size)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for runs in places.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= size
    assert len(places) <= 1.05 * sum(w[3] for w in want) / size + 1
    assert packing.pack_documents(nothing, BPE, size).collect() == []


def test_best_fit_is_best_fit_decreasing():
    r = random.Random(3)
    for _ in range(40):
        size = r.randint(5, 60)
        items = sorted((r.randint(1, size) for _ in range(r.randint(1, 300))), reverse=True)
        gaps = []
        for x in items:
            fit = min((g for g in gaps if g >= x), default=None)
            if fit is None:
                gaps.append(size - x)
            else:
                gaps[gaps.index(fit)] -= x
        plan = packing.best_fit(Counter(items).items(), size)
        assert 1 + max(p.sequence + -(-n // p.each) - 1 for p, n in counted(plan, Counter(items))) == len(gaps)


def counted(plan, counts):
    """Each run with the number of its pieces."""
    by = {}
    for p in plan:
        by.setdefault(p.length, []).append(p)
    for length, runs in by.items():
        runs.sort(key=lambda p: p.rank)
        for p, nxt in zip(runs, [*runs[1:], None], strict=True):
            yield p, (nxt.rank if nxt else counts[length]) - p.rank


def test_chunked_ids_are_the_librarys_ids():
    from tokenizers import Tokenizer

    tk, mine, r = Tokenizer.from_file(BPE), packing.ChunkTokenizer(BPE), random.Random(2)
    for letters in ("ab1 \n", "a \t\n.é'", " \n a ", "xy  \n's ", "a\u00a0 \u2003b", "<|endoftext|> "):
        for _ in range(400):
            s = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
            assert mine.ids(s) == np.array(tk.encode(s, add_special_tokens=False).ids, dtype="<u4").tobytes(), repr(s)


def test_ids_of_batches_and_other_vocabularies():
    import public_tokenizers
    from tokenizers import Tokenizer

    r = random.Random(8)
    words = [f"w{k}" for k in range(300)] + ["é\u00a0x", "a\nb", "\nc", "d\n", "", "\t", "don't", "漢字", "x" * 500, "\u0120"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 600))) for _ in range(60)] + ["", " ", "  ", "<|endoftext|> a b", " lead"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        want = [np.array(e.ids, dtype="<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        mine = packing.ChunkTokenizer(path)
        mine.memory.limit = 200  # met again and again
        assert mine.batch(texts) == want
        assert [mine.ids(t) for t in texts] == want


def test_plain_words_have_the_librarys_ids():
    """Every plain character after, before and between others, and mixtures of all kinds."""
    import re

    from tokenizers import Tokenizer

    tk, mine, r = Tokenizer.from_file(BPE), packing.ChunkTokenizer(BPE), random.Random(6)
    assert mine.fast is not None
    letters = [c for c in map(chr, range(33, 0x250)) if re.match(packing.PLAIN, c)]
    words = [a + c + b for c in letters for a in ("", "x", "9", "'", "é") for b in ("", "s", "7", "-", "Ž")]
    words += [a + b for a in letters[:94] for b in letters[:94]]
    words += ["".join(r.choices(letters if k % 2 else letters[:94], k=r.randint(1, 20))) for k in range(20_000)]
    words += [f"{w}{e}" for w in ("don", "I", "we", "DON") for e in ("'t", "'T", "'ll", "'ve", "'re", "'m", "'d", "'s", "''s")]
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in tk.encode_batch(texts, add_special_tokens=False)]
    assert mine.batch(texts) == want and mine.fast is not None
    mine.memory.clear()
    mine.fast = lambda text: [1]
    assert mine.batch(texts) == want and mine.fast is None


def test_units_keep_rows_in_order():
    from quillgrid.llm import _word_ids

    r = random.Random(1)
    rows = [(i, None if r.random() < 0.1 else "x" * r.choice((0, 5, 900_000, 9_000_000))) for i in range(40)]
    batches = [pa.RecordBatch.from_pydict({"i": [x[0] for x in rows[a : a + 7]], "t": [x[1] for x in rows[a : a + 7]]}) for a in range(0, 40, 7)]
    got = list(_word_ids.units(iter(batches), 1))
    assert [(i, t) for b in got for i, t in zip(b["i"].to_pylist(), b["t"].to_pylist(), strict=True)] == rows
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b["t"].to_pylist()) <= _word_ids.UNIT_BYTES for b in got)


def test_added_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    tk, mine, r = Tokenizer.from_file(BPE), packing.ChunkTokenizer(BPE), random.Random(4)
    added = [t.content for t in tk.get_added_tokens_decoder().values()]
    assert added
    for _ in range(400):
        s = "".join(r.choice([*added, "hi", " ", "x", "\n", "<|", "|>"]) for _ in range(r.randint(1, 10)))
        assert mine.ids(s) == np.array(tk.encode(s, add_special_tokens=False).ids, dtype="<u4").tobytes(), repr(s)


def test_pieces_agree_with_the_library(odd, odd_rows, nothing):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sentencepiece_codec.digest_documents(odd, PIECES).collect()
    want = Counter((i, len(ids := sp.encode(t or "")), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()) for i, t in odd_rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == want
    assert all(r.parity and r.round_trip for r in got)
    assert sentencepiece_codec.digest_documents(nothing, PIECES).collect() == []


def test_pieces_decode_again(spark):
    df = frame(spark, [(1, " a  b\n\tç 漢字 \x00 x "), (2, ""), (3, None), (4, "▁ mark")])
    ids = sentencepiece_codec.encode_documents(df, PIECES)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode_documents(ids, PIECES).collect()}
    assert back == {1: " a  b\n\tç 漢字 \x00 x ", 2: "", 3: "", 4: "  mark"}


def test_odd_pieces_against_the_library():
    import sentencepiece

    sp, mine, r = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepiece_codec.Codec(PIECES), random.Random(4)
    for letters in ("ab  ", "a \n\t", "é漢 ▁x", "  ", " <s>"):
        for _ in range(300):
            s = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
            ids, same = mine.encode([s])[0]
            assert same and np.frombuffer(ids, dtype="<u4").tolist() == sp.encode(s), repr(s)
