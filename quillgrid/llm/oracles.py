"""DuckDB SQL of the opN queries that SQL can express."""

from __future__ import annotations

from quillgrid.llm.quality_rules import BASE, RULES, STOP_WORDS, Rule
from quillgrid.llm.url_filter import UrlRule

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def url_sql(rules: list[UrlRule]) -> str:
    values = ", ".join(f"('{r.action}', '{r.host}', '{r.path}', '{r.text}')" for r in rules)
    return rf"""with rules(action, rhost, rpath, rule) as (values {values}),
cut as (select page_id, case when position('://' in coalesce(url, '')) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
fits as (select page_id, rule, action, row_number() over (partition by page_id order by length(rule) desc, action desc) as k from parts join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') as verdict from parts p left join fits f on f.page_id = p.page_id and f.k = 1"""


def _fails(r: Rule) -> str:
    tests = [f"100 * {r.numerator} < {r.low} * {r.denominator}"] * (r.low is not None) + [f"100 * {r.numerator} > {r.high} * {r.denominator}"] * (r.high is not None)
    return f"(({' or '.join(tests)}) and n_words >= {r.least})"


def quality_sql() -> str:
    stop = ", ".join(f"'{x}'" for w in STOP_WORDS for x in (w, w.capitalize()))
    return rf"""with w as (select doc_id, coalesce(text, '') as t, {WORDS} as w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
g as (select doc_id, p, w[p : p + 7] as gram from (select doc_id, w, unnest(range(1, len(w) - 6)) as p from w where len(w) >= 8)),
r as (select g.doc_id, g.p from g join (select doc_id, gram from g group by all having count(*) > 1) using (doc_id, gram)),
c as (select doc_id, count(distinct q) as n from (select doc_id, unnest(range(p, p + 8)) as q from r) group by doc_id),
m as (select w.doc_id, len(w) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars, cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, len(list_filter(w, lambda x: list_contains([{stop}], x))) as n_stop_words, coalesce(c.n, 0) as n_repeat_words, 1 as one from w left join c using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {" or ".join(_fails(r) for r in RULES if r.name in BASE)} as base_failed, not ({" or ".join(map(_fails, RULES))}) as kept from m"""


SUBSTRING_SQL = f"""with w as (select doc_id, {WORDS} as w from documents),
g as (select doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from w where len(w) >= 50)),
f as (select h, min(doc_id) as least from g group by h),
gone as (select distinct doc_id, unnest(range(p, p + 50)) as q from g join f using (h) where doc_id > least),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as q from w),
kept as (select doc_id, string_agg(word, ' ' order by q) as s from words anti join gone using (doc_id, q) group by doc_id)
select w.doc_id, len(w) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(s, '')) as kept_sha256 from w left join (select doc_id, count(*) as n from gone group by doc_id) using (doc_id) left join kept using (doc_id)"""

SUFFIX_SQL = """with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
g as (select doc_id, p, md5(substr(x, 2 * p + 1, 200)) as h from (select doc_id, x, unnest(range(0, length(x) // 2 - 99)) as p from d where length(x) >= 200)),
gone as (select doc_id, p from (select *, row_number() over (partition by h order by doc_id, p) as k from g) where k > 1),
runs as (select doc_id, p, sum(fresh) over (partition by doc_id order by p rows unbounded preceding) as run from (select *, case when p <= lag(p) over (partition by doc_id order by p) + 100 then 0 else 1 end as fresh from gone)),
spans as (select doc_id, min(p) as s, max(p) + 100 as e from runs group by doc_id, run),
bits as (select doc_id, e, substr(x, 2 * coalesce(lag(e) over (partition by doc_id order by s), 0) + 1, 2 * (s - coalesce(lag(e) over (partition by doc_id order by s), 0))) as part from spans join d using (doc_id)),
kept as (select doc_id, string_agg(part, '' order by e) as head, max(e) as e from bits group by doc_id),
sums as (select doc_id, sum(e - s) as n, count(*) as k from spans group by doc_id)
select d.doc_id, length(x) // 2 as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed, coalesce(k, 0) as n_spans, sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(e, 0) + 1))) as kept_sha256 from d left join sums using (doc_id) left join kept using (doc_id)"""
