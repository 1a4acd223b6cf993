"""The query catalogue: each operator over the layout tables, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgrid.functions import geometry as G
from quillgrid.functions import text as T
from quillgrid.functions import vocabulary as V
from quillgrid.functions.geometry import Rect
from quillgrid.operators import graph, greedy, registry, rollups, sequence, similarity, spatial
from quillgrid.plans.fixtures import table, with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(*tables: str, sql: str | None = None) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a function of the named tables under its own name."""

    def add(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(*(table(spark, sf_dir, t) for t in tables))

        QUERIES[fn.__name__] = run
        if sql is not None:
            from quillgrid.plans.fixtures import TABLES

            ORACLE_SQL[fn.__name__] = with_tables([t for t in tables if t in TABLES], sql)
        return fn

    return add


# Pieces of DuckDB SQL that several oracles share.
INTER = "greatest(0.0, least({a}x1, {b}x1) - greatest({a}x0, {b}x0)) * greatest(0.0, least({a}y1, {b}y1) - greatest({a}y0, {b}y0))".format
AREA = "greatest(0.0, {a}x1 - {a}x0) * greatest(0.0, {a}y1 - {a}y0)".format
SHARE = f"({INTER(a='b.', b='a.')}) / greatest({AREA(a='b.')}, 1e-9)"
IOU = f"({INTER(a='a.', b='b.')}) / ({AREA(a='a.')} + {AREA(a='b.')} - {INTER(a='a.', b='b.')})"
CLASS = "case area_type when 'window_area' then 'window' when 'door_area' then 'door' when 'garage_area' then 'garage_door' end"
MEETS = "a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1"
HELD = f"""hit as (select b.box_id, b.page, a.area_ord, a.area_type, {SHARE} as containment, {AREA(a="a.")} as size from boxes b join areas a on a.page = b.page where a.area_type != 'exclude'),
best as (select * from hit where containment >= 0.7 qualify row_number() over (partition by box_id order by size, area_ord) = 1)"""


def rx(column: str, pattern: str, flags: str = "i") -> str:
    return "regexp_matches({}, '{}', '{}')".format(column, pattern.replace("'", "''"), flags)


def handed_class(area_type: Column) -> Column:
    return T.looked_up(area_type, V.AREA_CLASS)


@query("boxes", "areas", sql=f", {HELD} select b.box_id, b.page, best.area_ord, best.containment, {CLASS} as cls, coalesce(area_type in ('mixed', 'unknown'), false) as cls_required from boxes b left join best using (box_id)")
def q01_smallest_container(boxes, areas):
    out = spatial.smallest_container(boxes, areas, "page", "box_id")
    return out.select("box_id", "page", "area_ord", "containment", handed_class(F.col("area_type")).alias("cls"), F.coalesce(F.col("area_type").isin("mixed", "unknown"), F.lit(False)).alias("cls_required"))


BUCKETS = f""", part as (select b.box_id, b.page, b.cls, a.page as r, {CLASS.replace("area_type", "a.area_type")} as rc, case when a.page is not null then {SHARE} end as part from boxes b left join areas a on a.page = b.page and a.area_type != 'exclude' where b.cls != ''),
got as (select box_id, page, cls, count(r) as n, max(part) as most, count(distinct coalesce(rc, '')) filter (part >= 0.7) as k, coalesce(bool_or(rc = cls) filter (part >= 0.7), false) as mine from part group by all),
buckets as (select box_id, page, cls, case when n = 0 then 'no_region' when k > 1 then case when mine then 'ambiguous' else 'wrong' end when k = 1 then case when mine then 'right' else 'wrong' end when most > 0.2 then 'too_small' else 'outside' end as bucket from got)"""


def _buckets(boxes: DataFrame, areas: DataFrame) -> DataFrame:
    regions = areas.where("area_type != 'exclude'").withColumn("cls", handed_class(F.col("area_type")))
    return spatial.coverage_buckets(boxes.where("cls != ''"), regions, "page", "box_id")


@query("boxes", "areas", sql=f"{BUCKETS} select page, bucket, count(*) as n, grouping(page) as over_all from buckets group by grouping sets ((page, bucket), (bucket))")
def q02_coverage_buckets(boxes, areas):
    got = _buckets(boxes, areas)
    return got.groupingSets([["page", "bucket"], ["bucket"]], "page", "bucket").agg(F.count("*").alias("n"), F.grouping("page").cast("long").alias("over_all"))


@query("boxes", sql=f", p as (select a.page, a.box_id as a_id, b.box_id as b_id, {IOU} as iou from boxes a join boxes b on a.page = b.page and a.box_id < b.box_id and {MEETS}) select * from p where iou >= 0.2")
def q03_iou_pairs(boxes):
    pairs = spatial.overlapping_pairs(boxes, "page", "box_id", 100.0)
    return pairs.select("page", F.col("a_box_id").alias("a_id"), F.col("b_box_id").alias("b_id"), G.iou(Rect.of("a_"), Rect.of("b_")).alias("iou")).where("iou >= 0.2")


@query("boxes")
def q04_suppress(boxes):
    return greedy.suppress(boxes, ["page"], "box_id", 0.3)


@query("boxes", sql=f", o as (select * from boxes) select a.page, a.box_id from boxes a where not exists (select 1 from o b where b.page = a.page and b.box_id != a.box_id and {AREA(a='b.')} > {AREA(a='a.')} and ({INTER(a='a.', b='b.')}) / greatest({AREA(a='a.')}, 1e-9) >= 0.85)")
def q05_drop_nested(boxes):
    return greedy.drop_nested(boxes, ["page"], "box_id").select("page", "box_id")


@query("boxes")
def q06_merge_boxes(boxes):
    return graph.merge_boxes(boxes, ["page"], "box_id")


@query(
    "boxes",
    sql=""", p as (select *, lag(x0) over w as px0, lag(y0) over w as py0, lag(x1) over w as px1, lag(y1) over w as py1 from boxes window w as (partition by page order by x0, box_id)),
f as (select *, case when coalesce(x0 - px1 >= 0 and x0 - px1 <= 0.15 * greatest(x1 - x0, px1 - px0) and abs((y1 - y0) - (py1 - py0)) <= 0.1 * greatest(y1 - y0, py1 - py0) and least(y1, py1) > greatest(y0, py0), false) then 0 else 1 end as fresh from p)
select page, box_id, cast(sum(fresh) over (partition by page order by x0, box_id rows unbounded preceding) as integer) as group_no from f""",
)
def q07_mullion_groups(boxes):
    return sequence.mullion_groups(boxes, ["page"], "box_id").select("page", "box_id", "group_no")


@query("boxes", sql=", g as (select page, box_id, x0 - (x1 - x0) * 0.07 as x0, y0 - (y1 - y0) * 0.07 as y0, x1 + (x1 - x0) * 0.07 as x1, y1 + (y1 - y0) * 0.07 as y1 from boxes), h as (select * from g) " + f"select a.page, a.box_id, count(b.box_id) as degree from g a left join h b on a.page = b.page and a.box_id != b.box_id and {MEETS} group by a.page, a.box_id")
def q08_overlap_degree(boxes):
    big = boxes.select("page", "box_id", *G.grown(Rect.of()).named())
    pairs = spatial.overlapping_pairs(big, "page", "box_id", 120.0)
    ends = pairs.select("page", F.explode(F.array("a_box_id", "b_box_id")).alias("box_id")).groupBy("page", "box_id").agg(F.count("*").alias("degree"))
    return boxes.select("page", "box_id").join(ends, ["page", "box_id"], "left").select("page", "box_id", F.coalesce("degree", F.lit(0)).alias("degree"))


@query(
    "boxes",
    "areas",
    sql=f""", c as (select b.box_id, a.area_ord, a.x0 as ax0, a.y0 as ay0, a.x1 - a.x0 as aw, a.y1 - a.y0 as ah, greatest(a.x0, b.x0) as x0, greatest(a.y0, b.y0) as y0, least(a.x1, b.x1) as x1, least(a.y1, b.y1) as y1, {AREA(a="b.")} as size, {INTER(a="b.", b="a.")} as got
from boxes b join areas a on a.page = b.page where a.area_type != 'exclude')
select box_id, area_ord, ((x0 + x1) / 2 - ax0) / aw as cx, ((y0 + y1) / 2 - ay0) / ah as cy, (x1 - x0) / aw as w, (y1 - y0) / ah as h from c where aw > 0 and ah > 0 and x1 > x0 and y1 > y0 and got >= 0.6 * size""",
)
def q09_crop_boxes(boxes, areas):
    a = areas.where("area_type != 'exclude'").select("page", "area_ord", *Rect.of().named("a_"))
    got = boxes.join(a, "page").withColumn("u", G.to_crop(Rect.of(), Rect.of("a_"))).where("u is not null")
    return got.select("box_id", "area_ord", "u.*")


@query("boxes", sql=" select box_id, concat_ws('|', case when least(x1 - x0, y1 - y0) < 24 then 'tiny' end, case when conf > 0 and conf < 0.35 then 'low_conf' end, case when (x1 - x0) / (y1 - y0) < 0.5 or (x1 - x0) / (y1 - y0) > 2 then 'extreme_aspect' end) as flags from boxes")
def q10_attention_flags(boxes):
    return boxes.select("box_id", F.array_join(G.attention_flags(Rect.of(), F.col("conf"), tiny=24.0, narrow=0.5, wide=2.0), "|").alias("flags"))


@query(
    "boxes",
    "areas",
    sql=f""", {HELD}, shut as (select distinct b.box_id from boxes b join areas a on a.page = b.page and a.area_type = 'exclude' where {SHARE} >= 0.7)
select case when s.box_id is not null then 'rejected' when least(x1 - x0, y1 - y0) >= 13 and best.area_ord is not null and best.area_type not in ('mixed', 'unknown') and conf >= 0.5 then 'accepted' else 'pending' end as state, count(*) as n from boxes b left join best using (box_id) left join shut s on s.box_id = b.box_id group by 1""",
)
def q11_seed_triage(boxes, areas):
    return registry.triage(boxes, areas, "page", "box_id").groupBy("state").agg(F.count("*").alias("n"))


def score_sql(t: str) -> str:
    return f"case when {t} = '' or len(string_split({t}, ' ')) > 9 or {rx(t, T.INDEX_PAGE)} then 0.0 when {rx(t, T.TITLE_TABLE)} then 1.0 when {rx(t, T.FOREIGN)} then 0.0 when {rx(t, T.TITLE_LEGEND)} then 1.0 when {rx(t, T.TITLE_IMPLIED)} or {rx(t, T.TITLE_WEAK)} then 0.35 else 0.0 end"


CATEGORY_SQL = f"case when {rx('title', T.HAS_GARAGE, 'c')} then 'garage_door' when {rx('title', T.HAS_WINDOW, 'c')} and {rx('title', T.HAS_DOOR, 'c')} then 'both' when {rx('title', T.HAS_WINDOW, 'c')} then 'window' when {rx('title', T.HAS_DOOR, 'c')} then 'door' else 'unknown' end"
KIND_SQL = rf"case when {rx('title', r'\bHARDWARE\b')} and not {rx('title', r'\bSCHEDULE\b')} then 'hardware' when {rx('title', r'\bNOTES?\b|ABBREVIATIONS?\b|\bKEY\b')} then 'notes' when {rx('title', rf'\b{V.LEGEND}\b')} then 'type_legend' when {rx('title', rf'\b{V.TABLE}\b')} then 'schedule' else 'unknown' end"


@query("titles", sql=f" select title_id, title, cast({score_sql('title')} as double) as score, {CATEGORY_SQL} as category, {KIND_SQL} as kind from titles")
def q12_title_scores(titles):
    t = F.col("title")
    return titles.select("title_id", "title", T.title_score(t).alias("score"), T.category_of(t).alias("category"), T.kind_of(t).alias("kind"))


@query("titles", sql=f", s as (select title_id, page % 10 + title_id % 7 * 10 as sheet, {score_sql('title')} as score, {CATEGORY_SQL} as category from titles), w as (select *, count(distinct category) filter (score = 1.0 and category != 'unknown') over (partition by sheet) as k, min(category) filter (score = 1.0 and category != 'unknown') over (partition by sheet) as c from s) select title_id, case when category = 'unknown' and score < 1.0 and score > 0 and k = 1 and c in ('door', 'window', 'garage_door') then c else category end as promoted from w".replace("count(distinct category) filter (score = 1.0 and category != 'unknown') over (partition by sheet)", "len(list_distinct(list(category) filter (score = 1.0 and category != 'unknown') over (partition by sheet)))"))
def q13_implied_titles(titles):
    t = F.col("title")
    s = titles.select("title_id", (F.col("page") % 10 + F.col("title_id") % 7 * 10).alias("sheet"), T.title_score(t).alias("score"), T.category_of(t).alias("category"))
    strong = s.where("score = 1.0 and category != 'unknown'").groupBy("sheet").agg(F.count_distinct("category").alias("k"), F.min("category").alias("c"))
    bare = (F.col("category") == "unknown") & (F.col("score") < 1.0) & (F.col("score") > 0) & (F.col("k") == 1) & F.col("c").isin("door", "window", "garage_door")
    return s.join(strong, "sheet", "left").select("title_id", F.when(bare, F.col("c")).otherwise(F.col("category")).alias("promoted"))


@query(
    "titles",
    sql=f""", s as (select page, size, x0, {score_sql("title")} as score, {CATEGORY_SQL} as category from titles where size >= 11),
p as (select page, max(score) as best, bool_or(x0 >= 1700 and score > 0) as edge, bool_or(score > 0 and category != 'unknown') as ours, count(*) filter (score > 0) as n, page % 7 = 0 as toc from s group by page)
select page, cast(case when n > 0 and not ours then 0 else least(0.75, case when best >= 1 then 0.6 when best > 0 then 0.3 else 0 end + case when edge then 0.15 else 0 end) + case when toc then 0.5 else 0 end end as double) as score from p""",
)
def q14_page_scores(titles):
    t = F.col("title")
    s = titles.where("size >= 11").select("page", "x0", T.title_score(t).alias("score"), T.category_of(t).alias("category"))
    p = s.groupBy("page").agg(F.max("score").alias("best"), F.bool_or((F.col("x0") >= 1700) & (F.col("score") > 0)).alias("edge"), F.bool_or((F.col("score") > 0) & (F.col("category") != "unknown")).alias("ours"), F.count_if(F.col("score") > 0).alias("n"))
    d = lambda x: F.lit(x).cast("decimal(4,2)")
    signal = F.least(d("0.75"), F.when(F.col("best") >= 1, d("0.6")).when(F.col("best") > 0, d("0.3")).otherwise(d("0")) + F.when(F.col("edge"), d("0.15")).otherwise(d("0")))
    score = F.when((F.col("n") > 0) & ~F.col("ours"), d("0")).otherwise(signal + F.when(F.col("page") % 7 == 0, d("0.5")).otherwise(d("0")))
    return p.select("page", score.cast("double").alias("score"))


HEADERS = "[" + ", ".join(f"'{w}'" for w in V.HEADER_WORDS) + "]"
SHARED = "[" + ", ".join(f"'{w}'" for w in V.SHARED_HEADER_WORDS) + "]"


@query("titles", sql=f", t as (select title_id, y0, list_distinct(list_transform(string_split(title, ' '), lambda w: trim(upper(w), ' :.,()[]'))) as tokens from titles), h as (select title_id, cast(floor(y0 / 5) as bigint) as bin, list_intersect(tokens, {HEADERS}) as hits from t) select title_id, bin, len(hits) as total, len(list_filter(hits, lambda h: not list_contains({SHARED}, h))) as clear from h")
def q15_header_bins(titles):
    got = titles.select("title_id", F.floor(F.col("y0") / 5).alias("bin"), T.header_strength(F.split("title", " ")).alias("h"))
    return got.select("title_id", "bin", F.col("h.total").cast("long").alias("total"), F.col("h.unambiguous").cast("long").alias("clear"))


@query("lines", sql=", c as (select page, size, sum(length(text)) as weight, min(line_no) as first from lines group by page, size) select page, arg_min(size, (-weight, first)) as mode_size from (select page, size, cast(weight as bigint) as weight, first from c) group by page".replace("arg_min(size, (-weight, first))", "first(size order by weight desc, first, size)"))
def q16_font_mode(lines):
    c = lines.groupBy("page", "size").agg(F.sum(F.length("text")).alias("weight"), F.min("line_no").alias("first"))
    return c.groupBy("page").agg(F.max_by("size", F.struct(F.col("weight"), -F.col("first"), -F.col("size"))).alias("mode_size"))


@query("words", sql=" select page, word_id, row_number() over (partition by page order by round(y0, 1), x0, word_id) - 1 as ord from words")
def q17_reading_order(words):
    w = Window.partitionBy("page").orderBy(F.round("y0", 1), "x0", "word_id")
    return words.select("page", "word_id", (F.row_number().over(w) - 1).cast("long").alias("ord"))


@query("words", sql=", g as (select *, case when y0 - lag(y0) over (partition by page order by y0, word_id) > 6 then 1 else 0 end as fresh from words) select page, word_id, cast(sum(fresh) over (partition by page order by y0, word_id rows unbounded preceding) as integer) as row_no from g")
def q18_row_sessions(words):
    return sequence.sessions(words, ["page"], "y0", 6.0, ["word_id"], "row_no").select("page", "word_id", "row_no")


@query("words", sql=", g as (select page, cast(floor(y0 / 100) as bigint) as band, max(x1) over (partition by page, floor(y0 / 100) order by x0, x1 rows between unbounded preceding and 1 preceding) as g0, x0 as g1 from words) select page, band, g0, g1, (g0 + g1) / 2 as middle from g where g1 - g0 >= 4")
def q19_gutters(words):
    return sequence.gutters(words.withColumn("band", F.floor(F.col("y0") / 100)), ["page", "band"])


@query(
    "lineitem",
    sql=""" , c as (select l_orderkey % 500 as t, l_linenumber % 3 as tier, l_orderkey // 500 as col, max(case when l_partkey % 3 = 0 then upper(l_returnflag) else '' end) as text from lineitem group by 1, 2, 3),
f as (select *, max(tier) over (partition by t) as lastt, last_value(nullif(text, '') ignore nulls) over (partition by t, tier order by col rows between unbounded preceding and current row) as fill from c),
g as (select t, col, list(case when tier = lastt then nullif(text, '') else fill end order by tier) as parts from f group by t, col),
h as (select t, col, list_filter(parts, lambda p: p is not null) as parts from g)
select t, col, coalesce(nullif(array_to_string(list_filter(parts, lambda p, i: i = 1 or p != parts[i - 1]), '.'), ''), 'col' || col) as name from h""".replace(" , c as", "with c as", 1),
)
def q20_header_tiers(lineitem):
    cells = lineitem.select((F.col("l_orderkey") % 500).alias("t"), (F.col("l_linenumber") % 3).alias("tier"), F.floor(F.col("l_orderkey") / 500).alias("col"), F.when(F.col("l_partkey") % 3 == 0, F.upper("l_returnflag")).otherwise("").alias("text"))
    return sequence.header_names(cells.groupBy("t", "tier", "col").agg(F.max("text").alias("text")), ["t"])


def expanded_sql(col: str, table: dict[str, str]) -> str:
    names = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"
    return rf"array_to_string(list_transform(regexp_extract_all(regexp_replace(upper({col}), '\b([A-Z])\.([A-Z])\.(?:([A-Z])\.)?', '\1\2\3', 'g'), '\w+|\W+'), lambda t: coalesce({names}[trim(t, '.')], t)), '')"


def first_sql(rules: list[tuple[str, str]]) -> str:
    def one(p: str, v: str) -> str:
        if "(?!" in p:  # no look-ahead: strike out what it forbids, then search
            return rf"when regexp_matches(regexp_replace(body, '\bFLUSH\s+(?:WITH|TO|AGAINST|MOUNT)', '', 'g'), '\bFLUSH\b', 'i') then '{v}'"
        return f"when {rx('body', p)} then '{v}'"

    return "case " + " ".join(one(p, v) for p, v in rules) + " end"


def all_sql(rules: list[tuple[str, str]]) -> str:
    return "concat_ws('|', " + ", ".join(f"case when {rx('body', p)} then '{v}' end" for p, v in sorted(rules, key=lambda r: r[1])) + ")"


@query(
    "specs",
    sql=f""", e as (select *, {expanded_sql("spec", V.ABBREVIATIONS)} || case when type_code != '' then ' ' || {expanded_sql("type_code", V.ABBREVIATIONS | V.CODE_ABBREVIATIONS)} else '' end as body from specs),
f as (select *, {first_sql(V.CATEGORY)} as own, {first_sql(V.OPERATION)} as operation, {first_sql(V.LEAF_FACE)} as leaf_face, {first_sql(V.MATERIAL)} as material, {all_sql(V.GLAZING)} as glazing, {all_sql(V.FLAGS)} as flags, cast(nullif(regexp_extract(body, '{V.FIRE_RATING}', 1, 'i'), '') as integer) as fire_rating_min from e),
g as (select *, coalesce(own, case when block_category in ('window', 'door', 'garage_door') then block_category end) as category, case when own is null and block_category in ('window', 'door', 'garage_door') then 'block_title' else 'lexicon' end as mapped_by from f)
select item_id, category, operation, leaf_face, material, glazing, fire_rating_min, flags, mapped_by, category is null or (category not in ('louver', 'shutter', 'grille', 'skylight') and operation is null and leaf_face is null) as needs_review from g""",
)
def q21_facets(specs):
    c = specs.select("item_id", T.classify(F.col("spec"), F.col("block_category"), F.col("type_code")).alias("c"))
    c = c.select("item_id", "c.*")
    return c.withColumns({"glazing": F.array_join("glazing", "|"), "flags": F.array_join("flags", "|")})


@query(
    "dims",
    sql=r""" select item_id, dim, case when dim = '' or regexp_matches(dim, 'VARIES', 'i') then null
when regexp_matches(dim, '\d+\s*''') then cast(regexp_extract(dim, '(\d+)\s*''\s*-?\s*(\d+)?', 1) as double) * 12 + coalesce(try_cast(nullif(regexp_extract(dim, '(\d+)\s*''\s*-?\s*(\d+)?', 2), '') as double), 0)
when regexp_matches(dim, '^\s*\d{1,2}\s*/\s*\d{1,2}\s*$') and cast(regexp_extract(dim, '/\s*(\d+)', 1) as double) < 12 then cast(regexp_extract(dim, '(\d+)\s*/', 1) as double) * 12 + cast(regexp_extract(dim, '/\s*(\d+)', 1) as double)
when regexp_matches(dim, '^\s*\d+(\.\d+)?\s*"?\s*$') then cast(regexp_extract(dim, '(\d+(?:\.\d+)?)', 1) as double) end as inches from dims""",
)
def q22_to_inches(dims):
    return dims.select("item_id", "dim", T.to_inches(F.col("dim")).alias("inches"))


@query("specs", "lineitem")
def q23_type_summary(specs, lineitem):
    kinds = specs.select("item_id", T.classify(F.col("spec"), F.col("block_category"), F.col("type_code")).alias("c")).select("item_id", "c.category", "c.operation", "c.leaf_face", "c.material")
    items = lineitem.select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("project"))
    got = items.join(kinds, "item_id").groupBy("category", "operation", "leaf_face", "material")
    return got.agg(F.count("*").alias("n"), F.count_distinct("project").alias("projects"))


def _summary_sql() -> str:
    body = ORACLE_SQL["q21_facets"]
    return f"with k as ({body}) select category, operation, leaf_face, material, count(*) as n, count(distinct l_suppkey) as projects from lineitem join k on l_partkey = item_id group by all"


ORACLE_SQL["q23_type_summary"] = _summary_sql()


@query("lineitem", "part", "orders", sql="select l_orderkey, l_linenumber, p_name as block_title, coalesce(o_orderpriority, '') as sheet_name, concat_ws('|', p_brand, p_type) as specs, case when l_returnflag = 'R' then 1 else 0 end as needs_review from lineitem left join part on p_partkey = l_partkey left join orders on o_orderkey = l_orderkey")
def q24_takeoff_rows(lineitem, part, orders):
    items = lineitem.join(part, F.col("p_partkey") == F.col("l_partkey"), "left").join(orders, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return items.select("l_orderkey", "l_linenumber", F.col("p_name").alias("block_title"), F.coalesce("o_orderpriority", F.lit("")).alias("sheet_name"), F.concat_ws("|", "p_brand", "p_type").alias("specs"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("needs_review"))


LEGEND_ORDER = ["both", "door", "window", "garage_door"]


@query(
    "specs",
    "titles",
    sql=f""", l as (select {CATEGORY_SQL} as category, title_id % 40 as code, title, title_id from titles), m as (select category, code, last(title order by title_id) as caption from l group by category, code),
r as (select s.item_id, m.caption, case when m.category = s.block_category then 0 when m.category = 'both' then 1 when m.category = 'door' then 2 when m.category = 'window' then 3 when m.category = 'garage_door' then 4 end as rank from specs s join m on m.code = s.item_id % 40)
select s.item_id, b.caption from specs s left join (select item_id, first(caption order by rank) as caption from r where rank is not null group by item_id) b using (item_id)""",
)
def q25_legend_captions(specs, titles):
    legend = titles.groupBy(T.category_of(F.col("title")).alias("category"), (F.col("title_id") % 40).alias("code")).agg(F.max_by("title", "title_id").alias("caption"))
    rank = F.when(F.col("category") == F.col("block_category"), 0)
    for i, c in enumerate(LEGEND_ORDER, 1):
        rank = rank.when(F.col("category") == c, i)
    met = specs.join(legend, F.col("item_id") % 40 == F.col("code")).withColumn("rank", rank).where("rank is not null")
    return specs.select("item_id").join(met.groupBy("item_id").agg(F.min_by("caption", "rank").alias("caption")), "item_id", "left")


@query(
    "titles",
    "comps",
    sql=""", p as (select t.title_id, c.comp_id, c.y0, c.x0 from titles t join comps c on c.page = t.page where c.y0 - t.y1 > 1 and c.y0 - t.y1 <= 200 and abs((c.x0 + c.x1) / 2 - (t.x0 + t.x1) / 2) <= 300)
select t.title_id, b.comp_id as below from titles t left join (select title_id, first(comp_id order by y0, x0, comp_id) as comp_id from p group by title_id) b using (title_id)""",
)
def q26_nearest_below(titles, comps):
    low = comps.withColumnRenamed("comp_id", "id").drop("page_h")
    return spatial.nearest_below(titles, low, "page", "title_id", 1.0, 200.0, 300.0).select("title_id", F.col("l_id").alias("below"))


@query(
    "comps",
    "words",
    sql=""", p as (select c.comp_id, w.word_id, c.y0 - w.y1 as gap from comps c join words w on w.page = c.page where c.y0 - w.y1 >= 0 and c.y0 - w.y1 <= 260 and abs((w.x0 + w.x1) / 2 - (c.x0 + c.x1) / 2) <= greatest((c.x1 - c.x0) * 0.75, 60))
select c.comp_id, b.word_id as above from comps c left join (select comp_id, first(word_id order by gap, word_id) as word_id from p group by comp_id) b using (comp_id)""",
)
def q27_nearest_above(comps, words):
    marks = words.withColumnRenamed("word_id", "id").drop("text")
    return spatial.nearest_above(comps, marks, "page", "comp_id").select("comp_id", F.col("m_id").alias("above"))


@query(
    "comps",
    "titles",
    sql=""", p as (select c.comp_id, c.page, t.title_id, (c.x0 + c.x1) / 2 as ccx, (t.x0 + t.x1) / 2 as tcx, t.y0 as ty0, t.y1 as ty1,
greatest(0.0, greatest(t.x0 - c.x1, c.x0 - t.x1)) + greatest(0.0, greatest(t.y0 - c.y1, c.y0 - t.y1)) + abs(c.x0 - t.x0) * 0.8 as cost, (c.y0 + c.y1) / 2 >= (t.y0 + t.y1) / 2 or t.y0 >= 0.65 * c.page_h as fits from comps c join titles t on t.page = c.page),
f as (select * from p where cost < 1500 and fits and not exists (select 1 from titles v where v.page = p.page and v.title_id != p.title_id and v.y0 < p.ty1 and p.ty0 < v.y1 and (v.x0 + v.x1) / 2 > least(ccx, tcx) and (v.x0 + v.x1) / 2 < greatest(ccx, tcx)))
select c.comp_id, b.title_id from comps c left join (select comp_id, first(title_id order by cost, title_id) as title_id from f group by comp_id) b using (comp_id)""",
)
def q28_min_cost_titles(comps, titles):
    return spatial.assign_by_cost(comps, titles, "page").select("comp_id", "title_id")


@query("words", "comps", sql=", p as (select c.comp_id as row_id, w.x0, w.word_id, w.text from words w join comps c on c.page = w.page where w.x0 >= c.x1 and (w.y0 + w.y1) / 2 >= c.y0 and (w.y0 + w.y1) / 2 < c.y1) select row_id, string_agg(text, ' ' order by x0, word_id) as tail from p group by row_id")
def q29_row_tails(words, comps):
    return spatial.row_tails(words, comps.withColumnRenamed("comp_id", "row_id"), "page").select("row_id", "tail")


@query("words", "areas", sql=", p as (select w.word_id, w.page, a.area_ord from words w join areas a on a.page = w.page where a.x0 <= w.x0 and a.y0 <= w.y0 and a.x1 >= w.x1 and a.y1 >= w.y1) select page, area_ord as block_id, count(*) as words from p group by all having count(*) >= 5")
def q30_words_in_blocks(words, areas):
    got = spatial.contained_words(words, areas.withColumnRenamed("area_ord", "block_id"), "page")
    return got.groupBy("page", "block_id").agg(F.count("*").alias("words")).where("words >= 5")


TOKENS = "list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda w: length(w) >= 3)))"


@query(
    "documents",
    sql=f"with s as (select doc_id, {TOKENS} as t from documents), p as (select a.doc_id as a, b.doc_id as b, len(list_intersect(a.t, b.t)) as k, len(a.t) as n, len(b.t) as m from s a join s b on a.doc_id < b.doc_id and len(a.t) > 0 and least(len(a.t), len(b.t)) >= 0.95 * greatest(len(a.t), len(b.t))) select a, b from p where k / (n + m - k) >= 0.95",
)
def q31_similar_pairs(documents):
    sets = similarity.word_sets(documents, "doc_id", "text")
    return similarity.jaccard_pairs(sets, "doc_id").select("a", "b")


@query("documents")
def q32_keep_first(documents):
    spark = documents.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillgrid-"))  # only where the session names none
    pairs = similarity.jaccard_pairs(similarity.word_sets(documents, "doc_id", "text"), "doc_id").checkpoint()
    return similarity.keep_first(pairs, similarity.components(pairs))


@query("documents", sql="select source, ('0x' || substr(sha256(source), 1, 2))::int % 5 = 4 as val, count(*) as docs from documents group by all")
def q33_hash_split(documents):
    return documents.groupBy("source", T.is_val(F.col("source")).alias("val")).agg(F.count("*").alias("docs"))


@query("boxes", sql=" select case when page % 5 = 4 then 'val' else 'train' end as split, cls, count(*) as n, count(distinct page) as pages, grouping(split) as g_split, grouping(cls) as g_cls from boxes group by cube (split, cls)".replace("select case when page % 5 = 4 then 'val' else 'train' end as split, cls,", "select split, cls,").replace("from boxes", "from (select *, case when page % 5 = 4 then 'val' else 'train' end as split from boxes)"))
def q34_split_report(boxes):
    got = boxes.withColumn("split", F.when(F.col("page") % 5 == 4, "val").otherwise("train")).cube("split", "cls")
    return got.agg(F.count("*").alias("n"), F.count_distinct("page").alias("pages"), F.grouping("split").cast("long").alias("g_split"), F.grouping("cls").cast("long").alias("g_cls"))


@query("boxes", sql=", n as (select box_id, (x1 - x0) * (y1 - y0) as size, row_number() over (order by (x1 - x0) * (y1 - y0) desc, box_id) as k from boxes where cls = '') select box_id, size from n where k <= (select cast(floor(count(*) * 0.15 / 0.85) as bigint) from boxes where cls = 'window')")
def q35_hard_negatives(boxes):
    keep = boxes.where("cls = 'window'").agg(F.floor(F.count("*") * 0.15 / 0.85).alias("n")).first().n
    return boxes.where("cls = ''").select("box_id", G.area(Rect.of()).alias("size")).orderBy(F.desc("size"), "box_id").limit(keep)


@query(
    "labels",
    "documents",
    sql="""with s as (select source, quality, l.doc_id, ((l.doc_id * 7919) % 1000) as conf from labels l join documents d using (doc_id)),
r as (select *, row_number() over w as k, sum(quality) over (partition by source order by conf desc, doc_id rows unbounded preceding) as tp, sum(quality) over (partition by source) as n from s window w as (partition by source order by conf desc, doc_id)),
p as (select *, tp / n as recall, tp / k as prec from r where n > 0),
e as (select *, max(prec) over (partition by source order by k rows between current row and unbounded following) as env, recall - coalesce(lag(recall) over (partition by source order by k), 0) as step from p)
select source, cast(max(n) as bigint) as n_truth, count(*) as n_pred, floor(sum(step * env) * 1e6 + 0.5) as ap_millionths from e group by source""",
)
def q36_average_precision(labels, documents):
    s = labels.join(documents.select("doc_id", "source"), "doc_id").select("source", "doc_id", (F.col("quality") == 1).alias("hit"), ((F.col("doc_id") * 7919) % 1000).alias("conf"))
    truths = s.groupBy("source").agg(F.count_if("hit").alias("n_truth")).where("n_truth > 0")
    ap = sequence.average_precision(s, truths, ["source"], "doc_id")
    return ap.select("source", "n_truth", "n_pred", F.floor(F.col("ap") * 1e6 + 0.5).cast("double").alias("ap_millionths"))


def _truths(boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    preds = boxes.where("cls in ('door', 'window')").withColumnRenamed("box_id", "pred_id")
    shift = F.when(F.col("box_id") % 2 == 0, 3.0).otherwise(-3.0)
    truths = boxes.where("cls in ('door', 'window') and box_id % 3 = 0").withColumns({"x0": F.col("x0") + shift, "x1": F.col("x1") + shift}).withColumnRenamed("box_id", "truth_id")
    return preds, truths


@query("boxes")
def q37_match_truths(boxes):
    return greedy.match_truths(*_truths(boxes), ["page"])


@query("boxes", sql=", c as (select page, count(*) filter (cls = 'door') as truth, count(*) filter (cls = 'window') as pred from boxes group by page) select count(*) as areas, count(*) filter (truth = pred) as exact, count(*) filter (abs(truth - pred) <= 1) as within_one from c")
def q38_count_rates(boxes):
    c = boxes.groupBy("page").agg(F.count_if(F.col("cls") == "door").alias("truth"), F.count_if(F.col("cls") == "window").alias("pred"))
    return c.agg(F.count("*").alias("areas"), F.count_if(F.col("truth") == F.col("pred")).alias("exact"), F.count_if(F.abs(F.col("truth") - F.col("pred")) <= 1).alias("within_one"))


PROGRESS = "count(*) as openings, count(*) filter (conf < 0.35) as flagged, count(*) filter (cls = '') as unknown"


@query("boxes", sql=f" select page, {PROGRESS}, count(*) filter (conf < 0.35) * 10 + count(*) filter (cls = '') * 30 + count(*) * 2 as difficulty_tenths, grouping(page) as total from boxes group by grouping sets ((page), ())")
def q39_progress(boxes):
    got = boxes.rollup("page").agg(F.count("*").alias("openings"), F.count_if(F.col("conf") < 0.35).alias("flagged"), F.count_if(F.col("cls") == "").alias("unknown"), F.grouping("page").cast("long").alias("total"))
    return got.withColumn("difficulty_tenths", F.col("flagged") * 10 + F.col("unknown") * 30 + F.col("openings") * 2)


@query("boxes", sql=" select page % 10 as planset, page, count(*) as boxes, count(*) filter (cls = 'door') as doors, count(*) filter (cls = 'window') as windows, grouping(planset) + grouping(page) as level from boxes group by rollup (planset, page)".replace("select page % 10 as planset,", "select planset,").replace("from boxes", "from (select *, page % 10 as planset from boxes)"))
def q40_library(boxes):
    got = boxes.withColumn("planset", F.col("page") % 10).rollup("planset", "page")
    return got.agg(F.count("*").alias("boxes"), F.count_if(F.col("cls") == "door").alias("doors"), F.count_if(F.col("cls") == "window").alias("windows"), (F.grouping("planset") + F.grouping("page")).cast("long").alias("level"))


@query("boxes")
def q41_merge_snapshots(boxes):
    old = boxes.where("box_id % 4 != 0").select("page", F.col("box_id").alias("old_id"), "x0", "y0", "x1", "y1", (F.col("box_id") % 11 == 0).alias("edited"))
    new = boxes.where("box_id % 5 != 0").select("page", F.col("box_id").alias("new_id"), (F.col("x0") + 2).alias("x0"), "y0", (F.col("x1") + 2).alias("x1"), "y1")
    return registry.merge_snapshots(old, new, ["page"], F.col("page") % 2 == 0)


@query("revisions", sql=", l as (select sheet_key, last(op order by rev) as op from revisions group by sheet_key), s as (select distinct sheet_key from revisions union select distinct cast(page as varchar(20)) from (select user_id as page from events)) select sheet_key from s where not exists (select 1 from l where l.sheet_key = s.sheet_key)")
def q42_seed_new(revisions):
    return revisions


def _q42(spark: SparkSession, sf_dir: str) -> DataFrame:
    revisions = table(spark, sf_dir, "revisions")
    sheets = revisions.select("sheet_key").union(table(spark, sf_dir, "events").select(F.col("user_id").cast("string"))).distinct()
    dead = revisions.groupBy("sheet_key").agg(F.max_by("op", "rev").alias("op")).where("op = 'delete'")
    return registry.to_seed(sheets, registry.latest(revisions), dead)


QUERIES["q42_seed_new"] = _q42


@query("revisions", sql=" select sheet_key, last(rev order by rev) as rev, last(op order by rev) as op, cast(last(payload order by rev) as bigint) as payload from revisions group by sheet_key having last(op order by rev) != 'delete'")
def q43_latest_revision(revisions):
    return registry.latest(revisions).select("sheet_key", "rev", "op", F.col("payload").cast("long").alias("payload"))


@query("documents", sql="with f as (select source, count(*) as pages, count(*) filter (length(trim(text)) >= 200) as text_pages, sum(length(text)) as chars from documents group by source) select source, pages, text_pages, case when pages = 0 then 'truncated' when text_pages * 10 >= pages then 'ok' else 'no_text_layer' end as health, cast(chars as bigint) as chars from f")
def q44_triage(documents):
    f = documents.groupBy("source").agg(F.count("*").alias("pages"), F.count_if(F.length(F.trim("text")) >= 200).alias("text_pages"), F.sum(F.length("text")).alias("chars"))
    return f.select("source", "pages", "text_pages", F.when(F.col("pages") == 0, "truncated").when(F.col("text_pages") * 10 >= F.col("pages"), "ok").otherwise("no_text_layer").alias("health"), "chars")


@query("labels", "documents", sql="select 'label_without_document' as problem, count(*) as n from labels l where not exists (select 1 from documents d where d.doc_id = l.doc_id) union all select 'document_without_label', count(*) from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id) union all select 'out_of_range', count(*) from labels where quality not in (0, 1) or toxic not in (0, 1)")
def q45_integrity(labels, documents):
    ends = labels.select("doc_id", F.lit(1).alias("l")).join(documents.select("doc_id", F.lit(1).alias("d")), "doc_id", "full_outer")
    n = ends.agg(F.count_if(F.col("d").isNull()).alias("label_without_document"), F.count_if(F.col("l").isNull()).alias("document_without_label"))
    bad = labels.agg(F.count_if(~F.col("quality").isin(0, 1) | ~F.col("toxic").isin(0, 1)).alias("n")).select(F.lit("out_of_range").alias("problem"), "n")
    return n.unpivot([], ["label_without_document", "document_without_label"], "problem", "n").unionByName(bad)


@query("boxes")
def q46_negative_pages(boxes):
    pages = boxes.select("page", (F.col("page") % 10).alias("planset")).distinct()
    positive = boxes.where("cls = 'garage_door' and conf > 0.95").select("page").distinct()
    n = positive.count()
    free = registry.rank_first(pages.join(positive, "page", "left_anti"), ["planset"], [F.sha2(F.col("page").cast("string"), 256)], 4)
    return free.orderBy(F.sha2(F.col("page").cast("string"), 256)).limit(int(1.5 * n))


@query("boxes", sql=" select row_number() over (order by page, box_id) as id, page as image_id, case cls when 'window' then 1 else 2 end as category_id, x0 as bx, y0 as by_, x1 - x0 as bw, y1 - y0 as bh from boxes where cls != ''")
def q47_coco_rows(boxes):
    from quillgrid.sources.sinks import coco_annotations

    return coco_annotations(boxes.where("cls != ''"))


@query("documents", sql=f"select doc_id, len({TOKENS}) as n_tokens, md5(array_to_string({TOKENS}, ' ')) as fingerprint from documents")
def q48_word_sets(documents):
    sets = similarity.word_sets(documents, "doc_id", "text")
    return sets.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join("tokens", " ").cast("binary")).alias("fingerprint"))


@query("documents", sql="with f as (select source, count(*) as pages, case when count(*) filter (length(trim(text)) >= 200) * 10 >= count(*) then 'ok' else 'no_text_layer' end as health, coalesce(bool_or(lang is null), false) as rotated from documents group by source) select health, count(*) as files, cast(sum(pages) as bigint) as pages, count(*) filter (rotated) as rotated, grouping(health) as total from f group by grouping sets ((health), ())")
def q49_corpus_summary(documents):
    """Sources are files; one with a text of no language stands for a file with a turned page."""
    texts = F.count_if(F.length(F.trim("text")) >= 200)
    files = documents.groupBy(F.col("source").alias("file")).agg(F.count("*").alias("pages"), F.when(texts * 10 >= F.count("*"), "ok").otherwise("no_text_layer").alias("health"), F.bool_or(F.col("lang").isNull()).alias("rotated"))
    return rollups.corpus_summary(files)


def _planset_counts(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Customers are plansets, their orders blocks on sheets by priority, lines items."""
    blocks = orders.select(F.col("o_custkey").alias("planset"), "o_orderkey", "o_orderpriority")
    items = lineitem.join(blocks, F.col("l_orderkey") == F.col("o_orderkey")).select("planset", (F.col("l_returnflag") == "R").alias("needs_review"))
    sheets = blocks.select("planset", "o_orderpriority").distinct()
    return rollups.planset_counts(customer.select(F.col("c_custkey").alias("planset")), sheets, blocks, items)


PLANSETS = """b as (select o_custkey as planset, count(*) as blocks, count(distinct o_orderpriority) + max(case when o_orderpriority is null then 1 else 0 end) as sheets from orders group by all),
i as (select o_custkey as planset, count(*) as items, count(*) filter (l_returnflag = 'R') as review from lineitem join orders on l_orderkey = o_orderkey group by all),
p as (select c_custkey as planset, coalesce(sheets, 0) as schedule_sheets, coalesce(blocks, 0) as blocks, coalesce(items, 0) as items, coalesce(review, 0) as needs_review from customer left join b on b.planset = c_custkey left join i on i.planset = c_custkey)"""


@query("customer", "orders", "lineitem", sql=f"with {PLANSETS} select planset, cast(schedule_sheets as bigint) as schedule_sheets, blocks, items, needs_review from p")
def q50_planset_counts(customer, orders, lineitem):
    return _planset_counts(customer, orders, lineitem)


@query("customer", "orders", "lineitem", sql=f"with {PLANSETS} select count(*) as plansets, count(*) filter (items > 0) as with_items, cast(sum(items) as bigint) as items, cast(sum(needs_review) as bigint) as needs_review, sum(needs_review) / nullif(sum(items), 0) as review_share from p")
def q51_extract_report(customer, orders, lineitem):
    return rollups.extract_report(_planset_counts(customer, orders, lineitem))


@query("boxes", "areas", sql=f", {HELD}, o as (select b.page, best.box_id is not null as in_block, case when b.cls = 'door' then 'sheet' else 'block' end as source from boxes b left join best using (box_id)) select page, count(*) as openings, count(*) filter (in_block) as in_block, count(*) filter (not in_block) as outside, count(*) filter (source = 'sheet') as by_sheet, count(*) filter (source = 'block') as by_block, grouping(page) as total from o group by grouping sets ((page), ())")
def q52_detection_summary(boxes, areas):
    held = q01_smallest_container(boxes, areas).select("box_id", F.col("area_ord").isNotNull().alias("in_block"))
    openings = boxes.select("box_id", "page", F.when(F.col("cls") == "door", "sheet").otherwise("block").alias("source")).join(held, "box_id")
    return rollups.detection_summary(openings)


@query("titles", sql=f", b as (select page, title_id, {CATEGORY_SQL} as category, {KIND_SQL} as kind, case when title_id % 2 = 0 then 'tabular' else 'pictorial' end as genre from titles) select b.page, b.category, title_id from b where kind = 'type_legend' and not exists (select 1 from b s where s.page = b.page and s.category = b.category and s.kind = 'schedule' and s.genre = 'tabular')")
def q53_legends_as_items(titles):
    t = F.col("title")
    blocks = titles.select("page", "title_id", T.category_of(t).alias("category"), T.kind_of(t).alias("kind"), F.when(F.col("title_id") % 2 == 0, "tabular").otherwise("pictorial").alias("genre"))
    return rollups.legends_as_items(blocks).select("page", "category", "title_id")
