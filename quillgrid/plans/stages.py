"""Composite stages over layout tables, each a chain of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions import geometry as G
from quillgrid.functions import text as T
from quillgrid.functions import vocabulary as V
from quillgrid.functions.geometry import Rect
from quillgrid.operators import graph, greedy, registry, sequence, similarity, spatial

PAGE = ["file", "page"]


def font_mode(lines: DataFrame) -> DataFrame:
    """(file, page, mode): the line size that most characters have; the first seen of equals, 10 without lines."""
    c = lines.groupBy(*PAGE, F.round("size", 1).alias("size")).agg(F.sum(F.length("text")).alias("n"), F.min("ord").alias("first"))
    return c.groupBy(*PAGE).agg(F.max_by("size", F.struct("n", -F.col("first"))).alias("mode"))


def locate(lines: DataFrame, pages: DataFrame, edges: DataFrame, toc: DataFrame, words: DataFrame, keep: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(candidate pages with score and signals, their titles).

    Dear signals come last: header bands are looked for on borderline pages only.
    """
    usable = pages.where(~F.coalesce("health", F.lit("ok")).isin("truncated", "unopenable")).select(*PAGE, "height")
    runs = sequence.merged_titles(lines.join(usable.select(*PAGE), PAGE, "left_semi"), PAGE)  # small lines end a run, so they go only after it
    runs = runs.join(font_mode(lines), PAGE).where(F.col("size") >= F.greatest(F.lit(11.0), 1.35 * F.col("mode")))
    t = F.col("run_text")
    titles = runs.select(*PAGE, "ord", t.alias("title"), *Rect.of().named(), "size", T.title_score(t).alias("score"), T.category_of(t).alias("category"), T.kind_of(t).alias("kind")).where("score > 0")
    titles = titles.dropDuplicates([*PAGE, "title", "y0", "x0"]).join(edges, PAGE, "left").withColumn("at_edge", F.coalesce(F.col("x0") >= F.col("tb_x"), F.lit(False)))
    strong = titles.where("score >= 1 and category != 'unknown' and not at_edge").groupBy(*PAGE).agg(F.collect_set("category").alias("cats"))
    bare = (F.col("category") == "unknown") & (F.col("score") < 1) & (F.size("cats") == 1) & F.get("cats", 0).isin("door", "window", "garage_door")
    titles = titles.join(strong, PAGE, "left").withColumn("category", F.when(bare, F.get("cats", 0)).otherwise(F.col("category"))).drop("cats")
    sheet = ~F.col("at_edge")
    signal = titles.groupBy(*PAGE).agg(
        F.max(F.when(sheet, F.when(F.col("score") >= 1, 0.6).otherwise(0.3))).alias("on"),
        F.bool_or("at_edge").alias("edge"),
        F.count_if(sheet).alias("n"),
        F.coalesce(F.bool_or(sheet & (F.col("category") != "unknown")), F.lit(False)).alias("ours"),
    )
    title_part = F.when((F.col("n") > 0) & ~F.col("ours"), 0.0).otherwise(F.least(F.lit(0.75), F.coalesce("on", F.lit(0.0)) + F.when(F.col("edge"), 0.15).otherwise(0.0)))
    marks = toc.where(T.title_score(F.col("title")) > 0).groupBy("file", F.col("page_index").alias("page")).agg(F.last("title").alias("toc_title"))
    shut = (F.coalesce("n", F.lit(0)) > 0) & ~F.coalesce("ours", F.lit(False))
    base = usable.join(signal, PAGE, "left").join(marks, PAGE, "left").withColumn("score", F.when(shut, 0.0).otherwise(F.coalesce(title_part, F.lit(0.0)) + F.when(F.col("toc_title").isNotNull(), 0.5).otherwise(0.0)))
    border = base.where((F.col("score") > 0) & (F.col("score") < keep)).select(*PAGE)
    header = header_bands(words.join(border, PAGE, "left_semi")).select(*PAGE).distinct().withColumn("header", F.lit(0.5))
    scored = base.join(header, PAGE, "left").withColumn("score", F.col("score") + F.coalesce("header", F.lit(0.0)))
    signals = F.array_compact(F.array(F.when(F.col("toc_title").isNotNull(), "toc"), F.when(F.col("on").isNotNull(), "title"), F.when(F.col("edge"), "titleblock"), F.when(F.col("header").isNotNull(), "header")))
    pages_out = scored.where(F.col("score") >= keep).select(*PAGE, "score", signals.alias("signals"))
    return pages_out, titles.join(pages_out.select(*PAGE), PAGE, "left_semi")


def header_bands(words: DataFrame, band: float = 5.0, radius: float = 300.0, hits: int = 6, clear: int = 2) -> DataFrame:
    """(file, page, bin, y): bands of header words with a word of the trade near by."""
    bins = words.withColumn("bin", F.floor(F.col("y0") / band)).groupBy(*PAGE, "bin").agg(F.collect_list("text").alias("texts"), F.min("y0").alias("y"), F.min("x0").alias("bx0"), F.max("x1").alias("bx1"))
    strength = T.header_strength(F.col("texts"))
    good = bins.withColumn("h", strength).where((F.col("h.total") >= hits) & (F.col("h.unambiguous") >= clear))
    near = words.where(F.upper("text").rlike(r"\b(?:DOORS?|WINDOWS?|GLAZING|STOREFRONT|SASH)\b")).select(F.col("file").alias("f"), F.col("page").alias("p"), F.col("x0").alias("wx0"), F.col("x1").alias("wx1"), F.col("y0").alias("wy0"))
    hit = (F.col("file") == F.col("f")) & (F.col("page") == F.col("p")) & (F.abs(F.col("wy0") - F.col("y")) <= radius) & (F.col("wx0") <= F.col("bx1") + radius) & (F.col("wx1") >= F.col("bx0") - radius)
    return good.join(near, hit, "left_semi").select(*PAGE, "bin", "y")


def segment(words: DataFrame, titles: DataFrame, pages: DataFrame, edges: DataFrame, width: int = 1600, height: int = 1200, least_words: int = 15, least_side: float = 40.0) -> DataFrame:
    """Blocks: word components, each with its title of least cost, boxed, cut free of each other and trimmed.

    titles: title_id, title, category, kind, rectangle. Columns: block_id, title and its fields, rectangle, word_count.
    """
    comp = words.join(graph.mask_components(words, PAGE, "word", width, height), [*PAGE, "word"])
    boxes = comp.groupBy(*PAGE, "comp").agg(*G.union_agg(Rect.of())).withColumnRenamed("comp", "comp_id")
    sized = boxes.join(pages.select(*PAGE, F.col("width").alias("page_w"), F.col("height").alias("page_h")), PAGE).join(edges, PAGE)
    fit = sized.where((G.area(Rect.of()) <= 0.55 * F.col("page_w") * F.col("page_h")) & (F.col("x0") < F.col("tb_x"))).withColumn("pk", F.concat_ws("/", *PAGE))
    t = titles.withColumn("pk", F.concat_ws("/", *PAGE))
    given = spatial.assign_by_cost(fit, t.select("pk", "title_id", *Rect.of().named()), "pk").where("title_id is not null")
    both = given.select("pk", "title_id", *Rect.of().named()).unionByName(t.select("pk", "title_id", *Rect.of().named()))
    raw = both.groupBy("pk", "title_id").agg(*G.union_agg(Rect.of()))
    raw = raw.join(t.select("pk", "title_id", *Rect.of().named("t_")), ["pk", "title_id"])
    free = greedy.resolve_overlaps(raw, ["pk"], "title_id").join(t.drop("x0", "y0", "x1", "y1").join(raw.select("pk", "title_id", *(f"t_{c}" for c in Rect._fields)), ["pk", "title_id"]), ["pk", "title_id"])
    blocks = free.withColumn("block_id", F.col("title_id").cast("string"))
    w = words.withColumn("pk", F.concat_ws("/", *PAGE))
    held = spatial.contained_words(w, blocks, "pk").join(blocks.select("pk", "block_id", ((F.col("t_x0") + F.col("t_x1")) / 2).alias("tx"), F.col("t_y1").alias("ty")), ["pk", "block_id"])
    key = ["pk", "block_id"]
    inner = sequence.trimmed_axis(sequence.trimmed_axis(held, key, "x0", "x1", "tx"), key, "y0", "y1", "ty", ratio=None)
    tight = inner.groupBy(*key).agg(*G.union_agg(Rect.of()), F.count("*").alias("word_count"))
    tight = tight.where((F.col("word_count") >= least_words) & (F.col("x1") - F.col("x0") >= least_side) & (F.col("y1") - F.col("y0") >= least_side))
    out = blocks.drop(*Rect._fields).join(tight, key)
    order = Window.partitionBy("pk").orderBy(F.round("y0"), "x0", "title_id")
    return out.withColumn("block_id", F.concat(F.lit("p"), F.col("page"), F.lit("_b"), F.row_number().over(order) - 1)).drop("pk")


def genre(words: DataFrame, blocks: DataFrame, hits: int = 3, clear: int = 2, purity: float = 0.45) -> DataFrame:
    """blocks with genre: tabular where some 5-point row in them reads like a table's header, else pictorial."""
    w, b = words.withColumn("pk", F.concat_ws("/", *PAGE)), blocks.withColumn("pk", F.concat_ws("/", *PAGE))
    rows = spatial.contained_words(w, b, "pk").where(F.col("text").rlike("[A-Za-z0-9]")).groupBy("pk", "block_id", F.floor(F.col("y0") / 5).alias("bin")).agg(F.collect_list("text").alias("texts"))
    h = rows.withColumn("h", T.header_strength(F.col("texts")))
    good = (F.col("h.total") >= hits) & (F.col("h.unambiguous") >= clear) & (F.col("h.total") >= purity * F.size("texts"))
    tab = h.where(good).select("pk", "block_id").distinct().withColumn("genre", F.lit("tabular"))
    return b.join(tab, ["pk", "block_id"], "left").withColumn("genre", F.coalesce("genre", F.lit("pictorial"))).drop("pk")


def ruled_rows(cells: DataFrame, tables: DataFrame, blocks: DataFrame) -> DataFrame:
    """Data rows of the best ruled table of each block: (block_id, row, cells array of (name, value)).

    cells: table_id, row, col, text; tables: table_id, block_id, rectangle.
    """
    b = blocks.select("block_id", *Rect.of().named("b_"))
    shape = cells.groupBy("table_id").agg((F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"))
    line = F.transform(F.array_sort(F.collect_list(F.struct("col", F.coalesce("text", F.lit("")).alias("t")))), lambda c: c["t"])
    rows = cells.groupBy("table_id", "row").agg(line.alias("cells"))
    heads = rows.where("row < 5").withColumn("is_head", T.is_header_row(F.col("cells")))
    tokens = F.flatten(F.transform("cells", lambda c: F.split(F.trim(c), r"[\s/]+")))
    score = heads.groupBy("table_id").agg(F.max(F.size(T.header_hits(tokens))).alias("hits"))
    fit = tables.join(b, "block_id").where(G.containment(Rect.of(), Rect.of("b_")) >= 0.7).join(shape, "table_id").join(score, "table_id").where("hits > 0 and rows >= 2 and cols >= 2")
    best = fit.groupBy("block_id").agg(F.max_by("table_id", F.struct(F.col("hits") + 0.1 * F.col("rows"), -F.col("table_id"))).alias("table_id"))
    first = heads.where("is_head").groupBy("table_id").agg(F.min("row").alias("h0"))
    run = heads.join(first, "table_id").where("row >= h0")
    body = run.where("not is_head").groupBy("table_id").agg(F.min("row").alias("h1"))
    tiers = first.join(body, "table_id", "left").join(shape, "table_id").select("table_id", "h0", F.coalesce("h1", F.least(F.col("rows"), F.lit(5))).alias("h1")).join(best, "table_id")
    head = cells.join(tiers, "table_id").where("row >= h0 and row < h1").select("table_id", F.col("row").alias("tier"), "col", "text")
    names = sequence.header_names(head, ["table_id"])
    data = rows.join(tiers, "table_id").where("row >= h1").where(T.is_data_row(F.col("cells"))).select("block_id", "table_id", "row", F.posexplode("cells").alias("col", "value"))
    named = data.join(names, ["table_id", "col"]).groupBy("block_id", "row").agg(F.array_sort(F.collect_list(F.struct("col", "name", "value"))).alias("c"))
    return named.select("block_id", "row", F.transform("c", lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value"))).alias("cells"))


def unruled_rows(words: DataFrame, blocks: DataFrame, purity: float = 0.4) -> DataFrame:
    """Data rows of blocks without rules: row bands, header cells by gaps, words dealt to cells."""
    w, b = words.withColumn("pk", F.concat_ws("/", *PAGE)), blocks.withColumn("pk", F.concat_ws("/", *PAGE))
    held = spatial.contained_words(w, b, "pk").withColumn("key", F.concat_ws("/", "pk", "block_id"))
    upper = held.groupBy("key").agg(F.sort_array(F.collect_list(F.col("y1") - F.col("y0"))).alias("h")).select("key", F.greatest(F.lit(1.5), 0.6 * F.get("h", F.floor(F.size("h") / 2).cast("int"))).alias("gap"))
    rows = sequence.sessions(held.join(upper, "key"), ["key"], "y0", F.col("gap"), ["x0", "word"], "row")
    by_row = rows.groupBy("key", "row").agg(F.collect_list("text").alias("texts")).withColumn("hits", F.size(T.header_hits(F.col("texts"))))
    head = by_row.where((F.col("hits") >= 3) & (F.col("hits") >= purity * F.size("texts"))).groupBy("key").agg(F.min("row").alias("h0"))
    top = rows.join(head, "key").where("row = h0")
    cells = sequence.bounds(top, ["key"])
    inside = (F.col("x0") >= F.coalesce("lo", F.lit(float("-inf")))) & (F.col("x0") < F.coalesce("hi", F.lit(float("inf"))))
    dealt = rows.join(head, "key").where("row >= h0").join(cells, "key").where(inside)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word", "text"))), lambda s: s["text"]), " ")
    cell = dealt.groupBy("key", "block_id", "row", "h0", "cell").agg(text.alias("value"))
    names = cell.where("row = h0").select("key", "cell", F.col("value").alias("name"))
    full = cell.where("row > h0").join(names, ["key", "cell"]).groupBy("key", "block_id", "row").agg(F.array_sort(F.collect_list(F.struct("cell", "name", "value"))).alias("c"))
    out = full.select("key", "block_id", "row", F.transform("c", lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value"))).alias("cells")).where(T.is_data_row(F.transform("cells", lambda c: c["value"])))
    enough = out.groupBy("key").agg(F.count("*").alias("n")).where("n >= 2")
    return out.join(enough.select("key"), "key", "left_semi").drop("key")


def pictorial_items(lines: DataFrame, block: str = "block_id") -> DataFrame:
    """(block, item, title, width, height, kind, mark, specs): cards of bulleted specifications under a caption.

    Caption lines are walked back until a size is found; else the last stands alone.
    """
    depth = lines.withColumn("depth", T.bullet_depth(F.col("text")))
    specs = sequence.spec_items(depth, [block])
    caption = F.col("spec_no") == 0
    told = specs.groupBy(block, "item").agg(F.max(F.when(caption, F.col("spec"))).alias("title"), F.array_sort(F.collect_list(F.when(~caption, F.struct("spec_no", T.strip_bullet(F.col("spec")).alias("spec"))))).alias("s")).where("title is not null and size(s) > 0")
    t = T.parse_title(F.col("title"))
    mark = F.regexp_extract("title", r"^\s*([A-Z0-9]{1,4})\s", 1)
    return told.select(block, "item", "title", t["width"].alias("width"), t["height"].alias("height"), t["kind"].alias("kind"), mark.alias("mark"), F.transform("s", lambda x: x["spec"]).alias("specs"))


def legend_entries(lines: DataFrame, block: str = "block_id") -> DataFrame:
    """(block, code, caption): short codes with the nearest line under them; boilerplate captions fall away after the choice."""
    code = lines.where(F.col("text").rlike(r"^\(?[A-Z0-9]{1,3}\)?$")).select(block, F.col("ord").alias("code_id"), F.regexp_replace("text", r"[()]", "").alias("code"), *Rect.of().named())
    heights = lines.where("y1 > y0").groupBy(block).agg(F.sort_array(F.collect_list(F.col("y1") - F.col("y0"))).alias("h"))
    step = heights.select(block, F.get("h", F.floor(F.size("h") / 2).cast("int")).alias("spacing"))
    spaced = code.join(step, block, "left").withColumn("spacing", F.coalesce("spacing", F.lit(10.0)))
    low = lines.where(F.length("text") > 3).select(block, F.col("ord").alias("id"), "text", *Rect.of().named())
    got = spatial.nearest_below(spaced, low, block, "code_id", 1.0, 2.2 * F.col("spacing"), F.col("spacing"), label=True)
    return got.where(F.col("l_text").isNotNull() & ~F.upper("l_text").rlike(r"\b(?:SCALE|NOTE|REFER|SEE)\b")).select(block, "code", F.col("l_text").alias("caption"))


def items_of_rows(rows: DataFrame, blocks: DataFrame, legends: DataFrame) -> DataFrame:
    """Takeoff items of table rows: roles, leading mark, sizes, legend caption, facets."""
    cols = F.transform("cells", lambda c: c["name"])
    r = rows.join(blocks.select("block_id", F.col("title").alias("block_title"), "category"), "block_id").withColumn("role", T.roles(cols))
    value = lambda name: F.coalesce(F.get(F.filter("cells", lambda c: c["name"] == F.try_element_at(F.col("role"), F.lit(name))), 0)["value"], F.lit(""))
    first = F.coalesce(F.get(F.filter("cells", lambda c: F.trim(c["value"]) != ""), 0)["value"], F.lit(""))
    lead = T.split_leading_mark(first)
    found = T.recover_size(F.col("cells"), F.col("role"))
    r = r.select("block_id", "row", "block_title", "category", "cells", F.when(value("mark") != "", value("mark")).otherwise(lead["mark"]).alias("mark"), F.when(value("width") != "", value("width")).otherwise(found["width"]).alias("width_text"), F.when(value("height") != "", value("height")).otherwise(found["height"]).alias("height_text"), F.upper(F.trim(value("type_code"))).alias("type_code"), value("quantity").alias("quantity"), F.array_join(F.transform("cells", lambda c: c["value"]), " ").alias("body"))
    captions = legends.groupBy("category", F.upper(F.trim("code")).alias("code")).agg(F.last("caption").alias("caption"))
    rank = F.when(F.col("l_category") == F.col("category"), 0)
    for i, c in enumerate(("both", "door", "window", "garage_door"), 1):
        rank = rank.when(F.col("l_category") == c, i)
    met = r.join(captions.withColumnRenamed("category", "l_category"), F.col("type_code") == F.col("code")).withColumn("rank", rank).where("rank is not null").groupBy("block_id", "row").agg(F.min_by("caption", "rank").alias("caption"))
    full = r.join(met, ["block_id", "row"], "left").withColumn("c", T.classify(F.concat_ws(" ", "body", "caption"), F.col("category"), F.col("type_code")))
    return full.select("block_id", "row", "block_title", "mark", "width_text", "height_text", T.to_inches(F.col("width_text")).alias("width_in"), T.to_inches(F.col("height_text")).alias("height_in"), "quantity", "type_code", "caption", F.col("c").alias("canonical"), F.col("cells").alias("raw"))


def detections(passes: list[DataFrame], by: str, ident: str, nested: float = 0.85, limit: float = 0.55) -> DataFrame:
    """Union of detector passes, suppressed, freed of nested boxes, with mullion groups."""
    both = passes[0]
    for p in passes[1:]:
        both = both.unionByName(p)
    kept = both.join(greedy.suppress(both, [by], ident, limit), [by, ident], "left_semi")
    return sequence.mullion_groups(greedy.drop_nested(kept, [by], ident, nested), [by], ident)


def dataset(sheets_boxes: DataFrame, sheets_areas: DataFrame, negative_share: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """(examples, boxes): crops of verified areas with accepted, classed boxes, empty ones as far as the share allows; hash-stable split."""
    a = sheets_areas.where("status = 'verified' and area_type not in ('exclude', 'mixed', 'unknown')").select("sheet_key", "planset_key", "area_id", "area_type", *Rect.of().named("a_"))
    o = sheets_boxes.where("state = 'accepted' and cls != '' and area_id is not null").select("sheet_key", "area_id", "box_id", "cls", *Rect.of().named())
    got = o.join(a, ["sheet_key", "area_id"]).withColumn("u", G.to_crop(Rect.of(), Rect.of("a_"))).where("u is not null")
    boxes = got.select("sheet_key", "area_id", "box_id", T.looked_up(F.col("cls"), V.CLASS_INDEX).alias("cls"), "u.*")
    n = boxes.groupBy("sheet_key", "area_id").agg(F.count("*").alias("boxes"))
    ex = a.join(n, ["sheet_key", "area_id"], "left").withColumn("boxes", F.coalesce("boxes", F.lit(0))).withColumn("split", F.when(T.is_val(F.col("planset_key")), "val").otherwise("train"))
    limit = int(ex.where("boxes > 0").count() * negative_share / (1 - negative_share))
    empty = ex.where("boxes = 0").orderBy(F.desc(G.area(Rect.of("a_"))), "sheet_key", "area_id").limit(limit)
    return ex.where("boxes > 0").unionByName(empty), boxes


def regions(sheets_areas: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(boxes, reasons): areas as unit boxes on whole pages, and how many were left out for which reason."""
    a = sheets_areas.join(pages.select("sheet_key", "width", "height"), "sheet_key").withColumn("cls", T.looked_up(F.col("area_type"), V.REGION_CLASS)).withColumn("u", G.to_page(Rect.of(), F.col("width"), F.col("height")))
    reason = F.when(F.col("new_since_seed"), "new_since_seed").when(F.col("cls").isNull(), "unfolded_type").when(F.col("u").isNull(), "degenerate")
    a = a.withColumn("reason", reason)
    return a.where("reason is null").select("sheet_key", "area_id", "cls", "u.*"), a.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def evaluate(preds: DataFrame, truths: DataFrame, by: list[str]) -> DataFrame:
    """One row: precision, recall and average precision over all, counts that are exact and within one."""
    m = greedy.match_truths(preds, truths, by)
    n = truths.agg(F.count("*").alias("n_truth")).withColumn("all", F.lit(0))
    ap = sequence.average_precision(m.withColumn("all", F.lit(0)), n.select("all", "n_truth"), ["all"], "pred_id")
    counts = truths.groupBy(*by).agg(F.count("*").alias("t")).join(preds.groupBy(*by).agg(F.count("*").alias("p")), by, "full_outer").na.fill(0, ["t", "p"])
    rates = counts.agg(F.avg((F.col("t") == F.col("p")).cast("double")).alias("exact_rate"), F.avg((F.abs(F.col("t") - F.col("p")) <= 1).cast("double")).alias("within_one_rate"))
    hits = m.agg(F.count_if("hit").alias("tp"), F.count("*").alias("n"))
    one = ap.join(rates.withColumn("all", F.lit(0)), "all").join(hits.withColumn("all", F.lit(0)), "all")  # a row each
    return one.select("ap", (F.col("tp") / F.nullif(F.col("n"), F.lit(0))).alias("precision"), (F.col("tp") / F.nullif(F.col("n_truth"), F.lit(0))).alias("recall"), "exact_rate", "within_one_rate")


def weak_labels(boxes: DataFrame, areas: DataFrame, by: str, ident: str, share: float = 0.80) -> DataFrame:
    """Merged detector boxes that lie in a classed area by share, with its class; every fifth project is val."""
    merged = graph.merge_boxes(boxes, [by], ident).withColumnRenamed("comp", ident)
    got = spatial.smallest_container(merged, areas, by, ident, share).withColumn("label", T.looked_up(F.col("area_type"), V.AREA_CLASS)).where("label is not null")
    rank = got.select(by).distinct().withColumn("k", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(by)) - 1)  # a row for each project
    return got.join(rank, by).withColumn("split", F.when(F.col("k") % 5 == 4, "val").otherwise("train")).drop("k")


def viewer_index(sheets: DataFrame, blocks: DataFrame, boxes: DataFrame, zoom: float = 1.8) -> DataFrame:
    """One row per sheet with its blocks and boxes nested, points scaled to pixels."""
    px = F.array(*G.scaled(Rect.of(), zoom))
    b = blocks.groupBy("sheet_key").agg(F.array_sort(F.collect_list(F.struct("block_id", "title", "category", px.alias("rect")))).alias("blocks"))
    o = boxes.groupBy("sheet_key").agg(F.array_sort(F.collect_list(F.struct("box_id", "cls", "conf", px.alias("rect")))).alias("boxes"))
    return sheets.join(b, "sheet_key", "left").join(o, "sheet_key", "left")


def deduplicate(words: DataFrame, ident: str = "sheet", threshold: float = 0.95) -> DataFrame:
    """(kept, dropped) of sheets whose word sets are nearly alike, in order of id."""
    sets = words.where(F.length("text") > 2).groupBy(ident).agg(F.array_sort(F.collect_set(F.upper("text"))).alias("tokens"))
    pairs = similarity.jaccard_pairs(sets, ident, threshold)
    return similarity.keep_first(pairs, similarity.components(pairs))


def merge_sheets(old: DataFrame, new: DataFrame, areas: DataFrame, by: str, reviewed: DataFrame) -> DataFrame:
    """Outcomes of a merge with every box assigned anew: human and edited boxes stay as they are."""
    marked = new.join(reviewed, by, "left").withColumn("reviewed", F.coalesce("reviewed", F.lit(False)))
    outcome = registry.merge_snapshots(old, marked, [by], F.col("reviewed"))
    o = outcome.join(old.select(by, "old_id", *Rect.of().named("o_")), [by, "old_id"], "left").join(new.select(by, "new_id", *Rect.of().named("n_")), [by, "new_id"], "left")
    human = F.col("outcome").isin("kept_human", "kept_unmatched")
    rect = [F.when(human, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c) for c in Rect._fields]
    rows = o.select(by, "old_id", "new_id", "outcome", *rect, F.coalesce("old_id", -1 - F.col("new_id")).alias("box"))
    return spatial.smallest_container(rows, areas, by, "box")
