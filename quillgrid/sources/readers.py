"""Readers of layouts, annotations, label files and side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from quillgrid.functions import text as T
from quillgrid.functions.geometry import Rect
from quillgrid.plans.schema import ANNOTATION


def files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, project_id, sha256, size_bytes, magic_ok) of the files in a folder; the content isn't kept."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return raw.select("path", T.project_id(F.col("path")).alias("project_id"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("magic_ok"))


def register_new(found: DataFrame, known: DataFrame) -> DataFrame:
    """Files by content: one row per sha256, none that is known; id is its first eight digits."""
    first = found.groupBy("sha256").agg(F.min_by(F.struct(*[c for c in found.columns if c != "sha256"]), "path").alias("r")).select("sha256", "r.*")
    return first.join(known.select("sha256"), "sha256", "left_anti").withColumn("id", F.substring("sha256", 1, 8))


def triage(pages: DataFrame, text_chars: int = 200) -> DataFrame:
    """Health of each file of pages (file, page, text, images, rotation, width, height), without decoding anything again.

    ok from a tenth of text pages up; truncated without pages; unreadable_scan
    where over half the pages hold images, else no_text_layer.
    """
    one = pages.withColumn("chars", F.length(F.trim(F.coalesce("text", F.lit("")))))
    size = F.concat_ws("x", F.round("width").cast("int"), F.round("height").cast("int"))
    count = lambda name: F.map_from_entries(F.collect_list(F.struct(name, "n")))
    rotations = one.groupBy("file", "rotation").count().withColumnRenamed("count", "n").groupBy("file").agg(count("rotation").alias("rotations"))
    sizes = one.groupBy("file", size.alias("size")).count().withColumnRenamed("count", "n").groupBy("file").agg(count("size").alias("page_sizes"))
    f = one.groupBy("file").agg(F.count("page").alias("page_count"), F.count_if(F.col("chars") >= text_chars).alias("text_pages"), F.count_if(F.col("images") > 0).alias("image_pages"), F.round(F.avg("chars"), 1).alias("mean_chars"))
    health = F.when(F.col("page_count") == 0, "truncated").when((F.col("text_pages") > 0) & (F.col("text_pages") * 10 >= F.col("page_count")), "ok").when(F.col("image_pages") * 2 > F.col("page_count"), "unreadable_scan").otherwise("no_text_layer")
    return f.withColumn("health", health).drop("image_pages").join(rotations, "file").join(sizes, "file")


def outline(toc: DataFrame) -> DataFrame:
    """(file, page_index, title): blanks dropped, the first of each page and title in any case kept."""
    rows = toc.where(F.trim("title") != "").withColumn("key", F.upper(F.trim("title")))
    first = rows.groupBy("file", "page", "key").agg(F.min_by(F.trim("title"), "ord").alias("title"))
    return first.select("file", (F.col("page") - 1).alias("page_index"), "title")


def words(layout: DataFrame, clip: Rect | None = None) -> DataFrame:
    """Words in reading order within each page, inside the clip where one is given; ord from 0."""
    r = Rect.of()
    rows = layout if clip is None else layout.where((r.x0 < clip.x1) & (r.x1 > clip.x0) & (r.y0 < clip.y1) & (r.y1 > clip.y0))
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("file", "page").orderBy(F.round("y0", 1), "x0", "word")) - 1)


def spans(layout: DataFrame) -> DataFrame:
    return layout.where(F.trim("text") != "")


def lines(spans_df: DataFrame) -> DataFrame:
    """Lines of spans (file, page, block, line, span, text, size, rectangle): texts joined, white space squeezed, the largest size."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), " ")
    one = spans(spans_df).groupBy("file", "page", "block", "line").agg(T.squeezed(text).alias("text"), F.max("size").alias("size"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return one.withColumn("ord", F.row_number().over(Window.partitionBy("file", "page").orderBy(F.round("y0", 1), "x0", "block", "line")) - 1)


def titleblock_edge(segments: DataFrame, pages: DataFrame) -> DataFrame:
    """(file, page, tb_x): the left edge of the title block.

    The least x of upright strokes of 60 % of the page's height that begin right of
    80 % of its width; 88 % of it without any, and never beyond that.
    """
    s = segments.join(pages.select("file", "page", "width", "height"), ["file", "page"])
    up = (F.abs(F.col("x1") - F.col("x0")) <= 1) & (F.abs(F.col("y1") - F.col("y0")) >= 0.6 * F.col("height")) & (F.least("x0", "x1") >= 0.8 * F.col("width"))
    least = s.where(up).groupBy("file", "page").agg(F.min(F.least("x0", "x1")).alias("x"))
    return pages.join(least, ["file", "page"], "left").select("file", "page", F.least(F.coalesce("x", 0.88 * F.col("width")), 0.88 * F.col("width")).alias("tb_x"))


def strokes(paths: DataFrame, pages: DataFrame, edges: DataFrame, most: float = 0.55) -> DataFrame:
    """Boxes of strokes that aren't empty, don't lie in the title block and aren't wider or taller than most of the page."""
    s = paths.join(pages.select("file", "page", "width", "height"), ["file", "page"]).join(edges, ["file", "page"])
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return s.where(((w > 0) | (h > 0)) & (F.col("x0") < F.col("tb_x")) & (w <= most * F.col("width")) & (h <= most * F.col("height"))).select(*paths.columns)


def json_lines(spark: SparkSession, path: str, schema: str | S.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation sheets, one JSON file each; files that don't parse are left out, unknown keys dropped."""
    schema = f"{ANNOTATION}, _corrupt_record string"
    raw = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(path)
    return raw.where(F.col("_corrupt_record").isNull() & F.col("sheet_key").isNotNull()).drop("_corrupt_record")


def areas(sheets: DataFrame) -> DataFrame:
    """(sheet_key, area_ord, area_id, area_type, new_since_seed, rectangle)."""
    a = sheets.select("sheet_key", "planset_key", "page", "status", F.posexplode("areas").alias("area_ord", "a"))
    return a.select("sheet_key", "planset_key", "page", "status", "area_ord", F.col("a.id").alias("area_id"), F.col("a.type").alias("area_type"), F.coalesce("a.seed.new_since_seed", F.lit(False)).alias("new_since_seed"), *_corners("a.rect"))


def openings(sheets: DataFrame) -> DataFrame:
    """(sheet_key, box_ord, box_id, cls, cls_source, state, area_id, containment, conf, rectangle)."""
    o = sheets.select("sheet_key", "planset_key", "page", "status", F.posexplode("openings").alias("box_ord", "o"))
    cols = {"id": "box_id", "cls": "cls", "cls_source": "cls_source", "state": "state", "area_id": "area_id", "containment": "containment", "confidence": "conf", "edited": "edited"}
    return o.select("sheet_key", "planset_key", "page", "status", "box_ord", *(F.col(f"o.{k}").alias(v) for k, v in cols.items()), *_corners("o.rect"))


def _corners(rect: str) -> list[Column]:
    return [F.get(rect, i).alias(n) for i, n in enumerate(Rect._fields)]


def side_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def split_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of a list separated by white space, without leading dots and slashes."""
    words_df = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("name"))
    return words_df.where("name != ''").select(F.regexp_replace("name", r"^[./]+", "").alias("name"))


def label_files(spark: SparkSession, path: str) -> DataFrame:
    """(image, cls, cx, cy, w, h) of label files; lines of other than five fields are left out."""
    rows = spark.read.text(path).withColumn("f", F.split(F.trim("value"), r"\s+")).where(F.size("f") == 5)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^.]*$", 1)
    return rows.select(stem.alias("image"), F.get("f", 0).cast("int").alias("cls"), *(F.get("f", i).cast("double").alias(n) for i, n in enumerate(("cx", "cy", "w", "h"), 1)))


class PageReader(DataSourceReader):
    """Reads page rows of a plug-in decoder; filters on file and page are pushed into it."""

    def __init__(self, options: dict[str, str], schema: S.StructType):
        self.options, self.schema, self.files, self.page = options, schema, None, None

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("file",):
                self.files = [f.value]
            elif isinstance(f, EqualTo) and f.attribute == ("page",):
                self.page = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        named = [f for f in self.options.get("files", "").split(",") if f]
        return [InputPartition(f) for f in named if self.files is None or f in self.files]

    def read(self, partition: InputPartition):
        """The decoder is a function module:name of (file, page or None) that yields tuples in the schema's order."""
        import importlib

        module, name = self.options["decoder"].split(":")
        yield from getattr(importlib.import_module(module), name)(partition.value, self.page)


class PageSource(DataSource):
    """spark.dataSource.register(PageSource); format("layout_pages") with options files and decoder."""

    @classmethod
    def name(cls) -> str:
        return "layout_pages"

    def schema(self) -> str:
        return self.options.get("columns", "file string, page int, word int, text string, x0 double, y0 double, x1 double, y1 double")

    def reader(self, schema: S.StructType) -> PageReader:
        return PageReader(self.options, schema)
