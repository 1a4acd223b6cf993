"""Scoring and parsing of drawing text as Column functions; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgrid.functions import vocabulary as V

I = "(?i)"  # noqa: E741
TITLE_TABLE = rf"\b{V.SUBJECT}\b.{{0,30}}?\b{V.TABLE}\b|\b{V.TABLE}\b.{{0,20}}?\b{V.SUBJECT}\b"
TITLE_LEGEND = rf"\b{V.SUBJECT}\b.{{0,24}}?\b{V.LEGEND}\b(?:[\s,&]+(?:AND\s+)?DETAILS?)?[\s:.,]*$"
TITLE_IMPLIED = rf"^{V.IMPLIED}\s+{V.LEGEND}\b[\s:.,]*$"
TITLE_WEAK = rf"\b{V.TABLE}\b"
INDEX_PAGE = "|".join(p.replace(" ", r"\s+") for p in V.INDEX_PAGES)
FOREIGN = "|".join([*V.FOREIGN_PARTS, rf"\b(?:{'|'.join(V.FOREIGN_WORDS)})\b", *(p.replace(" ", r"\s+") for p in V.FOREIGN_PHRASES)])
# The outer boundaries of an alternation hold for its first and last word only.
HAS_WINDOW = r"\bWINDOW|SASH|GLAZING\b"
HAS_DOOR = r"\bDOOR|OPENING|STOREFRONT\b"
HAS_GARAGE = r"\bGARAGE|OVERHEAD|SECTIONAL|ROLL[- ]?UP\b"


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def title_score(text: Column) -> Column:
    """0, 0.35 or 1: how much a title speaks of a schedule. The order of the tests is part of it."""
    t = squeezed(text)
    words = F.size(F.split(t, " "))
    return (
        F.when(t.isNull() | (t == "") | (words > 9) | t.rlike(I + INDEX_PAGE), 0.0)
        .when(t.rlike(I + TITLE_TABLE), 1.0)
        .when(t.rlike(I + FOREIGN), 0.0)
        .when(t.rlike(I + TITLE_LEGEND), 1.0)
        .when(t.rlike(I + TITLE_IMPLIED) | t.rlike(I + TITLE_WEAK), 0.35)
        .otherwise(0.0)
    )


def normalise_token(token: Column) -> Column:
    return F.regexp_replace(F.upper(token), r"^[ :.,()\[\]]+|[ :.,()\[\]]+$", "")


def header_hits(tokens: Column) -> Column:
    """Distinct header words among an array of tokens."""
    return F.array_intersect(F.array_distinct(F.transform(tokens, normalise_token)), F.array(*map(F.lit, V.HEADER_WORDS)))


def header_strength(tokens: Column) -> Column:
    """struct(total, unambiguous)."""
    hits = header_hits(tokens)
    return F.struct(F.size(hits).alias("total"), F.size(F.array_except(hits, F.array(*map(F.lit, V.SHARED_HEADER_WORDS)))).alias("unambiguous"))


def category_of(title: Column) -> Column:
    t = F.upper(title)
    window, door = t.rlike(HAS_WINDOW), t.rlike(HAS_DOOR)
    return F.when(t.rlike(HAS_GARAGE), "garage_door").when(window & door, "both").when(window, "window").when(door, "door").otherwise("unknown")


def kind_of(title: Column) -> Column:
    t = F.upper(title)
    return (
        F.when(t.rlike(r"\bHARDWARE\b") & ~t.rlike(r"\bSCHEDULE\b"), "hardware")
        .when(t.rlike(r"\bNOTES?\b|ABBREVIATIONS?\b|\bKEY\b"), "notes")
        .when(t.rlike(rf"\b{V.LEGEND}\b"), "type_legend")
        .when(t.rlike(rf"\b{V.TABLE}\b"), "schedule")
        .otherwise("unknown")
    )


def _mapped(token: Column, table: Mapping[str, str]) -> Column:
    bare = F.regexp_replace(token, r"^\.+|\.+$", "")
    found = F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), bare)
    return F.coalesce(found, token)


def expand(text: Column, from_code: bool = False) -> Column:
    """Upper case with dotted initials joined and abbreviations written out."""
    joined = F.regexp_replace(F.upper(text), r"\b([A-Z])\.([A-Z])\.(?:([A-Z])\.)?", "$1$2$3")
    table = V.ABBREVIATIONS | (V.CODE_ABBREVIATIONS if from_code else {})
    return F.array_join(F.transform(F.regexp_extract_all(joined, F.lit(r"\w+|\W+"), F.lit(0)), lambda t: _mapped(t, table)), "")


def first_match(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The value of the first rule whose pattern is found; null if none is."""
    return F.coalesce(*(F.when(text.rlike(I + p), F.lit(v)) for p, v in rules))


def all_matches(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Sorted distinct values of the rules whose patterns are found."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(text.rlike(I + p), F.lit(v)) for p, v in rules)))))


def fire_rating(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, I + V.FIRE_RATING, 1), F.lit("")).cast("int")


def classify(text: Column, block_category: Column, type_code: Column) -> Column:
    """struct of the canonical facets of a row's text."""
    body = F.concat(expand(F.coalesce(text, F.lit(""))), F.when(F.coalesce(type_code, F.lit("")) != "", F.concat(F.lit(" "), expand(type_code, True))).otherwise(""))
    own, operation, face = first_match(body, V.CATEGORY), first_match(body, V.OPERATION), first_match(body, V.LEAF_FACE)
    handed = own.isNull() & block_category.isin("window", "door", "garage_door")
    category = F.when(handed, block_category).otherwise(own)
    review = category.isNull() | (~category.isin(V.NOT_OPERABLE) & operation.isNull() & face.isNull())
    return F.struct(
        category.alias("category"),
        operation.alias("operation"),
        face.alias("leaf_face"),
        first_match(body, V.MATERIAL).alias("material"),
        all_matches(body, V.GLAZING).alias("glazing"),
        fire_rating(body).alias("fire_rating_min"),
        all_matches(body, V.FLAGS).alias("flags"),
        F.when(handed, "block_title").otherwise("lexicon").alias("mapped_by"),
        F.coalesce(review, F.lit(True)).alias("needs_review"),
    )


def to_inches(text: Column) -> Column:
    """Feet and inches, slash feet or a bare number as inches; null for VARIES and what doesn't parse."""
    feet = r"(\d+)\s*'\s*-?\s*(\d+)?"
    slash = r"^\s*(\d{1,2})\s*/\s*(\d{1,2})\s*$"
    number = lambda p, g: F.coalesce(F.nullif(F.regexp_extract(text, p, g), F.lit("")).cast("double"), F.lit(0.0))
    return (
        F.when(text.isNull() | (text == "") | text.rlike("(?i)VARIES"), F.lit(None).cast("double"))
        .when(text.rlike(feet), number(feet, 1) * 12 + number(feet, 2))
        .when(text.rlike(slash) & (number(slash, 2) < 12), number(slash, 1) * 12 + number(slash, 2))
        .when(text.rlike(r'^\s*\d+(?:\.\d+)?\s*"?\s*$'), F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1).cast("double"))
    )


def tidy_dimension(text: Column) -> Column:
    """Without white space; a stray foot mark after inches becomes an inch mark."""
    return F.regexp_replace(F.regexp_replace(text, r"\s+", ""), r"^(\d+'-?\d+)'$", '$1"')


# Titles of items. A size is found anywhere in the text, a nominal call at its start and with a kind after it.
SIZE_TITLE = r"""(\d+\s*'\s*-?\s*\d*\s*["']?)\s*[xX×]\s*(\d+\s*'\s*-?\s*\d*\s*["']?)\s*(.*)$"""
CALL_TITLE = r"^(?i:PAIR\s+)?(\d)(\d)(\d)(\d)\s+(.+)$"


def parse_title(text: Column) -> Column:
    """struct(width, height, kind): "W x H kind", or a nominal call of four digits, else all of it as kind."""
    part = lambda i: F.regexp_extract(text, SIZE_TITLE, i)
    digit = lambda i: F.regexp_extract(text, CALL_TITLE, i)
    size, call = text.rlike(SIZE_TITLE), text.rlike(CALL_TITLE)
    made = lambda a, b: F.concat(digit(a), F.lit("'-"), digit(b), F.lit('"'))
    return F.struct(
        F.when(size, tidy_dimension(part(1))).when(call, made(1, 2)).otherwise("").alias("width"),
        F.when(size, tidy_dimension(part(2))).when(call, made(3, 4)).otherwise("").alias("height"),
        F.when(size, F.trim(part(3))).when(call, F.trim(digit(5))).otherwise(text).alias("kind"),
    )


# Bullets, and lines of a key and its value.
BULLETS = "[·•▪‣●■*]"
KEY_VALUE = r"^[A-Z][A-Z .]{2,16}:\s*\S"


def bullet_depth(text: Column) -> Column:
    """Number of leading bullets; 1 for "KEY: value" lines; else 0."""
    n = F.length(F.regexp_replace(F.regexp_extract(text, rf"^\s*((?:{BULLETS}\s*)+)", 1), r"\s", ""))
    return F.when(n > 0, n).when(text.rlike(KEY_VALUE), 1).otherwise(0)


def strip_bullet(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"^\s*(?:{BULLETS}\s*)+", ""))


def plausible(text: Column, limit: float) -> Column:
    """Whether a dimension lies between 8 inches and the limit."""
    return F.coalesce(to_inches(text).between(8.0, limit), F.lit(False))


def is_header_row(cells: Column) -> Column:
    """At least two filled cells, and header words for two and 0.4 of them at least."""
    filled = F.filter(cells, lambda c: F.trim(c) != "")
    tokens = F.flatten(F.transform(filled, lambda c: F.split(F.trim(c), r"[\s/]+")))
    return (F.size(filled) >= 2) & (F.size(header_hits(tokens)) >= F.greatest(F.lit(2.0), F.size(filled) * 0.4))


# Marks, and whatever reads as a dimension.
MARK_LIKE = r"(?i)^[A-Z]{0,3}[-.]?\d{0,4}[A-Z]?$"
DIMENSION_LIKE = r"""(?i)\d+\s*'\s*-?\s*\d*\s*"?|\d+\s*-\s*\d+|^\d{3,4}$|\bVARIES\b"""


def is_data_row(cells: Column) -> Column:
    """A short mark among the first two filled cells, or any dimension."""
    filled = F.filter(F.transform(cells, lambda c: F.trim(c)), lambda c: c != "")
    mark = F.exists(F.slice(filled, 1, 2), lambda c: (F.length(c) <= 5) & c.rlike(MARK_LIKE))
    return mark | F.exists(filled, lambda c: c.rlike(DIMENSION_LIKE))


def roles(columns: Column) -> Column:
    """map role -> first column whose name matches; one column may fill several roles."""
    pairs = [x for role, p in V.COLUMN_ROLES.items() for x in (F.lit(role), F.get(_columns_like(columns, p), 0))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def _columns_like(columns: Column, pattern: str) -> Column:
    return F.filter(columns, lambda c: c.rlike(I + pattern))


def split_leading_mark(value: Column) -> Column:
    """struct(mark, rest) of a cell's text; an empty mark and the whole text where there is none."""
    p = r"^\s*([A-Z]{0,2}-?\d{1,3}[A-Z]?)\s+(\S.*)$"
    hit = value.rlike(p)
    return F.struct(F.when(hit, F.regexp_extract(value, p, 1)).otherwise("").alias("mark"), F.when(hit, F.regexp_extract(value, p, 2)).otherwise(value).alias("rest"))


DIMENSION_TOKEN = r"""\d{1,2}\s*'\s*-?\s*\d{0,2}\s*["”]?"""


def recover_size(cells: Column, role: Column) -> Column:
    """struct(width, height): the first two foot-marked tokens of an array of (name, value), where no size column is known."""
    skip = F.array_compact(F.array(*(F.try_element_at(role, F.lit(r)) for r in ("mark", "thickness", "head_height", "quantity"))))
    usable = F.filter(cells, lambda c: ~F.array_contains(skip, c["name"]) & (F.coalesce(c["value"], F.lit("")) != ""))
    found = F.transform(F.flatten(F.transform(usable, lambda c: F.regexp_extract_all(c["value"], F.lit(DIMENSION_TOKEN), F.lit(0)))), lambda c: F.trim(c))
    known = F.try_element_at(role, F.lit("width")).isNotNull() | F.try_element_at(role, F.lit("height")).isNotNull()
    ok = ~known & (F.size(found) >= 2)
    return F.struct(F.when(ok, F.get(found, 0)).otherwise("").alias("width"), F.when(ok, F.get(found, 1)).otherwise("").alias("height"))


def project_id(path: Column) -> Column:
    """project_<id>_... names its project; else the file's stem does."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.when(stem.rlike("^project_[^_]+_"), F.split(stem, "_")[1]).otherwise(stem)


def is_val(key: Column) -> Column:
    """The hash-stable split: the first byte of the key's SHA-256, modulo 5, is 4."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 2), 16, 10).cast("int") % 5 == 4


def class_index(name: Column) -> Column:
    """0 window, 1 door of a detector's class name; null for others. Window words win."""
    n = F.lower(name)
    return F.when(n.rlike("window|sash|glazing"), 0).when(n.rlike("door|garage"), 1)


def sheet_key(project: Column, sha256: Column, page: Column) -> Column:
    return F.concat(project, F.lit("_"), F.substring(sha256, 1, 8), F.lit("_p"), page)


def ordinal_id(prefix: Column, n: Column, digits: int = 3) -> Column:
    return F.concat(prefix, F.lpad(n.cast("string"), digits, "0"))


def valid_key(key: Column) -> Column:
    """No path can hide in such a key."""
    return key.rlike(r"^[A-Za-z0-9_-]{1,120}$")


def looked_up(value: Column, table: Mapping[str, object]) -> Column:
    """The table's value, null where it has none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), value)
