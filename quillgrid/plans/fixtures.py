"""Layout tables made from the star-schema tables by whole-number rules.

Each is SQL that Spark and DuckDB read alike, tables in braces and a row for each
number in angle brackets; so both engines start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TITLES = [
    "DOOR SCHEDULE", "WINDOW SCHEDULE", "SCHEDULE OF OPENINGS", "WINDOW TYPES", "DOOR ELEVATIONS & DETAILS", "DOOR HARDWARE", "GENERAL NOTES", "FRAME TYPES", "ROOM FINISH SCHEDULE",
    "SHEET INDEX", "OVERHEAD DOOR SCHEDULE", "LIGHTING FIXTURE SCHEDULE", "WINDOW AND DOOR LEGEND", "STOREFRONT ELEVATION", "PANEL SCHEDULE", "PLUMBING CHART", "REFLECTED CEILING PLAN", "GLAZING TYPES:", "WINDOW SILL DETAIL", "MULLION TYPES",
]
SPECS = [
    "HM FLUSH DOOR 90 MIN", "ALUM SLIDER WINDOW TEMP GL", "SCWD DOOR PR 20 MINUTE", "FX WINDOW INSUL LOW-E", "S.G.D. TEMPERED", "OH DOOR SECTIONAL STL", "CSMT EGRESS", "WD LOUVER", "FRP DOOR 6 PANEL",
    "STOREFRONT CLEAR INSUL", "DH VINYL OBSCURE", "FLUSH WITH WALL MTL", "BI-FOLD HCWD", "EXTERIOR PAIR FRENCH DOOR ADA", "SKYLIGHT FIXED LAMINATED", "POCKET DOOR INTERIOR", "GRILLE", "SELF-CLOSING HM DOOR 45 MIN", "3 LITE AWNING SASH", "BLANK",
]
DIMS = ["3' - 6\"", "3/0", "36", "VARIES", "", "7'-0", "2/14", "3.5\"", "N/A", "10 ' 2"]


def values(rows: list[str], name: str) -> str:
    body = ", ".join("({}, '{}')".format(i, r.replace("'", "''")) for i, r in enumerate(rows))
    return f"(values {body}) as {name}(k, s)"


D = "cast({} as double)".format
NUMBERS = "<0..7>"
TABLES = {
    "boxes": f"""select event_id as box_id, user_id as page, {D("(event_id * 37) % 1000")} as x0, {D("(event_id * 53) % 800")} as y0,
        {D("(event_id * 37) % 1000 + 20 + (event_id * 7) % 60")} as x1, {D("(event_id * 53) % 800 + 20 + (event_id * 11) % 60")} as y1,
        {D("(event_id * 7919) % 1000")} / 1000 as conf, case when event_type in ('click', 'view') then 'sheet' else 'block' end as source,
        case event_type when 'view' then 'window' when 'click' then 'door' when 'purchase' then 'garage_door' else '' end as cls from {{events}}""",
    "areas": f"""select u.user_id as page, i as area_ord, {D("(i * 170 + u.user_id) % 900 + case when i >= 6 then 15 else 0 end")} as x0, {D("(i % 6 * 130) % 600 + case when i >= 6 then 15 else 0 end")} as y0,
        {D("(i * 170 + u.user_id) % 900 + case when i >= 6 then 105 else 0 end + 120 + 40 * (i % 5)")} as x1, {D("(i % 6 * 130) % 600 + 160 + 40 * (i % 5)")} as y1,
        case (u.user_id + i) % 6 when 0 then 'window_area' when 1 then 'door_area' when 2 then 'garage_area' when 3 then 'exclude' when 4 then 'mixed' else 'unknown' end as area_type
        from (select user_id, <0..7> as i from (select distinct user_id from {{events}}) v) u""",
    "titles": f"""select p_partkey as title_id, cast(floor(p_partkey / 4) as bigint) as page, v.s as title, {D("9 + p_size % 12")} as size, {D("(p_partkey * 41) % 2000")} as x0, {D("(p_partkey * 29) % 1500")} as y0,
        {D("(p_partkey * 41) % 2000 + 150")} as x1, {D("(p_partkey * 29) % 1500 + 20")} as y1 from {{part}} join {values(TITLES, "v")} on p_partkey % {len(TITLES)} = v.k""",
    "comps": f"""select o_orderkey as comp_id, cast(floor(o_custkey / 3) as bigint) as page, {D("(o_orderkey * 61) % 2000")} as x0, {D("(o_orderkey * 43) % 1500")} as y0,
        {D("(o_orderkey * 61) % 2000 + 40 + o_orderkey % 90")} as x1, {D("(o_orderkey * 43) % 1500 + 30 + o_orderkey % 70")} as y1, {D("1560")} as page_h from {{orders}}""",
    "specs": f"""select p_partkey as item_id, v.s as spec, case p_partkey % 3 when 0 then 'door' when 1 then 'window' else 'unknown' end as block_category,
        case when p_partkey % 4 = 0 then 'F' when p_partkey % 4 = 1 then 'G' else '' end as type_code from {{part}} join {values(SPECS, "v")} on p_partkey % {len(SPECS)} = v.k""",
    "dims": f"select p_partkey as item_id, v.s as dim from {{part}} join {values(DIMS, 'v')} on (p_partkey + p_size) % {len(DIMS)} = v.k",
    "lines": f"""select l_orderkey as page, l_linenumber as line_no, l_partkey % 3 as block, {D("10 + l_partkey % 4")} as size, {D("l_linenumber * 14 + l_partkey % 9")} as y0, {D("l_linenumber * 14 + l_partkey % 9 + 10")} as y1,
        {D("l_partkey % 400")} as x0, {D("l_partkey % 400 + 6 * length(l_returnflag || l_linestatus) + l_suppkey % 50")} as x1, l_returnflag || l_linestatus as text from {{lineitem}}""",
    "words": f"""select l_orderkey * 8 + l_linenumber as word_id, l_suppkey as page, {D("(l_partkey * 13 + l_orderkey) % 1800")} as x0, {D("(l_orderkey * 7) % 1400")} as y0,
        {D("(l_partkey * 13 + l_orderkey) % 1800 + 8 + l_partkey % 30")} as x1, {D("(l_orderkey * 7) % 1400 + 8")} as y1, l_returnflag || cast(l_partkey % 10 as varchar(3)) as text from {{lineitem}}""",
    "revisions": "select cast(conv_id as varchar(20)) as sheet_key, turn as rev, case when turn % 7 = 6 then 'delete' when role = 'user' then 'save' else 'verify' end as op, cast(length(text) as bigint) as payload from {conversations}",
}


def sql_of(name: str) -> str:
    """DuckDB's text of a table."""
    return re.sub(r"\{(\w+)\}", r"\1", TABLES[name]).replace(NUMBERS, "unnest(range(8))")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A layout table, or a table of the star schema as it is."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    used = set(re.findall(r"\{(\w+)\}", TABLES[name]))
    return spark.sql(TABLES[name].replace(NUMBERS, "explode(sequence(0, 7))"), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def with_tables(names: list[str], query: str) -> str:
    """A DuckDB query that begins with the named layout tables."""
    if not names:
        return query.strip()
    return "with " + ", ".join(f"{n} as ({sql_of(n)})" for n in names) + " " + query
