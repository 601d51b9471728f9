"""Name resolution and code classification (E01-E11), as set operations.

Every rule produces candidate rows ``(raw name, priority, key, line)``; the
union is reduced to the best priority per raw name with one window. Work runs
over *distinct* raw names, so the cost follows the vocabulary, not the fact
table. The "longest contained name" rule is an equi-join on substrings (each
raw name is exploded into its substrings of the lengths the registry uses),
not a nested-loop comparison of every name with every registry entry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens import config as C


def normalize_line(col: str | Column) -> Column:
    """Exact valid code, else SRT / SHP / BD-only / YU, default YU."""
    u = F.upper(F.trim(F.col(col) if isinstance(col, str) else col))
    has = lambda s: u.contains(s)
    return (F.when(u.isin(list(C.SUBWAY_LINES)), u)
            .when(has("SRT"), F.lit("SRT"))
            .when(has("SHP") | has("SHEP"), F.lit("SHP"))
            .when(has("BD") & ~has("YU"), F.lit("BD"))
            .otherwise(F.lit("YU")))


def cut_at_first(col: Column, markers: Sequence[str]) -> Column:
    """Cut at the first listed marker that occurs anywhere (list order wins)."""
    expr = None
    for m in markers:
        pos = F.instr(col, m)
        val = F.rtrim(col.substr(F.lit(1), pos - 1))
        expr = F.when(pos > 0, val) if expr is None else expr.when(pos > 0, val)
    return expr.otherwise(col)


def _regex_quote(text: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in text)


def strip_suffix(col: Column, suffixes: Sequence[str]) -> Column:
    """Strip the listed suffix the text ends with, then trailing blanks.

    No entry of a suffix list ends with another entry, so at most one suffix
    can match the end and one anchored alternation is exact; it refers to its
    input once, which keeps chained normalisation steps small.
    """
    alt = "|".join(_regex_quote(s) for s in suffixes)
    return F.regexp_replace(col, f"^(.*?)\\s*(?:{alt})$", "$1")


def _first_part(raw: Column, pattern: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(raw, pattern, 1)), F.lit(""))


def _lookup_rule(names: DataFrame, steps: list, lookup: DataFrame, priority: int) -> DataFrame:
    """Apply normalisation ``steps`` (each a function of the previous column) and look up.

    Every step is materialised as its own column, so a step refers to a plain
    column instead of repeating the whole expression of the step before it.
    """
    cand = names.select("name", F.col("name").alias("_s0"))
    for i, step in enumerate(steps):
        cand = cand.withColumn(f"_s{i + 1}", step(F.col(f"_s{i}")))
    cand = (cand.select("name", F.col(f"_s{len(steps)}").alias("core_name"))
            .filter(F.col("core_name").isNotNull()))
    return (cand.join(lookup, "core_name")
            .select("name", F.lit(priority).alias("priority"), "station_key", "line_code"))


def _longest_contained(names: DataFrame, lookup: DataFrame, priority: int,
                       min_len: int = C.MIN_SUBSTRING_MATCH) -> DataFrame:
    """The longest registry name (>= min_len chars) contained in the raw name; of
    equally long ones the first in the registry (``ordinal``; without one, by name)."""
    lengths = (lookup.select(F.length("core_name").alias("len"))
               .filter(F.col("len") >= min_len).distinct())
    n = F.length("name")
    per_len = names.select(
        "name", F.explode(F.when(n >= min_len, F.sequence(F.lit(min_len), n))).alias("len"))
    per_len = per_len.join(F.broadcast(lengths), "len")
    subs = per_len.select(
        "name", "len",
        F.explode(F.sequence(F.lit(1), F.length("name") - F.col("len") + 1)).alias("pos"))
    subs = subs.select("name", "len", F.expr("substring(name, pos, len)").alias("core_name")).distinct()
    hits = subs.join(lookup, "core_name")
    place = [F.col("ordinal").asc()] if "ordinal" in lookup.columns else []
    w = Window.partitionBy("name").orderBy(F.col("len").desc(), *place, F.col("core_name").asc())
    return (hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("name", F.lit(priority).alias("priority"), "station_key", "line_code"))


def _rules(names: DataFrame, lookup: DataFrame, overrides: DataFrame | None) -> list[DataFrame]:
    out = []
    if overrides is not None:
        out.append(names.join(overrides.withColumnRenamed("raw_station_name", "name"), "name")
                   .select("name", F.lit(1).alias("priority"), "station_key", "line_code"))
    strip_station = lambda c: strip_suffix(c, C.STATION_SUFFIXES)
    strip_line = lambda c: strip_suffix(c, C.LINE_SUFFIXES)
    out.append(_lookup_rule(names, [lambda c: cut_at_first(c, C.STATION_SUFFIXES),
                                    lambda c: strip_suffix(c, C.FACILITY_SUFFIXES),
                                    strip_line], lookup, 2))
    out.append(_lookup_rule(names, [lambda c: _first_part(c, r"^(.+?)\s+TO\s+"),
                                    strip_station, strip_line], lookup, 3))
    out.append(_lookup_rule(names, [lambda c: _first_part(c, r"^(.+?)\s+AND\s+"),
                                    strip_line], lookup, 4))
    out.append(_longest_contained(names, lookup, 5))
    out.append(_lookup_rule(names, [lambda c: _first_part(c, r"^BETWEEN\s+(.+?)\s+AND\s+"),
                                    strip_station, strip_line], lookup, 7))
    return out


def _best(cands: list[DataFrame]) -> DataFrame:
    allc = cands[0]
    for c in cands[1:]:
        allc = allc.unionByName(c)
    w = Window.partitionBy("name").orderBy("priority", "station_key")
    return allc.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def primary_lines(raw: DataFrame, name_col: str = "station", line_col: str = "line") -> DataFrame:
    """Per raw name, the most frequent line (ties: smaller code) and total occurrences."""
    pairs = (raw.filter(F.col(name_col).isNotNull() & (F.trim(F.col(name_col)) != ""))
             .groupBy(F.col(name_col).alias("raw_station_name"), F.col(line_col).alias("line"))
             .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("raw_station_name").orderBy(F.col("n").desc(), F.col("line").asc_nulls_last())
    return (pairs.withColumn("_r", F.row_number().over(w))
            .withColumn("total_occurrences", F.sum("n").over(Window.partitionBy("raw_station_name")))
            .filter(F.col("_r") == 1)
            .select("raw_station_name", F.col("line").alias("primary_line"), "total_occurrences"))


def resolve_names(names: DataFrame, lookup: DataFrame, registry: DataFrame,
                  overrides: DataFrame | None = None) -> DataFrame:
    """Exactly one (canonical name, station key, line) per raw name.

    ``names``: raw_station_name, primary_line.  ``lookup``: core_name,
    station_key, line_code.  ``registry``: station_key, canonical_station_name.
    ``overrides``: raw_station_name, station_key, line_code.
    Priority: override (E02), normalised core (E03), 'X TO Y' / 'X AND Y' (E04),
    longest contained name (E05), 'APPROACHING X' (the remainder resolved by the
    same rules) and 'BETWEEN X AND Y' (E06), then Unknown with the normalised
    primary line (E07). The registries themselves are data (E08): the caller
    passes them as DataFrames.
    """
    n = names.select(F.col("raw_station_name").alias("name"), "primary_line").distinct()
    first = _rules(n.select("name"), lookup, overrides)
    rem = n.select("name", F.trim(F.regexp_extract("name", r"^\(?APPROACH(?:ING)?\)?\s*(.+)", 1))
                   .alias("rest")).filter(F.col("rest") != "")
    rest_best = _best(_rules(rem.select(F.col("rest").alias("name")).distinct(), lookup, overrides))
    approach = (rem.join(rest_best.withColumnRenamed("name", "rest"), "rest")
                .select("name", F.lit(6).alias("priority"), "station_key", "line_code"))
    best = _best(first + [approach])
    unknown_name, unknown_key = C.UNKNOWN_STATION
    reg = registry.select("station_key", "canonical_station_name")
    return (n.join(best, "name", "left").join(F.broadcast(reg), "station_key", "left")
            .select(F.col("name").alias("raw_station_name"),
                    F.coalesce("canonical_station_name", F.lit(unknown_name)).alias("canonical_station_name"),
                    F.coalesce("station_key", F.lit(unknown_key)).alias("station_key"),
                    F.coalesce("line_code", normalize_line("primary_line")).alias("line_code"),
                    F.coalesce("priority", F.lit(8)).alias("rule")))


# --- delay codes -------------------------------------------------------------

def _map_lit(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def code_category(code: str | Column) -> Column:
    """Text map > code override > suffix (weather, signal) > 2-char prefix > General."""
    c = F.col(code) if isinstance(code, str) else code
    suffix = F.substr(c, F.lit(3))
    return F.coalesce(
        F.try_element_at(_map_lit(C.TEXT_CATEGORY), c),
        F.try_element_at(_map_lit(C.CODE_CATEGORY_OVERRIDES), c),
        F.when(F.length(c) >= 2, F.when(suffix.isin(list(C.WEATHER_SUFFIXES)), F.lit("Weather"))
               .when(suffix.isin(list(C.SIGNAL_SUFFIXES)), F.lit("Signal"))),
        F.when(F.length(c) >= 2, F.try_element_at(_map_lit(C.PREFIX_CATEGORY), F.substring(c, 1, 2))),
        F.lit("General"))


def classify_codes(codes: DataFrame, suffix_desc: DataFrame,
                   desc_overrides: DataFrame | None = None, code_col: str = "delay_code") -> DataFrame:
    """E09 + E10 over distinct codes: (delay_code, delay_description, delay_category).

    Description: override > self-describing text > longest suffix-prefix found
    in ``suffix_desc`` (suffix, description) > '<prefix label> - Code <suffix>'
    > the code itself.
    """
    d = codes.select(F.col(code_col).alias("delay_code")).filter(F.col("delay_code").isNotNull()).distinct()
    suffix = F.substr("delay_code", F.lit(3))
    pref = (d.select("delay_code", suffix.alias("sfx"))
            .filter((F.length("delay_code") >= 2) & (F.length("sfx") > 0))
            .select("delay_code", F.explode(F.sequence(F.lit(1), F.length("sfx"))).alias("l"), "sfx")
            .select("delay_code", "l", F.expr("substring(sfx, 1, l)").alias("suffix")))
    longest = (pref.join(F.broadcast(suffix_desc), "suffix")
               .groupBy("delay_code").agg(F.max_by("description", "l").alias("sfx_desc")))
    out = d.join(longest, "delay_code", "left")
    if desc_overrides is not None:
        out = out.join(F.broadcast(desc_overrides.withColumnRenamed("description", "ovr_desc")),
                       "delay_code", "left")
    else:
        out = out.withColumn("ovr_desc", F.lit(None).cast("string"))
    c = F.col("delay_code")
    label = F.try_element_at(_map_lit(C.PREFIX_LABEL), F.substring(c, 1, 2))
    sfx = F.substr(c, F.lit(3))
    derived = (F.when(F.length(c) < 2, c)
               .when(sfx == "", F.coalesce(F.concat(label, F.lit(" - General")), c))
               .otherwise(F.coalesce(F.col("sfx_desc"), F.concat(label, F.lit(" - Code "), sfx), c)))
    text = F.when(F.try_element_at(_map_lit(C.TEXT_CATEGORY), c).isNotNull(), c)
    return out.select(
        "delay_code",
        F.coalesce(F.col("ovr_desc"), text, derived).alias("delay_description"),
        code_category(c).alias("delay_category"))


def code_counts(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Occurrences of each non-blank code over several sources, merged."""
    parts = []
    for df, col in sources:
        parts.append(df.select(F.trim(F.col(col)).alias("delay_code"))
                     .filter(F.col("delay_code").isNotNull() & (F.col("delay_code") != ""))
                     .groupBy("delay_code").agg(F.count(F.lit(1)).alias("n")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("delay_code").agg(F.sum("n").alias("occurrences"))


# --- station feed neighbourhood ----------------------------------------------

def neighbourhood(groups: str | Column) -> Column:
    """First specific group, else first direction (not E-Charging), else Downtown."""
    g = F.col(groups) if isinstance(groups, str) else groups
    cleaned = F.transform(g, lambda x: F.trim(x))
    non = F.array(*[F.lit(x) for x in C.NON_NEIGHBOURHOOD_GROUPS])
    specific = F.filter(cleaned, lambda x: ~F.array_contains(non, x))
    directional = F.filter(cleaned, lambda x: F.array_contains(non, x) & (x != "E-Charging"))
    pick = F.coalesce(F.get(specific, 0), F.get(directional, 0), F.lit(C.DEFAULT_NEIGHBOURHOOD))
    return F.coalesce(F.try_element_at(_map_lit(C.NEIGHBOURHOOD_CORRECTIONS), pick), pick)
