"""Map untidy workbook headers to the canonical columns.

The alias corpus is a constant inside the scoring expression, so finding the best
alias is a projection over the distinct spellings: no cross join and no Python.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.similarity import PATTERN_TYPE, indel_ratio, pattern, score_of, token_sort
from tillbook.functions.text import WHITESPACE, once
from tillbook.operators.aliases import match_aliases
from tillbook.schema import CANONICAL_COLUMNS, HEADER_ALIASES

DEFAULT_THRESHOLD = 70

# Control characters that count as blanks around a header, on top of white space.
_HEADER_BLANKS = WHITESPACE + "\x1c\x1d\x1e\x1f"


def normalise(header: Column) -> Column:
    """Trim, lower-case, and turn each space or hyphen into ``_`` (runs are kept)."""
    return F.translate(F.lower(F.btrim(header, F.lit(_HEADER_BLANKS))), " -", "__")


def _exact_lookup() -> Column:
    """Constant map from alias to canonical name."""
    lookup = {s: name for name, spellings in HEADER_ALIASES.items() for s in spellings}
    return F.from_json(F.lit(json.dumps(lookup)), "map<string,string>")


def _corpus() -> Column:
    """Constant list of all aliases, ready to be compared; the optimizer parses it once."""
    pairs = [(s, name) for name, spellings in HEADER_ALIASES.items() for s in spellings]
    entries = [
        {"rank": -i, "alias": s, "canonical": name, "pattern": pattern(" ".join(sorted(s.split())))}
        for i, (s, name) in enumerate(pairs)
    ]
    entry_type = f"struct<rank:int,alias:string,canonical:string,pattern:{PATTERN_TYPE}>"
    return F.from_json(F.lit(json.dumps(entries)), f"array<{entry_type}>")


def built_in_aliases(spark: SparkSession) -> DataFrame:
    """The built-in aliases as a table (alias, canonical, rank), to add others to."""
    rows = [(s, name) for name, spellings in HEADER_ALIASES.items() for s in spellings]
    return spark.createDataFrame([(s, name, i) for i, (s, name) in enumerate(rows)], "alias string, canonical string, rank long")


def _no_match() -> Column:
    text = F.lit(None).cast("string")
    return F.struct(F.lit(0.0).alias("ratio"), F.lit(-999).alias("rank"), text.alias("alias"), text.alias("canonical"))


def best_alias(normalised: Column) -> Column:
    """Struct ``(ratio, rank, alias, canonical)`` of the most similar alias; the earlier alias wins a tie."""
    chars = F.filter(F.split(token_sort(normalised), ""), lambda c: c != "")

    def score(entry: Column) -> Column:
        return F.struct(
            indel_ratio(chars, entry["pattern"]).alias("ratio"),
            entry["rank"].alias("rank"),
            entry["alias"].alias("alias"),
            entry["canonical"].alias("canonical"),
        )

    scored = F.array_max(F.transform(_corpus(), score))
    return F.when(F.size(chars) > 0, scored).otherwise(_no_match())


def match_header(normalised: Column, threshold: int = DEFAULT_THRESHOLD) -> Column:
    """Struct ``(canonical, via_alias, score, method)`` for one normalised header.

    ``method`` is ``exact``, ``fuzzy``, ``low_score`` or ``no_match``; only the
    first two have a canonical name. Scoring runs for headers without an exact
    match only.
    """

    def report(found: Column) -> Column:
        exact, best = found["exact"], found["best"]
        score = score_of(best["ratio"])
        fuzzy = score >= threshold
        return F.struct(
            F.coalesce(exact, F.when(fuzzy, best["canonical"])).alias("canonical"),
            F.coalesce(F.when(exact.isNotNull(), normalised), best["alias"]).alias("via_alias"),
            F.coalesce(F.when(exact.isNotNull(), F.lit(100)), score).alias("score"),
            F.when(exact.isNotNull(), "exact")
            .when(best["alias"].isNull(), "no_match")
            .when(fuzzy, "fuzzy")
            .otherwise("low_score")
            .alias("method"),
        )

    exact = F.try_element_at(_exact_lookup(), normalised)
    best = F.when(exact.isNull(), best_alias(normalised))
    return once(F.struct(exact.alias("exact"), best.alias("best")), report)


def header_map(raw_files: DataFrame, threshold: int = DEFAULT_THRESHOLD, aliases: DataFrame | None = None) -> DataFrame:
    """One row per header of each file with the canonical column it maps to."""
    return header_lists(raw_files, threshold, aliases).select(
        "path", "source_file", F.posexplode("mapped").alias("position", "m")
    ).select("path", "source_file", "position", "m.*")


def header_lists(raw_files: DataFrame, threshold: int = DEFAULT_THRESHOLD, aliases: DataFrame | None = None) -> DataFrame:
    """The files with ``mapped``: for each header its text and its match, in order.

    Files of one origin share their whole header list, so distinct lists are
    planned once; and lists share spellings, so each distinct spelling is scored
    once. A file meets its list by a hash and the list itself. ``aliases`` (alias,
    canonical, rank) takes the place of the built-in ones and may have any size.
    """
    listed = raw_files.withColumn("list_key", F.xxhash64("headers"))
    lists = listed.where("headers IS NOT NULL").select("list_key", "headers").distinct()
    spelled = lists.select("list_key", "headers", F.posexplode("headers").alias("position", "raw_header")).withColumn(
        "normalised", normalise(F.coalesce("raw_header", F.lit("")))
    )
    spellings = spelled.select("normalised").distinct()
    if aliases is None:
        matched = spellings.select("normalised", match_header(F.col("normalised"), threshold).alias("m"))
    else:
        matched = match_aliases(spellings, aliases, threshold)
    one = F.struct("position", "raw_header", "m.canonical", "m.via_alias", "m.score", "m.method")
    # A list is no longer than a sheet is wide.
    in_order = F.array_sort(F.collect_list(one))
    mapped = spelled.join(matched, "normalised").groupBy("list_key", "headers").agg(
        F.transform(in_order, lambda x: x.dropFields("position")).alias("mapped")
    )
    return listed.join(mapped, ["list_key", "headers"], "left").drop("list_key").select(*raw_files.columns, "mapped")


def plan_files(raw_files: DataFrame, threshold: int = DEFAULT_THRESHOLD, aliases: DataFrame | None = None) -> DataFrame:
    """Decide per file whether its headers are usable, and where each column sits.

    Adds ``columns_read``, ``missing`` and ``duplicated`` (canonical names),
    ``positions`` (index of each canonical column) and ``problem`` (NULL for a
    usable file). A file without headers is kept.
    """
    found = header_lists(raw_files, threshold, aliases).withColumn(
        "names", F.coalesce(F.transform("mapped", lambda m: m["canonical"]), F.array().cast("array<string>"))
    )

    def hits(c: str) -> Column:
        return F.size(F.filter("names", lambda n: n == c))

    def names_where(condition) -> Column:
        return F.array_compact(F.array(*[F.when(condition(hits(c)), c) for c in CANONICAL_COLUMNS]))

    def position(c: str) -> Column:
        return F.nullif(F.array_position("names", c), F.lit(0)).cast("int") - 1

    planned = found.select(
        *raw_files.columns,
        F.coalesce(F.size("headers"), F.lit(0)).alias("columns_read"),
        names_where(lambda n: n == 0).alias("missing"),
        names_where(lambda n: n > 1).alias("duplicated"),
        F.struct(*[position(c).alias(c) for c in CANONICAL_COLUMNS]).alias("positions"),
    )
    problem = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(
            F.size("missing") > 0,
            F.concat(
                F.lit("No column found for "), F.array_join("missing", ", "),
                F.lit("; the sheet is headed "), F.array_join("headers", ", ", "(blank)"),
            ),
        )
        .when(
            F.size("duplicated") > 0,
            F.concat(F.lit("Several headers map to one column: "), F.array_join("duplicated", ", ")),
        )
    )
    return planned.withColumn("problem", problem)
