"""Best alias of each spelling against an alias table of any size.

A spelling and an alias that are similar enough share pairs of neighbouring letters, and at least a number
that follows from their lengths. An index of the aliases by such pairs gives the candidates, the count of
shared pairs leaves few of them, and only these are compared exactly. All steps are joins and grouped sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.similarity import score_of, token_sort, wide_pattern, wide_ratio

# Marks of the two ends of a text; no letter of a trimmed header.
_BEGIN, _END = "\x02", "\x03"


def _chars(words: Column) -> Column:
    return F.filter(F.split(words, ""), lambda c: c != "")


def _grams(chars: Column, size: int) -> Column:
    """Runs of one or two letters; those of two include the ends."""
    if size == 1:
        return chars
    framed = F.concat(F.array(F.lit(_BEGIN)), chars, F.array(F.lit(_END)))
    return F.zip_with(F.slice(framed, 1, F.size(chars) + 1), F.slice(framed, 2, F.size(chars) + 1), lambda a, b: F.concat(a, b))


def _counted(rows: DataFrame, name: str, size: int, length: str, count: str) -> DataFrame:
    """Per text and gram: how often the gram occurs in the text."""
    grams = rows.select(name, F.size("chars").alias(length), F.explode(_grams(F.col("chars"), size)).alias("gram"))
    return grams.groupBy(name, length, "gram").agg(F.count(F.lit(1)).alias(count))


def candidate_pairs(spelled: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """(normalised, alias): every pair whose score can reach the threshold, and some that do not.

    Both sides have ``chars``. A score counts from half a point below the threshold, as it is rounded. With
    n and m letters it takes a common subsequence of L = ratio * (n + m) / 200 letters. Between its letters and
    the two ends lie L + 1 gaps, of which the n + m - 2L other letters spoil one each; the rest are shared
    pairs of letters, at least one if the ratio is 2/3 or more. Below that, single letters are counted.
    """
    ratio = threshold - 0.5
    size = 2 if ratio * 3 >= 200 else 1
    left = _counted(spelled, "normalised", size, "n", "left")
    right = _counted(known, "alias", size, "m", "right")
    both = F.col("n") + F.col("m")
    common = F.greatest(F.ceil(ratio * both / 200 - 1e-9), F.lit(1))
    least = 3 * common + 1 - both if size == 2 else common
    met = left.join(right, "gram").where(common <= F.least("n", "m"))
    shared = met.groupBy("normalised", "alias", "n", "m").agg(F.sum(F.least("left", "right")).alias("shared"))
    return shared.where(F.col("shared") >= least).select("normalised", "alias")


def match_aliases(spellings: DataFrame, aliases: DataFrame, threshold: int) -> DataFrame:
    """(normalised, m) per distinct spelling, with m as ``match_header`` gives it.

    ``aliases`` has alias, canonical and rank; of equal aliases, and of equally similar ones, the least rank
    wins. An equal alias is an exact match. A spelling with no alias at the threshold has the method
    ``no_match`` and the score 0: aliases below the threshold are not looked for. Null aliases and aliases
    without letters match nothing but themselves.
    """
    if not 1 <= threshold <= 100:
        raise ValueError("the threshold is a score from 1 to 100")
    spellings = spellings.select("normalised").where("normalised IS NOT NULL").distinct()
    first = F.min(F.struct("rank", "canonical")).alias("first")
    known = aliases.where("alias IS NOT NULL").groupBy("alias").agg(first).select("alias", "first.*")
    whole = spellings.join(known.select(F.col("alias").alias("normalised"), "canonical"), "normalised", "left")
    exact = whole.where("canonical IS NOT NULL")
    rest = whole.where("canonical IS NULL").select("normalised", _chars(token_sort(F.col("normalised"))).alias("chars"))
    in_order = F.array_join(F.array_sort(F.filter(F.split("alias", r"(?U)\s+"), lambda w: w != "")), " ")
    known = known.withColumn("chars", _chars(in_order)).where("size(chars) > 0")
    pairs = candidate_pairs(rest, known, threshold)
    prepared = known.select("alias", "rank", "canonical", wide_pattern(F.col("chars")).alias("pattern"))
    scored = pairs.join(rest, "normalised").join(prepared, "alias")
    scored = scored.select("normalised", "alias", "rank", "canonical", wide_ratio(F.col("chars"), F.col("pattern")).alias("ratio"))
    scored = scored.where(score_of(F.col("ratio")) >= threshold)
    best = F.max(F.struct("ratio", (-F.col("rank")).alias("turn"), "alias", "canonical")).alias("best")
    best = scored.groupBy("normalised").agg(best)

    def match(canonical: Column, alias: Column, score: Column, method: Column) -> Column:
        return F.struct(canonical.alias("canonical"), alias.alias("via_alias"), score.alias("score"), method.alias("method"))

    equal = match(F.col("canonical"), F.col("normalised"), F.lit(100), F.lit("exact"))
    score = F.coalesce(score_of(F.col("best.ratio")), F.lit(0))
    method = F.when(F.col("best").isNull(), "no_match").otherwise("fuzzy")
    near = match(F.col("best.canonical"), F.col("best.alias"), score, method)
    found = rest.select("normalised").join(best, "normalised", "left").select("normalised", near.alias("m"))
    return exact.select("normalised", equal.alias("m")).union(found)
