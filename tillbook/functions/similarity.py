"""Token-sort similarity of headers, as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_sort(v: Column) -> Column:
    """Words in alphabetical order; anything but letters, digits and ``_`` separates words."""
    words = F.split(F.lower(v), r"(?U)\W+")
    return F.array_join(F.array_sort(F.filter(words, lambda w: w != "")), " ")


# Spark type of a pattern inside a larger constant.
PATTERN_TYPE = "struct<size:int,masks:map<string,bigint>>"


def pattern(text: str) -> dict:
    """A fixed text prepared for :func:`indel_ratio`: its length and, per character, a bit mask of positions."""
    if len(text) > 62:
        raise ValueError("a constant pattern is limited to 62 characters; longer aliases go into an alias table")
    masks: dict[str, int] = {}
    for i, ch in enumerate(text):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return {"size": len(text), "masks": masks}


def indel_ratio(chars: Column, pat: Column) -> Column:
    """Similarity 0-100 of a list of characters and a :data:`PATTERN_TYPE` value: ``200 * LCS / (len a + len b)``.

    The longest common subsequence is found with one bit vector per pattern:
    each text character clears at most one further bit, and the cleared bits
    count the matches.
    """
    size = pat["size"]
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - F.lit(1).cast("bigint")

    def step(bits: Column, ch: Column) -> Column:
        hit = bits.bitwiseAND(F.coalesce(F.try_element_at(pat["masks"], ch), F.lit(0).cast("bigint")))
        return (bits + hit).bitwiseOR(bits - hit).bitwiseAND(full)

    common = size - F.bit_count(F.aggregate(chars, full, step))
    return F.lit(200.0) * common / (F.size(chars) + size)


# Positions per word of a wide pattern: a word, its matches and a carry add up within a bigint.
_WORD = 62


def wide_pattern(chars: Column) -> Column:
    """A list of characters of any length prepared for :func:`wide_ratio`: size, words of set bits, and words per character."""
    size = F.size(chars)
    starts = F.sequence(F.lit(0), F.floor((F.greatest(size, F.lit(1)) - 1) / _WORD).cast("int"))

    def bits(part: Column, wanted) -> Column:
        ones = F.transform(part, lambda c, i: F.when(wanted(c), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(0))
        return F.aggregate(ones, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def words(wanted) -> Column:
        return F.transform(starts, lambda w: bits(F.slice(chars, w * _WORD + 1, F.lit(_WORD)), wanted))

    letters = F.array_distinct(chars)
    masks = F.map_from_arrays(letters, F.transform(letters, lambda x: words(lambda c: c == x)))
    return F.struct(size.alias("size"), words(lambda c: F.lit(True)).alias("words"), masks.alias("masks"))


def wide_ratio(chars: Column, pat: Column) -> Column:
    """:func:`indel_ratio` with a :func:`wide_pattern`: the bit vector has several words, sums carry over to the next."""
    size, full = pat["size"], pat["words"]
    none = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))

    def add(state: Column, mask: Column) -> Column:
        def one(done: Column, w: Column) -> Column:
            bits = F.get(state, w)
            hit = bits.bitwiseAND(F.get(mask, w))
            total = bits + hit + done["carry"]
            word = total.bitwiseOR(bits - hit).bitwiseAND(F.get(full, w))
            return F.struct(F.concat(done["out"], F.array(word)).alias("out"), F.shiftright(total, _WORD).alias("carry"))

        return F.aggregate(F.sequence(F.lit(0), F.size(full) - 1), none, one)["out"]

    def step(state: Column, ch: Column) -> Column:
        mask = F.try_element_at(pat["masks"], ch)
        return F.when(mask.isNull(), state).otherwise(add(state, mask))

    left = F.aggregate(F.aggregate(chars, full, step), F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w))
    return F.lit(200.0) * (size - left) / (F.size(chars) + size)


def score_of(ratio: Column) -> Column:
    """A ratio as a whole score, halves to even."""
    return F.bround(ratio, 0).cast("int")
