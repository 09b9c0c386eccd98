"""Alias tables of any size, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tillbook.functions.similarity import wide_pattern, wide_ratio
from tillbook.operators.aliases import match_aliases
from tillbook.operators.headers import built_in_aliases, header_map
from tillbook.schema import HEADER_ALIASES


def lcs(a, b):
    """Length of the longest common subsequence, by bits of one long integer."""
    full = (1 << len(b)) - 1
    masks = {c: sum(1 << i for i, x in enumerate(b) if x == c) for c in set(b)}
    bits = full
    for c in a:
        hit = bits & masks.get(c, 0)
        bits = ((bits + hit) | (bits - hit)) & full
    return len(b) - bits.bit_count()


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b))


def in_order(text):
    return " ".join(sorted(text.split()))


def brute(spelling, aliases, threshold):
    """(alias, score) of the best alias, or None; aliases in the order of their ranks."""
    if spelling in aliases:
        return spelling, 100
    best = max(((ratio(spelling, in_order(a)), -i) for i, a in enumerate(aliases) if in_order(a)), default=(0, 0))
    return (aliases[-best[1]], round(best[0])) if round(best[0]) >= threshold else None


def found(spark, spellings, aliases, threshold):
    table = spark.createDataFrame([(a, f"c:{a}", i) for i, a in enumerate(aliases)], "alias string, canonical string, rank long")
    rows = match_aliases(spark.createDataFrame([(s,) for s in spellings], "normalised string"), table, threshold).collect()
    assert len(rows) == len(set(spellings))
    for r in rows:
        assert r.m.canonical == (None if r.m.via_alias is None else f"c:{r.m.via_alias}")
        assert r.m.method == ("no_match" if r.m.via_alias is None else "exact" if r.normalised in aliases else "fuzzy")
    return {r.normalised: (r.m.via_alias, r.m.score) if r.m.via_alias is not None else None for r in rows}


def invented(rng, letters, least, most):
    return "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))


def spoiled(rng, text, letters):
    out = list(text)
    for _ in range(rng.randint(0, max(1, len(out) // 3))):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [rng.choice(letters)], [out[at], rng.choice(letters)]])
        out = out or ["a"]
    return "".join(out)


def test_wide_ratio_of_any_length(spark):
    rng = random.Random(3)
    sizes = [1, 2, 61, 62, 63, 124, 125, 200, 400]
    pairs = [(invented(rng, "abcé_", n, n), invented(rng, "abcé_", m, m)) for n in sizes for m in sizes]
    pairs += [("x" * n, "x" * m) for n in (62, 124, 150) for m in (61, 62, 186)] + [("", "abc"), ("q", "abc")]
    chars = [F.filter(F.split(c, ""), lambda x: x != "") for c in ("a", "b")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", wide_ratio(chars[0], wide_pattern(chars[1])).alias("r")).collect():
        assert r.r == ratio(r.a, r.b)


@pytest.mark.parametrize("threshold", [1, 40, 67, 70, 90, 100])
def test_equal_to_brute_force(spark, threshold):
    rng = random.Random(threshold)
    letters = "abcdeo_t"
    aliases = [invented(rng, letters, 1, 90) for _ in range(60)] + [invented(rng, letters, 1, 6) for _ in range(60)]
    aliases = list(dict.fromkeys(aliases))
    spellings = {spoiled(rng, rng.choice(aliases), letters) for _ in range(100)} | {invented(rng, letters, 1, 8) for _ in range(30)}
    assert found(spark, sorted(spellings), aliases, threshold) == {s: brute(s, aliases, threshold) for s in spellings}


def test_twenty_thousand_aliases(spark):
    rng = random.Random(17)
    letters = "abcdefghijklmnoprstuvwy_"
    aliases = list(dict.fromkeys(invented(rng, letters, 4, 24) for _ in range(19_800)))
    aliases += [invented(rng, letters, 150, 200) for _ in range(200)]
    spellings = sorted({spoiled(rng, a, letters) for a in rng.sample(aliases, 30) + aliases[-15:]})
    result = found(spark, spellings, aliases, 70)
    assert result == {s: brute(s, aliases, 70) for s in spellings}
    assert sum(v is not None for v in result.values()) > 30


def test_odd_aliases_and_spellings(spark):
    rows = [("sale date", "b", 5), ("sale date", "a", 2), (None, "n", 0), ("", "blank", 1), ("date of sale", "d", 7)]
    table = spark.createDataFrame(rows, "alias string, canonical string, rank long")
    spelled = spark.createDataFrame([("sale date",), ("sale.date",), ("",), (None,), ("...",), ("sale date",)], "normalised string")
    out = {r.normalised: tuple(r.m) for r in match_aliases(spelled, table, 70).collect()}
    assert out == {
        "sale date": ("a", "sale date", 100, "exact"), "sale.date": ("a", "sale date", 100, "fuzzy"),
        "": ("blank", "", 100, "exact"), "...": (None, None, 0, "no_match"),
    }
    assert match_aliases(spelled.limit(0), table, 70).count() == 0
    assert {r.m.method for r in match_aliases(spelled, table.limit(0), 70).collect()} == {"no_match"}
    with pytest.raises(ValueError):
        match_aliases(spelled, table, 0)


def test_same_as_the_built_in_list(spark):
    rng = random.Random(5)
    known = [a for v in HEADER_ALIASES.values() for a in v]
    headers = sorted({spoiled(rng, rng.choice(known), "aeinorst_ -") for _ in range(120)} | {"Customer Name", "", "zzz"})
    files = spark.createDataFrame([("in/f", "f", headers, None)], "path string, source_file string, headers array<string>, error string")
    one = {r.raw_header: r for r in header_map(files).collect()}
    two = {r.raw_header: r for r in header_map(files, aliases=built_in_aliases(spark)).collect()}
    assert one.keys() == two.keys()
    for h, r in one.items():
        if r.canonical is None:
            assert (two[h].canonical, two[h].method) == (None, "no_match")
        else:
            assert (two[h].canonical, two[h].via_alias, two[h].score, two[h].method) == (r.canonical, r.via_alias, r.score, r.method)
