"""Header alignment on hand-written and random headers."""

import random

import pytest
from pyspark.sql import functions as F

from tillbook.functions.similarity import PATTERN_TYPE, indel_ratio, pattern, score_of
from tillbook.operators.headers import header_map, normalise, plan_files
from tillbook.schema import CANONICAL_COLUMNS, HEADER_ALIASES


def files(spark, **headers):
    rows = [(f"in/{name}", name, value, None) for name, value in headers.items()]
    return spark.createDataFrame(rows, "path string, source_file string, headers array<string>, error string")


def mapped(spark, headers, threshold=70):
    rows = header_map(files(spark, f=headers), threshold).collect()
    return {r.raw_header: r for r in rows}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_corpus_size():
    assert len(HEADER_ALIASES) == len(CANONICAL_COLUMNS) == 10
    assert sum(len(v) for v in HEADER_ALIASES.values()) == 68


def test_normalise_keeps_runs(spark):
    df = spark.createDataFrame([("  A  b-C\t",), ("\x1cSALE DATE\xa0",)], "h string")
    assert [r[0] for r in df.select(normalise(F.col("h"))).collect()] == ["a__b_c", "sale_date"]


def test_known_headers(spark):
    found = mapped(spark, ["SALE DATE", "Qty", "Customar_Name", "Prcie_Per_Unit", "zzz", "", "Total"])
    outcome = {h: (r.canonical, r.method, r.score) for h, r in found.items()}
    assert outcome["SALE DATE"] == ("sale_date", "exact", 100)
    assert outcome["Qty"] == ("quantity", "exact", 100)
    assert outcome["Total"] == ("sales_amount", "exact", 100)
    assert outcome["Customar_Name"] == ("customer_name", "fuzzy", 92)
    assert outcome["Prcie_Per_Unit"] == ("price_per_unit", "fuzzy", 93)
    assert outcome["zzz"][:2] == (None, "low_score")
    assert outcome[""] == (None, "no_match", 0)


def test_punctuation_splits_words(spark):
    found = mapped(spark, ["sale.date", "DATE.(sale)"])
    assert [(r.canonical, r.via_alias, r.score) for r in found.values()] == [("sale_date", "sale date", 100)] * 2


def test_threshold(spark):
    assert mapped(spark, ["Customar_Name"], threshold=93)["Customar_Name"].method == "low_score"
    assert mapped(spark, ["Customar_Name"], threshold=92)["Customar_Name"].method == "fuzzy"


def test_scores_match_brute_force(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcde_st") for _ in range(rng.randint(1, 20))) for _ in range(60)]
    aliases = [" ".join(sorted(a.split())) for v in HEADER_ALIASES.values() for a in v]
    pairs = [(t, a, pattern(a)) for t in texts for a in aliases]
    df = spark.createDataFrame(pairs, f"t string, a string, p {PATTERN_TYPE}")
    chars = F.filter(F.split("t", ""), lambda c: c != "")
    ratio = indel_ratio(chars, F.col("p"))
    for r in df.select("t", "a", ratio.alias("ratio"), score_of(ratio).alias("score")).collect():
        assert r.ratio == 200 * lcs(r.t, r.a) / (len(r.t) + len(r.a))
        assert r.score == round(r.ratio)


def test_best_alias_is_the_first_of_the_best(spark):
    rng = random.Random(11)
    ordered = [(a, c) for c, v in HEADER_ALIASES.items() for a in v]
    headers = sorted({"".join(rng.choice("aeinorstcu_") for _ in range(rng.randint(2, 14))) for _ in range(80)})
    exact = {a for a, _ in ordered}
    found = mapped(spark, headers, threshold=50)
    for h in headers:
        if h in exact:
            continue
        words = " ".join(sorted(h.split()))
        ratios = [200 * lcs(words, " ".join(sorted(a.split()))) / (len(words) + len(a)) for a, _ in ordered]
        best = max(ratios)
        assert (found[h].score, found[h].via_alias) == (round(best), ordered[ratios.index(best)][0])
        assert found[h].canonical == (ordered[ratios.index(best)][1] if round(best) >= 50 else None)


def test_plan(spark):
    good = list(CANONICAL_COLUMNS)
    planned = {
        r.source_file: r
        for r in plan_files(
            files(
                spark,
                good=good + ["Remarks"],
                missing=[c for c in good if c != "city"],
                twice=good + ["Revenue"],
                same=good[:-1] + ["Total", "Total"],
                bare=[],
            )
        ).collect()
    }
    assert planned["good"].problem is None and planned["good"].columns_read == 11
    assert planned["good"].positions.sales_amount == 9
    assert planned["missing"].missing == ["city"] and "city" in planned["missing"].problem
    assert planned["twice"].duplicated == ["sales_amount"]
    assert planned["same"].duplicated == ["sales_amount"]
    assert planned["bare"].missing == good and planned["bare"].columns_read == 0


def test_pattern_length_is_checked():
    with pytest.raises(ValueError):
        pattern("x" * 63)
