"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

Every document that passes the base rules becomes a vector of six transformed statistics. For each language
and source the location and the covariance of the three quarters of its documents that lie closest together
are estimated: from medians and quartiles, concentration steps measure the Mahalanobis distance of every
document, take those up to the distance that three quarters of them stay within, and estimate anew from
these, until no unit's log-determinant changes by more than ``SETTLED``, ``STEPS`` times at most. A last
step estimates from all documents within the usual distance. Documents farther away than a chi-square
cutoff are rejected.

All documents take part in every step. A step is one aggregation: counts, sums and products per unit and bin
of distance, so that a unit of any size is added up within the tasks first and its few hundred bins are
all that one task receives. Languages and sources with fewer than ``least`` documents form one unit per
language; what is still smaller forms one unit in all; if that is too small too, its documents are not judged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import stored

#: Least words, and the share of words in repeated windows above which a text fails the base rules.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
#: The part of the documents that the estimates rest on, and the fewest documents of a unit.
PART, LEAST_ROWS = 0.75, 60
#: Chance of a document of a normally distributed unit to be rejected.
TAIL = 1e-6
#: Chance to lie outside the distance of the last estimate.
LAST_TAIL = 0.025
STEPS, SETTLED = 12, 1e-3

_PER_OCTAVE, _LOWEST, _HIGHEST = 16, -4, 20
_GRID = 0.01


def _angle(part: str, whole: str) -> Column:
    """A share as an angle, whose spread hardly depends on the share itself."""
    return F.asin(F.sqrt(F.least(F.lit(1.0), (F.col(part) + 0.375) / (F.col(whole) + 0.75))))


def statistics() -> dict[str, tuple[Column, float]]:
    """Expressions of the transformed statistics over the counts, and the least spread of each.

    Texts that are all alike in one statistic would make the slightest difference an outlier without it.
    """
    return {
        "word_length": (F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)), 0.05),
        "symbols": (_angle("n_symbols", "word_chars"), 0.05),
        "repeats": (_angle("n_repeat_words", "n_words"), 0.10),
        "upper": (_angle("n_upper", "n_letters"), 0.05),
        "stops": (_angle("n_stops", "word_chars"), 0.04),
        "dup_lines": (_angle("n_dup_lines", "n_lines"), 0.10),
    }


#: Number of statistics; even, as the chi-square formulas need.
D = 6


def chi_square(x: float, degrees: int) -> float:
    """The distribution function for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square_quantile(tail: float, degrees: int) -> float:
    """The value exceeded with probability ``tail``, for an even number of degrees."""
    low, high = 0.0, 2000.0
    for _ in range(200):
        middle = (low + high) / 2
        above = math.exp(-middle / 2) * sum((middle / 2) ** k / math.factorial(k) for k in range(degrees // 2))
        low, high = (middle, high) if above > tail else (low, middle)
    return high


def _model(center: np.ndarray, cov: np.ndarray, n: int) -> pd.DataFrame:
    factor = np.linalg.inv(np.linalg.cholesky(cov))
    row = {"center": [center.tolist()], "factor": [factor.ravel().tolist()], "spread": [float(-np.log(np.diag(factor)).sum())], "n": [n]}
    return pd.DataFrame(row)


_SCHEMA = "unit string, center array<double>, factor array<double>, spread double, n long"


def _floor() -> np.ndarray:
    return np.array([least for _, least in statistics().values()])


def start_model(counts: pd.DataFrame, least_spread: np.ndarray) -> pd.DataFrame:
    """Medians and quartile distances of counted grid cells (dim, cell, n) of one unit."""
    center, scale, n = np.zeros(D), np.zeros(D), 0
    for dim, cells in counts.groupby("dim"):
        cells = cells.sort_values("cell")
        upto = cells["n"].cumsum().to_numpy()
        n = int(upto[-1])
        low, middle, high = (cells["cell"].to_numpy()[np.searchsorted(upto, q * n)] * _GRID for q in (0.25, 0.5, 0.75))
        center[dim], scale[dim] = middle + _GRID / 2, (high - low) / 1.349
    return _model(center, np.diag(np.maximum(scale, least_spread) ** 2), n)


def next_model(bins: pd.DataFrame, part: float, least_spread: np.ndarray) -> pd.DataFrame:
    """The estimate from the nearest bins of one unit that hold ``part`` of its documents.

    ``bins`` has bin, n and the flattened sums and products of (1, statistics).
    """
    bins = bins.sort_values("bin")
    upto = bins["n"].cumsum().to_numpy()
    n = int(upto[-1])
    last = int(np.searchsorted(upto, math.ceil(part * n)))
    sums = bins.iloc[: last + 1]
    inside = int(upto[last])
    center = np.array([sums[f"s{i}"].sum() for i in range(D)]) / inside
    cov = np.zeros((D, D))
    for i in range(D):
        for j in range(i + 1):
            cov[i, j] = cov[j, i] = sums[f"p{i}_{j}"].sum() / inside - center[i] * center[j]
    # Of a normal distribution, the nearest part alone has a smaller covariance than the whole.
    share = min(inside / n, 1 - LAST_TAIL)
    cov *= share / chi_square(chi_square_quantile(1 - share, D), D + 2)
    cov, center = np.round(cov, 10), np.round(center, 10)  # sums differ in their last digits with the order of rows
    cov += np.diag(np.maximum(least_spread**2 - np.diag(cov), 0)) + 1e-9 * np.eye(D)
    return _model(center, cov, n)


def _distance(model: str = "") -> Column:
    """Squared Mahalanobis distance of x0 … from a model's center and factor."""
    center, factor = F.col(f"{model}center"), F.col(f"{model}factor")
    out = F.lit(0.0)
    for i in range(D):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.get(factor, F.lit(i * D + j)) * (F.col(f"x{j}") - F.get(center, F.lit(j)))
        out = out + z * z
    return out


def _bins(rows: DataFrame, models: DataFrame, bin_of: Column) -> DataFrame:
    """Per unit and bin of distance: count, sums and products of the statistics."""
    binned = rows.join(models.select("unit", "center", "factor"), "unit").withColumn("far", _distance()).withColumn("bin", bin_of)
    x = [F.col(f"x{i}") for i in range(D)]
    return binned.groupBy("unit", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(D)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(D) for j in range(i + 1)],
    )


@dataclass
class Estimates:
    """``models``: (lang, source, center, factor) of every language and source that could be estimated."""

    models: DataFrame
    steps: int


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(100 * MOST_REPEATED))


def _vectors(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """The row as a struct, its language and source as text, base_failed and the statistics x0 …"""
    x = [expression.alias(f"x{i}") for i, (expression, _) in enumerate(statistics().values())]
    known = [F.col(f"`{c}`").cast("string").alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    return counted.select(F.struct("*").alias("row"), *known, base_failed().alias("base_failed"), *x)


def estimate(counted: DataFrame, *, lang: str = "lang", source: str = "source", least: int = LEAST_ROWS, part: float = PART) -> Estimates:
    """Robust estimates from all rows of ``textrules.with_counts`` that pass the base rules.

    A null language or source is a group of its own. Repeated rows count each time. Without rows there is no estimate.
    """
    judged = _vectors(counted, lang, source).where("NOT base_failed").drop("row", "base_failed")
    sizes = stored(judged.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "outlier-sizes")
    small = sizes.where(F.col("n") < least)
    by_lang = small.groupBy("lang").agg(F.sum("n").alias("pooled"))
    rest = by_lang.where(F.col("pooled") < least).agg(F.sum("pooled")).first()[0] or 0
    named = sizes.join(by_lang.withColumnRenamed("lang", "pool"), F.col("lang").eqNullSafe(F.col("pool")), "left")
    unit = lambda level, *by: F.to_json(F.struct(F.lit(level).alias("level"), *by))
    units = stored(
        named.select(
            F.col("lang").alias("unit_lang"), F.col("source").alias("unit_source"),
            F.when(F.col("n") >= least, unit(2, "lang", "source")).when(F.col("pooled") >= least, unit(1, "lang"))
            .when(F.lit(rest >= least), unit(0)).alias("unit"),
        ).where("unit IS NOT NULL"),
        "outlier-units",
    )
    same = F.col("lang").eqNullSafe(F.col("unit_lang")) & F.col("source").eqNullSafe(F.col("unit_source"))
    rows = stored(judged.join(units, same).select("unit", *[f"x{i}" for i in range(D)]), "outlier-statistics")

    least_spread = _floor()
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.floor(F.col(f"x{i}") / _GRID).alias("cell")) for i in range(D)]))
    counts = rows.select("unit", cells.alias("c")).groupBy("unit", "c.dim", "c.cell").agg(F.count(F.lit(1)).alias("n"))

    def begin(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        return start_model(cells, least_spread).assign(unit=key[0])

    def proceed(share: float):
        return lambda key, bins: next_model(bins, share, least_spread).assign(unit=key[0])

    models = stored(counts.groupBy("unit").applyInPandas(begin, _SCHEMA), "outlier-model")
    octaves = F.floor(F.log2(F.col("far")) * _PER_OCTAVE)
    by_distance = F.when(F.col("far") < 2.0**_LOWEST, F.lit(_LOWEST * _PER_OCTAVE)).otherwise(F.least(octaves, F.lit(_HIGHEST * _PER_OCTAVE)))
    steps, change = 0, 1.0
    while steps < STEPS and change > SETTLED:
        before = models.select("unit", F.col("spread").alias("before"))
        models = stored(_bins(rows, models, by_distance).groupBy("unit").applyInPandas(proceed(part), _SCHEMA), "outlier-model")
        change = models.join(before, "unit").agg(F.max(F.abs(F.col("spread") - F.col("before")))).first()[0] or 0.0
        steps += 1
    within = (F.col("far") > chi_square_quantile(LAST_TAIL, D)).cast("long")
    # All rows of the first bin, those within the distance, and no more.
    models = stored(_bins(rows, models, within).groupBy("unit").applyInPandas(proceed(0.0), _SCHEMA), "outlier-model")
    return Estimates(stored(units.join(models, "unit").drop("unit"), "outlier-models"), steps)


def judge(counted: DataFrame, estimates: Estimates, *, lang: str = "lang", source: str = "source", tail: float = TAIL) -> DataFrame:
    """All columns of ``counted``, base_failed, distance (squared; null if not judged) and kept, for every row.

    kept is false for rows that fail the base rules, and for others where the distance exceeds the chi-square
    cutoff; rows whose language and source could not be estimated are kept. Columns named like a result give way.
    """
    rows = _vectors(counted, lang, source)
    same = F.col("lang").eqNullSafe(F.col("unit_lang")) & F.col("source").eqNullSafe(F.col("unit_source"))
    found = rows.join(estimates.models, same, "left").withColumn("far", F.when(~F.col("base_failed"), _distance()))
    within = F.coalesce(F.col("far") <= chi_square_quantile(tail, D), F.lit(True))
    results = ("base_failed", "distance", "kept")
    keep = [F.col("row").getField(c).alias(c) for c in counted.columns if c.lower() not in results]
    return found.select(*keep, "base_failed", F.col("far").alias("distance"), (~F.col("base_failed") & within).alias("kept"))
