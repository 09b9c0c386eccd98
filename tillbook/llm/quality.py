"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Every document becomes a vector of transformed statistics. Per class, counts, sums and cross products
are added up over all labelled rows; the class covariances are shrunk towards the pooled one and towards
its diagonal, and factored once. How much they are shrunk is chosen by cross-validation among the labelled
rows: folds by the hash of the document's id, each judged by the moments of the others. A score is the logistic function of the difference of the two
log-densities (half squared Mahalanobis distances and log-determinants), with the class shares as prior.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import Words, fields, map_text, stored

LETTERS, UPPER, DIGITS, SPACE, LINES, STOPS, SYMBOLS = range(7)
_CLASS = np.full(256, SYMBOLS, dtype=np.uint8)
_CLASS[128:] = _CLASS[97:123] = LETTERS
_CLASS[65:91] = UPPER
_CLASS[48:58] = DIGITS
_CLASS[[9, 11, 12, 13, 32]] = SPACE
_CLASS[10] = LINES
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = STOPS

STATISTICS = (
    "words", "word_length", "upper", "digits", "space", "lines", "stops", "symbols", "repeats", "distinct",
    "variety",
)

#: Shares of the pooled covariance and of the diagonal that are tried, strongest first; without errors to
#: tell them apart, the first pair is taken.
SHRINK_POOLED = (0.8, 0.5, 0.2, 0.05)
SHRINK_DIAGONAL = (0.3, 0.1, 0.05, 0.01)
FOLDS = 4
PREDICT_FROM = 0.3


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Angle of a share: its spread hardly depends on the share itself; 0 for an empty whole."""
    return np.arcsin(np.sqrt(part / np.maximum(whole, 1)))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; a null or empty text gives zeros."""
    words = Words(texts)
    n = len(texts)
    sizes = np.diff(words.offsets)
    kinds = _CLASS[words.data]
    counts = np.zeros((n, 7), dtype=np.int64)
    for i in range(n):
        counts[i] = np.bincount(kinds[words.offsets[i] : words.offsets[i + 1]], minlength=7)
    w = words.counts
    length = np.bincount(np.repeat(np.arange(n), w), weights=words.end - words.begin, minlength=n)
    document = np.repeat(np.arange(n, dtype=np.uint64), w)
    key = np.sort((document << np.uint64(42)) | (words.hashes >> np.uint64(22)))
    fresh = np.ones(key.size, dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(42)).astype(np.int64), minlength=n)
    same = (words.hashes[1:] == words.hashes[:-1]) & (document[1:] == document[:-1])
    repeats = np.bincount(document[1:][same].astype(np.int64), minlength=n)
    letters = counts[:, LETTERS] + counts[:, UPPER]
    variety = np.log1p(w) - np.log1p(distinct)
    return np.column_stack([
        np.log1p(w),
        np.log1p(length / np.maximum(w, 1)),
        _share(counts[:, UPPER], letters),
        *(_share(counts[:, c], sizes) for c in (DIGITS, SPACE, LINES, STOPS, SYMBOLS)),
        _share(repeats, w),
        _share(distinct, w),
        variety,
    ])


def with_statistics(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` and the vector ``statistics``."""

    def start():
        return lambda texts: [_vectors(statistics(texts))]

    return map_text(docs, text, keep, fields(statistics="doubles"), start)


def _vectors(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


@dataclass
class Discriminant:
    """Class means and inverse Cholesky factors over scaled statistics; ``constant`` holds the rest."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constant: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """How likely label 1 is, between 0 and 1."""
        if not self.means.size:
            return np.full(rows.shape[0], 1 / (1 + np.exp(-self.constant)))
        x = (rows - self.center) / self.scale
        far = [(((x - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.means, self.factors, strict=True)]
        return 1 / (1 + np.exp(-np.clip(self.constant + (far[0] - far[1]) / 2, -500, 500)))


def _moments(labelled: DataFrame) -> dict[int, dict[int, np.ndarray]]:
    """Per fold and label, the sums of all products of (1, statistics) with itself, over all rows."""
    d = len(STATISTICS) + 1
    groups = [(f, c) for f in range(FOLDS) for c in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {g: np.zeros((d, d)) for g in groups}
        for batch in batches:
            rows = np.array(batch.column("statistics").flatten()).reshape(-1, d - 1)
            rows = np.column_stack([np.ones(rows.shape[0]), rows])
            label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            for f, c in groups:
                own = rows[(label == c) & (fold == f)]
                total[f, c] += own.T @ own
        for (f, c), sums in total.items():
            cell = np.arange(d * d)
            made = [pa.array(np.full(d * d, f)), pa.array(np.full(d * d, c)), pa.array(cell), pa.array(sums.ravel())]
            yield pa.RecordBatch.from_arrays(made, names=["fold", "label", "cell", "value"])

    sums = labelled.select("label", "fold", "statistics").mapInArrow(run, "fold long, label long, cell long, value double")
    out = {f: {c: np.zeros(d * d) for c in (0, 1)} for f in range(FOLDS)}
    for row in sums.groupBy("fold", "label", "cell").agg(F.sum("value").alias("value")).collect():  # 2 FOLDS d^2 numbers
        out[row["fold"]][row["label"]][row["cell"]] = row["value"]
    return {f: {c: v.reshape(d, d) for c, v in own.items()} for f, own in out.items()}


def _sum(moments: dict[int, dict[int, np.ndarray]], but: int | None = None) -> dict[int, np.ndarray]:
    return {c: sum(m[c] for f, m in moments.items() if f != but) for c in (0, 1)}


def choose_shrinkage(labelled: DataFrame, moments: dict[int, dict[int, np.ndarray]], predict_from: float = PREDICT_FROM) -> tuple[float, float]:
    """The pair of shrinkages with the least error over all folds; of equal ones the strongest.

    The error is the mean over both classes of the share of wrong predictions.
    """
    pairs = [(p, d) for p in SHRINK_POOLED for d in SHRINK_DIAGONAL]
    models = [[fit(_sum(moments, f), p, d) for p, d in pairs] for f in range(FOLDS)]
    shared = labelled.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        wrong = np.zeros((2, len(pairs)), dtype=np.int64)
        for batch in batches:
            rows = np.array(batch.column("statistics").flatten()).reshape(-1, len(STATISTICS))
            label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            for f in np.unique(fold).tolist():
                at = fold == f
                for i, model in enumerate(own[f]):
                    missed = (model.scores(rows[at]) >= predict_from) != label[at]
                    wrong[:, i] += np.bincount(label[at][missed].astype(np.int64), minlength=2)
        made = [pa.array(np.repeat([0, 1], len(pairs))), pa.array(np.tile(np.arange(len(pairs)), 2)), pa.array(wrong.ravel())]
        yield pa.RecordBatch.from_arrays(made, names=["label", "pair", "wrong"])

    counts = labelled.select("label", "fold", "statistics").mapInArrow(run, "label long, pair long, wrong long")
    n = {c: max(1.0, _sum(moments)[c][0, 0]) for c in (0, 1)}
    error = np.zeros(len(pairs))
    for row in counts.groupBy("label", "pair").agg(F.sum("wrong").alias("wrong")).collect():  # a few numbers
        error[row["pair"]] += row["wrong"] / n[row["label"]]
    return pairs[int(np.argmin(np.round(error, 12)))]


def fit(moments: dict[int, np.ndarray], pooled: float, diagonal: float) -> Discriminant:
    """The discriminant of given class moments; without two rows of either class, the prior alone."""
    n = np.array([moments[c][0, 0] for c in (0, 1)])
    prior = float(np.log((n[1] + 1) / (n[0] + 1)))
    none = np.zeros(0)
    if n.min() < 2:
        return Discriminant(none, none, none, none, prior)
    means = np.array([moments[c][0, 1:] / n[c] for c in (0, 1)])
    cov = np.array([moments[c][1:, 1:] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)])
    both = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    center, scale = means.mean(axis=0), np.sqrt(np.maximum(np.diag(both), 1e-12))
    cov, both = cov / np.outer(scale, scale), both / np.outer(scale, scale)
    factors, logs = [], []
    for own in cov:
        s = (1 - pooled) * own + pooled * both
        s = (1 - diagonal) * s + diagonal * np.diag(np.diag(s)) + 1e-6 * np.eye(s.shape[0])
        least, axes = np.linalg.eigh((s + s.T) / 2)
        if least[0] < 1e-7:  # rows that are almost equal leave only the rounding of their sums
            s = (axes * np.maximum(least, 1e-6)) @ axes.T
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(lower))
        logs.append(np.log(np.diag(lower)).sum())
    return Discriminant(center, scale, (means - center) / scale, np.array(factors), float(prior + logs[0] - logs[1]))


def train_quality(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", label: str = "quality") -> Discriminant:
    """The discriminant of all documents that have a label 0 or 1; repeated rows count each time."""
    known = labels.select(F.col(f"`{doc}`").alias("known"), F.col(f"`{label}`").cast("long").alias("label"))
    known = known.where("label in (0, 1) AND known IS NOT NULL")
    # Statistics of all texts are made where they lie: to read labelled texts only, all texts would be shuffled first.
    texts = docs.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{text}`").alias("text")).where("doc IS NOT NULL")
    rows = with_statistics(texts, "text", ["doc"]).join(known, F.col("doc") == F.col("known"))
    fold = F.pmod(F.xxhash64(F.col("doc").cast("string")), F.lit(FOLDS))
    labelled = stored(rows.select("label", "statistics", fold.alias("fold")), "labelled")
    moments = _moments(labelled)
    return fit(_sum(moments), *choose_shrinkage(labelled, moments))


def score_quality(
    docs: DataFrame, model: Discriminant, *, text: str = "text", keep: Sequence[str] | None = None, predict_from: float = PREDICT_FROM
) -> DataFrame:
    """Columns ``keep`` (default: all), score (0 to 1) and predicted (1 from ``predict_from`` on).

    Every row gets a score, a null or empty text that of a document without words. Without usable labels
    of both classes the score is their smoothed share. Input columns named like a result give way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value

        def step(texts: pa.Array) -> list[pa.Array]:
            score = own.scores(statistics(texts))
            return [pa.array(score), pa.array((score >= predict_from).astype(np.int32))]

        return step

    return map_text(docs, text, docs.columns if keep is None else keep, fields(score="double", predicted="int"), start)
