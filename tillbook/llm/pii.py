"""Personal data by weak supervision: labelers vote, their reliability is estimated, a classifier decides.

Base patterns find spans that always stay; looser patterns propose more. Six labelers (pattern, validity,
gazetteer, context, shape, border) vote on every candidate. Over all documents the candidates are counted by
their votes and traits, which leaves a table of bounded size; expectation-maximisation on it estimates how
reliable each labeler is, and how likely each pattern of votes is personal data. These likelihoods train a
logistic classifier per kind on votes and traits; proposals it finds likelier than not are added.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import map_text, pieces, prepare
from tillbook.llm.pii_labelers import KINDS, LABELERS, Candidate, add_apart, candidates

_BASES = (len(KINDS), *[3] * len(LABELERS), 4, 4, 5)
ADD_FROM = 0.5

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("base", T.BooleanType()),
])
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))


def pattern_of(c: Candidate) -> int:
    """Kind, votes and traits as one number."""
    out = 0
    for base, value in zip(_BASES, (c.kind, *(v + 1 for v in c.votes), *c.traits), strict=True):
        out = out * base + value
    return out


def _columns(patterns: np.ndarray) -> np.ndarray:
    out = np.empty((patterns.size, len(_BASES)), dtype=np.int64)
    for k in range(len(_BASES) - 1, -1, -1):
        patterns, out[:, k] = np.divmod(patterns, _BASES[k])
    return out


def count_patterns(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The patterns of all candidates of all documents, and how often each occurs."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            for piece in pieces(batch, 0):
                for value in piece.column(0):
                    seen.update(pattern_of(c) for c in candidates(value.as_py()))
        made = [pa.array(list(seen.keys()), pa.int64()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(made, names=["pattern", "n"])

    texts = docs.select(F.col(f"`{text}`").cast("string"))
    counted = texts.mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = counted.orderBy("pattern").toArrow()  # one row per pattern: bounded by the labelers, not by the data
    return rows["pattern"].to_numpy(), rows["n"].to_numpy()


def likelihoods(votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """How likely each row of votes (-1, 0, 1) is of the class, and each labeler's share of right votes.

    Expectation-maximisation with independent labelers whose silence says nothing. It starts from the
    majority, and from labelers that are right four times in five.
    """
    net = votes.sum(axis=1)
    q = np.where(net > 0, 0.9, np.where(net < 0, 0.1, 0.5))
    right = np.full(votes.shape[1], 0.8)
    for _ in range(rounds):
        prior = (n @ q + 1) / (n.sum() + 2)
        for k in range(votes.shape[1]):
            yes, no = votes[:, k] > 0, votes[:, k] < 0
            agreed = n[yes] @ q[yes] + n[no] @ (1 - q[no])
            right[k] = np.clip((agreed + 4) / (n[yes].sum() + n[no].sum() + 5), 0.02, 0.98)
        odds = np.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done = np.abs(new - q).max(initial=0) < 1e-9
        q = new
        if done:
            break
    return q, right


def _features(columns: np.ndarray) -> np.ndarray:
    """One column per vote and trait value, and a constant."""
    parts = [np.ones((columns.shape[0], 1))]
    for k in range(1, len(_BASES)):
        parts.append((columns[:, k : k + 1] == np.arange(_BASES[k])).astype(float))
    return np.hstack(parts)


def fit_logistic(x: np.ndarray, q: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels; counts are scaled to 1000 in all."""
    weight = n / n.sum() * 1000
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (q - p)) - ridge * beta
        bend = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + ridge * np.eye(x.shape[1])
        change = np.linalg.solve(bend, slope)
        beta = beta + np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return beta


class SpanClassifier:
    """Scores of candidates by kind; without any candidate to learn from, a kind keeps its base spans only."""

    def __init__(self, patterns: np.ndarray, n: np.ndarray) -> None:
        columns = _columns(patterns)
        self.weights: list[np.ndarray | None] = []
        self.reliability: dict[str, dict[str, float]] = {}
        for kind, name in enumerate(KINDS):
            own = columns[:, 0] == kind
            if not own.any():
                self.weights.append(None)
                continue
            q, right = likelihoods(columns[own, 1 : 1 + len(LABELERS)] - 1, n[own].astype(float))
            self.reliability[name] = dict(zip(LABELERS, right.round(4).tolist(), strict=True))
            self.weights.append(fit_logistic(_features(columns[own]), q, n[own].astype(float)))
        self._known: dict[int, float] = {}

    def score(self, c: Candidate) -> float:
        """How likely the candidate is personal data."""
        pattern = pattern_of(c)
        if pattern not in self._known:
            weights = self.weights[c.kind]
            x = _features(_columns(np.array([pattern])))[0]
            self._known[pattern] = 0.0 if weights is None else float(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))
        return self._known[pattern]

    def spans(self, text: str | None) -> list[dict]:
        """Base spans and those added, by kind and start; an added one overlaps no other span."""
        scored = [(c, self.score(c)) for c in candidates(text)]
        kept = [(c, s) for c, s in scored if c.base]
        added: list[tuple[Candidate, float]] = []
        taken: list[tuple[int, int]] = []
        for c, s in sorted((x for x in scored if not x[0].base and x[1] >= ADD_FROM), key=lambda x: (-x[1], x[0].start)):
            if add_apart(taken, c.start, c.end):
                added.append((c, s))
        kept = sorted(kept + added, key=lambda x: (x[0].kind, x[0].start))
        return [{"kind": KINDS[c.kind], "start": c.start, "end": c.end, "score": s, "base": c.base} for c, s in kept]


def train_spans(docs: DataFrame, *, text: str = "text") -> SpanClassifier:
    """The classifier learnt from the candidates of all documents; null texts have none."""
    return SpanClassifier(*count_patterns(docs, text))


def find_personal_data(
    docs: DataFrame, classifier: SpanClassifier, *, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Columns ``keep`` (default: all) and found: the spans of the text by kind and start.

    Places are code points, ends exclusive; base spans are marked. A null or empty text has no spans.
    Whole texts are searched in time proportional to their length. An input column ``found`` gives way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def start():
        own = shared.value
        return lambda texts: [pa.array([own.spans(t) for t in texts.to_pylist()], _ARROW_SPAN)]

    new = T.StructType([T.StructField("found", T.ArrayType(SPAN))])
    return map_text(docs, text, docs.columns if keep is None else keep, new, start)


def mask(text: str | None, spans: Sequence[dict]) -> str | None:
    """The text with every span, overlapping ones together, replaced by the kind in brackets."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, classifier: SpanClassifier, *, text: str = "text", n_chars: str | None = None) -> DataFrame:
    """All columns, with masked texts; ``n_chars`` names a column that gets their new length."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def start():
        own = shared.value
        return lambda texts: [pa.array([mask(t, own.spans(t)) for t in texts.to_pylist()], pa.string())]

    masked = map_text(docs, text, docs.columns, T.StructType([T.StructField(text, T.StringType())]), start)
    if n_chars:
        masked = masked.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return masked.select(*docs.columns)


def digest(found: Column, only_base: bool) -> Column:
    """kind:start:end of the spans, comma-joined."""
    spans = F.filter(found, lambda s: s["base"]) if only_base else found
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
