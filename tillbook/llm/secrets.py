"""Secret scan: candidate strings, and a random forest that removes the false positives.

Candidates are values after the name of a key and ``=`` or ``:``, of any length and with any signs (without
quotes around them, up to white space, a quote or one of ``,;&)}]>``); values of 8 or more characters after such a
name or such a sign alone, or after ``Bearer``; and, wherever they stand, keys in an issuer's format, JSON web tokens
and runs of 16 or more letters, digits and ``+/_-`` that hold a digit. A forest trained on labelled findings scores them by their length, how their characters follow one another (in kind, and against the
corpus' own words), how much of them dictionary words cover, the path of their document, and the words
around them. The dictionary holds the words of 3 to 12 letters that make up at least one in ``RARITY`` of all such words
of all texts, so it has at most ``RARITY`` entries however many texts there are; character transitions are counted over all these words, in
the dictionary or not, and kept by the same rule. Both move features, and which findings are labelled as words; no candidate depends on them.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import Words, fields, map_text, pieces, prepare, stored, text_bytes

#: Shortest run that is a candidate wherever it stands.
LEAST_LENGTH = 16
#: Shortest value after a key's name or a sign of assignment alone; after both, any length will do.
LEAST_VALUE = 8
#: A word belongs to the dictionary if it is at least one in so many of all words of 3 to 12 letters; a pair of letters alike.
RARITY = 200_000
#: Labelled findings in one part of the training rows; the number of parts follows from their number alone.
PART_ROWS = 100_000
TREES, DEPTH, SEED = 24, 8, 11
SECRET_FROM = 0.5
PATH_BUCKETS = 8

_RUN = np.zeros(256, dtype=bool)
_RUN[48:58] = _RUN[65:91] = _RUN[97:123] = True
_RUN[[ord(c) for c in "+/_-"]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_WORD = re.compile(r"[^\W\d_]+")
_AROUND = 32
#: Words near a candidate, in groups that each give one number. Fixed values.
_NEAR = (
    frozenset("password passwd pwd passphrase secret secrets credential credentials".split()),
    frozenset("token auth bearer key apikey access private session cookie".split()),
    frozenset("hash sha md commit checksum digest revision build version".split()),
    frozenset("id uuid guid order invoice serial isbn card number phone".split()),
    frozenset("example sample test dummy placeholder fake".split()),
)
_NAMES = r"(?:password|passwd|pwd|passphrase|secret|token|(?:api|access|private|signing)[ _-]?key|auth|bearer|credentials?)"
#: Names that announce a value, but not surely a secret one.
_ANY_NAME = rf"(?:{_NAMES}|(?<![^\W_])(?:key|session|cookie))"
_GIVEN = r"[ \t]{0,20}(?:=>|:=|[=:])[ \t]{0,20}"
_NAMED = re.compile(rf"{_ANY_NAME}(?:(?P<sign>[\"']?{_GIVEN})|[\"']?[ \t]{{1,20}})", re.I)
_SIGN = re.compile(r"(?<![=!<>:])(?:=>|:=|[=:])(?![=:]|//)[ \t]{0,20}")
_QUOTED = re.compile(r"\"([^\"\n]+)\"|'([^'\n]+)'")
_NAMED_VALUE = re.compile(r"[\"'`]?([^\s\"'`,;&)}\]>]+)")
_VALUE = re.compile(r"[\"'`]?([\w+/.!@$%~#^*?-]+={0,2})")
_WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
_ISSUED = re.compile(
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+)(?![A-Za-z0-9])"
)
_KEY_NAME = re.compile(rf"(?:{_NAMES}[\"']?{_GIVEN}|(?<![^\W_])bearer[ \t]{{1,20}})[\"'`]?$", re.I)
#: What keeps a value without a mark of a secret from being a sure false positive.
_HINT = re.compile(_ANY_NAME, re.I)
_DIGEST = re.compile(r"(?:hash|sha-?\d*|md5|commit|checksum|digest|revision)[\"']?\s{0,2}[=:]?\s{0,2}[\"']?$", re.I)
_NUMBER = re.compile(r"[\d+/_.:-]+")
_UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
_HEX = re.compile(r"[0-9a-f]{16,}", re.I)
_SIGNS = re.compile(r"[\d!@$%~^*#]")
#: Share of dictionary words from which a value without a mark of a secret is one of words.
WORDS_FROM = 0.5


def candidate_spans(texts: pa.Array) -> list[list[tuple[int, int]]]:
    """Code-point spans of the candidates of each text, in order; no two overlap."""
    return [
        _apart([*_marked_spans(text), *((2, b, e) for b, e in runs)] if text else [])
        for text, runs in zip(texts.to_pylist(), _run_spans(texts), strict=True)
    ]


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans (rank, begin, end) without those that overlap one of a lower rank, or of their own that begins earlier."""
    kept: list[tuple[int, int]] = []
    for _, b, e in sorted(spans):
        at = bisect.bisect_left(kept, (b, e))
        if (at == 0 or kept[at - 1][1] <= b) and (at == len(kept) or kept[at][0] >= e):
            kept.insert(at, (b, e))
    return kept


def _value(text: str, at: int, pattern: re.Pattern[str], spaces: bool) -> tuple[int, int]:
    """Span of the value that begins at ``at``: what is in quotes (``spaces``: also with white space), or else a run of ``pattern``."""
    found = _QUOTED.match(text, at)
    if found:
        b, e = found.span(found.lastindex)
        if not any(c.isspace() for c in text[b:e]) or (spaces and not text[b:e].isspace()):
            return b, e
    found = pattern.match(text, at)
    if not found:
        return at, at
    b, e = found.span(1)
    return b, b + len(text[b:e].rstrip(".:?"))


def _marked_spans(text: str) -> list[tuple[int, int, int]]:
    """Rank, begin and end of issued keys, web tokens and values after a key's name (0), and of values after a sign alone (1)."""
    out = [(0, *m.span()) for pattern in (_ISSUED, _WEB_TOKEN) for m in pattern.finditer(text)]
    done = 0
    for m in _NAMED.finditer(text):
        if m.start() < done:
            continue  # inside the value of another name
        b, e = _value(text, m.end(), _NAMED_VALUE, bool(m["sign"]))
        if e - b >= (1 if m["sign"] else LEAST_VALUE):
            out.append((0, b, e))
            done = e
    for m in _SIGN.finditer(text):
        before = text[max(0, m.start() - 3) : m.start()].rstrip(" \t")[-1:]
        if before.isalnum() or (before and before in "_\"')]"):
            b, e = _value(text, m.end(), _VALUE, False)
            if e - b >= LEAST_VALUE:
                out.append((1, b, e))
    return out


def _run_spans(texts: pa.Array) -> list[list[tuple[int, int]]]:
    """Code-point spans of the long runs that hold a digit."""
    data, offsets = text_bytes(texts)
    inside = _RUN[data]
    cut = np.zeros(data.size + 1, dtype=bool)
    cut[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    if data.size:
        opens[1:] &= ~inside[:-1] | cut[1:-1]
        closes[:-1] &= ~inside[1:] | cut[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = end - begin >= LEAST_LENGTH
    begin, end = begin[long], end[long]
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    document = np.searchsorted(offsets, begin, side="right") - 1
    for b, e, d in zip(begin, end, document, strict=True):
        if _DIGIT[data[b:e]].any():
            start = int(((data[offsets[d] : b] & 0xC0) != 0x80).sum())
            out[d].append((start, start + int(e - b)))
    return out


def count_words(docs: DataFrame, text: str = "text", rarity: int = RARITY) -> tuple[dict[str, int], dict[str, int]]:
    """Counts of the words of 3 to 12 letters, and of the pairs of letters in them, that are one in ``rarity`` of all or more.

    All texts are counted whole. What comes to the driver is at most ``rarity`` words and as many pairs.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for piece in pieces(batch, 0):
                words = Words(piece.column(0))
                upto = np.concatenate([[0], np.cumsum((words.lower & 0xC0) != 0x80)])  # code points, not bytes
                lengths = upto[words.end] - upto[words.begin]
                fit = np.flatnonzero((lengths >= 3) & (lengths <= 12))
                _, first, n = np.unique(words.hashes[fit], return_index=True, return_counts=True)
                for w, k in zip(fit[first], n.tolist(), strict=True):
                    seen[words.lower[words.begin[w] : words.end[w]].tobytes()] += k
            if len(seen) > 500_000:  # given out early, so that memory stays bounded
                yield _word_batch(seen)
                seen.clear()
        yield _word_batch(seen)

    texts = docs.select(F.col(f"`{text}`").cast("string"))
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted.where(~F.col("word").rlike("[0-9]")), "words")
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = counted.select(F.explode(F.transform(starts, lambda i: F.substring("word", i, F.lit(2)))).alias("pair"), "n")
    pairs = stored(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    return _frequent(counted, "word", rarity), _frequent(pairs, "pair", rarity)


def _frequent(counts: DataFrame, what: str, rarity: int) -> dict[str, int]:
    """The counts that are one in ``rarity`` of their sum or more: at most ``rarity`` of them."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r[what]: r["n"] for r in counts.where(F.col("n") * F.lit(rarity) >= F.lit(total)).select(what, "n").collect()}


def _word_batch(seen: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array([w.decode("utf-8", "replace") for w in seen], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), pa.int64())], names=["word", "n"])


class Language:
    """The dictionary, and how likely one letter follows another in the words of the corpus."""

    def __init__(self, words: dict[str, int], pairs: dict[str, int]) -> None:
        self.words = frozenset(words)
        first: Counter[str] = Counter()
        for pair, n in pairs.items():
            first[pair[0]] += n
        self.bits = {p: -math.log2((n + 1) / (first[p[0]] + 64)) for p, n in pairs.items()}
        self.rare = 12.0

    def surprise(self, value: str) -> float:
        """Mean bits of a character after the one before it."""
        low = value.lower()
        return sum(self.bits.get(low[i : i + 2], self.rare) for i in range(len(low) - 1)) / max(len(low) - 1, 1)

    def coverage(self, value: str) -> float:
        """Share of the characters that lie in dictionary words, taken greedily from the left, long ones first."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            size = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / len(low)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(text: str, start: int, end: int, path: str, language: Language) -> list[float]:
    """The numbers that the forest sees for one candidate."""
    value = text[start:end]
    kinds = [_kind(c) for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    before, after = text[max(0, start - _AROUND) : start], text[end : end + _AROUND]
    near = [w.lower() for w in _WORD.findall(before)[-3:] + _WORD.findall(after)[:2]]
    hexadecimal = sum(c in "0123456789abcdefABCDEF" for c in value) / len(value)
    bucket = zlib.crc32(path.encode()) % PATH_BUCKETS
    return [
        float(len(value)), changes / max(len(value) - 1, 1), *(kinds.count(k) / len(value) for k in range(4)),
        entropy, hexadecimal, language.surprise(value), language.coverage(value),
        *(float(sum(w in group for w in near)) for group in _NEAR),
        float(before.rstrip(" \"'").endswith(("=", ":"))), float(before.endswith(("\"", "'"))), float(path.count("/")),
        float(bool(re.search(r"test|example|sample|doc", path, re.I))), *(float(bucket == k) for k in range(PATH_BUCKETS)),
    ]


def known_label(text: str, start: int, end: int, language: Language) -> int | None:
    """Label of a finding by unmistakable marks, None without one.

    1 for a value of 8 or more characters, with a digit or one of ``!@$%~^*#``, that is given to a key's name or
    follows ``Bearer``, and for one in an issuer's format or a web token. 0 for a number, a UUID, a named digest
    or a value of words, if no name of a key stands near.
    """
    value = text[start:end]
    if _ISSUED.search(value) or _WEB_TOKEN.search(value):
        return 1
    before = text[max(0, start - 2 * _AROUND) : start]
    if _KEY_NAME.search(before):
        return 1 if len(value) >= LEAST_VALUE and _SIGNS.search(value) else None
    if _HINT.search(before[-_AROUND:]) or _HINT.search(value):
        return None
    if _NUMBER.fullmatch(value) or _UUID.fullmatch(value) or (_HEX.fullmatch(value) and _DIGEST.search(before)):
        return 0
    return 0 if language.coverage(value) >= WORDS_FROM else None


def find_candidates(
    docs: DataFrame, counted: tuple[dict[str, int], dict[str, int]], *, text: str = "text", path: str = "source", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep``, begin, end, label and features of every candidate of every text, stored.

    The label is null without a clear mark. A null or empty text has no candidates, a null path is the empty string. Whole texts are searched.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Language(*counted))
    own_path = F.translate(F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")), "\n", " ")
    both = F.concat(own_path, F.lit("\n"), F.col(f"`{text}`").cast("string")).alias("path and text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], both)

    def start():
        language = shared.value

        def step(texts: pa.Array) -> list[pa.Array]:
            paths, bodies = [], []
            for value in texts.to_pylist():
                own, _, body = (value or "\n").partition("\n")
                paths.append(own)
                bodies.append(body)
            spans = candidate_spans(pa.array(bodies, pa.string()))
            begins = [[b for b, _ in s] for s in spans]
            ends = [[e for _, e in s] for s in spans]
            labels = [[known_label(t, b, e, language) for b, e in s] for t, s in zip(bodies, spans, strict=True)]
            vectors = [[v for b, e in s for v in features(t, b, e, p, language)] for t, p, s in zip(bodies, paths, spans, strict=True)]
            return [*(pa.array(x, pa.list_(pa.int64())) for x in (begins, ends, labels)), pa.array(vectors, pa.list_(pa.float64()))]

        return step

    made = map_text(rows, "path and text", keep, fields(begins="longs", ends="longs", labels="longs", vectors="doubles"), start)
    width = F.floor(F.size("vectors") / F.size("begins")).cast("int")
    parts = F.transform("begins", lambda b, i: F.struct(
        b.alias("begin"), F.col("ends")[i].alias("end"), F.col("labels")[i].alias("label"), F.slice("vectors", i * width + 1, width).alias("features")
    ))
    exploded = made.where(F.size("begins") > 0).select(*keep, F.explode(parts).alias("c"))
    return stored(exploded.select(*keep, "c.*"), "candidates")


def remove_false_positives(candidates: DataFrame, training: DataFrame) -> DataFrame:
    """The candidates with score (0 to 1) and secret (score of 0.5 or more), by a forest grown on ``training``.

    Training rows have label (0 or 1; rows with null teach nothing) and features. If they lack one of the labels, every score is their
    smoothed share of label 1. Rows that repeat count each time. The rows are dealt to parts by their content and sorted
    there, so the forest does not depend on how the cluster laid them out.
    """
    training = training.where("label IS NOT NULL")
    seen = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (seen.get(0) and seen.get(1)):
        share = (seen.get(1, 0) + 1) / (sum(seen.values()) + 2)
        return candidates.withColumns({"score": F.lit(share), "secret": F.lit(share >= SECRET_FROM)})
    # Labels weigh the same in all, however few there are of one.
    weight = F.create_map(*[x for k, n in seen.items() for x in (F.lit(k), F.lit(1 / n))])
    parts = -(-sum(seen.values()) // PART_ROWS)
    training = training.select("label", "features").repartition(parts, "features", "label").sortWithinPartitions("features", "label")
    rows = training.select(F.col("label").cast("double"), array_to_vector("features").alias("features"), (weight[F.col("label")] * sum(seen.values()) / 2).alias("weight"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(rows)
    scored = forest.transform(candidates.withColumn("features", array_to_vector("features")))
    score = vector_to_array("probability")[1]
    return scored.withColumns({"score": score, "secret": score >= SECRET_FROM}).drop("rawPrediction", "probability", "prediction")
