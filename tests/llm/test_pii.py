import re
import time

import numpy as np
import pytest

from tillbook.llm.pii import SpanClassifier, find_personal_data, likelihoods, mask, mask_personal_data, pattern_of, train_spans
from tillbook.llm.pii_labelers import add_apart, base_spans, candidates

# The contract's patterns, plainly.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def luhn(d):
        odd, even = d[-1::-2], d[-2::-2]
        return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0

    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


@pytest.mark.parametrize("seed", range(30))
def test_base_spans_are_those_of_the_patterns(seed):
    rng = np.random.default_rng(seed)
    parts = ["a@b.co", "@", ".", "-", "+", "1", "23", "255", "256", "0.0.0.0", " ", "4539 1488 0343 6467", "4111111111111111",
             "+1 (555) 123-4567", "x", "é", "\n", "a.b%c@d-e.f.g", "..", "(", "00000000"]
    for _ in range(200):
        text = "".join(rng.choice(parts, rng.integers(0, 25)))
        assert base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for unit in ("a", "1", "1.", "1 ", "@", "a@", "+1", "+1-", "a.", "-"):
        candidates(unit * 200_000)


def test_a_hundred_thousand_numbers_take_seconds():
    texts = ["".join(unit.format(i % 10_000) for i in range(100_000)) for unit in ("call (555) 123-{0:04d} or ", "4539 1488 0343 {0:04d}x ", "me (at) h{0}.com, ")]
    classifier = SpanClassifier(*_counted([t[:20_000] for t in texts]))
    started = time.time()
    for text in texts:
        classifier.spans(text)
    assert time.time() - started < 90


def _counted(texts):
    patterns = [pattern_of(c) for t in texts for c in candidates(t)]
    return np.unique(np.array(patterns), return_counts=True)


def test_spans_apart_are_those_of_plain_comparison():
    rng = np.random.default_rng(3)
    for _ in range(200):
        spans, plainly = [], []
        for a in rng.integers(0, 60, 30).tolist():
            b = a + int(rng.integers(1, 6))
            fits = not any(x < b and a < y for x, y in plainly)
            plainly += [(a, b)] if fits else []
            assert add_apart(spans, a, b) == fits
        assert spans == sorted(plainly)


def test_votes_add_spans_and_base_ones_stay(spark):
    good = [f"ring +1 (20{i % 10}) 555-{i:04d} or write to u{i}@mail.example.com now" for i in range(200)]
    lost = "ring +1 (269) 555-3296 4539148803436467 today"  # one run of 27 digits to the base patterns
    docs = spark.createDataFrame(list(enumerate([*good, lost, None, ""])), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["found"] for r in find_personal_data(docs, train_spans(docs)).collect()}
    assert [(s["kind"], s["start"], s["end"], s["base"]) for s in found[200]] == [("card", 23, 39, False), ("phone", 5, 22, False)]
    assert found[201] == [] and found[202] == [] and len(found) == 203
    for i, text in enumerate(good):
        assert [(s["kind"], s["start"], s["end"]) for s in found[i] if s["base"]] == [(("email", "ip", "card", "phone")[k], a, b) for k, a, b in plain(text)]


def test_expectation_maximisation_finds_the_unreliable_labeler():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    accuracy = np.array([0.95, 0.9, 0.85, 0.55])
    votes = np.where(rng.random((4000, 4)) < accuracy, 1, -1) * np.where(truth, 1, -1)[:, None]
    votes[rng.random((4000, 4)) < 0.3] = 0
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    q, right = likelihoods(patterns, n.astype(float))
    assert np.abs(right - accuracy).max() < 0.05
    by_pattern = {tuple(p): x for p, x in zip(patterns.tolist(), q, strict=True)}
    assert np.mean([(by_pattern[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)]) > 0.92


def test_classifier_without_candidates_keeps_base_spans():
    empty = SpanClassifier(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert [s["kind"] for s in empty.spans("a@b.co and 3296 4539148803436467")] == ["email"]
    assert len({pattern_of(c) for c in candidates("a@b.co 10.1.2.3")}) == 2


def test_mask():
    spans = [{"kind": "email", "start": 2, "end": 8}, {"kind": "ip", "start": 5, "end": 12}, {"kind": "card", "start": 14, "end": 15}]
    assert mask("ab" + "x" * 10 + "cd" + "y" + "e", spans) == "ab[EMAIL]cd[CARD]e"
    assert mask(None, []) is None and mask("a", []) == "a"


def test_odd_documents(odd, no_documents):
    classifier = train_spans(odd)
    found = find_personal_data(odd, classifier)
    assert found.count() == odd.count() and found.columns.count("found") == 1
    masked = mask_personal_data(odd, classifier, n_chars="n_chars")
    assert masked.columns == odd.columns and masked.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
    assert masked.where("text IS NULL").count() == odd.where("text IS NULL").count()
    assert find_personal_data(no_documents, train_spans(no_documents)).count() == 0


@pytest.mark.parametrize("address", ["jane [At] example.com", "jane ( at ) example.com", "jane (at ) example.com", "jane{aT}example.com", "j(at)e.org"])
def test_looser_addresses_do_not_depend_on_other_text(address):
    def spans(text):
        return [(c.kind, text[c.start : c.end]) for c in candidates(text) if not c.base]

    assert spans(address) and spans(address) == spans(f"{address}; AT home, at the dot (at)")
