import re

import numpy as np
import pyarrow as pa
import pytest

from tillbook.llm.common import Words, document_of

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return PATTERN.findall((text or "").translate(LOWER))


def random_texts(seed, n):
    rng = np.random.default_rng(seed)
    letters = list("abABzZ09 .,-_\n\té漢\U0001f600")
    return ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(n)] + [None, "", "ab", "ab"]


@pytest.mark.parametrize("seed", range(20))
def test_words_are_those_of_the_pattern(seed):
    texts = random_texts(seed, 40)
    words = Words(pa.array(texts, pa.string()))
    found = [words.bytes_of(i, 1).decode() for i in range(words.begin.size)]
    expected = [words_of(t) for t in texts]
    assert found == [w for ws in expected for w in ws]
    assert words.counts.tolist() == [len(ws) for ws in expected]
    by_hash = {}
    for w, h in zip(found, words.hashes.tolist(), strict=True):
        assert by_hash.setdefault(w, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_words_of_a_slice():
    texts = pa.array(["aa bb", None, "cc dd ee", "ff"], pa.string())
    assert Words(texts.slice(1, 2)).hashes.tolist() == Words(pa.array([None, "cc dd ee"])).hashes.tolist()
    assert Words(texts.slice(0, 0)).counts.tolist() == []


@pytest.mark.parametrize("size", [1, 2, 3, 5, 13])
def test_windows_stay_within_a_text(size):
    texts = random_texts(3, 60)
    words = Words(pa.array(texts, pa.string()))
    at, value = words.windows(size)
    expected = [tuple(ws[i : i + size]) for ws in map(words_of, texts) for i in range(len(ws) - size + 1)]
    assert len(at) == len(expected)
    by_hash = {}
    for piece, h in zip(expected, value.tolist(), strict=True):
        assert by_hash.setdefault(piece, h) == h
    document = document_of(words.first, at)
    assert ((at >= words.first[document]) & (at + size <= words.first[document + 1])).all()
