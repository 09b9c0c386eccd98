"""Token counts of sections, from one encoding of the whole document.

A document is encoded once; the bytes of its tokens, one after the other, are its text, so token borders
are running sums of token lengths. Sections are spans of the text; how many tokens belong to one follows
from the places of its two borders among the token borders. A token that crosses a border goes to the
section that holds its first byte (``first``), its last byte (``last``), its middle (``most``: the larger
part, of equal parts the later one), or in shares by bytes (``split``).
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import fields, map_text, text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits a text before merging, as published with this vocabulary. A fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "most", "split")
#: A vocabulary file of more bytes isn't broadcast.
MAX_VOCABULARY = 64 << 20

#: From a text's bytes to the byte places at which its sections begin and end.
Sections = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every line with its line end; together they are the whole text."""
    ends = np.flatnonzero(data == 10) + 1
    if data.size and (not ends.size or ends[-1] != data.size):
        ends = np.append(ends, data.size)
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if ends.size else ends, ends


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file."""
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Encoder:
    """Token borders of texts under one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def borders(self, text: str) -> np.ndarray:
        """Where tokens begin in the bytes of the text, and its end."""
        tokens = np.array(self.encoding.encode_ordinary(text), dtype=np.int64)
        return np.concatenate([[0], np.cumsum(self.sizes[tokens])])


def allocate(borders: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section under a rule; sections may overlap or leave gaps."""
    if rule == "split":
        count = np.arange(borders.size, dtype=float)
        return np.interp(end, borders, count) - np.interp(begin, borders, count)
    if rule == "first":
        marks, scale = borders[:-1], 1
    elif rule == "last":
        marks, scale = borders[1:] - 1, 1
    else:
        marks, scale = borders[:-1] + borders[1:], 2
    return (np.searchsorted(marks, end * scale) - np.searchsorted(marks, begin * scale)).astype(float)


def count_tokens(
    docs: DataFrame,
    *,
    text: str = "text",
    keep: Sequence[str] | None = None,
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    rule: str = "first",
    sections: Sections = lines,
) -> DataFrame:
    """Columns ``keep`` (default: all), n_tokens of the text, and begins, ends, tokens of its sections.

    Places are code points, ends exclusive. Sections are lines, or what ``sections`` finds. With sections
    that cover the text once, their tokens add up to n_tokens under every rule. A null or empty text has
    no token and no section. Strings of special tokens are text. ``vocabulary`` is a rank file that the
    driver reads. Input columns named like a result give way to it.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def start():
        encoder = Encoder(shared.value, pattern)

        def step(texts: pa.Array) -> list[pa.Array]:
            data, offsets = text_bytes(texts)
            totals, begins, ends, tokens = [], [], [], []
            for i, value in enumerate(texts.to_pylist()):
                own = data[offsets[i] : offsets[i + 1]]
                borders = encoder.borders(value or "")
                b, e = sections(own)
                character = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
                totals.append(borders.size - 1)
                begins.append(character[b])
                ends.append(character[e])
                tokens.append(allocate(borders, b, e, rule))
            return [pa.array(totals, pa.int64()), pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.float64()))]

        return step

    new = fields(n_tokens="long", begins="longs", ends="longs", tokens="doubles")
    return map_text(docs, text, docs.columns if keep is None else keep, new, start)


def section_rows(counted: DataFrame) -> DataFrame:
    """One row per section (number from 0, begin, end, tokens); a text without sections gives one with nulls."""
    zipped = F.posexplode_outer(F.arrays_zip("begins", "ends", "tokens")).alias("section", "at")
    others = [c for c in counted.columns if c not in ("begins", "ends", "tokens")]
    rows = counted.select(*others, zipped)
    return rows.select(*others, "section", F.col("at.begins").alias("begin"), F.col("at.ends").alias("end"), F.col("at.tokens").alias("tokens"))
