"""Language identification by partial matching.

Per language, a tree of byte contexts of up to three bytes is counted over training texts. A text is coded
under every tree: a byte seen after the longest known context costs its share there, any other first costs
an escape to the next shorter context, and at last eight bits. The counts are frozen, so the exact code
length of a text is a sum of table entries; the shortest code names the language. Each language has its
own sorted tables of what was seen in it: no context and no language is left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import fields, map_text, pieces, prepare, text_bytes

#: About so many bytes of text train the tree of one language, whole texts drawn by hash.
TRAIN_BYTES = 8 << 20
#: Code lengths (runs of four bytes times languages) held at once while texts are coded; changes no result.
TABLE_CELLS = 24_000_000
UNKNOWN = "und"

_PAD = 10  # what stands before a text: line ends
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number would be in the sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), keys.size - 1)
    return at, keys[at] == wanted


@dataclass
class Tree:
    """One language: of each order, the sorted runs of a context and a byte with their bits, and the contexts with those of an escape."""

    runs: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> Tree:
        tree = cls([], [], [], [])
        for order in range(4):
            runs, where = np.unique(grams & np.uint64(256 ** (order + 1) - 1), return_inverse=True)
            n = np.bincount(where, weights=counts, minlength=runs.size)
            contexts, where, kinds = np.unique(runs >> np.uint64(8), return_inverse=True, return_counts=True)
            whole = np.bincount(where, weights=n, minlength=contexts.size) + kinds
            tree.runs.append(runs.astype(np.uint32))
            tree.bits.append(-np.log2(n / whole[where]))
            tree.contexts.append(contexts.astype(np.uint32))
            tree.escapes.append(-np.log2(kinds / whole))
        return tree

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each run of four bytes."""
        out = np.zeros(grams.size)
        rest = np.arange(grams.size)
        for order in (3, 2, 1, 0):
            own = grams[rest] & np.uint32(256 ** (order + 1) - 1)
            if not self.runs[order].size:
                continue
            at, seen = _found(self.runs[order], own)
            out[rest[seen]] += self.bits[order][at[seen]]
            rest, own = rest[~seen], own[~seen]
            at, known = _found(self.contexts[order], own >> np.uint32(8))
            out[rest[known]] += self.escapes[order][at[known]]
        out[rest] += 8.0
        return out


@dataclass
class ContextTrees:
    """The trees of the languages, in the order of their names."""

    languages: list[str]
    trees: list[Tree]
    cells: int = TABLE_CELLS

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each text under each language."""
        data, offsets = text_bytes(texts)
        out = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(np.diff(offsets))
        if not some.size:
            return out
        coded = pa.array(_grams(data, offsets)).dictionary_encode()
        grams, where = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        order = np.argsort(grams)  # neighbours are looked up one after the other
        block = max(1, self.cells)
        bits = np.empty(grams.size)
        for k, tree in enumerate(self.trees):
            for first in range(0, grams.size, block):
                own = order[first : first + block]
                bits[own] = tree.lengths(grams[own])
            out[some, k] = np.add.reduceat(bits[where], offsets[some])
        return out


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the three before it in its text (big-endian); line ends stand before a text."""
    gram = data.astype(np.uint32)
    for back in (1, 2, 3):
        before = np.full(data.size, _PAD, dtype=np.uint32)
        before[back:] = data[:-back] if data.size > back else before[back:]
        for k in range(back):
            starts = offsets[:-1] + k
            before[starts[starts < data.size]] = _PAD
        gram |= before << np.uint32(8 * back)
    return gram


def build_trees(languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray, cells: int = TABLE_CELLS) -> ContextTrees:
    """The trees for counted runs of four bytes (big-endian in 32 bits) of each language."""
    order = np.argsort(language, kind="stable")
    ends = np.searchsorted(language[order], np.arange(len(languages) + 1))
    parts = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return ContextTrees(languages, [Tree.of(grams[p].astype(np.uint64), counts[p]) for p in parts], cells)


def _count_grams(rows: DataFrame) -> DataFrame:
    """number (of the language), gram, n over the texts."""
    prepare(rows.sparkSession)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for piece in pieces(batch, 1):
                data, offsets = text_bytes(piece.column(1))
                number = np.repeat(piece.column(0).to_numpy().astype(np.uint64), np.diff(offsets))
                parts.append(np.unique((number << np.uint64(32)) | _grams(data, offsets), return_counts=True))
                if len(parts) > 20:
                    parts = [merged(parts)]
        if parts:
            keys, n = merged(parts)
            made = [pa.array((keys >> np.uint64(32)).astype(np.int64)), pa.array((keys & np.uint64(2**32 - 1)).astype(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(made, names=["number", "gram", "n"])

    counted = rows.mapInArrow(run, "number long, gram long, n long")
    return counted.groupBy("number", "gram").agg(F.sum("n").alias("n"))


def train_languages(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", train_bytes: int = TRAIN_BYTES, cells: int = TABLE_CELLS
) -> ContextTrees | None:
    """Trees of the languages named in ``docs``; rows whose text or language is null teach nothing.

    Of each language about ``train_bytes`` of whole texts are used, and one text at least, drawn by a hash of the
    text; the tables depend on nothing else, so they agree on every run. Every language has a tree. None if there is nothing to learn from.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    parts = 1 << 20
    place = F.pmod(F.xxhash64("text"), F.lit(parts))
    found = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size"), F.min(place).alias("first")).collect()
    if not found:
        return None
    share = {r["lang"]: max(round(parts * min(1.0, train_bytes / r["size"])), r["first"] + 1) for r in found}
    languages = sorted(share)
    number = F.create_map(*[x for k, name in enumerate(languages) for x in (F.lit(name), F.lit(k))])
    below = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(share[name]))])
    drawn = rows.where(place < F.try_element_at(below, F.col("lang")))
    counted = _count_grams(drawn.select(F.try_element_at(number, F.col("lang")).alias("number"), "text")).toArrow()  # bounded by train_bytes
    if not counted.num_rows:
        return None
    return build_trees(
        languages, counted["number"].to_numpy(), counted["gram"].to_numpy().astype(np.uint64), counted["n"].to_numpy(), cells
    )


def detect_language(
    docs: DataFrame, trees: ContextTrees | None, *, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Columns ``keep`` (default: all), lang_pred and score: the language's share of all likelihoods.

    ``und`` with score 0 for a text that is null or has no letter, and for all texts without trees. Of
    equally short codes the first language by name wins. Whole texts of any length are coded. Input
    columns named like a result give way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def start():
        own = shared.value

        def step(texts: pa.Array) -> list[pa.Array]:
            n = len(texts)
            if own is None or not n:
                return [pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n))]
            bits = own.lengths(texts)
            best = bits.argmin(axis=1)
            share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            lettered = _has_letter(texts)
            names = [own.languages[k] if yes else UNKNOWN for k, yes in zip(best, lettered, strict=True)]
            return [pa.array(names, pa.string()), pa.array(np.where(lettered, share, 0.0))]

        return step

    return map_text(docs, text, docs.columns if keep is None else keep, fields(lang_pred="string", score="double"), start)


def _has_letter(texts: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(texts)
    some = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out = some[offsets[1:]] > some[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out
