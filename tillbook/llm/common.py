"""What the operators of this subpackage share: stored tables, text batches and word hashes.

Words are runs of ASCII letters, digits and any non-ASCII characters, with A-Z lower-cased. They are
found on the UTF-8 bytes of a whole Arrow batch at once, which splits exactly as the characters would.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.plans.catalog import shared_folder, ship_package

#: Bytes of text handled at once inside a task; a longer text is handled alone.
PIECE_BYTES = 2 << 20

TextStep = Callable[[pa.Array], Sequence[pa.Array]]


_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "string": T.StringType(), "binary": T.BinaryType(), "strings": T.ArrayType(T.StringType()),
    "longs": T.ArrayType(T.LongType()), "doubles": T.ArrayType(T.DoubleType()),
}


def fields(**kinds: str) -> T.StructType:
    """A schema of nullable columns; lists are ``strings``, ``longs`` and ``doubles``."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in kinds.items()])


_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Makes the package known to Python workers, and Arrow batches small, unless the session sets their size.

    A task holds a batch several times: in the JVM, in the Python worker, and as results.
    """
    ship_package(spark)
    if spark.conf.get(_BATCH_SETTING) == "67108864b":  # Spark's own default
        spark.conf.set(_BATCH_SETTING, "8m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """The rows written to the folder that all executors share, and read back: lineage ends here.

    Tables lie under ``<spark.checkpoint.dir>/tillbook/llm/<application>``; that folder may be
    deleted when the application has ended.
    """
    return stored_parts([df], what)


def stored_parts(frames: Iterable[DataFrame], what: str) -> DataFrame:
    """The rows of several frames of one schema, made one after the other and written to one stored table."""
    for i, df in enumerate(frames):
        if not i:
            spark, schema = df.sparkSession, df.schema
            path = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``PIECE_BYTES`` of text, or of one row if that is longer."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def map_text(
    df: DataFrame, text: str, keep: Sequence[str], new: T.StructType, start: Callable[[], TextStep]
) -> DataFrame:
    """Columns ``keep`` of every row, and the ``new`` ones made from its text.

    ``start`` is called once per task and gives the function from texts (nulls included) to the new
    columns. A kept column whose name is among the new ones gives way to it.
    """
    prepare(df.sparkSession)
    names = {f.name.lower() for f in new}
    keep = [c for c in keep if c.lower() not in names]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = df.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for piece in pieces(batch, 1):
                made = step(piece.column(1))
                yield pa.RecordBatch.from_arrays([piece.column(0), *made], names=schema.names)

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *[f.name for f in new])


# Bytes and words ------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_HASH_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.full(n, base, dtype=np.uint64), dtype=np.uint64)


_POWER = _powers(0x9E3779B97F4A7C15, 4096)
#: Multipliers of the words of a shingle, by position.
PLACE = _powers(0xD1342543DE82EF95, 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which close values become unrelated."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins and ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of some texts: ``begin`` and ``end`` in ``lower``, ``first`` word of each text, ``hashes``."""

    def __init__(self, texts: pa.Array, hashes: bool = True) -> None:
        self.data, self.offsets = text_bytes(texts)
        data = self.data
        self.lower = _LOWER[data]
        inside = _WORD[self.lower]
        cut = np.zeros(data.size + 1, dtype=bool)
        cut[self.offsets] = True
        opens, closes = inside.copy(), inside.copy()
        if data.size:
            opens[1:] &= ~inside[:-1] | cut[1:-1]
            closes[:-1] &= ~inside[1:] | cut[1:-1]
        self.begin = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.begin, self.offsets)
        self.counts = np.diff(self.first)
        if hashes:
            self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        sizes = self.end - self.begin
        upto = np.cumsum(sizes)
        out = np.empty(sizes.size, dtype=np.uint64)
        at = 0
        while at < sizes.size:
            before = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, before + _HASH_BYTES, side="right")))
            size, begin = sizes[at:to], self.begin[at:to]
            place = upto[at:to] - size - before
            within = np.arange(int(upto[to - 1] - before)) - np.repeat(place, size)
            value = self.lower[np.repeat(begin, size) + within].astype(np.uint64)
            value += np.uint64(1)
            value *= _POWER[within & 4095]
            out[at:to] = np.add.reduceat(value, place)
            at = to
        return mix(out)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words within one text."""
        n = self.hashes.size - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        value = self.hashes[:n] * PLACE[0]
        for j in range(1, size):
            value += self.hashes[j : j + n] * PLACE[j]
        whole = np.ones(n, dtype=bool)
        for j in range(1, size):  # a run may not go on into the next text
            ends = self.first[1:-1] - j
            whole[ends[(ends >= 0) & (ends < n)]] = False
        at = np.flatnonzero(whole)
        return at, mix(value[at] + np.uint64(size))

    def bytes_of(self, word: int, size: int) -> bytes:
        """The lower-cased words from ``word`` on, joined by a space."""
        return b" ".join(
            self.lower[b:e].tobytes()
            for b, e in zip(self.begin[word : word + size], self.end[word : word + size], strict=True)
        )


def document_of(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text to which each word number belongs."""
    return np.searchsorted(first, at, side="right") - 1
