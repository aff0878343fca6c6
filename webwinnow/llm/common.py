"""Helpers shared by the operators: tables, written intermediates, text bytes and word hashes."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from webwinnow.plans.session import shared_folder as checkpoint_folder

#: A word of every contract here: a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SLICE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; see the library's own helper where it is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or checkpoint_folder(spark)


def saved(df: DataFrame, name: str) -> DataFrame:
    """*df* as a Parquet table written to the shared folder, read back without its lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, stem: str) -> str:
    """A column name that *df* does not hold."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    array = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = array.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (SplitMix64), in place on a uint64 array."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one entry more than rows)."""
    solid = ~_SPACE[data]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    start[cut] |= solid[cut]
    end[cut - 1] |= solid[cut - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash per word: the sum of mixed (byte, place in the word), worked off in slices."""
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _SLICE)))
        lengths = ends[a:b] - starts[a:b]
        base = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum(), dtype=np.int64) - np.repeat(base, lengths)
        x = data[place + np.repeat(starts[a:b], lengths)]
        x = (_LOWER[x] if lower else x).astype(np.uint64)
        x += (place.astype(np.uint64) + np.uint64(1)) << np.uint64(8)
        x *= np.uint64(0x9E3779B97F4A7C15)
        out[a:b] = np.add.reduceat(mix(x), base)
        a = b
    return out


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash per run of *size* words; fewer words give one hash of the whole run."""
    if not len(words):
        return words
    size = min(size, len(words))
    x = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        x *= np.uint64(0xD1342543DE82EF95)
        x += words[k : len(words) - size + 1 + k]
        x = mix(x)
    return x


def symbols(text: Column, chars: str) -> Column:
    """Occurrences of any character of the class *chars*; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[{chars}]")), F.lit(0)).cast("long")
