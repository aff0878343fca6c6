"""Benchmark decontamination by the q-gram lemma on diagonal bands, verified by banded alignment.

Texts are compared as normalised characters: A-Z lower-cased, every run of other ASCII marks one blank. A passage that
holds an item of ``m`` characters with at most ``e`` edits shares at least ``m - q + 1 - q * e`` of its q-grams, all on diagonals
(place in the text minus place in the item) within a range of ``2e + 1``. Diagonals are counted in cells of that width;
two neighbouring cells are a band, bands overlap by a cell, so one band holds all of them. Bands that reach the bound
are aligned with the item.

The items go to the tasks in blocks of bounded size. All documents are read once, in one narrow pass without a shuffle: a
task gathers some megabytes of texts and holds them against one block after the other, so it has one block's index in
memory whatever the number of items.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from webwinnow.llm.common import mix, shared_folder, text_bytes

_NORM = np.full(256, 32, np.uint8)
_NORM[48:58] = np.arange(48, 58)
_NORM[65:91] = np.arange(97, 123)
_NORM[97:123] = np.arange(97, 123)
_NORM[128:] = np.arange(128, 256)
_BASE = 0xD1342543DE82EF95
_BITS = 22
_SLICE = 1 << 20


@dataclass(frozen=True)
class Lemma:
    """q (8 to 16), edits as a share of the item's characters, bytes of items per block and of texts gathered for several.

    Items under ``q`` characters are no passages.
    """

    q: int = 10
    budget: float = 0.06
    block_bytes: int = 4 << 20
    gather_bytes: int = 32 << 20

    def edits(self, m):
        """Edits allowed; no more than leave one q-gram whole wherever they fall, which binds for short items."""
        m = np.asarray(m)
        return np.minimum(np.floor(m * self.budget), np.maximum(0, (m - self.q) // self.q)).astype(np.int64)

    def bound(self, m):
        return np.asarray(m) - self.q + 1 - self.q * self.edits(m)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points and row offsets; rows neither start nor end with a blank."""
    x = _NORM[data]
    blank = x == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank of a run
    first = offsets[:-1][offsets[:-1] < len(x)]
    keep[first] &= ~blank[first]
    x, at = x[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
    ends = at[1:][at[1:] > at[:-1]] - 1
    tail = np.zeros(len(x), bool)
    tail[ends] = x[ends] == 32
    return code_points(x[~tail], at - np.concatenate([[0], np.cumsum(tail)])[at])


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 rows, and the rows' offsets among them; a byte that is not UTF-8 is a character of its own."""
    if not (data & 0x80).any():
        return data.astype(np.uint32), offsets
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    text = data.tobytes().decode("utf-8", "surrogateescape")
    if len(text) != at[-1]:
        rows = [data[a:b].tobytes().decode("utf-8", "surrogateescape") for a, b in zip(offsets[:-1], offsets[1:])]
        text, at = "".join(rows), np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), at


def _grams(x: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code of each q-gram, q of 8 to 16: two polynomials of eight characters, which overlap where q is less than 16."""
    c = x.astype(np.uint64)
    for width in (1, 2, 4):
        c = c[: len(c) - width] * np.uint64(pow(_BASE, width, 1 << 64)) + c[width:]
    size = len(x) - q + 1
    return mix(c[:size] * np.uint64(0x9E3779B97F4A7C15) ^ mix(c[q - 8 : q - 8 + size].copy()))


class Items:
    """Index of one block of items: q-gram codes with the items and places that hold them."""

    def __init__(self, ids: pa.Array, texts: pa.Array, lemma: Lemma):
        data, offsets = normalised(*text_bytes(texts))
        long = np.flatnonzero(np.diff(offsets) >= lemma.q)
        self.lemma, self.ids = lemma, ids.take(pa.array(long))
        self.texts = [data[offsets[i] : offsets[i + 1]] for i in long]
        self.sizes = np.array([len(x) for x in self.texts], np.int64)
        self.edits, self.bounds = lemma.edits(self.sizes), lemma.bound(self.sizes)
        codes = [_grams(x, lemma.q) for x in self.texts]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.codes, starts = np.unique(flat[order], return_index=True)
        self.ptr = np.concatenate([starts, [len(flat)]]).astype(np.int64)
        self.item = np.repeat(np.arange(len(codes)), [len(x) for x in codes])[order]
        self.place = np.concatenate([np.arange(len(x)) for x in codes] or [np.zeros(0, np.int64)])[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def _shared(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of *x* and code numbers of the q-grams that some item holds."""
        places, found = [], []
        q = self.lemma.q
        for a in range(0, max(0, len(x) - q + 1), _SLICE):
            codes = _grams(x[a : a + _SLICE + q - 1], q)
            hit = np.flatnonzero(self.seen[(codes >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.codes, codes[hit]), len(self.codes) - 1)
            same = self.codes[at] == codes[hit]
            places.append(hit[same] + a)
            found.append(at[same])
        return np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int64)])

    def _postings(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per item and place that hold one of the q-grams *code*: the number of the q-gram, the item, the place."""
        times = self.ptr[code + 1] - self.ptr[code]
        base = np.cumsum(times) - times
        slot = np.arange(times.sum()) - np.repeat(base - self.ptr[code], times)
        return np.repeat(np.arange(len(code)), times), self.item[slot], self.place[slot]

    def _runs(self, at: np.ndarray, code: np.ndarray, row: np.ndarray) -> Iterator[list[slice]]:
        """Runs of whole rows of about a slice of postings; a row of more comes as several slices."""
        through = np.concatenate([[0], np.cumsum(self.ptr[code + 1] - self.ptr[code])])
        a = 0
        while a < len(code):
            b = int(np.searchsorted(through, through[a] + _SLICE, side="right")) - 1
            if b < len(code):
                b = int(np.searchsorted(row, row[max(a, b)]))
            if b > a:
                yield [slice(a, b)]
            else:
                b = int(np.searchsorted(row, row[a], side="right"))
                steps = np.searchsorted(through, np.arange(through[a] + _SLICE, through[b], _SLICE))
                cuts = np.unique(np.clip(np.concatenate([[a], steps, [b]]), a, b)).tolist()
                yield [slice(*cut) for cut in zip(cuts, cuts[1:])]
            a = b

    def _cells(self, parts: list[slice], at: np.ndarray, code: np.ndarray, row: np.ndarray) -> dict[tuple[int, int], int]:
        """Shared q-grams per pair and cell of diagonals, for pairs that share enough of them in total."""

        def postings():
            for part in parts:
                number, item, place = self._postings(code[part])
                yield row[part][number] * len(self.ids) + item, item, at[part][number] - place

        held = list(postings()) if len(parts) == 1 else None
        pairs, shared = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for pair, _, _ in held or postings():
            found, count = np.unique(pair, return_counts=True)
            pairs, which = np.unique(np.concatenate([pairs, found]), return_inverse=True)
            shared = np.bincount(which, np.concatenate([shared, count])).astype(np.int64)
        pairs = pairs[shared >= self.bounds[pairs % len(self.ids)]]
        counts: dict[tuple[int, int], int] = {}
        for pair, item, diagonal in (held or postings()) if len(pairs) else ():
            enough = pairs[np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)] == pair
            if not enough.any():
                continue
            pair, item, diagonal = pair[enough], item[enough], diagonal[enough]
            cell = np.floor_divide(diagonal, 2 * self.edits[item] + 1)
            keys, count = np.unique(np.stack([pair, cell]), axis=1, return_counts=True)
            for p, c, n in zip(*keys.tolist(), count.tolist()):
                counts[p, c] = counts.get((p, c), 0) + n
        return counts

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(row, item, edits)`` of rows that hold an item within its edit budget."""
        if not len(self.codes):
            return
        x, offsets = normalised(data, offsets)
        at, code = self._shared(x)
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + self.lemma.q <= offsets[row + 1]
        at, code, row = at[inside], code[inside], row[inside]
        at = at - offsets[row]
        for parts in self._runs(at, code, row):
            counts = self._cells(parts, at, code, row)
            best: dict[int, int] = {}
            for p, c in sorted({(p, k) for p, c in counts for k in (c - 1, c)}):
                i = p % len(self.ids)
                if best.get(p) == 0 or counts.get((p, c), 0) + counts.get((p, c + 1), 0) < self.bounds[i]:
                    continue
                r, e = p // len(self.ids), int(self.edits[i])
                low = c * (2 * e + 1)
                edits = self._align(x[offsets[r] : offsets[r + 1]], i, low - e, low + 2 * (2 * e + 1) + e)
                if edits <= e:
                    best[p] = min(edits, best.get(p, edits))
            for p, edits in best.items():
                yield p // len(self.ids), p % len(self.ids), edits

    def _align(self, text: np.ndarray, i: int, low: int, high: int) -> int:
        """Least edits of item *i* against a part of *text* that starts on a diagonal of ``low .. high``."""
        item = self.texts[i]
        m, big = len(item), len(item) + 1
        region = text[max(0, low) : max(0, high + m)]
        found = region.tobytes().find(item.tobytes())
        if found >= 0 and found % item.itemsize == 0:
            return 0
        band = high - low + 1
        padded = np.zeros(m + band, np.uint32)  # 0 never occurs in normalised text
        padded[max(0, -low) : max(0, -low) + len(region)] = region[: m + band - max(0, -low)]
        steps = np.arange(band)
        inside = (low + steps >= 0) & (low + steps <= len(text))
        cost = np.where(inside, 0, big)
        for k in range(m):
            step = cost + (padded[k : k + band] != item[k])
            step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
            step = np.minimum.accumulate(step - steps) + steps
            cost = step
        return int(cost.min())


def _blocks(items: DataFrame, id_col: str, text_col: str, lemma: Lemma) -> list[Broadcast]:
    """The items in broadcast blocks of about ``block_bytes``, or one item where that is longer.

    Spark keeps a broadcast in files and in its block managers, so the driver's memory holds one block at a time and the
    plan none; a task fetches a block when it comes to it.
    """
    spark = items.sparkSession
    items = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // lemma.block_bytes)
    if blocks <= 1:
        return [spark.sparkContext.broadcast(items.toArrow())]
    path = f"{shared_folder(spark)}/items-{uuid.uuid4().hex}"
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    dealt.repartition("block").write.partitionBy("block").parquet(path)
    stored = spark.read.schema(T.StructType([*items.schema.fields, T.StructField("block", T.LongType())])).parquet(path)
    return [spark.sparkContext.broadcast(stored.where(F.col("block") == k).drop("block").toArrow()) for k in range(blocks)]


@lru_cache(maxsize=1)
def _index(block: Broadcast, lemma: Lemma) -> Items:
    """The index of a block; a Python worker keeps the last one from task to task."""
    rows = block.value.combine_chunks()
    return Items(*[c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns], lemma)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of about *limit* bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _found(batches: Iterator[pa.RecordBatch], at: int, blocks: list[Broadcast], lemma: Lemma) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch with what its texts (column *at*) hold: per block the block's ids and ``(row, item, edits)``."""
    order = list(blocks)
    for held in _gathered(batches, lemma.gather_bytes if len(order) > 1 else 0):
        found = [[] for _ in held]
        for block in order:
            index = _index(block, lemma)
            for k, batch in enumerate(held):
                found[k].append((index.ids, list(index.matches(*text_bytes(batch.column(at))))))
        order.reverse()  # the next texts begin with the block that is indexed
        yield from zip(held, found)


def contaminated(
    docs: DataFrame, items: DataFrame, lemma: Lemma = Lemma(), id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``id, item id, edits`` for each row of *docs* and item that it holds within the edit budget, fewest edits.

    Null and empty texts hold nothing; null items and items under ``q`` normalised characters match nothing; repeated items
    count once, repeated rows each. Null ids stay null. Other columns are ignored. An empty table on either side gives
    an empty result.
    """
    kinds = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id]
    schema = f"`{id_col}` {kinds[0]}, `{item_id}` {kinds[1]}, edits int"
    blocks = _blocks(items, item_id, item_text, lemma)

    def run(batches):
        for batch, found in _found(batches, 1, blocks, lemma):
            for ids, rows in found:
                if rows:
                    at, item, edits = (pa.array(x, pa.int64()) for x in zip(*rows))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), ids.take(item), edits.cast(pa.int32())], [id_col, item_id, "edits"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decontaminated(docs: DataFrame, items: DataFrame, lemma: Lemma = Lemma(), text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of *docs* that hold no item, columns unchanged; see ``contaminated`` for the edge cases."""
    at, blocks = docs.columns.index(text_col), _blocks(items, item_id, item_text, lemma)

    def run(batches):
        for batch, found in _found(batches, at, blocks, lemma):
            clean = np.ones(batch.num_rows, bool)
            clean[[row for _, rows in found for row, _, _ in rows]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
