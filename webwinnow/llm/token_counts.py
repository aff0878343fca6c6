"""Token counts by heap-and-linked-list byte-pair merging.

Symbols of a text stand in a linked list; a heap holds the adjacent pairs that make a piece of the vocabulary. The pair of
lowest rank (leftmost on a tie) is popped and merged until none is left, so a text of ``s`` symbols has ``s`` minus
the number of merges tokens; no identifier is made. A character outside the vocabulary counts as its UTF-8 bytes.

Merges never cross a place that no piece spans. Where no piece holds a blank after another character, or holds some
character together with a neighbour, texts are cut there, and the counts of short parts are remembered by each worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_BLANK = "▁"  # fixed value: how the vocabulary writes a blank
_CHUNK = 1 << 20
_PLACE, _PLACE_BITS = 20, 32  # bits of a symbol and of a place in a heap entry
_SYMBOLS, _PLACES = (1 << _PLACE) - 1, (1 << _PLACE_BITS) - 1
_REMEMBERED, _SHORT = 1_000_000, 48  # parts remembered by a worker, and their longest


class _Remembered(dict):
    """Counts of short parts; emptied when full."""

    def __init__(self, tokens):
        self.tokens = tokens

    def __missing__(self, part: str) -> int:
        found = self.tokens(part)
        if len(part) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[part] = found
        return found


class Merges:
    """Pairs of symbols that merge, from ``(piece, score)`` of a vocabulary with byte fallback."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        names = dict(pieces)
        order = {s: r for r, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        self.symbol = {x: i for i, x in enumerate(sorted(names.keys() | {c for p in names for c in p}))}
        self.own = {c: 1 if c in names else len(c.encode()) for c in self.symbol if len(c) == 1}
        self.plain = all(x == 1 for x in self.own.values())
        self.pairs: dict[tuple[int, int], int] = {}
        for piece, score in pieces:
            for k in range(1, len(piece)):
                pair = self.symbol.get(piece[:k]), self.symbol.get(piece[k:])
                if None not in pair:
                    self.pairs[pair] = (order[score] + 1 << _PLACE + _PLACE_BITS) + self.symbol[piece]
        long = [p for p in names if len(p) > 1]
        alone = sorted(self.symbol.keys() & set("\n\r\t") | set("\n\r\t") - {c for p in long for c in p})
        alone = [c for c in alone if not any(c in p for p in long)]
        blank_leads = not any(_BLANK in p.lstrip(_BLANK) for p in long)
        solid = re.escape("".join(alone))
        self.cut = re.compile(f"{_BLANK}*[^{_BLANK}{solid}]+|{_BLANK}+" + (f"|[{solid}]" if alone else "")) if blank_leads else None
        self.known = _Remembered(self.tokens)

    def tokens(self, part: str) -> int:
        """Tokens of a part: initial symbols minus merges."""
        ids = list(map(self.symbol.get, part))
        n, pairs = len(ids), self.pairs
        total = n if self.plain and None not in ids else sum(self.own.get(c) or len(c.encode()) for c in part)
        # an entry of the heap is the pair's number (rank, then merged symbol) with the place of its left symbol between
        heap = [met + (i << _PLACE) for i, met in enumerate(map(pairs.get, zip(ids, ids[1:]))) if met]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids.append(None)  # the end merges with nothing
        while heap:
            entry = heappop(heap)
            i = entry >> _PLACE & _PLACES
            j = after[i] if ids[i] is not None else n
            met = pairs.get((ids[i], ids[j]))
            if not met or met + (i << _PLACE) != entry:
                continue  # one of the two has changed since
            ids[i], ids[j] = merged, _ = met & _SYMBOLS, None
            total -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                met = pairs.get((merged, ids[k]))
                if met:
                    heappush(heap, met + (i << _PLACE))
            k = before[i]
            if k >= 0:
                met = pairs.get((ids[k], merged))
                if met:
                    heappush(heap, met + (k << _PLACE))
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text; the vocabulary puts a blank before it."""
        if not text:
            return 0
        if not self.cut:
            return self.tokens(_BLANK + text.replace(" ", _BLANK))
        total = 0
        for chunk in _chunks(text):
            total += sum(map(self.known.__getitem__, self.cut.findall(chunk)))
        return total


def _chunks(text: str) -> Iterator[str]:
    """The text with written blanks, in slices that end before a blank after another character."""
    start, lead = 0, _BLANK
    while start < len(text):
        end = start + _CHUNK
        if end < len(text):
            found = re.compile("(?<=[^ ▁]) ").search(text, end)
            end = found.start() if found else len(text)
        yield lead + text[start:end].replace(" ", _BLANK)
        start, lead = end, ""


def read_pieces(path: str) -> list[tuple[str, float]]:
    """``(piece, score)`` of the mergeable pieces of a sentencepiece BPE model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
    if not any(model.is_byte(i) for i in special) or any(model.is_unused(i) for i in ids):
        raise ValueError("the vocabulary needs byte fallback and no unused pieces")
    skip = set(special)
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids if i not in skip]


@lru_cache(4)
def _merges(pieces: tuple[tuple[str, float], ...]) -> Merges:
    """One table of merges per vocabulary and worker."""
    return Merges(pieces)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of *docs*: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than *limit* tokens).

    A null text is empty: no bytes, no tokens. Repeated rows give equal rows; null ids stay; other columns are ignored;
    an empty table gives an empty result. Strings that look like special tokens are ordinary text. A text is worked off
    in slices, but a run without blanks is merged as a whole, in ``n log n``. The vocabulary is read on the driver and
    broadcast; its size does not depend on the data.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(tuple(read_pieces(model_path)))

    def run(batches):
        merges = _merges(pieces.value)
        for batch in batches:
            counts = [merges.count(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
