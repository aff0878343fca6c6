"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Each rule says good (1), bad (-1) or nothing (0) about a document. Documents with the same votes are one *pattern*;
there are at most ``3 ** len(RULES)`` of them whatever the size of the corpus, so their counts may go to the driver.
Expectation-maximisation over the patterns of all documents that pass the base rules estimates each rule's accuracy on
good and on bad documents and the share of good ones, without labels; the log-odds of a document are then a sum over
its votes, computed in columns. Documents that fail the base rules are decided already and would only blur the picture.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from webwinnow.llm.common import saved, shingle_hashes, text_bytes, total, unused, word_hashes, word_spans

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bangs", "n_pipes", "n_stops")

# Classes of bytes, counted per text.
_SPACE, _INNER, _SYMBOL, _PIPE, _UPPER, _LOWER, _BANG, _STOP = range(1, 9)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[128:192] = _INNER
_CLASS[list(b"#*$%&<>")] = _SYMBOL
_CLASS[ord("|")] = _PIPE
_CLASS[65:91] = _UPPER
_CLASS[97:123] = _LOWER
_CLASS[ord("!")] = _BANG
_CLASS[list(b".?")] = _STOP


def _share(s, part: str, of: str = "n_words") -> Column:
    return s[part] / F.greatest(F.lit(1), s[of])


def _capitals(s) -> Column:
    return s["n_upper"] / F.greatest(F.lit(1), s["n_upper"] + s["n_lower"])


#: (name, bad, good) over the counts of a text; where neither holds the rule abstains.
RULES = (
    ("symbols", lambda s: _share(s, "n_symbols") > 0.1, lambda s: _share(s, "n_symbols") < 0.02),
    ("capitals", lambda s: _capitals(s) > 0.4, lambda s: _capitals(s) < 0.15),
    ("exclamations", lambda s: _share(s, "n_bangs") > 0.2, lambda s: _share(s, "n_bangs") < 0.02),
    ("separators", lambda s: _share(s, "n_pipes") > 0.2, lambda s: _share(s, "n_pipes") < 0.02),
    ("repeats", lambda s: _share(s, "n_repeat_words") > 0.4, lambda s: _share(s, "n_repeat_words") < 0.1),
    ("lines", lambda s: _share(s, "n_dup_lines", "n_lines") > 0.3, lambda s: _share(s, "n_dup_lines", "n_lines") < 0.1),
    ("word length", lambda s: ~_share(s, "word_chars").between(2.5, 14), lambda s: _share(s, "word_chars").between(3, 11)),
    ("sentences", lambda s: ~_share(s, "n_stops").between(0.002, 0.6), lambda s: _share(s, "n_stops").between(0.01, 0.35)),
    ("length", lambda s: s["n_words"] < 50, lambda s: s["n_words"] >= 80),
)


#: A rule is trusted to speak against a good document no more often than this; else junk that breaks one rule only
#: would pass for good documents on which that rule is wrong.
FALSE_ALARM = 0.002


def base_failed(s) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _repeated(words: np.ndarray) -> int:
    """Words in three-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    _, at, count = np.unique(shingle_hashes(words, 3), return_inverse=True, return_counts=True)
    twice = count[at] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(twice)] |= twice
    return int(inside.sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _stats(column: pa.Array) -> Iterator[list[int]]:
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, lower=False)
    classes = _CLASS[data]
    for i in range(len(offsets) - 1):
        a, b = offsets[i], offsets[i + 1]
        c = np.bincount(classes[a:b], minlength=9)
        mine = words[first[i] : first[i + 1]]
        n_lines, n_dup = _lines(data[a:b].tobytes())
        yield [
            len(mine), int(b - a - c[_SPACE] - c[_INNER]), int(c[_SYMBOL] + c[_PIPE]), n_dup, _repeated(mine), n_lines,
            int(c[_UPPER]), int(c[_LOWER]), int(c[_BANG]), int(c[_PIPE]), int(c[_BANG] + c[_STOP]),
        ]


def with_stats(docs: DataFrame, name: str = "stats", text_col: str = "text") -> DataFrame:
    """*docs* with a struct column *name* of the counts in ``STATS``; a null text counts as empty."""
    at = docs.columns.index(text_col)
    kind = pa.struct([(x, pa.int64()) for x in STATS])

    def run(batches):
        for batch in batches:
            rows = list(_stats(batch.column(at)))
            columns = [pa.array(x, pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(STATS)
            stats = pa.StructArray.from_arrays(columns, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, stats], [*batch.schema.names, name])

    fields = T.StructType([T.StructField(x, T.LongType(), False) for x in STATS])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, fields, False)]))


@dataclass(frozen=True)
class VoteModel:
    """Log-odds of a good document, and what each rule's bad vote, silence and good vote add to them."""

    prior: float
    weights: tuple[tuple[float, float, float], ...]

    def posterior(self, votes: list[Column]) -> Column:
        added = [F.element_at(F.array(*map(F.lit, w)), v + 2) for v, w in zip(votes, self.weights)]
        return 1 / (1 + F.exp(-total([F.lit(self.prior), *added])))


def votes(s) -> list[Column]:
    """One column of -1, 0 or 1 per rule, from a struct column (or a dict of columns) with ``STATS``."""
    return [F.when(bad(s), -1).when(good(s), 1).otherwise(0) for _, bad, good in RULES]


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, false_alarm: float = FALSE_ALARM,
) -> VoteModel:
    """A rule's accuracy on good and on bad documents, from vote patterns and how many documents show each.

    Starts from all-must-pass (any bad vote: probably bad), then alternates between the posterior of each pattern and
    the share of good votes, silences and bad votes of each rule among good and among bad documents. Half a document is
    added to every count. One thing bends the plain estimate: ``false_alarm`` (1: none) limits how often a rule may be
    wrong about good documents.
    """
    n = counts.sum()
    shown = np.stack([patterns == v for v in (-1, 0, 1)]).astype(float)  # vote, pattern, rule
    q = np.where((patterns == -1).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        good, bad = counts * q, counts * (1 - q)
        share = np.clip((good.sum() + 0.5) / (n + 1), 0.01, 0.99)
        odds = np.log((good @ shown + 0.5) / (good.sum() + 1.5)) - np.log((bad @ shown + 0.5) / (bad.sum() + 1.5))
        odds[0] = np.minimum(odds[0], np.log(false_alarm) - np.log((bad @ shown[0] + 0.5) / (bad.sum() + 1.5)))
        prior = np.log(share / (1 - share))
        now = 1 / (1 + np.exp(-(prior + np.einsum("vpr,vr->p", shown, odds))))
        moved = np.abs(now - q).max()
        q = now
        if moved < 1e-9:
            break
    return VoteModel(float(prior), tuple(tuple(x) for x in odds.T.tolist()))


def vote_patterns(judged: DataFrame, name: str = "stats") -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns of the documents that pass the base rules, and their counts: at most ``3 ** len(RULES)`` rows."""
    voted = judged.where(~base_failed(F.col(name))).select(F.array(*votes(F.col(name))).alias("v"))
    rows = sorted((tuple(r["v"]), r["count"]) for r in voted.groupBy("v").count().collect())
    if not rows:
        return np.zeros((1, len(RULES))), np.zeros(1)
    return np.array([v for v, _ in rows], float), np.array([n for _, n in rows], float)


def fit_votes(judged: DataFrame, name: str = "stats") -> VoteModel:
    """The model for a table with the struct column *name*; an empty table has one without evidence."""
    return expectation_maximisation(*vote_patterns(judged, name))


def kept(s, model: VoteModel) -> Column:
    """Base rules passed, and a posterior of at least a half."""
    return ~base_failed(s) & (model.posterior(votes(s)) >= 0.5)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of *docs*: the id, five counts, ``base_failed``, ``quality_probability`` and ``kept``.

    Null and empty texts have no words and fail; repeated rows get the same verdict; a null id stays null; other
    columns are ignored; an empty table gives an empty result.
    """
    judged = saved(with_stats(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).drop("text"), "stats")
    model, s = fit_votes(judged), F.col("stats")
    return judged.select(
        F.col("id").alias(id_col), *[s[x].alias(x) for x in STATS[:5]], base_failed(s).alias("base_failed"),
        model.posterior(votes(s)).alias("quality_probability"), kept(s, model).alias("kept"),
    )


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of *docs* that the rules keep, columns unchanged; the edge cases of ``quality_verdicts`` hold here too."""
    model = fit_votes(with_stats(docs.select(F.col(text_col).alias("text"))))
    name = unused(docs, "stats")
    return with_stats(docs, name, text_col).where(kept(F.col(name), model)).select(*docs.columns)
