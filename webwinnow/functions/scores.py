"""Score formulas as column expressions (usable on table columns and on array elements)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from webwinnow import constants as K
from webwinnow.functions.binding import let
from webwinnow.functions.text import fill


def round3(x: Column) -> Column:
    """Round a double to 3 decimals by its exact binary value, ties to even.

    ``round`` decides on the shortest printed form and so differs on values
    such as 1.0005.  The product with 1000 is split into its rounded value and
    its exact error, which settles the halves.
    """
    def parts(v):
        split = v * F.lit(134217729.0)
        high = split - (split - v)
        scaled = v * F.lit(1000.0)
        return F.struct(
            F.floor(scaled).cast("double").alias("low"),
            scaled.alias("scaled"),
            ((high * F.lit(1000.0) - scaled) + (v - high) * F.lit(1000.0)).alias("error"),
        )

    def settle(p):
        rest = p["scaled"] - p["low"]
        up = (rest > 0.5) | (
            (rest == 0.5) & ((p["error"] > 0) | ((p["error"] == 0) & (F.pmod(p["low"], F.lit(2.0)) == 1.0)))
        )
        return (p["low"] + F.when(up, 1.0).otherwise(0.0)) / F.lit(1000.0)

    return let(let(x, parts), settle)


def link_density(text: Column, link: Column) -> Column:
    return F.when(text > 0, link / text).otherwise(0.0)


def text_density(text: Column, tags: Column) -> Column:
    return F.when(tags > 0, text / tags).otherwise(0.0)


def block_score(text: Column, tags: Column, link: Column, commas: Column) -> Column:
    penalty = F.greatest(F.lit(0.0), F.lit(1.0) - link / text)
    score = text / (tags + 1) * penalty / F.lit(100.0) + commas * F.lit(K.COMMA_WEIGHT)
    return F.when(text < K.MIN_BLOCK_TEXT, 0.0).otherwise(score)


def selector_tag(selector: Column) -> Column:
    return F.lower(F.regexp_extract(selector, r"^[^.#]*", 0))


def is_likely_noise(selector: Column, text: Column, density: Column, score: Column) -> Column:
    protected = (text >= K.PROTECT_TEXT) & selector_tag(selector).isin(*K.CONTENT_TAGS)
    return F.when(score >= K.SCORE_THRESHOLD, False).when(protected, False).otherwise(density > K.LINK_NOISE)


def scorer_confidence(blocks: Column, strong: Column, top3: Column, text_total: Column) -> Column:
    """From block count, blocks at or over the threshold, mean of the top 3 scores, total text."""
    value = (
        strong / blocks * F.lit(0.4)
        + F.least(F.lit(1.0), top3 / F.lit(5.0)) * F.lit(0.3)
        + F.least(F.lit(1.0), text_total / F.lit(2000)) * F.lit(0.3)
    )
    return F.when(blocks == 0, 0.0).otherwise(round3(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))))


def validate(exists: Column, text: Column, commas: Column, density: Column, avg: Column) -> Column:
    """The three-pass cascade, as a struct."""

    def passes(limits):
        min_text, min_commas, min_score, max_density = limits
        return (text >= min_text) & (commas >= min_commas) & (avg >= min_score) & (density <= max_density)

    def outcome(confidence, number, warning, measured=True):
        return F.struct(
            (text if measured else F.lit(0)).cast("int").alias("text_length"),
            (commas if measured else F.lit(0)).cast("int").alias("comma_count"),
            (density if measured else F.lit(0.0)).cast("double").alias("link_density"),
            (avg if measured else F.lit(0.0)).cast("double").alias("avg_score"),
            confidence.alias("confidence"),
            F.lit(number).alias("pass_used"),
            warning.cast("string").alias("warning"),
        )

    bonus = avg / F.lit(10.0) * F.lit(0.3)
    return (
        F.when(~exists, outcome(F.lit(0.1), 3, F.lit(K.WARN_NO_MATCH), False))
        .when(text == 0, outcome(F.lit(0.1), 3, F.lit(K.WARN_NO_CONTENT), False))
        .when(passes(K.PASS1), outcome(round3(F.least(F.lit(1.0), F.lit(0.7) + bonus)), 1, F.lit(None)))
        .when(passes(K.PASS2), outcome(round3(F.least(F.lit(0.7), F.lit(0.4) + bonus)), 2, F.lit(K.WARN_RELAXED)))
        .when(text >= K.PASS3_MIN_TEXT, outcome(F.lit(0.2), 3, fill(K.WARN_FALLBACK, text, commas)))
        .otherwise(outcome(F.lit(0.1), 3, fill(K.WARN_TOO_SHORT, text), False))
    )


def final_confidence(mapper: Column, scorer: Column, validator: Column) -> Column:
    return round3(mapper * F.lit(0.3) + scorer * F.lit(0.3) + validator * F.lit(0.4))
