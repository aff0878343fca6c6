"""Content-quality columns and the zero-noise gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from webwinnow import constants as K
from webwinnow.functions import text as tx
from webwinnow.functions.binding import let


def with_quality(df: DataFrame, content: str = "content", raw: Column | None = None) -> DataFrame:
    """Strip boilerplate lines, then add language, quality_score, main_content and has_schema.

    ``raw`` is the HTML searched for schema.org marks; extraction results keep
    no raw HTML, so their flag is false.
    """
    cleaned = df.withColumn(content, tx.remove_boilerplate(F.col(content)))
    c = F.col(content)
    return cleaned.withColumns({
        "language": tx.language(c),
        "quality_score": tx.quality_score(c),
        "main_content": tx.main_paragraphs(c),
        "has_schema": tx.has_schema(F.lit("") if raw is None else raw),
    })


def noise_pattern_count(c: Column) -> Column:
    """How many of the text-noise patterns occur."""
    def count(low):
        total = F.lit(0)
        for pattern in K.TEXT_NOISE:
            total = total + tx.holds_pattern(c, low, pattern).cast("int")
        return total

    return let(tx.folded(c), count)


def text_gate(c: Column) -> Column:
    """Failure message of the text gate, null when the text passes."""
    failure = let(
        noise_pattern_count(c), lambda n: F.when(n > K.MAX_TEXT_NOISE, tx.fill(K.GATE_TEXT_NOISE, n))
    )
    return F.when(F.coalesce(tx.strip(c), F.lit("")) == "", K.GATE_TEXT_EMPTY).otherwise(failure)


def main_body(c: Column) -> Column:
    """Text between the first pair of body tags, stripped; null without a pair."""
    start, end = "<main_body>", "</main_body>"

    def cut(tail):
        stop = F.locate(end, tail)
        return F.when(stop > 0, tx.strip(F.substring(tail, F.lit(1), stop - 1)))

    tail = F.substring(c, F.locate(start, c) + len(start), F.length(c))
    return F.when(c.contains(start), let(tail, cut))


def boundary_gate(c: Column, body: Column | None = None) -> Column:
    """First failing check of the boundary format, null when it passes; ``body`` may hold ``main_body(c)``."""
    space = tx.SPACE

    def judge(inner):
        return (
            F.when(~(c.contains("<extraction_result>") & c.rlike(rf"(?:^|\n){space}*<extraction_result>")), K.GATE_OPEN)
            .when(
                ~(c.contains("</extraction_result>") & c.rlike(rf"</extraction_result>{space}*(?=\n|\z)")), K.GATE_CLOSE
            )
            .when(~c.contains("<main_body>"), K.GATE_BODY_OPEN)
            .when(~c.contains("</main_body>"), K.GATE_BODY_CLOSE)
            .when(inner.isNull(), K.GATE_MALFORMED)
            .when(inner == "", K.GATE_BODY_EMPTY)
            .when(
                ~(inner.contains("#") & inner.rlike(rf"(?:^|\n)#{{1,6}}{space}+[^{space[1:]}")), K.GATE_NO_HEADING
            )
        )

    return let(main_body(c), judge) if body is None else judge(body)


def qa_gate(df: DataFrame, text: str | None = None, wrapped: str | None = None) -> DataFrame:
    """Add the gate columns instead of raising: messages, the pass flag and the inner body."""
    reasons = []
    if text is not None:
        df = df.withColumn("text_failure", text_gate(F.col(text)))
        reasons.append(F.col("text_failure"))
    if wrapped is not None:
        df = df.withColumn("body", main_body(F.col(wrapped)))
        df = df.withColumn("boundary_failure", boundary_gate(F.col(wrapped), F.col("body")))
        df = df.withColumn("body", F.when(F.col("boundary_failure").isNull(), F.col("body")))
        reasons.append(F.col("boundary_failure"))
    return df.withColumn("passed", F.coalesce(*reasons).isNull())
