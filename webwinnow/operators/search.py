"""Ranked search hits: per-query top-k and the text digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from webwinnow import constants as K

_c = F.col


def search_requests(requests: DataFrame) -> DataFrame:
    """Clamp ``limit`` (default 5, at most 20); a missing query or a limit that is no whole number is told in ``error``."""
    blank = F.coalesce(_c("query"), F.lit("")) == ""
    text = F.trim(_c("limit").cast("string"))
    # whole numbers of any length: the sign and whether more than two digits are left after zeros say enough
    digits = F.regexp_extract(text, r"^[+-]?0*([0-9]*)$", 1)
    number = F.when(F.length(digits) > 9, F.when(text.startswith("-"), -K.SEARCH_MAX).otherwise(K.SEARCH_MAX)).otherwise(
        F.expr("try_cast(trim(cast(limit as string)) as int)"))
    numeric = _c("limit").isNull() | text.rlike(r"^[+-]?[0-9]+$")
    return requests.withColumns({
        "limit": F.least(F.coalesce(number, F.lit(K.SEARCH_DEFAULT)), F.lit(K.SEARCH_MAX)),
        "error": F.when(blank, "query required (string)").when(~numeric, "limit must be a whole number"),
    })


def topk_hits(hits: DataFrame, limit: int | None = K.SEARCH_DEFAULT) -> DataFrame:
    """Best hits per query, ``(query, position, title, url, description)``.

    Higher score first, input order on a tie; a missing score counts as 0.
    ``limit=None`` reads a per-row ``limit`` column.  The rank bound is pushed
    below the shuffle, so a hot query sends at most 20 rows per input split.
    """
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rank_in")
    hits = hits.withColumn("score", F.coalesce(F.expr("try_cast(score as double)"), F.lit(0.0)))
    bound = min(int(limit), K.SEARCH_MAX) if limit is not None else K.SEARCH_MAX
    ranked = hits.withColumn("position", F.row_number().over(order)).where(_c("position") <= bound)
    if limit is None:
        ranked = ranked.where(_c("position") <= F.least(_c("limit"), F.lit(K.SEARCH_MAX)))
    return ranked.select(
        "query", "position",
        F.coalesce(_c("title").cast("string"), F.lit("")).alias("title"),
        F.coalesce(_c("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(_c("content").cast("string"), F.lit("")).alias("description"),
    )


def search_digest(requests: DataFrame, results: DataFrame) -> DataFrame:
    """``(query, digest)``: one Markdown text per requested query."""
    entry = F.concat(
        F.lit("### "), _c("position").cast("string"), F.lit(". ["), _c("title"), F.lit("]("), _c("url"), F.lit(")\n"),
        F.when(_c("description") == "", "*No description*").otherwise(_c("description")), F.lit("\n"),
    )
    listed = results.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("position", entry.alias("entry")))).alias("entries")
    )
    body = F.array_join(F.transform("entries", lambda e: e["entry"]), "\n")
    return (
        requests.select("query").distinct()
        .join(listed, "query", "left")
        .select(
            "query",
            F.when(_c("entries").isNull(), K.NO_RESULTS)
            .otherwise(F.concat(F.lit("## Search Results: "), _c("query"), F.lit("\n\n"), body))
            .alias("digest"),
        )
    )
