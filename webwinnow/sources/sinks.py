"""Outputs: result rows, request envelopes, digests, metrics and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from webwinnow.operators.report import summary
from webwinnow.plans.session import lookup_join

_c = F.col
_JSON = {"ignoreNullFields": "false"}
_END = (1 << 63) - 1


def write_results(results: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write result rows (parquet or json lines) to a new directory."""
    writer = results.write.mode("errorifexists")
    (writer.option("ignoreNullFields", False) if fmt == "json" else writer).format(fmt).save(path)


def request_envelopes(requests: DataFrame, results: DataFrame, payload: str = "data") -> DataFrame:
    """``(request_id, envelope)``: one JSON text per request, items in request order.

    *results* holds ``request_id`` and ``pos`` besides the item columns; a
    request is a capped URL list, so its group is small.  A request without
    items gives an empty list, a null or empty URL list an error.
    """
    item = F.struct(*[c for c in results.columns if c not in ("request_id", "pos")])
    grouped = results.groupBy("request_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", item.alias("item")))), lambda x: x["item"]).alias("items")
    )
    done = F.to_json(
        F.struct(F.lit(True).alias("success"), F.coalesce(_c("items"), F.array()).alias(payload)), _JSON
    )
    failed = F.to_json(
        F.struct(F.lit(False).alias("success"), F.lit("urls required (list of strings)").alias("error"))
    )
    return requests.join(grouped, "request_id", "left").select(
        "request_id", F.when(F.coalesce(F.size("urls"), F.lit(0)) < 1, failed).otherwise(done).alias("envelope")
    )


def envelope_lines(requests: DataFrame, results: DataFrame, payload: str = "data") -> DataFrame:
    """``(request_id, place, line)``: the texts of :func:`request_envelopes` in lines, to be read in order of ``place``.

    An opening line, a line per item and a closing line, so requests of any length stay rows. ``request_id`` is unique
    in *requests*, ``(request_id, pos)`` in *results*; items of other requests are left out.
    """
    item = F.to_json(F.struct(*[c for c in results.columns if c not in ("request_id", "pos")]), _JSON)
    valid = F.coalesce(F.size("urls"), F.lit(0)) > 0
    first = results.groupBy("request_id").agg(F.min("pos").alias("first"))
    asked = requests.where(valid).select("request_id").join(first, "request_id")
    items = lookup_join(results.select("request_id", "pos", item.alias("item")), asked, "request_id", "pos")
    body = items.where(_c("first").isNotNull()).select(
        "request_id", _c("pos").cast("long").alias("place"),
        F.concat(F.when(_c("pos") > _c("first"), F.lit(",")).otherwise(F.lit("")), _c("item")).alias("line"),
    )
    failed = F.to_json(F.struct(F.lit(False).alias("success"), F.lit("urls required (list of strings)").alias("error")))

    def line(place, text):
        return F.struct(F.lit(place).cast("long").alias("place"), text.alias("line"))

    around = F.when(valid, F.array(line(-1, F.lit(f'{{"success":true,"{payload}":[')), line(_END, F.lit("]}"))))
    return body.unionByName(requests.select("request_id", F.inline(around.otherwise(F.array(line(-1, failed))))))


def write_envelopes(requests: DataFrame, results: DataFrame, path: str, payload: str = "data") -> None:
    """Write one JSON text per request under *path*: ``request_id=.../part-*.txt``, to be read in order of the names.

    Rows are dealt by ranges of request and place and sorted within them, so a task holds one open file and a long
    request is spread over many tasks.
    """
    _write_lines(envelope_lines(requests, results, payload), path)


def _write_lines(lines: DataFrame, path: str) -> None:
    dealt = lines.repartitionByRange("request_id", "place").sortWithinPartitions("request_id", "place")
    dealt.select("request_id", "line").write.mode("errorifexists").partitionBy("request_id").text(path)


def search_envelopes(requests: DataFrame, results: DataFrame) -> DataFrame:
    """``(query, envelope)``: one JSON text per search request; a missing query gives an error.

    *results* are the top hits per query, at most 20 each.
    """
    hit = F.struct("position", F.struct("title", "url", "description", "position").alias("item"))
    grouped = results.groupBy("query").agg(
        F.transform(F.sort_array(F.collect_list(hit)), lambda x: x["item"]).alias("items")
    )
    done = F.to_json(
        F.struct(F.lit(True).alias("success"), F.coalesce(_c("items"), F.array()).alias("results")), _JSON
    )
    failed = F.to_json(
        F.struct(F.lit(False).alias("success"), F.lit("query required (string)").alias("error"))
    )
    return requests.join(grouped, "query", "left").select(
        "query", F.when(F.coalesce(_c("query"), F.lit("")) == "", failed).otherwise(done).alias("envelope")
    )


def _digest_part() -> Column:
    """The Markdown of an item, without its last line end."""
    def filled(name, other):
        return F.coalesce(F.nullif(_c(name), F.lit("")), other)

    return F.when(
        F.coalesce(_c("error"), F.lit("")) != "", F.concat(F.lit("### ❌ "), _c("url"), F.lit("\n"), _c("error"))
    ).otherwise(
        F.concat(F.lit("### 📄 "), filled("title", _c("url")), F.lit("\n\n"), filled("content", F.lit("*No content*")))
    )


def extract_digest(results: DataFrame) -> DataFrame:
    """``(request_id, digest)``: the items of a request as one Markdown text."""
    part = F.concat(_digest_part(), F.lit("\n"))
    grouped = results.groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", part.alias("part")))).alias("parts")
    )
    return grouped.select(
        "request_id", F.array_join(F.transform("parts", lambda p: p["part"]), "\n---\n").alias("digest")
    )


def digest_lines(results: DataFrame) -> DataFrame:
    """``(request_id, place, line)``: the texts of :func:`extract_digest`, a row per item, each to be followed by a line end.

    ``(request_id, pos)`` is unique in *results*.
    """
    first = results.groupBy("request_id").agg(F.min("pos").alias("first"))
    items = lookup_join(results.select("request_id", "pos", _digest_part().alias("part")), first, "request_id", "pos")
    between = F.when(_c("pos") > _c("first"), F.lit("\n---\n")).otherwise(F.lit(""))
    return items.select("request_id", _c("pos").cast("long").alias("place"), F.concat(between, "part").alias("line"))


def write_digests(results: DataFrame, path: str) -> None:
    """Write one Markdown text per request under *path*, laid out as by :func:`write_envelopes`."""
    _write_lines(digest_lines(results), path)


def metrics(extracted: DataFrame) -> DataFrame:
    """One row per extraction that reached its finish."""
    return extracted.where(_c("finished")).select(
        "url",
        F.coalesce(_c("finish_quality"), F.lit(0.0)).alias("quality_score"),
        F.coalesce(_c("metadata.structure_cache_hit"), F.lit(False)).alias("structure_cache_hit"),
        F.lit("").alias("error"),
    )


def write_report(rows: DataFrame, version: str, path: str) -> None:
    """Write report rows and their one-row summary as JSON under a new directory."""
    rows.write.mode("errorifexists").json(f"{path}/results")
    summary(rows, version).write.mode("errorifexists").json(f"{path}/summary")
