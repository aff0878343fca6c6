"""Page scan: raw pages -> one row per page with its DOM as nested columns.

The scan is a narrow map: it never shuffles, and every later per-page operator
works on the row's own arrays, so rows meet only where pages really meet
(structure lookup, embedded frames, reports).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from webwinnow import constants as K
from webwinnow.plans.session import lookup_join, spread
from webwinnow.schemas import DOM_FIELDS, FRAME, NODE, PAGES
from webwinnow.sources.dom_tokens import PageRows
from webwinnow.sources.html_tree import parse_html

TOKENS_PER_BATCH = 200_000


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a page table (parquet, json or csv) with its fixed schema."""
    reader = spark.read.schema(PAGES)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return spread(reader.format(fmt).load(path))


def _list(flat, ends):
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def _struct_list(columns, fields: T.StructType, ends):
    schema = to_arrow_schema(fields)
    arrays = [pa.array(columns[f.name], f.type) for f in schema]
    return _list(pa.StructArray.from_arrays(arrays, fields=list(schema)), ends)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        html_at, url_at = names.index("html"), names.index("url")
        kept = [i for i, name in enumerate(names) if name != "html"]
        start = 0
        rows, errors = PageRows(), []

        def flush(stop):
            columns = [batch.column(i).slice(start, stop - start) for i in kept]
            columns.append(_struct_list(rows.nodes, NODE, rows.node_ends))
            columns.extend(_list(pa.array(v, pa.string()), rows.token_ends) for v in (rows.t, rows.h, rows.m))
            columns.append(_struct_list(rows.frames, FRAME, rows.frame_ends))
            columns.append(pa.array(errors, pa.string()))
            return pa.RecordBatch.from_arrays(columns, [names[i] for i in kept] + [f.name for f in DOM_FIELDS])

        for i in range(batch.num_rows):
            source = batch.column(html_at)[i].as_py()
            if source is None:
                rows.close_page()
                errors.append(K.ERR_NO_PAGE)
            else:
                try:
                    rows.add_page(parse_html(source), batch.column(url_at)[i].as_py())
                    errors.append(None)
                except Exception as exc:  # one bad page must not fail the batch
                    rows.drop_open_page()
                    rows.close_page()
                    errors.append(f"{type(exc).__name__}: {exc}")
            if len(rows.t) >= TOKENS_PER_BATCH:
                yield flush(i + 1)
                start, rows, errors = i + 1, PageRows(), []
        if start < batch.num_rows:
            yield flush(batch.num_rows)


def scan_dom(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by the page's nodes, tokens and frames; other columns pass through."""
    kept = [f for f in pages.schema.fields if f.name != "html"]
    return pages.mapInArrow(_scan_batches, T.StructType(kept + DOM_FIELDS))


def dom_nodes(dom: DataFrame) -> DataFrame:
    """The DOM as a flat table, one row per element in document order."""
    return dom.select("page_id", F.inline("nodes")).withColumnsRenamed(
        {"id": "node_id", "last": "last_id", "parent": "parent_id"}
    )


def requested_pages(urls: DataFrame, pages: DataFrame, cap: int | None = None) -> DataFrame:
    """One row per requested ``(pos, url)``: the page, or a null ``html`` when it is missing.

    ``cap`` keeps the first positions of the request only. Copies of a URL in
    *pages* are reduced to the one with the highest ``page_id``.
    """
    if cap is not None:
        urls = urls.where(F.col("pos") < cap)
    wanted = urls.select("url").where(F.col("url").isNotNull()).distinct()
    latest = (
        pages.select("url", "page_id", "html")
        .join(wanted, "url", "left_semi")  # only pages that were asked for go on with their html
        .groupBy("url")
        .agg(F.max_by(F.struct("page_id", "html"), "page_id").alias("page"))
    )
    return lookup_join(urls, latest, "url", "pos").select("pos", "url", "page.page_id", "page.html")


def explode_request(requests: DataFrame, urls: str | Column = "urls") -> DataFrame:
    """``array<string>`` request lists -> ``(pos, url)`` rows in list order."""
    return requests.select(F.posexplode(urls).alias("pos", "url"))

