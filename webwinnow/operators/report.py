"""Roll-ups over extraction results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from webwinnow.plans.session import cut_lineage

_c = F.col
RANGE_BITS = 9  # the median is looked for in one of 512 ranges of equally many distinct values


def steady_sum(c: Column) -> Column:
    """Sum that does not depend on row order, in decimals of 12 places; a plain sum where a value or the total is too large for them."""
    exact = c.try_cast("decimal(38,12)")
    fits = F.count_if(c.isNotNull() & exact.isNull()) == 0
    return F.coalesce(F.when(fits, F.try_sum(exact).cast("double")), F.sum(c.cast("double")))


def result_rows(extracted: DataFrame) -> DataFrame:
    """Report rows: url, status, title, selector, confidence, sizes and counts."""
    m = _c("metadata")
    ok = _c("error").isNull() | F.coalesce(m["low_content"], F.lit(False))
    return extracted.select(
        "page_id", "url",
        F.when(ok, "success").otherwise("error").alias("status"),
        "title",
        F.coalesce(m["selector"], F.lit("")).alias("selector"),
        F.coalesce(m["confidence"], F.lit(0.0)).alias("confidence"),
        F.length("content").alias("content_length"),
        F.length("raw_content").alias("raw_length"),
        F.coalesce(m["scored_blocks_count"], F.lit(0)).alias("scored_blocks"),
        F.coalesce(m["pruned_static"], F.lit(0)).alias("pruned_static"),
        F.coalesce(m["pruned_dynamic"], F.lit(0)).alias("pruned_dynamic"),
        F.coalesce(m["pruned_total"], F.lit(0)).alias("pruned_total"),
        F.coalesce(m["validation_pass"], F.lit(0)).alias("validation_pass"),
        "error",
    )


def with_category(rows: DataFrame, categories: DataFrame, on: str = "name") -> DataFrame:
    """Attach the category of each result by name; rows without a category are left out."""
    return rows.join(categories, on)


def category_report(rows: DataFrame, category: str = "category", measures: tuple[str, ...] = ("confidence",)) -> DataFrame:
    """Per category: successes, failures, success rate in percent, and mean measures over the successes."""
    good = _c("status") == "success"
    ok = F.count_if(good)
    means = [
        (F.coalesce(steady_sum(F.when(good, F.coalesce(_c(m), F.lit(0)))), F.lit(0.0)) / F.greatest(ok, F.lit(1)))
        .alias(f"avg_{m}")
        for m in measures
    ]
    return rows.groupBy(category).agg(
        ok.alias("ok"),
        F.count_if(~good).alias("fail"),
        (ok / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100).alias("rate"),
        *means,
    )


def value_counts(rows: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """``measure, x, n``: how often each value occurs among the successful rows."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), _c(m).cast("double").alias("x")) for m in measures])
    long = rows.where(_c("status") == "success").select(F.inline(pairs)).where(_c("x").isNotNull())
    return long.groupBy("measure", "x").agg(F.count(F.lit(1)).alias("n"))


def dealt_ranges(counts: DataFrame, whole: DataFrame) -> DataFrame:
    """*counts* with the ``range`` of each value: how many of its measure's sorted splitters it reaches (a bisection)."""
    met = counts.join(F.broadcast(whole.select("measure", "splitters", "total")), "measure")  # a row per measure
    place = F.lit(0)
    for step in (1 << k for k in reversed(range(RANGE_BITS))):
        place = place + F.when(F.get("splitters", place + (step - 1)) <= _c("x"), step).otherwise(0)
        met = met.withColumn("range", place)
        place = _c("range")
    return met.drop("splitters")


def overall_report(rows: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """One row per measure: minimum, maximum, mean and upper median of the successful rows.

    The median is the element at ``n // 2`` of the sorted values. Equal values are counted first and the counts written
    once. A quantile sketch over the distinct values gives splitters, so ranges hold about equally many of them however
    the values are spread; totals per range tell where the median lies, and only that range is summed up value by value.
    """
    counts = cut_lineage(value_counts(rows, measures))
    cuts = F.array(*[F.lit(k / (1 << RANGE_BITS)) for k in range(1, 1 << RANGE_BITS)])
    whole = counts.groupBy("measure").agg(
        F.min("x").alias("min"), F.max("x").alias("max"), (steady_sum(_c("x") * _c("n")) / F.sum("n")).alias("mean"),
        F.sum("n").alias("total"), F.percentile_approx("x", cuts, F.lit(20 << RANGE_BITS)).alias("splitters"),
    )
    ranged = dealt_ranges(counts, whole)
    sums = ranged.groupBy("measure", "range").agg(F.sum("n").alias("in_range"), F.first("total").alias("total"))
    before = F.sum("in_range").over(Window.partitionBy("measure").orderBy("range")) - _c("in_range")
    middle = F.floor(_c("total") / 2)
    held = sums.withColumn("before", before).where((_c("before") <= middle) & (middle < _c("before") + _c("in_range")))
    held = held.select("measure", "range", "before", middle.alias("middle"))
    through = _c("before") + F.sum("n").over(Window.partitionBy("measure", "range").orderBy("x"))
    picked = ranged.join(F.broadcast(held), ["measure", "range"]).withColumn("through", through).where(_c("through") > _c("middle"))
    median = picked.groupBy("measure").agg(F.min("x").alias("median"))
    return whole.join(median, "measure").select("measure", "min", "max", "mean", "median")


def pass_histogram(rows: DataFrame) -> DataFrame:
    """Count and percentage of validation passes 1, 2 and 3 among the successful rows."""
    good = _c("status") == "success"
    totals = rows.agg(
        F.count_if(good).alias("total"),
        *[F.count_if(good & (_c("validation_pass") == p)).alias(f"p{p}") for p in (1, 2, 3)],
    )
    lines = F.array(*[F.struct(F.lit(p).alias("validation_pass"), _c(f"p{p}").alias("n")) for p in (1, 2, 3)])
    return totals.select("total", F.inline(lines)).select(
        "validation_pass", "n", (_c("n") / F.greatest(_c("total"), F.lit(1)) * 100).alias("percent")
    )


def summary(rows: DataFrame, version: str) -> DataFrame:
    """Version, total, success and failed counts, one row."""
    good = _c("status") == "success"
    return rows.agg(
        F.lit(version).alias("version"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(good).alias("success"),
        F.count_if(~good).alias("failed"),
    )
