"""Evaluate an expression once and use it several times inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with *value* evaluated once per row (or per array element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums or extremes of an integer array.

    A fold that grows an array copies it at each step, so the array is cut into blocks of about the square root of its
    length: running values within blocks, those of the block totals, and both together.
    """
    empty = F.array().cast("array<int>")

    def scanned(block: Column) -> Column:
        def step(out: Column, v: Column) -> Column:
            return F.concat(out, F.array(F.when(F.size(out) == 0, v).otherwise(combine(F.element_at(out, -1), v))))

        return F.aggregate(block, empty, step)

    def blocked(x: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(x).cast("double"))).cast("int")
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / size).cast("int"))
        return F.transform(starts, lambda k: scanned(F.slice(x, k * size + 1, size)))

    def carried(local: Column) -> Column:
        def shifted(totals: Column) -> Column:
            return F.flatten(F.transform(local, lambda block, k: F.when(k == 0, block).otherwise(
                let(F.get(totals, k - 1), lambda t: F.transform(block, lambda v: combine(t, v))))))

        return let(scanned(F.transform(local, lambda block: F.element_at(block, -1))), shifted)

    return let(values.cast("array<int>"), lambda x: F.when(F.size(x) <= 0, empty).otherwise(let(blocked(x), carried)))


def fixed_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Compute the named columns here, whatever is done with them later.

    A filter on a derived column is otherwise pushed down by substituting
    expressions, level by level, which multiplies a deep chain of them.  A
    filter does not pass the generator used here.
    """
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*names))))
