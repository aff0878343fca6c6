"""Mixing sources to target weights by Efraimidis-Spirakis keys.

Sources share a token budget by weight, each up to ``most`` times its own size; what a full source leaves is shared
again among the others. A source first takes complete epochs of all its documents. The rest of its target is a weighted
sample without replacement: each document draws an exponential key divided by its quality weight, documents are sorted
by key within their source, and the smallest keys are taken while the prefix sum of sizes stays near the rest.

A source may hold a third of all rows, so its documents are first dealt to buckets of the key. Bucket totals give each
bucket its offset, and documents are sorted within a bucket only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from webwinnow.llm.common import WORD, saved, symbols, unused


_OCTAVES = 48  # classes of weights, four to a factor of two; the last one holds all smaller weights


@dataclass(frozen=True)
class Mix:
    """Weights dealt to sources in order, the budget as a share of all sizes, the limit per source, the key seed."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    seed: str = "mix"
    bucket_rows: int = 4_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Weight in (0, 1]: 1 for plain prose, less for each mark of junk per word."""
    return 1 / (1 + symbols(text, "#*$%&|<>!").cast("double") / F.greatest(F.lit(1), size))


def key(row: Column, weight: Column, seed: str) -> Column:
    """Exponential key of a row: ``-ln(u) / weight``, u in (0, 1) from a hash of the seed and the row's name."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), row)), 1, 12), 16, 10).cast("double")
    return -F.ln((bits + 0.5) / F.lit(float(1 << 48))) / weight


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, n`` -> also ``target``.

    Sources in order of code points, null last, have the weights in turn. Sharing the excess of full sources again and
    again ends where every open source has one rate per unit of weight; sorted by the rate at which they fill up, the
    full sources come first, so running sums give that rate. One row per source, so one task orders them.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    cap = F.col("source_size") * mix.most
    weight = F.element_at(F.array(*[F.lit(w) for w in mix.weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(mix.weights))) + 1).cast("int"))
    full = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = W.partitionBy()
    before = F.coalesce(F.sum("cap").over(full.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(full.rowsBetween(0, W.unboundedFollowing))
    rated = (
        sources.withColumns({"weight": weight, "cap": cap})
        .withColumn("budget", F.sum("source_size").over(everything) * mix.share)
        .withColumn("rate", (F.col("budget") - before) / open_weight)
        .withColumn("open", F.col("rate") * F.col("weight") <= F.col("cap"))
        # the first open source's rate holds for all that follow; if all are full the budget is the sum of the caps
        .withColumn("rate", F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "rate"))).over(everything)["rate"])
    )
    target = F.coalesce(F.least(F.col("rate") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return rated.withColumn("target", target).drop("cap", "budget", "rate", "open")


def bucketed(rows: DataFrame, mix: Mix) -> DataFrame:
    """``source, size, w, name`` (and more) -> also the source's plan, ``key`` and its ``bucket``."""
    octave = F.least(F.lit(_OCTAVES), F.floor(-4 * F.log2("w")))
    classes = rows.groupBy("source", octave.alias("octave")).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.sum("w").alias("w"))
    curve = F.array_sort(F.collect_list(F.struct((F.col("w") / F.col("n")).alias("w"), "n")))  # at most one entry per class
    plan = classes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("n").alias("n"), curve.alias("curve"))
    plan = targets(plan.withColumn("buckets", F.ceil(F.col("n") / mix.bucket_rows)), mix).drop("weight")
    plan = plan.withColumn("epochs", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)))
    plan = saved(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "plan")
    keyed = rows.withColumn("key", key(F.col("name"), F.col("w"), mix.seed))
    full = keyed.join(plan, keyed["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    # the share of smaller keys, which are exponential in each class of weights: this spreads keys evenly and in order
    above = F.aggregate("curve", F.lit(0.0), lambda s, c: s + c["n"] * F.exp(-F.col("key") * c["w"])) / F.col("n")
    full = full.withColumn("bucket", F.when(F.col("buckets") > 1, F.floor(F.col("buckets") * (1 - above))).otherwise(0).cast("long"))
    return full


def taken_rows(rows: DataFrame, mix: Mix) -> DataFrame:
    """``source, size, weight, name`` (and more) -> also ``source_size, target, epochs, taken``.

    A document of the rest is taken while half of it still fits, so a source ends within half a document of its target.
    """
    full = bucketed(rows, mix)
    offsets = full.groupBy("source", "bucket").agg(F.sum("size").alias("in"))
    offsets = offsets.withColumn("offset", F.sum("in").over(W.partitionBy("source").orderBy("bucket")) - F.col("in")).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "offset")
    placed = full.join(offsets, full["source"].eqNullSafe(offsets["s"]) & (full["bucket"] == offsets["b"])).drop("s", "b")
    within = W.partitionBy("source", "bucket").orderBy("key", "name", "size")  # equal rows are taken together
    through = F.col("offset") + F.sum("size").over(within)
    extra = (through - F.col("size") / 2 < F.col("rest")) & (F.col("size") > 0)
    placed = placed.withColumn("extra", extra).withColumn("taken", F.col("size") * (F.col("epochs") + F.col("extra").cast("long")))
    return placed.drop("n", "curve", "buckets", "rest", "bucket", "offset")


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of *docs*: id, ``size`` in words, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    Null and empty texts have size 0 and take nothing. A null source is a source of its own. Repeated rows are
    documents each and are taken together; equal keys are ordered by the row's name (id and source) and size, so reruns
    agree. Null ids stay.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = saved(docs.select(*_named(docs, id_col, text_col, source_col), F.col(id_col).alias("id")), "sizes")
    return taken_rows(rows, mix).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "source", "epochs")


def _named(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    text, source = F.col(text_col), F.col(source_col)
    name = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(source, F.lit("")))
    weight = F.coalesce(quality_weight(text, words_in(text)), F.lit(1.0))
    return [name.alias("name"), source.alias("source"), words_in(text).alias("size"), weight.alias("w")]


def mixture(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of *docs* that the mix takes, with ``copies`` and ``taken`` words after their columns; see ``mixed``.

    Where *docs* has a column of that name, the new one's name has underscores after it.
    """
    rows = saved(docs.select(*_named(docs, id_col, text_col, source_col)), "sizes")
    place = F.struct("key", "name", "size")
    cuts = taken_rows(rows, mix).groupBy("source").agg(F.first("epochs").alias("epochs"), F.max(F.when(F.col("extra"), place)).alias("cut"))
    mark = unused(docs, "_mix")
    cuts = saved(cuts.select(F.col("source").alias(f"{mark}s"), F.struct("epochs", "cut").alias(f"{mark}c")), "cuts")  # a row per source
    marked = docs.withColumn(mark, F.struct(*_named(docs, id_col, text_col, source_col)))
    met = marked.join(cuts, marked[source_col].eqNullSafe(cuts[f"{mark}s"]))
    m, c = F.col(mark), F.col(f"{mark}c")
    mine = F.struct(key(m["name"], m["w"], mix.seed).alias("key"), m["name"].alias("name"), m["size"].alias("size"))
    extra = F.coalesce((mine <= c["cut"]) & (m["size"] > 0), F.lit(False)).cast("long")
    copies = F.when(m["size"] > 0, c["epochs"] + extra).otherwise(0)
    met = met.withColumn(f"{mark}n", copies).where(F.col(f"{mark}n") > 0)
    return met.select(*docs.columns, F.col(f"{mark}n").alias(unused(docs, "copies")), (m["size"] * F.col(f"{mark}n")).alias(unused(docs, "taken")))
