"""Chat formatting with cumulative-snapshot collapse.

Chats are often logged after every turn, so a conversation may be a prefix of a longer one. A turn's hash names its
role, text and place; the hash of a prefix is the running XOR of its turns' hashes (128 bits in two halves), so it is
the same for all conversations that begin alike. A conversation whose whole hash is a proper prefix of another one goes
(anti-join), and of equal conversations the smallest id stays; what is left is rendered.

Running values are computed within blocks of turns first and block values are carried over, so a conversation of any
length is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from webwinnow.llm.common import saved


@dataclass(frozen=True)
class Template:
    """Text around each turn; ``block`` consecutive turn numbers are worked off together."""

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    block: int = 512


def _half(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def prefixes(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv, turn, role, text`` -> also place, running hash (``h1, h2``), and per conversation its length and hash."""
    block = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / template.block)
    rows = turns.withColumn("block", block)
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    inside = W.partitionBy("conv", "block").orderBy(*order)
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("conv").orderBy("block")) - F.col("n")
    starts = sizes.select(F.col("conv").alias("c"), F.col("block").alias("b"), before.alias("start"))
    same = lambda a, b: (a["conv"].eqNullSafe(b["c"])) & (a["block"] == b["b"])
    placed = rows.withColumn("in_block", F.row_number().over(inside))
    placed = placed.join(starts, same(placed, starts)).drop("c", "b").withColumn("place", F.col("start") + F.col("in_block"))
    said = [F.col("place"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")), F.col("role").isNull(), F.col("text").isNull()]
    hashed = placed.withColumns({"t1": _half(11, *said), "t2": _half(29, *said)})
    hashed = saved(hashed.drop("start", "in_block"), "turns")
    whole = hashed.groupBy("conv", "block").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = whole.select(F.col("conv").alias("c"), F.col("block").alias("b"), *[F.coalesce(F.bit_xor(f"x{k}").over(earlier), F.lit(0)).alias(f"c{k}") for k in (1, 2)])
    running = W.partitionBy("conv", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    chained = hashed.join(carried, same(hashed, carried)).drop("c", "b")
    return chained.withColumns({f"h{k}": F.col(f"c{k}").bitwiseXOR(F.bit_xor(f"t{k}").over(running)) for k in (1, 2)})


def maximal_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns, with ``place``, of conversations that are no prefix and no repetition of another one."""
    chained = prefixes(turns, template)
    ends = saved(
        chained.groupBy("conv").agg(F.max(F.struct("place", "h1", "h2")).alias("end")).select("conv", "end.*"), "ends")
    # of equal conversations the smallest id stays (null last)
    kept = ends.groupBy("place", "h1", "h2").agg(F.min("conv").alias("conv"))
    longer = chained.join(ends.select(F.col("conv").alias("c"), F.col("place").alias("n")), chained["conv"].eqNullSafe(F.col("c")))
    inner = longer.where("place < n").select("place", "h1", "h2").distinct()
    kept = saved(kept.join(inner, ["place", "h1", "h2"], "left_anti").select(F.col("conv").alias("c")), "maximal")
    return chained.join(kept, chained["conv"].eqNullSafe(kept["c"]), "left_semi").select("conv", "place", "role", "text")


def rendered_turn(role: Column, text: Column, template: Template) -> Column:
    blank = F.lit("")
    return F.concat(F.lit(template.before), F.coalesce(role, blank), F.lit(template.between), F.coalesce(text, blank), F.lit(template.after))


def render_maximal(
    turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per maximal conversation: id, ``n_turns`` and the rendered ``text``.

    Turns are ordered by number (null first), role and text; rows that repeat all four are one turn. A null id is a
    conversation of its own; null roles and texts render as empty but differ from empty ones. Extra columns are ignored;
    an empty table gives an empty result. A rendered conversation is one value, so it is gathered in one row.
    """
    plain = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).distinct()
    said = F.struct("place", rendered_turn(F.col("role"), F.col("text"), template).alias("said"))
    gathered = maximal_turns(plain, template).groupBy("conv").agg(F.array_sort(F.collect_list(said)).alias("t"))
    return gathered.select(F.col("conv").alias(conv_col), F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["said"]), "").alias("text"))
