"""Prefix trie of conversations in balanced parentheses, built in shards.

A node is a distinct sequence of first turns, named by a running hash of its turns. Node counts, children and ends are
grouped sums over the prefixes. Only nodes where conversations part or end matter for sums over subtrees; the chain of
nodes above such a node has its members, so every chain is one edge of the compressed trie.

The paths of the compressed trie, one for each node at which a conversation ends, are sorted and split by range into
shards. A shard writes its part as balanced parentheses in one pass over its paths. Excess minima over blocks (and
blocks of blocks) find the parenthesis that closes a subtree; a rank over the pairs that are leaves counts the leaves
below, and cumulative values of the edges give the savings. An edge's value comes with one path only, that of its smallest
member, so the nodes of the spines that neighbouring shards share are merged by adding what the shards found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from webwinnow.llm.common import WORD, saved

_BITS = 12  # a conversation is numbered in blocks of this many bits
_FAN = 64
_NODE = ["h1", "h2"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A sequence of +1 (open) and -1 (close) with block minima of the excess."""

    def __init__(self, steps: np.ndarray):
        self.steps, self.excess = steps, np.cumsum(steps, dtype=np.int64)
        self.levels = [self.excess]
        while len(self.levels[-1]) > _FAN:
            low = self.levels[-1]
            padded = np.concatenate([low, np.full(-len(low) % _FAN, np.iinfo(np.int64).max)])
            self.levels.append(padded.reshape(-1, _FAN).min(axis=1))

    def findclose(self, at: int) -> int:
        """Where the parenthesis opened at *at* is closed: the first later place of less excess."""
        below, place = self.excess[at] - 1, at + 1
        for depth in range(len(self.levels)):  # up, while the rest of the block stays above
            block = self.levels[depth][place : (place // _FAN + 1) * _FAN]
            found = np.flatnonzero(block <= below)
            if len(found):
                place += int(found[0])
                break
            place = place // _FAN + 1
        for level in reversed(self.levels[:depth]):  # down to the first place
            place *= _FAN
            place += int(np.flatnonzero(level[place : place + _FAN] <= below)[0])
        return place


def shard_sums(paths: Iterator[tuple[np.ndarray, np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, leaves and savings of the nodes of sorted ``(names, values, ends in a leaf)`` paths, subtree by subtree."""
    steps, names, values, leaf, stack = bytearray(), [], [], [], []
    opened = []
    for path, worth, at_leaf in paths:
        same = 0
        while same < len(stack) and same < len(path) and names[stack[same]] == path[same]:
            same += 1
        steps += b"\xff" * (len(stack) - same)
        del stack[same:]
        for name in path[same:]:
            stack.append(len(names))
            opened.append(len(steps))
            steps.append(1)
            names.append(name)
            values.append(0)
            leaf.append(False)
        leaf[stack[-1]] = at_leaf
        for node, value in zip(stack, worth):
            values[node] += value
    steps += b"\xff" * len(stack)
    bits = np.frombuffer(bytes(steps), np.int8)
    opened, values = np.array(opened, np.int64), np.array(values, np.int64)
    pairs = np.zeros(len(bits) + 1, np.int64)
    pairs[opened + 1] = np.array(leaf, np.int64)  # "()" whose node has no children in any shard
    pairs[opened + 1] &= bits[opened + 1] == -1
    worth = np.zeros(len(bits) + 1, np.int64)
    worth[opened + 1] = values
    rank, total = np.cumsum(pairs), np.cumsum(worth)
    tree = Parentheses(bits)
    closed = np.array([tree.findclose(at) for at in opened.tolist()], np.int64)
    return np.array(names, object), rank[closed] - rank[opened], total[closed] - total[opened]


def _said(text: Column, role: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, block, depth, said, words``: turns in their order from 1, named by a hash, and the words of their text."""
    blank = F.lit("")
    role, text = F.coalesce(role_col, blank), F.coalesce(text_col, blank)
    order = ["conv", "turn", "role", "said"]
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), _said(text, role).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "said", "words", F.monotonically_increasing_id().alias("place"))
    placed = saved(ranged.withColumn("block", F.shiftright("place", _BITS)), "turns")
    starts = _starts(placed.groupBy("conv", "block").agg(F.count("*").alias("n")), {"start": F.sum("n")})
    within = F.row_number().over(W.partitionBy("conv", "block").orderBy("place"))
    return _met(placed.withColumn("within", within), starts).select("conv", "block", (F.col("start") + F.col("within")).alias("depth"), "said", "words")


def _starts(blocks: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Totals of a conversation's earlier blocks."""
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return blocks.select("conv", "block", *[F.coalesce(c.over(earlier), F.lit(0)).alias(name) for name, c in totals.items()])


def _met(rows: DataFrame, blocks: DataFrame, how: str = "inner") -> DataFrame:
    """*rows* with what belongs to their conversation and block."""
    other = blocks.withColumnsRenamed({"conv": "_c", "block": "_b"})
    return rows.join(other, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")), how).drop("_c", "_b")


def rebuilt(rows: DataFrame, every: int = 20, leads: int = 4) -> DataFrame:
    """Numbered turns whose first ``h`` are those of the conversation ``c - c % every``; h is ``crc32(c) % leads``.

    A null id keeps its own turns. A leading conversation gives at most ``leads - 1`` turns to ``every`` others.
    """
    h = F.coalesce(F.crc32(F.col("conv").cast("string")) % leads, F.lit(0))
    base = F.col("conv") - F.col("conv") % every
    convs = rows.groupBy("conv").agg(F.lit(0).alias("any")).select("conv", h.alias("h"), base.alias("base"))
    firsts = rows.where((F.col("conv") % every == 0) & (F.col("depth") < leads)).select(F.col("conv").alias("base"), "depth", "said", "words")
    given = saved(convs.join(firsts, "base").where("depth <= h").select("conv", "depth", "said", "words"), "leads")
    blocks = rows.groupBy("conv", "block").agg(F.lit(0).alias("any"))
    n = given.groupBy(F.col("conv").alias("_g")).agg(F.count("*").alias("given"))
    shifts = blocks.join(n, F.col("conv") == F.col("_g"), "left").select("conv", "block", h.alias("h"), F.coalesce("given", F.lit(0)).alias("given"))
    own = _met(rows, shifts).where("depth > h").select("conv", (F.col("depth") - F.col("h") + F.col("given")).alias("depth"), "said", "words")
    return own.unionByName(given)


def _prefixes(rows: DataFrame) -> DataFrame:
    """Per conversation and depth: the node's and its parent's name, words of the last turn and of all, whether it ends."""
    block = F.shiftright(F.col("depth") - 1, _BITS)
    turn = {f"t{k}": F.xxhash64(F.lit(seed), "depth", "said") for k, seed in ((1, 11), (2, 29))}
    rows = rows.withColumn("block", block).withColumns(turn).drop("said")
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"), F.sum("words").alias("w"))
    carried = _starts(blocks, {"c1": F.bit_xor("x1"), "c2": F.bit_xor("x2"), "cw": F.sum("w")})
    whole = W.partitionBy("conv")
    carried = carried.withColumn("later", F.col("block") < F.max("block").over(whole))
    order = W.partitionBy("conv", "block").orderBy("depth")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    running = rows.withColumns({
        "r1": F.bit_xor("t1").over(so_far), "r2": F.bit_xor("t2").over(so_far), "rw": F.sum("words").over(so_far),
        "more": F.lead("depth").over(order).isNotNull()})
    h1, h2 = F.col("c1").bitwiseXOR(F.col("r1")), F.col("c2").bitwiseXOR(F.col("r2"))
    return saved(_met(running, carried).select(
        "conv", "depth", h1.alias("h1"), h2.alias("h2"), h1.bitwiseXOR(F.col("t1")).alias("p1"), h2.bitwiseXOR(F.col("t2")).alias("p2"),
        "words", (F.col("cw") + F.col("rw")).alias("through"), (~F.col("more") & ~F.col("later")).alias("ends")), "prefixes")


def _nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, the root included: smallest member, counts, children, parent's smallest member."""
    ending = F.when(F.col("ends"), F.col("conv"))
    nodes = prefixes.groupBy(*_NODE).agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.count("*").alias("n"), F.max("words").alias("words"),
        F.max("through").alias("through"), F.sum(F.col("ends").cast("long")).alias("ends"), F.min(ending).alias("ender"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    silent = F.col("n") - F.col("told")
    whole = convs.agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.sum(F.col("told").cast("long")).alias("told"), F.min(F.when(~F.col("told"), F.col("conv"))).alias("ender"))
    zero = F.lit(0).cast("long")
    root = whole.where("n > 0").select(
        zero.alias("h1"), zero.alias("h2"), "conv", zero.alias("depth"), "n", zero.alias("words"), zero.alias("through"),
        silent.alias("ends"), "ender", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = saved(nodes.unionByName(root), "nodes")
    children = nodes.where("p1 is not null").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("n_children"))
    return nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))


def _with_lower(nodes: DataFrame) -> DataFrame:
    """Adds the lower end (``u1, u2, below``) of each node's edge: the next node of its smallest member that matters."""
    matters = (F.col("n_children") != 1) | (F.col("ends") > 0) | (F.col("depth") == 0)
    rows = nodes.withColumns({"matters": matters, "block": F.shiftright("depth", _BITS)})
    end = F.when(F.col("matters"), F.struct(F.col("h1").alias("u1"), F.col("h2").alias("u2"), F.col("through").alias("below")))
    on = W.partitionBy("conv", "block").orderBy("depth").rowsBetween(0, W.unboundedFollowing)
    firsts = rows.groupBy("conv", "block").agg(F.min(F.when(F.col("matters"), F.struct("depth", end.alias("end")))).alias("first"))
    after = W.partitionBy("conv").orderBy("block").rowsBetween(1, W.unboundedFollowing)
    later = firsts.select("conv", "block", F.first("first", True).over(after)["end"].alias("later"))
    found = _met(rows.withColumn("here", F.first(end, True).over(on)), later).withColumn("end", F.coalesce("here", "later"))
    return found.select(*nodes.columns, "matters", "end.*")


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of a shard's nodes; the shard is a range of the sorted paths."""
    def paths():
        for batch in batches:
            lists = batch.column(0)
            flat, at = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(False))])
            names = list(zip(flat.field("h1").to_pylist(), flat.field("h2").to_pylist()))
            worth = flat.field("value").to_pylist()
            for k, leaf in enumerate(batch.column(1).to_pylist()):
                yield names[at[k] : at[k + 1]], worth[at[k] : at[k + 1]], leaf

    names, leaves, sums = shard_sums(paths())
    if len(names):
        h1, h2 = zip(*names)
        yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(leaves), pa.array(sums)], [*_NODE, "leaves", "value"])


def _subtrees(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``h1, h2, leaves, value`` of the nodes that matter: leaves and savings of their edges and all edges below."""
    edges = nodes.groupBy(F.col("u1").alias("h1"), F.col("u2").alias("h2")).agg((F.sum("words") * (F.max("n") - 1)).alias("edge"))
    critical = saved(nodes.where("matters").select(*_NODE, F.col("conv").alias("owner"), "n_children", "ender", "ends").join(edges, _NODE), "critical")
    own = F.when(F.col("owner").eqNullSafe(F.col("conv")), F.col("edge")).otherwise(0)
    step = F.struct("depth", *_NODE, own.alias("value"), (F.col("n_children") == 0).alias("leaf"))
    met = prefixes.select("conv", "depth", *_NODE).join(critical.drop("ender", "ends"), _NODE)
    paths = met.groupBy("conv").agg(F.array_sort(F.collect_list(step)).alias("path"))
    ends = critical.where("ends > 0").select("ender", ((F.col("h1") == 0) & (F.col("h2") == 0) & (F.col("n_children") == 0)).alias("bare"))
    reps = ends.join(paths, F.col("ender").eqNullSafe(F.col("conv")), "left")
    zero = F.lit(0).cast("long")
    top = F.array(F.struct(F.lit(0).cast("long").alias("h1"), zero.alias("h2"), zero.alias("value")))
    below = F.coalesce(F.transform("path", lambda s: F.struct(s["h1"], s["h2"], s["value"])), F.array().cast("array<struct<h1:bigint,h2:bigint,value:bigint>>"))
    leaf = F.coalesce(F.element_at("path", -1)["leaf"], F.col("bare"))
    reps = saved(reps.select(F.concat(top, below).alias("path"), leaf.alias("leaf")), "paths")
    keyed = reps.withColumn("order", F.transform("path", lambda s: F.struct(s["h1"], s["h2"])))
    shards = keyed.repartitionByRange("order").sortWithinPartitions("order").select("path", "leaf")
    parts = shards.mapInArrow(_shard, "h1 long, h2 long, leaves long, value long")
    return parts.groupBy(*_NODE).agg(F.sum("leaves").alias("leaves"), F.sum("value").alias("value")).join(edges, _NODE, "left")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each run of equal nodes; holds one state, whatever a node's ends."""
    run, state, done = None, None, []
    for batch in batches:
        for h1, h2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            name = b"" if conv is None else str(conv).encode()
            if (h1, h2) == run:
                state.update(b"," + name)
                continue
            if run is not None:
                done.append((*run, state.hexdigest()))
            run, state = (h1, h2), hashlib.sha256(name)
        if len(done) > 1000:
            yield _rows(done)
            done = []
    yield _rows([*done, (*run, state.hexdigest())] if run is not None else [])


def _rows(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], [*_NODE, "sha"])


def trie(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Node table of numbered turns ``conv, depth, said, words``; *every* has all ids as ``conv``, turnless ones too.

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (of the subtree) and ``ends_sha256``. A null id is a conversation of its own, last in order, with an
    empty name. No conversation, no root.
    """
    prefixes = _prefixes(rows)
    lasts = prefixes.where("ends").select("conv", *_NODE)
    told = lasts.select(F.col("conv").alias("_t"), F.lit(True).alias("told"))
    convs = every.select("conv").distinct().join(told, F.col("conv").eqNullSafe(F.col("_t")), "left")
    convs = saved(convs.select("conv", F.coalesce("told", F.lit(False)).alias("told")), "convs")
    nodes = saved(_with_lower(_nodes(prefixes, convs)), "edges")

    zero = F.lit(0).cast("long")
    members = lasts.unionByName(convs.where("not told").select("conv", zero.alias("h1"), zero.alias("h2")))
    shared = members.join(nodes.where("ends > 1").select(*_NODE), _NODE, "left_semi")
    order = [*_NODE, F.col("conv").asc_nulls_last()]
    hashes = shared.repartition(*_NODE).sortWithinPartitions(*order).select(*_NODE, "conv").mapInArrow(_ends, "h1 long, h2 long, sha string")

    # a node of one member needs no sums: one leaf, nothing saved
    chain = (F.col("n") - 1) * (F.col("below") - F.col("through") + F.col("words"))
    sums = _subtrees(prefixes, nodes).withColumnsRenamed({"h1": "u1", "h2": "u2"})
    many = nodes.where("n > 1").join(sums, ["u1", "u2"]).withColumn("saved", F.col("value") - F.col("edge") + chain).drop("value", "edge")
    lone = nodes.where("n = 1").withColumns({"leaves": F.lit(1).cast("long"), "saved": zero})
    found = many.unionByName(lone).join(hashes, _NODE, "left")
    first = convs.agg(F.min("conv")).first()[0]
    parents = nodes.where("n_children > 0").select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv").alias("parent"))
    deep = found.where("depth > 1").join(parents, ["p1", "p2"], "left")
    top = found.where("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(first)).cast(dict(nodes.dtypes)["conv"]))
    alone = F.sha2(F.coalesce(F.col("ender").cast("string"), F.lit("")), 256)
    ends = F.when(F.col("ends") == 0, _NO_ENDS).when(F.col("ends") == 1, alone).otherwise(F.col("sha"))
    return deep.unionByName(top).select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), ends.alias("ends_sha256"))


def prefix_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    shared_leads: bool = False,
) -> DataFrame:
    """Prefix trie of the conversations of *turns*, see ``trie``; with *shared_leads*, after ``rebuilt``.

    Turns are ordered by number (null first), then role and a hash of role and text; repeated rows are turns each. A null
    role or text is empty. Other columns are ignored; an empty table gives an empty result.
    """
    rows = numbered(turns, conv_col, turn_col, role_col, text_col)
    if shared_leads:
        rows = rebuilt(saved(rows, "numbered"))
    return trie(rows, turns.select(F.col(conv_col).alias("conv")))
