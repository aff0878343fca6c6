"""Conversation structure repair by a square-root checkpointed dynamic program.

A conversation is to read as an optional system turn and then pairs of a user and an assistant turn. An automaton of
four states (nothing yet, after system, after user, after assistant) tells which role may follow; each row is kept, given
the other role or deleted, and empty turns may be inserted. The cost to go from a state before a row is the least cost of
repairing the rest. An edit is tight if it lies on a cheapest repair; walking forward and always taking the tight edit of
the least letter gives the least audit.

Rows are sorted by range (one shuffle of short rows without texts) and numbered, so a conversation of any length lies in
parts of neighbouring rows, each of about the square root of the longest conversation. Backward vectors are kept at the
ends of parts only: a part's least costs between states make a 4 x 4 matrix, and a conversation's matrices are chained
from its end. Then each part is walked on its own, from each state that it may be entered in, with vectors at every
square root of its rows and the blocks between them computed again. Chaining the exits tells where each part is entered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import isqrt
from operator import and_

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from webwinnow.llm.common import saved

DELETE, INSERT, REROLE, LATE = 4, 3, 3, 3
_FAR = 1 << 50
_NEXT = (2, 2, 3, 2)  # the state after the user or assistant turn that may follow
_ROLE = {2: "user", 3: "assistant"}
_END = (0, 6, 3, 0)  # inserts after the last row
_TAIL = ("", "II", "I", "")
_BITS = 12
_SPACE = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def back(code: str, v: Vector) -> Vector:
    """Costs to go before a row, inserts included, from those after it. *code*: letter of ``coded``."""
    initial, kind = divmod(ord(code) - 65, 4)
    c0, c1, c2, c3 = DELETE + v[0], DELETE + v[1], DELETE + v[2], DELETE + v[3]
    if kind < 2:
        late = LATE if kind else 0
        user = v[2] + late + (0 if initial == 1 else REROLE)
        c0, c1, c3 = min(c0, user, v[1] + late if initial == 0 else _FAR), min(c1, user), min(c3, user)
        c2 = min(c2, v[3] + late + (0 if initial == 2 else REROLE))
    after_user, after_assistant = min(c2, c3 + INSERT), min(c3, c2 + INSERT)
    return min(c0, after_user + INSERT), min(c1, after_user + INSERT), after_user, after_assistant


def transfer(codes: str) -> list[int]:
    """Least cost of a part from each state to each state, row by row."""
    columns = []
    for end in range(4):
        v = tuple(0 if q == end else _FAR for q in range(4))
        for code in reversed(codes):
            v = back(code, v)
        columns.append(v)
    return [columns[end][start] for start in range(4) for end in range(4)]


def walk(codes: str, end: Vector, states: list[int]) -> list[tuple[str, int]]:
    """Audit and exit for each entry state, given the costs to go after the part."""
    n, step = len(codes), isqrt(len(codes)) + 1
    marks, v = {n: end}, end
    for i in range(n - 1, -1, -1):
        v = back(codes[i], v)
        if i % step == 0:
            marks[i] = v
    runs = [[state, []] for state in states]
    for low in range(0, n, step):
        high = min(low + step, n)
        block = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            block.append(back(codes[i], block[-1]))
        for k in range(high - low):
            now, then, code = block[high - low - k], block[high - low - k - 1], codes[low + k]
            for run in runs:
                run[0] = _row(code, now, then, run[0], run[1])
    return [("".join(letters), state) for state, letters in runs]


def _row(code: str, now: Vector, then: Vector, state: int, letters: list[str]) -> int:
    """Adds the tight edits of a row, inserts before it included; the state after it."""
    initial, kind = divmod(ord(code) - 65, 4)
    while now[state] != DELETE + then[state]:
        follow = _NEXT[state]
        if now[state] == INSERT + now[follow]:
            letters.append("I")
            state = follow
            continue
        if state == 0 and initial == 0 and now[0] == then[1] + (LATE if kind else 0):
            follow = 1
        letters.append("K" if initial == follow - 1 else "R")  # system, user, assistant: 0, 1, 2
        return follow
    letters.append("D")
    return state


def replay(codes: str, audit: str, state: int) -> list[tuple[str, int, str | None]]:
    """``(edit, row in the part or -1, new role or null)`` of the turns that remain."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        follow = 1 if edit == "K" and ord(codes[at]) - 65 < 4 else _NEXT[state]
        state = follow
        out.append((edit, -1 if edit == "I" else at, None if edit == "K" else _ROLE[follow]))
        at += edit != "I"
    return out


def _chain(parts: list) -> dict:
    """Costs to go after each part, least cost, illegal neighbours and distinct turns of a conversation."""
    ends, v = [], _END
    for p in reversed(parts):
        ends.append(list(v))
        m = p["matrix"]
        v = tuple(min(m[4 * q + r] + v[r] for r in range(4)) for q in range(4))
    illegal, last, turns, latest = 0, None, 0, None
    for p in parts:
        illegal += p["illegal"] + (last is not None and last + p["first"] not in ("su", "ua", "au"))
        last = p["last"]
        if p["low"] is not None:
            turns += p["turns"] - (p["low"] == latest)
            latest = p["high"]
    return {"ends": ends[::-1], "cost": v[0], "illegal": illegal, "turns": turns}


def _enter(exits: list) -> dict:
    """The state in which each part is entered, and the last exit."""
    entries, state = [], 0
    for e in exits:
        entries.append(state)
        state = e[state]
    return {"entries": entries, "last": state}


def _transfer(codes: pd.Series) -> pd.Series:
    return codes.map(transfer)


def _chained(parts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_chain(list(p)) for p in parts], columns=["ends", "cost", "illegal", "turns"])


def _walked(codes: pd.Series, end: pd.Series, at: pd.Series) -> pd.Series:
    found = [walk(c, tuple(map(int, e)), [0] if k == 0 else [0, 1, 2, 3]) for c, e, k in zip(codes, end, at)]
    return pd.Series([[{"audit": a, "exit": x} for a, x in f] for f in found])


def _entered(exits: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_enter(e) for e in exits], columns=["entries", "last"])


def _replayed(codes: pd.Series, audit: pd.Series, state: pd.Series) -> pd.Series:
    return pd.Series([[{"edit": e, "at": i, "role": r} for e, i, r in replay(*x)] for x in zip(codes, audit, state)])


def _join(a: DataFrame, b: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Join on columns in which null equals null."""
    other = {c: f"_{c}" for c in columns}
    met = [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()]
    return a.join(b.withColumnsRenamed(other), reduce(and_, met), how).drop(*other.values())


def plain_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text``; a null role or text is one space."""
    blank = F.lit(" ")
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, blank).alias("role"), F.coalesce(text_col, blank).alias("text"))


def _named(turns: DataFrame) -> DataFrame:
    """Adds ``said``, a 128-bit name of role and text."""
    return turns.withColumn("said", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))))


def _coded(turns: DataFrame) -> tuple[DataFrame, int]:
    """Rows without texts in their order: ``conv, turn, said, place`` and the code letter; and the bits of a part.

    The letter tells the role's initial (s, u, a, other) and the first fault (none, truncated, blank, duplicate).
    """
    trimmed = F.rtrim("text", F.lit(_SPACE))
    first = F.left("role", F.lit(1))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = F.when(trimmed == "", 2).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    order = ["conv", "turn", "role", "said"]
    short = _named(turns).select(*order, initial.alias("initial"), fault.alias("fault"))
    ranged = short.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = saved(ranged.drop("role").withColumn("place", F.monotonically_increasing_id()), "numbered")
    longest = numbered.groupBy("conv").count().agg(F.max("count")).first()[0] or 1
    repeats = numbered.groupBy("conv", "said").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = _join(numbered, repeats, "conv", "said", how="left")
    fault = F.when((F.col("fault") != 2) & (F.col("place") > F.col("earliest")), 3).otherwise(F.col("fault"))
    coded = rows.select("conv", "turn", "said", "place", F.char(65 + 4 * F.col("initial") + fault).alias("code"))
    return coded, max(_BITS, -(-(longest - 1).bit_length() // 2))


def _parts(turns: DataFrame) -> DataFrame:
    """``conv, part``: code letters, names and turn numbers of the part's rows in order; its size is bounded."""
    coded, bits = _coded(turns)
    row = F.struct("place", "code", "said")
    grouped = coded.groupBy("conv", F.shiftright("place", bits).alias("part")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).alias("turns"),
    )
    codes = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    return saved(grouped.select("conv", "part", codes.alias("codes"), F.transform("rows", lambda r: r["said"]).alias("saids"), "low", "high", "turns"), "parts")


def planned(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``conv, turn, role, text``: the audit of each part with its entry state, and figures per conversation."""
    parts = _parts(turns)
    initials = F.translate("codes", "ABCDEFGHIJKLMNOP", "ssssuuuuaaaaoooo")
    # of two neighbours the first is looked at, the second looked ahead to
    illegal = F.regexp_count(initials, F.lit("(?=..)(?!su|ua|au).")).cast("long")
    counts = {name: F.sum(F.regexp_count("codes", F.lit(letters)).cast("long")).alias(name) for name, letters in (
        ("blank", "[CGKO]"), ("duplicate", "[DHLP]"), ("truncated", "[BFJN]"))}
    edge = parts.withColumns({"illegal": illegal, "first": F.left(initials, F.lit(1)), "last": F.right(initials, F.lit(1)), "matrix": F.pandas_udf(_transfer, "array<bigint>")("codes")})
    rows = F.array_sort(F.collect_list(F.struct("part", "matrix", "illegal", "first", "last", "low", "high", "turns")))
    gathered = edge.groupBy("conv").agg(
        rows.alias("parts"), *counts.values(), F.min("low").alias("low"), F.max("high").alias("high"))
    chained = saved(gathered.withColumn("chain", F.pandas_udf(_chained, "ends array<array<bigint>>, cost bigint, illegal bigint, turns bigint")("parts")).select(
        "conv", *counts, "low", "high", "chain", F.transform("parts", lambda p: p["part"]).alias("at")), "chains")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("chain.turns"), F.lit(0)).alias("gaps")
    figures = chained.select("conv", gaps, *counts, "chain.illegal", "chain.cost")
    ends = chained.select("conv", F.posexplode(F.arrays_zip("at", "chain.ends"))).select(
        "conv", F.col("col.at").alias("part"), F.col("col.ends").alias("end"), F.col("pos").alias("nth"), )
    walked = _join(parts.select("conv", "part", "codes", "saids"), ends, "conv", "part")
    walked = saved(walked.withColumn("walks", F.pandas_udf(_walked, "array<struct<audit:string,exit:int>>")("codes", "end", "nth")).drop("end"), "walks")
    exits = F.transform("walks", lambda w: w["exit"])
    order = F.array_sort(F.collect_list(F.struct("part", exits.alias("exits"))))
    entered = walked.groupBy("conv").agg(order.alias("p")).withColumn("e", F.pandas_udf(_entered, "entries array<int>, last int")(F.transform("p", lambda x: x["exits"])))
    size = F.size("p")
    entered = entered.select("conv", size.alias("n"), "e.last", F.posexplode(F.arrays_zip(F.transform("p", lambda x: x["part"]).alias("part"), F.col("e.entries").alias("state"))))
    tail = F.when(F.col("pos") == F.col("n") - 1, F.element_at(F.array(*map(F.lit, _TAIL)), F.col("last") + 1)).otherwise("")
    entered = entered.select("conv", "col.part", "col.state", tail.alias("tail"))
    chosen = _join(walked, entered, "conv", "part")
    audit = F.concat(F.get(F.col("walks"), F.when(F.size("walks") == 1, 0).otherwise(F.col("state")))["audit"], F.col("tail"))
    return chosen.select("conv", "part", "codes", "saids", "state", audit.alias("audit")), figures


def _attached(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv, part, pos, edit, role, text`` of the repaired turns; a conversation's rows lie in one partition.

    Texts move once: they meet the edits under the conversation, where equal rows, of which one remains, are one group.
    """
    steps = audits.select("conv", "part", "saids", F.posexplode(F.pandas_udf(_replayed, "array<struct<edit:string,at:int,role:string>>")("codes", "audit", "state")))
    own = F.unhex(F.md5(F.concat_ws(":", F.lit("insert"), F.col("part").cast("string"), F.col("pos").cast("string"))))
    said = F.when(F.col("col.at") >= 0, F.get(F.col("saids"), F.col("col.at"))).otherwise(own)
    edits = steps.select("conv", said.alias("said"), F.struct("part", "pos", F.col("col.edit").alias("edit"), F.col("col.role").alias("role")).alias("step"))
    rows = _named(turns).select("conv", "said", F.struct("role", "text").alias("row"))
    met = rows.unionByName(edits, allowMissingColumns=True).repartition("conv").groupBy("conv", "said")
    met = met.agg(F.first("row", True).alias("row"), F.first("step", True).alias("step")).where("step is not null")
    role, text = F.coalesce("step.role", "row.role"), F.coalesce("row.text", F.lit(""))
    return met.select("conv", "step.part", "step.pos", "step.edit", role.alias("role"), text.alias("text"))


def repaired(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The turns of the repaired conversations: id, ``part`` and ``pos`` (their order), ``edit`` (K, R or I), role, text.

    Rows are ordered by turn number (null first), then role and a hash of the text. A null role or text is one space; a
    null id is a conversation of its own. Blank rows and repetitions of an earlier role and text are deleted. Other
    columns are ignored; an empty table gives an empty result.
    """
    plain = plain_turns(turns, conv_col, turn_col, role_col, text_col)
    audits, _ = planned(plain)
    return _attached(plain, audits).withColumnRenamed("conv", conv_col)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each run of equal ids; holds one state, whatever a conversation's length."""
    run, state, done = None, None, ([], [])
    for batch in batches:
        ids = batch.column(0)
        for k, (conv, line) in enumerate(zip(ids.to_pylist(), batch.column(1).to_pylist())):
            if state is None or conv != run:
                if state is not None:
                    done[0].append(run), done[1].append(state.hexdigest())
                run, state = conv, hashlib.sha256(line.encode())
            else:
                state.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array(done[0], ids.type), pa.array(done[1], pa.string())], ["conv", "sha"])
        done = ([], [])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([run], ids.type), pa.array([state.hexdigest()])], ["conv", "sha"])


def repair_digest(
    turns: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Per conversation of *every* (default: *turns*): gaps, faults, cost, audit and the hash of the repaired turns.

    See ``repaired`` for the edge cases; a conversation without rows has zeros, an empty audit and the hash of nothing.
    """
    plain = plain_turns(turns, conv_col, turn_col, role_col, text_col)
    audits, figures = planned(plain)
    audits = saved(audits, "audits")
    kind = dict(plain.dtypes)["conv"]
    lines = _attached(plain, audits).select("conv", F.concat("role", F.lit(":"), "text").alias("line"), "part", "pos")
    hashes = lines.sortWithinPartitions("conv", "part", "pos").select("conv", "line").mapInArrow(_hashed, f"conv {kind}, sha string")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "")
    told = audits.groupBy("conv").agg(whole.alias("audit"))
    convs = (turns if every is None else every).select(F.col(conv_col).alias("conv")).distinct()
    result = _join(_join(_join(convs, figures, "conv", how="left"), told, "conv", how="left"), hashes, "conv", how="left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return result.select(
        F.col("conv").alias(conv_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults that a hash of id and turn deals out; a null is one space."""
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    fault, text = F.col("fault"), F.coalesce("text", blank)
    rows = turns.select("conv_id", "turn", "role", "text", (F.crc32(name) % 20).alias("fault")).where("fault != 0")
    told = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce("role", blank))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), told.alias("text"), copies.alias("copy")).drop("copy")
