import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from webwinnow.llm import prefix_trie as module
from webwinnow.llm.prefix_trie import Parentheses, prefix_trie, shard_sums

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def conversations(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        if c is None:
            out[c] = turns
            continue
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def expected(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    smallest = {path: min((c for c in m if c is not None), default=None) for path, m in members.items()}
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, m in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(m) - 1) * (len(path[-1][1].split()) if path else 0)
    rows = []
    for path, m in members.items():
        ends = sorted((c for c in m if len(convs[c]) == len(path)), key=lambda c: (c is None, c or 0))
        told = ",".join("" if c is None else str(c) for c in ends)
        parent = smallest[path[:-1]] if path else None
        rows.append((smallest[path], len(path), parent, len(m), children[path], leaves[path], saved[path], hashlib.sha256(told.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_turns(r, convs, spread):
    rows = []
    for c in convs:
        n = r.choice([1, 1, 2, 3, 5, 8])
        rows += [(c, t, r.choice(["user", "assistant"]), r.choice(["a b", "c", "d e f"][:spread])) for t in r.sample(range(50), n)]
    return rows


@pytest.mark.parametrize("bits,spread", [(1, 2), (12, 3)])
def test_trie_against_brute_force(spark, monkeypatch, bits, spread):
    monkeypatch.setattr(module, "_BITS", bits)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one shard holds all
    try:
        r = random.Random(bits)
        rows = random_turns(r, [*range(120), None], spread)
        deep = [(c, t, "user", f"turn {t}") for c in (200, 201, 202) for t in range(40 + c % 3)]
        turns = spark.createDataFrame(rows + deep + [(300 + c, 0, "user", "same words") for c in range(60)], SCHEMA).repartition(4)
        plain = conversations(turns.collect())
        assert found(prefix_trie(turns)) == expected(plain)
        assert found(prefix_trie(turns, shared_leads=True)) == expected(rebuilt(plain))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_awkward_conversations(spark):
    rows = [(1, None, None, None), (1, 4, "user", "x " * 200_000), (2, None, "", ""), (2, 4, "user", "x " * 200_000), (None, 1, "user", None),
            (21, 0, "user", "a"), (21, 0, "user", "a"), (22, 0, "user", "a"), (45, 0, "user", "only"), (-3, 0, "user", "a")]
    clashes = ["conv", "depth", "n", "h1", "path", "block", "ends", "words", "value"]
    turns = spark.createDataFrame([(*x, *clashes) for x in rows], SCHEMA + "".join(f", {c} string" for c in clashes))
    assert found(prefix_trie(turns)) == expected(conversations(rows))
    positive = [x for x in rows if x[0] != -3]
    assert found(prefix_trie(turns.where("conv_id > 0 or conv_id is null"), shared_leads=True)) == expected(rebuilt(conversations(positive)))
    assert prefix_trie(turns.where("false")).count() == 0 and prefix_trie(turns.where("false"), shared_leads=True).count() == 0


def test_findclose():
    r = random.Random(2)
    for size in (1, 5, 70, 5000, 20_000):
        steps, depth = [], 0
        while len(steps) < 2 * size:
            left = 2 * size - len(steps)
            up = depth == 0 or depth < left and r.random() < 0.55
            steps.append(1 if up else -1)
            depth += steps[-1]
        stack, want = [], {}
        for at, s in enumerate(steps):
            if s > 0:
                stack.append(at)
            else:
                want[stack.pop()] = at
        tree = Parentheses(np.array(steps, np.int8))
        assert all(tree.findclose(a) == b for a, b in want.items())


def test_spines_of_two_shards_add_up():
    one, two = [((0,), (0,), False), ((0, 1), (0, 5), False)], [((0, 1, 2), (0, 0, 7), True), ((0, 3), (0, 4), True)]
    total = defaultdict(lambda: np.zeros(2, int))
    for part in (one, two):
        for name, *sums in zip(*shard_sums(iter(part))):
            total[name] += sums
    assert {k: tuple(v) for k, v in total.items()} == {0: (2, 16), 1: (1, 12), 2: (1, 7), 3: (1, 4)}
