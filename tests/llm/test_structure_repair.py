import hashlib
import random

import pytest

from webwinnow.llm import structure_repair
from webwinnow.llm.structure_repair import _END, _TAIL, back, damaged, repair_digest, repaired, replay, transfer, walk

SPACE = " \t\n\x0b\x0c\r"
FOLLOW = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ROLE = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, turns) of ``(role, text, fault)`` rows, by keeping the least cost and audit of each state."""
    def inserted(best):
        for _ in range(4):
            for q, (cost, audit, out) in list(best.items()):
                for c, r in FOLLOW[q].items():
                    if c != "s":
                        best[r] = min(best.get(r, (1 << 60, "", ())), (cost + 3, audit + "I", (*out, (ROLE[c], ""))))
        return best

    best = {0: (0, "", ())}
    for role, text, fault in rows:
        new = {}
        for q, (cost, audit, out) in inserted(best).items():
            found = [(q, (cost + 4, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                for c, r in FOLLOW[q].items():
                    if role[:1] == c:
                        found.append((r, (cost + late, audit + "K", (*out, (role, text)))))
                    if c != "s":
                        found.append((r, (cost + late + 3, audit + "R", (*out, (ROLE[c], text)))))
            for r, x in found:
                new[r] = min(new.get(r, (1 << 60, "", ())), x)
        best = new
    best = inserted(best)
    return min(best[q] for q in (0, 3) if q in best)


def expected(rows):
    """Digest columns per conversation of ``(conv, turn, role, text)``; rows of one turn in the given order."""
    convs, out = {}, {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        seen, told = set(), []
        for _, role, text in turns:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            told.append((role, text, fault))
        cost, audit, kept = cheapest(told)
        numbers = [t[0] for t in turns if t[0] is not None]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(told, told[1:])]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(f == kind for *_, f in told) for kind in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def rows_of(r, convs, longest):
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None], ["Yes.", "No!", "why?", "cut off", "", "  \n", None, "A b. "]
    return [(c, t, r.choice(roles), r.choice(texts) if r.random() < 0.6 else f"text {r.random()}.")
            for c in convs for t in sorted(r.sample(range(3 * longest), r.randrange(1, longest)))]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_repair_against_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(structure_repair, "_BITS", bits)
    r = random.Random(bits)
    rows = rows_of(r, [*range(40), None], 12) + rows_of(r, [100], 200)
    got = {x[0]: tuple(x[1:]) for x in repair_digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == expected(rows)


def test_matrices_and_checkpoints():
    r = random.Random(8)
    for _ in range(200):
        codes = "".join(chr(65 + r.randrange(16)) for _ in range(r.randrange(1, 40)))
        v = _END
        for code in reversed(codes):
            v = back(code, v)
        m = transfer(codes)
        assert v == tuple(min(m[4 * q + e] + _END[e] for e in range(4)) for q in range(4))
        for state, (audit, end) in enumerate(walk(codes, _END, [0, 1, 2, 3])):
            assert len(audit.replace("I", "")) == len(codes)
            steps = replay(codes, audit + _TAIL[end], state)
            price = {"I": 3, "R": 3, "K": 0}
            late = sum(3 for _, at, _ in steps if at >= 0 and (ord(codes[at]) - 65) % 4 == 1)
            assert v[state] == 4 * audit.count("D") + sum(price[e] for e, _, _ in steps) + late


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "And?"), (1, 3, "user", "And?"), (2, 0, "tool", "")]
    got = repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "part", "pos").collect()
    assert [(x.conv_id, x.edit, x.role, x.text) for x in got] == [
        (1, "K", "system", "Be kind."), (1, "I", "user", ""), (1, "K", "assistant", "Hello."), (1, "K", "user", "And?"), (1, "I", "assistant", "")]


def test_awkward_turns(spark):
    rows = [(1, None, None, None), (1, 5, "user", None), (None, None, "user", "Hi."), (None, None, "user", "Hi."), (3, 1, "user", "x" * 300_000),
            (3, 1, "user", "x" * 300_000), (4, 2, "ünï", "é"), (5, -3, "assistant", "ok."), (5, 7, "assistant", "ok.")]
    clashes = ["part", "place", "said", "row", "step", "codes", "conv", "n", "state", "audit"]
    turns = spark.createDataFrame([(*x, *clashes) for x in rows], SCHEMA + "".join(f", {c} string" for c in clashes))
    assert {x[0]: tuple(x[1:]) for x in repair_digest(turns).collect()} == expected(rows)
    assert repair_digest(turns.where("false")).count() == 0 and repaired(turns.where("false")).count() == 0
    nothing = repair_digest(turns.where("conv_id = 4"), turns).where("conv_id = 5").first()
    assert tuple(nothing) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert damaged(turns).columns == ["conv_id", "turn", "role", "text"]
