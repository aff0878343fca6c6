import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from webwinnow.llm.chat_snapshots import Template, render_maximal
from webwinnow.llm.warc_revisits import Archive, deduplicate, read_archives, resolved, revisit_table, write_responses
from webwinnow.llm.weighted_mix import Mix, bucketed, mixed, mixture

DOCS = "doc_id bigint, text string, source string"


def shared(sizes, weights, share, most):
    """Targets by sharing the excess of full sources again until none is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if rate * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: rate * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("bucket_rows", [3, 10_000])
def test_mix(spark, bucket_rows):
    r = random.Random(4)
    rows = [(i, " ".join(["w"] * r.randrange(0, 40)), r.choice(["a", "b", "b", "b", "c", "d", None])) for i in range(400)]
    docs, mix = spark.createDataFrame(rows, DOCS), Mix(bucket_rows=bucket_rows)
    got = mixed(docs, mix).collect()
    sizes, taken, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for x in got:
        assert x.size == len(rows[x.doc_id][1].split()) and 0 <= x.taken <= 2 * x.size
        sizes[x.source] += x.size
        taken[x.source] += x.taken
        largest[x.source] = max(largest[x.source], x.size)
        target[x.source] = x.target
    want = shared(sizes, (3, 1, 2), 1.5, 2)
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in want)
    assert sorted(map(str, mixed(docs, Mix()).collect())) == sorted(map(str, got))
    chosen = {x.doc_id: x.taken for x in mixture(docs, mix).collect()}
    assert chosen == {x.doc_id: x.taken for x in got if x.taken}


def test_heavier_documents_come_first(spark):
    rows = [(i, ("w " if i % 2 else "w# ") * 10, "s") for i in range(600)]
    got = mixed(spark.createDataFrame(rows, DOCS), Mix(share=0.5)).collect()
    clean = sum(x.taken for x in got if x.doc_id % 2)
    assert clean > 0.58 * sum(x.taken for x in got)  # twice the weight


def test_key_buckets_are_even(spark):
    """Half of the source at weight 1, half at 0.02: keys of very different scales."""
    rows = spark.range(100_000).select(
        F.lit("s").alias("source"), F.col("id").cast("string").alias("name"), F.lit(1).cast("long").alias("size"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.02).alias("w"))
    mix = Mix(bucket_rows=2_000)
    keyed = bucketed(rows, mix)
    largest = keyed.groupBy("bucket").count().agg(F.max("count"), F.count("*")).first()
    assert largest[0] < 3 * mix.bucket_rows and largest[1] == 50


def test_mix_of_awkward_rows(spark, awkward, tmp_path):
    got = mixed(awkward).collect()
    assert len(got) == 12 and sum(x.size == 0 and x.taken == 0 for x in got) == 4
    chosen = mixture(awkward)
    assert chosen.columns == [*awkward.columns, "copies_", "taken_"]
    chosen.write.parquet(str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() == chosen.count() > 0
    assert mixed(awkward.where("false")).count() == 0 and mixture(awkward.where("false")).count() == 0


PAGES = "page_id bigint, url string, html string"


def expected(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        first = max(groups[html or ""]) if len(body) >= 1000 else page
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if first == page else "revisit", None if first == page else first))
    return sorted(out)


def test_revisits(spark):
    big, odd = "é" * 700, "WARC/1.1\r\nContent-Length: 7\r\n\r\n\x0b  end\r\n\r\n" * 60
    rows = [(i, f"http://x/{i}\r\nX: y", big if i % 3 == 0 else odd if i % 3 == 1 else f"small {i}") for i in range(50)] + [(60, None, None), (61, "u", ""), (62, "u", "s" * 999), (63, "u", "s" * 999)]
    got = revisit_table(spark.createDataFrame(rows, PAGES), Archive(records=7))
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_archives_round_trip_and_take_part_again(spark, tmp_path):
    rows = [(i, f"u{i}", "x" * 1500 + str(i % 2)) for i in range(10)]
    first = write_responses(spark.createDataFrame(rows, PAGES), str(tmp_path / "raw"))
    assert {r.payload for r in read_archives(spark, first, payloads=True).collect()} == {h for _, _, h in rows}
    once = deduplicate(spark, first, str(tmp_path / "once"))
    twice = deduplicate(spark, once, str(tmp_path / "twice"))
    assert sorted(map(tuple, resolved(spark, twice).collect())) == expected(rows)
    assert len({r.record_id for p in (first, once, twice) for r in read_archives(spark, p, payloads=False).collect()}) == 30


def test_awkward_pages(spark):
    pages = spark.createDataFrame([(1, "u", "p" * 2000), (1, "u", "p" * 2000), (None, None, "p" * 2000), (None, None, None)], PAGES)
    got = revisit_table(pages.withColumns({"digest": F.lit("x"), "record_id": F.lit("y"), "payload": F.lit("z")})).collect()
    assert sorted((r.record_type, r.page_id or 0, r.refers_to or 0) for r in got) == [("response", 0, 0), ("response", 1, 0), ("revisit", 0, 1), ("revisit", 1, 1)]
    assert revisit_table(pages.where("false")).count() == 0


TURNS = "conv_id bigint, turn bigint, role string, text string"


def maximal(rows):
    conversations = defaultdict(set)
    for conv, turn, role, text in rows:
        conversations[conv].add((turn, role, text))
    lists = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or "", t[2] is not None, t[2] or ""))] for c, v in conversations.items()}
    out = {}
    for c, mine in sorted(lists.items(), key=lambda x: (x[0] is None, x[0] or 0)):
        if mine in [lists[k] for k in out] or any(len(o) > len(mine) and o[: len(mine)] == mine for o in lists.values()):
            continue
        out[c] = mine
    return {c: (len(v), "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in v)) for c, v in out.items()}


@pytest.mark.parametrize("block", [2, 512])
def test_snapshots(spark, block):
    r = random.Random(6)
    rows = []
    for c in range(80):
        seed = random.Random(r.randrange(12))
        rows += [(c, t, ("user", "assistant")[t % 2], f"says {seed.randrange(3)}") for t in range(r.randrange(1, 9))]
    rows += [(None, 0, None, "x"), (None, None, "user", None), (90, 0, "user", None), (91, 0, "user", ""), (90, 0, "user", None), (92, 3, "a", "b"), (92, 3, "a", "c")]
    docs = spark.createDataFrame(rows, TURNS).withColumns({"conv": F.lit(1), "place": F.lit(2), "h1": F.lit(3)})
    got = {x.conv_id: (x.n_turns, x.text) for x in render_maximal(docs, Template(block=block)).collect()}
    assert got == maximal(rows)
    assert render_maximal(docs.where("false")).count() == 0
