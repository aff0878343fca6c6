"""Operator queries against their SQL, and the pipeline stage by stage against brute force."""

import re
from collections import defaultdict

import pytest
from check_oracles import compare, connect
from test_jaccard_join import brute
from test_text_operators import base_spans, counts, plain

import __spark_entry__ as entry
import corpus_pipeline
from webwinnow.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, con, name):
    message, same = compare(spark, con, name, SF_DIR)
    assert same, message


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        out[name] = {r.doc_id: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    quality, copies, clean, secret, mixed = (out[name] for name, _ in corpus_pipeline.STAGES)

    def passes(text):
        n, _, marks, _, repeats = counts(text)
        return n >= 50 and 100 * repeats <= 50 * n

    assert set(quality) <= {d for d, r in before.items() if passes(r.text)}
    assert not any(counts(r.text)[2] > 0.1 * counts(r.text)[0] for r in quality.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [d for d, y in labels.items() if y == 1 and d in before and passes(before[d].text)]
    assert sum(d in quality for d in good) >= 0.98 * len(good)

    groups = brute([(d, r.text) for d, r in quality.items()], 5, 8)
    assert set(copies) == {d for d, (_, least) in groups.items() if d == least}

    items = [plain(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert set(clean) == {d for d, r in copies.items() if not any(m in plain(r.text) for m in items)}

    assert set(secret) == set(clean)
    for d, r in secret.items():
        assert not base_spans(r.text)
        assert (r.text == clean[d].text) == ("[secret]" not in r.text)
        assert r.n_chars == len(r.text)
    assert any("[secret]" in r.text for r in secret.values()) == any(base_spans(r.text) for r in clean.values())

    sizes, taken = defaultdict(int), defaultdict(int)
    for r in secret.values():
        sizes[r.source] += counts(r.text)[0]
    for r in mixed.values():
        assert r.text == secret[r.doc_id].text and r.taken == r.copies * counts(r.text)[0] and 1 <= r.copies <= 2
        taken[r.source] += r.taken
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns[-2:] == ["copies", "taken"] and got.count() > 0
