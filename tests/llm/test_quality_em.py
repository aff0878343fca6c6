"""Expectation-maximisation over vote patterns against a plain one over documents."""

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from webwinnow.llm import quality_rules as Q
from webwinnow.llm.quality_rules import FALSE_ALARM, RULES, expectation_maximisation


def plain(documents, rounds=200):
    """Posteriors of a list of vote lists: a loop over documents, rules and votes."""
    n = len(documents)
    q = [0.05 if -1 in votes else 0.95 for votes in documents]
    for _ in range(rounds):
        good, bad = math.fsum(q), math.fsum(1 - x for x in q)
        share = min(max((good + 0.5) / (n + 1), 0.01), 0.99)
        weight = []
        for k in range(len(documents[0])):
            odds = {}
            for vote in (-1, 0, 1):
                g = math.fsum(x for x, votes in zip(q, documents) if votes[k] == vote)
                b = math.fsum(1 - x for x, votes in zip(q, documents) if votes[k] == vote)
                in_bad = (b + 0.5) / (bad + 1.5)
                odds[vote] = math.log((g + 0.5) / (good + 1.5) / in_bad)
                if vote == -1:
                    odds[vote] = min(odds[vote], math.log(FALSE_ALARM / in_bad))
            weight.append(odds)
        now = [1 / (1 + math.exp(-(math.log(share / (1 - share)) + sum(w[v] for w, v in zip(weight, votes))))) for votes in documents]
        moved = max(abs(a - b) for a, b in zip(now, q))
        q = now
        if moved < 1e-9:
            break
    return q


@pytest.mark.parametrize("seed", range(6))
def test_patterns_give_what_documents_give(seed):
    """Good documents pass most rules, bad ones break one or two; a rule that never fires is among them."""
    r = random.Random(seed)
    documents = []
    for _ in range(300):
        votes = [r.choice([1, 1, 1, 0]) for _ in RULES]
        if r.random() < 0.2:
            for k in r.sample(range(len(RULES) - 1), r.choice([1, 2])):
                votes[k] = -1
        documents.append(tuple(votes))
    patterns = sorted(set(documents))
    model = expectation_maximisation(np.array(patterns, float), np.array([documents.count(p) for p in patterns], float))
    want = dict(zip(documents, plain(documents)))
    for p in patterns:
        odds = model.prior + sum(w[v + 1] for w, v in zip(model.weights, p))
        assert 1 / (1 + math.exp(-odds)) == pytest.approx(want[p], abs=1e-6)


@pytest.fixture(scope="module")
def judged(spark):
    """Votes and quality labels of the documents that pass the base rules, with their patterns."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    table = Q.with_stats(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")).join(labels, "doc_id", "left")
    labelled = table.where(~Q.base_failed(F.col("stats"))).select(F.array(*Q.votes(F.col("stats"))).alias("v"), "quality")
    rows = labelled.groupBy("v", "quality").count().collect()
    return *Q.vote_patterns(table), {(tuple(r.v), r.quality): r["count"] for r in rows}


def mistakes(judged, **options):
    """Labelled documents that the verdicts get wrong: good ones dropped, bad ones kept; and verdicts unlike all-must-pass."""
    patterns, counts, labelled = judged
    model = expectation_maximisation(patterns, counts, **options)
    keeps = {tuple(p): model.prior + sum(w[int(v) + 1] for w, v in zip(model.weights, p)) >= 0 for p in patterns}
    dropped = sum(n for (v, quality), n in labelled.items() if quality == 1 and not keeps[v])
    kept = sum(n for (v, quality), n in labelled.items() if quality == 0 and keeps[v])
    return dropped, kept, sum(n for (v, _), n in labelled.items() if keeps[v] == (-1 in v))


def test_posterior_beats_all_must_pass_and_needs_the_bound(judged):
    labelled = judged[2]
    assert sum(n for (v, quality), n in labelled.items() if quality == 1 and -1 in v) == 10  # what all-must-pass would drop
    assert mistakes(judged) == (0, 0, 24)
    assert mistakes(judged, false_alarm=1.0)[1] > 100


def test_junk_that_breaks_one_rule_needs_the_bound_on_false_alarms():
    """300 good documents and two kinds of junk, each of which breaks rules of its own."""
    one = np.ones((3, len(RULES)))
    one[1, 0] = -1  # symbols alone
    one[2, 1:3] = -1  # capitals and exclamations
    counts = np.array([300.0, 30.0, 30.0])

    def keeps(**options):
        model = expectation_maximisation(one, counts, **options)
        return [model.prior + sum(w[int(v) + 1] for w, v in zip(model.weights, p)) >= 0 for p in one]

    assert keeps() == [True, False, False]
    assert keeps(false_alarm=1.0) == [True, True, False]
