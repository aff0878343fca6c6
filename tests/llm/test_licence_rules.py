"""Licence rules against brute force, and texts of many blank lines."""

import random
import time
from itertools import combinations

import pytest

from webwinnow.llm import licence_scan as L


def by_hand(names):
    """Rules whose identifiers are some choice of the found ones in order, without those that begin a longer one."""
    found = [k for k, (_, wanted) in enumerate(L.RULES) if wanted in set(combinations(names, len(wanted)))]
    begun = {L.RULES[k][1][:n] for k in found for n in range(len(L.RULES[k][1]))}
    return [k for k in found if L.RULES[k][1] not in begun]


@pytest.mark.parametrize("seed", range(40))
def test_sentences_and_rules_equal_brute_force(seed):
    """Known sentences in any order, repeated, broken over lines, between unknown ones."""
    r = random.Random(seed)
    names = [r.choice(sorted(L.SENTENCES)) for _ in range(r.randrange(0, 9))]
    if seed % 2:  # the longer rules, in order and with one step missing
        names += [x for x in r.choice([w for _, w in L.RULES if len(w) > 1]) if r.random() < 0.8]
    text, starts = "Words before the notice.\n", []
    for name in names:
        starts.append(len(text))
        text += L.SENTENCES[name].replace(" ", "\n" if r.random() < 0.3 else " ") + r.choice(["\n", " \n\n", "\nOther words follow.\n"])
    hits = L.sentence_hits(text)
    assert [(h.identifier, h.start) for h in hits] == list(zip(names, starts))
    assert L.matched_rules(names) == by_hand(names)


@pytest.mark.parametrize("filler", ["\n", ". ", "a\n", "licence\n", "--\n"])
def test_long_texts_take_time_in_proportion(filler):
    """200,000 pieces, with words or without, around a known sentence."""
    text = filler * 100_000 + "\n" + L.SENTENCES["isc-grant"] + "\n" + filler * 100_000
    began = time.monotonic()
    assert [h.identifier for h in L.sentence_hits(text)] == ["isc-grant"]
    assert time.monotonic() - began < 30
