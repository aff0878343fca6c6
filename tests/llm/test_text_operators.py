import hashlib
import math
import random
import re
import string
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webwinnow.llm import compression_classifier, decontamination, licence_scan, toxicity
from webwinnow.llm.decontamination import Lemma, contaminated, decontaminated
from webwinnow.llm.quality_rules import keep_quality, quality_verdicts
from webwinnow.llm.secret_scan import Battery, redact, secrets, tested_runs, thresholds

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string"


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            marked |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("the of and to stone river walks under green light".split()) + r.choice(["", "", "s", "."]) + str(r.randrange(30)) for _ in range(n))


def test_quality_counts_equal_brute_force(spark, awkward):
    text = {1: "a b c\na b c a b c\n\na b c d | # é\n", 2: prose(1, 70), 3: "x\ty\x0bz\n" * 4}
    rows = list(text.items())
    got = {r.doc_id: tuple(r)[1:6] for r in quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {k: counts(v) for k, v in rows}
    mixed = {r.doc_id: r for r in quality_verdicts(awkward).where("doc_id is not null").collect()}
    assert (mixed[3].n_words, mixed[3].base_failed, mixed[3].kept) == (0, True, False)
    assert mixed[8].n_words == 60_000
    assert quality_verdicts(awkward.where("false")).count() == 0


def test_quality_verdict_parts_junk_from_prose(spark):
    # enough documents to estimate that rules seldom speak against good ones
    good = [(i, prose(i, 120)) for i in range(300)]
    bad = [(1000 + i, " ".join(w + "###" for w in prose(i, 90).split())) for i in range(30)] + [(2000 + i, prose(i, 90).upper().replace(" ", "!! ")) for i in range(30)]
    docs = spark.createDataFrame(good + bad, DOCS)
    kept = {r.doc_id for r in keep_quality(docs).collect()}
    assert kept == {i for i, _ in good}


def test_keep_quality_keeps_columns(spark, awkward):
    kept = keep_quality(awkward)
    assert kept.columns == awkward.columns and kept.schema == awkward.schema
    assert kept.where("text is null").count() == 0


def base_spans(text):
    kinds = (
        ("assign", r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 1),
        ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0),
    )
    found = [(m.start(), at, kind, m.end()) for at, (kind, p, least, g) in enumerate(kinds) for m in re.finditer(p, text) if len(m[g]) >= least]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def test_base_spans_equal_brute_force(spark):
    text = {
        1: "é token = \"abc\" Secret:abcdef apikey='zz.zz/zz' password=pass12 token=token=secret=123456", 2: "AKIA" + "A" * 16 + " AKIAAKIA" + "Z9" * 9,
        3: "0123456789abcdef01234567 " + "a" * 23 + " x" + "f" * 40 + "g", 4: None, 5: "", 6: "päss API_KEY: " + "0f" * 20 + "\n\n" + "secret" * 500,
    }
    for r in secrets(spark.createDataFrame(list(text.items()), DOCS)).collect():
        spans = base_spans(text[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == spans


def test_random_strings_are_found_and_ordinary_ones_left(spark):
    r = random.Random(3)
    letters = string.ascii_letters + string.digits + "+/"
    random_ones = [(i, "see " + "".join(r.choice(letters) for _ in range(r.choice((40, 44, 60)))) + " here") for i in range(60)]
    dull = [(1000 + i, "path Abcdefghij0000000000/Abcdefghij0000000000/" + "aB1" * 12 + " end") for i in range(60)]
    got = {x.doc_id: x.spans for x in secrets(spark.createDataFrame(random_ones + dull, DOCS)).collect()}
    assert sum("random" in got[i] for i, _ in random_ones) >= 30  # the control leaves some out
    assert not any("random" in got[i] for i, _ in dull)


def run_table(spark, rows):
    """A table of tested runs from ``(encoding, length, p, value)``."""
    kind = "runs array<struct<start:int,end:int,encoding:int,length:int,p:double,value:bigint>>"
    return spark.createDataFrame([([(0, 30, *row)],) for row in rows], kind)


def test_thin_strata_are_reported(spark):
    r = random.Random(4)
    sizes = dict(enumerate([1, 1, 2, 3, 5, 10, 50]))
    rows = [(3, at, r.uniform(0.01, 0.45) if n < 5 else r.uniform(0.01, 1), r.getrandbits(60)) for at, n in sizes.items() for _ in range(n)]
    cuts = thresholds(run_table(spark, rows), Battery())
    assert all(p >= cuts.get((code, at), 2.0) for code, at, p, _ in rows)
    # many ordinary strings are still told from few random ones
    many = [(3, 0, r.uniform(0.01, 0.1), r.getrandbits(60)) for _ in range(400)] + [(3, 0, (i + 0.5) / 200, r.getrandbits(60)) for i in range(200)]
    assert thresholds(run_table(spark, many), Battery())[3, 0] > 0.05


def test_copies_do_not_move_thresholds(spark):
    r = random.Random(6)
    rows = [(3, 4, (i + 0.5) / 1000, r.getrandbits(60)) for i in range(1000)] + [(3, 4, 0.001, r.getrandbits(60)) for _ in range(600)]
    alone = thresholds(run_table(spark, rows), Battery())
    for p in (0.3, 0.7):
        assert thresholds(run_table(spark, rows + [(3, 4, p, 7)] + [(3, 4, p, 7)] * 1000), Battery()) == alone
    text = "see Zm9vQmFy8rK2xLq0PdT5wNc1YhUe7sGjAi3B here"
    found = [x.spans for x in secrets(spark.createDataFrame([(i, text) for i in range(40)], DOCS)).collect()]
    assert len(found) == 40 and set(found) == {"random:4:40"}  # cuts apply to every occurrence


def test_named_values_letters_and_digits_are_tested(spark):
    r = random.Random(8)
    key = "Zm9vQmFy8rK2xLq0PdT5wNc1YhUe7sGjAi3B"
    text = {
        1: f"AUTH={key}", 2: f"AWS_KEY={key}==", 3: f"https://h.x/?sig={key}&a=b", 4: "k " + "".join(r.choice(string.ascii_letters) for _ in range(28)), 5: "k 31415926535897932384",
        7: "ID=fQ7xZk2LmW9rTb4Yp0==",
    }
    got = {x.doc_id: x.spans for x in secrets(spark.createDataFrame(list(text.items()), DOCS)).collect()}
    assert [got[i] for i in (1, 2, 3, 7)] == ["random:5:41", "random:8:46", "random:17:53", "random:3:23"]
    assert [got[i] for i in (4, 5)] == [f"random:2:{len(text[i])}" for i in (4, 5)]


def test_letters_of_one_case_are_words_until_the_corpus_says_otherwise(spark):
    r = random.Random(9)
    key = "qzxvlmnprtwybcdfghjksaeo"
    words = [(i, "das einlichheitenpfpfver" + "".join(r.choice(["ung", "heit", "keit", "lich"]) for _ in range(3))) for i in range(30)]
    alone = {x.doc_id: x.spans for x in secrets(spark.createDataFrame([*words, (99, key)], DOCS)).collect()}
    assert set(alone.values()) == {""}
    more = [(200 + i, "".join(r.choice(string.ascii_lowercase) for _ in range(24))) for i in range(120)]
    found = {x.doc_id: x.spans for x in secrets(spark.createDataFrame([*words, (99, key), *more], DOCS)).collect()}
    right, wrong = sum(found[i] != "" for i, _ in more), sum(found[i] != "" for i, _ in words)
    assert found[99] == "random:0:24" and right >= 110 and wrong <= 0.1 * (right + wrong)  # the rate is estimated: 0.05 and its error


ALPHABETS = {"0": "0123456789abcdef", "3": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/", "5": string.ascii_lowercase}


def plain_p(text, alphabet):
    """The battery in plain Python."""
    x, k, n = [alphabet.index(c) for c in text], len(alphabet), len(text)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi = sum((x.count(v) - n / k) ** 2 / (n / k) for v in range(k))
    z1 = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    high = [v * 2 >= k for v in x]
    a, b, runs = sum(high), n - sum(high), 1 + sum(p != q for p, q in zip(high, high[1:]))
    spread = math.sqrt(max(1e-9, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))))
    mean = sum(x) / n
    serial = sum((p - mean) * (q - mean) for p, q in zip(x, x[1:])) / max(1e-9, sum((v - mean) ** 2 for v in x))
    least = min(1, tail(z1), 2 * tail(abs(runs - 2 * a * b / n - 1) / spread), 2 * tail(abs(serial + 1 / n) * math.sqrt(n)))
    return 1 - (1 - least) ** 3


def test_p_values_equal_a_plain_battery(spark):
    r = random.Random(10)
    texts = [(int(code), "".join(r.choice(a if r.random() < 0.7 else a[:6]) for _ in range(r.randrange(20, 130)))) for code, a in ALPHABETS.items() for _ in range(60)]
    for code in (0, 3):  # the shape of the encoding
        texts = [(c, t + ("0a" if code == 0 else "0aZ") if c == code else t) for c, t in texts]
    rows = spark.createDataFrame(texts, "code int, text string").select("*", tested_runs(F.col("text")).alias("runs")).collect()
    for row in rows:
        (run,) = row.runs
        assert run.encoding == row.code and (run.start, run.end) == (0, len(row.text))
        assert run.p == pytest.approx(plain_p(row.text, ALPHABETS[str(row.code)]), abs=2e-6)


def test_long_runs_and_many_matches_are_linear(spark):
    r = random.Random(11)
    long_run = "x " + "".join(r.choices(string.ascii_letters + string.digits + "+/", k=1_000_000)) + " y"
    many = "password=abcdef " * 100_000
    both = "".join(f"token:abc{i:06d} {'%040x' % r.getrandbits(160)} " for i in range(20_000))
    docs = spark.createDataFrame([(1, long_run), (2, many), (3, both)], DOCS)
    began = time.time()
    got = {x.doc_id: x for x in secrets(docs).collect()}
    clean = {x.doc_id: x.text for x in redact(docs).collect()}
    assert time.time() - began < 90
    assert got[1].spans == "random:2:1000002" and clean[1] == "x [secret] y"
    assert got[2].n_assign == 100_000 and clean[2] == "[secret] " * 100_000
    assert (got[3].n_assign, got[3].n_hex) == (20_000, 20_000) and clean[3] == "[secret] [secret] " * 20_000


def test_redaction_and_awkward_rows(spark, awkward):
    docs = spark.createDataFrame([(1, "a token = 0123456789abcdef0123456789abcdef z password=abcdefg"), (2, "plain"), (3, None)], DOCS)
    assert [r.text for r in redact(docs).orderBy("doc_id").collect()] == ["a [secret] z [secret]", "plain", None]
    assert redact(awkward).schema.names == awkward.columns
    assert sorted(map(str, redact(awkward).collect())) == sorted(map(str, awkward.collect()))
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.base_sha256 for r in secrets(awkward).where("text is null" if "text" in secrets(awkward).columns else "doc_id in (3, 4)").collect()} == {empty}
    assert secrets(awkward.where("false")).count() == 0


def plain(text):
    return " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def least_edits(item, text):
    """Edits of *item* against its best part of *text*, in bytes or in characters."""
    before = np.zeros(len(text) + 1, int)
    for c in item:
        now = np.empty_like(before)
        now[0] = before[0] + 1
        for j in range(1, len(now)):
            now[j] = min(before[j - 1] + (text[j - 1] != c), before[j] + 1, now[j - 1] + 1)
        before = now
    return int(before.min())


def test_decontamination_equals_brute_force(spark):
    r = random.Random(9)
    items = [(i, prose(100 + i, 12 + 6 * i)) for i in range(5)] + [(9, "short"), (10, None), (0, prose(100, 12))]
    docs = []
    for d in range(60):
        words = prose(d, 40).split()
        if d % 2:
            text = items[d % 5][1]
            for _ in range(r.choice((0, 0, 1, 3, 8))):
                k = r.randrange(len(text))
                text = text[:k] + r.choice(["", "Q", "zz"]) + text[k + 1 :]
            words[r.randrange(40):1] = [text.upper() if d % 3 == 0 else text.replace(" ", " -- ")]
        docs.append((d, " ".join(words)))
    lemma = Lemma(block_bytes=200)
    got = {(x.doc_id, x.item_id): x.edits for x in contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, text string"), lemma).collect()}
    want = {}
    for d, text in docs:
        for i, item in {(i, t) for i, t in items if t and len(plain(t)) >= lemma.q}:
            m = plain(item).encode()
            e = least_edits(m, plain(text).encode())
            if e <= int(lemma.edits(len(m))):
                want[d, i] = e
    assert got == want and len(want) > 15


def test_decontamination_of_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(None, "w100 w101 w102 w103 w104 w105"), (2, "absent passage of words")], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in contaminated(awkward, items).collect()] == [(8, None)]
    assert sorted(map(str, decontaminated(awkward, items).collect())) == sorted(map(str, awkward.where("doc_id is null or doc_id <> 8").collect()))
    assert contaminated(awkward, items.where("false")).count() == 0 and contaminated(awkward.where("false"), items).count() == 0


def test_compression_scores(spark, awkward):
    good = [(i, prose(i, 150)) for i in range(80)]
    bad = [(i, " ".join(w.upper() + "!!" for w in prose(i, 150).split())) for i in range(80, 160)]
    docs = spark.createDataFrame(good + bad, DOCS)
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(160)] + [(5, 1), (7, None)], "doc_id bigint, quality int")
    got = compression_classifier.score_quality(docs, labels).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id < 80) for r in got if r.held_out]) > 0.9
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    odd = compression_classifier.score_quality(awkward, labels).collect()
    assert len(odd) == 12 and all(0 <= r.score <= 1 for r in odd)
    assert compression_classifier.score_quality(awkward.where("false"), labels).count() == 0
    assert compression_classifier.score_quality(awkward, labels.where("false")).count() == 12


def test_toxic_grades(spark, awkward):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        words = prose(i, 60).split()
        for _ in range(r.choice((1, 3, 6)) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(["scumbag", "idiotic", "Moron,"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels[:200] + [(0, 1), (299, None)], "doc_id bigint, toxic int")
    got = toxicity.toxic_grades(docs, known).collect()
    assert np.mean([x.predicted == labels[x.doc_id][1] for x in got if x.doc_id >= 200]) > 0.95
    assert all(0 <= x.expected_severity <= 3 for x in got)
    odd = toxicity.toxic_grades(awkward, known).collect()
    assert len(odd) == 12 and all(0 <= x.expected_severity <= 3 for x in odd)
    assert len({x.toxic_probability for x in odd if x.doc_id in (3, 4, 5)}) == 1
    assert {x.predicted for x in toxicity.toxic_grades(awkward, known.where("false")).collect()} == {0}
    assert toxicity.toxic_grades(awkward.where("false"), known).count() == 0


def test_ordinal_thresholds_are_ordered():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 3))
    y = np.digitize(x @ [2.0, -1.0, 0.0] + r.logistic(size=400) * 0.3, [-1, 0.5, 2])
    weights, thresholds = toxicity._regress(x, y, np.ones(400), 600)
    assert (np.diff(thresholds) > 0).all() and weights[0] > 1 > 0 > weights[1] and abs(weights[2]) < 0.5
    p = toxicity.Model(np.zeros(0, np.int64), weights, thresholds).grades(x @ weights)
    assert np.allclose(p.sum(axis=1), 1) and np.mean(p.argmax(axis=1) == y) > 0.75


def test_licences(spark, awkward):
    grant, condition = licence_scan.SENTENCES["mit-grant"], licence_scan.SENTENCES["mit-condition"]
    wrapped = re.sub(r"(.{50}\S*) ", r"\1\n", grant)
    rows = [
        (1, "Some words. Released under the MIT License. More."), (2, f"{wrapped}\n\n{condition}\n"), (3, f"{condition} {grant}"),
        (4, "prose\nLicensed under CC BY-NC 4.0.\nprose"), (5, "This licence sentence is unknown."), (6, None),
    ]
    got = {r.doc_id: r for r in licence_scan.licences(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i].licences for i in range(1, 7)] == [["MIT"], ["MIT"], [], ["CC-BY-NC-4.0"], [], []]
    assert got[1].starts == [12] and got[3].sentences == ["mit-condition", "mit-grant"]
    assert all(licence_scan.HINT.search(s) for s in licence_scan.SENTENCES.values())
    assert {x for _, ids in licence_scan.RULES for x in ids} == set(licence_scan.SENTENCES)
    assert {tuple(r.licences) for r in licence_scan.licences(awkward).collect()} == {()}
    assert licence_scan.licences(awkward.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(licence_scan.SENTENCES))
def test_each_known_sentence_is_recognised(name):
    hits = licence_scan.sentence_hits(f"Text before.\n{licence_scan.SENTENCES[name]}\nText after.")
    assert [h.identifier for h in hits] == [name]


def test_short_items_keep_a_bound(spark):
    """An item of 18 bytes may lose no edit to the lemma: none is allowed where an edit could break every q-gram."""
    lemma = Lemma()
    assert [int(lemma.edits(m)) for m in (10, 17, 19, 20, 40, 200)] == [0, 0, 0, 1, 2, 12]
    assert all(int(lemma.bound(m)) >= 1 for m in range(10, 400))
    items = spark.createDataFrame([(1, "abcdefghijklmnopqr")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x abcdefghijklmnopqr y"), (2, "x abcdefghiZklmnopqr y")], DOCS)
    assert [(r.doc_id, r.edits) for r in contaminated(docs, items, lemma).collect()] == [(1, 0)]


def test_sliced_postings_equal_whole_ones(monkeypatch):
    """Rows of more postings than a slice are worked off in parts, with the same matches."""
    common = prose(1, 30)
    items = [f"{common} {prose(k, 12)}" for k in range(6)] + [common, "abc " * 9, "ab" * 12]
    texts = [prose(50, 20), " ".join(items), "abc " * 40, None, f"x {items[3]} y {items[3]}", "", f"{items[6][:40]}Q{items[6][41:]}"]
    index = decontamination.Items(pa.array(range(len(items))), pa.array(items), Lemma())
    data = decontamination.text_bytes(pa.array(texts))
    whole = sorted(index.matches(*data))
    assert len(whole) == 9 + 1 + 2 + 1 and (4, 3, 0) in whole and (6, 6, 1) in whole
    for size in (1, 7, 100, 3_000):
        monkeypatch.setattr(decontamination, "_SLICE", size)
        assert sorted(index.matches(*data)) == whole


def test_many_item_blocks_meet_gathered_texts(spark):
    """More blocks than one, and texts gathered in several lots, give what one block gives, in one pass over the texts."""
    items = spark.createDataFrame([(k, prose(300 + k, 14)) for k in range(40)], "item_id int, text string")
    docs = spark.createDataFrame([(d, f"{prose(d, 30)} {prose(300 + d % 60, 14)}") for d in range(200)], DOCS).repartition(2)
    one, many = Lemma(), Lemma(block_bytes=500, gather_bytes=2_000)
    want = sorted(map(tuple, contaminated(docs, items, one).collect()))
    got = contaminated(docs, items, many)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 140
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert decontaminated(docs, items, many).count() == 60


def test_edits_count_characters(spark):
    """An edited letter outside ASCII is one edit; brute force over the characters agrees."""
    r = random.Random(4)
    letters = "äöüßéñ漢字😀 abcde"
    items = [(k, "é" + "".join(r.choice(letters) for _ in range(60)) + "ß") for k in range(6)]
    docs = []
    for d in range(60):
        text = items[d % 6][1]
        for _ in range(d // 10):
            k = r.randrange(len(text))
            text = text[:k] + r.choice(["", "漢", "é", "x"]) + text[k + 1 :]
        docs.append((d, f"före {text} 終わり"))
    lemma = Lemma()
    got = {(x.doc_id, x.item_id): x.edits for x in contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, text string"), lemma).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            m = plain(item)
            e = least_edits(m, plain(text))
            if e <= int(lemma.edits(len(m))):
                want[d, i] = e
    assert got == want and 20 <= len(want) < 60 and max(want.values()) == 3


def test_code_points_of_broken_bytes():
    rows = ["aé漢😀".encode(), b"", b"\xff\xe9\x80a", "é".encode()]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    x, at = decontamination.code_points(data, offsets)
    assert at.tolist() == [0, 4, 4, 8, 9] and x[:4].tolist() == [ord(c) for c in "aé漢😀"] and x[8] == ord("é")
