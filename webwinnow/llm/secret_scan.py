"""Secret scans in column functions only.

Three fixed patterns give the base spans. A battery of randomness tests adds spans: each run of encoding characters
has its encoding inferred, and its symbols are tested for a uniform alphabet (chi-squared),
for runs about the middle of the alphabet, and for serial correlation. The smallest of the three p-values, corrected for
taking the smallest, is uniform for random strings and near zero for ordinary ones. Tests of short strings have little
power, so the share of ordinary strings among those declared random is controlled in each stratum of encoding and
length. Twice the p-values above a half tell how many random strings a stratum holds. Its share of random strings is
shrunk towards that of all lengths of the encoding, and that towards a prior (letters of one case are words until the
corpus says otherwise); where it stays under ``share`` nothing is reported. Elsewhere the surplus at any threshold is
false discoveries, and the lowest threshold that keeps their rate at ``rate`` is used; a surplus within ``errors`` standard
errors of its estimate counts as none (but not for letters of one case), so a thin stratum falls back to the level ``least``. Each distinct string counts
once, however many copies it has. The corpus enters through counts per stratum and bin of p-values.

Positions and overlaps are running sums and extremes over blocks of about the square root of an array, and symbols are
counted by string functions, so a text of one long run or of very many matches takes no quadratic time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from webwinnow.functions.binding import let, running
from webwinnow.llm.common import saved, unused

#: Base patterns: kind, pattern with the match as first group, least length, group that it holds for.
_ASSIGN = (
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))"
)
KINDS = (("assign", _ASSIGN, 6, 3), ("access", r"(AKIA[A-Z0-9]+)", 20, 2), ("hex", r"([0-9a-f]+)", 24, 2))
#: What a text must hold to be searched for the kind at all.
_HINTS = (r"[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]", "AKIA", "[0-9a-f]{24}")
#: "=" is padding at the end of a run, so a value after NAME= is a run of its own; 20 characters are asked with padding.
_RUN = r"([A-Za-z0-9+/_-]{14,}={0,6})"

#: Encodings: name, shape, alphabet. The first shape that fits is inferred.
_ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[A-Za-z])(?:[0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("digits", r"^[0-9]+$", "0123456789"),
    ("letters", r"^(?:[a-z]+|[A-Z]+)$", "abcdefghijklmnopqrstuvwxyz"),
    ("mixed letters", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
)
#: Share of random strings in an encoding of which nothing is known: letters of one case are words.
_PRIOR = (1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1.0)
_LENGTHS = (20, 24, 32, 40, 48, 64, 96, 128)  # lower ends of the length strata
_BINS = 200
#: Coefficients of the usual five-term approximation of the normal tail.
_TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


@dataclass(frozen=True)
class Battery:
    """False-discovery rate, the least p-value at which a string may count as random, standard errors of a surplus that
    count as chance, the least share of random strings in a stratum, and how many strings a prior share weighs."""

    rate: float = 0.05
    least: float = 0.005
    errors: float = 2.0
    share: float = 0.25
    prior: float = 20.0


def _spans(text: Column, pattern: str, least: int, held: int, kind: str) -> Column:
    """``(kind, start, end, value)`` of the leftmost matches whose group *held* has *least* characters.

    The lengths of the matches and of the gaps before them add up to positions.
    """
    match = F.lit(pattern)
    hits = F.regexp_extract_all(text, match, F.lit(1))
    values = hits if held == 2 else F.regexp_extract_all(text, match, F.lit(held - 1))
    pairs = F.zip_with(
        F.arrays_zip(hits.alias("hit"), values.alias("held")), F.split(text, pattern, -1),
        lambda x, gap: F.struct(x["hit"].alias("hit"), F.length(x["held"]).alias("n"), (F.length(gap) + F.length(x["hit"])).alias("step")))

    def placed(found: Column) -> Column:
        # the text after the last match has no partner
        known = F.filter(found, lambda x: x["hit"].isNotNull())
        ends = running(F.transform(known, lambda x: x["step"]), lambda a, b: a + b)
        spans = F.zip_with(known, ends, lambda x, end: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(x["hit"])).alias("start"), end.alias("end"), x["hit"].alias("value"), x["n"]))
        return F.transform(F.filter(spans, lambda x: x["n"] >= least), lambda x: F.struct(x["kind"], x["start"], x["end"], x["value"]))

    return let(pairs, placed)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds by start, then kind as listed."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    found = [F.when(text.rlike(hint), _spans(text, *spec[1:], spec[0])).otherwise(none) for spec, hint in zip(KINDS, _HINTS)]
    return _by_place(F.concat(*found))


def _rank(kind: Column) -> Column:
    return F.when(kind == "assign", 0).when(kind == "access", 1).when(kind == "hex", 2).otherwise(3)


def _by_place(spans: Column) -> Column:
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), _rank(s["kind"]).alias("rank"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def _normal_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0."""
    t = 1 / (1 + 0.2316419 * z)
    poly = F.lit(0.0)
    for c in reversed(_TAIL):
        poly = (poly + c) * t
    return F.exp(-z * z / 2) / F.lit(2.5066282746310002) * poly


def _upper(z: Column) -> Column:
    return F.when(z >= 0, _normal_tail(z)).otherwise(1 - _normal_tail(-z))


def _p_value(text: Column, alphabet: Column) -> Column:
    """Corrected smallest p-value of the battery for the symbols of *text*, all of them in *alphabet*.

    Symbols are counted first; runs and lagged products are sums of whole numbers over neighbours, in one pass.
    """
    symbols = F.split(alphabet, "")
    counts = F.transform(symbols, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double"))
    values = F.transform(F.split(text, ""), lambda c: F.position(c, alphabet) - 1)
    return let(F.struct(counts.alias("counts"), values.alias("x"), F.size(symbols).alias("k")), _battery)


def _battery(t: Column) -> Column:
    x, k = t["x"], t["k"]
    before, after = F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x))
    neighbours = F.aggregate(
        F.zip_with(before, after, lambda a, b: F.struct(((a * 2 >= k) != (b * 2 >= k)).cast("double").alias("turn"), (a * b).cast("double").alias("product"))),
        F.struct(F.lit(1.0).alias("runs"), F.lit(0.0).alias("product")),
        lambda s, v: F.struct((s["runs"] + v["turn"]).alias("runs"), (s["product"] + v["product"]).alias("product")))
    ranked = F.transform(t["counts"], lambda c, i: F.struct(c.alias("c"), i.cast("double").alias("v")))

    def summed(term) -> Column:
        return F.aggregate(ranked, F.lit(0.0), lambda s, r: s + term(r))

    sums = F.struct(
        F.size(x).cast("double").alias("n"), k.cast("double").alias("k"), neighbours.alias("pairs"), summed(lambda r: r["c"] * r["c"]).alias("squares"),
        summed(lambda r: F.when(r["v"] * 2 >= k, r["c"]).otherwise(0.0)).alias("high"), summed(lambda r: r["c"] * r["v"]).alias("total"),
        summed(lambda r: r["c"] * r["v"] * r["v"]).alias("second"), F.element_at(x, 1).alias("first"), F.element_at(x, -1).alias("last"))
    return let(sums, _from_sums)


def _from_sums(t: Column) -> Column:
    n, k = t["n"], t["k"]
    df = k - 1
    chi = t["squares"] * k / n - n
    z_chi = (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))  # Wilson-Hilferty

    pairs = 2 * t["high"] * (n - t["high"])
    spread = F.sqrt(F.greatest(F.lit(1e-9), pairs * (pairs - n) / (n * n * (n - 1))))
    z_runs = F.abs(t["pairs"]["runs"] - pairs / n - 1) / spread

    mean = t["total"] / n
    around = t["second"] - n * mean * mean
    lagged = t["pairs"]["product"] - mean * (2 * t["total"] - t["first"] - t["last"]) + (n - 1) * mean * mean
    z_serial = F.abs(lagged / F.greatest(F.lit(1e-9), around) + 1 / n) * F.sqrt(n)

    least = F.least(_upper(z_chi), 2 * _normal_tail(z_runs), 2 * _normal_tail(z_serial))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.pow(1 - F.least(F.lit(1.0), least), F.lit(3.0))))


def tested_runs(text: Column) -> Column:
    """``(start, end, encoding, length, p, value)`` (value: a hash) of each run of encoding characters whose encoding is inferred."""
    kind = "array<struct<start:int,end:int,encoding:int,length:int,p:double,value:bigint>>"
    runs = _spans(text, _RUN, 20, 2, "random")

    def encoding(value: Column) -> Column:
        found = F.lit(None).cast("int")
        for at in reversed(range(len(_ENCODINGS))):
            found = F.when(value.rlike(_ENCODINGS[at][1]), at).otherwise(found)
        return found

    def pick(code: Column, parts: list) -> Column:
        out = F.lit(parts[-1])
        for at in reversed(range(len(parts) - 1)):
            out = F.when(code == at, F.lit(parts[at])).otherwise(out)
        return out

    inferred = F.filter(
        F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), encoding(s["value"]).alias("encoding"), s["value"].alias("value"))),
        lambda s: s["encoding"].isNotNull(),
    )

    def tested(s: Column) -> Column:
        code, length = s["encoding"], F.length(s["value"])
        plain = F.rtrim(F.translate(s["value"], "-_", "+/"), F.lit("="))
        cased = F.when(code.isin(0, 2, 5), F.lower(plain)).otherwise(plain)
        stratum = F.aggregate(F.array(*[F.lit(x) for x in _LENGTHS]), F.lit(0), lambda a, x: a + (length >= x).cast("int"))
        p = let(F.struct(cased.alias("text"), pick(code, [a for _, _, a in _ENCODINGS]).alias("alphabet")), lambda t: _p_value(t["text"], t["alphabet"]))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), code.alias("encoding"), stratum.alias("length"), p.alias("p"), F.xxhash64(s["value"]).alias("value"))

    return F.when(text.rlike("[A-Za-z0-9+/_-]{14}[A-Za-z0-9+/_=-]{6}"), F.transform(inferred, tested)).otherwise(F.array().cast(kind))


def thresholds(runs: DataFrame, battery: Battery) -> dict[tuple[int, int], float]:
    """Least p-value per stratum from a table with a column ``runs`` of tested runs; strata that report nothing have none."""
    # copies of a string count once: they would move the threshold for all others
    bins = F.least(F.lit(_BINS - 1), F.floor(F.col("r.p") * _BINS)).alias("bin")
    distinct = runs.select(F.explode("runs").alias("r")).select("r.encoding", "r.length", bins, "r.value").distinct()
    rows = distinct.groupBy("encoding", "length", "bin").count().collect()  # strata and bins are few and fixed
    counts: dict[tuple[int, int], dict[int, int]] = {}
    for r in rows:
        counts.setdefault((r["encoding"], r["length"]), {})[r["bin"]] = r["count"]
    return cuts(counts, battery)


def cuts(counts: dict[tuple[int, int], dict[int, int]], battery: Battery) -> dict[tuple[int, int], float]:
    """Least p-value per stratum from counts of distinct strings per bin of their p-value."""
    def random_and_all(strata) -> tuple[int, int]:
        held = [counts[s] for s in strata]
        return 2 * sum(n for h in held for b, n in h.items() if 2 * b >= _BINS), sum(sum(h.values()) for h in held)

    out = {}
    for encoding, length in counts:
        random, n = random_and_all([s for s in counts if s[0] == encoding])
        share = (random + battery.prior * _PRIOR[encoding]) / (n + battery.prior)
        random, n = random_and_all([(encoding, length)])
        if (random + battery.prior * share) / (n + battery.prior) < battery.share:
            continue
        bins, above, before = sorted(counts[encoding, length]), n, -1
        for b in bins:
            level = (before + 1) / _BINS  # the lowest level that takes the same strings
            # twice a binomial count of one half has the standard error sqrt(n); words get no benefit of the doubt
            if above - (random + battery.errors * _PRIOR[encoding] * above**0.5) * (1 - level) <= battery.rate * above:
                out[encoding, length] = max(battery.least, level)
                break
            above, before = above - counts[encoding, length][b], b
    return out


def _apart(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span: by the furthest end before them and the nearest start after them."""
    far = F.lit(2**31 - 1)
    marked = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("run"), s["end"].alias("end"))),
        F.transform(runs, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("run"), s["end"].alias("end")))))

    def kept(m: Column) -> Column:
        ends = running(F.transform(m, lambda s: F.when(s["run"] == 0, s["end"]).otherwise(0)), F.greatest)
        starts = F.reverse(running(F.reverse(F.transform(m, lambda s: F.when(s["run"] == 0, s["start"]).otherwise(far))), F.least))
        both = F.zip_with(m, F.arrays_zip(ends.alias("end"), starts.alias("start")), lambda s, near: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), ((s["run"] == 1) & (near["end"] <= s["start"]) & (near["start"] >= s["end"])).alias("free")))
        return F.filter(both, lambda s: s["free"])

    plain = F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(True).alias("free")))
    return F.when((F.size(base) == 0) | (F.size(runs) == 0), plain).otherwise(let(marked, kept))


def all_spans(base: Column, runs: Column, cuts: dict[tuple[int, int], float]) -> Column:
    """Base spans and the random runs that overlap none of them, by start, then kind."""
    def random(r: Column) -> Column:
        cut = F.lit(2.0)
        for (encoding, length), p in sorted(cuts.items()):
            cut = F.when((r["encoding"] == encoding) & (r["length"] == length), p).otherwise(cut)
        return r["p"] >= cut

    free = _apart(base, F.filter(runs, random))
    added = F.transform(free, lambda r: F.struct(F.lit("random").alias("kind"), r["start"].alias("start"), r["end"].alias("end")))
    plain = F.transform(base, lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return _by_place(F.concat(plain, added))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, battery: Battery = Battery(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of *docs*: the id, counts per base kind, ``base_sha256`` and all ``spans``.

    A null text is empty: no spans, the hash of the empty string. Repeated rows give equal rows; a null id stays null;
    other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    scanned = saved(docs.select(F.col(id_col).alias("id"), base_spans(text).alias("base"), tested_runs(text).alias("runs")), "secrets")
    cuts = thresholds(scanned, battery)
    base = F.col("base")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        F.col("id").alias(id_col), *[count(kind) for kind, *_ in KINDS], F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(all_spans(base, F.col("runs"), cuts)).alias("spans"),
    )


def redact(docs: DataFrame, battery: Battery = Battery(), text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """*docs* with every span of ``secrets`` replaced by *mark*; spans that overlap are replaced as one.

    Texts without spans, nulls and other columns stay as they are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base, runs, spans = (unused(docs, x) for x in ("_base", "_runs", "_spans"))
    # scanned once: the thresholds and the replacement read it back
    found = saved(docs.withColumns({base: base_spans(text), runs: tested_runs(text)}), "scanned")
    cuts = thresholds(found.select(F.col(runs).alias("runs")), battery)
    found = found.withColumn(spans, all_spans(F.col(base), F.col(runs), cuts))
    clean = F.when(F.size(spans) > 0, _replaced(F.col(text_col), F.col(spans), mark)).otherwise(F.col(text_col))
    return found.withColumn(text_col, clean).select(*docs.columns)


def _replaced(text: Column, spans: Column, mark: str) -> Column:
    """*text* with *mark* for each span that starts after the ends of all before it, and without what spans cover."""
    def pieces(t: Column) -> Column:
        spans, chars = t["spans"], t["chars"]

        def gap(s: Column, i: Column) -> Column:
            done = F.when(i == 0, 0).otherwise(F.get(t["reached"], i - 1))
            return F.when(s["start"] >= done, F.concat(F.array_join(F.slice(chars, done + 1, s["start"] - done), ""), F.lit(mark))).otherwise("")

        return F.concat(F.array_join(F.transform(spans, gap), ""), F.array_join(F.slice(chars, F.element_at(t["reached"], -1) + 1, F.size(chars)), ""))

    reached = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return let(F.struct(spans.alias("spans"), F.split(text, "").alias("chars"), reached.alias("reached")), pieces)
