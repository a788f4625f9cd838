"""Secrets in whole texts: fixed shapes, and runs that pass a randomness battery.

Fixed shapes (assign, access, hex) are regular expressions.  On top, every run of
encoding characters is tested: its encoding is inferred from its alphabet, its
symbols are tested for chi-squared uniformity, for runs above and below the middle
of the alphabet, and for lag-1 serial correlation, and Fisher's method combines the
three into one p-value that is uniform for random strings and near zero for words
and counters.

False-discovery control is length-aware: per encoding and length class (powers of
two), the strings with p above one half estimate how many truly random strings the
class holds, hence how many random ones lie above any cut.  Of LEVELS the lowest cut
whose estimated share of non-random strings among those reported stays within ``fdr``
is used, else the highest: a class whose strings are short or wordy gets a higher cut
than one of long keys, but no class, however few or wordy its strings, loses more
random ones than the highest level's share.  The counts cover all documents.

DataFrame functions only: positions come from the lengths of ``split`` gaps and
``regexp_extract_all`` hits.  Two scans of the texts, one small aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightdeck.llm.common import spare

# The shapes that the base scan finds, in listed order.
ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
ASSIGN_HEAD = r"^(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

#: A run worth testing: at least 16 encoding characters, perhaps padded.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Encodings, tried in order: name, shape, alphabet in code order.
ENCODINGS = [
    ("lower", r"^[a-z]{32,}$", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", r"^[A-Z]{32,}$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", r"^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("upper36", r"^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base64", r"^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
#: Runs without a digit are tested if both cases are among so many characters, or if
#: they are as long as the one-case encodings ask: shorter ones may be plain words.
MIXED = r"^(?=.*[a-z])(?=.*[A-Z]).{20,}$"
ONE_CASE = r"^(?:[a-z]{32,}|[A-Z]{32,})$"
#: The cuts of p, lowest first: so many of the random strings may be missed.
LEVELS = (0.001, 0.002, 0.005, 0.01, 0.02)
REDACTED = "[REDACTED]"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _located(text: Column, pattern: str, make) -> Column:
    """Array of ``make(hit, start)`` for every match, in order; code points."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"), hits.alias("hit"))
    empty = F.array().cast("array<struct<hit:string,start:int>>")
    walked = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["gap"]) + F.char_length(x["hit"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                x["hit"].alias("hit"),
                (acc["at"] + F.char_length(x["gap"])).alias("start")))).alias("out")),
        lambda acc: F.transform(acc["out"], lambda s: make(s["hit"], s["start"])))
    return F.when(text.rlike(pattern), walked).otherwise(F.array())


def _span(kind: int):
    return lambda hit, start: F.struct(start.alias("start"), F.lit(kind).alias("kind"),
                                       (start + F.char_length(hit)).alias("end"))


def base_spans(text: Column) -> Column:
    """Sorted spans of the fixed shapes: array of (start, kind, end)."""
    keep = F.filter(_located(text, ASSIGN, lambda hit, start: F.struct(
        start.alias("start"), F.lit(0).alias("kind"), (start + F.char_length(hit)).alias("end"),
        F.char_length(F.regexp_replace(hit, ASSIGN_HEAD, "")).alias("size"))),
        lambda s: s["size"] >= 6)
    assign = F.transform(keep, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return F.array_sort(F.concat(*[c.cast(_SPAN) for c in (
        assign, _located(text, ACCESS, _span(1)), _located(text, HEX, _span(2)))]))


def _normal_tail(z: Column) -> Column:
    """P(N(0,1) > z) for z >= 0, to 1e-7 (rational approximation of erfc)."""
    x = z / F.lit(2 ** 0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return 0.5 * poly * F.exp(-x * x)


def _upper(z: Column) -> Column:
    return F.when(z >= 0, _normal_tail(F.abs(z))).otherwise(1 - _normal_tail(F.abs(z)))


def battery(hits: Column) -> Column:
    """Per candidate (hit, start): (start, end, encoding, size, p); p of randomness.

    p is 0 where no encoding fits, the run has no letter, or it has no digit and is
    too short to be told from words.
    """
    def alphabet(s):
        found = F.lit("")
        for _, shape, letters in reversed(ENCODINGS):
            found = F.when(s.rlike(shape), F.lit(letters)).otherwise(found)
        testable = (s.rlike("[0-9]") & s.rlike("[A-Za-z]")) | s.rlike(MIXED) | s.rlike(ONE_CASE)
        return F.when(testable, found).otherwise(F.lit(""))

    body = F.transform(hits, lambda h: F.struct(
        h["start"].alias("start"), (h["start"] + F.char_length(h["hit"])).alias("end"),
        alphabet(F.regexp_replace(h["hit"], "=+$", "")).alias("letters"),
        F.regexp_replace(h["hit"], "=+$", "").alias("body")))
    coded = F.transform(body, lambda b: F.struct(
        b["start"].alias("start"), b["end"].alias("end"), F.char_length(b["letters"]).alias("k"),
        F.char_length(b["body"]).cast("double").alias("n"), b["letters"].alias("letters"),
        F.when(F.char_length(b["letters"]) > 0, F.transform(
            F.split(b["body"], ""), lambda c: F.instr(b["letters"], c) - 1))
        .otherwise(F.array().cast("array<int>")).alias("codes")))

    def sums(c):
        k, mid = c["k"], (c["k"] - 1) / 2.0
        squares = F.aggregate(F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0))), F.lit(0.0),
                              lambda a, j: a + F.pow(F.size(F.filter(c["codes"], lambda x: x == j)), F.lit(2.0)))
        start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("turns"),
                         F.lit(0.0).alias("above"), F.lit(0.0).alias("lag"), F.lit(0.0).alias("var"))

        def step(a, x):
            d = x - mid
            return F.struct(
                d.alias("last"),
                (a["turns"] + F.when((d > 0) != (a["last"] > 0), 1.0).otherwise(0.0)).alias("turns"),
                (a["above"] + F.when(d > 0, 1.0).otherwise(0.0)).alias("above"),
                (a["lag"] + F.coalesce(a["last"] * d, F.lit(0.0))).alias("lag"),
                (a["var"] + d * d).alias("var"))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), k.alias("k"),
                        c["n"].alias("n"), c["letters"].alias("letters"), squares.alias("squares"),
                        F.aggregate(c["codes"], start, step).alias("s"))

    def scored(c):
        k, n, s = c["k"].cast("double"), c["n"], c["s"]
        free = k - 1
        chi = k / n * c["squares"] - n
        # Wilson-Hilferty: the cube root of a chi-squared value is nearly normal
        z = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        p_chi = _upper(z)
        a, b = s["above"], n - s["above"]
        mean = 2 * a * b / n + 1
        spread = F.sqrt(2 * a * b * (2 * a * b - n) / (n * n * (n - 1)))
        p_runs = F.when(a * b > n / 2, 2 * _normal_tail(F.abs((s["turns"] + 1 - mean) / spread))).otherwise(1e-9)
        r = s["lag"] / s["var"]
        p_serial = F.when(s["var"] > 0, 2 * _normal_tail(F.abs((r + 1 / n) * F.sqrt(n)))).otherwise(1e-9)
        half = -F.log(F.greatest(p_chi, F.lit(1e-30))) - F.log(F.greatest(p_runs, F.lit(1e-30))) \
            - F.log(F.greatest(p_serial, F.lit(1e-30)))
        combined = F.exp(-half) * (1 + half + half * half / 2)
        name = F.lit("")
        for label, _, letters in ENCODINGS:
            name = F.when(c["letters"] == letters, F.lit(label)).otherwise(name)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), name.alias("encoding"),
                        F.floor(F.log2(n)).cast("int").alias("size"),
                        F.when(k > 0, F.least(combined, F.lit(1.0))).otherwise(0.0).alias("p"))
    return F.transform(F.transform(coded, sums), scored)


def _scanned(docs: DataFrame, text_col: str, base: str = "base", tests: str = "tests") -> DataFrame:
    """``docs`` with sorted ``base`` spans and battery results (``tests``)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hits = _located(text, CANDIDATE, lambda hit, start: F.struct(hit.alias("hit"), start.alias("start")))
    name = spare(docs, "candidate_hits")
    found = docs.withColumn(name, hits).withColumn(base, base_spans(text))
    return found.withColumn(tests, F.when(F.size(name) > 0, battery(F.col(name))).otherwise(F.array())).drop(name)


def cuts(docs: DataFrame, text_col: str = "text", fdr: float = 0.1) -> dict[tuple[str, int], float]:
    """Lowest p that each (encoding, length class) reports, from all documents.

    The result has at most one entry for each of 9 encodings and 31 classes.  With
    N(t) strings at p >= t and 2 * N(1/2) * (1 - t) of them random, the estimated
    share of non-random ones is 1 - 2 * N(1/2) * (1 - t) / N(t).
    """
    steps = [*LEVELS, 0.5]
    over = sum((F.when(F.col("t.p") >= x, 1).otherwise(0) for x in steps), F.lit(0))
    tests = (_scanned(docs.select(F.col(text_col).alias("text")), "text").select(F.explode("tests").alias("t"))
             .where("t.encoding <> '' AND t.p > 0")
             .groupBy("t.encoding", "t.size", over.alias("bin")).count())
    by_class: dict[tuple[str, int], list[int]] = {}
    for r in tests.collect():  # at most encodings x classes x steps rows
        by_class.setdefault((r["encoding"], r["size"]), [0] * (len(steps) + 1))[r["bin"]] += r["count"]
    out = {}
    for key, bins in by_class.items():
        random_all = 2 * bins[-1]
        out[key] = LEVELS[-1]
        for i, t in enumerate(LEVELS):
            above = sum(bins[i + 1:])
            if above and 1 - min(1.0, random_all * (1 - t) / above) <= fdr:
                out[key] = t
                break
    return out


def scan(docs: DataFrame, text_col: str = "text", fdr: float = 0.1) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end), sorted.

    A NULL text counts as empty and has no span; every row is kept, repeated rows
    included; other columns pass through, save that columns named ``base`` or
    ``spans`` are replaced.  kind indexes KINDS.
    """
    cut = cuts(docs, text_col, fdr)
    limit = F.lit(2.0)
    rules = [F.lit(x) for (e, n), t in sorted(cut.items()) for x in (f"{e}:{n}", t)]
    levels = F.create_map(*rules) if rules else None
    tests = spare(docs, "battery_results")
    found = _scanned(docs, text_col, "base", tests)
    if levels is not None:
        def over(t):
            at = levels[F.concat_ws(":", t["encoding"], t["size"])]
            return t["p"] >= F.coalesce(at, limit)
        extra = F.transform(F.filter(tests, over), lambda t: F.struct(
            t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    else:
        extra = F.array()
    return found.withColumn("spans", F.array_sort(F.concat(F.col("base"), extra.cast(_SPAN)))).drop(tests)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every maximal stretch covered by spans replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["end"] <= a["at"], a["out"])
            .when((s["start"] < a["at"]) & (a["at"] > 0), a["out"])
            .otherwise(F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                                F.lit(REDACTED))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
