"""Secret scans: known patterns, and a battery of randomness tests.

Patterns find assignments, access keys and hexadecimal keys. Besides, every run
of 20 or more characters that keys are written with is a candidate. Its encoding
(the smallest alphabet that holds it) is inferred and three tests ask whether it
may be uniformly random in that alphabet: chi-squared uniformity, runs above and
below the middle, and lag-1 serial correlation. A candidate that fails one of
them is no key. For the others, the probability of so even a histogram under
ordinary text of that length (a non-central chi-squared law, so it knows the
length) is taken, and the Benjamini-Hochberg rule is applied within each length
class over all candidates of the table: only what stays below the wanted false
discovery rate is reported, as kind ``random``.

All work is done by DataFrame functions. Positions are in code points, ends
exclusive.

Cases: a null or empty text has no spans; repeated rows are scanned each for
itself and each counts in the rule; an empty table has no thresholds. Only id
and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.session import discard, materialize

#: kind, pattern, group whose length counts, least length
PATTERNS = (
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
KINDS = ("assign", "access", "hex", "random")
KEY_CHARS = "A-Za-z0-9+/_="
CANDIDATE = rf"(?<![{KEY_CHARS}-])[{KEY_CHARS}-]{{20,}}"
#: What a text with an ``assign`` span contains; all other spans lie in a candidate.
ANY_WORD = r"(?i)pass(word|wd)|secret|token|api_?key"

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings from the smallest alphabet up; "=" pads, "-" and "_" stand for "+" and "/".
ALPHABETS = (
    ("digits", DIGITS),
    ("hex", DIGITS + LOWER[:6]),
    ("upper hex", DIGITS + UPPER[:6]),
    ("lower", LOWER),
    ("upper", UPPER),
    ("base32", UPPER + DIGITS[2:8]),
    ("lower base36", DIGITS + LOWER),
    ("upper base36", DIGITS + UPPER),
    ("base62", DIGITS + UPPER + LOWER),
    ("base64", DIGITS + UPPER + LOWER + "+/"),
)
#: Ordinary text repeats characters more often than chance: the share by which
#: its index of coincidence exceeds that of a uniform source.
TEXT_EXCESS = 0.7
MAX_Z = 3.3
FALSE_DISCOVERY_RATE = 0.05
LENGTH_CLASSES = (20, 24, 32, 48, 64, 96, 128, 256)
BUCKETS_PER_UNIT = 50

_PLACE = "struct<start:long,end:long>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _places(text: Column, pattern: str, group: int, least: int) -> Column:
    """Start and end of the leftmost non-overlapping matches whose group is
    long enough: matches and the gaps between them alternate."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    body = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(gaps, F.zip_with(found, body, lambda x, b: F.struct(F.length(x).alias("n"), F.length(b).alias("body"))), lambda g, x: F.struct(F.length(g).alias("gap"), x.alias("x")))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_PLACE}>").alias("out"))

    def add(a: Column, s: Column) -> Column:
        start = a["at"] + s["gap"]
        end = start + F.coalesce(s["x"]["n"], F.lit(0))
        keep = F.coalesce(s["x"]["body"] >= least, F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(a["out"]).alias("out"))

    return F.aggregate(sizes, empty, add, lambda a: a["out"])


def _tests(token: Column) -> Column:
    """Encoding size, length and the three z values of a token."""
    plain = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
    alphabet = F.lit(ALPHABETS[-1][1])
    for _, chars in reversed(ALPHABETS[:-1]):
        alphabet = F.when(plain.rlike(f"^[{chars}]+$"), F.lit(chars)).otherwise(alphabet)

    def measured(x: Column) -> Column:
        values = F.transform(F.filter(F.split(x["token"], ""), lambda c: c != ""), lambda c: F.position(c, x["alphabet"]).cast("double") - 1)
        # Lengths and means are bound before the lambdas that use them: inside, they would be computed for every character.
        return _let(F.struct(values.alias("v"), F.length(x["alphabet"]).cast("double").alias("k")), sized)

    def sized(x: Column) -> Column:
        n = F.greatest(F.size(x["v"]).cast("double"), F.lit(1.0))
        total = F.aggregate(x["v"], F.lit(0.0), lambda a, y: a + y)
        return _let(F.struct(x["v"].alias("v"), x["k"].alias("k"), n.alias("n"), (total / n).alias("mean")), statistics)

    def statistics(x: Column) -> Column:
        v, k, n, mean = x["v"], x["k"], x["n"], x["mean"]
        squares = F.aggregate(
            F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda c: F.size(F.filter(v, lambda y: y == c.cast("double"))).cast("double")), F.lit(0.0), lambda a, c: a + c * c
        )
        chi = k / n * squares - n
        df = k - 1
        cube = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        high = F.size(F.filter(v, lambda y: y >= k / 2)).cast("double")
        low = n - high
        runs = 1.0 + F.size(F.filter(v, lambda y, i: (i > 0) & ((y >= k / 2) != (v[F.greatest(i - 1, F.lit(0))] >= k / 2)))).cast("double")
        mean_runs = 2 * high * low / n + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / F.greatest(n - 1, F.lit(1.0))
        z_runs = F.when(var_runs > 0, (runs - mean_runs) / F.sqrt(F.greatest(var_runs, F.lit(1e-9)))).otherwise(F.lit(99.0))
        spread = F.aggregate(v, F.lit(0.0), lambda a, y: a + (y - mean) * (y - mean))
        serial = F.aggregate(F.transform(v, lambda y, i: F.when(i > 0, (y - mean) * (v[F.greatest(i - 1, F.lit(0))] - mean)).otherwise(0.0)), F.lit(0.0), lambda a, y: a + y)
        z_serial = F.when(spread > 0, (serial / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0))
        excess = TEXT_EXCESS * n
        z_text = (chi - df - excess) / F.sqrt(2 * (df + 2 * excess))
        return F.struct(n.cast("int").alias("n"), k.cast("int").alias("k"), cube.alias("z_chi"), z_runs.alias("z_runs"), z_serial.alias("z_serial"), z_text.alias("z_text"))

    return _let(F.struct(plain.alias("token"), alphabet.alias("alphabet")), measured)


def normal_lower_tail(z: Column) -> Column:
    """P(Z <= z) of a standard normal, by a published rational approximation
    with an absolute error below 1e-7."""
    # Abramowitz and Stegun, formula 26.2.17.
    p, b = 0.2316419, (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + p * F.abs(z))
    poly = t * (b[0] + t * (b[1] + t * (b[2] + t * (b[3] + t * b[4]))))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z <= 0, upper).otherwise(1 - upper)


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for k, least in enumerate(LENGTH_CLASSES):
        out = F.when(n >= least, k).otherwise(out)
    return out


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the places of each pattern, and the tested candidates."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("run", F.col("text").rlike(CANDIDATE)).withColumn("word", F.col("text").rlike(ANY_WORD))
    none = F.array().cast(f"array<{_PLACE}>")
    gates = {"assign": F.col("word"), "access": F.col("run"), "hex": F.col("run")}
    d = d.select("id", "text", "run", *[F.when(gates[k], _places(F.col("text"), p, g, n)).otherwise(none).alias(k) for k, p, g, n in PATTERNS], F.when(F.col("run"), _places(F.col("text"), CANDIDATE, 0, 20)).otherwise(none).alias("places"))

    def tested(s: Column) -> Column:
        token = F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        return _let(_tests(token), lambda t: F.struct(s["start"].alias("start"), s["end"].alias("end"), t.alias("t")))

    known = [k for k, *_ in PATTERNS]
    d = d.select("id", *known, F.transform("places", tested).alias("tested"))
    p_text = lambda c: normal_lower_tail(c["t"]["z_text"])
    sound = lambda c: (c["t"]["z_chi"] <= MAX_Z) & (F.abs(c["t"]["z_runs"]) <= MAX_Z) & (F.abs(c["t"]["z_serial"]) <= MAX_Z)
    bucket = lambda c: F.when(sound(c), F.floor(-F.ln(F.greatest(p_text(c), F.lit(1e-300))) * BUCKETS_PER_UNIT)).otherwise(F.lit(-1)).cast("int")
    rated = F.transform("tested", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _length_class(c["t"]["n"]).alias("length_class"), bucket(c).alias("bucket")))
    return d.select(F.col("id").alias(id_col), *known, rated.alias("candidates"))


def thresholds(rated: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> dict[int, int]:
    """The least bucket (of -ln p) that the Benjamini-Hochberg rule accepts in
    each length class. Only counts by class and bucket are gathered, at most a
    few hundred thousand rows whatever the table; one row per class reaches the
    driver."""
    counts = rated.select(F.explode("candidates").alias("c")).groupBy("c.length_class", "c.bucket").agg(F.count("*").alias("n"))
    w = Window.partitionBy("length_class")
    down = w.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("length_class", "bucket", F.sum("n").over(down).alias("rank"), F.sum("n").over(w).alias("m"))
    p_upper = F.exp(-F.col("bucket") / BUCKETS_PER_UNIT)
    passed = ranked.where((F.col("bucket") >= 0) & (p_upper <= rate * F.col("rank") / F.col("m")))
    return {r[0]: r[1] for r in passed.groupBy("length_class").agg(F.min("bucket")).collect()}


def _marked(places: Column | str, rank: int, kind: str) -> Column:
    return F.transform(places, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def report(rated: DataFrame, accepted: dict[int, int]) -> DataFrame:
    """Adds ``spans``: all spans as (start, rank, end, kind), sorted by start,
    then kind. A random run inside a span of a pattern is not added again."""
    base = [_marked(k, r, k) for r, (k, *_) in enumerate(PATTERNS)]
    rated = rated.withColumn("base", F.sort_array(F.concat(*base)))

    def take(c: Column) -> Column:
        ok = F.lit(False)
        for length_class, least in sorted(accepted.items()):
            ok = ok | ((c["length_class"] == length_class) & (c["bucket"] >= least))
        return ok & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    extra = _marked(F.filter("candidates", take), KINDS.index("random"), "random")
    return rated.withColumn("spans", F.sort_array(F.concat("base", extra)))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the places of each pattern, ``base`` and ``spans``."""
    rated = materialize(candidates(docs, id_col, text_col), "secret-candidates")
    return report(rated, thresholds(rated)).drop("candidates")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all columns, with every span replaced by ``mask``
    (spans that touch or overlap by one mask); ``n_chars``, if there is such a
    column, is counted anew."""
    packed = docs.select(F.struct("*").alias("__row"), F.col(text_col).cast("string").alias("__text"))
    # Rated twice, for the thresholds and for the spans, so that no text is written.
    rated = materialize(candidates(packed.withColumn("__row", F.lit(None)), "__row", "__text").select("candidates"), "secret-candidates")
    accepted = thresholds(rated)
    discard(rated)
    found = report(candidates(packed, "__row", "__text"), accepted).select("__row", "spans")
    text = F.col(f"__row.`{text_col}`").cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        fresh = (s["start"] > a["at"]) | (a["at"] == 0)
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(fresh, F.concat(a["out"], gap, F.lit(mask))).otherwise(a["out"]).alias("out"))

    clean = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    found = found.withColumn("__clean", F.when(F.size("spans") > 0, clean).otherwise(text))
    changed = {text_col: F.col("__clean")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("__clean")).otherwise(F.col("__row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[changed.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])
