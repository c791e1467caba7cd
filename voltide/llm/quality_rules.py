"""Quality rules: counts of repetition and symbols, and the divergence of a
document's character-class and common-word histograms from its language.

All work is done by DataFrame functions. ``measure`` reads each text once and
keeps a few numbers; ``references`` averages the histograms of all sound
documents of a language; ``judge`` compares each document with the reference of
its language (unknown or null language: with the nearest reference) by the
Jensen-Shannon distance. Short documents are guarded: their histograms are too
noisy to judge, so only the plain rules hold for them.

Cases: a null or empty text has no words, hence fails the plain rules; with no
reference at all (empty table, no sound document) nothing diverges; repeated
rows are measured each for itself. Only id, text and language are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.session import discard, materialize

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a"],
}
N_COMMON = 16

BLANKS = r"[\x20\x09-\x0D]+"
#: Counted by pattern; blanks and lower-case letters follow from the totals.
CLASSES = {"symbol": "#*$%&|<>", "upper": "A-Z", "digit": "0-9", "mark": r".,;:!?\x22\x27()\[\]\-", "other": r"\x{80}-\x{10FFFF}"}

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GUARD_WORDS = 50
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.45


def _count(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at the given sorted positions."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("reach"))
    add = lambda a, p: F.struct((a["total"] + WINDOW - F.greatest(F.lit(0), a["reach"] - p)).alias("total"), (p + WINDOW).alias("reach"))
    return F.aggregate(positions, start, add, lambda a: a["total"])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: the id, ``lang``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``classes`` (characters by class) and
    ``common`` (occurrences of each common word, a list for each language that
    the document is compared with)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    d = d.select("id", "lang", text.alias("text"), F.filter(F.split(text, BLANKS), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    known = sorted({w for x in COMMON_WORDS.values() for w in x})
    d = d.select(
        "id",
        "lang",
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("n_chars"),
        *[_count(F.col("text"), c).alias(f"n_{k}") for k, c in CLASSES.items()],
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: w.isin(known)).alias("frequent"),
    )
    at = lambda i: F.xxhash64(*[F.col("hashes")[i + k] for k in range(WINDOW)])
    d = d.withColumn("windows", F.when(F.col("n") >= WINDOW, F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), at)))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn("sorted", F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = lambda s, k: (
        (F.when(k > 0, F.col("sorted")[k - 1]["h"]) == s["h"]) | (F.when(k < F.size("sorted") - 1, F.col("sorted")[k + 1]["h"]) == s["h"])
    )
    d = d.withColumn("repeated", F.sort_array(F.transform(F.filter("sorted", lambda s, k: F.coalesce(again(s, k), F.lit(False))), lambda s: s["i"])))
    lists = F.lit([COMMON_WORDS[x] for x in sorted(COMMON_WORDS)])
    for x, words in COMMON_WORDS.items():
        lists = F.when(F.col("lang") == x, F.array(F.lit(words))).otherwise(lists)
    blank = F.col("n_chars") - F.col("word_chars")
    classes = [F.col(f"n_{k}") for k in CLASSES]
    return d.select(
        F.col("id").alias(id_col),
        F.col("lang").alias("__lang"),
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        F.col("n_symbol").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("repeated")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(blank, *classes, F.col("n_chars") - blank - sum(classes[1:], classes[0])).alias("classes"),
        F.transform(lists, lambda x: F.transform(x, lambda w: F.size(F.filter("frequent", lambda f: f == w)).cast("long"))).alias("common"),
    )


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c / F.greatest(total, F.lit(1)))


def _word_shares(counts: Column) -> Column:
    """Shares of the common words and of all other words."""
    shares = _shares(counts, F.col("n_words"))
    return F.concat(shares, F.array(1.0 - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)))


def _class_shares() -> Column:
    return _shares(F.col("classes"), F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Mean class and word histogram of each language with a word list, over
    all documents that pass the plain rules and the length guard: one row per
    language reaches the driver."""
    sound = measured.where(~base_failed() & (F.col("n_words") >= GUARD_WORDS) & F.col("__lang").isin(list(COMMON_WORDS)))
    sound = sound.select("__lang", _class_shares().alias("c"), _word_shares(F.col("common")[0]).alias("w"))
    n_classes = len(CLASSES) + 2
    means = [F.avg(F.col("c")[k]) for k in range(n_classes)] + [F.avg(F.col("w")[k]) for k in range(N_COMMON + 1)]
    rows = sound.groupBy("__lang").agg(*[m.alias(f"m{k}") for k, m in enumerate(means)]).collect()
    return {r[0]: (list(r[1 : n_classes + 1]), list(r[n_classes + 1 :])) for r in rows}


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""
    half = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: half(a, b) + half(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def judge(measured: DataFrame, known: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    """Adds ``class_distance``, ``word_distance`` (null without a reference),
    ``base_failed`` and ``kept``."""
    class_all, word_all, class_by, word_by = [], [], F.lit(None), F.lit(None)
    d = measured.withColumn("__c", _class_shares()).withColumn("__w", F.transform("common", _word_shares))
    for k, x in enumerate(sorted(COMMON_WORDS)):
        if x not in known:
            continue
        c, w = (F.array(*[F.lit(v) for v in values]) for values in known[x])
        class_all.append(js_distance(F.col("__c"), c))
        word_all.append(js_distance(F.get("__w", F.lit(k)), w))
        class_by = F.when(F.col("__lang") == x, js_distance(F.col("__c"), c)).otherwise(class_by)
        word_by = F.when(F.col("__lang") == x, js_distance(F.col("__w")[0], w)).otherwise(word_by)
    listed = F.coalesce(F.col("__lang").isin(sorted(COMMON_WORDS)), F.lit(False))
    nearest = lambda by, every: F.when(listed, by).otherwise(F.array_min(F.array(*every)) if every else F.lit(None)).cast("double")
    d = d.withColumns({"class_distance": nearest(class_by, class_all), "word_distance": nearest(word_by, word_all), "base_failed": base_failed()})
    long = F.col("n_words") >= GUARD_WORDS
    far = long & ((F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE))
    return d.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).drop("__c", "__w", "__lang", "classes", "common")


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``judge`` with references of the same table; the measures are written
    once to the shared folder."""
    measured = materialize(measure(docs, id_col, text_col, lang_col), "quality-measures")
    return judge(measured, references(measured))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep. Measured twice,
    for the references and for the verdict, so that no text is written."""
    packed = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    measured = materialize(measure(packed.withColumn("__row", F.lit(None)), "__row", "t", "l").drop("__row"), "quality-measures")
    known = references(measured)
    discard(measured)
    # The row number keeps the optimizer from pushing the verdict below the
    # measures, where it would compute them once for each time it names them.
    judged = judge(measure(packed, "__row", "t", "l"), known).withColumn("__at", F.monotonically_increasing_id())
    return judged.where("kept AND __at >= 0").select("__row.*")
