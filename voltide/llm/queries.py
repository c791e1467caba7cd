"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm import (
    best_fit_packing,
    decontamination,
    importance_resampling,
    jaccard_join,
    pii,
    quality_classifier,
    quality_rules,
    quotation,
    secrets,
    sentencepiece_bpe,
    substring_dedup,
    tokenizer_alignment,
    warc,
)
from voltide.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_ALNUM_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op2_decontamination",
    rf"""
    WITH item AS (SELECT CAST(item_id AS VARCHAR) item, {_ALNUM_WORDS.format(lower_ascii('text'))} w FROM benchmark WHERE text IS NOT NULL),
    windows AS (SELECT DISTINCT item, least(13, len(w)) size, list_slice(w, i, i + least(13, len(w)) - 1) win
      FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) i FROM item WHERE len(w) > 0)),
    doc AS (SELECT doc_id, coalesce({_ALNUM_WORDS.format(lower_ascii('text'))}, []) w FROM documents),
    places AS (SELECT doc_id, size, i, list_slice(w, i, i + size - 1) win FROM (
      SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) i FROM doc, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
    hits AS (SELECT doc_id, i, size, item FROM places JOIN windows USING (size, win)),
    words AS (SELECT doc_id, count(*) n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) k FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) contaminated
    FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.match_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _common_words_sql() -> str:
    rows = [f"('{x}', {k}, '{w}')" for x, words in quality_rules.COMMON_WORDS.items() for k, w in enumerate(words)]
    return f"(VALUES {', '.join(rows)}) AS v(ref, bin, word)"


def _quality_sql() -> str:
    q = quality_rules
    classes = ", ".join(rf"len(regexp_extract_all(t, '[{c}]')) n_{k}" for k, c in q.CLASSES.items())
    names = [f"n_{k}" for k in q.CLASSES]
    return rf"""
    WITH common AS MATERIALIZED (SELECT * FROM {_common_words_sql()}),
    doc AS (SELECT doc_id, coalesce(lang, '') lang, coalesce(text, '') t, {_WORDS.format("coalesce(text, '')")} w FROM documents),
    runs AS (SELECT doc_id, i, list_slice(w, i, i + 7) win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) i FROM doc WHERE len(w) >= 8)),
    again AS (SELECT doc_id, win FROM runs GROUP BY doc_id, win HAVING count(*) > 1),
    covered AS (SELECT doc_id, count(*) n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) k FROM runs JOIN again USING (doc_id, win)) GROUP BY doc_id),
    lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) x FROM doc),
    base AS (SELECT doc_id, lang, w, len(w) n_words, length(array_to_string(w, '')) word_chars, {classes}, length(t) n_chars,
        coalesce(n, 0) n_repeat_words, len(x) - len(list_distinct(x)) n_dup_lines
      FROM doc JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    judged AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words base_failed FROM base),
    shares AS (SELECT doc_id, k bin, list_extract([n_chars - word_chars, {", ".join(names)}, word_chars - {" - ".join(names)}], k) / greatest(n_chars, 1) p
      FROM judged, range(1, {len(names) + 3}) r(k) WHERE n_words >= {q.GUARD_WORDS} AND NOT base_failed),
    pairs AS (SELECT doc_id, n_words, w, ref, lang = ref AS own FROM judged, (SELECT DISTINCT ref FROM common)
      WHERE n_words >= {q.GUARD_WORDS} AND NOT base_failed AND (lang = ref OR lang NOT IN (SELECT ref FROM common))),
    seen AS (SELECT doc_id, lower(x) word, count(*) n FROM (SELECT doc_id, unnest(w) x FROM judged) GROUP BY ALL),
    listed AS (SELECT doc_id, ref, own, bin, coalesce(n, 0) / n_words p FROM pairs JOIN common USING (ref) LEFT JOIN seen USING (doc_id, word)),
    word_shares AS (SELECT * FROM listed UNION ALL SELECT doc_id, ref, own, 99, 1 - sum(p) FROM listed GROUP BY doc_id, ref, own),
    class_refs AS (SELECT lang ref, bin, avg(p) q FROM shares JOIN judged USING (doc_id) WHERE lang IN (SELECT ref FROM common) GROUP BY ALL),
    word_refs AS (SELECT ref, bin, avg(p) q FROM word_shares WHERE own GROUP BY ALL),
    class_terms AS (SELECT doc_id, ref, p, q FROM pairs JOIN shares USING (doc_id) JOIN class_refs USING (ref, bin)),
    word_terms AS (SELECT doc_id, ref, p, q FROM word_shares JOIN word_refs USING (ref, bin)),
    class_far AS (SELECT doc_id, min(d) class_d FROM (SELECT doc_id, ref, {{js}} d FROM class_terms GROUP BY ALL) GROUP BY doc_id),
    word_far AS (SELECT doc_id, min(d) word_d FROM (SELECT doc_id, ref, {{js}} d FROM word_terms GROUP BY ALL) GROUP BY doc_id)
    SELECT doc_id, n_words, word_chars, n_symbol n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT coalesce(class_d > {q.MAX_CLASS_DISTANCE} OR word_d > {q.MAX_WORD_DISTANCE}, false) kept
    FROM judged LEFT JOIN class_far USING (doc_id) LEFT JOIN word_far USING (doc_id)
    """.replace(
        "{js}",
        "sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))",
    )


@query("op4_quality_rules", _quality_sql())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(
    "op9_jaccard_join",
    rf"""
    WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS.format(lower_ascii("coalesce(text, '')"))} w FROM documents),
    sets AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 2) s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) i FROM doc)),
    sizes AS (SELECT doc_id, count(*) n FROM sets GROUP BY doc_id),
    common AS (SELECT a.doc_id x, b.doc_id y, count(*) n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common.n >= 90 * (p.n + q.n - common.n)),
    pairs AS (SELECT x u, y v FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT doc_id u, doc_id v FROM doc UNION SELECT reach.u, pairs.v FROM reach JOIN pairs ON reach.v = pairs.u)
    SELECT doc_id, coalesce(n, 0) n_shingles, component_id
    FROM doc LEFT JOIN sizes USING (doc_id) JOIN (SELECT u doc_id, min(v) component_id FROM reach GROUP BY u) USING (doc_id)
    """,
)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op7_secret_scans")
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model() -> str:
    return vocabulary_file("piece_bpe_32k.model")


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_documents(table(spark, sf_dir, "documents"), piece_model())


_BASE32 = """
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST(list_reduce(list_transform(range(5 * k, 5 * k + 5), lambda b:
        (CAST(instr('0123456789abcdef', substr(h, 1 + b // 4, 1)) - 1 AS BIGINT) >> (3 - b % 4)) & 1), lambda x, y: 2 * x + y) AS BIGINT), 1)), '')
"""


@query(
    "op6_warc",
    f"""
    WITH page AS (SELECT page_id, sha1(coalesce(html, '')) h, strlen(coalesce(html, '')) payload_bytes FROM pages),
    origin AS (SELECT h, payload_bytes, max(page_id) origin FROM page GROUP BY ALL)
    SELECT page_id, payload_bytes, {_BASE32} payload_digest,
      CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END record_type, CASE WHEN page_id <> origin THEN origin END refers_to
    FROM page JOIN origin USING (h, payload_bytes)
    """,
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.archive_index(spark, path)


@query("op3_quotation_linking")
def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.link_quotes(table(spark, sf_dir, "conversations"))


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score_documents(docs, quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels")))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, pii.fit_tagger(docs))
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


@query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.align_tokenizers(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), piece_model())


@query("op12_best_fit_packing")
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


_CRC_BYTE = "xor(x >> 8, list_extract(crc_table, 1 + CAST(xor(x & 255, b) AS BIGINT)))"


@query(
    "op13_importance_resampling",
    rf"""
    WITH crc AS (SELECT list(v ORDER BY k) crc_table FROM (
      SELECT k, list_reduce(list_prepend(CAST(k AS BIGINT), CAST(range(8) AS BIGINT[])), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) v FROM range(256) r(k))),
    doc AS (SELECT doc_id, coalesce({_ALNUM_WORDS.format(lower_ascii("text"))}, []) w FROM documents),
    corpus AS (SELECT word, count(*) n FROM (SELECT unnest(w) word FROM doc) GROUP BY word),
    goal AS (SELECT word, count(*) n FROM (SELECT unnest({_ALNUM_WORDS.format(lower_ascii("text"))}) word FROM benchmark) GROUP BY word),
    word_bytes AS (SELECT word, list_transform(range(0, strlen(word)), lambda k: (instr('0123456789ABCDEF', substr(hex(word), 1 + 2 * k, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hex(word), 2 + 2 * k, 1)) - 1) c
      FROM (SELECT word FROM corpus UNION SELECT word FROM goal)),
    hashed AS (SELECT word, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST(c AS BIGINT[])), lambda x, b: {_CRC_BYTE})) % 10000 bucket FROM word_bytes, crc),
    s AS (SELECT bucket, sum(n) n FROM corpus JOIN hashed USING (word) GROUP BY bucket),
    t AS (SELECT bucket, sum(n) n FROM goal JOIN hashed USING (word) GROUP BY bucket),
    sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0) all_s, coalesce((SELECT sum(n) FROM t), 0) all_t),
    gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((s.n + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) g FROM s LEFT JOIN t USING (bucket), sums),
    weights AS (SELECT doc_id, sum(g) weight FROM (SELECT doc_id, unnest(w) word FROM doc) JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
    noise AS (SELECT doc_id, len(w) n_features, CAST(coalesce(weight, 0) AS BIGINT) weight, (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296 u FROM doc LEFT JOIN weights USING (doc_id)),
    scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(u))) AS BIGINT) score FROM noise),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) place, count(*) OVER () n FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END rank FROM scored LEFT JOIN placed USING (doc_id)
    """,
)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
