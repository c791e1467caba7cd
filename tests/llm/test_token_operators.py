"""Tokenizer alignment, packing and resampling against brute force."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import DOC_SCHEMA, LONG, clash, doc_rows
from voltide.llm import best_fit_packing, chunks, importance_resampling, tokenizer_alignment
from voltide.llm.queries import piece_model, vocabulary_file

BYTE_MODEL, WORD_MODEL = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("word_bpe_49k.json")
ODD_TEXTS = [
    None, "", " ", "\n", "  x", "x  ", " a\n\nb \n c\t d", "a\r\nb;\r\n\r\n);\r x", "tab\tin\x0bside\x0c", "no\xa0break　wide\x85next",
    "<|endoftext|> and <|startoftext|> <s></s>", "a<|EndOfText|>b <|ENDOFTEXT|>", "it's we'll I'M they'Ve", "▁ literal ▁mark", "é́ ﬁ ẛ̣ Å", "日本語 🦄🦄\n🦄 ", "\x00 a\x00b \x1c c\x1fd", "aaa " * 5000, "ΑΣ ΣΑΣ. İI", "  \n  \n  ",
    "1234 5 678,90", "\n\n\nstart", "end\n\n\n", " \n lead", "x" * 3000, "'s 't", "ab" * 700,
]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- chunks ------------------------------------------------------------------------


def test_chunks_join_to_the_text_and_start_at_white_space():
    rng = random.Random(3)
    texts = [t for t in ODD_TEXTS if t] + ["".join(rng.choice("ab.\n \t\r\xa0é") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    for t in texts:
        keys = chunks.spaced_chunks(t)
        assert "".join(map(chunks.chunk_text, keys)) == " " + t
        assert all(chunks.chunk_text(k)[0] in " \n" for k in keys)


def test_memory_is_bounded_and_keeps_what_is_used():
    calls = []

    def encode(keys):
        calls.extend(keys)
        return ([k.upper() for k in keys],)

    memory = chunks.ChunkMemory(encode, most=10)
    for n in range(30):
        memory.shrink()
        codes = memory.numbers(["often", "often", f"once{n}"])
        memory.learn(np.array(codes))
        assert [memory.columns[0][c] for c in codes] == ["OFTEN", "OFTEN", f"ONCE{n}"]
        assert len(memory) <= 12 and len(memory.names) == len(memory)
    assert calls.count("often") == 1 and len(calls) == 31


# --- 11 tokenizer alignment ----------------------------------------------------------


def aligned(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, digest of each text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(BYTE_MODEL), sentencepiece.SentencePieceProcessor(model_file=piece_model())
    a_tok.encode_special_tokens = True
    value = tokenizer_alignment.byte_values()
    with open(BYTE_MODEL) as f:
        a_bytes = {i: bytes(value[c] for c in k) for k, i in json.load(f)["model"]["vocab"].items()}
    b_bytes = lambda i: bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for text in texts:
        a, b = (a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)) if text else ([], [])
        x, y = [a_bytes[i] for i in a], [b_bytes(i) for i in b]
        if not text or not (b"".join(x) == b"".join(y) == (" " + text).encode()):
            found.append(None)
            continue
        owner = lambda ids, parts: [k for k, part in enumerate(parts) for _ in part]
        pairs = [(a[i], b[j]) for i, j in sorted(set(zip(owner(a, x), owner(b, y), strict=True)))]
        ends = lambda parts: set(np.cumsum([len(p) for p in parts]).tolist())
        cuts, groups, i, j, at_a, at_b = ends(x) & ends(y), [], 0, 0, 0, 0
        for cut in sorted(cuts):
            p, q = i, j
            while at_a < cut:
                at_a, i = at_a + len(x[i]), i + 1
            while at_b < cut:
                at_b, j = at_b + len(y[j]), j + 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
        counts.update(pairs)
        found.append((len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]), f[4]) for f in found
    ]


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("small_runs", [False, True])
def test_alignment_equals_brute_force(spark, monkeypatch, small_runs):
    if small_runs:  # many runs, merges of two, several tasks for a radix partition, sums given up early
        for name, value in (("RUN_RECORDS", 500), ("FAN_IN", 2), ("TASK_BYTES", 300), ("HELD_DOCUMENTS", 20)):
            monkeypatch.setattr(tokenizer_alignment, name, value)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()]
    texts = ODD_TEXTS + docs + docs[:3]
    df = clash(spark.createDataFrame(doc_rows(enumerate(texts)), DOC_SCHEMA).repartition(3))
    got = rows_of(tokenizer_alignment.align_tokenizers(df, BYTE_MODEL, piece_model(), radix=8 if small_runs else 256), *ALIGNED)
    assert got == sorted(((i, *row) for i, row in enumerate(aligned(texts))), key=str)


def test_alignment_of_odd_rows(spark, odd_docs, no_docs):
    out = tokenizer_alignment.align_tokenizers(odd_docs, BYTE_MODEL, piece_model())
    texts = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows_of(out, *ALIGNED) == sorted(((i, *row) for (i, _), row in zip(texts, aligned([t for _, t in texts]), strict=True)), key=str)
    assert tokenizer_alignment.align_tokenizers(no_docs, BYTE_MODEL, piece_model()).count() == 0


def test_runs_hold_counts_beyond_a_record():
    T = tokenizer_alignment
    record = lambda b, a, doc, n: b << 46 | a << 28 | doc << 12 | n
    records = np.array([record(9, 4, d % 3, 1) for d in range(30_000)] + [record(9, 5, 65_535, 7), record(3, 4, 0, 1)], np.uint64)
    runs = {part: (T.unpacked(p), T.unpacked(d)) for part, p, d in T.runs_of(records, 4)}
    (b, a, n, links), (step, each) = runs[1]
    assert (b.tolist(), a.tolist(), n.tolist(), links.tolist()) == ([9, 9], [4, 5], [3, 1], [30_000, 7])
    assert (np.cumsum(step) & 65_535).tolist() == [0, 1, 2, 65_535] and each.tolist() == [10_000] * 3 + [7]
    assert set(runs) == {1, 3}


def test_merge_of_sorted_runs():
    rng = np.random.default_rng(5)
    runs, want = [], Counter()
    for _ in range(9):
        keys = np.unique(rng.integers(0, 400, rng.integers(0, 200)))
        n = rng.integers(1, 9, len(keys))
        runs.append((keys // 20, keys % 20, n))
        want.update({(k // 20, k % 20): v for k, v in zip(keys.tolist(), n.tolist(), strict=True)})
    b, a, n = tokenizer_alignment.merged(runs)
    assert list(zip(zip(b.tolist(), a.tolist(), strict=True), n.tolist(), strict=True)) == sorted(want.items())


# --- 12 best-fit packing ----------------------------------------------------------------


def check_packing(rows, texts, size):
    """Pieces are those of the library, and sequences have no gap."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_MODEL)
    want = []
    for i, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(i, at // size, at, len(ids[at : at + size]), zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())) for at in range(0, len(ids), size)]
    assert sorted((r[:5] for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for pieces in sequences.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [at for at, _ in sorted(pieces)] == [0, *ends[:-1].tolist()] and ends[-1] <= size
    return len(sequences), -(-sum(r[3] for r in rows) // size)


PACKED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def pack(df, **options):
    return [tuple(r) for r in best_fit_packing.pack_documents(df, WORD_MODEL, **options).select(*PACKED).collect()]


@pytest.mark.parametrize("size", [4096, 64])
def test_packing_holds_the_librarys_ids(spark, size):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [(-1 - k, t) for k, t in enumerate(ODD_TEXTS)] + docs
    df = clash(spark.createDataFrame(doc_rows(texts), DOC_SCHEMA).repartition(3))
    n, least = check_packing(pack(df, size=size), texts, size)
    assert n <= 1.02 * least + 1


def test_packing_is_tight_when_many_tasks_leave_open_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs.repartition(24))
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    n, least = check_packing(rows, texts, 4096)
    assert n <= 1.01 * least + 1


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    texts = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    check_packing(pack(odd_docs), texts, 4096)
    assert pack(no_docs) == []


def test_best_fit_takes_the_fullest_bin_and_closes_it_first():
    b = best_fit_packing.BestFit(10, 2)
    assert b.add(6, "a") == [] and b.add(7, "b") == []
    assert b.add(3, "c") == [[(0, "b"), (7, "c")]]  # fills the fullest with room exactly
    assert b.add(9, "d") == [] and b.add(8, "e") == [[(0, "d")]]  # a third bin: the fullest closes
    assert [(f, [i for _, i in c]) for f, c in b.rest()] == [(2, ["e"]), (4, ["a"])] and b.n_open == 0
    rng, b, most = random.Random(1), best_fit_packing.BestFit(100, 8), 0
    placed = []
    for k in range(2000):
        placed += b.add(rng.randrange(1, 101), k)
        most = max(most, b.n_open)
    placed += [c for _, c in b.rest()]
    assert most == 8 and sorted(i for c in placed for _, i in c) == list(range(2000))
    with pytest.raises(ValueError):
        b.add(101, "x")


# --- 13 importance resampling --------------------------------------------------------------


def resampled(docs, target, size=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    runs = lambda w: [" ".join(w[i : i + n]) for n in range(1, size + 1) for i in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in runs(words(text))) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in docs:
        w = words(text)
        weight = sum(gain(bucket(f)) for f in runs(w))
        h = None if i is None else int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(runs(w)), weight, score, len(w)))
    able = sorted((r for r in out if r[4] >= min_words and r[3] is not None), key=lambda r: (-r[3], r[0]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in out), key=str)


DRAWN = ["doc_id", "n_features", "weight", "score", "rank"]


@pytest.mark.parametrize("options", [{}, {"size": 3, "buckets": 97, "percent": 35, "min_words": 5}])
def test_resampling_equals_brute_force(spark, options):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [(1_000_000 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(r.doc_id, r.text) for r in docs.collect()] + [(None, "word " * 30)]
    df = clash(spark.createDataFrame(doc_rows(texts), DOC_SCHEMA).repartition(5))
    got = rows_of(importance_resampling.resample(df, bench, **options), *DRAWN)
    assert got == resampled(texts, [r.text for r in bench.collect()], **options)


def test_resampling_of_odd_rows(spark, odd_docs, no_docs):
    texts = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    for target, goal in ((odd_docs, [t for _, t in texts]), (no_docs, [])):
        assert rows_of(importance_resampling.resample(odd_docs, target, min_words=1, percent=60), *DRAWN) == resampled(texts, goal, min_words=1, percent=60)
    assert importance_resampling.resample(no_docs, odd_docs).count() == 0


def test_ranks_have_no_gap_and_break_ties_by_id(spark):
    df = spark.range(5000).selectExpr("id", "id % 3 AS score").repartition(7)
    got = rows_of(importance_resampling.ranked(df, df.score.desc(), "id"), "place", "id")
    want = sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert sorted(got) == list(enumerate(want, 1))


def test_crcs_of_spans():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 600)
    ends = starts + rng.integers(0, 100, 600)
    got = importance_resampling.span_crcs(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]
    assert len(LONG) > 200_000
