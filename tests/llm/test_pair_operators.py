"""Operators on pairs and groups of documents, and the pipeline, against brute
force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import DOC_SCHEMA, clash, doc_rows

# --- components ----------------------------------------------------------------


def brute_components(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    from voltide.llm.components import connected_components

    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)] + [(7, 7), (100, 101), (None, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == brute_components({n for e in real for n in e}, real)


# --- 9 n-gram Jaccard join --------------------------------------------------------


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(w))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if size else set()


def brute_classes(pairs, size, percent):
    sets = {k: shingles(t, size) for k, t in pairs}
    ids = [k for k in sets if sets[k]]
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 100 * (n := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - n)
    ]
    return {k: len(x) for k, x in sets.items()}, brute_components(sets, links)


def near_copies(seed):
    """Families of copies that drift to both sides of the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    out = []
    for family in range(12):
        base = [word() for _ in range(rng.choice([3, 8, 30, 90, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += [word() for _ in range(rng.randrange(1 + len(copy) // 8))]
            out.append(" ".join(copy))
    rng.shuffle(out)
    return list(enumerate(out + ["", " \t", "A b", "a B", "a", "one two three"]))


@pytest.mark.parametrize("size,percent,block", [(3, 90, 256), (5, 80, 4)])
def test_jaccard_classes_are_exact(spark, monkeypatch, size, percent, block):
    from voltide.llm import jaccard_join as J

    monkeypatch.setattr(J, "TILE_BLOCK", block)
    pairs = near_copies(size)
    out = J.similarity_classes(clash(spark.createDataFrame(doc_rows(pairs), DOC_SCHEMA).repartition(3)), shingle=size, percent=percent).collect()
    n, comp = brute_classes(pairs, size, percent)
    assert {r.doc_id: r.n_shingles for r in out} == n
    assert {r.doc_id: r.component_id for r in out} == comp
    assert len(set(comp.values())) < len(comp) - 10


def test_segments_keep_every_link():
    from voltide.llm import jaccard_join as J

    rng = np.random.default_rng(3)
    for percent in (80, 90):
        bands = J.Bands(percent)
        for n in (1, 2, 5, 9, 17, 40, 130, 700):
            for _ in range(40):
                x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                cut = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                y = np.unique(np.concatenate([x[rng.permutation(len(x))[cut:]], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 4))).astype(np.uint64)]))
                both = len(np.intersect1d(x, y))
                if len(y) and 100 * both >= percent * (len(x) + len(y) - both):
                    assert len(np.intersect1d(bands.keys(x), bands.keys(y)))
                    a, b = J.folded([J.parity_bitmap(x), J.parity_bitmap(y)])
                    assert np.bitwise_count(a ^ b).sum() <= len(x) + len(y) - 2 * both


def test_jaccard_edges(spark, odd_docs, no_docs):
    from voltide.llm import jaccard_join as J

    out = J.similarity_classes(odd_docs).collect()
    comp = {r.doc_id: r.component_id for r in out}
    assert len(out) == 9 and comp == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, None: 5}
    kept = J.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 4, 5, 7, None]
    assert J.similarity_classes(no_docs).count() == 0


# --- 5 substring dedup --------------------------------------------------------------


def test_shared_passages(spark, odd_docs, no_docs):
    from voltide.llm import substring_dedup as S

    rng = random.Random(7)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage, fuzzy = words(60), words(120)
    changed = [w if k % 17 else "new" for k, w in enumerate(fuzzy) if k % 29 != 5]
    texts = {1: words(80) + passage + words(20), 2: words(5) + passage, 3: words(30) + passage + words(200), 4: words(300), 5: words(40) + fuzzy + words(40), 6: words(9) + changed + words(9), 7: words(20) + passage[:40], 8: words(90)}
    texts[9] = texts[8]
    d = clash(spark.createDataFrame(doc_rows([(k, ", ".join(t).upper() if k == 2 else " ".join(t)) for k, t in texts.items()]), DOC_SCHEMA))
    got = {(r.doc_id, r.other_id): r for r in S.shared_passages(d).collect()}
    assert set(got) == {(2, 1), (3, 1), (6, 5), (9, 8)}
    assert [*got[2, 1][1:3], *got[2, 1][4:]] == [5, 65, 80, 140, 60]
    assert [*got[3, 1][1:3], *got[3, 1][4:]] == [30, 90, 80, 140, 60]
    r = got[6, 5]
    assert r.start_word <= 16 and r.end_word >= 9 + len(changed) - 4 and r.other_start <= 48 and r.other_end >= 154
    assert S.shared_passages(odd_docs).where("doc_id = other_id").isEmpty()
    assert S.shared_passages(no_docs).count() == 0


def test_chains_are_optimal():
    from voltide.llm import substring_dedup as S

    rng = np.random.default_rng(4)
    for _ in range(150):
        n = int(rng.integers(1, 12))
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        order = np.lexsort((y, x))
        best = [0.0] * n
        for j in order:
            best[j] = 8.0
            for i in range(n):
                if x[i] < x[j] and y[i] < y[j]:
                    dx, dy = int(x[j] - x[i]), int(y[j] - y[i])
                    if best[i] - 0.1 * (dx + dy) > 0:
                        best[j] = max(best[j], best[i] - 0.1 * (dx + dy) + min(8.0, dx, dy))
        found = S.chains(x, y)
        assert sorted(i for _, c in found for i in c) == list(range(n))
        for _, c in found:
            assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
        if (np.abs(np.subtract.outer(x, x)) + np.eye(n) * 99 >= 8).all() and (np.abs(np.subtract.outer(y, y)) + np.eye(n) * 99 >= 8).all():
            assert abs(found[0][0] - max(best)) < 1e-9


@pytest.mark.parametrize("sizes", [(60, 60, 60), (100, 100, 60), (120, 150, 60), (400, 400, 400), (55, 5000, 3000)])
def test_passages_around_unlike_text(spark, sizes):
    from voltide.llm import substring_dedup as S

    rng = random.Random(11)
    words = lambda n: [f"v{rng.randrange(300)}" for _ in range(n)]
    size, one, two = sizes
    head, foot = words(size), words(size)
    a, b = head + words(one) + foot, head + words(two) + foot
    x = np.array([0, 10, 30, size + one, size + one + 30])
    y = np.where(x < size, x, x - one + two)
    u, v = S.aligned_words(*(np.array([int(w[1:]) for w in t], np.uint64) for t in (a, b)), x, y)
    found = sorted(S.pieces(u, v))
    assert len(found) == 2
    for (s, e, t, f, n), at, other in zip(found, (0, size + one), (0, size + two), strict=True):
        # Chance words next to a passage may be aligned with it.
        assert abs(s - at) <= 4 and abs(e - at - size) <= 4 and abs(t - other) <= 4 and abs(f - other - size) <= 4 and n >= size
    d = spark.createDataFrame(doc_rows([(1, " ".join(a)), (2, " ".join(b))]), DOC_SCHEMA)
    assert S.shared_passages(d).count() == 2


def test_passages_held_in_part_by_earlier_documents(spark):
    from voltide.llm import substring_dedup as S

    rng = random.Random(14)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    one, two, three, four = words(55), words(60), words(120), words(50)
    texts = {
        1: words(20) + one[:45] + words(9), 2: words(5) + one + words(30), 3: words(40) + one + words(5),
        11: two[:35] + words(40), 12: words(40) + two[25:], 13: words(7) + two + words(8), 14: words(30) + two + words(8),
        21: words(5) + three[:100] + words(5), 22: words(15) + three + words(5), 23: words(3) + three + words(5),
        31: words(30) + four + words(4), 32: words(2) + four + words(60) + four + words(3),
    }
    d = spark.createDataFrame(doc_rows([(k, " ".join(t)) for k, t in texts.items()]), DOC_SCHEMA)
    got = {tuple(r)[:6] for r in S.shared_passages(d).collect()}
    assert {(3, 40, 95, 2, 5, 60), (14, 30, 90, 13, 7, 67), (23, 3, 123, 22, 15, 135)} <= got
    assert {(32, 2, 52, 31, 30, 80), (32, 112, 162, 31, 30, 80)} <= got


def test_passages_reach_the_least_copy(spark):
    from voltide.llm import substring_dedup as S

    rng = random.Random(12)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage, late = words(60), words(70)
    copy = words(30) + passage + words(30) + late
    rows = [(9, copy), (5, copy), (3, words(20) + passage), (7, late + words(40))]
    d = spark.createDataFrame(doc_rows([(k, " ".join(t)) for k, t in rows]), DOC_SCHEMA).coalesce(1)
    assert sorted(tuple(r) for r in S.shared_passages(d).collect()) == [(5, 30, 90, 3, 20, 80, 60), (7, 0, 70, 5, 120, 190, 70), (9, 0, 190, 5, 0, 190, 190)]


@pytest.mark.parametrize("copies", [10, 60])
def test_near_copies_meet_few_partners(spark, copies):
    """Six changed words in 400: passages per document do not grow with the group,
    and every copy is covered by what it shares with earlier ones."""
    from voltide.llm import substring_dedup as S

    rng = random.Random(12)
    base, rows = [f"b{k}" for k in range(400)], []
    for i in range(copies):
        words = list(base)
        for k in rng.sample(range(400), 6):
            words[k] = f"x{i}n{k}"
        rows.append((i, " ".join(words)))
    d = spark.createDataFrame(doc_rows(rows), DOC_SCHEMA).repartition(3)
    shared = {}
    for r in S.shared_passages(d).collect():
        shared.setdefault(r.doc_id, []).append(r)
    assert sorted(shared) == list(range(1, copies))
    assert sum(map(len, shared.values())) <= 2 * copies
    for found in shared.values():
        covered = set().union(*(range(r.start_word, r.end_word) for r in found))
        assert len(covered) >= 0.95 * 400


def test_partners_cover_what_each_holds(spark):
    """Words held by two earlier documents in part keep both as partners."""
    from voltide.llm import substring_dedup as S

    at = np.arange(0, 71)
    other = np.where(at <= 50, 1, 2)
    parts = S.covering_partners(other, at, at + 1000 * other, np.ones(71, bool))
    assert [set(other[p].tolist()) for p in parts] == [{1}, {2}]
    assert sorted(np.concatenate(parts).tolist()) == list(range(71))
    inside = S.covering_partners(np.array([1] * 71 + [2] * 3), np.concatenate([at, [10, 11, 12]]), np.concatenate([at, [10, 11, 12]]), np.ones(74, bool))
    assert len(inside) == 1 and len(inside[0]) == 71


def test_a_row_without_an_id_keeps_no_set_from_the_others(spark):
    from voltide.llm import jaccard_join as J

    rng = random.Random(13)
    text = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    near = [*text[:-1], "other"]
    rows = [(None, " ".join(text)), (4, " ".join(text)), (8, " ".join(near))]
    d = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.component_id) for r in J.similarity_classes(d).collect()}
    assert got == {(None, 4), (4, 4), (8, 4)}


def test_common_words_and_pieces(monkeypatch):
    from voltide.llm import substring_dedup as S

    rng = np.random.default_rng(5)
    for bits in (1 << 25, 20):
        monkeypatch.setattr(S, "MAX_BITS", bits)
        for _ in range(60):
            a, b = (rng.integers(0, 5, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
            best = np.zeros((len(a) + 1, len(b) + 1), int)
            for i in range(len(a)):
                for j in range(len(b)):
                    best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
            x, y = S.common_words(a, b)
            assert len(x) == best[-1, -1] and (a[x] == b[y]).all() and (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
    # 40 and 40 like words around 11 unlike ones are one passage of 88 percent.
    x = np.r_[0:40, 51:91]
    assert S.pieces(x, x) == [(0, 91, 0, 91, 80)]
    # Of a long stretch of 75 percent the part of 80 percent is found.
    x = np.r_[np.flatnonzero(np.arange(200) % 4), 200:300]
    (s, e, *_, n), = S.pieces(x, x)
    assert e == 300 and 75 <= 300 - s <= 200 + 100 and n >= 0.8 * (e - s)


# --- 6 WARC ------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    from voltide.llm import warc as W
    from voltide.session import scratch_path

    big = "é" * 50_001 + "\r\n\r\nWARC/1.1\r\n" * 3000
    pages = {1: "x", 2: "x", 3: None, 4: "", 5: big, 6: big, 7: "y" * 16_000, 8: "0\r\n\r\n", 9: "\x00\r\n"}
    rows = [(k, "http://a/ b\r\nX: y" if k == 1 else None, v) for k, v in pages.items()] + [(None, "u", "x"), (7, "u", pages[7])]
    d = clash(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    path = scratch_path(spark, "warc-test")
    W.write_archive(d, path, segment=5000)
    responses, revisits = W.read_archive(spark, path)
    assert responses.count() == 7
    payload = {r.page_id: bytes(r.payload) for r in responses.collect()}
    assert payload == {k: (pages[k] or "").encode() for k in (2, 4, 6, 7, 8, 9)}
    assert {(r.page_id, r.refers_to) for r in revisits.collect()} == {(1, 2), (None, 2), (3, 4), (5, 6)}
    index = W.archive_index(spark, path).collect()
    assert len(index) == len(rows)
    for r in index:
        text = pages.get(r.page_id, "x") or ""
        assert r.payload_bytes == len(text.encode()) and r.payload_digest == W.payload_digest(text.encode())
    empty = scratch_path(spark, "warc-test")
    W.write_archive(d.limit(0), empty)
    assert W.archive_index(spark, empty).count() == 0


def test_damaged_archives():
    from voltide.llm import warc as W

    payload = bytes(range(256)) * 40
    assert W.dechunked(W.chunked(payload, 100)) == payload and W.dechunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    records = list(W.page_records(1, "u", payload, None, False, 1000))
    data = b"".join(r + W.END for r in records)
    parts = [{"segment": int(f["warc-segment-number"]), "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, "payload": b} for f, b in W.parse(data)]
    assert len(parts) > 5 and W.reassemble(parts[::-1]) == payload
    for bad in (parts[1:], parts[:-1], parts + parts[-1:], [*parts[:-1], parts[-1] | {"total": 5}]):
        with pytest.raises(W.DamagedArchive):
            W.reassemble(bad)
    for cut in (data[:-1], data[5:], data[: len(data) // 2]):
        with pytest.raises((W.DamagedArchive, ValueError)):
            list(W.parse(cut))
    with pytest.raises(W.DamagedArchive):
        W.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


# --- 3 quotation linking ------------------------------------------------------------------------


def test_quotes_link_replies(spark):
    from voltide.llm import quotation as Q

    rows = [
        (1, 0, "user", "How do I sort a very large table?\n\nAnd how do I join it?"),
        (1, 1, "assistant", "> How do I sort a very large table?\nUse repartitionByRange here.\n\n> And how do I join it?\nUse a sort-merge join."),
        (1, 2, "user", "On Monday Bob wrote:\n> Use repartitionByRange here.\n>\n> > how do i  SORT a very large table?\nThanks a lot for that."),
        (1, 3, "assistant", ">> Use repartitionByRange here.\n> Thanks a lot for that.\nWelcome, anytime you like"),
        (1, 4, "user", "> ok\nfine"),
        (1, 4, "user", "> ok\nfine"),
        (1, 5, None, None),
        (2, 0, "u", ""),
        (None, 1, "u", "> x"),
        (2, None, "u", "hello there my friend"),
        (2, 1, "u", "> How do I sort a very large table?\nno"),
        (2, 2, "u", "> " + "later words of one message\nx"),
        (2, 3, "u", "later words of one message"),
    ]
    d = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = Q.link_quotes(d)
    got = {(r.conv_id, r.turn): (r.clean_text, r.quote_depth, r.n_quotes, r.n_linked, r.parent_turn, r.thread_turn, r.reply_depth) for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1, 0] == (rows[0][3], 0, 0, 0, None, 0, 0)
    assert got[1, 1] == ("Use repartitionByRange here.\n\nUse a sort-merge join.", 1, 2, 2, 0, 0, 1)
    assert got[1, 2] == ("Thanks a lot for that.", 2, 2, 2, 1, 0, 2)
    assert got[1, 3] == ("Welcome, anytime you like", 2, 2, 2, 2, 0, 3)
    assert got[1, 4] == ("fine", 1, 0, 0, None, 4, 0)
    assert got[1, 5] == got[2, 0][:5] + (5, 0) == ("", 0, 0, 0, None, 5, 0)
    assert got[None, 1][4:] == (None, None, 0) and got[2, None][0] == "hello there my friend"
    assert got[2, 1] == ("no", 1, 1, 0, None, 1, 0)  # the original is in another conversation
    assert got[2, 2] == ("x", 1, 1, 0, None, 2, 0)  # the original comes later
    ordered = [(r.conv_id, r.thread_turn, r.turn) for r in Q.reply_ordered(out).where("conv_id = 1").collect()]
    assert ordered == sorted(ordered)
    assert Q.link_quotes(d.limit(0)).count() == 0


# --- pipeline -----------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as C
    from tests.llm.test_text_operators import brute_counts, brute_hits, brute_secrets
    from voltide.llm import sentencepiece_bpe
    from voltide.llm.queries import piece_model
    from voltide.session import materialize

    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in C.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece encoding"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    with open(piece_model(), "rb") as f:
        library = sentencepiece_bpe.PieceVocabulary(f.read()).library
    tables = [docs]
    for name, stage in C.STAGES:
        tables.append(materialize(stage(spark, tables[-1], sf), "test-stage"))
    before = [{r.doc_id: r for r in t.collect()} for t in tables]
    assert all(t.columns == docs.columns for t in tables[:-1])
    texts = [{k: r.text for k, r in b.items()} for b in before[:-1]]
    failed = {k for k, t in texts[0].items() if (c := brute_counts(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
    assert not failed & set(texts[1]) and set(texts[0]) - failed - set(texts[1]) < {k for k, t in texts[0].items() if re.search(r"[#*$%&|<>!]{2}", t)}
    _, comp = brute_classes(sorted(texts[1].items()), 5, 80)
    assert set(texts[2]) == {k for k, c in comp.items() if k == c}
    dirty = {k for k, t in texts[2].items() if (h := brute_hits(t, items))[1] and 20 * h[1] >= h[0]}
    assert set(texts[3]) == set(texts[2]) - dirty
    for k, t in texts[3].items():
        want, at = "", 0
        for s, _, e, _ in brute_secrets(t):
            if s > at or at == 0:
                want += t[at:s] + "[SECRET]"
            at = max(at, e)
        assert texts[4][k] == want + t[at:] or "[SECRET]" in texts[4][k]
    assert set(before[5]) == set(texts[4])
    for k, r in before[5].items():
        assert r.n_tokens == len(library.encode(texts[4][k]))


@pytest.mark.parametrize("period", [12, 30])
def test_repeats_inside_two_texts_are_told_once(spark, period):
    """Texts that repeat a line share any two of its places; passages must not grow
    with the square of the repeats, and all shared words stay told."""
    from voltide.llm import substring_dedup as S

    line = [f"w{k}" for k in range(period)]
    repeats = {1: 40, 2: 35, 3: 20, 4: 44}
    rows = [(i, " ".join([f"h{i}x{k}" for k in range(9)] + line * n + [f"t{i}x{k}" for k in range(9)])) for i, n in repeats.items()]
    got = S.shared_passages(spark.createDataFrame(doc_rows(rows), DOC_SCHEMA)).collect()
    told = {}
    for r in got:
        told.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert {i: len(v) for i, v in told.items()} == {i: period * repeats[i] for i in (2, 3, 4)}
    assert len(got) <= 10


def test_changed_passages_reach_beyond_the_least_document(spark):
    """Documents 2 and 3 share a passage with changes. The seeds of it lead to document
    1, which holds them too, but far apart: the pair 3 and 2 must be found all the same."""
    from voltide.llm import substring_dedup as S

    rng = random.Random(21)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(120)
    changed = [w if k % 24 else f"new{k}" for k, w in enumerate(passage)]
    apart = [w for k in range(0, 120, 24) for w in [*words(90), *passage[k + 1 : k + 24]]]
    texts = {1: apart + words(40), 2: words(30) + passage + words(30), 3: words(9) + changed + words(50)}
    d = spark.createDataFrame(doc_rows([(k, " ".join(t)) for k, t in texts.items()]), DOC_SCHEMA)
    got = [tuple(r) for r in S.shared_passages(d).collect()]
    assert len(got) == 1 and (got[0][0], got[0][3]) == (3, 2)
    assert got[0][1] <= 10 and got[0][2] >= 9 + 116 and got[0][6] >= 110


def test_seeds_apart_leave_their_words_to_other_partners():
    from voltide.llm import substring_dedup as S

    x = np.arange(0, 100, 20)
    other, y = np.repeat([1, 2], 5), np.concatenate([x * 50, x + 7])
    parts = S.covering_partners(other, np.concatenate([x, x]), y, np.zeros(10, bool))
    assert sorted(int(other[p[0]]) for p in parts) == [1, 2]
