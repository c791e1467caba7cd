"""Pairs of unlike sets must not grow with the square of a tile."""

import numpy as np

from voltide.llm import jaccard_join as J


def test_bitmaps_refuse_unlike_sets_of_any_size():
    rng = np.random.default_rng(5)
    for n in (700, 1000, 1023):
        sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(300)]
        words = J.folded([J.parity_bitmap(s, percent=80) for s in sets])
        x, _ = J.allowed(np.arange(300), np.full(300, n), words, 80)
        assert len(x) == 0


def test_bitmaps_allow_every_linked_pair():
    rng = np.random.default_rng(6)
    for n in (40, 500, 1023):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for percent in (80, 90):
            gone = 2 * n * (100 - percent) // (100 + percent) // 2
            other = np.concatenate([base[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)])
            common = n - gone
            if 100 * common < percent * (2 * n - common):
                continue
            for wide in (False, True):
                words = J.folded([J.parity_bitmap(np.unique(v), wide, percent) for v in (base, other)])
                assert len(J.allowed(np.arange(2), np.full(2, n), words, percent)[0]) == 1


def test_keys_of_a_row_stay_together(spark):
    texts = [" ".join(f"w{i}_{k}" for k in range(60)) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    ids = [r["id"] for r in J.sketch(docs, "doc_id", "text", 3, 90).where("tile IS NOT NULL").select("id").collect()]
    assert len(ids) > 100 and ids == sorted(ids)


def test_texts_that_no_pair_asks_for_are_not_shuffled(spark):
    """Of 5000 texts 40 are wanted: these come, and hardly any other is shuffled."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in [*range(5000), 7, None]], "id long, text string")
    ids = docs.where("id % 125 = 7").select("id").distinct()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = J.wanted_rows(docs, ids)
        assert sorted(map(tuple, got.collect())) == sorted([(7, "text 7"), *((i, f"text {i}") for i in range(7, 5000, 125))])
        assert got.columns == ["id", "text"] and J.wanted_rows(docs, ids.where("id < 0")).count() == 0
        # The look at the bits comes before the shuffle.
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("getbit") and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
