from collections import defaultdict

import brute
from conftest import ODD
from landsurvey.llm import mixing, queries


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Resharing round by round until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s] + 1e-9}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def check(rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    for s, t in targets(sizes).items():
        assert abs(target[s] - t) < 1e-6 * max(1, t)
        assert abs(taken[s] - t) <= 1 + sum(r.source == s for r in rows) * 0.01


def test_targets_are_met(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(spark, docs).collect()
    assert len(rows) == docs.count()
    check(rows)
    again = queries.op5_mixing(spark, sf_dir).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_odd_rows(spark, odd, nothing):
    rows = mixing.mix(spark, odd).collect()
    assert sorted((r.size for r in rows)) == sorted(len(brute.DARK.findall(t or "")) for _, t in ODD)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(r.target - targets(sizes)[r.source]) < 1e-6 for r in rows)
    assert mixing.mix(spark, nothing).count() == 0


def test_repeated_rows_share(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x")] * 10 + [(2, "a b", "y")] * 5, "doc_id bigint, text string, source string")
    rows = mixing.mix(spark, docs, weights=(1, 1), share=0.5).collect()
    assert abs(sum(r.taken for r in rows) - 25) <= 1
    for s in "xy":
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert sum(0 < r.taken < r.size for r in own) <= 1


def test_rows_without_ids_meet_the_target(spark):
    rows = [(None, "word" if i % 2 else f"two w{i % 7}", "x") for i in range(1000)] + [(i, "some more words", "y") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    every = [mixing.mix(spark, docs, weights=(2, 1), share=0.6).collect() for _ in range(2)]
    for rows in every:
        for s in "xy":
            own = [r for r in rows if r.source == s]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 1
            assert sum(0 < r.taken < r.size for r in own) <= 1
    assert sorted((r.size, r.taken) for r in every[0]) == sorted((r.size, r.taken) for r in every[1])
