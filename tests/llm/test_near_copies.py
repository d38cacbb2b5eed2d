import random

import brute
import numpy as np
import corpus_pipeline as pipeline
from landsurvey.llm import near_copies
from pyspark.sql import functions as F


def shingles(text, width=5):
    w = brute.DARK.findall((text or "").translate(brute.LOW))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def kept(docs):
    """The smallest id of each group that chains of similarity 0.8 join."""
    sets, group = [shingles(t) for _, t in docs], list(range(len(docs)))
    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return set(least.values())


def stage_ids(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    return sorted(r.doc_id for r in pipeline.drop_near_copies(spark, df, "").collect())


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    unique = {x[0] for x in brute.exact([tuple(d) for d in docs]) if x[3]}
    docs = [tuple(d) for d in docs if d.doc_id in unique]
    assert stage_ids(spark, docs) == sorted(kept(docs))


def test_crowds_and_chains(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    docs = []
    for edits in (1, 2, 4, 9):
        base = [word() for _ in range(120)]
        for _ in range(40):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(len(text))] = word()
            docs.append((1000 - len(docs), " ".join(text)))
    docs += [(2000, None), (2001, " \t"), (2002, "Few words"), (2003, "few  words"), (2004, "other words")]
    want = sorted(kept(docs))
    assert 4 < len(want) < 120
    for sample in (20_000, 50):
        monkeypatch.setattr(near_copies, "SAMPLE_TEXTS", sample)
        assert stage_ids(spark, docs) == want


def test_repeats_count_once(spark):
    """A line that one copy repeats often changes its text and not its set."""
    rng = random.Random(9)
    docs = []
    for k in range(12):
        base = [f"w{rng.randrange(9000)}" for _ in range(150)]
        line = " ".join(f"l{rng.randrange(9000)}" for _ in range(8))
        edited = list(base)
        edited[rng.randrange(20, 130)] = "other"
        docs += [(10 * k, f"{' '.join(base)} {line}"), (10 * k + 1, " ".join(edited) + f" {line}" * (2 + 9 * k))]
    want = sorted(kept(docs))
    assert len(want) == 12
    assert stage_ids(spark, docs) == want


def test_edited_copies_below_the_similarity_seldom_meet(spark, monkeypatch):
    """Copies of one text with edits of their own, just under 0.8 from each other, are a
    crowd; few of its pairs may be left to compare whole, and none that is similar."""
    rng = random.Random(5)
    base, docs = [f"w{rng.randrange(9000)}" for _ in range(400)], []
    for i in range(80):
        again = i % 8 == 7  # of the document before
        text = docs[-1][1].split() if again else list(base)
        for at in rng.sample(range(len(text)), 1 if again else 6):
            text[at] = f"e{i}x{at}"
        docs.append((i, " ".join(text)))
    compared, whole = [], near_copies.verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return whole(pairs, sets)

    monkeypatch.setattr(near_copies, "verified", counted)
    monkeypatch.setattr(near_copies, "LARGE", 16, raising=False)
    want = sorted(kept(docs))
    assert 60 < len(want) < 80
    assert stage_ids(spark, docs) == want
    assert sum(compared[1:]) < 80 * 79 / 2 / 5


def test_sketches_differ_in_no_more_bits_than_sets_in_members(spark):
    """Of sets of all sizes, those of equal sketch length and those on both sides of a power of two."""
    rng = np.random.default_rng(6)
    rows = []
    for size in (1, 5, 32, 60, 64, 250, 256, 511, 512, 4000, 20_000):
        for away in (0, 1, size // 9, size // 5, size // 4):
            a = rng.integers(-(1 << 63), (1 << 63) - 1, size)
            b = np.concatenate([a[away:], rng.integers(-(1 << 63), (1 << 63) - 1, max(1, away // 2))])
            differ = len(np.setxor1d(a, b))
            rows.append((differ, *[near_copies.odd_sketch(np.unique(s)).tolist() for s in (a, b)]))
    df = spark.createDataFrame(rows, "differ int, a array<bigint>, b array<bigint>")
    found = df.select("differ", near_copies.differing(F.col("a"), F.col("b")).alias("one"), near_copies.differing(F.col("b"), F.col("a")).alias("two")).collect()
    assert all(r.one == r.two <= r.differ for r in found)
    assert all(r.one > 0.7 * r.differ for r in found if 40 <= r.differ < 4000)  # by chance few fall on one place
    assert {len(r[1]) == len(r[2]) for r in rows} == {True, False}


def test_open_pairs_move_few_bytes(spark):
    """Members of a crowd in groups of their own: what each moves is far less than its shingles."""
    rng = np.random.default_rng(8)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 2000)
    rows, sketches = [], []
    for v in range(40):
        s = np.unique(np.concatenate([base[: 2000 - 400], rng.integers(-(1 << 63), (1 << 63) - 1, 400)]))
        rows += [(int(key), 40, (v, len(s), at, 0, 0)) for at, key in enumerate(sorted(base[:30]))]
        sketches.append((v, near_copies.odd_sketch(s).tolist()))
    crowds = spark.createDataFrame(rows, "key bigint, n bigint, x struct<v: bigint, size: bigint, at: int, fp: bigint, fq: bigint>")
    labels = spark.createDataFrame([(0, 0)], "v bigint, label bigint")
    found = near_copies.open_pairs(crowds, labels, spark.createDataFrame(sketches, "v bigint, sketch array<bigint>"))
    assert found.collect() == []  # similarity 0.67
    assert max(len(s) for _, s in sketches) * 64 <= 4 * 2000
    near = near_copies.open_pairs(crowds, labels, spark.createDataFrame([(v, sketches[0][1]) for v in range(40)], "v bigint, sketch array<bigint>"))
    assert sorted((r.a, r.b) for r in near.collect()) == [(a, b) for a in range(40) for b in range(a + 1, 40)]
    assert "ReusedExchange" in near._jdf.queryExecution().executedPlan().toString()  # moved once, for both sides


def test_open_pairs_are_few_in_crowds_of_any_size(spark, monkeypatch):
    """Edited copies just under 0.8 from each other, as above, in a crowd of 60."""
    rng = random.Random(11)
    base, docs = [f"w{rng.randrange(9000)}" for _ in range(400)], []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(len(text)), 6):
            text[at] = f"e{i}x{at}"
        docs.append((i, " ".join(text)))
    compared, whole = [], near_copies.verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return whole(pairs, sets)

    monkeypatch.setattr(near_copies, "verified", counted)
    assert stage_ids(spark, docs) == sorted(kept(docs))
    assert sum(compared[1:]) < 60 * 59 / 2 / 10
