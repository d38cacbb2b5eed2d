import random

import brute
from conftest import ODD
from landsurvey.llm import queries, simhash


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op2_simhash(spark, sf)) == sorted(brute.simhash(docs), key=repr)


def test_odd_rows(spark, odd, nothing):
    assert got(simhash.report(spark, odd)) == sorted(brute.simhash(ODD), key=repr)
    assert simhash.report(spark, nothing).count() == 0
    kept = simhash.dedup(spark, odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({x[2] for x in brute.simhash(ODD)})


def test_blocks_change_no_fingerprint(monkeypatch):
    rng = random.Random(2)
    for i in range(60):
        text = "".join(rng.choice("ab \n\té") for _ in range(rng.randrange(0, 400))).encode()
        for width in (1, 3, 5):
            monkeypatch.setattr(simhash, "BLOCK", 1 << 20)
            whole = simhash.fingerprint(text, width)
            assert whole == brute.fingerprint(text.decode(), width)
            monkeypatch.setattr(simhash, "BLOCK", 1 + i % 40)
            assert simhash.fingerprint(text, width) == whole


def test_links_reach_the_stated_distance(spark):
    base = 0x0123456789ABCDEF
    for bits in (1, 3, 5):
        flips = [base] + [base ^ sum({1 << (i * 7 + j * 11) % 64 for j in range(n)}) for n in range(1, 8) for i in range(9)]
        signed = sorted({x - (1 << 64) if x >> 63 else x for x in flips})
        df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert set(map(tuple, simhash.links(df, bits).collect())) == want


def test_clusters_of_crowds_are_those_of_all_links(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        base = rng.getrandbits(63)
        for _ in range(60):
            prints.add(base ^ sum({1 << rng.randrange(63) for _ in range(rng.randrange(0, 4))}))
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    for bits in (3, 5):
        every = {v: x for v, x in simhash.components(spark, simhash.links(df, bits)).collect()}
        got = {v: x for v, x in simhash.clusters(spark, df, bits).collect()}
        assert set(got) == prints
        group = lambda names: {frozenset(k for k in names if names[k] == x) for x in names.values()}
        assert group(got) == group({p: every.get(p, p) for p in prints})
        assert simhash.hub_links(df, bits).count() <= 2 * len(prints)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {v: x for v, x in simhash.components(spark, edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
