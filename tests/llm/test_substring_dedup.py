import random

import brute
import numpy as np
import pytest
from conftest import LONG, ODD
from landsurvey.llm import queries
from landsurvey.llm import substring_dedup as op


def want(docs):
    return sorted(((d, *x) for (d, _), x in zip(docs, brute.repeats([t for _, t in docs]), strict=True)), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = got(queries.op7_substring_dedup(spark, sf_dir))
    assert sum(x[2] for x in found) > 0
    assert found == want(docs)


def test_odd_rows(spark, odd, nothing):
    docs = [(d, t if t != LONG else LONG[:3000]) for d, t in ODD]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, uid int, spans string")
    assert got(op.report(spark, df)) == want(docs)
    assert op.report(spark, nothing).count() == 0
    assert op.report(spark, odd).count() == len(ODD)


def passages(seed, n=60):
    """Texts of few letters that share passages of 150 to 700 bytes, some edited."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abé ") for _ in range(k))
    pool = [word(rng.randrange(150, 700)) for _ in range(8)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            p = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = "Z"
            a = rng.randrange(0, 60)
            parts += [word(rng.randrange(0, 80)), "".join(p[a : len(p) - rng.randrange(0, 60)])]
        out.append((i, "".join(parts)))
    return [*out, (900, "ab" * 400), (901, "ab" * 150), (902, "x" * 199), (903, "x" * 199), (904, "y" * 201)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("kinds", [2000, 3])
def test_shared_passages(spark, monkeypatch, seed, kinds):
    monkeypatch.setattr(op, "KINDS", kinds)
    docs = passages(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert got(op.report(spark, df)) == want(docs)


def test_pieces_and_batches_change_nothing(monkeypatch):
    import pyarrow as pa

    text = "".join(t for _, t in passages(3))
    column = pa.array([text, None, text[:500]])
    def strings(piece):
        monkeypatch.setattr(op, "PIECE", piece)
        seen = set()
        for row, bounds, raw, offset in op.pieces(column):
            a, _, first, last, place, at = op.anchors(raw, bounds)
            for h, x, y, p, r in zip(a, first, last, place, at, strict=True):
                seen |= {(row + r, j - bounds[r] + offset, int(h), p - bounds[r] + offset) for j in range(x, y + 1)}
        return seen
    assert strings(700) == strings(1 << 20)


def test_interval_tree_pairs_every_repeat():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(2, 14)
        core = bytes(rng.choice(b"ab") for _ in range(4))
        lefts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))) for _ in range(n)]
        rights = [core + bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))) for _ in range(n)]
        group = np.array(sorted(rng.randrange(2) for _ in range(n)))
        who, left, right = op.repeated_parts(group, lefts, rights, length=12, gram=4)
        found = {(int(w), o) for w, x, r in zip(who, left, right, strict=True) for o in range(12 - r, x + 1)}
        expect = set()
        for i in range(n):
            for j in range(n):
                if i != j and group[i] == group[j]:
                    for o in range(13):
                        a = (lefts[i][-o:] if o else b"") + rights[i][: 12 - o]
                        b = (lefts[j][-o:] if o else b"") + rights[j][: 12 - o]
                        if len(a) == 12 and o <= min(len(lefts[i]), len(lefts[j]), 8) and 12 - o <= min(len(rights[i]), len(rights[j])) and a == b:
                            expect.add((i, o))
        assert found == expect
