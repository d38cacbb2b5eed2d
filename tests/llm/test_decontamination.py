import brute
from conftest import LONG, ODD
from landsurvey.llm import decontamination as op
from landsurvey.llm import queries


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = brute.decontamination(docs, items)
    assert any(x[-1] for x in want)
    assert got(queries.op1_decontamination(spark, sf_dir)) == sorted(want, key=repr)


def test_odd_rows_and_short_items(spark, odd, nothing):
    items = [
        (1, "hello"), (2, "Hello, World!"), (22, "hello world"), (3, None), (4, " ... "), (5, "a" * 1000),
        (6, "two three four five six seven eight nine ten eleven"), (7, " ".join(LONG.split()[3000:3050])), (8, "é" * 300),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert got(op.report(spark, odd, bench)) == sorted(brute.decontamination(ODD, items), key=repr)
    assert op.report(spark, nothing, bench).count() == 0
    assert not op.report(spark, odd, bench.limit(0)).filter("contaminated").count()
    clean = op.decontaminate(spark, odd, bench)
    assert clean.columns == odd.columns
    assert clean.count() == sum(not x[-1] for x in brute.decontamination(ODD, items))


def test_shards_agree(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = got(op.report(spark, docs, bench))
    monkeypatch.setattr(op, "SHARD_WINDOWS", 400)
    assert got(op.report(spark, docs, bench)) == one


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    import numpy as np
    from landsurvey.llm import words

    raw = np.frombuffer(("ab " * 500 + LONG[:3000] + " " + "x" * 700).encode(), np.uint8)
    starts, ends = words.word_bounds(raw, words.ALNUM, np.array([0, len(raw)]))
    one = words.word_hashes(raw, starts, ends)
    monkeypatch.setattr(words, "BLOCK", 64)
    assert (words.word_hashes(raw, starts, ends) == one).all()
    assert one[0] == one[7] != one[-1]
