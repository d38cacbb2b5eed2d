import brute
from conftest import ODD
from landsurvey.llm import exact_dedup as op
from landsurvey.llm import queries
from landsurvey.llm.common import fresh_path


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows(queries.op10_exact_dedup(spark, sf_dir)) == sorted(brute.exact(docs), key=repr)


def test_odd_rows(spark, odd, nothing):
    found = rows(op.exact_duplicates(spark, odd))
    want = brute.exact([(d if d is not None else -1, t) for d, t in ODD])
    assert [x[1:3] for x in found if x[0] == 10] == [(10, 2)]
    # of the repeated row with id 6 one stays
    assert sum(x[3] for x in found) == sum(x[3] for x in want) - 1
    assert op.exact_duplicates(spark, nothing).count() == 0
    kept = op.dedup(spark, odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({x[4] for x in want})


def test_index_persists(spark):
    place = fresh_path(spark, "index-test")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id bigint, text string")
    two = spark.createDataFrame([(9, "a"), (8, "c"), (7, "C")], "doc_id bigint, text string")
    keep = lambda df: {r.doc_id: (r.keep_id, r.kept) for r in df.collect()}
    first = keep(op.exact_duplicates(spark, one, place))
    assert first == {1: (3, False), 2: (2, True), 3: (3, True)}
    assert keep(op.exact_duplicates(spark, two, place)) == {9: (3, False), 8: (8, True), 7: (8, False)}
    # adding the first batch again changes nothing
    assert keep(op.exact_duplicates(spark, one, place)) == first
    assert op.DigestIndex(spark, place).rows().count() == 3
    # an index keeps its number of buckets
    small = fresh_path(spark, "index-test")
    op.DigestIndex(spark, small, 5)
    op.DigestIndex(spark, small).add(spark.createDataFrame([(bytearray(b"x"), 1)], "digest binary, keep_id bigint"))
    again = op.DigestIndex(spark, small, 7)
    assert again.buckets == 5 and again.rows().count() == 1


def test_rows_without_ids_stay_once(spark):
    place = fresh_path(spark, "index-test")
    rows = spark.createDataFrame([(None, "same"), (None, "same"), (4, "other")], "doc_id bigint, text string")
    kept = lambda: sorted((r.text_sha256 for r in op.exact_duplicates(spark, rows, place).collect() if r.kept))
    assert kept() == sorted([brute.sha("same"), brute.sha("other")])
    assert kept() == [brute.sha("other")]


def test_index_is_compacted(spark, monkeypatch):
    monkeypatch.setattr(op, "MOST_APPENDS", 2)
    monkeypatch.setattr(op, "ROWS_A_BUCKET", 5)
    monkeypatch.setattr(op, "LEAST_BUCKETS", 2)
    place, sizes, tables = fresh_path(spark, "index-test"), [], {t.name for t in spark.catalog.listTables()}
    for k in range(6):
        batch = spark.createDataFrame([(i, f"text {i}") for i in range(10 * k, 10 * k + 12)], "doc_id bigint, text string")
        rows = {r.doc_id: r.kept for r in op.exact_duplicates(spark, batch, place).collect()}
        assert rows == dict.fromkeys(range(10 * k, 10 * k + 12), True)
        index = op.DigestIndex(spark, place)
        assert index.rows().count() == 10 * k + 12
        sizes.append(index.buckets)
        index.close()
    assert sizes[-1] > sizes[0] and {t.name for t in spark.catalog.listTables()} == tables
