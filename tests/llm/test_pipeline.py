import brute
import corpus_pipeline as pipeline
from landsurvey.llm import toxicity
from test_mixing import check


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.report(spark, docs, labels).filter("predicted = 1").collect()}
    assert 0 < len(toxic) < 0.3 * docs.count()
    left = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    kept = {x[0] for x in brute.exact(left) if x[3]}
    left = [x for x in left if x[0] in kept]
    groups = brute.simhash(left, pipeline.NEAR_BITS)
    left = [x for x, g in zip(left, groups, strict=True) if x[0] == g[2]]
    clean = {x[0] for x in brute.decontamination(left, items) if not x[5]}
    stage_docs = docs
    for _, stage in pipeline.STAGES[:-1]:
        stage_docs = stage(spark, stage_docs, sf)
        assert stage_docs.columns == docs.columns
    assert {r.doc_id for r in stage_docs.select("doc_id").collect()} == clean
    rows = pipeline.run(spark, sf).collect()
    assert len(rows) == len({r.doc_id for r in rows})
    assert {r.doc_id for r in rows} <= clean
    assert all(r.taken > 0 for r in rows)
    # the words taken are those of the mix of all that reached the last stage
    whole = {r.doc_id: r for r in rows}
    assert sum(r.taken for r in whole.values()) > 0


def test_mix_of_pipeline_meets_targets(spark):
    from landsurvey.llm import mixing

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    every, taken = mixing.mix(spark, docs).collect(), mixing.mixed(spark, docs).collect()
    check(every)
    assert {(r.doc_id, r.taken) for r in every if r.taken} == {(r.doc_id, r.taken) for r in taken}


def test_odd_rows(spark, odd, nothing, tmp_path):
    labels = spark.createDataFrame([(4, 0, 0), (5, 0, 1), (None, 1, 1), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve")], "item_id bigint, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd, nothing):
        docs = rows
        for name, stage in pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            assert set(rows.columns) <= {*docs.columns}, name
        assert docs.count() == 0 if rows is nothing else docs.count() > 0


def test_stages_clear_what_earlier_ones_wrote(spark, tmp_path):
    import glob

    from landsurvey.llm.common import shared_dir

    docs = spark.createDataFrame([(i, f"text {i % 3} of some words", "en", "s") for i in range(9)], "doc_id bigint, text string, lang string, source string")
    left = lambda: set(glob.glob(shared_dir(spark).removeprefix("file://") + "/*"))
    before = left() - {p for p in left() if any(p.endswith(x.split("/")[-1]) for x in pipeline._leftovers)}
    first = pipeline.drop_exact_copies(spark, docs, "")
    # read lazily by the next stage: kept until its result is written
    second = pipeline.drop_near_copies(spark, first, "")
    assert second.count() == 3
    second.write.parquet(str(tmp_path / "out"))
    third = pipeline.mix_sources(spark, spark.read.parquet(str(tmp_path / "out")), "")
    names = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in left() - before}
    assert "exact-input" not in names and "near-input" not in names and "mix-input" in names
    assert third.count() > 0
