"""The stages of the pipeline against brute force by the rules that they state."""

from collections import defaultdict

import brute
import corpus_pipeline as pipeline
from landsurvey.llm import toxicity
from landsurvey.llm.common import shared_dir
from test_mixing import targets
from test_near_copies import kept

SF = "/root/testdata/sf0.01"


def test_stages_and_run(spark):
    import glob

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    toxic = {r.doc_id for r in toxicity.report(spark, docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    left = [(r.doc_id, r.text) for r in rows.values() if r.doc_id not in toxic]
    unique = {x[0] for x in brute.exact(left) if x[3]}
    left = [x for x in left if x[0] in unique]
    alone = kept(left)
    assert 0 < len(alone) < len(left)
    left = [x for x in left if x[0] in alone]
    clean = {x[0] for x in brute.decontamination(left, items) if not x[5]}
    found = pipeline.run(spark, SF)
    got = {r.doc_id: r for r in found.collect()}
    size, taken = defaultdict(int), defaultdict(int)
    words = {i: len(brute.DARK.findall(rows[i].text or "")) for i in clean}
    for i in clean:
        size[rows[i].source] += words[i]
    for i, r in got.items():
        assert r.text == rows[i].text and r.size == words[i] and 0 < r.taken <= 2 * r.size and r.source_size == size[r.source]
        taken[r.source] += r.taken
    # whole to within one cut document a source: what is not taken is clean and in a source that met its target
    want = targets(size)
    assert set(got) <= clean and all(abs(taken[s] - want[s]) <= 1 for s in size)
    assert {i for i in clean if words[i] and want[rows[i].source] >= size[rows[i].source] + 1} <= set(got)
    # of what stages wrote only the last one's input is left
    assert [p for p in glob.glob(shared_dir(spark).removeprefix("file://") + "/pipeline-*") if "benchmark-decontamination" not in p] == []
