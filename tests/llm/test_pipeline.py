"""The pipeline: its stages, their columns, and that their decisions take effect."""

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import corpus_pipeline
from quarry.llm import exact_dedup, quality_rules
from quarry.llm.queries import QUERIES
from quarry.session import scratch_root
from quarry.sources import files


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = [before]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(spark, stage(spark, docs, sf), name.replace(" ", "-"))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    assert docs.where("n_chars <> length(text)").count() == 0


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    first = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality_rules.judged(first).where("kept").select("doc_id")
    left = exact_dedup.dedup(exact_dedup.arrivals(first.join(kept, "doc_id", "left_semi"))).where("kept")
    allowed = {r["doc_id"] for r in left.collect()}
    out = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} <= allowed


def test_odd_rows_pass_every_stage(spark, odd, empty):
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(spark, stage(spark, docs, ""), name.replace(" ", "-"))
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, "").count()


def folders(spark):
    return set(files.list_children(spark, f"{scratch_root(spark)}/quarry"))


def test_runs_delete_their_own_scratch_alone(spark):
    """Frames of other operators outlive a run; two runs at once don't touch each other's."""
    sf = "/root/testdata/sf0.001"
    before = QUERIES["op7_bagminhash"](spark, sf)
    old = folders(spark)
    with ThreadPoolExecutor(2) as pool:
        runs = list(pool.map(lambda _: Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())), range(2)))
    plain = lambda rows: Counter((r[0], r[1], r[2], r[3]) for r in rows.elements())  # noqa: E731 -- less the sequence
    assert plain(runs[0]) == plain(runs[1]) and sum(runs[0].values()) > 0
    assert before.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    new = folders(spark) - old
    assert len(new) == 2 and all(n.startswith("repeated-substrings") for n in new), new  # what the last stage reads
