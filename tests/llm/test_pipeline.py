import re
from collections import Counter, defaultdict

import corpus_pipeline
from beadloom.llm import line_dedup, mixing, quality
from tests.llm.test_jaccard import brute
from tests.llm.test_tables import plain_dedup

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage on the rows that its predecessor really wrote, next to a plain version of what it promises."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        found.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        steps[name] = ([r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()])
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns

    before, after = steps["quality_classifier"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    model = quality.train([(r["text"], labels[r["doc_id"]]) for r in before if r["doc_id"] in labels])
    good = {r["doc_id"] for r, s in zip(before, quality.scored(model, [r["text"] for r in before])[0]) if s >= quality.KEEP}
    assert {r["doc_id"] for r in after} == good and len(after) < len(before)

    before, after = steps["line_dedup"]
    plain = dict(plain_dedup([(r["doc_id"], r["text"], r["source"]) for r in before], line_dedup.MIN_SITES, line_dedup.MIN_CHARS))
    was = {r["doc_id"]: r["text"] for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, t in plain.items() if t == was[i] or t.strip()}

    before, after = steps["jaccard_join"]
    roots = brute([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert {r["doc_id"] for r in after} == {i for i, _, root in roots if i == root} and len(after) < len(before)

    before, after = steps["source_mixing"]
    times = Counter(r["doc_id"] for r in after)
    assert set(times) == {r["doc_id"] for r in before} and max(times.values()) <= 2
    size = lambda t: len(re.findall(r"[^ \t\n\x0b\f\r]+", t or ""))
    have, took = Counter(), Counter()
    for r in before:
        have[r["source"]] += size(r["text"])
    for r in after:
        took[r["source"]] += size(r["text"])
    assert all(took[s] <= mixing.MAX_REPEATS * n + 1 for s, n in have.items())

    before, after = steps["best_fit_packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    fill = defaultdict(int)
    for r in after:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048


def test_run_gives_the_last_stage(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
