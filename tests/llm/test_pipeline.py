from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest

import __spark_entry__
from pitchlake.llm.quality import accepted_documents, quality_scores
from pitchlake.llm.queries import ORACLES, QUERIES
from pitchlake.llm.shared import materialize

from .conftest import awkward_rows
from .test_dedup import near_by_hand
from .test_shards_and_mixes import n_words, targets
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns over the smallest documents, with what it was given."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs = stage(spark, docs, SF).cache()
        out.append((name, given, docs))
    return out


def test_stages_are_the_five_in_order(stages):
    assert [n for n, _, _ in stages] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, given, kept in stages[:-1]:
        assert kept.columns == given.columns and 0 < kept.count()


def test_each_stage_equals_brute_force_on_its_input(spark, stages):
    quality, exact, near, mixing, packing = [(given.collect(), kept.collect()) for _, given, kept in stages]
    scores = {r.doc_id: r.predicted for r in quality_scores(stages[0][1], spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(quality[1]) == sorted(r for r in quality[0] if scores[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in quality[1]}
    assert sum((d in kept) == q for d, q in labels.items()) / len(labels) > 0.95

    first = {}
    for r in exact[0]:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        first[norm] = min(first.get(norm, r.doc_id), r.doc_id)
    assert sorted(exact[1]) == sorted(r for r in exact[0] if r.doc_id in set(first.values()))
    stays = {d for d, _, _, keep in near_by_hand([(r.doc_id, r.text) for r in near[0]]) if keep}
    assert sorted(near[1]) == sorted(r for r in near[0] if r.doc_id in stays)

    times, sizes, taken = Counter(r.doc_id for r in mixing[1]), defaultdict(int), defaultdict(int)
    for r in mixing[0]:
        sizes[r.source] += n_words(r.text)
        taken[r.source] += times[r.doc_id] * n_words(r.text)
    most = max(n_words(r.text) for r in mixing[0])
    assert set(times.values()) <= {1, 2, 3} and set(mixing[1]) <= set(mixing[0])
    assert all(abs(taken[s] - t) <= most for s, t in targets(dict(sizes)).items())
    check_packing(packing[1], [(r.doc_id, r.text) for r in packing[0]], 2048)


def test_run_is_its_stages(spark, stages):
    pieces, mixed = corpus_pipeline.run(spark, SF).collect(), stages[-1][1].collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == Counter((r.doc_id, r.doc_tokens) for r in stages[-1][2].collect() if r.start == 0)
    check_packing(pieces, [(r.doc_id, r.text) for r in mixed], 2048)


def _folder(spark, tmp_path, docs, labels):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    return f"file://{tmp_path}"


def test_awkward_tables_run_to_the_end(spark, tmp_path):
    docs = [(r[0], r[1], r[2], r[3], r[4]) for r in awkward_rows()]
    folder = _folder(spark, tmp_path, docs, [])
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = materialize(stage(spark, kept, folder), "awkward")
    # 3 and a row without an id have the text of 1, 7 that of 6, and 15 that of 14; 2 is near 1, 10 near 9, and 12 near 11.
    assert sorted(r.doc_id for r in kept.collect()) == [-3, 1, 4, 5, 6, 8, 9, 11, 13, 14]
    pieces = corpus_pipeline.run(spark, folder).collect()
    # The mix takes less than all of the source with the very long text, and no text without words.
    assert {1, 4, 5, 9, 11, 13} <= {r.doc_id for r in pieces} <= {-3, 1, 4, 5, 9, 11, 13, 14}
    check_packing(pieces, [(i, next(d[1] for d in docs if d[0] == i)) for r in pieces if r.start == 0 for i in [r.doc_id]], 2048)


def test_empty_tables_run_to_the_end(spark, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, [], [(1, 1, 0)])).collect() == []


def test_accepted_documents_of_empty_and_clashing_tables(spark, awkward, nothing):
    def labels(quality):
        return spark.createDataFrame([(i, quality, 0) for i in range(1, 16)], "doc_id long, quality int, toxic int")

    assert accepted_documents(nothing, labels(1)).collect() == []
    kept = accepted_documents(awkward, labels(1))
    assert kept.columns == awkward.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, awkward.collect()))
    assert accepted_documents(awkward, labels(0)).collect() == []


def test_everything_is_registered():
    registered, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert {*QUERIES, "pipeline"} <= set(registered) and set(ORACLES) <= set(oracles) <= set(registered)
    assert [sum(q.startswith(f"op{n}_") for q in registered) for n in range(1, 14)] == [1] * 13
