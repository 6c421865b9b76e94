from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from pitchlake.llm.shared import shared_folder
from pitchlake.llm.topk import Blocks, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def by_hand(rows, queries, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    rows = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for q, v in queries:
        if q is not None and whole(v) is not None:
            scored = sorted((-sum(a * b for a, b in zip(whole(v), w)), i) for i, w in rows if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i * 7 - 500, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(5000 + i, [0.25] * 8) for i in range(100)]
    rows += [(1, None), (2, [1.0, None]), (4, [float("nan")] * 8), (8, [float("inf")] * 8), (None, [1.0] * 8), (10, []), (11, [1.0, 2.0]), (12, [3e38] * 2 + [0.0] * 6)][:7]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    table = spark.createDataFrame([(i, v, 0, "score") for i, v in rows], SCHEMA).repartition(3)
    asked = [(i, v) for i, v in rows if i is not None and i % 5 == 0]
    for sizes in ((1024, 64, 2048), (16, 2, 10), (1, 1, 1000)):
        found = nearest(table, table.where(F.col("vec_id") % 5 == 0), 4, *sizes).collect()
        assert sorted(map(tuple, found)) == by_hand(rows, asked, 4)


def test_few_candidates_and_empty_tables(spark):
    table = spark.createDataFrame([(0, [1.0], 0, ""), (100, [2.0], 0, "")], SCHEMA)
    assert sorted(map(tuple, nearest(table, table).collect())) == [(0, 1, 100, 2 * 1024 * 1024), (100, 1, 0, 2 * 1024 * 1024)]
    assert nearest(table.limit(0), table).count() == nearest(table, table.limit(0)).count() == nearest(table.where("vec_id = 0"), table.where("vec_id = 0")).count() == 0


def test_large_components_are_exact(spark):
    table = spark.createDataFrame([(0, [2.0**40, 1.0]), (1, [3.0, 5.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<double>")
    found = nearest(table, table.where("vec_id = 0")).collect()
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(1, 2**60 * 3 + 5 * 2**20), (2, 2**60 * 3 + 4 * 2**20)]


def test_blocks_are_skipped_below_the_kth_score():
    ids = np.arange(4096)
    matrix = np.where(ids[:, None] < 1024, 100.0, 1.0) * np.ones((4096, 4))
    blocks = Blocks(ids // 1024, ids, matrix)
    asked = np.ones((1, 4))
    scored = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ other

    blocks.matrix = blocks.matrix.view(Watched)
    assert blocks.best(-1, asked[0], blocks.bounds(asked)[0], 10) == [(400, i) for i in range(10)]
    assert scored == [1024]


def test_queries_go_to_few_cells_where_vectors_have_structure(spark):
    """Sixteen kinds of vectors, in order of their ids: a query is sent to cells of its own kind."""
    rng = np.random.default_rng(5)
    kind = np.arange(4096) // 256
    matrix = (np.eye(16)[kind] + rng.normal(0, 0.02, (4096, 16))).astype(np.float32)
    rows = [(i, [float(x) for x in v], 0, "") for i, v in enumerate(matrix)]
    table = spark.createDataFrame(rows, SCHEMA)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def pairs():
        return {f.getPath().toString() for f in system.listStatus(folder) if f.getPath().getName().startswith("search-pairs")}

    before = pairs()
    found = nearest(table, table.where(F.col("vec_id") % 64 == 0), 5, 16, 1, 2048).collect()
    whole = np.floor(1024 * matrix.astype(np.float64)).astype(np.int64)
    for q in range(0, 4096, 64):
        score = whole @ whole[q]
        best = sorted((-int(s), i) for i, s in enumerate(score) if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)] == best
    n_cells, n_queries = 4096 // 16, 64
    sent = [spark.read.parquet(p).count() for p in pairs() - before]
    assert len(sent) == 2 and n_queries in sent
    assert sum(sent) < 0.1 * n_cells * n_queries
