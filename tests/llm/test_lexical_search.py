from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pitchlake.llm import lexical_search
from pitchlake.llm.lexical_search import _Documents, _Queries, ranked, term_counts, weight
from pitchlake.llm.queries import op12_ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, queries, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        scored = []
        for i, c in held:
            m = 100 - 25 + (25 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_terms_are_those_of_the_pattern():
    for text in ("It's A1-b2_C3", "Grüße, ÉTÉ\u00a0ñandú — 数学   x́y 🙂", "\x00a\x7fb\x80c{d}[e]", "", " \n"):
        assert term_counts(text.encode()) == Counter(t.encode() for t in terms(text))
    assert term_counts(None) == Counter()


def test_awkward_rows_equal_brute_force(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    queries = [(1, "the of THE " + (docs[0][1] or "")[:200]), (1, "one two"), (None, "grüße 数学"), (4, None), (5, "!?"), (6, "nowhere to be found zzzzzz"), (7, "a a a"), (8, docs[-1][1])]
    table = spark.createDataFrame([(*q, "score", 1) for q in queries], "item_id long, text string, score string, rank int").repartition(2)
    assert rows_of(ranked(awkward, table, 5)) == by_hand(docs, queries, 5)


@pytest.mark.parametrize("sizes", [{}, {"width": 16, "doc_block": (7, 200), "query_block": (3, 50), "lots": 2}, {"width": 1, "doc_block": (1, 1), "query_block": (1, 1), "lots": 1}])
def test_random_texts_equal_brute_force_at_any_size(spark, sizes):
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(-40, 160)]
    docs += [(500 + i, "w1 w2 w3 same") for i in range(40)] + [(500, "w1 w2 w3 same")] * 2
    queries = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(12)] + [(99, "same same w1")]
    found = ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(queries, "item_id long, text string"), 6, **sizes)
    assert rows_of(found) == by_hand(docs, queries, 6)


def test_empty_tables(spark, awkward, nothing):
    queries = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranked(nothing, queries).count() == ranked(awkward, queries.limit(0)).count() == 0
    assert ranked(awkward.where("text is null"), queries).count() == 0


def _blocks(docs, queries, width):
    index = next(lexical_search._indexed(iter([_batch(docs)]))).to_pylist()[0]
    asked = next(lexical_search._asked(iter([_batch(queries)]))).to_pylist()[0]
    df = Counter(t for _, text in docs for t in term_counts(text.encode()))
    hashes = dict(zip(df, lexical_search.word_hashes(list(df)).tolist(), strict=True))
    asked["known"] = [{"term": hashes[t] - (2**64 if hashes[t] >= 2**63 else 0), "df": n} for t, n in df.items()]
    q = _Queries(asked, index["n_docs"], width)
    return _Documents(index, q, index["n_docs"], index["n_terms"]), q


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])})


def test_a_sketch_bounds_each_score_and_few_documents_are_scored():
    rng = random.Random(2)
    docs = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(60))) for i in range(600)]
    queries = [(i, docs[i][1]) for i in range(20)]
    for width in (4, 64, 1024, 16384):
        documents, asked = _blocks(docs, queries, width)
        bounds = documents.sketches(asked.coordinate, width) @ asked.lookup
        scored = []
        counted = documents.scores
        documents.scores = lambda some, wanted: scored.append(len(some)) or counted(some, wanted)
        for q in range(len(queries)):
            wanted = np.zeros(len(asked.vocabulary), dtype=np.int64)
            mine = slice(asked.begin[q], asked.begin[q + 1])
            wanted[asked.place[mine]] = asked.count[mine]
            assert (bounds[:, q] >= counted(np.arange(600), wanted)).all()
        best = [lexical_search._Best(5, 0) for _ in queries]
        lexical_search._meet(documents, asked, best, width)
        assert all(b.ids[0] == q for q, b in enumerate(best))
        if width == 16384:
            assert sum(scored) < 0.2 * 600 * len(queries)


def test_weights_and_given_tables(spark):
    assert weight(10, 10) == math.floor(1000 * math.log(22 / 21))
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    queries = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    assert rows_of(op12_ranked_search(spark, "/root/testdata/sf0.001")) == by_hand(docs, queries, 20)
