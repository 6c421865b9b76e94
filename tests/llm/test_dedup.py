from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm.components import components
from pitchlake.llm.exact_dedup import drop_exact_copies, exact_groups
from pitchlake.llm.near_dedup import BANDS, BAND_SIZE, drop_near_copies, linked, near_duplicates, sketch
from pitchlake.llm.shared import pieces
from pitchlake.llm.substring_dedup import repeated_passages, windows, without_repeated_passages

from .conftest import SCHEMA, awkward_rows, row, words


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def exact_by_hand(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (doc, _), n in zip(rows, norm, strict=True):
        ids = [d for (d, _), m in zip(rows, norm, strict=True) if m == n]
        out.append((doc, min((d for d in ids if d is not None), default=None), len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("digest", [lambda sha: sha, lambda sha: F.substring(sha, 1, 0), lambda sha: F.substring(sha, 1, 1)])
def test_exact_groups_equal_brute_force(awkward, digest):
    found = exact_groups(awkward, digest=digest).collect()
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found))) == sorted(map(str, exact_by_hand(rows)))
    kept = [(r.text_sha256, r.doc_id) for r in found if r.kept]
    assert len(kept) == len({sha for sha, _ in kept}) == len({r.text_sha256 for r in found})


def test_exact_copies_of_a_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot  text")).otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_groups(docs)
    assert found.where("kept").count() == 2001
    assert found.where("group_size = 1000").select("keep_id").distinct().collect() == [(0,)]


def test_dropping_exact_copies_keeps_columns_and_one_row(awkward, nothing):
    kept = drop_exact_copies(awkward)
    assert kept.columns == awkward.columns
    norms = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(norms) == len(set(norms)) == len({n for n in (re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in awkward_rows())})
    assert drop_exact_copies(nothing).count() == exact_groups(nothing).count() == 0


def shingles(text):
    ws = tokens("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws)} if 0 < len(ws) < 5 else {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def near_by_hand(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    comp = {d: d for d, _ in sets if d is not None}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if d is not None and e is not None and a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(d), root(e)))
                comp[y] = x
    return [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets]


def test_near_duplicates_equal_brute_force(awkward, nothing):
    found = near_duplicates(awkward).collect()
    want = near_by_hand([(r[0], r[1]) for r in awkward_rows()])
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert near_duplicates(nothing).count() == 0


def test_near_groups_with_chains_and_hot_buckets_equal_brute_force(spark):
    rng, rows = random.Random(5), []
    for g in range(6):
        base = words(100 + g, 90).split()
        for i in range(60 if g else 400):
            edited = list(base)
            for _ in range(rng.randint(0, 4)):
                edited[rng.randrange(len(edited))] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(edited)))
            if g == 1:
                base = edited  # each is like the one before, the last unlike the first
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, near_duplicates(docs).collect())) == sorted(near_by_hand(rows))


def test_a_hot_group_of_edited_copies_equals_brute_force(spark):
    """5,000 edits of one text: sets are bit masks of what is left of it, and private rest."""
    rng, base, rows, masks = random.Random(6), words(200, 100).split(), [], []
    for d in range(5000):
        edited, mask = list(base), (1 << 96) - 1
        for at in rng.sample(range(100), rng.choice([0, 1, 2, 3, 4, 5, 6, 8])):
            edited[at] = f"w{d}x{at}"
            for i in range(max(0, at - 4), min(95, at) + 1):
                mask &= ~(1 << i)
        rows.append((d, " ".join(edited)))
        masks.append(mask)
    comp = list(range(5000))

    def root(x):
        while comp[x] != x:
            comp[x] = comp[comp[x]]
            x = comp[x]
        return x

    for a, m in enumerate(masks):
        for b in range(a):
            if root(a) != root(b) and 100 * (both := (m & masks[b]).bit_count()) >= 75 * (192 - both):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in found} == {d: root(d) for d in range(5000)} and len({root(d) for d in range(5000)}) > 50
    assert all(r.n_shingles == 96 for r in found)


def rows_made(spark, since=-1):
    """The last execution's id, and rows out of each join, generator and Arrow node after since."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store, made, last = spark._jsparkSession.sharedState().statusStore(), {}, since

    def each(found):
        it = found.iterator()
        while it.hasNext():
            yield it.next()

    for execution in each(store.executionsList()):
        if (number := execution.executionId()) <= since:
            continue
        last, values = max(last, number), {m._1(): m._2() for m in each(store.executionMetrics(number))}
        for node in each(store.planGraph(number).allNodes()):
            if re.search("Join|Generate|Arrow", node.name()):
                for m in each(node.metrics()):
                    if m.name() == "number of output rows" and m.accumulatorId() in values:
                        made[number, node.id(), node.desc()[:200]] = int(values[m.accumulatorId()].replace(",", ""))
    return last, made


def test_shingles_that_edited_copies_share_are_not_rows_of_each(spark):
    """700 edits of one text in one bucket or more, of which many are linked with no other."""
    rng, base, rows = random.Random(8), words(400, 300).split(), []
    for d in range(700):
        edited = list(base)
        for at in rng.sample(range(300), rng.randint(0, 16)):
            edited[at] = f"w{d}x{at}"
        rows.append((d, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    since, _ = rows_made(spark)
    found = sorted(map(tuple, near_duplicates(docs).collect()))
    assert found == sorted(near_by_hand(rows)) and len({f[2] for f in found}) > 50
    _, made = rows_made(spark, since)
    sets = [shingles(t) for _, t in rows]
    assert max(made.values()) < sum(map(len, sets)) / 2, max(made.items(), key=lambda m: m[1])
    assert any("_lot_grams" in desc and n > 1.1 * len(sets[0]) for (*_, desc), n in made.items())  # this step was taken


def test_near_copies_of_a_shared_template_and_repeated_rows(spark):
    """Pages that share two thirds of their words are not alike; repeated rows are one class."""
    template = words(300, 80)
    rows = [(d, f"{template} {words(1000 + d, 40)}") for d in range(150)]
    rows += [(7, rows[7][1])] * 200 + [(500, rows[3][1].replace(" ", "  "))]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(d, 3 if d == 500 else d) for d, _ in rows} and len(found) == len(rows)


CLASHES = "doc_id long, text string, __id long, __sha string, __own_sha string, __first int, __times int, __time int, doc string, pick string, row int, kept boolean, at int"


@pytest.mark.parametrize("drop", [drop_exact_copies, drop_near_copies])
def test_dropping_stands_clashing_names_and_empty_tables(spark, drop):
    rows = [(i, f"{words(i, 30)}", 1, "a", "b", 2, 3, 4, "d", "p", 5, False, 6) for i in range(4)]
    rows += [(9, rows[0][1], *rows[0][2:]), (9, rows[0][1], *rows[0][2:]), (None, None, *rows[0][2:])]
    table = spark.createDataFrame(rows, CLASHES)
    assert sorted(map(str, drop(table).collect())) == sorted(map(str, table.where("doc_id is null or doc_id < 9").collect()))
    assert drop(table.limit(0)).columns == table.columns and drop(table.limit(0)).count() == 0


def test_dropping_near_copies(awkward):
    kept = drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 2 not in ids and 3 not in ids and 10 not in ids and 12 not in ids
    assert {1, 4, 5, 6, 7, 8, 9, 11, 13, -3} <= set(ids)


def test_sketches_fill_and_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    for n in (1, 3, 200, 5000):
        assert not (sketch(rng.integers(0, 2**63, n).astype(np.uint64)) == np.uint64(2**64 - 1)).any()
    agree = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 500).astype(np.uint64)
        a, b = sketch(x[:400]), sketch(x[100:])
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.6) < 0.03 and np.std(agree) < 0.06 and BANDS * BAND_SIZE == len(a)


def test_link_threshold_is_inclusive():
    a = np.arange(7, dtype=np.uint64)
    assert linked(a[:6], a[:8]) is linked(a[:6], a[:7]) is True
    assert linked(np.arange(75, dtype=np.uint64), np.arange(100, dtype=np.uint64)) and not linked(np.arange(74, dtype=np.uint64), np.arange(100, dtype=np.uint64))


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(None, 3)]
    comp = {x: x for e in edges for x in e if None not in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    found = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: c for x, c in comp.items() if x in found} and all(x in found or all(a == b for a, b in edges if x in (a, b)) for x in comp)


def passages_by_hand(rows, size=50):
    first = {}
    for d, t in rows:
        ws = tokens(t)
        for i in range(len(ws) - size + 1):
            w = tuple(ws[i : i + size])
            if d is not None:
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        ws = tokens(t)
        gone = {j for i in range(len(ws) - size + 1) if d is not None and first[tuple(ws[i : i + size])] < d for j in range(i, i + size)}
        left = " ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bucket_rows", [2000, 1])
def test_repeated_passages_equal_brute_force(awkward, nothing, bucket_rows):
    found = repeated_passages(awkward, bucket_rows=bucket_rows).collect()
    want = passages_by_hand([(r[0], r[1]) for r in awkward_rows()])
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert repeated_passages(nothing).count() == 0


def test_repeated_passages_of_the_given_documents(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    for bucket_rows in (2000, 3):
        assert sorted(map(tuple, repeated_passages(small, bucket_rows=bucket_rows).collect())) == sorted(passages_by_hand(rows))


def test_a_passage_of_very_many_documents(spark):
    """All of 20,000 documents say a passage of 60 words: the first keeps it."""
    passage = words(50, 60)
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("u"), "id", F.lit(f" v {passage} w"), "id").alias("text"))
    found = repeated_passages(docs.repartition(6)).groupBy("n_words", "n_removed").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).collect()
    assert sorted((r.n_words, r.n_removed, r.n, r.low) for r in found) == [(63, 0, 1, 0), (63, 61, 19_999, 1)]


def test_repeated_rows_are_judged_once(spark):
    rows = [(1, f"{words(1, 30)} {words(3, 60)}"), (0, f"{words(2, 30)} {words(3, 60)} {words(4, 10)}")]
    docs = spark.createDataFrame(rows[:1] * 1000 + rows[1:], "doc_id long, text string").repartition(3)
    for bucket_rows in (2000, 1):
        found = repeated_passages(docs, bucket_rows=bucket_rows).collect()
        assert len(found) == 1001 and {tuple(r) for r in found} == set(passages_by_hand(rows))


def test_texts_without_repeated_passages(awkward):
    kept = without_repeated_passages(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    by_id = {r.doc_id: r.text for r in kept.collect()}
    assert by_id[4] == next(r[1] for r in awkward_rows() if r[0] == 4)
    assert by_id[5].split()[:70] == words(6, 70).split() and len(by_id[5].split()) == 80


def test_pieces_keep_words_whole():
    rng = random.Random(0)
    for _ in range(200):
        text = bytes(rng.choice(b"ab \n\tc") for _ in range(rng.randint(0, 60)))
        for size in (1, 3, 10, 100):
            assert sum((p.split() for p in pieces(text, size)), []) == text.split()


def test_windows_of_a_packed_super_k_mer():
    ws = words(9, 55).encode().split()
    assert windows(b" ".join(ws)) == [b" ".join(ws[i : i + 50]) for i in range(6)]


def test_awkward_rows_fit_their_schema():
    assert all(len(r) == len(SCHEMA.split(",")) for r in [*awkward_rows(), row(1, "x")])
