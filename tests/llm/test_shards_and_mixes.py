from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pitchlake.llm.mixing import MOST, mix_schedule, mixed, taken_documents, targets
from pitchlake.llm.sharding import balanced_shards, deal, schedule

from .conftest import awkward_rows, words


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_shards(found, rows, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    shard_of = defaultdict(set)
    for r in found:
        shard_of[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())


def test_longest_first_schedule_equals_brute_force():
    sizes = dict(enumerate([7, 7, 6, 6, 5, 5, 4, 4, 4, 1, 1, 12]))
    loads, out = [0] * 3, {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        out[item] = loads.index(min(loads))
        loads[out[item]] += size
    assert schedule(sizes, 3) == out


def test_shards_of_awkward_rows(awkward, nothing):
    found = balanced_shards(awkward, 3).collect()
    check_shards(found, [(r[0], r[1]) for r in awkward_rows()], 3)
    assert balanced_shards(nothing, 3).count() == 0


def test_dealing_equal_sizes_equals_the_schedule():
    rng = random.Random(0)
    for t in range(300):
        shards = rng.randint(1, 9)
        sizes = sorted((rng.choice([1, 2, 3, 5, 8, 50, 400]) * rng.randint(1, 3) for _ in range(rng.randint(1, 200))), reverse=True)
        sizes = [10_000, *sizes] if t % 3 == 0 else sizes
        want, heap, got = schedule(dict(enumerate(sizes)), shards), [(0, s) for s in range(shards)], []
        for size, n in sorted(Counter(sizes).items(), reverse=True):
            stretches = deal(heap, size, n)
            for r in range(n):
                first, turn = [x for x in stretches if x[0] <= r][-1]
                got.append(turn[(r - first) % len(turn)])
        assert got == [want[i] for i in range(len(sizes))]


def test_each_group_goes_where_longest_first_puts_it(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    found = balanced_shards(small, 8).collect()
    check_shards(found, rows, 8)
    sizes, shard_of = Counter(), {}
    for r in found:
        sizes[r.text_crc32, r.size] += r.size
        shard_of[r.text_crc32, r.size] = r.shard
    loads, want = Counter(), Counter()
    # Groups of one size are alike: how many of them each shard has is what the schedule says.
    order = sorted(sizes, key=lambda g: -sizes[g])
    for i, shard in schedule(dict(enumerate(sizes[g] for g in order)), 8).items():
        want[sizes[order[i]], shard] += 1
    for g, size in sizes.items():
        loads[size, shard_of[g]] += 1
    assert loads == want


def test_shards_of_one_hot_text(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    check_shards(balanced_shards(docs, 4).collect(), [(r.doc_id, r.text) for r in docs.collect()], 4)


def test_targets_are_capped_and_reshared():
    found = targets({"b": 100, "a": 10, None: 50, "c": 0})
    assert list(found) == ["a", "b", "c", None]
    assert found["a"] == 30 and found["c"] == 0
    # a and c are full; b weighs 2 and null 5.
    assert abs(found["b"] - 130 * 2 / 7) < 1e-9 and abs(found[None] - 130 * 5 / 7) < 1e-9
    assert targets({}) == {} and targets({"a": 0}) == {"a": 0.0}


def check_mix(found, rows):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += n_words(t)
    target, taken = targets(dict(sizes)), Counter()
    source = {d: s for d, _, s in rows}
    assert Counter((r.doc_id, r.size) for r in found) == Counter((d, n_words(t)) for d, t, _ in rows)
    for r in found:
        assert 0 <= r.taken <= MOST * r.size and (r.first_slot is None) == (r.taken == 0)
        taken[source[r.doc_id]] += r.taken
        assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - target[source[r.doc_id]]) < 1e-6
    assert all(taken[s] == int(t) for s, t in target.items())


def test_mix_of_awkward_rows(awkward, nothing):
    found = mixed(awkward).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], n_words(r[1])) for r in awkward_rows())
    named = awkward.where("doc_id is not null")
    check_mix(mixed(named).collect(), [(r[0], r[1], r[3]) for r in awkward_rows() if r[0] is not None])
    check_mix(mixed(named, block_words=7).collect(), [(r[0], r[1], r[3]) for r in awkward_rows() if r[0] is not None])
    assert sorted(map(str, found)) == sorted(map(str, mixed(awkward.repartition(2)).collect()))
    assert mixed(nothing).count() == taken_documents(nothing).count() == mix_schedule(nothing).count() == 0
    assert taken_documents(awkward).columns == awkward.columns


def test_mix_of_given_documents(small):
    check_mix(mixed(small).collect(), [(r.doc_id, r.text, r.source) for r in small.collect()])


def test_reruns_agree_on_rows_that_repeat_ids_with_other_texts(spark):
    rows = [(i % 5 if i % 4 else None, words(i, 10 + i * 7 % 90), "ab"[i % 2]) for i in range(120)]
    schema = "doc_id long, text string, source string"
    want = sorted(map(str, mixed(spark.createDataFrame(rows, schema).repartition(3), block_words=64).collect()))
    random.Random(1).shuffle(rows)
    assert sorted(map(str, mixed(spark.createDataFrame(rows[::-1], schema).repartition(2), block_words=64).collect())) == want


def test_slots_are_whole_blocks_in_golden_ratio_order(small):
    rows = {r.doc_id: (n_words(r.text), r.source) for r in small.collect()}
    pieces = sorted(mix_schedule(small, block_words=50).collect(), key=lambda r: (r.slot, r.place))
    sizes = Counter()
    for n, s in rows.values():
        sizes[s] += n
    target, slots, taken = targets(dict(sizes)), defaultdict(list), Counter()
    for r in pieces:
        slots[r.slot].append(r)
        taken[r.source] += r.words
        assert rows[r.doc_id][1] == r.source and 0 <= r.start and r.start + r.words <= rows[r.doc_id][0]
    for own in slots.values():
        assert len({r.source for r in own}) == 1 and own[0].place == 0 and sum(r.words for r in own) <= 50
        assert all(a.place + a.words == b.place for a, b in zip(own, own[1:], strict=False))
    assert {s: taken[s] for s in target} == {s: int(t) for s, t in target.items()}
    # After any part of the mix each source has had about its share.
    order, so_far, total = sorted(slots), Counter(), sum(taken.values())
    for i, slot in enumerate(order):
        so_far[slots[slot][0].source] += sum(r.words for r in slots[slot])
        if i % 40 == 39:
            done = sum(so_far.values()) / total
            assert all(abs(so_far[s] - done * taken[s]) <= 50 * 12 for s in target)


def test_taken_documents_repeat_rows(small):
    plan = {r.doc_id: (r.taken, r.size) for r in mixed(small).collect()}
    taken = taken_documents(small)
    assert taken.columns == small.columns
    times = Counter(r.doc_id for r in taken.collect())
    for doc, (words_taken, size) in plan.items():
        assert abs(times[doc] - (words_taken / size if size else 0)) <= 0.5


def test_rows_without_ids_are_taken(spark):
    rows = [(None if i % 3 else i, f"{words(i, 40 + i % 50)} {i}", "ab"[i % 2]) for i in range(300)]
    rows += [(7, words(1000, 900), "b"), (7, words(1001, 30), "a"), (None, "", "a"), (None, None, None)]
    found = taken_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    times, sizes, taken = Counter(map(tuple, found.collect())), Counter(), Counter()
    for r in rows:
        sizes[r[2]] += n_words(r[1])
        taken[r[2]] += times[r] * n_words(r[1])
    assert set(times) <= {r for r in rows if n_words(r[1])} and any(r[0] is None for r in times)
    target = targets(dict(sizes))
    assert all(abs(taken[s] - t) <= 900 for s, t in target.items())
    # A source that is taken whole several times has each of its rows as often.
    assert target["a"] >= sizes["a"] and all(times[r] >= 1 for r in rows if r[2] == "a" and n_words(r[1]))
