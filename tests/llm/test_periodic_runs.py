from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from pitchlake.llm.periodic_runs import numbered, periodic_runs, periodic_stretches, repeated_words, run_digests, with_repeating_words, without_periodic_runs, word_runs
from pitchlake.llm.queries import op13_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(x, least=24):
    """Every stretch (start, length, period) by looking at every period."""
    n, out = len(x), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q) and not any(all(x[k] == x[k + r] for k in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating(doc_id, words):
    """The text that the query's contract makes of a document."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digests(doc_id, text):
    words = repeating(doc_id, WORD.findall(text or ""))
    runs = by_hand(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def sequence(rng, n, letters):
    x = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 3:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
            for i in range(a, rng.randint(a, n)):
                x[i] = x[a + (i - a) % p]
    return x


def test_stretches_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        x = sequence(rng, rng.randint(0, 80), rng.choice([1, 2, 2, 3, 5]))
        assert list(map(tuple, periodic_stretches(np.array(x, dtype=np.int64)).tolist())) == by_hand(x, 0)


def test_long_texts_with_many_runs():
    for x in ([3] * 200_000, [0, 1] * 50_000 + list(range(50_000)) + [7, 8, 9] * 30_000, ([0] * 30 + [1] * 30 + [2]) * 1500):
        runs = word_runs(np.array(x))
        gone = repeated_words(len(x), runs)
        for s, n, q in runs[:: max(1, len(runs) // 50)].tolist():
            assert x[s : s + n - q] == x[s + q : s + n]
            assert (s == 0 or x[s - 1] != x[s - 1 + q]) and (s + n == len(x) or x[s + n] != x[s + n - q])
        assert gone.any()
    assert len(word_runs(np.array(([0] * 30 + [1] * 30 + [2]) * 1500))) == 3001


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a " * 23),
    (5, "a " * 24),
    (6, "a\u00a0b " * 40),
    (7, " ".join(["ab", "cd", "ef"] * 8)),
    (8, " ".join(["ab", "cd", "ef"] * 7)),
    (9, "x " + "y\tz\n" * 12 + "w"),
    (10, "一 二 三 四 " * 10),
    (None, "q r " * 50),
    (None, None),
    (11, "s " * 30 + "t " * 30),
    (11, "s " * 30 + "t " * 30),
]


def test_awkward_and_random_texts_equal_brute_force(spark):
    rng = random.Random(9)
    rows = AWKWARD + [(i, " ".join(f"w{v}" for v in sequence(rng, rng.randint(0, 150), rng.choice([1, 2, 3, 9])))) for i in range(100, 300)]
    docs = spark.createDataFrame([(*r, "runs", 1) for r in rows], "doc_id long, text string, runs string, start int").repartition(3)
    found = run_digests(periodic_runs(with_repeating_words(docs)))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted((digests(*r) for r in rows), key=repr)
    cut = without_periodic_runs(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    kept = {r.doc_id: r.text for r in cut.where("doc_id is not null").collect()}
    assert kept[4] == "a " * 23 and kept[5] == "a" and kept[1] is None and kept[11] == "s t" and kept[9] == "x y z w"


def test_empty_table(spark, nothing):
    assert run_digests(periodic_runs(with_repeating_words(nothing))).collect() == []
    assert without_periodic_runs(nothing).collect() == []


def test_words_are_numbered_as_they_come():
    x, words = numbered("b a b\u00a0c b".encode())
    assert x.tolist() == [0, 1, 2, 0] and words == [b"b", b"a", "b\u00a0c".encode()]
    assert len(numbered(None)[0]) == 0


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(WORD.findall(r[1] or "")) <= 1500]
    found = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert all(found[r[0]] == digests(*r) for r in rows) and len(rows) > 100
    assert sum(r[1] > 0 for r in found.values()) > 10
