from __future__ import annotations

import zlib
from itertools import product

import numpy as np

from pitchlake.llm import quality
from pitchlake.llm.quality import Scorer, accepted_documents, chunks, fit, line_features, line_quality, marginals, quality_scores, stretch, with_neighbours

from .conftest import awkward_rows


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    lengths, move = np.array([3, 1, 4]), rng.normal(size=(2, 2))
    scores = rng.normal(size=8)
    p, pairs, log_z = marginals(scores, lengths, move)
    want_pairs, at = np.zeros((2, 2)), 0
    for d, n in enumerate(lengths):
        s, total, good = scores[at : at + n], 0.0, np.zeros(n)
        for path in product((0, 1), repeat=int(n)):
            w = np.exp(sum(s[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += w
            good += w * np.array(path)
        for path in product((0, 1), repeat=int(n)):
            w = np.exp(sum(s[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
            for a, b in zip(path, path[1:]):
                want_pairs[a, b] += w / total
        assert np.allclose(p[at : at + n], good / total) and np.isclose(log_z[d], np.log(total))
        at += n
    assert np.allclose(pairs, want_pairs)


TEXTS = [b"a b c\nDD! e\n\nx|y z 12\nfoo foo.", b"", None, b"one", b"\n\n", "Ünï\n| a | b |\n\nx".encode(), b"!" * 99, b" a\n"]


def test_features_are_bounded_and_of_neighbours():
    for text in TEXTS:
        f, weights = line_features(text or b"")
        assert f.min() >= 0 and f.max() <= 1 and len(f) == len(weights) == (text or b"").count(b"\n") + 1
        assert weights.tolist() == [len(x) + 1 for x in (text or b"").split(b"\n")]
        one = [line_features(x)[0][0] for x in (text or b"").split(b"\n")]
        assert np.allclose(f, one)
    f = line_features(b"One two.\nTHREE!! THREE!! 4")[0]
    assert f[0, 10] == 1 and f[1, 10] == 0 and np.isclose(f[1, 7], 0.5) and np.isclose(f[1, 6], 2 / 3) and np.isclose(f[1, 2], 10 / 17)
    x, own = with_neighbours(f), f.shape[1]
    assert (x[0, 2 * own :] == f[1]).all() and (x[1, own : 2 * own] == f[0]).all() and not x[0, own : 2 * own].any()


def score_by_hand(text, weights, move):
    """The length-weighted mean of the marginals over all labellings of a text's lines."""
    f, heavy = line_features(text or b"")
    scores, n = with_neighbours(f) @ weights, len(f)
    good, total = np.zeros(n), 0.0
    for path in product((0, 1), repeat=n):
        w = np.exp(sum(scores[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:])))
        total += w
        good += w * np.array(path)
    return float((good / total * heavy).sum() / heavy.sum())


def test_scores_equal_enumeration():
    rng = np.random.default_rng(1)
    weights, move = rng.normal(size=3 * quality._FEATURES), rng.normal(size=(2, 2))
    assert np.allclose(Scorer(weights, move).scores(TEXTS), [score_by_hand(t, weights, move) for t in TEXTS])


def test_long_texts_are_scored_whole_in_chunks(monkeypatch):
    rng = np.random.default_rng(2)
    weights, move = rng.normal(size=3 * quality._FEATURES), rng.normal(size=(2, 2))
    text = b"\n".join(bytes(rng.choice(list(b"ab !|C1."), size=rng.integers(0, 60)).astype(np.uint8)) for _ in range(400))
    want = Scorer(weights, move).scores([text])[0]
    for size, lines in ((1000, 10**6), (10**6, 7), (70, 3)):
        monkeypatch.setattr(quality, "CHUNK_BYTES", size)
        monkeypatch.setattr(quality, "CHUNK_LINES", lines)
        parts = list(chunks(text))
        assert b"\n".join(parts) == text and max(p.count(b"\n") for p in parts) < lines
        assert np.allclose(Scorer(weights, move).scores([b"x", text, b""])[1], want)
    for text in TEXTS:
        assert b"\n".join(chunks(text or b"")) == (text or b"")


def test_line_feeds_and_one_long_line_take_little_memory():
    import resource

    weights, move = np.ones(3 * quality._FEATURES), np.eye(2)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    scores = Scorer(weights, move).scores([b"\n" * 600_000, b"abc def! " * 600_000])
    assert ((scores > 0) & (scores <= 1)).all()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000  # kilobytes


def test_stretches_lie_anywhere_in_a_text():
    text = b"\n".join(b"%d" % i for i in range(1000))
    found = [stretch(text, draw).split(b"\n") for draw in range(0, len(text), 97)]
    assert all(1 <= len(f) <= quality.SAMPLE_LINES and [int(x) for x in f] == list(range(int(f[0]), int(f[0]) + len(f))) for f in found)
    assert int(found[0][0]) == 0 and int(found[-1][-1]) == 999
    assert stretch(None, 5) == b"" and stretch(b"a\nb", 5) == b"a\nb"


def test_the_fit_has_no_slope_left():
    rng = np.random.default_rng(3)
    features = [rng.normal(size=(rng.integers(1, 6), 4)) for _ in range(60)]
    labels = [int(f.mean() + rng.normal() * 0.3 > 0) for f in features]

    def gain(theta):
        lengths = np.array([len(f) for f in features])
        scores, move = np.concatenate(features) @ theta[:-4], theta[-4:].reshape(2, 2)
        log_z = marginals(scores, lengths, move)[2]
        ends = np.cumsum(lengths)
        own = [scores[e - n : e].sum() * v + (n - 1) * move[v, v] for e, n, v in zip(ends, lengths, labels)]
        return (sum(own) - log_z.sum()) / len(labels) - quality.PENALTY * (theta**2).sum() / 2

    weights, move = fit(features, labels)
    theta = np.concatenate([weights, move.ravel()])
    slopes = [(gain(theta + 1e-5 * e) - gain(theta - 1e-5 * e)) / 2e-5 for e in np.eye(len(theta))]
    assert np.abs(slopes).max() < 0.01


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = {r.doc_id: r for r in quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()}
    assert len(found) == 1000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())
    held = [(found[r.doc_id].predicted, r.quality) for r in labels.collect() if found[r.doc_id].held_out]
    assert sum(a == b for a, b in held) / len(held) >= 0.97


def test_held_out_labels_are_not_learned(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    turned = spark.createDataFrame([(r.doc_id, 1 - r.quality if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.quality) for r in labels.collect()], "doc_id long, quality int")
    a, b = (sorted(map(tuple, quality_scores(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_awkward_rows_and_labels(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (14, 0), (15, 0), (None, 0), (4, None), (5, 1), (9, 1)], "doc_id long, quality int")
    found = quality_scores(awkward, labels).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in awkward_rows())
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in found)
    assert quality_scores(nothing, labels).count() == 0
    none = labels.limit(0)
    assert {r.score for r in quality_scores(awkward, none).collect()} == {1.0}
    assert {r.score for r in quality_scores(awkward, labels.where("quality = 0")).collect()} == {0.0}
    assert line_quality(awkward, none).columns == [c for c in awkward.columns if c != "score"] + ["score", "predicted"]
    assert accepted_documents(nothing, labels).columns == nothing.columns and accepted_documents(nothing, labels).count() == 0
    kept = accepted_documents(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() and {r.score for r in kept.collect()} == {"score"}
