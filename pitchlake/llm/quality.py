"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .shared import U64, mix, small_batches, texts_of, word_hashes

#: The model is fitted on at most SAMPLE_DOCS labelled documents, chosen by a hash of their
#: ids, and on a stretch of at most SAMPLE_LINES lines of each, from a hashed place on.
#: Scoring reads every line of every text.
SAMPLE_DOCS, SAMPLE_LINES = 2000, 128
ROUNDS, RATE, PENALTY = 150, 0.1, 1e-3
ACCEPTED = 0.7
#: Bytes and lines that are looked at together, whatever the lengths of lines and texts.
CHUNK_BYTES, CHUNK_LINES = 1 << 20, 1 << 14
#: Buckets of hashed character trigrams.
GRAMS = 64

_KIND = np.zeros(256, dtype=np.uint8)
_SPACE, _UPPER, _DIGIT, _SYMBOL, _PIPE, _BANG = 1, 2, 4, 8, 16, 32
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[65:91] |= _UPPER
_KIND[48:58] |= _DIGIT
_KIND[list(b"#$%&*@^~<>{}[]\\/=+_")] |= _SYMBOL
_KIND[ord("|")] |= _PIPE
_KIND[ord("!")] |= _BANG
_COUNTS, _OWN = 11, 14
_FEATURES = _OWN + GRAMS


def _counted(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each line of data, of its trigrams by bucket, and all its words' hashes."""
    b = np.frombuffer(data, dtype=np.uint8)
    breaks = np.flatnonzero(b == 10)
    n, starts = len(breaks) + 1, np.concatenate([[0], breaks + 1])
    size = np.diff(np.append(starts, len(b) + 1)) - 1
    line_of = np.repeat(np.arange(n), size + 1)[: len(b)]
    kind = _KIND[b]
    out = np.zeros((n, _COUNTS))
    out[:, 0] = size
    for column, flag in enumerate((_UPPER, _DIGIT, _SYMBOL, _PIPE, _BANG), 1):
        out[:, column] = np.bincount(line_of[(kind & flag) > 0], minlength=n)
    filled = (kind & _SPACE) == 0
    words = np.flatnonzero(filled & np.concatenate([[True], ~filled[:-1]])) if len(b) else np.empty(0, dtype=np.int64)
    at, hashes = line_of[words], word_hashes(data.split())
    out[:, 6] = np.bincount(at, minlength=n)
    if len(words):
        same = (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])
        out[:, 7] = np.bincount(at[1:][same], minlength=n)
        with np.errstate(over="ignore"):
            _, first = np.unique(mix(hashes + at.astype(np.uint64) * U64(0x9E3779B97F4A7C15)), return_index=True)
        out[:, 8] = np.bincount(at[first], minlength=n)
        ends = np.zeros(n, dtype=np.int64)
        last = np.flatnonzero(filled)
        ends[line_of[last]] = last
        out[:, 9] = np.isin(b[ends], np.frombuffer(b".?!", dtype=np.uint8)) & (out[:, 6] > 0)
        begin = b[np.minimum(starts, len(b) - 1)]
        out[:, 10] = (size > 0) & ((kind[np.minimum(starts, len(b) - 1)] & _UPPER > 0) | (begin >= 0xC3))
    grams = np.zeros((n, GRAMS))
    if len(b) > 2:
        x = b.astype(np.uint32)
        x = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761) >> np.uint32(26)
        within = (line_of[:-2] == line_of[2:]) & (b[2:] != 10)
        grams = np.bincount(line_of[:-2][within] * GRAMS + x[within], minlength=n * GRAMS).reshape(n, GRAMS).astype(np.float64)
    return out, grams, hashes


def line_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What each line of data looks like, numbers between 0 and 1, and its weight, the bytes
    plus 1: shares of kinds of characters and words, and of hashed character trigrams, so
    that content counts in any language. A line of more than CHUNK_BYTES is counted in parts."""
    if len(data) > CHUNK_BYTES and b"\n" not in data:
        parts = [_counted(data[i : i + CHUNK_BYTES]) for i in range(0, len(data), CHUNK_BYTES)]
        counts, grams = sum(p[0] for p in parts), sum(p[1] for p in parts)
        known = np.empty(0, dtype=np.uint64)
        for _, _, hashes in parts:
            known = np.union1d(known, hashes)
        counts[0, 8:] = len(known), parts[-1][0][0, 9], parts[0][0][0, 10]
    else:
        counts, grams, _ = _counted(data)
    size, upper, digit, symbol, pipe, bang, n, again, distinct, closed, begun = counts.T
    words, full = np.maximum(n, 1), np.maximum(size, 1)
    own = np.stack(
        [
            np.ones_like(n),
            np.minimum(1, np.log1p(size) / 10),
            upper / full,
            np.minimum(1, 2 * pipe / words),
            np.minimum(1, 2 * symbol / words),
            np.minimum(1, bang / words),
            distinct / words,
            again / np.maximum(1, n - 1),
            np.minimum(1, size / words / 20),
            digit / full,
            closed,
            begun,
            1 / words,
            np.zeros_like(n),
        ],
        axis=1,
    )
    own[n == 0] = [1.0, *[0.0] * (_OWN - 2), 1.0]
    return np.hstack([own, grams / np.maximum(1, grams.sum(axis=1, keepdims=True))]), size + 1


def chunks(text: bytes) -> Iterator[bytes]:
    """A text in parts of whole lines: at most CHUNK_LINES, and CHUNK_BYTES unless it is one line."""
    at = 0
    while True:
        end = at + CHUNK_BYTES
        end = len(text) if end >= len(text) else max(text.rfind(b"\n", at, end), at - 1)
        if end < at:  # one line of more than CHUNK_BYTES
            end = text.find(b"\n", at)
            end = len(text) if end < 0 else end
        part = text[at:end]
        if part.count(b"\n") >= CHUNK_LINES:
            breaks = np.flatnonzero(np.frombuffer(part, dtype=np.uint8) == 10)
            part = part[: int(breaks[CHUNK_LINES - 1])]
        yield part
        at += len(part) + 1
        if at > len(text):
            return


def stretch(text: bytes | None, draw: int) -> bytes:
    """At most SAMPLE_LINES lines of a text from the line on that has the byte draw % size."""
    text = text or b""
    if text.count(b"\n") < SAMPLE_LINES:
        return text
    at = end = text.rfind(b"\n", 0, draw % len(text)) + 1
    for _ in range(SAMPLE_LINES):
        end = text.find(b"\n", end) + 1
        if not end:
            return text[at:]
    return text[at : end - 1]


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Each line's own and its neighbours' features (zeros beyond the ends)."""
    n, wide = own.shape
    out = np.zeros((n, 3 * wide), dtype=own.dtype)
    out[:, :wide] = own
    out[1:, wide : 2 * wide] = own[:-1]
    out[:-1, 2 * wide :] = own[1:]
    return out


def _by_position(lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Documents by falling length, and for each position the row of each that is as long."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    return order, [starts[: int((lengths > t).sum())] + t for t in range(int(lengths.max(initial=0)))]


def marginals(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all documents' lines, laid end to end.

    scores: log-odds of `good` of each line by its features; move: 2 x 2 log weights of
    consecutive labels. Gives P(good) of each line, expected counts of consecutive labels,
    and each document's log partition sum.
    """
    order, rows = _by_position(lengths)
    odds = np.stack([np.zeros_like(scores), scores], axis=1)
    shift = odds.max(axis=1, keepdims=True)
    emit, step = np.exp(odds - shift), np.exp(move)
    ahead, back, log_z = np.empty_like(emit), np.ones_like(emit), np.zeros(len(lengths))
    last = None
    for at in rows:
        a = emit[at] if last is None else (ahead[last[: len(at)]] @ step) * emit[at]
        total = a.sum(axis=1)
        ahead[at] = a / total[:, None]
        log_z[order[: len(at)]] += np.log(total) + shift[at, 0]
        last = at
    pairs = np.zeros((2, 2))
    for t in range(len(rows) - 2, -1, -1):
        here, there = rows[t][: len(rows[t + 1])], rows[t + 1]
        behind = emit[there] * back[there]
        b = behind @ step.T
        both = ahead[here][:, :, None] * step * behind[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back[here] = b / b.sum(axis=1, keepdims=True)
    p = ahead * back
    return p[:, 1] / p.sum(axis=1), pairs, log_z


def fit(features: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that make the labels likely, each line labelled as its
    document: penalised maximum likelihood, by Adam with a falling rate."""
    x, lengths = np.concatenate(features), np.array([len(f) for f in features])
    y = np.repeat(np.array(labels, dtype=np.float64), lengths)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = sum(n - 1 for n, v in zip(lengths.tolist(), labels, strict=True) if v == label)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, ROUNDS + 1):
        p, pairs, _ = marginals((x @ theta[:-4].astype(x.dtype)).astype(np.float64), lengths, theta[-4:].reshape(2, 2))
        slope = np.concatenate([x.T @ (y - p).astype(x.dtype), (seen - pairs).ravel()]) / len(labels) - PENALTY * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta += RATE * (1 - i / (ROUNDS + 1)) * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


class Scorer:
    """Scores texts by a fitted model; holds a few numbers for each chunk of a long text."""

    def __init__(self, weights: np.ndarray, move: np.ndarray):
        self.weights, self.move = weights.reshape(3, _FEATURES).T, move
        self.step = np.exp(move - move.max())

    def _parts(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each line what it adds to its own, the next and the line before's score; weights."""
        own, heavy = line_features(data)
        return own @ self.weights, heavy

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        out, held, n, total = np.empty(len(texts)), [], 0, 0
        for i, text in enumerate(texts):
            text = text or b""
            lines = text.count(b"\n") + 1
            if len(text) > CHUNK_BYTES or lines > CHUNK_LINES:
                out[i] = self._long(text)
                continue
            if held and (n + len(text) > CHUNK_BYTES or total + lines > CHUNK_LINES):
                self._short(held, out)
                held, n, total = [], 0, 0
            held.append((i, text, lines))
            n, total = n + len(text) + 1, total + lines
        if held:
            self._short(held, out)
        return np.clip(out, 0.0, 1.0)

    def _short(self, held: list[tuple[int, bytes, int]], out: np.ndarray) -> None:
        """Texts that are one chunk together."""
        parts, heavy = self._parts(b"\n".join(t for _, t, _ in held))
        lengths = np.array([n for _, _, n in held])
        starts = np.cumsum(lengths) - lengths
        is_first, is_last = np.zeros(len(heavy), dtype=bool), np.zeros(len(heavy), dtype=bool)
        is_first[starts], is_last[starts + lengths - 1] = True, True
        scores = parts[:, 0].copy()
        scores[1:] += np.where(is_first[1:], 0.0, parts[:-1, 1])
        scores[:-1] += np.where(is_last[:-1], 0.0, parts[1:, 2])
        p = self._marginals(scores, is_first)
        out[[i for i, _, _ in held]] = np.add.reduceat(p * heavy, starts) / np.add.reduceat(heavy, starts)

    def _marginals(self, scores: np.ndarray, is_first: np.ndarray) -> np.ndarray:
        """P(good) of each line, of texts laid end to end."""
        ahead = self._run(scores, is_first, None)
        back = self._run_back(scores, np.append(is_first[1:], True), None)
        p = ahead * back
        return p[:, 1] / p.sum(axis=1)

    def _emit(self, scores: np.ndarray) -> np.ndarray:
        odds = np.stack([np.zeros_like(scores), scores], axis=1)
        return np.exp(odds - odds.max(axis=1, keepdims=True))

    def _run(self, scores: np.ndarray, is_first: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        """Forward sums; a first line of a text forgets what is before it."""
        emit = self._emit(scores)
        steps = emit[:, :, None] * np.where(is_first[:, None, None], 1.0, self.step.T[None])
        found = _products(steps) @ (np.ones(2) if before is None else before)
        return found / found.sum(axis=1, keepdims=True)

    def _run_back(self, scores: np.ndarray, is_last: np.ndarray, after: np.ndarray | None) -> np.ndarray:
        """Backward sums, of which after are those of the line behind the last, with what it emits."""
        emit = self._emit(scores)
        # From the sums of line t + 1 to those of line t.
        steps = self.step[None] * np.append(emit[1:], [[1.0, 1.0]], axis=0)[:, None, :]
        steps[is_last] = 1.0
        if after is not None:
            steps[-1] = self.step
        found = _products(steps[::-1])[::-1] @ (np.ones(2) if after is None else after)
        return found / found.sum(axis=1, keepdims=True)

    def _long(self, text: bytes) -> float:
        """One text, chunk by chunk: forward for the sums at the chunks' ends, then from the
        last chunk back, each chunk's features being made again."""
        ends: list[tuple[int, int]] = []  # where each chunk lies
        at = 0
        for part in chunks(text):
            ends.append((at, at + len(part)))
            at += len(part) + 1

        def parts(k: int) -> tuple[np.ndarray, np.ndarray]:
            return self._parts(text[ends[k][0] : ends[k][1]])

        edge = np.zeros((len(ends) + 2, 2, 3))  # what the first and last lines of each chunk add
        sums: list[np.ndarray | None] = [None]

        def scores_of(k: int, own: np.ndarray) -> np.ndarray:
            scores = own[:, 0].copy()
            scores[1:] += own[:-1, 1]
            scores[:-1] += own[1:, 2]
            scores[0] += edge[k, 1, 1]
            scores[-1] += edge[k + 2, 0, 2]
            return scores

        here = parts(0)
        for k in range(len(ends)):
            edge[k + 1] = here[0][0], here[0][-1]
            there = parts(k + 1) if k + 1 < len(ends) else None
            if there is not None:
                edge[k + 2, 0] = there[0][0]
            first = np.zeros(len(here[1]), dtype=bool)
            first[0] = k == 0
            sums.append(self._run(scores_of(k, here[0]), first, sums[-1])[-1])
            here = there
        good = total = 0.0
        after = None
        for k in reversed(range(len(ends))):
            own, heavy = parts(k)
            scores, inside = scores_of(k, own), np.zeros(len(heavy), dtype=bool)
            first, last = inside.copy(), inside
            first[0], last[-1] = k == 0, k == len(ends) - 1
            ahead, back = self._run(scores, first, sums[k]), self._run_back(scores, last, after)
            p = ahead * back
            good += float((p[:, 1] / p.sum(axis=1) * heavy).sum())
            total += float(heavy.sum())
            after = self._emit(scores[:1])[0] * back[0]
        return good / total


def _products(steps: np.ndarray) -> np.ndarray:
    """For each t the product steps[t] ... steps[0] of 2 x 2 matrices, up to a factor."""
    out, gap = steps / steps.sum(axis=(1, 2), keepdims=True), 1
    while gap < len(out):
        both = out[gap:] @ out[:-gap]
        out = np.concatenate([out[:gap], both / both.sum(axis=(1, 2), keepdims=True)])
        gap *= 2
    return out


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[list[np.ndarray], list[int]]:
    known = labels.where("doc_id is not null and quality is not null").where(~is_held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(known), "doc_id")  # at most SAMPLE_DOCS rows
    rows = rows.select("doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit("stretch")), F.lit(1 << 40)).alias("draw"), "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(stretch(t, draw))[0].astype(np.float32).tobytes() for draw, t in zip(batch.column(2).to_pylist(), texts_of(batch), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "label", "features"])

    # One row per document: a repeated id doesn't widen the sample.
    found = rows.mapInArrow(features, "doc_id string, label int, features binary").groupBy("doc_id").agg(F.min(F.struct("features", "label")).alias("row"))
    drawn = sorted((r.doc_id, r.row.label, bytes(r.row.features)) for r in found.collect())
    return [with_neighbours(np.frombuffer(f, dtype=np.float32).reshape(-1, _FEATURES)) for _, _, f in drawn], [v for _, v, _ in drawn]


def line_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= ACCEPTED, else 0).

    A conditional random field over a text's lines gives each line's probability to be
    good; score is their mean, weighted by the lines' lengths in bytes plus 1. Features are
    of the line and its two neighbours alone. It is learned from labels (doc_id, quality;
    null labels and ids count as none, of several labels the majority, ties as 1), without
    held-out rows, where each line has its document's label. With labels of one kind, or
    none, every score is 0 if that kind is 0, else 1. Null and empty texts have one empty
    line. Texts of any length are scored whole, chunk by chunk: what is held at once is
    bounded by CHUNK_BYTES and CHUNK_LINES. All columns of docs stay; a column of that name
    is replaced. Repeated rows score alike. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    features, known = _sample(docs, labels, id_col, text_col)
    kinds = set(known)
    scorer = Scorer(*fit(features, known)) if len(kinds) == 2 else None
    constant = 0.0 if kinds == {0} else 1.0

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    at = kept.index(text_col)
    own = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    schema = StructType([*(docs.schema[c] for c in kept), *own])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, batch.schema.names[at])
            scores = scorer.scores(texts) if scorer else np.full(len(texts), constant)
            columns = [*batch.columns, pa.array(scores), pa.array((scores >= ACCEPTED).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score", "predicted"])

    return docs.select(*kept).mapInArrow(scored, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. See line_quality.

    A row is held out, so that its label isn't learned, if crc32 of its id as text is 2
    modulo 4; a null id is not held out."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = line_quality(texts, labels.select("doc_id", "quality"))
    return found.select("doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def accepted_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose predicted quality is 1, with all their columns, whatever their
    names. Null, empty and very long texts, repeated rows and empty tables: see line_quality."""
    marked = line_quality(docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns}), labels, f"own_{id_col}", f"own_{text_col}")
    return marked.where("predicted = 1").select(*(F.col(f"own_{c}").alias(c) for c in docs.columns))
