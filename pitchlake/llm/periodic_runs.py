"""Detection of periodic runs of words by a dictionary of basic factors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import pieces, small_batches, texts_of

#: A run has at least LEAST_WORDS words, and TIMES times its period.
LEAST_WORDS, TIMES = 24, 3
#: Words that are joined at a time.
CHUNK = 1 << 16

_RUNS = "runs array<struct<start: long, length: long, period: long>>"


def numbered(text: bytes | None) -> tuple[np.ndarray, list[bytes]]:
    """A text's words as numbers, and the distinct words by number. The words of a very long
    text are not all held at once."""
    known: dict[bytes, int] = {}
    parts = [np.fromiter((known.setdefault(w, len(known)) for w in piece.split()), dtype=np.int64) for piece in pieces(text or b"")]
    return np.concatenate(parts), list(known)


def periodic_stretches(x: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the maximal stretches of x with a smallest period q and
    a length of 3 q or more, by start, then period.

    The dictionary of basic factors names each stretch of b = 1, 2, 4, ... places, equal ones
    alike: a factor of 2 b is named by the pair of its halves' names. A factor that occurs
    once is dropped, since longer ones over it occur once too. In a stretch of period q take
    b from q to below 2 q. The factor at each place of the stretch but its last q + b - 1
    comes again q places on, and no earlier, else q would not be the smallest period. So
    within a window twice as long as a factor its occurrences are an arithmetic progression;
    consecutive places whose successor lies the same distance d ahead, b / 2 < d <= b,
    propose the period d. A proposal is extended to both sides while places d apart are
    equal, which also makes proposals of one stretch equal, and these are dropped.
    """
    n, found = len(x), []
    b, at = 1, np.arange(n)
    names = np.full(n, -1, dtype=np.int64)
    names[:] = x
    while len(at) and b * 3 <= n * 2:
        value = names[at]
        order = np.lexsort((at, value))
        at, value = at[order], value[order]
        same = value[1:] == value[:-1]
        gap = np.where(same, at[1:] - at[:-1], 0)
        near = np.flatnonzero((gap > b // 2) & (gap <= b))
        if len(near):
            where, d = at[near], gap[near]
            order = np.lexsort((where, d))
            where, d = where[order], d[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(where) != 1) | (np.diff(d) != 0)]))
            last = np.append(first[1:], len(where)) - 1
            found += zip(where[first].tolist(), (where[last] + d[last] + b).tolist(), d[first].tolist(), strict=True)
        more = np.zeros(len(at), dtype=bool)
        more[1:] |= same
        more[:-1] |= same
        rank = np.cumsum(np.concatenate([[0], ~same])) if len(at) else at
        names = np.full(n, -1, dtype=np.int64)
        names[at[more]] = rank[more]
        at = np.sort(at[more])
        at = at[at + 2 * b <= n]
        second = names[at + b]
        at, second = at[second >= 0], second[second >= 0]
        pair = names[at] * (n + 1) + second
        names[at] = pair
        b *= 2
    runs = set()
    for start, end, d in found:
        while start and x[start - 1] == x[start - 1 + d]:
            start -= 1
        while end < n and x[end] == x[end - d]:
            end += 1
        if end - start >= TIMES * d:
            runs.add((start, end - start, d))
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)


def word_runs(x: np.ndarray) -> np.ndarray:
    """The runs of a text's words: those periodic stretches of LEAST_WORDS words or more."""
    runs = periodic_stretches(x)
    return runs[runs[:, 1] >= LEAST_WORDS]


def repeated_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words some run contains after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def _joined(x: np.ndarray, words: list[bytes]) -> bytes:
    parts = (b" ".join([words[i] for i in x[k : k + CHUNK].tolist()]) for k in range(0, len(x), CHUNK))
    return b" ".join(parts)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.empty((0, 3), dtype=np.int64)
    struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), struct)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, runs, kept = [], [], []
        for text in texts_of(batch):
            x, words = numbered(text)
            counts.append(len(x))
            runs.append(word_runs(x))
            kept.append(_joined(x[~repeated_words(len(x), runs[-1])], words))
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "n_words": pa.array(counts, pa.int64()), "runs": _lists(runs), "collapsed_text": pa.array(kept, pa.binary()).cast(pa.string())}
        )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs, collapsed_text.

    Words are runs of anything but ASCII white space, numbered from 0. runs lists the
    (start, length, period) of each stretch of words whose smallest period is `period`, whose
    length is at least LEAST_WORDS and three times the period, and that no neighbouring word
    extends, by start, then period. collapsed_text has the words that no run contains after
    its first period, joined by one space. Null, empty and short texts have no run; a null or
    empty text collapses to an empty one. Rows that repeat, or have no id, are judged as all
    others. Overlapping runs are all listed. Other columns are not read. An empty table gives
    no rows. See periodic_stretches for the method.

    Each text is judged whole, in one task, without a shuffle; a very long text takes some
    hundred bytes a word.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_judged, f"doc_id long, n_words long, {_RUNS}, collapsed_text string")


def without_periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, of which texts with runs are replaced by their collapsed ones, joined by single
    spaces; all other rows, and all columns, stay as they are. See periodic_runs."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in texts_of(batch, text_col):
                x, words = numbered(text)
                runs = word_runs(x)
                kept.append(_joined(x[~repeated_words(len(x), runs)], words) if len(runs) else text)
            yield batch.set_column(place, text_col, pa.array(kept, pa.binary()).cast(pa.string()))

    return docs.mapInArrow(cut, docs.schema)


def _greater(run: Column, best: Column) -> Column:
    """Whether run has a greater length over period than best, or as great a one and the smaller period."""
    left, right = run["length"] * best["period"], best["length"] * run["period"]
    later = (run["start"] == best["start"]) & (run["period"] < best["period"])
    return best.isNull() | (left > right) | ((left == right) & ((run["start"] < best["start"]) | later))


def run_digests(found: DataFrame) -> DataFrame:
    """What periodic_runs found as one row of digests: doc_id, n_runs, the run of the greatest
    exponent (ties to the smaller start, then period) as start, length, period and
    exponent_milli, and sha256 of the runs' lines and of the collapsed text."""
    kind = "struct<start: long, length: long, period: long>"
    best = F.aggregate("runs", F.lit(None).cast(kind), lambda a, r: F.when(_greater(r, a), r).otherwise(a))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def repeating_place(doc_id: int, n: int) -> tuple[int, int] | None:
    """(a, p) for a text of n words that is to repeat p words from word a on, by its id; None
    if it is to stay. One id in ten is chosen, by its crc32."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _repeating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
            if doc is None or text is None or zlib.crc32(str(doc).encode()) % 10:
                continue
            x, words = numbered(text)
            place = repeating_place(doc, len(x))
            if place:
                a, p = place
                texts[i] = _joined(np.concatenate([x[:a], x[a + (np.arange(a, len(x)) - a) % p]]), words)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.binary()).cast(pa.string())})


def with_repeating_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of docs, where one text in ten, chosen by its id, repeats some of its words
    from some word on (see repeating_place): texts with known runs, to try the detector on.
    Null texts, texts without words and rows without an id stay."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_repeating, "doc_id long, text string")
