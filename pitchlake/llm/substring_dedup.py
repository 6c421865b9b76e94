"""Removal of repeated passages: super-k-mers dealt by minimiser, windows counted by sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import gram_hashes, materialize, pieces, salt_bit, salt_of, small_batches, spread_over_salts, texts_of, word_hashes

#: Words in a window, and in the grams of which a window's least hash is its minimiser; of
#: the longer grams, its second minimiser.
WINDOW, GRAM, LONG_GRAM = 50, 10, 30
#: Super-k-mers that one bucket sorts. Fuller buckets are split by the second minimiser, and
#: what is still fuller, of different strings, by windows' digests.
BUCKET_ROWS = 2000
SALTS = 32

_PLACE = "doc_id long, text_key long"


def minimisers(hashes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The minimiser of each window of words with these hashes: the least among its grams."""
    low = gram_hashes(hashes, gram)
    grams, span = WINDOW - gram + 1, 1
    while 2 * span <= grams:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    rest = grams - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _changes(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of one value begin, and their lengths."""
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    return first, np.diff(np.append(first, len(low)))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's word count, the hash of all its words, and its super-k-mers."""
    for batch in batches:
        n, sha, keys, starts, counts = [], [], [], [], []
        for text in texts_of(batch):
            parts, joined = [], hashlib.sha256()
            for words in filter(None, map(bytes.split, pieces(text or b""))):
                joined.update(b" " * bool(parts) + b" ".join(words))
                parts.append(word_hashes(words))
            hashes = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
            n.append(len(hashes))
            sha.append(joined.digest())
            if len(hashes) < WINDOW:
                keys.append(None), starts.append(None), counts.append(None)
                continue
            low = minimisers(hashes)
            first, lengths = _changes(low)
            keys.append(low[first].view(np.int64))
            starts.append(first.astype(np.int32))
            counts.append(lengths.astype(np.int32))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "text_key": batch.column(1),
                "n_words": pa.array(n, pa.int64()),
                "sha": pa.array(sha, pa.binary()),
                "keys": pa.array(keys, pa.list_(pa.int64())),
                "starts": pa.array(starts, pa.list_(pa.int32())),
                "counts": pa.array(counts, pa.list_(pa.int32())),
            }
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each wanted super-k-mer as one string. Those of full buckets are parted
    where the second minimiser, key2, changes."""
    for batch in batches:
        out = {"key": [], "key2": [], "doc_id": [], "text_key": [], "start": [], "n": [], "packed": []}
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), texts_of(batch), strict=True)
        for doc, text_key, runs, text in rows:
            words = text.split()
            for run in runs:
                begin, n = run["start"], run["n"]
                parts = [(None, 0, n)]
                if run["full"]:
                    low = minimisers(word_hashes(words[begin : begin + n + WINDOW - 1]), LONG_GRAM)
                    first, lengths = _changes(low)
                    parts = zip(low[first].view(np.int64).tolist(), first.tolist(), lengths.tolist(), strict=True)
                for key2, at, length in parts:
                    out["key"].append(run["key"])
                    out["key2"].append(key2)
                    out["doc_id"].append(doc)
                    out["text_key"].append(text_key)
                    out["start"].append(begin + at)
                    out["n"].append(length)
                    out["packed"].append(b" ".join(words[begin + at : begin + at + length + WINDOW - 1]))
        out["digest"] = list(map(xxhash.xxh3_128_digest, out["packed"]))
        kinds = {"start": pa.int32(), "n": pa.int32(), "packed": pa.binary(), "digest": pa.binary()}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})


def windows(packed: bytes) -> list[bytes]:
    """The windows of a packed super-k-mer, in order."""
    ends = np.flatnonzero(np.frombuffer(packed, dtype=np.uint8) == 0x20).tolist() + [len(packed)]
    begins = [0, *(e + 1 for e in ends[:-1])]
    return [packed[b:e] for b, e in zip(begins, ends[WINDOW - 1 :], strict=False)]


def _runs(places: list[int]) -> Iterator[tuple[int, int]]:
    """(first, length) of each run of consecutive numbers."""
    for _, run in groupby(enumerate(places), lambda x: x[1] - x[0]):
        numbers = [p for _, p in run]
        yield numbers[0], len(numbers)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_key, start, packed, key, key2) come sorted by key, key2 and doc_id.
    Windows of a bucket's rows are sorted with their document; each that is not in its first
    document is to be removed."""

    def repeated(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        found = [(w, doc, r, i) for r, (doc, _, _, packed, *_) in enumerate(rows) for i, w in enumerate(windows(packed))]
        found.sort()
        gone: dict[int, list[int]] = {}
        window = first = None
        for w, doc, r, i in found:
            if w != window:
                window, first = w, doc
            elif doc > first:
                gone.setdefault(r, []).append(i)
        return [(rows[r][0], rows[r][1], rows[r][2] + at, n) for r, places in gone.items() for at, n in _runs(sorted(places))]

    held: list[tuple] = []
    for batch in batches:
        done: list[tuple[int, int, int, int]] = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if held and row[4:] != held[0][4:]:
                done += repeated(held)
                held = []
            held.append(row)
        yield _removals(done)
    yield _removals(repeated(held))


def _removals(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    names, kinds = ("doc_id", "text_key", "start", "n"), (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each window of rows (doc_id, text_key, start, packed, ...)."""
    for batch in batches:
        ids, keys, starts, digests = [], [], [], []
        for doc, text_key, start, packed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            found = windows(packed)
            digests += map(xxhash.xxh3_128_digest, found)
            starts += range(start, start + len(found))
            ids += [doc] * len(found)
            keys += [text_key] * len(found)
        yield pa.RecordBatch.from_pydict(
            {"doc_id": pa.array(ids, pa.int64()), "text_key": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int32()), "window": pa.array(digests, pa.binary())}
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text after its removals."""
    for batch in batches:
        removed, sha, kept = [], [], []
        for runs, text in zip(batch.column(3).to_pylist(), texts_of(batch), strict=True):
            words = text.split()
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            for run in runs:
                gone[run["start"]] += 1
                gone[run["start"] + run["n"] + WINDOW - 1] -= 1
            covered = np.cumsum(gone[:-1]) > 0
            left = b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c])
            removed.append(int(covered.sum()))
            sha.append(hashlib.sha256(left).digest())
            kept.append(left)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "text_key": batch.column(1),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha": pa.array(sha, pa.binary()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )


def _met(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Those of rows whose keys are in two documents or more, with low, the first of these,
    and rows, how many there are. Both ways are salted by document, so that a key which very
    many rows have is combined before it meets, and no task holds all of it."""
    salted = rows.withColumn("salt", salt_of("doc_id", SALTS))
    ends = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"), F.sum(salt_bit()).alias("salt_bits")]
    some = salted.groupBy(*keys, "salt").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("rows"))
    known = some.groupBy(*keys).agg(*ends).where("low < high").drop("high")
    return salted.join(spread_over_salts(known, SALTS), [*keys, "salt"]).drop("salt")


def _sorted_windows(rows: DataFrame) -> DataFrame:
    dealt = rows.repartition("key", "key2").sortWithinPartitions("key", "key2", "doc_id")
    return dealt.mapInArrow(_counted, f"{_PLACE}, start int, n int")


def _of_full_buckets(parts: DataFrame, bucket_rows: int) -> DataFrame:
    """What goes of the super-k-mers of full buckets, from their parts.

    Equal parts are combined by digest before they are shuffled, salted by document: a
    passage of very many documents is the same few strings again and again. All documents of
    a string but its first one lose all its windows. The first may lose windows to other
    strings of the bucket, so distinct strings are sorted by windows as those of first
    documents; where still more than bucket_rows of them meet, as around a passage whose
    neighbours differ, windows meet by 128-bit digests.
    """
    place, string = ["doc_id", "text_key"], ["key", "key2", "digest"]
    salted = parts.withColumn("salt", salt_of("doc_id", SALTS))
    some = salted.groupBy(*string, "salt").agg(F.min("doc_id").alias("low"), F.min("packed").alias("packed"))
    strings = some.groupBy(*string).agg(F.min("low").alias("low"), F.min("packed").alias("packed"), F.sum(salt_bit()).alias("salt_bits"))
    strings = materialize(strings.withColumn("string", F.monotonically_increasing_id()), "passage-strings")
    row = [*place, "start", "packed", "key", "key2"]
    as_rows = strings.select(F.col("low").alias("doc_id"), F.col("string").alias("text_key"), F.lit(0).alias("start"), "packed", "key", "key2")
    meeting = materialize(_met(as_rows, ["key", "key2"]).select(*row, "rows"), "passage-meeting")
    lost = _sorted_windows(meeting.where(F.col("rows") <= bucket_rows).select(*row))
    single = meeting.where(F.col("rows") > bucket_rows).select(*row).mapInArrow(_digested, f"{_PLACE}, start int, window binary")
    later = _met(materialize(single, "passage-windows"), ["window"]).where("doc_id > low").select(*place, "start", F.lit(1).alias("n"))
    lost = lost.unionByName(later).groupBy(F.col("text_key").alias("string")).agg(F.collect_list(F.struct("start", "n")).alias("lost"))  # of one string
    known = strings.drop("packed").join(lost, "string", "left")
    placed = salted.drop("packed").join(spread_over_salts(known, SALTS), [*string, "salt"])
    own = F.transform("lost", lambda x: F.struct((F.col("start") + x["start"]).alias("start"), x["n"].alias("n")))
    gone = F.when(F.col("doc_id") > F.col("low"), F.array(F.struct("start", "n"))).otherwise(own)
    return placed.select(*place, F.explode(gone).alias("gone")).select(*place, "gone.*")


def _removed(docs: DataFrame, id_col: str, text_col: str, bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, text_key, n_words, sha), and what is left of those that lose words."""
    small_batches(docs.sparkSession)
    place = ["doc_id", "text_key"]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    marked = materialize(
        texts.mapInArrow(_marked, f"{_PLACE}, n_words long, sha binary, keys array<long>, starts array<int>, counts array<int>"), "passage-marks"
    )
    runs = marked.where("doc_id is not null").select(*place, F.explode(F.arrays_zip("keys", "starts", "counts")).alias("run"))
    runs = runs.select(*place, F.col("run.keys").alias("key"), F.col("run.starts").alias("start"), F.col("run.counts").alias("n"))
    wanted = _met(runs, ["key"]).select(*place, F.struct("key", "start", "n", (F.col("rows") > bucket_rows).alias("full")).alias("run"))
    wanted = wanted.groupBy(*place).agg(F.collect_set("run").alias("runs"))  # of one text
    chosen = texts.join(wanted, place).select(*place, "text", "runs").dropDuplicates(place)  # of repeated rows, one
    chosen = materialize(chosen, "passage-texts")

    def packed(full: bool) -> DataFrame:
        some = chosen.withColumn("runs", F.filter("runs", lambda r: r["full"] == F.lit(full))).where(F.size("runs") > 0)
        return some.mapInArrow(_packed, f"key long, key2 long, {_PLACE}, start int, n int, packed binary, digest binary")

    gone = _sorted_windows(packed(False).select(*place, "start", "packed", "key", "key2"))
    gone = gone.unionByName(_of_full_buckets(materialize(packed(True), "passage-parts"), bucket_rows))
    gone = gone.groupBy(*place).agg(F.collect_list(F.struct("start", "n")).alias("gone"))
    losing = chosen.select(*place, "text").join(gone, place).select(*place, "text", "gone")
    cut = losing.mapInArrow(_cut, f"{_PLACE}, n_removed long, kept_sha binary, kept_text string")
    return marked.select(*place, "n_words", "sha"), cut


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256.

    Words are runs of anything but ASCII white space. A word is removed when some window of
    WINDOW words that covers it also starts in a document with a smaller id. kept_sha256 is
    of the kept words, joined by one space. Windows are judged on the input. Null, empty and
    short texts have no window. Rows without an id lose nothing and take nothing. Rows that
    repeat an id and text are all returned alike, and are judged once; two texts with one id
    are judged apart and take nothing from each other. Very long texts are hashed in pieces
    and judged whole. Other columns are not read. An empty table gives no rows.

    Consecutive windows with the same minimiser form a super-k-mer. Equal windows have equal
    minimisers, so only super-k-mers whose minimiser occurs in two documents travel, each as
    one packed string, to its minimiser's bucket, where windows are sorted and counted by
    their words. A bucket of more than bucket_rows super-k-mers is split by a second
    minimiser, of longer grams: its super-k-mers are parted where that changes, and equal
    parts are combined before they are shuffled, so that a passage of very many documents
    travels as often as it differs (see _of_full_buckets).
    """
    marked, cut = _removed(docs, id_col, text_col, bucket_rows)
    found = marked.join(cut.drop("kept_text"), ["doc_id", "text_key"], "left")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"),
    )


def without_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs, of which texts that lose words are replaced by their kept words, joined by one
    space. See repeated_passages: rows that lose nothing, null and empty texts, and rows
    without an id stay as they are; all columns stay."""
    _, cut = _removed(docs, id_col, text_col, bucket_rows)
    docs, kept = docs.alias("docs"), cut.alias("kept")
    same = (F.col(f"docs.{id_col}") == F.col("kept.doc_id")) & (F.xxhash64(f"docs.{text_col}") == F.col("kept.text_key"))
    text = F.coalesce("kept.kept_text", F.col(f"docs.{text_col}"))
    return docs.join(kept, same, "left").select(*(text.alias(c) if c == text_col else F.col(f"docs.{c}") for c in docs.columns))
