"""Near-duplicate detection: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import U64, gram_hashes, materialize, mix, pieces, small_batches, texts_of, word_hashes

SHINGLE = 5
#: Bands of coordinates. Two sets of similarity 0.75 share none of 40 bands of 4 with
#: probability (1 - 0.75^4)^40, or 3 in 10 million.
BANDS, BAND_SIZE = 40, 4
PERCENT = 75
#: Members of a leader that are compared in one group of a task.
BLOCK = 256
#: Buckets of at most so many classes are settled pair by pair, each in one group of a task.
SMALL = 64
#: Members of one leader whose shingles are counted in one group of a task, and the shingles
#: of these, both on average over the leader's groups.
LOT, LOT_SHINGLES = 128, 1 << 20

_EMPTY = U64(0xFFFFFFFFFFFFFFFF)
_LOW = U64((1 << 40) - 1)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles (a shorter text is one shingle)."""
    x = np.concatenate([word_hashes(p.lower().split()) for p in pieces(text or b"")])
    if not len(x):
        return x
    return np.unique(gram_hashes(x, min(SHINGLE, len(x))))


def sketch(elements: np.ndarray, size: int = BANDS * BAND_SIZE) -> np.ndarray:
    """The fast similarity sketch of a set (not empty), one 64-bit value per coordinate.

    In round i of the first `size` rounds each element falls into one hashed bin with a
    hashed value; a bin keeps the least (round, value). Bins still empty then take, in round
    size + bin, the least value of all elements. So each coordinate is filled, and two sets
    agree on one with their similarity as probability. Rounds after all bins are full change
    nothing, so several small rounds run at once.
    """
    out = np.full(size, _EMPTY, dtype=np.uint64)
    step = min(size, max(1, 1024 // len(elements)))
    with np.errstate(over="ignore"):
        for start in range(0, size, step):
            rounds = np.arange(start, min(size, start + step), dtype=np.uint64)[:, None]
            x = mix(elements[None, :] + (rounds + U64(1)) * U64(0xD1B54A32D192ED03))
            bins = ((x >> U64(40)) * U64(size)) >> U64(24)
            np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds << U64(40)) | (x & _LOW)).ravel())
            if not (out == _EMPTY).any():
                return out
        for b in np.flatnonzero(out == _EMPTY):
            x = mix(elements + U64(size + b + 1) * U64(0xD1B54A32D192ED03))
            out[b] = (U64(size + b) << U64(40)) | (x & _LOW).min()
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One key per band; bands of different positions never share keys on purpose."""
    parts = coordinates.reshape(BANDS, BAND_SIZE)
    with np.errstate(over="ignore"):
        h = np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(BAND_SIZE):
            h = mix(h * U64(0x9E3779B97F4A7C15) + parts[:, i])
    return h.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the sets' similarity is PERCENT or more."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)) or not len(a):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for text in texts_of(batch):
            found = shingle_set(text)
            sizes.append(len(found))
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            bands.append(band_keys(sketch(found)) if len(found) else None)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0).cast(pa.int64()),
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
            }
        )


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they are shuffled several times."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [press.compress(t or b"") for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle sets of compressed texts, one after the other."""
    press = zstandard.ZstdDecompressor()
    for packed in column:
        yield shingle_set(press.decompress(packed.as_py()))


def _against_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (lead, salt, kind): a leader's own row, then its members."""
    group, sets = None, []
    for batch in batches:
        a, b = [], []
        columns = (batch.column(i).to_pylist() for i in range(4))
        for lead, salt, kind, doc, own in zip(*columns, _sets(batch.column(4)), strict=True):
            if (lead, salt) != group:
                group, sets = (lead, salt), []
            if kind == 0:
                sets.append(own)
            elif any(linked(own, s) for s in sets):
                a.append(lead)
                b.append(doc)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _within_bucket(_: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within a small bucket, between members not yet joined."""
    members, parent = [], {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for batch in batches:
        docs, comps = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc", "comp"))
        members += zip(docs, comps, _sets(batch.column(batch.schema.get_field_index("packed"))), strict=True)
    members.sort(key=lambda m: len(m[2]))
    a, b = [], []
    for i, (doc, comp, own) in enumerate(members):
        for other, other_comp, s in members[i + 1 :]:
            if 100 * len(own) < PERCENT * len(s):
                break
            if root(comp) != root(other_comp) and linked(own, s):
                parent[root(comp)] = root(other_comp)
                a.append(doc)
                b.append(other)
    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc, comp, minor, lead, packed) with the text's set instead of the text."""
    for batch in batches:
        sets = [s.view(np.int64) for s in _sets(batch.column(4))]
        kinds = {"size": pa.array([len(s) for s in sets], pa.int64()), "grams": pa.array(sets, pa.list_(pa.int64()))}
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *kinds.values()], names=["doc", "comp", "minor", "lead", *kinds])


def _lot_grams(lot: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The distinct shingles of a lot: in how many of its sets each is, and the least and
    greatest component of these. Edited copies share most shingles, which come once here."""
    grams = rows["grams"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    comps = np.repeat(rows["comp"].to_numpy(), rows["size"].to_numpy())
    order = np.lexsort((comps, grams))
    grams, comps = grams[order], comps[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    after = np.append(first[1:], len(grams))
    lead, salt = (np.full(len(first), k.as_py(), dtype=np.int64) for k in lot)
    return pa.table({"lead": lead, "salt": salt, "gram": grams[first], "n": after - first, "low": comps[first], "high": comps[after - 1]})


def _prefixes(rows: pa.Table, shared: pa.Table) -> pa.Table:
    """Of the sets of a lot, given its shingles that several components have with their
    numbers: the rarest that can be the first one in common with a linked set."""
    order = np.argsort(shared["gram"].to_numpy())
    known, numbers = shared["gram"].to_numpy()[order], shared["n"].to_numpy()[order]
    out = {c: [np.empty(0, np.int64)] for c in ("row", "rest", "gram")}
    for i, size in enumerate(rows["size"].to_pylist() if len(known) else []):
        grams = rows["grams"][i].values.to_numpy()
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        at = at[known[at] == grams]
        # A linked set has three quarters of this one, none of them what only its component has.
        first = at[np.lexsort((known[at], numbers[at]))][: max(0, len(at) - (3 * size + 3) // 4 + 1)]
        out["row"].append(np.full(len(first), i))
        out["rest"].append(len(at) - np.arange(len(first)))
        out["gram"].append(known[first])
    out = {c: np.concatenate(parts) for c, parts in out.items()}
    kept = rows.select(["doc", "comp", "minor", "size"]).take(pa.array(out["row"]))
    return kept.append_column("rest", pa.array(out["rest"])).append_column("gram", pa.array(out["gram"]))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased; words are runs of anything but ASCII white space; a document's set
    is its distinct shingles of five words, or its only sequence if it has fewer. Documents
    are linked when 100 * intersection >= 75 * union; component_id is the smallest id that
    links reach, and the document with that id is kept. Null and empty texts have an empty
    set and are linked with nothing. Rows without an id are linked with nothing, have no
    component_id and are kept. Rows that repeat an id are all returned; links of each hold
    for the id. Other columns of docs are not read. An empty table gives no rows.

    Documents with one and the same set are one class. A bucket is a band's key that several
    classes have; its leader is the class that meets most others in all its buckets, which in
    a group of edited copies is one with few edits. First each bucket's classes are verified
    against its leader. What that leaves in more than one component is settled exactly, with
    rows that grow with the documents: small buckets pair by pair in one group each, the
    classes of all larger ones by a join on the rare ends of their sets (see _candidates).
    So each linked pair that shares a bucket has been verified or is joined already. Texts
    are read twice: for sketches, and to write those of buckets' classes once, compressed one
    by one, which is what the later steps shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = materialize(
        texts.mapInArrow(_sketches, "doc_id long, n_shingles long, set_key binary, bands array<long>"), "near-sketches"
    )
    sets = sketches.where("doc_id is not null and set_key is not null")
    classes = sets.groupBy("set_key").agg(F.min("doc_id").alias("doc"))
    banded = sets.select(F.col("doc_id").alias("doc"), "set_key", "bands").join(classes, ["doc", "set_key"])
    keyed = banded.select("doc", F.explode("bands").alias("key"))
    met = keyed.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key")
    met = materialize(keyed.join(met, "key").distinct(), "near-met")
    buckets = met.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc")).alias("print"))
    shared = materialize(met.join(buckets, "key"), "near-buckets")
    meets = shared.groupBy("doc").agg(F.sum("n").alias("meets"))
    leads = shared.join(meets, "doc").groupBy("key").agg(F.max_by("doc", F.struct("meets", -F.col("doc"))).alias("lead"))
    members = materialize(shared.join(leads, "key"), "near-members")

    squeezed = texts.where("doc_id is not null").mapInArrow(_squeezed, "doc_id long, packed binary")
    squeezed = materialize(squeezed.join(members.select(F.col("doc").alias("doc_id")).distinct(), "doc_id"), "near-texts")

    links = materialize(_verified(squeezed, members.where("doc <> lead").select("lead", "doc").distinct()), "near-links")
    comps = components(links)

    labelled = members.where("n > 2").join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    open_ = (
        labelled.groupBy("key", "lead", "n", "print")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where("low < high")
        .groupBy("lead", "n", "print")  # of buckets of the same classes, one is enough
        .agg(F.min("key").alias("key"))
    )
    still = materialize(labelled.join(open_.select("key"), "key").select("key", "lead", "doc", "comp", "n"), "near-open")
    by_doc = squeezed.withColumnRenamed("doc_id", "doc")
    within = still.where(F.col("n") <= SMALL).join(by_doc, "doc").select("key", "doc", "comp", "packed")
    within = within.groupBy("key").applyInArrow(_within_bucket, "a long, b long")
    large = still.where(F.col("n") > SMALL)
    shares = large.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("docs"))
    major = shares.groupBy("key").agg(F.max_by("comp", F.struct("docs", "comp")).alias("major"))
    minor = F.max(F.col("comp") != F.col("major")).alias("minor")
    lead = F.max_by("lead", F.struct("n", "lead")).alias("lead")
    across = _verified(squeezed, _candidates(by_doc, large.join(major, "key").groupBy("doc", "comp").agg(minor, lead)))
    more = materialize(within.unionByName(across), "near-more")
    if more.limit(1).count():
        named = comps.select("node", "comp")
        ends = more
        for side in ("a", "b"):
            ends = ends.join(named.select(F.col("node").alias(side), F.col("comp").alias(f"{side}_comp")), side, "left")
        joined = components(ends.select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")))
        joined = joined.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        alone = joined.select(F.col("comp").alias("node"), F.col("top").alias("comp")).join(comps.select("node"), "node", "left_anti")
        comps = comps.join(joined, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")).unionByName(alone)

    named = classes.join(comps, F.col("doc") == F.col("node"), "left").select("set_key", F.coalesce("comp", "doc").alias("component"))
    component = F.coalesce("component", "doc_id")
    return sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(named, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _verified(texts: DataFrame, edges: DataFrame) -> DataFrame:
    """The (lead, doc) pairs that are linked, as (a, b). A leader's members are dealt out by
    BLOCK or so; only its own text is repeated for each lot."""
    lots = edges.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("lots"))
    dealt = edges.join(lots, "lead").withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("lots")))
    leads = lots.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("salt"))
    needed = dealt.select("lead", "salt", F.lit(1).alias("kind"), F.col("doc").alias("doc_id")).unionByName(
        leads.select("lead", "salt", F.lit(0).alias("kind"), F.col("lead").alias("doc_id"))
    )
    # Written first, so that texts are not shuffled where Spark can broadcast what is needed.
    needed = materialize(needed, "near-needed")
    rows = needed.join(texts, "doc_id").select("lead", "salt", "kind", "doc_id", "packed")
    rows = rows.repartition("lead", "salt").sortWithinPartitions("lead", "salt", "kind")
    return rows.mapInArrow(_against_leader, "a long, b long")


def _candidates(by_doc: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (lead, doc) of members (doc, comp, minor, lead) of different components that
    can be linked; minor are those outside the commonest component of some bucket, of which
    each pair that shares a bucket has one. Members of a leader are dealt out in lots.

    Shingles that only one component has are left out of its sets, the rest is ordered by
    rarity. Linked sets x and y have 3/7 of |x| + |y| shingles in common, at least three
    quarters of either, so the first common one is among the first quarter of x and of y, less
    those left out, and as many are from there on (prefix and position filters: Bayardo et al.
    2007, Xiao et al. 2008). A lot has one row for each of its distinct shingles, however many
    of its sets have it, and each set at most a quarter of its shingles.
    """
    members = materialize(members, "near-large")
    sets = members.join(by_doc, "doc").select("doc", "comp", "minor", "lead", "packed")
    sets = materialize(sets.mapInArrow(_grams, "doc long, comp long, minor boolean, lead long, size long, grams array<long>"), "near-grams")
    lots = sets.groupBy("lead").agg(F.ceil(F.greatest(F.count(F.lit(1)) / LOT, F.sum("size") / LOT_SHINGLES)).alias("lots"))
    dealt = sets.join(lots, "lead").withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("lots"))).drop("lots")
    # Else the join's dealing by lead alone is enough for Spark, with all lots of one in a task.
    lot = dealt.repartition("lead", "salt").groupBy("lead", "salt")
    grams = materialize(lot.applyInArrow(_lot_grams, "lead long, salt long, gram long, n long, low long, high long"), "near-lot-grams")
    known = grams.groupBy("gram").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    shared = grams.select("lead", "salt", "gram").join(known.where("low < high").select("gram", "n"), "gram")
    posts = lot.cogroup(shared.groupBy("lead", "salt")).applyInArrow(_prefixes, "doc long, comp long, minor boolean, size long, rest long, gram long")
    posts = materialize(posts, "near-posts")
    x, y = posts.where("minor").alias("x"), posts.alias("y")
    low, high = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    can = (
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.comp") != F.col("y.comp"))
        & (100 * low >= PERCENT * high)
        & (7 * F.least("x.rest", "y.rest") >= 3 * (low + high))
    )
    return x.join(y, can).select(F.least("x.doc", "y.doc").alias("lead"), F.greatest("x.doc", "y.doc").alias("doc")).distinct()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which near_duplicates keeps the id, with all their columns,
    whatever their names. Rows without an id stay, and so do all rows that repeat an id that
    stays. Null, empty and very long texts: see near_duplicates. An empty table gives no rows.
    """
    kept = near_duplicates(docs, id_col, text_col).where("kept and doc_id is not null").select("doc_id").distinct()
    keep = docs.alias("docs").join(kept.alias("kept"), F.col(f"docs.{id_col}") == F.col("kept.doc_id"), "left_semi")
    return keep.unionByName(docs.where(F.col(id_col).isNull()))
