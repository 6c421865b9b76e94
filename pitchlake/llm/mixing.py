"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, n_words

WEIGHTS = (5.0, 2.0, 1.0)
#: No source is taken more often than this, as a whole and in each of its words.
MOST = 3
#: Words of a block, whatever the input's size.
BLOCK_WORDS = 1024
#: Slots that are ranked together.
SLOT_RANGE = 65536
#: Golden-ratio points on a ring of 2^31: the multiplier is odd and next to 2^31 / 1.618.
RING, STEP = 1 << 31, 1327217885


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Words to take from each source. Sources by code point, null last, weigh as given in
    turn and share the sum of all sizes; what exceeds `most` times a source's size is shared
    again among the others by weight, until no source exceeds it."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out = dict.fromkeys(names, 0.0)
    left, rest = float(sum(sizes.values())), names
    while rest:
        unit = left / sum(weight[s] for s in rest)
        full = [s for s in rest if unit * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in rest}
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        rest = [s for s in rest if s not in set(full)]
    return out


def _ranked(slots: DataFrame) -> DataFrame:
    """Slots (slot, number) with rank: the slots of the same source before each."""
    slots = slots.withColumn("range", F.expr(f"slot div {SLOT_RANGE}"))
    counts = slots.groupBy("number", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("number", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("number", "range").orderBy("slot"))
    return slots.withColumn("place", place).join(starts, ["number", "range"]).select("slot", "number", (F.col("first") + F.col("place") - 1).alias("rank"))


def _chosen(point: Column, bounds: list[int]) -> Column:
    """The number of the source whose part of the ring has the point."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*(F.lit(b).cast("long") for b in bounds)), lambda b: b <= point))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, first_slot.

    size is the text's words (0 if null); target is as in targets(); taken counts the words
    of the document that the mix takes, repeats included: at most `most` times size, and for
    each source in sum its target, rounded down. first_slot is the first slot of the mix
    that takes from the document, null if none does. See mix_schedule for the mix itself.

    A null source is a source of its own; rows without or with repeated ids are rows like
    others; of rows that are alike in id and text, whichever is taken more often, the rows
    returned are the same. Nothing is drawn at random, so reruns agree, however the rows are
    dealt to partitions. Documents without words take no part, with taken 0. Texts of any
    length are cut into blocks. Other columns are not read. An empty table gives no rows.
    Sources are names of a few collections: the driver holds one number for each.
    """
    rows, taken = _planned(_numbered(docs, id_col, text_col, source_col), weights, most, block_words)
    taken = taken.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot"
    )


def mix_schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mix in pieces, to be read by (slot, place): slot, place, source, doc_id, start, words.

    A source's documents, shuffled by a hash of their ids and texts, are laid end to end and
    cut into blocks of block_words words; a source that is to give more than its size is
    gone through several times, and its last pass ends where its target does. Slot i of the
    mix takes the source in whose part of the ring of cumulative numbers of slots the i-th
    golden-ratio point lies; a source's r-th slot takes its r-th block. Slots of a source
    beyond its last block stay empty; the few that are missing to it follow at the end.
    start and words tell which words of the document a piece has, place where it lies in its
    block. Null sources, ids and texts are as in mixed(). An empty table gives no rows.
    """
    _, taken = _planned(_numbered(docs, id_col, text_col, source_col), weights, most, block_words)
    return taken.select("slot", "place", "source", "doc_id", "start", "words")


def _numbered(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, doc_id, source, size, shuffle), written, so that row is the same each time it is read."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), *_of_text(id_col, text_col, source_col))
    return materialize(rows, "mix-rows")


def _of_text(id_col: str, text_col: str, source_col: str) -> list[Column]:
    shuffle = F.md5(F.concat_ws(" ", F.lit("mix"), F.col(id_col).cast("string"), F.md5(F.col(text_col))))
    return [F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), shuffle.alias("shuffle")]


def _planned(rows: DataFrame, weights: Sequence[float], most: int, block: int) -> tuple[DataFrame, DataFrame]:
    """rows with number, source_size and target, and what the slots take of them: (row, slot,
    time, place, start, words, source, doc_id), where time counts a source's passes from 0."""
    sizes = {r.source: r.size for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    target = targets(sizes, weights, most)
    sources, passed = [], 0
    for i, (s, t) in enumerate(target.items()):
        blocks, (times, rest) = -(-sizes[s] // block), divmod(int(t), sizes[s]) if sizes[s] else (0, 0)
        needed = times * blocks + -(-rest // block)
        sources.append((i, s, sizes[s], t, blocks, times, rest, needed))
        passed += needed
    n_slots, bounds, so_far = passed, [], 0
    for *_, needed in sources[:-1]:
        so_far += needed
        bounds.append(int(so_far / max(1, n_slots) * RING))

    spark = rows.sparkSession
    # One row for each source: Spark broadcasts it by its size.
    known = spark.createDataFrame(sources, "number int, name string, source_size long, target double, blocks long, times long, rest long, needed long")
    rows = rows.join(known.select("number", "name", "source_size", "target"), F.col("source").eqNullSafe(F.col("name"))).drop("name")

    part = F.substring("shuffle", 1, 3)
    parts = rows.groupBy("number", part.alias("part")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("number", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("number", "part").orderBy("shuffle", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("part", part).withColumn("within", F.coalesce(F.sum("size").over(order), F.lit(0)))
    laid = laid.join(starts, ["number", "part"]).withColumn("at", F.col("first") + F.col("within")).where("size > 0")
    first, last = F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}")
    pieces = laid.select("row", "number", "source", "doc_id", "at", "size", F.explode(F.sequence(first, last)).alias("block"))

    point = F.expr(f"((id % {RING}L) * {STEP}L) % {RING}L")
    slots = materialize(_ranked(spark.range(n_slots).select(F.col("id").alias("slot"), _chosen(point, bounds).alias("number"))), "mix-slots")
    found = known.join(slots.groupBy("number").agg(F.count(F.lit(1)).alias("have")), "number", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("long")))
    missing = found.where("have < needed").select("number", "have", F.explode(F.sequence("have", F.col("needed") - 1)).alias("rank"))
    missing = missing.select((n_slots + (F.col("rank") - F.col("have")) * len(sources) + F.col("number")).alias("slot"), "number", "rank")
    slots = slots.unionByName(missing).join(known.select("number", "source_size", "blocks", "times", "rest", "needed"), "number").where("rank < needed")
    time = F.expr("rank div blocks")
    ends = F.when(time < F.col("times"), F.col("source_size")).otherwise(F.col("rest"))
    slots = slots.select("slot", "number", time.alias("time"), (F.col("rank") % F.col("blocks")).alias("block"), ends.alias("ends"))
    taken = pieces.join(slots, ["number", "block"])
    begin = F.greatest(F.col("at"), F.col("block") * block)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block, F.col("ends"))
    taken = taken.select(
        "row", "slot", "time", (begin - F.col("block") * block).alias("place"), (begin - F.col("at")).alias("start"), (end - begin).alias("words"), "source", "doc_id"
    )
    return rows, taken.where("words > 0")


def taken_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as the mix takes them, in the order of the mix.

    A pass through a source takes each of its documents; of the last pass, which ends within
    a document, that one is taken if half of its words are. So a source is shifted by half a
    document at most. Documents without words are not taken. Each row is taken as mixed()
    says of that row, whether it has an id, repeats one or not; null sources are one source.
    A row comes at the slot that its first words have: rows are dealt in ranges of slots and
    sorted within, so that what is read together, or packed together, is mixed. All columns
    stay. An empty table gives no rows.
    """
    numbered = materialize(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-documents")
    rows = numbered.select("row", F.col(f"doc.{id_col}").alias("doc_id"), *_of_text(f"doc.{id_col}", f"doc.{text_col}", f"doc.{source_col}"))
    rows, taken = _planned(rows, WEIGHTS, MOST, BLOCK_WORDS)
    whole = taken.groupBy("row", "time").agg(F.sum("words").alias("words"), F.min(F.struct("slot", "place")).alias("at"))
    whole = materialize(whole.join(rows.select("row", "size"), "row").where("2 * words >= size").select("row", "at"), "mix-taken")
    found = numbered.join(whole, "row").repartitionByRange("at").sortWithinPartitions("at")
    return found.select("doc.*")
