"""Packing of token ids into sequences: concatenate and cut."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, small_batches, texts_of
from .tokens import encoder

LENGTH = 2048


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    All documents' ids, each document's with the end id, lie end to end, partition after
    partition, and are cut every `length` ids: every sequence but the last is full. A
    document that crosses a cut has a piece on either side of it. start counts its ids
    before the piece, offset the sequence's. A null text counts as empty: its only id is the
    end id. Null ids, repeated rows and texts of any length are documents like others. Other
    columns are not read. An empty table gives no rows.

    The first pass encodes, counts ids within each partition and writes both; prefix sums
    over the partitions' totals (one row each) then give each partition its place, and the
    second pass cuts what the first has written.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer).encode
        for batch in batches:
            ids = encode(texts_of(batch))
            n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(ids), part, dtype=np.int32)),
                    "at": pa.array(at + np.cumsum(n) - n),
                    "n": pa.array(n),
                    "doc_id": batch.column(0),
                    "ids": pa.array(ids, pa.binary()),
                }
            )
            at += int(n.sum())

    tokens = materialize(texts.mapInArrow(encoded, f"part int, at long, n long, doc_id {kind}, ids binary"), "packing-ids")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("first"))
    placed = tokens.join(F.broadcast(starts), "part").select((F.col("first") + F.col("at")).alias("at"), "n", "doc_id", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, lengths, crcs, places, pieces = [], [], [], [], [], []
            for row, (at, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                raw = batch.column(3)[row].as_buffer()
                bounds = [0, *range(length - at % length, n, length), n]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    piece = raw[4 * a : 4 * b]
                    rows.append(row), starts.append(a), lengths.append(b - a), places.append(at + a)
                    crcs.append(zlib.crc32(piece))
                    if with_ids:
                        pieces.append(np.frombuffer(piece, dtype="<u4").astype(np.int64))
            place = np.array(places, dtype=np.int64)
            of = pa.array(rows, pa.int64())
            columns = {
                "doc_id": batch.column(2).take(of),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": batch.column(1).take(of),
                "sequence_id": pa.array(place // length),
                "offset": pa.array(place % length),
            }
            if with_ids:
                columns["ids"] = pa.array(pieces, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<long>" * with_ids
    return placed.mapInArrow(cut, schema)
