"""Exact top-k inner-product search with block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, small_batches

#: Rows of a document-range block; blocks of a cell and queries of a lot, at most; cells whose
#: maxima are looked at together.
BLOCK_ROWS, CELL_BLOCKS, CELL_QUERIES = 1024, 64, 2048
SHEET_CELLS = 4096


def quantized(vector: Column) -> Column:
    """floor(1024 * x) of each component; null for vectors that take no part: null ones and
    those with null or infinite components or NaN."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("long"))
    return F.when(~F.coalesce(bad, F.lit(False)), whole)


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _exactly(*parts: np.ndarray) -> type:
    """float64 where products of such rows stay exact in it, else Python's integers."""
    most = 1.0
    for p in parts:
        most *= float(np.abs(p.astype(np.float64)).max(initial=0))
    return np.float64 if most * parts[0].shape[1] < 2**53 else object


def _ranked(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=np.int64)
    return np.lexsort((ids, -scores))


class Blocks:
    """Blocks of rows with forward indexes (id and all terms of a row) and term extremes."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, matrix: np.ndarray):
        order = np.lexsort((ids, numbers))
        self.ids, self.matrix = ids[order], matrix[order]
        cuts = np.flatnonzero(np.diff(numbers[order])) + 1
        self.begins, self.ends = np.append(0, cuts), np.append(cuts, len(ids))
        self.high = np.maximum.reduceat(self.matrix, self.begins, axis=0)
        self.low = np.minimum.reduceat(self.matrix, self.begins, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and block the sum over terms of the most that a row can score."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def best(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """(score, id) of the k best rows but the query's own, ties to the smaller id; of
        those that score `least` or more, if it is given."""
        scores, ids = query[:0], self.ids[:0]
        for b in np.argsort(-bounds, kind="stable"):
            if least is not None and bounds[b] < least or len(scores) == k and bounds[b] < scores[-1]:
                break
            rows = slice(self.begins[b], self.ends[b])
            found, own = self.matrix[rows] @ query, self.ids[rows]
            keep = own != query_id
            if least is not None:
                keep &= found >= least
            if len(scores) == k:
                keep &= found >= scores[-1]
            scores, ids = np.concatenate([scores, found[keep]]), np.concatenate([ids, own[keep]])
            order = _ranked(scores, ids)[:k]
            scores, ids = scores[order], ids[order]
        return list(zip(map(int, scores), ids.tolist(), strict=True))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).astype(np.int64) if values else np.empty(0, dtype=np.int64)))


def _arrays(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in column]


def _merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term maxima and minima of a cell from those of its blocks."""
    highs, lows = [], []
    for batch in batches:
        highs += _arrays(batch.column(batch.schema.get_field_index("high")))
        lows += _arrays(batch.column(batch.schema.get_field_index("low")))
    width = max(map(len, highs))
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int64()), _lists([_matrix(highs, width).max(axis=0)]), _lists([_matrix(lows, width).min(axis=0)])], names=["cell", "high", "low"]
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    block_rows: int = BLOCK_ROWS,
    cell_blocks: int = CELL_BLOCKS,
    cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """Each query's k highest scores among vectors: query_id, rank, vec_id, score.

    Both tables are (vec_id long, embedding array). The score is the integer inner product
    of the quantized components, ties go to the smaller vec_id, and a query's own id is no
    candidate. Vectors that are null or hold null or non-finite components take no part, nor
    do rows without an id; missing components of shorter vectors count as 0. Of rows that
    repeat an id, each is a candidate and, as a query, the one with the greatest components.
    With fewer than k candidates all are returned; without any, or with an empty table, none.
    A score that 64 bits can't hold is an error. Other columns are not read.

    Vectors, in order of their ids, are packed into blocks with the extremes of each term;
    blocks into cells, of cell_blocks at most and as many that all cores have some. First
    each query is scored in the cell of its greatest bound (the sum of term maxima), which
    gives it a k-th score. Then it is sent to those other cells only whose bound reaches
    that; only term maxima are looked at for this, in sheets against lots of queries. In a
    cell each query scores the blocks by falling bound through their forward indexes, until
    the bound is below its k-th score. Lots of queries keep every group bounded.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    terms = quantized(F.col("embedding"))
    rows = vectors.select(F.col("vec_id").cast("long"), terms.alias("terms")).where("vec_id is not null and terms is not null")
    asked = queries.select(F.col("vec_id").cast("long"), terms.alias("terms")).where("vec_id is not null and terms is not null")
    asked = asked.groupBy("vec_id").agg(F.max("terms").alias("terms"))
    n_rows = rows.count()
    deep = max(1, min(cell_blocks, n_rows // (2 * block_rows * spark.sparkContext.defaultParallelism)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, part = [], 0, TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            nonlocal number, held
            ids, found = zip(*held, strict=True)
            matrix = _matrix(found, max(map(len, found)))
            columns = {
                "cell": pa.array([(part << 40) + number // deep], pa.int64()),
                "ids": _lists([np.array(ids, dtype=np.int64)]),
                "terms": _lists([matrix.ravel()]),
                "high": _lists([matrix.max(axis=0)]),
                "low": _lists([matrix.min(axis=0)]),
            }
            number, held = number + 1, []
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), _arrays(batch.column(1)), strict=True):
                held.append(row)
                if len(held) == block_rows:
                    yield block()
        if held:
            yield block()

    longs = "array<long>"
    ordered = rows.repartitionByRange("vec_id", F.xxhash64("terms")).sortWithinPartitions("vec_id")
    blocks = materialize(ordered.mapInArrow(pack, f"cell long, ids {longs}, terms {longs}, high {longs}, low {longs}"), "search-blocks")
    cells = materialize(blocks.select("cell", "high", "low").groupBy("cell").applyInArrow(_merged, f"cell long, high {longs}, low {longs}"), "search-cells")
    asked = materialize(asked, "search-queries")
    n_sheets, n_lots = max(1, -(-cells.count() // SHEET_CELLS)), max(1, -(-asked.count() // cell_queries))
    asked = asked.withColumn("lot", F.pmod(F.xxhash64("vec_id"), F.lit(n_lots)).cast("int"))
    every_lot, every_sheet = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (n_lots, n_sheets))
    sheets = cells.withColumn("sheet", F.pmod(F.xxhash64("cell"), F.lit(n_sheets)).cast("int")).withColumn("lot", every_lot)

    def bounds_of(posed: DataFrame, first: bool) -> DataFrame:
        """(vec_id, cell, bound): the cell of each query's greatest bound in a sheet, or all
        other cells than its own whose bound reaches `least`."""

        def reach(_: tuple[pa.Scalar, ...], asking: pa.Table, maxima: pa.Table) -> pa.Table:
            out: list[tuple[int, int, float]] = []
            if asking.num_rows and maxima.num_rows:
                wanted, high, low = _arrays(asking["terms"]), _arrays(maxima["high"]), _arrays(maxima["low"])
                width = max(map(len, [*wanted, *high]))
                wanted, high, low = (_matrix(m, width) for m in (wanted, high, low))
                kind = _exactly(wanted, np.maximum(np.abs(high), np.abs(low)))
                wanted, high, low = (m.astype(kind) for m in (wanted, high, low))
                bounds = np.maximum(wanted, 0) @ high.T + np.minimum(wanted, 0) @ low.T
                numbers = np.array(maxima["cell"].to_pylist(), dtype=np.int64)
                for q, own, least, b in zip(*(asking[c].to_pylist() for c in ("vec_id", "own", "least")), bounds, strict=True):
                    if first:
                        at = [int(np.argmax(b))]
                    else:
                        at = np.flatnonzero((numbers != own) & (True if least is None else b >= least)).tolist()
                    out += [(q, int(numbers[i]), float(b[i])) for i in at]
            columns = list(zip(*out, strict=True)) or [()] * 3
            return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["vec_id", "cell", "bound"])

        posed = posed.withColumn("sheet", every_sheet).groupBy("sheet", "lot")
        return posed.cogroup(sheets.groupBy("sheet", "lot")).applyInArrow(reach, "vec_id long, cell long, bound double")

    def scored(pairs: DataFrame) -> DataFrame:
        """The best of each (cell, lot, vec_id, terms, least)."""

        def cell(_: tuple[pa.Scalar, ...], asking: pa.Table, packed: pa.Table) -> pa.Table:
            found: list[tuple[int, int, int]] = []
            if asking.num_rows and packed.num_rows:
                ids, wanted = _arrays(packed["ids"]), _arrays(asking["terms"])
                parts = [t.reshape(len(i), -1) for i, t in zip(ids, _arrays(packed["terms"]), strict=True)]
                width = max(*(p.shape[1] for p in parts), *map(len, wanted))
                matrix = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
                wanted = _matrix(wanted, width)
                kind = _exactly(wanted, matrix)
                blocks = Blocks(np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.concatenate(ids), matrix.astype(kind))
                wanted = wanted.astype(kind)
                for q, least, terms_of_q, bounds in zip(asking["vec_id"].to_pylist(), asking["least"].to_pylist(), wanted, blocks.bounds(wanted), strict=True):
                    found += [(q, i, s) for s, i in blocks.best(q, terms_of_q, bounds, k, least)]
            columns = list(zip(*found, strict=True)) or [()] * 3
            return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

        pairs = materialize(pairs, "search-pairs")
        needed = pairs.select("cell", "lot").distinct().join(blocks.select("cell", "ids", "terms"), "cell")
        needed = needed.select(F.col("cell").alias("its_cell"), F.col("lot").alias("its_lot"), "ids", "terms")
        return pairs.groupBy("cell", "lot").cogroup(needed.groupBy("its_cell", "its_lot")).applyInArrow(cell, "query_id long, vec_id long, score long")

    nothing = {"own": F.lit(None).cast("long"), "least": F.lit(None).cast("long")}
    seeds = bounds_of(asked.withColumns(nothing), True).groupBy("vec_id").agg(F.max_by("cell", F.struct("bound", "cell")).alias("own"))
    seeds = materialize(seeds, "search-seeds")
    first = materialize(scored(asked.join(seeds, "vec_id").select(F.col("own").alias("cell"), "lot", "vec_id", "terms", nothing["least"].alias("least"))), "search-first")
    least = F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")
    known = asked.join(seeds, "vec_id").join(first.groupBy(F.col("query_id").alias("vec_id")).agg(least), "vec_id", "left")
    rest = bounds_of(known, False).select("vec_id", "cell").join(known, "vec_id").select("cell", "lot", "vec_id", "terms", "least")
    found = first.unionByName(scored(rest))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
