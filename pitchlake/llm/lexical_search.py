"""Ranked lexical search: hashed max-sketches of documents, exact rescoring by falling bounds."""

from __future__ import annotations

import math
from collections import Counter, OrderedDict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, pieces, small_batches, texts_of, word_hashes

#: Coordinates of a sketch.
WIDTH = 1024
#: Documents, and terms of documents, after which a block of the index ends.
BLOCK_DOCS, BLOCK_TERMS = 1024, 1 << 17
#: Queries, and terms of queries, after which a block of queries ends.
BLOCK_QUERIES, QUERY_TERMS = 1024, 1 << 16
#: One block in so many is searched first, for a score that the best ones reach.
LOTS = 64
#: Documents that are scored first, then twice as many each time; query blocks that a task
#: keeps ready.
STEP, READY = 16, 8
#: Bounds are sums of doubles, which can be rounded down where queries are very long.
SLACK = 1 + 2.0**-40

_UPPER = range(0x41, 0x5B)
_TERM = bytes(b + 0x20 if b in _UPPER else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

_INDEX = "ids array<long>, n_docs long, n_terms long, lengths binary, sizes binary, vocabulary binary, spread binary, places binary, counts binary"
_QUERIES = "items array<long>, q_sizes binary, q_terms binary, q_counts binary"


def term_counts(text: bytes | None) -> Counter[bytes]:
    """A text's terms, which are runs of ASCII letters and digits and of all characters that
    are not ASCII, with A-Z in lower case; the words of a very long text are not all held."""
    found: Counter[bytes] = Counter()
    for piece in pieces(text or b""):
        found.update(piece.translate(_TERM).split())
    return found


def _raw(x, kind: type) -> bytes:
    return np.asarray(x, dtype=kind).tobytes()


def _block(held: list[tuple[int | None, Counter]], lengths: list[int]) -> pa.RecordBatch:
    known: dict[bytes, int] = {}
    places = [known.setdefault(t, len(known)) for _, terms in held for t in terms]
    hashes = word_hashes(list(known))
    order = np.argsort(hashes)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    spread = np.bincount(places, minlength=len(order))[order]
    counts = [n for _, terms in held for n in terms.values()]
    row = {
        "ids": pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
        "n_docs": pa.array([len(held)], pa.int64()),
        "n_terms": pa.array([sum(lengths)], pa.int64()),
        "lengths": _raw(lengths, np.int64),
        "sizes": _raw([len(terms) for _, terms in held], np.int32),
        "vocabulary": _raw(hashes[order], np.uint64),
        "spread": _raw(spread, np.int32),
        "places": _raw(rank[places], np.int32),
        "counts": _raw(counts, np.int32),
    }
    return pa.RecordBatch.from_pydict({k: pa.array([v], pa.binary()) if isinstance(v, bytes) else v for k, v in row.items()})


def _indexed(batches: Iterator[pa.RecordBatch], most_docs: int = BLOCK_DOCS, most_terms: int = BLOCK_TERMS) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive documents that have terms: their ids, and forward lists of the
    places of their terms in the block's sorted vocabulary, with counts."""
    held: list[tuple[int | None, Counter]] = []
    lengths: list[int] = []
    size = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
            if terms := term_counts(text):
                held.append((doc, terms))
                lengths.append(terms.total())
                size += len(terms)
            if len(held) >= most_docs or size >= most_terms:
                yield _block(held, lengths)
                held, lengths, size = [], [], 0
    if held:
        yield _block(held, lengths)


def _asked(batches: Iterator[pa.RecordBatch], most_queries: int = BLOCK_QUERIES, most_terms: int = QUERY_TERMS) -> Iterator[pa.RecordBatch]:
    """Blocks of queries, with the hashes of their distinct terms and how often each is repeated."""
    held: list[tuple[int | None, Counter]] = []

    def block() -> pa.RecordBatch:
        row = {
            "q_sizes": _raw([len(terms) for _, terms in held], np.int32),
            "q_terms": word_hashes([t for _, terms in held for t in terms]).tobytes(),
            "q_counts": _raw([n for _, terms in held for n in terms.values()], np.int64),
        }
        items = pa.array([[i for i, _ in held]], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict({"items": items, **{k: pa.array([v], pa.binary()) for k, v in row.items()}})

    size = 0
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
            terms = term_counts(text)
            if not terms:
                continue
            held.append((item, terms))
            size += len(terms)
            if len(held) >= most_queries or size >= most_terms:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n) of each block's vocabulary: in how many of its documents a term is."""
    for batch in batches:
        for vocabulary, spread in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            terms = np.frombuffer(vocabulary, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms), "n": pa.array(np.frombuffer(spread, dtype=np.int32).astype(np.int64))})


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = np.unique(np.frombuffer(terms, dtype=np.int64))
            yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(found), block, dtype=np.int64)), "term": pa.array(found)})


def weight(n: int, df: int) -> int:
    """The weight of a term that is in df of n documents with terms."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class _Queries:
    """A block of queries: weights of its terms, and for each query the terms and how often."""

    def __init__(self, row: dict, n_docs: int, width: int):
        known = sorted((np.uint64(t["term"] % 2**64), t["df"]) for t in row["known"] or ())
        self.vocabulary = np.array([t for t, _ in known], dtype=np.uint64)
        self.weights = np.array([weight(n_docs, df) for _, df in known], dtype=np.int64)
        self.coordinate = (self.vocabulary % np.uint64(width)).astype(np.int64)
        terms = np.frombuffer(row["q_terms"], dtype=np.uint64)
        counts = np.frombuffer(row["q_counts"], dtype=np.int64)
        query = np.repeat(np.arange(len(row["items"])), np.frombuffer(row["q_sizes"], dtype=np.int32))
        place = np.searchsorted(self.vocabulary, terms)
        there = np.flatnonzero(self.vocabulary[np.minimum(place, len(known) - 1)] == terms) if known else np.empty(0, dtype=np.int64)
        self.place, self.count, query = place[there], counts[there], query[there]
        self.begin = np.searchsorted(query, np.arange(len(row["items"]) + 1))
        self.lookup = np.zeros((width, len(row["items"])))
        np.add.at(self.lookup, (self.coordinate[self.place], query), self.count)
        self.wanted = np.zeros(len(known), dtype=np.int64)


class _Documents:
    """A block of documents: the impacts of those of their terms that a block of queries has."""

    def __init__(self, row: dict, queries: _Queries, n_docs: int, n_terms: int):
        self.ids = row["ids"]
        vocabulary = np.frombuffer(row["vocabulary"], dtype=np.uint64)
        at = np.minimum(np.searchsorted(queries.vocabulary, vocabulary), max(0, len(queries.vocabulary) - 1))
        known = queries.vocabulary[at] == vocabulary if len(queries.vocabulary) else np.zeros(len(vocabulary), dtype=bool)
        place = np.frombuffer(row["places"], dtype=np.int32)
        some = np.flatnonzero(known[place])
        doc = np.repeat(np.arange(len(self.ids)), np.frombuffer(row["sizes"], dtype=np.int32))[some]
        self.term = at[place[some]]
        tf = np.frombuffer(row["counts"], dtype=np.int32)[some].astype(np.int64)
        lengths = np.frombuffer(row["lengths"], dtype=np.int64)
        m = 100 - 25 + (25 * lengths * n_docs) // n_terms
        self.impact = queries.weights[self.term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        self.begin = np.searchsorted(doc, np.arange(len(self.ids) + 1))
        self.doc = doc

    def sketches(self, coordinate: np.ndarray, width: int) -> np.ndarray:
        """For each document the greatest impact of its terms at each coordinate. A row times
        a query's counts of coordinates is at least the document's score."""
        out = np.zeros(len(self.ids) * width, dtype=np.int64)
        key = self.doc * width + coordinate[self.term]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
        if len(first):
            out[key[first]] = np.maximum.reduceat(self.impact[order], first)
        return out.reshape(len(self.ids), width).astype(np.float64)

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The exact scores of some documents, for a query's counts of its vocabulary's terms."""
        n = self.begin[docs + 1] - self.begin[docs]
        skip = np.repeat(self.begin[docs] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        at = np.arange(int(n.sum())) + skip
        out = np.zeros(len(docs), dtype=np.int64)
        np.add.at(out, np.repeat(np.arange(len(docs)), n), self.impact[at] * wanted[self.term[at]])
        return out


class _Best:
    """The k best (score, id) of a query so far, above 0 and not below `least`."""

    def __init__(self, k: int, least: int):
        self.k, self.least, self.scores, self.ids = k, max(1, least), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.least
        scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def _meet(documents: _Documents, queries: _Queries, best: list[_Best], width: int) -> None:
    """Score documents for all queries by falling bound, each query until the bound is below
    the score of its k-th best."""
    bounds = documents.sketches(queries.coordinate, width) @ queries.lookup
    bounds *= SLACK
    ids = np.array([0 if i is None else i for i in documents.ids], dtype=np.int64)
    bounds[np.array([i is None for i in documents.ids], dtype=bool)] = 0
    least = np.array([b.least for b in best], dtype=np.float64)
    for q in np.flatnonzero((bounds >= least).any(axis=0)).tolist():
        docs = np.flatnonzero(bounds[:, q] >= least[q])
        docs = docs[np.argsort(-bounds[docs, q], kind="stable")]
        mine = slice(queries.begin[q], queries.begin[q + 1])
        queries.wanted[queries.place[mine]] = queries.count[mine]
        i, step = 0, STEP
        while i < len(docs) and bounds[docs[i], q] >= best[q].least:
            some = docs[i : i + step]
            best[q].add(documents.scores(some, queries.wanted), ids[some])
            i, step = i + step, 2 * step
        queries.wanted[queries.place[mine]] = 0


def _found(pairs: DataFrame, n_docs: int, n_terms: int, k: int, width: int) -> DataFrame:
    """(block, query, item_id, doc_id, score): the k best of each query in each partition of
    pairs of a block of documents and a block of queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: OrderedDict[int, _Queries] = OrderedDict()
        best: dict[int, list[_Best]] = {}
        items: dict[int, list] = {}
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}

            def values(i: int, *names: str) -> dict:
                return {name: columns[name][i].as_py() for name in names}  # noqa: B023

            for i, block in enumerate(columns["block"].to_pylist()):
                if block not in best:
                    row = values(i, "items", "floor")
                    floor = row["floor"] or [0] * len(row["items"])
                    best[block], items[block] = [_Best(k, f or 0) for f in floor], row["items"]
                if block not in ready:
                    ready[block] = _Queries(values(i, "known", "items", "q_terms", "q_sizes", "q_counts"), n_docs, width)
                    while len(ready) > READY:
                        ready.popitem(last=False)
                queries = ready[block]
                if len(queries.vocabulary):
                    row = values(i, "ids", "lengths", "sizes", "vocabulary", "places", "counts")
                    _meet(_Documents(row, queries, n_docs, n_terms), queries, best[block], width)
        for block, found in best.items():
            n = [len(b.ids) for b in found]
            query = np.repeat(np.arange(len(found)), n)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(query), block, dtype=np.int64)),
                    "query": pa.array(query, pa.int32()),
                    "item_id": pa.array([items[block][q] for q in query.tolist()], pa.int64()),
                    "doc_id": pa.array(np.concatenate([b.ids for b in found])),
                    "score": pa.array(np.concatenate([b.scores for b in found])),
                }
            )

    return pairs.mapInArrow(search, "block long, query int, item_id long, doc_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    width: int = WIDTH,
    doc_block: tuple[int, int] = (BLOCK_DOCS, BLOCK_TERMS),
    query_block: tuple[int, int] = (BLOCK_QUERIES, QUERY_TERMS),
    lots: int = LOTS,
) -> DataFrame:
    """For each row of queries its k best documents: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of characters that are not ASCII, of whole
    texts, with only A-Z in lower case. With N documents that have terms, L terms in all of
    them with repeats, n terms in a document, df documents that hold a term and tf times that
    a document holds it, a term's weight w is floor(1000 ln((2 N + 2) / (2 df + 1))), m of a document is
    75 + 25 n N div L, and a score is the sum of w ((10^9 tf) div (1000 tf + 12 m)) over the
    query's terms, repeats included. Only scores above 0 count; equal ones go by doc_id.

    Null and empty texts, and those without a term, are no documents and find none. Rows
    without an id count in N, L and df, but are not returned. Rows that repeat are each a
    document, or a query, of their own; a query without an id is returned without one. Fewer
    than k documents are all that there are; empty tables give no rows. Other columns are not
    read. Terms are told apart by 64-bit hashes.

    Documents are written once as blocks of forward lists. Statistics of the queries' terms
    are sums over blocks. A document's impacts (w times the quotient, of those of its terms that
    the block of queries has) fold into a sketch: hashed coordinates, each with the greatest impact at
    it. A matrix product looks up all queries of a block in all sketches of a block; each sum
    is at least the score. Each query then scores its documents by falling bound, and stops
    below its k-th best score. One block in `lots` is searched
    before the rest, which then starts with a score that k documents reach and returns only
    what reaches it too. Blocks, of documents and of queries, end at bounded sizes; blocks of
    queries meet all blocks of documents, and Spark sends them to all tasks where they are small.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    index = texts.mapInArrow(partial(_indexed, most_docs=doc_block[0], most_terms=doc_block[1]), _INDEX)
    index = index.withColumn("lot", F.pmod(F.xxhash64("ids"), F.lit(lots)).cast("int"))
    index = materialize(index, "search-index")
    asked = queries.select(F.col(item_col).cast("long").alias("item_id"), F.col(query_col).alias("text")).mapInArrow(partial(_asked, most_queries=query_block[0], most_terms=query_block[1]), _QUERIES)
    asked = materialize(asked.withColumn("block", F.monotonically_increasing_id()), "search-queries")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    wanted = asked.select("block", "q_terms").mapInArrow(_distinct_terms, "block long, term long")
    df = index.select("vocabulary", "spread").mapInArrow(_spread, "term long, n long").join(wanted.select("term").distinct(), "term", "left_semi")
    df = df.groupBy("term").agg(F.sum("n").alias("df"))
    known = wanted.join(df, "term").groupBy("block").agg(F.collect_list(F.struct("term", "df")).alias("known"))  # of one block of queries
    asked = asked.join(known, "block", "left")
    asked = materialize(asked.withColumn("floor", F.lit(None).cast("array<long>")), "search-weights")
    forward = index.select("ids", "lengths", "sizes", "vocabulary", "places", "counts", "lot")

    def best(blocks: DataFrame, asking: DataFrame) -> DataFrame:
        return _first(_found(blocks.drop("lot").crossJoin(asking), n_docs or 0, n_terms or 0, k, width), k)

    reached = best(forward.where("lot = 0"), asked).where(F.col("rank") == k).groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("query", "score"))).alias("reached"))
    floor = F.transform("items", lambda _, i: F.coalesce(F.try_element_at("reached", i), F.lit(0).cast("long")))
    asked = materialize(asked.drop("floor").join(reached, "block", "left").withColumn("floor", floor).drop("reached"), "search-floors")
    return best(forward, asked).select("item_id", "rank", "doc_id", "score")
