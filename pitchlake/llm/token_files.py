"""Token-id files: documents compressed apart with a shared trained dictionary."""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import shared_folder, small_batches, texts_of
from .tokens import encoder

#: Documents, and characters of a stretch of each and bytes of its ids, at most, from which
#: the dictionary is trained, and its size.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 4096, 8192, 65536
LEVEL = 3
#: A file's block ends with the document that brings it to so many compressed bytes.
BLOCK_BYTES = 1 << 20

MAGIC = b"IDBLOCK1"
_HEAD = struct.Struct("<8s32sqqq")


def pack_block(dictionary_hash: bytes, first_token: int, docs: list[tuple[int | None, int, bytes]]) -> bytes:
    """A block: magic, dictionary hash, first_token, number of documents, bytes of frames;
    then for each document id, tokens, end of its frame, and whether it has an id; then the
    frames. All integers are little-endian and signed, of 64 bits."""
    ends = np.cumsum([len(frame) for _, _, frame in docs], dtype="<i8")
    index = np.array([[i or 0 for i, _, _ in docs], [n for _, n, _ in docs], ends, [i is not None for i, _, _ in docs]], dtype="<i8")
    return b"".join([_HEAD.pack(MAGIC, dictionary_hash, first_token, len(docs), int(ends[-1])), index.tobytes(), *(f for _, _, f in docs)])


class Block:
    """Reads a block: any document alone, through the offset index."""

    def __init__(self, block: bytes, dictionary: bytes):
        magic, self.dictionary_hash, self.first_token, n, size = _HEAD.unpack_from(block)
        if magic != MAGIC or len(block) != _HEAD.size + 32 * n + size:
            raise ValueError("this is not a whole block of token ids")
        if hashlib.sha256(dictionary).digest() != self.dictionary_hash:
            raise ValueError("the block was written with another dictionary")
        index = np.frombuffer(block, dtype="<i8", count=4 * n, offset=_HEAD.size).reshape(4, n)
        self.ids = [i if known else None for i, known in zip(index[0].tolist(), index[3].tolist(), strict=True)]
        self.tokens = index[1]
        self._ends, self._frames = index[2], memoryview(block)[_HEAD.size + 32 * n :]
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._zstd = zstandard.ZstdDecompressor(dict_data=shared)

    def raw(self, i: int) -> bytes:
        """The ids of the i-th document, as little-endian unsigned 32-bit integers."""
        begin = int(self._ends[i - 1]) if i else 0
        return self._zstd.decompress(self._frames[begin : int(self._ends[i])], max_output_size=4 * int(self.tokens[i]))


def _train(spark: SparkSession, texts: DataFrame, path: str) -> bytes:
    """A dictionary from the ids of at most SAMPLE_DOCS documents, chosen by a hash of their
    ids, of each a stretch from a hashed place on; empty where they are too few to train one."""
    few = texts.where("doc_id is not null and length(text) > 0").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    spare = F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)
    place = F.pmod(F.xxhash64("doc_id", F.lit("stretch")), spare).cast("int") + 1
    some = texts.join(F.broadcast(few.distinct()), "doc_id").select(F.substr("text", place, F.lit(SAMPLE_CHARS)).alias("text"))  # at most SAMPLE_DOCS ids
    encode = encoder(path).encode
    samples = sorted(encode([r.text.encode()])[0][:SAMPLE_BYTES] for r in some.limit(2 * SAMPLE_DOCS).collect() if r.text)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of docs, in ascending doc_id order, to the folder path.

    path/blocks is a table of blocks (see pack_block): part and block number them in order,
    low and high bound their ids, n_tokens counts their tokens. A block's first_token counts
    the tokens of its part before it. path/dictionary holds the dictionary and its hash.
    A null text counts as empty; its ids are the end id alone. Texts of any length are
    encoded whole; an empty table gives no blocks. Rows without an id come first; rows that repeat an id are all written. Both tables are written by Spark, so a
    lost executor's blocks are made anew and no half-written block is seen.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dictionary = _train(spark, texts, tokenizer)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest, dictionary)], "hash binary, dictionary binary").write.parquet(f"{path}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        zstd, encode = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), encoder(tokenizer).encode
        held, size = [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, before, held, size
            n, known = sum(t for _, t, _ in held), [i for i, _, _ in held if i is not None]
            row = (part, number, known[0] if known else None, known[-1] if known else None, n, pack_block(digest, before, held))
            number, before, held, size = number + 1, before + n, [], 0
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["part", "block", "low", "high", "n_tokens", "data"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                ids = encode([text])[0]
                frame = zstd.compress(ids)
                held.append((doc, len(ids) // 4, frame))
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield block()
        if held:
            yield block()

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = texts.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    made = ordered.mapInArrow(blocks, "part int, block int, low long, high long, n_tokens long, data binary")
    made.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 (and ids, if asked for).

    start counts the ids of all documents before it. Each block checks its dictionary hash.
    """
    small_batches(spark)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    table = spark.read.parquet(f"{path}/blocks")
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(data.as_buffer().to_pybytes(), dictionary)
                raw = [block.raw(i) for i in range(len(block.ids))]
                begin = first + block.first_token + np.cumsum(block.tokens) - block.tokens
                columns = {
                    "doc_id": pa.array(block.ids, pa.int64()),
                    "start": pa.array(begin, pa.int64()),
                    "n_tokens": pa.array(block.tokens, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(r, dtype="<u4").astype(np.int64) for r in raw], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return table.select("part", "data").join(F.broadcast(starts), "part").select("first", "data").mapInArrow(documents, schema)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with an id: reads the blocks that can hold it, and of those
    only its frames."""
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    rows = spark.read.parquet(f"{path}/blocks").where((F.col("low") <= doc_id) & (F.col("high") >= doc_id)).orderBy("part", "block").select("data")
    found = (Block(bytes(r.data), dictionary) for r in rows.toLocalIterator())
    return [np.frombuffer(b.raw(i), dtype="<u4").tolist() for b in found for i, d in enumerate(b.ids) if d == doc_id]


def token_files_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write docs to token-id files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, path)
    return read_token_files(spark, path)
