"""What several operators of this subpackage use: the shared folder, words, word hashes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

U64 = np.uint64


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Spark makes one folder for each application in it, which holds all tables that the
    operators write on their way and can be removed when the application has ended. Where
    the session names none, a local session (as in tests) takes one under its warehouse;
    on a cluster that is an error, since local folders are not shared.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(path or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints")
    return context.getCheckpointDir()


#: Rows of ids and counts can take this many times their size in compressed files. Spark
#: decides by file sizes what is small enough to broadcast before a query runs.
UNPACKED = 20


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    This cuts the lineage, survives lost executors and lets later steps read the rows again
    without another run of what made them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) < UNPACKED:
        spark.conf.set("spark.sql.sources.fileCompressionFactor", UNPACKED)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound the bytes of an Arrow batch, since single texts can be very long. This is set for
    the session: Spark reads it when the operator's result is evaluated."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes (splitmix64): every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Recent(dict):
    """Results of a function for keys that have come twice, of which between `most` and twice
    as many are remembered. Words that come once are many, and not worth a place."""

    _MARKS = 1 << 21

    def __init__(self, make: Callable[[bytes], Any], most: int):
        self.make, self.most, self.before, self.came = make, most, {}, bytearray(self._MARKS)

    def __missing__(self, key: bytes) -> Any:
        value = self.before.get(key)
        if value is None:
            value, mark = self.make(key), hash(key) % self._MARKS
            if not self.came[mark]:
                self.came[mark] = 1
                return value
        if len(self) >= self.most:
            self.before, self.came = dict(self), bytearray(self._MARKS)
            self.clear()
        self[key] = value
        return value


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in pieces of about size bytes, cut at white space: the words of a very long
    text are not all held at once."""
    at = 0
    while len(text) - at > size and (space := _SPACE.search(text, at + size)):
        yield text[at : space.start()]
        at = space.end()
    yield text[at:]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive word hashes."""
    n = len(x) - k + 1
    with np.errstate(over="ignore"):
        h = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            h = h * U64(0x9E3779B97F4A7C15) + x[i : i + n]
        return mix(h)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column's values as UTF-8 bytes, without decoding them."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def salt_of(column: str, salts: int) -> Column:
    """A salt, the same for each value of the column."""
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def salt_bit() -> Column:
    """The bit of the column salt; sums over distinct salts tell which there are (62 at most)."""
    return F.expr("shiftleft(1L, salt)")


def spread_over_salts(winners: DataFrame, salts: int) -> DataFrame:
    """winners with salt_bits, as one row for each of their salts."""
    present = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.col("salt_bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s)) != 0)
    return winners.withColumn("salt", F.explode(present)).drop("salt_bits")
