"""Exact deduplication by skew-safe combining. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .shared import SPACES, materialize, salt_bit, salt_of, spread_over_salts

#: Salts among which the rows of one text are spread. At most 62: they are bits of a long.
SALTS = 16


def _rows(docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("norm"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("norm", 256)))
    return rows.withColumn("key", digest(F.col("sha"))).withColumn("salt", salt_of("doc_id", salts))


def _combined(rows: DataFrame) -> DataFrame:
    """(key, norm, keep_id, group_size, salt_bits): equal texts combined in three steps.

    Map-side aggregation deduplicates within each input partition, the first shuffle merges
    salted digest groups, the second combines the at most SALTS winners of each text. Every
    step groups by the whole text besides its digest.
    """
    salted = rows.groupBy("key", "salt", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("key", "norm").agg(
        F.min("keep_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.sum(salt_bit()).alias("salt_bits"),
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = lambda sha: sha,
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Two texts are equal when they are identical after each run of white space (space, tab
    to carriage return) is replaced by one space; a null text counts as empty. Of equal
    texts the smallest doc_id stays. A null id never stays beside another id; a group that
    has null ids only keeps one row. Of rows repeated with one id and text, one is kept; all
    count in group_size. Texts of any length are compared whole. Other columns of docs are not read. An empty table gives no rows.

    Texts that share a digest but differ (digest can be replaced to test this) are told
    apart by their content; this needs no further work while no digest is shared.
    """
    rows = _rows(docs, id_col, text_col, salts, digest)
    by_key = _combined(rows).groupBy("key").agg(
        F.count(F.lit(1)).alias("texts"),
        F.min("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.bit_or("salt_bits").alias("salt_bits"),
    )
    by_key = materialize(by_key, "exact-groups")
    shared = by_key.where("texts > 1").select("key")
    one_text = spread_over_salts(by_key.where("texts = 1").drop("texts"), salts)
    found = rows.select("doc_id", "sha", "key", "salt").join(one_text, ["key", "salt"]).drop("key")
    if shared.limit(1).count():
        few = rows.join(shared, "key", "left_semi")
        found = found.unionByName(few.join(spread_over_salts(_combined(few), salts), ["key", "norm", "salt"]).drop("key", "norm"))
    twin = F.row_number().over(Window.partitionBy("sha", "salt", "doc_id").orderBy(F.lit(0)))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (twin == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _in_order(docs: DataFrame) -> Column:
    """A row's columns in their order, to compare rows by; maps, which have no order, as JSON."""

    def orderable(kind: DataType) -> bool:
        return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()

    return F.struct(*(F.col(f"`{f.name}`") if orderable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in docs.schema))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns, whatever their names.

    Of rows that repeat an id and text, which are combined before they are shuffled, the
    least one stays: by its first column, then the second and so on, nulls before values. So
    what stays does not depend on the order of rows. Null ids, null, empty and very long
    texts: see exact_groups. An empty table gives no rows. Texts are shuffled once here; what
    is kept is known by id and digest.
    """
    sha = F.hex(F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " "), 256)))
    one = docs.select(F.struct("*").alias("doc"), _in_order(docs).alias("place"), F.concat_ws(" ", sha, F.col(id_col).cast("string")).alias("pick"))
    least = F.min("doc") if one.schema["doc"].dataType == one.schema["place"].dataType else F.min_by("doc", "place")
    one = one.groupBy("pick").agg(least.alias("doc"))
    kept = exact_groups(docs, id_col, text_col).where("kept")
    kept = kept.select(F.concat_ws(" ", F.upper("text_sha256"), F.col("doc_id").cast("string")).alias("pick"))
    return one.join(kept, "pick", "left_semi").select("doc.*")
