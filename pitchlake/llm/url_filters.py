"""URL filters: host suffixes and path prefixes looked up by short hash prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import salt_bit, spread_over_salts

#: Hexadecimal digits of an expression's digest by which it meets rules.
PREFIX = 8
SALTS = 32
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (what follows the first `://`, up to `/`, `?`, `#` or the end, A-Z in lower
    case) and the path (from there up to `?`, `#` or the end); both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def _depth(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/")))


def _folder(path: Column) -> Column:
    """A path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, folder), 256)


def rule_table(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules (verdict, host and path in one, as `net/es/`) as the table (host, path, verdict)."""
    rows = [(verdict, *rule.partition("/")) for verdict, rule in rules]
    return spark.createDataFrame([(host, slash + path, verdict) for verdict, host, slash, path in rows], "host string, path string, verdict string")


def _keyed(rules: DataFrame) -> DataFrame:
    """Rules with the expression by which they are found: their host, and their path's folder."""
    host, path = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER), F.coalesce("path", F.lit(""))
    known = rules.select(host.alias("r_host"), path.alias("r_path"), "verdict").where(F.col("verdict").isin(ALLOW, BLOCK))
    known = known.groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))  # of two verdicts, to block
    known = known.withColumn("folder", _folder(F.col("r_path"))).withColumn("digest", _digest(F.col("r_host"), F.col("folder")))
    shape = {"labels": _labels(F.col("r_host")), "depth": _depth(F.col("r_path"))}
    return known.withColumns({"prefix": F.substring("digest", 1, PREFIX), **shape})


def _shapes(keyed: DataFrame) -> list[tuple[int, int]]:
    """The (labels, depth) that rules have. Only expressions of such a shape can meet a rule, so
    a URL of very many labels or slashes is not expanded into more than there are shapes."""
    return sorted(map(tuple, keyed.select("labels", "depth").distinct().collect()))


def expressions(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """An array of (e_host, e_folder): suffixes of the host at its dots, with prefixes of the
    path at its slashes, of the given numbers of labels and slashes."""
    found = [
        F.when(
            (_labels(host) >= labels) & (_depth(path) >= depth),
            F.struct(
                F.substring_index(host, ".", -labels).alias("e_host"),
                (F.concat(F.substring_index(path, "/", depth), F.lit("/")) if depth else F.lit("")).alias("e_folder"),
            ),
        )
        for labels, depth in shapes
    ]
    return F.array_compact(F.array(*found))


def judged_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict.

    rules is (host, path, verdict). A rule fits the URLs of its host and of its subdomains whose
    path starts with the rule's path; of those that fit, the one of most characters decides,
    ties to the longer host, and of the same rule with both verdicts, the one that blocks. rule is its host
    and path; it is null where none fits, and the verdict is `otherwise`. A null URL, or one
    without `://`, has an empty host and path, which only a rule for the empty host fits.
    Hosts are compared in lower case of A-Z, paths as they are. Null ids and rows that
    repeat stay, each as a row. Rules with a null part count it as empty; rules of another
    verdict count for nothing. No rules, or no pages, are no error. Other columns are not read.

    Each distinct host and path is expanded once into host suffixes and path prefixes, and
    meets the rules by the first PREFIX digits of an expression's digest; then whole digests
    and the rest of the path are compared, and the rule that goes first is taken. Both joins
    are salted, so no task holds all pages of one URL, or all URLs of one host. A URL is
    expanded only to the shapes that rules have, whatever its own length.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    salt = F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("salt", salt)
    keyed = _keyed(rules)
    shapes = _shapes(keyed)
    if not shapes:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    urls = rows.groupBy("host", "path", "salt").agg(F.lit(1).alias("one")).groupBy("host", "path").agg(F.sum(salt_bit()).alias("salt_bits"))
    parts = urls.withColumn("e", F.explode(expressions(F.col("host"), F.col("path"), shapes)))
    parts = parts.select("host", "path", "salt_bits", _digest(F.col("e.e_host"), F.col("e.e_folder")).alias("e_digest"))
    parts = parts.withColumns({"prefix": F.substring("e_digest", 1, PREFIX), "part": F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")})
    spread = keyed.drop("labels", "depth", "folder").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = parts.join(spread, ["prefix", "part"]).where((F.col("e_digest") == F.col("digest")) & F.startswith("path", F.col("r_path")))
    size = F.length("r_host") + F.length("r_path")
    first = F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), F.struct(size, F.length("r_host")))
    best = hits.groupBy("host", "path", "salt_bits").agg(first.alias("best"))
    found = rows.join(spread_over_salts(best, SALTS), ["host", "path", "salt"], "left")
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


def allowed_pages(pages: DataFrame, rules: DataFrame, url_col: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """The rows of pages whose URL the rules allow, with all their columns. See judged_urls:
    null URLs and URLs without a host go by `otherwise`; rows that repeat stay."""
    urls = pages.select(F.col(url_col).alias("url")).distinct()
    blocked = judged_urls(urls, rules, "url", "url", otherwise).where(F.col("verdict") == BLOCK).select(F.col("page_id").alias("__blocked"))
    return pages.join(blocked, F.col(url_col).eqNullSafe(F.col("__blocked")), "left_anti")
