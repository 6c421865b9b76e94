"""Tables of a run's report, and the report."""

from __future__ import annotations

import html
import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import PITCH_LENGTH_M, PITCH_WIDTH_M

SHOWN_ROWS, BALL_ROWS = 50, 25


def team_split(tracks: DataFrame) -> DataFrame:
    """Rows and tracks of each team but the ball's; rows without a team are `(unassigned)`.
    Rows without a track count as one track."""
    others = tracks.where("cls <> 'ball'").groupBy("match_id", "team")
    counts = others.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("track_id").alias("n_tracks"))
    return counts.withColumn("team", F.coalesce("team", F.lit("(unassigned)")))


def run_summary(stages: dict[str, DataFrame], stats: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row for each stage that ran: stage, n_rows, and if stats are given (tables of one
    row a match) those as JSON text."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(i).alias("place"), F.lit(name).alias("stage"), "n_rows")
        if stats is not None:
            text = stats[name].agg(F.to_json(F.collect_list(F.struct("*"))).alias("stats")) if name in stats else None
            row = row.withColumn("stats", F.lit(None).cast("string")) if text is None else row.join(text)  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def heatmap(tracks: DataFrame, bin_m: float = 5.0, player: str | None = None) -> DataFrame:
    """How many rows lie in each square of the pitch, of one player or of the team."""
    rows = tracks.where(F.col("x_m").isNotNull() & F.col("y_m").isNotNull())
    rows = rows.where(F.col("player") == player) if player is not None else rows
    at = {c: F.floor(F.col(f"{c}_m") / bin_m).cast("long") for c in ("x", "y")}
    return rows.groupBy("match_id", "team", at["x"].alias("x_bin"), at["y"].alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def _spread(cells: DataFrame, axis: str, n: int, sigma_cells: Column) -> DataFrame:
    """cells (by, axis, mass) smoothed along one axis of n cells: the mass of each goes to the
    cells within three sigma by a Gaussian kernel, of which what lies on the axis counts as
    all, so that none is lost at its ends."""
    reach = F.ceil(3 * sigma_cells)
    targets = F.sequence(F.greatest(F.lit(0).cast("long"), F.col(axis) - reach), F.least(F.lit(n - 1).cast("long"), F.col(axis) + reach))
    by = [c for c in cells.columns if c not in (axis, "mass")]
    weighed = cells.withColumn("__s", sigma_cells).withColumn("__to", targets)
    weighed = weighed.withColumn("__w", F.transform("__to", lambda t: F.exp(-F.pow((t - F.col(axis)) / F.col("__s"), 2) / 2)))
    total = F.aggregate("__w", F.lit(0.0), lambda a, w: a + w)
    sent = weighed.select(*by, F.explode(F.arrays_zip("__to", "__w")).alias("__t"), (F.col("mass") / total).alias("__part"))
    sent = sent.select(*by, F.col("__t.__to").alias(axis), (F.col("__part") * F.col("__t.__w")).alias("__m"))
    return sent.groupBy(*by, axis).agg(F.sum("__m").alias("mass"))


def kernel_heatmap(tracks: DataFrame, bin_m: float = 1.0, bandwidth_m: float | None = None, player: str | None = None) -> DataFrame:
    """The density of rows on the pitch, smoothed by a Gaussian kernel: match_id, team, x_bin,
    y_bin, density (a share of all rows a square metre), of one player or of all.

    Rows are counted in squares of bin_m first, those beyond the pitch at its edge; squares
    are few, so what is smoothed does not grow with the rows. The kernel is separable, so it
    is spread along x, then along y. Its width is bandwidth_m, or by Scott's rule the standard
    deviation of the rows times n ** (-1 / 6), in each direction and for each team, but half a
    square at least. Rows without a position, and squares beyond three widths, have no
    density; the densities of a team add up to 1 over the pitch.
    """
    rows = tracks.where(F.col("x_m").isNotNull() & F.col("y_m").isNotNull())
    rows = rows.where(F.col("player") == player) if player is not None else rows
    sides = {"x": math.ceil(PITCH_LENGTH_M / bin_m), "y": math.ceil(PITCH_WIDTH_M / bin_m)}
    at = {c: F.least(F.greatest(F.floor(F.col(f"{c}_m") / bin_m), F.lit(0)), F.lit(n - 1)).cast("long") for c, n in sides.items()}
    by = ["match_id", "team"]
    counts = rows.groupBy(*by, at["x"].alias("x_bin"), at["y"].alias("y_bin")).agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"{c}_m").alias(f"s{c}") for c in sides), *(F.sum(F.pow(f"{c}_m", F.lit(2))).alias(f"q{c}") for c in sides))
    whole = Window.partitionBy(*by)
    n = F.sum("n").over(whole)

    def sigma(c: str) -> Column:
        if bandwidth_m is not None:
            return F.lit(max(bandwidth_m, bin_m / 2) / bin_m)
        square = F.greatest((F.sum(f"q{c}").over(whole) - F.pow(F.sum(f"s{c}").over(whole), F.lit(2)) / n) / F.greatest(n - 1, F.lit(1)), F.lit(0.0))
        return F.greatest(F.sqrt(square) * F.pow(n, F.lit(-1 / 6)), F.lit(bin_m / 2)) / bin_m

    cells = counts.select(*by, "x_bin", "y_bin", (F.col("n") / n).alias("mass"), sigma("x").alias("__sx"), sigma("y").alias("__sy"))
    along_x = _spread(cells, "x_bin", sides["x"], F.col("__sx"))
    both = _spread(along_x, "y_bin", sides["y"], F.col("__sy"))
    return both.select(*by, "x_bin", "y_bin", (F.col("mass") / bin_m**2).alias("density"))


def shot_map(shots: DataFrame) -> DataFrame:
    """shots with xg as points to draw: the size grows with xg."""
    return shots.withColumn("size", F.col("xg") * 900 + 30)


def pass_network(changes: DataFrame, tracks: DataFrame) -> DataFrame:
    """Passes between pairs of tracks, with both tracks' mean positions."""
    passes = changes.where("type_name = 'pass'").groupBy("match_id", "from_track_id", "to_track_id").agg(F.count(F.lit(1)).alias("n_passes"))
    mean = tracks.where("track_id >= 0").groupBy("match_id", "track_id").agg(F.avg("x_m").alias("x"), F.avg("y_m").alias("y"))
    for end in ("from", "to"):
        at = mean.select("match_id", F.col("track_id").alias(f"{end}_track_id"), F.col("x").alias(f"{end}_x"), F.col("y").alias(f"{end}_y"))
        passes = passes.join(at, ["match_id", f"{end}_track_id"], "left")
    return passes


def ball_preview(ball: DataFrame, rows: int = BALL_ROWS) -> DataFrame:
    return ball.orderBy("match_id", "frame").limit(rows)


def html_report(title: str, identity_coverage: float, tables: dict[str, DataFrame], path: str | Path) -> Path | str:
    """A page with a caveat and the first SHOWN_ROWS rows of each table. At a URI that is not
    a local file's it is written by Spark, as the only part of a folder of that name."""
    parts = [
        f"<h1>{html.escape(title)}</h1>",
        f"<p>Players are known in {round(identity_coverage * 100)}% of the rows. Positions are estimates from one camera; what is unknown is left empty.</p>",
    ]
    for name, df in tables.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{'' if v is None else html.escape(str(v))}</td>" for v in row) + "</tr>" for row in df.limit(SHOWN_ROWS).collect())
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    page = f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body>{''.join(parts)}</body></html>"
    scheme, _, rest = str(path).partition(":")
    if rest and scheme != "file":
        spark = next(iter(tables.values())).sparkSession
        spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(str(path))
        return str(path)
    file = Path("/" + rest.lstrip("/") if rest else path)
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(page)
    return file
