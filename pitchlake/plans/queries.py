"""The registered queries over the given tables, each with the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..contracts import enforce, with_nulls
from ..functions.geometry import chroma_of_hex, ground_point, on_pitch, project, seconds
from ..operators import ball, detect, events, identity, physical, possession, report, team, tracking, value, xg
from ..operators.calibrate import fraction_on_pitch
from ..sources import files
from ..sources.derived import HOMOGRAPHY, view, with_views
from ..sources.files import shared_folder
from . import match_run


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Kit colours as chroma, so that SQL needs no colour space.
REFERENCES = [(0, "home", "kit", 12.0, 3.0), (1, "away", "kit", -12.0, -3.0), (2, "home", "special", 20.0, 14.0), (3, "referee", "special", -20.0, 16.0)]
WEIGHTS = (-0.6, -0.09, 1.1, 0.4)
GATE = ball.gate_limit(1280.0)
_BALL_ONLY = {"track": False, "team": False, "identity": False, "calibrate": False}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return add


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums depend on their order in the last digits; six decimals don't."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _kinematics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return physical.add_kinematics(view(spark, sf_dir, "tracks_m"))


_ORDERED = "PARTITION BY match_id, track_id ORDER BY frame, det_id"
_KINEMATICS = f"""
    smooth AS (
        SELECT match_id, track_id, frame, det_id, team, player, t_s,
               avg(x_m) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS x_m,
               avg(y_m) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS y_m
        FROM {{tracks_m}} WHERE track_id >= 0 WINDOW w AS ({_ORDERED})
    ), step AS (
        SELECT *, nullif(t_s - lag(t_s) OVER w, 0) AS dt, x_m - lag(x_m) OVER w AS dx, y_m - lag(y_m) OVER w AS dy
        FROM smooth WINDOW w AS ({_ORDERED})
    ), speed AS (
        SELECT *, sqrt(dx * dx + dy * dy) / dt AS speed_ms FROM step
    )"""


@query("SELECT match_id, frame, det_id, cls, conf, (x1 + x2) / 2 AS ground_x, y2 AS ground_y, (y1 + y2) / 2 AS centre_y FROM {det}")
def detections_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = ground_point()
    centre = (F.col("y1") + F.col("y2")) / 2
    return view(spark, sf_dir, "det").select("match_id", "frame", "det_id", "cls", "conf", x.alias("ground_x"), y.alias("ground_y"), centre.alias("centre_y"))


@query("""
    SELECT match_id, frame, row_number() OVER (PARTITION BY match_id, frame ORDER BY det_id) - 1 AS det_id,
           CASE cls WHEN 'ball' THEN 'sports ball' ELSE 'person' END AS cls, conf, x1, y1, x2, y2
    FROM {det} WHERE conf >= 0.5 AND cls IN ('ball', 'player', 'goalkeeper')""")
def det_class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "det").withColumnsRenamed({"det_id": "rank", "cls": "label", "conf": "score"})
    return detect.postprocess(raw, {"ball": "sports ball", "player": "person", "goalkeeper": "person"}, 0.5)


@query("""
    SELECT match_id, frame, det_id FROM (
        SELECT *, dense_rank() OVER (PARTITION BY match_id ORDER BY frame) AS place FROM {det} WHERE frame >= 3 AND (frame - 3) % 4 = 0
    ) WHERE place <= 100""")
def frame_stride_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.stride(view(spark, sf_dir, "det"), 4, 100, 3).select("match_id", "frame", "det_id")


@query("SELECT match_id, frame, det_id, x_m, y_m FROM {tracks_m}")
def project_ground_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = project(*ground_point(), HOMOGRAPHY)
    return view(spark, sf_dir, "tracks_px").select("match_id", "frame", "det_id", x.alias("x_m"), y.alias("y_m"))


@query("SELECT match_id, frame, det_id, CAST(frame / 25e0 AS FLOAT) AS t_s FROM {det}")
def seconds_f32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "det").select("match_id", "frame", "det_id", seconds(F.col("frame"), 25).cast("float").alias("t_s"))


@query("""
    SELECT match_id, round(avg(CASE WHEN x_m BETWEEN -3 AND 108 AND y_m BETWEEN -3 AND 71 THEN 1e0 ELSE 0e0 END), 6) AS share
    FROM {tracks_m} GROUP BY match_id""")
def on_pitch_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = on_pitch(F.col("x_m"), F.col("y_m")).cast("double")
    return view(spark, sf_dir, "tracks_m").groupBy("match_id").agg(F.round(F.avg(inside), 6).alias("share"))


@query("""
    SELECT match_id, frame, CAST(t_s AS FLOAT) AS t_s, track_id, team, CAST(NULL AS SMALLINT) AS shirt, player,
           CAST(x_m AS FLOAT) AS x_m, CAST(y_m AS FLOAT) AS y_m, CAST(NULL AS FLOAT) AS speed_ms, CAST(conf AS FLOAT) AS conf
    FROM {tracks_m}""")
def tracks_m_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce(with_nulls(view(spark, sf_dir, "tracks_m"), shirt="short", speed_ms="double"), "tracks_m", strict=True)


@query(f"WITH {_KINEMATICS} SELECT match_id, track_id, frame, det_id, round(x_m, 6) AS x_m, round(y_m, 6) AS y_m, round(speed_ms, 6) AS speed_ms FROM speed")
def kinematics_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _kinematics(spark, sf_dir).where("track_id >= 0").select("match_id", "track_id", "frame", "det_id", "x_m", "y_m", "speed_ms")
    return _rounded(rows, "x_m", "y_m", "speed_ms")


@query(f"""
    WITH {_KINEMATICS} SELECT match_id, track_id, frame, det_id, round((speed_ms - lag(speed_ms) OVER ({_ORDERED})) / dt, 5) AS accel_ms2 FROM speed""")
def kinematics_accel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _kinematics(spark, sf_dir).where("track_id >= 0")
    return rows.select("match_id", "track_id", "frame", "det_id", F.round("accel_ms2", 5).alias("accel_ms2"))


@query("SELECT match_id, frame, det_id, x_m, y_m, CAST(NULL AS DOUBLE) AS speed_ms, CAST(NULL AS DOUBLE) AS accel_ms2 FROM {tracks_m} WHERE track_id < 0")
def kinematics_untracked_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinematics(spark, sf_dir).where("track_id < 0").select("match_id", "frame", "det_id", "x_m", "y_m", "speed_ms", "accel_ms2")


@query(f"""
    WITH {_KINEMATICS}, paced AS (
        SELECT *, speed_ms * coalesce(t_s - lag(t_s) OVER ({_ORDERED}), 0) AS step_m FROM speed WHERE speed_ms IS NOT NULL
    )
    SELECT match_id, team, player, track_id, round((max(t_s) - min(t_s)) / 60, 6) AS minutes, round(sum(step_m), 6) AS distance_m,
           round(max(speed_ms), 6) AS top_speed_ms, count(*) FILTER (WHERE speed_ms > 7) AS sprints
    FROM paced GROUP BY match_id, team, player, track_id""")
def player_physical_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(physical.summarise_player(_kinematics(spark, sf_dir)), "minutes", "distance_m", "top_speed_ms")


_BEST = """
    best AS (
        SELECT match_id, frame, (x1 + x2) / 2 AS x_px, (y1 + y2) / 2 AS y_px, conf FROM {det} WHERE cls = 'ball'
        QUALIFY row_number() OVER (PARTITION BY match_id, frame ORDER BY conf DESC, det_id) = 1
    )"""
_GATE = f"""{_BEST}, numbered AS (
        SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY frame) AS n FROM best
    ), gate AS (
        SELECT match_id, n, frame, x_px, y_px, conf, true AS accepted, frame AS f0, x_px AS x0, y_px AS y0 FROM numbered WHERE n = 1
        UNION ALL
        SELECT match_id, n, frame, x_px, y_px, conf, ok, CASE WHEN ok THEN frame ELSE f0 END, CASE WHEN ok THEN x_px ELSE x0 END, CASE WHEN ok THEN y_px ELSE y0 END
        FROM (
            SELECT b.*, g.f0, g.x0, g.y0, (b.frame - g.f0) / 25e0 > 0 AND ((b.frame - g.f0) / 25e0 > 1
                   OR sqrt((b.x_px - g.x0) * (b.x_px - g.x0) + (b.y_px - g.y0) * (b.y_px - g.y0)) / ((b.frame - g.f0) / 25e0) <= {GATE!r}) AS ok
            FROM gate g JOIN numbered b ON b.match_id = g.match_id AND b.n = g.n + 1
        )
    )"""
_FILLED = f"""{_GATE}, grid AS (
        SELECT match_id, frame, row_number() OVER (PARTITION BY match_id ORDER BY frame) - 1 AS pos FROM (SELECT DISTINCT match_id, frame FROM {{det}})
    ), pair AS (
        SELECT match_id, pos, x_px, y_px, lag(pos) OVER w AS p0, lag(x_px) OVER w AS x0, lag(y_px) OVER w AS y0
        FROM gate JOIN grid USING (match_id, frame) WHERE accepted WINDOW w AS (PARTITION BY match_id ORDER BY frame)
    ), inside AS (
        SELECT *, unnest(range(1, pos - p0)) AS step FROM pair WHERE pos - p0 > 1 AND pos - p0 <= 12
    ), points AS (
        SELECT match_id, frame, x_px, y_px, conf, false AS interpolated FROM gate WHERE accepted
        UNION ALL
        SELECT i.match_id, g.frame, x0 + step / CAST(i.pos - p0 AS double) * (x_px - x0), y0 + step / CAST(i.pos - p0 AS double) * (y_px - y0), NULL, true
        FROM inside i JOIN grid g ON g.match_id = i.match_id AND g.pos = p0 + step
    )"""


def _grid(det: DataFrame) -> DataFrame:
    return ball.processed_grid(det)


@query(f"WITH {_BEST} SELECT * FROM best")
def ball_best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball.best_candidates(view(spark, sf_dir, "det"))


@query(f"WITH RECURSIVE {_GATE} SELECT match_id, frame, x_px, y_px, conf, accepted FROM gate")
def ball_speed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball.speed_gate(ball.best_candidates(view(spark, sf_dir, "det")), 25.0, GATE)


@query(f"WITH RECURSIVE {_FILLED} SELECT match_id, frame, round(x_px, 6) AS x_px, round(y_px, 6) AS y_px, conf, interpolated FROM points")
def ball_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = view(spark, sf_dir, "det")
    kept = ball.speed_gate(ball.best_candidates(det), 25.0, GATE).where("accepted")
    return _rounded(ball.fill_gaps(kept, _grid(det)), "x_px", "y_px")


@query(f"WITH RECURSIVE {_FILLED} SELECT match_id, frame, round(x_px, 6) AS x_px, round(y_px, 6) AS y_px, conf, interpolated FROM points".replace("{det}", "{det_strided}"))
def ball_strided_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ball of a run that reads every fourth frame: gaps are counted in frames read."""
    run = match_run.build(RunConfig(stages=_BALL_ONLY, io={"frame_stride": 4}), match_run.Inputs(view(spark, sf_dir, "det")))
    points = run.tables["ball"].withColumn("conf", F.col("conf").cast("double"))
    return _rounded(points.select("match_id", "frame", "x_px", "y_px", "conf", "interpolated"), "x_px", "y_px", "conf")


@query(f"""
    WITH RECURSIVE {_FILLED} SELECT 'ball' AS output, match_id, count(*) AS n_rows, min(frame) AS first_frame, max(frame) AS last_frame, count(DISTINCT frame % 4) AS n_phases FROM points GROUP BY match_id
    UNION ALL SELECT 'detect', match_id, count(*), min(frame), max(frame), count(DISTINCT frame % 4) FROM {{det}} GROUP BY match_id
    UNION ALL SELECT 'grid', match_id, count(*), min(frame), max(frame), count(DISTINCT frame % 4) FROM grid GROUP BY match_id""".replace("{det}", "{det_strided}"))
def run_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a strided run's tables hold of each match."""
    run = match_run.build(RunConfig(stages=_BALL_ONLY, io={"frame_stride": 4}), match_run.Inputs(view(spark, sf_dir, "det")))
    out = None
    for name, table in (("ball", run.tables["ball"]), ("detect", run.tables["detect"]), ("grid", run.grid)):
        frame = F.col("frame")
        counts = [F.count(F.lit(1)).alias("n_rows"), F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame"), F.countDistinct(frame % 4).alias("n_phases")]
        found = table.groupBy("match_id").agg(*counts).withColumn("output", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


_TO_METRES = [[f"({HOMOGRAPHY[r][0]!r}e0 * x_px + {HOMOGRAPHY[r][1]!r}e0 * y_px + {HOMOGRAPHY[r][2]!r}e0)" for r in (0, 1, 2)]][0]


@query(f"""
    WITH RECURSIVE {_FILLED} SELECT match_id, frame, frame / 25e0 AS t_s, round({_TO_METRES[0]} / {_TO_METRES[2]}, 6) AS x_m,
           round({_TO_METRES[1]} / {_TO_METRES[2]}, 6) AS y_m, conf, interpolated FROM points""")
def ball_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = view(spark, sf_dir, "det")
    rows = ball.trajectory(det, _grid(det), homography=HOMOGRAPHY).select("match_id", "frame", "t_s", "x_m", "y_m", "conf", "interpolated")
    return _rounded(rows, "x_m", "y_m")


@query(f"""
    WITH RECURSIVE {_FILLED}, n AS (SELECT match_id, count(*) AS n_frames FROM grid GROUP BY match_id),
    p AS (SELECT match_id, count(*) AS n_points, count(*) FILTER (WHERE interpolated) AS n_interpolated FROM points GROUP BY match_id)
    SELECT match_id, n_frames, coalesce(n_points, 0) AS n_points, coalesce(n_interpolated, 0) AS n_interpolated,
           round_even(coalesce(n_points, 0) / CAST(n_frames AS double), 3) AS coverage_fraction
    FROM n LEFT JOIN p USING (match_id)""")
def ball_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = view(spark, sf_dir, "det")
    return ball.coverage(ball.trajectory(det, _grid(det)), _grid(det))


_POSSESSION = """
    ball_at AS (
        SELECT match_id, frame, x_m AS ball_x, y_m AS ball_y FROM {tracks_m} WHERE cls = 'ball'
        QUALIFY row_number() OVER (PARTITION BY match_id, frame ORDER BY conf DESC, det_id) = 1
    ), near AS (
        SELECT match_id, frame, track_id, team, sqrt((x_m - ball_x) * (x_m - ball_x) + (y_m - ball_y) * (y_m - ball_y)) AS dist_m
        FROM {tracks_m} JOIN ball_at USING (match_id, frame) WHERE team IN ('home', 'away')
        QUALIFY row_number() OVER (PARTITION BY match_id, frame ORDER BY dist_m, track_id, team) = 1
    ), poss AS (
        SELECT match_id, frame, CASE WHEN dist_m <= 15 THEN track_id END AS possessor_track_id, CASE WHEN dist_m <= 15 THEN team END AS team, dist_m FROM near
    )"""
_SETTLED = f"""{_POSSESSION}, turn AS (
        SELECT *, CASE WHEN possessor_track_id IS NOT DISTINCT FROM lag(possessor_track_id) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new
        FROM poss WINDOW w AS (PARTITION BY match_id ORDER BY frame)
    ), spell AS (
        SELECT *, sum(new) OVER (PARTITION BY match_id ORDER BY frame) AS spell FROM turn
    ), firm AS (
        SELECT *, count(*) OVER (PARTITION BY match_id, spell) >= 2 AND possessor_track_id IS NOT NULL AS is_firm FROM spell
    ), settled AS (
        SELECT match_id, frame, possessor_track_id, team, dist_m,
               last_value(CASE WHEN is_firm THEN possessor_track_id END IGNORE NULLS) OVER w AS settled_track_id,
               last_value(CASE WHEN is_firm THEN team END IGNORE NULLS) OVER w AS settled_team
        FROM firm WINDOW w AS (PARTITION BY match_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    )"""


def _possession(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = view(spark, sf_dir, "tracks_m")
    best = F.max_by(F.struct("x_m", "y_m"), F.struct("conf", -F.col("det_id"))).alias("p")
    at = tracks.where("cls = 'ball'").groupBy("match_id", "frame").agg(best).select("match_id", "frame", "p.*")
    # The derived players are spread at random, so the radius is wide here.
    return possession.assign_possession(tracks, at, radius_m=15.0)


@query(f"WITH {_POSSESSION} SELECT match_id, frame, possessor_track_id, team, round(dist_m, 6) AS dist_m FROM poss")
def possession_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_possession(spark, sf_dir), "dist_m")


@query(f"""
    WITH {_POSSESSION} SELECT match_id, team, count(*) AS n_frames, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY match_id) AS double), 6) AS share
    FROM poss WHERE team IS NOT NULL GROUP BY match_id, team""")
def possession_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(possession.possession_share(_possession(spark, sf_dir)), "share")


@query(f"WITH {_SETTLED} SELECT match_id, frame, possessor_track_id, settled_track_id, settled_team FROM settled")
def possession_hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    settled = possession.settled_possession(_possession(spark, sf_dir), hold_frames=2)
    return settled.select("match_id", "frame", "possessor_track_id", "settled_track_id", "settled_team")


@query(f"""
    WITH {_SETTLED}, moved AS (
        SELECT *, lag(settled_track_id) OVER w AS from_track_id, lag(settled_team) OVER w AS from_team FROM settled WINDOW w AS (PARTITION BY match_id ORDER BY frame)
    )
    SELECT match_id, frame, from_track_id, settled_track_id AS to_track_id, from_team AS team,
           CASE WHEN from_team = settled_team THEN 'pass' ELSE 'turnover' END AS type_name
    FROM moved WHERE from_track_id <> settled_track_id""")
def possession_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return possession.possession_changes(possession.settled_possession(_possession(spark, sf_dir), hold_frames=2))


_PLAYED = _SETTLED.replace("{tracks_m}", "{play}").replace("<= 15", "<= 2")
_CHANGES = """
    moved AS (
        SELECT *, lag(settled_track_id) OVER w AS from_track_id, lag(settled_team) OVER w AS from_team, lag(frame) OVER w AS from_frame
        FROM settled WINDOW w AS (PARTITION BY match_id ORDER BY frame)
    ), changes AS (
        SELECT match_id, frame, from_frame, from_track_id AS track_id, settled_track_id AS to_track_id, from_team AS team,
               CASE WHEN from_team = settled_team THEN 'pass' ELSE 'turnover' END AS type_name
        FROM moved WHERE from_track_id <> settled_track_id
    )"""
_ACTIONS = f"""{_PLAYED}, {_CHANGES}, spot AS (
        SELECT match_id, frame, t_s, x_m, y_m FROM {{play}} WHERE cls = 'ball'
    ), pace AS (
        SELECT match_id, frame, sqrt((x_m - lag(x_m) OVER w) * (x_m - lag(x_m) OVER w) + (y_m - lag(y_m) OVER w) * (y_m - lag(y_m) OVER w)) / nullif(t_s - lag(t_s) OVER w, 0) AS speed
        FROM spot WINDOW w AS (PARTITION BY match_id ORDER BY frame)
    ), spike AS (
        SELECT match_id, frame FROM (SELECT *, coalesce(lag(speed) OVER (PARTITION BY match_id ORDER BY frame) < 18, true) AS slow FROM pace) WHERE speed >= 18 AND slow
    ), held AS (
        SELECT s.match_id, s.frame, h.settled_track_id AS track_id, h.settled_team AS team
        FROM spike s ASOF LEFT JOIN (SELECT * FROM settled WHERE settled_track_id IS NOT NULL) h ON s.match_id = h.match_id AND s.frame - 1 >= h.frame
    ), following AS (
        SELECT h.*, c.frame AS next_frame, c.type_name AS next_type, row_number() OVER (PARTITION BY h.match_id, c.frame ORDER BY h.frame) AS n
        FROM held h ASOF LEFT JOIN changes c ON h.match_id = c.match_id AND h.frame <= c.frame
    ), lone AS (
        SELECT match_id, frame, track_id, team, CASE WHEN (next_frame - frame) / 25e0 <= 3 THEN next_frame END AS next_frame
        FROM following WHERE n = 1 AND NOT coalesce((next_frame - frame) / 25e0 <= 3 AND next_type = 'pass', false)
    ), act AS (
        SELECT match_id, frame, track_id, team, type_name, CASE WHEN type_name = 'pass' THEN 'success' ELSE 'fail' END AS result_name, from_frame, frame AS to_frame
        FROM changes c WHERE NOT EXISTS (SELECT 1 FROM lone WHERE lone.match_id = c.match_id AND lone.next_frame = c.frame)
        UNION ALL
        SELECT match_id, frame, track_id, team, NULL, CASE WHEN next_frame IS NOT NULL THEN 'fail' END, frame - 1, coalesce(next_frame, frame) FROM lone
    ), started AS (
        SELECT a.*, b.x_m AS start_x, b.y_m AS start_y FROM act a ASOF LEFT JOIN spot b ON a.match_id = b.match_id AND a.from_frame >= b.frame
    ), spiked AS (
        SELECT a.*, b.x_m - start_x AS dx, b.y_m - start_y AS dy FROM started a ASOF LEFT JOIN spot b ON a.match_id = b.match_id AND a.frame >= b.frame
    ), ended AS (
        SELECT a.*, b.x_m AS end_x, b.y_m AS end_y, CASE WHEN dx > 0 THEN 105 - start_x WHEN dx < 0 THEN -start_x END AS ahead
        FROM spiked a ASOF LEFT JOIN spot b ON a.match_id = b.match_id AND a.to_frame <= b.frame
    )"""


def _played(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Settled possession and the ball with its speed, of a game whose ball is passed on."""
    tracks = view(spark, sf_dir, "play")
    at = tracks.where("cls = 'ball'").select("match_id", "frame", "t_s", "x_m", "y_m")
    return possession.settled_possession(possession.assign_possession(tracks, at), hold_frames=2), ball.ball_speed(at)


@query(f"""
    WITH {_ACTIONS} SELECT match_id, frame, frame / 25e0 AS t_s, track_id, team, result_name,
           coalesce(type_name, CASE WHEN abs(ahead) <= 40 AND abs(start_y + ahead * dy / nullif(dx, 0) - 34) <= 7.32e0 / 2 + 2 THEN 'shot' ELSE 'clearance' END) AS type_name,
           round(start_x, 6) AS start_x, round(start_y, 6) AS start_y, round(end_x, 6) AS end_x, round(end_y, 6) AS end_y
    FROM ended""")
def action_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = []
    for table in _played(spark, sf_dir):  # written once, as a run does, since actions read them several times
        folder = shared_folder(spark)
        table.write.parquet(folder)
        kept.append(spark.read.schema(table.schema).parquet(folder))
    return _rounded(events.action_stream(*kept), "start_x", "start_y", "end_x", "end_y")


@query(f"WITH {_PLAYED}, {_CHANGES} SELECT match_id, frame, track_id AS from_track_id, to_track_id, team, type_name FROM changes")
def played_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return possession.possession_changes(_played(spark, sf_dir)[0])


@query(f"""
    WITH {_PLAYED}, {_CHANGES}, passes AS (
        SELECT match_id, track_id AS from_track_id, to_track_id, count(*) AS n_passes FROM changes WHERE type_name = 'pass' GROUP BY ALL
    ), mean AS (SELECT match_id, track_id, avg(x_m) AS x, avg(y_m) AS y FROM {{play}} WHERE track_id >= 0 GROUP BY ALL)
    SELECT p.*, round(f.x, 6) AS from_x, round(f.y, 6) AS from_y, round(t.x, 6) AS to_x, round(t.y, 6) AS to_y
    FROM passes p LEFT JOIN mean f ON f.match_id = p.match_id AND f.track_id = from_track_id LEFT JOIN mean t ON t.match_id = p.match_id AND t.track_id = to_track_id""")
def played_pass_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = possession.possession_changes(_played(spark, sf_dir)[0])
    return _rounded(report.pass_network(changes, view(spark, sf_dir, "play")), "from_x", "from_y", "to_x", "to_y")


@query("""
    SELECT match_id, coalesce(team, '(unassigned)') AS team, count(*) AS n_rows, count(DISTINCT track_id) AS n_tracks
    FROM {tracks_px} WHERE cls <> 'ball' GROUP BY match_id, team""")
def team_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.team_split(view(spark, sf_dir, "tracks_px"))


_SAMPLES = """
    samples AS (
        SELECT concat('m', CAST(label AS varchar(20))) AS match_id, CAST(floor(vec_id / 10e0) AS bigint) % 20 AS track_id,
               100 * CAST(embedding[1] AS double) AS a, 100 * CAST(embedding[2] AS double) AS b FROM embeddings
    ), chroma AS (
        SELECT match_id, track_id, median(a) AS a, median(b) AS b, count(*) AS n_crops FROM samples GROUP BY match_id, track_id HAVING count(*) >= 3
    )"""


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = {c: 100 * F.get("embedding", F.lit(i)).cast("double") for i, c in enumerate("ab")}
    track = F.floor(F.col("vec_id") / 10).cast("long") % 20
    return view(spark, sf_dir, "embeddings").select(F.concat(F.lit("m"), F.col("label")).alias("match_id"), track.alias("track_id"), *(v.alias(k) for k, v in part.items()))


@query(f"WITH {_SAMPLES} SELECT match_id, track_id, round(a, 6) AS a, round(b, 6) AS b, n_crops FROM chroma")
def team_chroma_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(team.track_chroma(_samples(spark, sf_dir)), "a", "b")


_REFS = "refs AS (SELECT * FROM (VALUES " + ", ".join(f"({p}, '{s}', '{k}', {a}e0, {b}e0)" for p, s, k, a, b in REFERENCES) + ") AS t(place, label, kind, ra, rb))"
_CENTRES = """
    centres AS (
        SELECT match_id, CASE WHEN a >= 0 THEN 0 ELSE 1 END AS cluster, avg(a) AS a, avg(b) AS b FROM chroma GROUP BY 1, 2
    )"""
_DIST = "sqrt(({0}.a - {1}) * ({0}.a - {1}) + ({0}.b - {2}) * ({0}.b - {2}))"
_LABELLED = f"""{_SAMPLES}, {_CENTRES}, labelled AS (
        SELECT c.match_id, c.cluster, c.a, c.b, CASE WHEN (c.cluster = 0) = ({_DIST.format("p", "12e0", "3e0")} + {_DIST.format("q", "-12e0", "-3e0")}
               <= {_DIST.format("p", "-12e0", "-3e0")} + {_DIST.format("q", "12e0", "3e0")}) THEN 'home' ELSE 'away' END AS team
        FROM centres c JOIN centres p ON p.match_id = c.match_id AND p.cluster = 0 JOIN centres q ON q.match_id = c.match_id AND q.cluster = 1
    )"""


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    chroma = team.track_chroma(_samples(spark, sf_dir))
    cluster = F.when(F.col("a") >= 0, 0).otherwise(1)
    centres = chroma.groupBy("match_id", cluster.alias("cluster")).agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    references = spark.createDataFrame(REFERENCES, "place int, label string, kind string, ref_a double, ref_b double")
    return chroma, team.label_clusters(centres, references), references


@query(f"WITH {_SAMPLES}, {_CENTRES} SELECT match_id, cluster, round(a, 6) AS a, round(b, 6) AS b FROM centres")
def team_lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, labelled, _ = _labelled(spark, sf_dir)
    return _rounded(labelled.select("match_id", "cluster", "a", "b"), "a", "b")


@query(f"WITH {_LABELLED} SELECT match_id, cluster, team FROM labelled")
def team_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir)[1].select("match_id", "cluster", "team")


@query(f"""
    WITH {_LABELLED}, {_REFS}, near AS (
        SELECT c.match_id, c.track_id, c.a, c.b, l.team, {_DIST.format("c", "l.a", "l.b")} AS d FROM chroma c JOIN labelled l USING (match_id)
        QUALIFY row_number() OVER (PARTITION BY c.match_id, c.track_id ORDER BY d, l.cluster) = 1
    ), special AS (
        SELECT n.match_id, n.track_id, label, {_DIST.format("n", "ra", "rb")} AS special_d FROM near n, refs WHERE kind = 'special'
        QUALIFY row_number() OVER (PARTITION BY n.match_id, n.track_id ORDER BY special_d, place) = 1
    )
    SELECT n.match_id, n.track_id, CASE WHEN n.d <= 8 THEN n.team WHEN s.special_d < 12 THEN s.label END AS team
    FROM near n JOIN special s ON s.match_id = n.match_id AND s.track_id = n.track_id""")
def team_special_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    chroma, labelled, references = _labelled(spark, sf_dir)
    return team.assign_teams(chroma, labelled, references, outlier_dist=8.0, special_dist=12.0)


@query()
def team_two_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team.team_centroids(team.track_chroma(_samples(spark, sf_dir)), 12.0)


_KITS = """
    kits AS (
        SELECT concat('m', CAST(label AS varchar(20))) AS match_id, vec_id, CASE WHEN vec_id % 2 = 0 THEN 6e1 ELSE -6e1 END AS side,
               CASE WHEN vec_id % 2 = 0 THEN 6e1 ELSE -6e1 END + 3 * CAST(embedding[1] AS double) AS a,
               CASE WHEN vec_id % 23 = 0 THEN 4e1 ELSE 0e0 END + 3 * CAST(embedding[2] AS double) AS b FROM embeddings
    )"""


@query(f"""
    WITH {_KITS} SELECT match_id, CAST(row_number() OVER (PARTITION BY match_id ORDER BY count(*) DESC, avg(a)) - 1 AS integer) AS cluster, round(avg(a), 6) AS a, round(avg(b), 6) AS b
    FROM kits WHERE vec_id % 23 <> 0 GROUP BY match_id, side""")
def team_peeled_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-means where it is known: two clusters far apart, from which outliers are peeled."""
    side = F.when(F.col("vec_id") % 2 == 0, 60.0).otherwise(-60.0)
    off = F.when(F.col("vec_id") % 23 == 0, 40.0).otherwise(0.0)
    part = [3 * F.get("embedding", F.lit(i)).cast("double") for i in (0, 1)]
    kits = view(spark, sf_dir, "embeddings").select(F.concat(F.lit("m"), F.col("label")).alias("match_id"), F.col("vec_id").alias("track_id"), (side + part[0]).alias("a"), (off + part[1]).alias("b"))
    return _rounded(team.team_centroids(kits, 25.0), "a", "b")


_VOTES = """
    counts AS (
        SELECT match_id, track_id, number, count(*) AS n, min(seq) AS first FROM {readings} WHERE number IS NOT NULL GROUP BY ALL
    ), votes AS (
        SELECT match_id, track_id, sum(n) AS n_votes, max(n) AS n_best, arg_max(number, n * 1000000000 - first) AS number FROM counts GROUP BY ALL
    )"""


@query(f"""
    WITH {_VOTES} SELECT match_id, track_id, CAST(coalesce(n_votes, 0) AS bigint) AS n_votes,
           CASE WHEN n_votes >= 5 AND n_best / CAST(n_votes AS double) >= 4e-1 THEN number END AS shirt
    FROM (SELECT DISTINCT match_id, track_id FROM {{readings}}) LEFT JOIN votes USING (match_id, track_id)""")
def identity_majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.majority_vote(view(spark, sf_dir, "readings"), min_share=0.4)


@query("SELECT event_id, s.team, s.shirt, q.name AS player FROM {sightings} s LEFT JOIN {squad} q ON q.side = s.team AND q.shirt = s.shirt")
def identity_squad_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.name_players(view(spark, sf_dir, "sightings"), view(spark, sf_dir, "squad")).select("event_id", "team", "shirt", "player")


@query("SELECT match_id, round_even(coalesce(avg(CASE WHEN cls <> 'ball' THEN CASE WHEN player IS NULL THEN 0e0 ELSE 1e0 END END), 0), 3) AS identity_coverage FROM {tracks_px} GROUP BY match_id")
def identity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.identity_coverage(view(spark, sf_dir, "tracks_px"))


@query("SELECT match_id, event_id, CASE type_name WHEN 'corner' THEN 'corner_crossed' ELSE type_name END AS type_name FROM {actions}")
def spadl_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.map_types(view(spark, sf_dir, "actions"))


_SHOT = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, is_goal,
           sqrt((105 - start_x) * (105 - start_x) + (34 - start_y) * (34 - start_y)) AS distance_m,
           atan2(7.32e0 * (105 - start_x), (105 - start_x) * (105 - start_x) + (34 - start_y) * (34 - start_y) - 3.66e0 * 3.66e0) AS angle
    FROM {shots}"""
_SHOT_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
_FEATURES = f"f AS (SELECT *, CASE WHEN angle < 0 THEN angle + pi() ELSE angle END AS angle_rad, 1 / greatest(distance_m, 1) AS inverse_distance FROM ({_SHOT}))"
_SCORE = f"1 / (1 + exp(-({WEIGHTS[0]}e0 + {WEIGHTS[1]}e0 * distance_m + {WEIGHTS[2]}e0 * angle_rad + {WEIGHTS[3]}e0 * inverse_distance)))"


@query(f"WITH {_FEATURES} SELECT {', '.join(_SHOT_KEY)}, round(distance_m, 6) AS distance_m, round(angle_rad, 6) AS angle_rad, round(inverse_distance, 6) AS inverse_distance FROM f")
def xg_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(xg.shot_features(view(spark, sf_dir, "shots")).select(*_SHOT_KEY, *xg.FEATURES), *xg.FEATURES)


@query(f"WITH {_FEATURES} SELECT {', '.join(_SHOT_KEY)}, round({_SCORE}, 6) AS xg FROM f")
def xg_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(xg.predict(view(spark, sf_dir, "shots"), WEIGHTS).select(*_SHOT_KEY, "xg"), "xg")


@query()
def xg_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    shots = view(spark, sf_dir, "shots")
    weights = xg.coefficients(xg.fit(shots))
    scored = xg.predict(shots, weights)
    return scored.groupBy("is_goal").agg(F.count(F.lit(1)).alias("n_shots"), F.avg("xg").alias("mean_xg"))


@query(f"WITH {_FEATURES} SELECT {', '.join(_SHOT_KEY)}, round({_SCORE} * 900 + 30, 4) AS size FROM f")
def shot_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.shot_map(xg.predict(view(spark, sf_dir, "shots"), WEIGHTS)).select(*_SHOT_KEY, F.round("size", 4).alias("size"))


@query("""
    SELECT match_id, team, CAST(floor(x_m / 5) AS bigint) AS x_bin, CAST(floor(y_m / 5) AS bigint) AS y_bin, count(*) AS n
    FROM {tracks_m} WHERE x_m IS NOT NULL AND y_m IS NOT NULL GROUP BY ALL""")
def heatmap_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.heatmap(view(spark, sf_dir, "tracks_m"))


_SIGMA = "greatest(sqrt(greatest((sum({0}_m * {0}_m) - sum({0}_m) * sum({0}_m) / CAST(count(*) AS double)) / greatest(count(*) - 1, 1), 0e0)) * power(count(*), -1e0 / 6e0), 125e-2) / 25e-1"
_KERNEL = """
    {a}_to AS (
        SELECT *, unnest(range(greatest(0, {a}_bin - CAST(ceil(3 * s{a}) AS bigint)), least({n} - 1, {a}_bin + CAST(ceil(3 * s{a}) AS bigint)) + 1)) AS goes FROM {from_}
    ), {a}_weighed AS (
        SELECT *, exp(-power((goes - {a}_bin) / s{a}, 2) / 2) AS w FROM {a}_to
    ), {a}_shared AS (
        SELECT *, w / sum(w) OVER (PARTITION BY match_id, team, x_bin, y_bin) AS part FROM {a}_weighed
    )"""


@query(f"""
    WITH wide AS (
        SELECT match_id, team, {_SIGMA.format("x")} AS sx, {_SIGMA.format("y")} AS sy, count(*) AS n FROM {{tracks_m}} WHERE x_m IS NOT NULL AND y_m IS NOT NULL GROUP BY match_id, team
    ), cells AS (
        SELECT t.match_id, t.team, CAST(least(greatest(floor(x_m / 25e-1), 0), 41) AS bigint) AS x_bin, CAST(least(greatest(floor(y_m / 25e-1), 0), 27) AS bigint) AS y_bin,
               count(*) / CAST(any_value(n) AS double) AS mass, any_value(sx) AS sx, any_value(sy) AS sy
        FROM {{tracks_m}} t JOIN wide ON wide.match_id = t.match_id AND wide.team IS NOT DISTINCT FROM t.team WHERE x_m IS NOT NULL AND y_m IS NOT NULL GROUP BY 1, 2, 3, 4
    ), {_KERNEL.format(a="x", n=42, from_="cells")}, along AS (
        SELECT match_id, team, goes AS x_bin, y_bin, sum(mass * part) AS mass, any_value(sy) AS sy FROM x_shared GROUP BY match_id, team, goes, y_bin
    ), {_KERNEL.format(a="y", n=28, from_="along")}
    SELECT match_id, team, x_bin, goes AS y_bin, round(sum(mass * part) / 625e-2, 8) AS density FROM y_shared GROUP BY match_id, team, x_bin, goes""")
def heatmap_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report.kernel_heatmap(view(spark, sf_dir, "tracks_m"), bin_m=2.5)
    return found.withColumn("density", F.round("density", 8))


@query("""
    WITH grid AS (
        SELECT match_id, frame, row_number() OVER (PARTITION BY match_id ORDER BY frame) - 1 AS pos FROM (SELECT DISTINCT match_id, frame FROM {det})
    ), seen AS (
        SELECT l.match_id, l.frame, l.det_id, conf, pos FROM {lanes} l JOIN grid USING (match_id, frame)
    ), gone AS (
        SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY match_id, det_id ORDER BY pos) <= 3 THEN 0 ELSE 1 END AS new FROM seen
    ), spell AS (
        SELECT *, sum(new) OVER (PARTITION BY match_id, det_id ORDER BY pos) AS spell FROM gone
    ), sure AS (
        SELECT *, min(CASE WHEN conf >= 0.25 THEN pos END) OVER (PARTITION BY match_id, det_id, spell) AS began FROM spell
    ), ids AS (
        SELECT match_id, det_id, spell, row_number() OVER (PARTITION BY match_id ORDER BY began, det_id) AS track_id
        FROM (SELECT DISTINCT match_id, det_id, spell, began FROM sure WHERE began IS NOT NULL)
    )
    SELECT match_id, frame, det_id, CASE WHEN pos >= began THEN track_id ELSE -1 END AS track_id FROM sure LEFT JOIN ids USING (match_id, det_id, spell)""")
def track_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Association where it is known: each lane's boxes are one track, until it is lost."""
    grid = ball.processed_grid(view(spark, sf_dir, "det"))
    return tracking.track(view(spark, sf_dir, "lanes"), grid, lost_frames=2).select("match_id", "frame", "det_id", "track_id")


@query(f"""
    WITH {_SETTLED}, moved AS (
        SELECT *, lag(settled_track_id) OVER w AS from_track_id, lag(settled_team) OVER w AS from_team FROM settled WINDOW w AS (PARTITION BY match_id ORDER BY frame)
    ), passes AS (
        SELECT match_id, from_track_id, settled_track_id AS to_track_id, count(*) AS n_passes
        FROM moved WHERE from_track_id <> settled_track_id AND from_team = settled_team GROUP BY ALL
    ), mean AS (SELECT match_id, track_id, avg(x_m) AS x, avg(y_m) AS y FROM {{tracks_m}} WHERE track_id >= 0 GROUP BY ALL)
    SELECT p.*, round(f.x, 6) AS from_x, round(f.y, 6) AS from_y, round(t.x, 6) AS to_x, round(t.y, 6) AS to_y
    FROM passes p LEFT JOIN mean f ON f.match_id = p.match_id AND f.track_id = from_track_id LEFT JOIN mean t ON t.match_id = p.match_id AND t.track_id = to_track_id""")
def pass_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = possession.possession_changes(possession.settled_possession(_possession(spark, sf_dir), hold_frames=2))
    return _rounded(report.pass_network(changes, view(spark, sf_dir, "tracks_m")), "from_x", "from_y", "to_x", "to_y")


_ZONE = "CASE WHEN {0}_x IS NOT NULL AND {0}_y IS NOT NULL THEN CAST(least(greatest(floor({0}_y / 85e-1), 0), 7) * 12 + least(greatest(floor({0}_x / 875e-2), 0), 11) AS bigint) END"
_VALUES = f"""
    act AS (
        SELECT *, {_ZONE.format("start")} AS zone, {_ZONE.format("end")} AS to_zone, type_name = 'shot' AS shot, result_name = 'success' AS done
        FROM {{moves}} WHERE type_name IN ('shot', 'pass')
    ), made AS (
        SELECT zone, count(*) AS n, count(*) FILTER (WHERE shot AND done) AS goals FROM act GROUP BY zone
    ), zones AS (
        SELECT unnest(range(0, 96)) AS zone
    ), step AS (
        SELECT zone, to_zone, count(*) / CAST(any_value(n) AS double) AS p FROM act JOIN made USING (zone) WHERE NOT shot AND done AND to_zone IS NOT NULL GROUP BY zone, to_zone
        UNION ALL SELECT zone, zone, 0 FROM zones
    ), worth AS (
        SELECT zone, coalesce(goals / CAST(n AS double), 0) AS now FROM zones LEFT JOIN made USING (zone)
    ), turn AS (
        SELECT zone, 0 AS turn, CAST(0 AS double) AS value FROM zones
        UNION ALL
        SELECT s.zone, any_value(t.turn) + 1, any_value(w.now) + sum(s.p * t.value) FROM turn t JOIN step s ON s.to_zone = t.zone JOIN worth w ON w.zone = s.zone WHERE t.turn < 20 GROUP BY s.zone
    ), valued AS (
        SELECT zone, value FROM turn WHERE turn = 20
    )"""


def _zone_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = value.zone_counts(view(spark, sf_dir, "moves"))
    return value.value_table(spark, value.zone_values(counts, rounds=20))


@query(f"WITH RECURSIVE {_VALUES} SELECT zone, CAST(zone % 12 AS integer) AS zone_x, CAST(zone // 12 AS integer) AS zone_y, round(value, 6) AS value FROM valued")
def zone_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_zone_values(spark, sf_dir), "value")


@query(f"""
    WITH RECURSIVE {_VALUES}, won AS (
        SELECT m.*, CASE WHEN type_name = 'shot' THEN CASE WHEN result_name = 'success' THEN 1 ELSE 0 END
                         WHEN type_name = 'pass' THEN CASE WHEN result_name = 'success' THEN coalesce(e.value, 0) ELSE 0 END END - s.value AS action_value
        FROM {{moves}} m LEFT JOIN valued s ON s.zone = {_ZONE.format("start")} LEFT JOIN valued e ON e.zone = {_ZONE.format("end")}
    )
    SELECT team_no, type_name, result_name, count(*) AS n_actions, count(action_value) AS n_valued, round(sum(action_value), 5) AS total_value FROM won GROUP BY ALL""")
def action_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    valued = value.value_actions(view(spark, sf_dir, "moves"), _zone_values(spark, sf_dir))
    return valued.groupBy("team_no", "type_name", "result_name").agg(F.count(F.lit(1)).alias("n_actions"), F.count("action_value").alias("n_valued"), F.round(F.sum("action_value"), 5).alias("total_value"))


@query("""
    SELECT match_id, n_tracks, coalesce(round_even(n_tracked / CAST(nullif(n_trackable, 0) AS double), 3), 0) AS tracked_fraction,
           coalesce(round_even(n_tracked / CAST(nullif(n_tracks, 0) AS double), 1), 0) AS mean_track_len
    FROM (
        SELECT match_id, count(*) FILTER (WHERE cls IN ('player', 'goalkeeper', 'referee')) AS n_trackable,
               count(*) FILTER (WHERE cls IN ('player', 'goalkeeper', 'referee') AND track_id >= 0) AS n_tracked,
               count(DISTINCT track_id) FILTER (WHERE track_id >= 0) AS n_tracks
        FROM {tracks_px} GROUP BY match_id
    )""")
def track_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.tracking_stats(view(spark, sf_dir, "tracks_px"))


@query("SELECT match_id, cls, count(*) AS n FROM {det} GROUP BY ALL")
def detect_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.class_counts(view(spark, sf_dir, "det"))


@query("""
    SELECT match_id, round_even(avg(CASE WHEN x_m BETWEEN -3 AND 108 AND y_m BETWEEN -3 AND 71 THEN 1e0 ELSE 0e0 END), 3) AS fraction_on_pitch,
           round_even(avg(CASE WHEN x_m BETWEEN -3 AND 108 AND y_m BETWEEN -3 AND 71 THEN 1e0 ELSE 0e0 END), 3) < 9e-1 AS low
    FROM {tracks_m} GROUP BY match_id""")
def calibration_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraction_on_pitch(view(spark, sf_dir, "tracks_m"))


@query("""
    SELECT 0 AS place, 'detect' AS stage, count(*) AS n_rows FROM {det}
    UNION ALL SELECT 1, 'team', count(*) FROM {tracks_px}
    UNION ALL SELECT 2, 'calibrate', count(*) FROM {tracks_m}""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = {"detect": "det", "team": "tracks_px", "calibrate": "tracks_m"}
    return report.run_summary({s: view(spark, sf_dir, v) for s, v in stages.items()})


@query("""
    SELECT match_id, frame, row_number() OVER (PARTITION BY match_id ORDER BY frame) - 1 AS pos FROM (SELECT DISTINCT match_id, frame FROM {det})""")
def frame_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball.processed_grid(view(spark, sf_dir, "det"))


@query("""
    SELECT match_id, track_id, frame, det_id FROM {tracks_px}
    WHERE track_id >= 0 AND cls <> 'ball' AND y2 - y1 >= 16 AND frame % 5 = 0""")
def team_sampled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team.sampled_boxes(view(spark, sf_dir, "tracks_px")).select("match_id", "track_id", "frame", "det_id")


@query()
def track_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = view(spark, sf_dir, "det")
    return tracking.track(det, ball.processed_grid(det)).select("match_id", "frame", "det_id", "cls", "track_id")


SECOND_CAMERA = ((0.057, 0.003, 1.0), (0.0, -0.065, 69.0), (0.0, 0.0001, 1.0))
KITS = (("home", "#D32F2F"), ("away", "#1976D2"))


def _through(h: tuple, x: str, y: str) -> tuple[str, str]:
    u, v, w = (f"({r[0]!r}e0 * {x} + {r[1]!r}e0 * {y} + {r[2]!r}e0)" for r in h)
    return f"{u} / {w}", f"{v} / {w}"


_FIRST, _SECOND = (_through(h, "((x1 + x2) / 2e0)", "y2") for h in (HOMOGRAPHY, SECOND_CAMERA))


@query(f"""
    WITH grid AS (
        SELECT match_id, frame, row_number() OVER (PARTITION BY match_id ORDER BY frame) - 1 AS pos FROM (SELECT DISTINCT match_id, frame FROM {{det}})
    ), seen AS (
        SELECT l.*, pos, odd, fps FROM {{lanes}} l JOIN grid USING (match_id, frame) JOIN {{two_cameras}} USING (match_id)
    ), gone AS (
        SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY match_id, det_id ORDER BY pos) <= CASE WHEN odd = 1 THEN 6 ELSE 3 END THEN 0 ELSE 1 END AS new FROM seen
    ), spell AS (
        SELECT *, sum(new) OVER (PARTITION BY match_id, det_id ORDER BY pos) AS spell FROM gone
    ), sure AS (
        SELECT *, min(CASE WHEN conf >= 0.25 THEN pos END) OVER (PARTITION BY match_id, det_id, spell) AS began FROM spell
    ), ids AS (
        SELECT match_id, det_id, spell, row_number() OVER (PARTITION BY match_id ORDER BY began, det_id) AS id
        FROM (SELECT DISTINCT match_id, det_id, spell, began FROM sure WHERE began IS NOT NULL)
    ), tracked AS (
        SELECT sure.*, CASE WHEN pos >= began THEN id ELSE -1 END AS track_id FROM sure LEFT JOIN ids USING (match_id, det_id, spell)
    ), known AS (
        SELECT t.*, CASE WHEN track_id < 1 OR track_id > 60 THEN NULL WHEN (track_id + odd) % 2 = 0 THEN 'home' ELSE 'away' END AS team,
               CASE WHEN track_id BETWEEN 1 AND 500 AND track_id - 1 IN (SELECT frame FROM grid g WHERE g.match_id = t.match_id) THEN CAST((track_id - 1) * 7 % 40 AS smallint) END AS shirt
        FROM tracked t
    )
    SELECT k.match_id, frame, det_id, track_id, team, k.shirt, q.name AS player, frame / fps AS t_s,
           round(CASE WHEN odd = 1 THEN {_SECOND[0]} ELSE {_FIRST[0]} END, 4) AS x_m, round(CASE WHEN odd = 1 THEN {_SECOND[1]} ELSE {_FIRST[1]} END, 4) AS y_m
    FROM known k LEFT JOIN {{two_squads}} q ON q.match_id = k.match_id AND q.side = k.team AND q.shirt = k.shirt""")
def run_two_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of all matches at once, of which each second one has another camera, other kits and
    another squad; players by track, team, shirt and name, in metres."""
    read = {v: view(spark, sf_dir, v) for v in ("lanes_and_ball", "lane_readings", "two_cameras", "two_squads", "det")}
    odd = F.col("odd") == 1
    h = F.when(odd, F.array(*(F.lit(v) for row in SECOND_CAMERA for v in row)))
    kits = team.kit_references(spark, [(side, "kit", colour) for side, colour in KITS])
    labels = F.when(odd & (F.col("label") == "home"), "away").when(odd, "home").otherwise(F.col("label"))
    references = read["two_cameras"].join(F.broadcast(kits)).withColumn("label", labels).drop("odd", "fps", "image_width")
    colours = kits.select("place", F.col("ref_a").alias("a"), F.col("ref_b").alias("b"))
    numbers = spark.range(1, 61).select(F.col("id").alias("track_id"), (F.col("id") % 2).cast("int").alias("place")).join(F.broadcast(colours), "place")
    crops = numbers.crossJoin(F.broadcast(spark.range(4).select(F.col("id").alias("frame"))))
    samples = read["two_cameras"].select("match_id").join(F.broadcast(crops)).drop("place")
    config = RunConfig(stages={"ball": False}, tracker={"lost_track_buffer": 3}, io={"frame_stride": 1})
    inputs = match_run.Inputs(
        read["lanes_and_ball"],
        grid=ball.processed_grid(read["det"]),
        chroma_samples=samples,
        references=references,
        readings=read["lane_readings"],
        squad=read["two_squads"],
        homography=HOMOGRAPHY,
        matches=read["two_cameras"].select("match_id", "fps", "image_width", h.alias("h")),
    )
    found = match_run.build(config, inputs).tables["calibrate"].where("cls <> 'ball'")
    columns = ["match_id", "frame", "det_id", "track_id", "team", "shirt", "player", "t_s"]
    return found.select(*columns, *(F.round(c, 4).alias(c) for c in ("x_m", "y_m")))


@query(f"""
    WITH {_VOTES} SELECT match_id, track_id, number, n, first, row_number() OVER (PARTITION BY match_id, track_id ORDER BY n DESC, first) AS rank FROM counts""")
def identity_vote_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.vote_counts(view(spark, sf_dir, "readings"))


_MMSS = "lpad(CAST(CAST(floor(second_of_match / 60e0) AS bigint) AS varchar(20)), 2, '0'), ':', lpad(CAST(second_of_match % 60 AS varchar(20)), 2, '0')"


def _clocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "tags").withColumn("clock_mmss", F.expr(f"concat({_MMSS})"))


@query("""
    SELECT CASE type_name WHEN 'corner' THEN 'corner_crossed' ELSE type_name END AS type_name, match_id, CAST(period AS tinyint) AS period, CAST(second_of_match AS float) AS t_s, team,
           CAST(shirt AS varchar) AS player, CAST(start_x AS float) AS start_x, CAST(start_y AS float) AS start_y, CAST(end_x AS float) AS end_x, CAST(end_y AS float) AS end_y,
           result_name, bodypart_name
    FROM {tags}""")
def tagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manual route: a tagging sheet written as CSV with a header, read and made events."""
    folder = shared_folder(spark)
    sheet = _clocked(spark, sf_dir)
    names = ["period", "clock_mmss", *(c.split()[0] for c in files.TAGGING.split(", ")[2:])]
    sheet.select("match_id", *names).write.partitionBy("match_id").csv(folder, header=True)
    tags = spark.read.schema(f"{files.TAGGING}, match_id string").csv(folder, header=True)
    return events.map_types(events.from_tags(tags, F.col("match_id")))


@query("SELECT CAST(second_of_match + event_id % 4 / 4e0 AS double) AS t_s, CASE WHEN event_id % 2 = 0 THEN 'corner' ELSE concat('set_', type_name) END AS type_name FROM {tags}")
def instances_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged actions written as XML instances, read back by their types."""
    folder = shared_folder(spark)
    code = F.when(F.col("event_id") % 2 == 0, "Corner  Kick").otherwise(F.concat(F.lit("SET "), F.upper("type_name")))
    rows = view(spark, sf_dir, "tags").select((F.col("second_of_match") + F.col("event_id") % 4 / 4).cast("double").alias("start"), code.alias("code"))
    rows.write.format("xml").option("rootTag", "file").option("rowTag", "instance").save(folder)
    return files.read_instances_xml(spark, folder, {"corner_kick": "corner"})


@query("SELECT CAST(second_of_match AS double) AS t_s, type_name FROM {tags}")
def clock_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged actions with a clock, in hours from an hour on, written as CSV and read back."""
    folder = shared_folder(spark)
    hours = F.concat(F.floor(F.col("second_of_match") / 3600), F.date_format(F.timestamp_seconds(F.col("second_of_match") % 3600), ":mm:ss"))
    clock = F.when(F.col("second_of_match") < 3600, F.col("clock_mmss")).otherwise(hours)
    _clocked(spark, sf_dir).select(clock.alias("clock"), F.initcap("type_name").alias("action")).write.csv(folder, header=True)
    return files.read_clock_csv(spark, folder)


@query(f"SELECT {', '.join(_SHOT_KEY)}, start_x, start_y, is_goal FROM {{shots}}")
def shots_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots written as CSV and read back with their types."""
    folder = shared_folder(spark)
    view(spark, sf_dir, "shots").drop("l_discount").write.csv(folder, header=True)
    read = files.read_shots(spark, folder)
    kinds = {f.name: f.dataType for f in view(spark, sf_dir, "shots").schema}
    return read.select(*(F.col(c).cast(kinds[c]).alias(c) for c in (*_SHOT_KEY, "start_x", "start_y", "is_goal")))


@query("SELECT match_id, frame, det_id, cls, conf FROM {det} WHERE match_id = 'm0'")
def match_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections written in a folder for each match, of which one is read."""
    folder = shared_folder(spark)
    files.write_matches(view(spark, sf_dir, "det"), folder)
    return spark.read.parquet(folder).where("match_id = 'm0'").select("match_id", "frame", "det_id", "cls", "conf")


@query("""
    SELECT match_id, team, CAST(floor(x_m / 4) AS bigint) AS x_bin, CAST(floor(y_m / 4) AS bigint) AS y_bin, count(*) AS n
    FROM {tracks_m} WHERE player = 'p4' AND x_m IS NOT NULL AND y_m IS NOT NULL GROUP BY ALL""")
def heatmap_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.heatmap(view(spark, sf_dir, "tracks_m"), bin_m=4.0, player="p4")


_TEAMS = "teams AS (SELECT DISTINCT match_id, track_id, CASE track_id % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'away' END AS team FROM {tracks_px} WHERE track_id >= 0 AND track_id % 5 > 0)"


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = view(spark, sf_dir, "tracks_px").where("track_id >= 0 and track_id % 5 > 0").select("match_id", "track_id").distinct()
    return found.withColumn("team", F.when(F.col("track_id") % 3 == 0, "home").when(F.col("track_id") % 3 == 1, "away"))


@query(f"WITH {_TEAMS} SELECT t.match_id, frame, det_id, cls, t.track_id, CASE WHEN cls = 'ball' THEN 'ball' ELSE teams.team END AS team FROM {{tracks_px}} t LEFT JOIN teams USING (match_id, track_id)")
def team_of_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = team.with_teams(view(spark, sf_dir, "tracks_px"), _teams(spark, sf_dir))
    return tracks.select("match_id", "frame", "det_id", "cls", "track_id", "team")


@query(f"WITH {_TEAMS} SELECT match_id, team, count(*) AS n_tracks FROM teams GROUP BY match_id, team")
def team_track_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team.team_counts(_teams(spark, sf_dir))


@query(f"""
    WITH {_SAMPLES}, {_CENTRES}
    SELECT c.match_id, c.cluster, CASE WHEN (c.cluster = 0) = ({_DIST.format("q", "-12e0", "-3e0")} < {_DIST.format("p", "-12e0", "-3e0")}) THEN 'home' ELSE 'away' END AS team
    FROM centres c JOIN centres p ON p.match_id = c.match_id AND p.cluster = 0 JOIN centres q ON q.match_id = c.match_id AND q.cluster = 1""")
def team_labels_of_one_kit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the away kit alone known, the nearer cluster takes it."""
    _, labelled, references = _labelled(spark, sf_dir)
    return team.label_clusters(labelled.drop("team"), references.where("label = 'away'")).select("match_id", "cluster", "team")


@query(f"""
    WITH {_SAMPLES}, {_CENTRES}
    SELECT c.match_id, c.cluster, CASE WHEN c.cluster = 0 THEN 'home' ELSE 'away' END AS team
    FROM centres c WHERE (SELECT count(*) FROM centres o WHERE o.match_id = c.match_id) = 2""")
def team_labels_without_kits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With no kit known, the first cluster is home."""
    _, labelled, references = _labelled(spark, sf_dir)
    return team.label_clusters(labelled.drop("team"), references.where("kind = 'special'")).select("match_id", "cluster", "team")


_LINEAR = "CASE WHEN {0} / 255e0 > 0.04045e0 THEN power(({0} / 255e0 + 0.055e0) / 1.055e0, 2.4e0) ELSE {0} / 255e0 / 12.92e0 END"
_LAB = "CASE WHEN {0} > 0.008856e0 THEN cbrt({0}) ELSE 7.787e0 * {0} + 16e0 / 116 END"


@query(f"""
    WITH n AS (SELECT p_partkey, p_partkey * 7919 % 16777216 AS n FROM part),
    rgb AS (SELECT p_partkey, {_LINEAR.format("(n // 65536)")} AS r, {_LINEAR.format("(n // 256 % 256)")} AS g, {_LINEAR.format("(n % 256)")} AS b FROM n),
    xyz AS (SELECT p_partkey, (0.412453e0 * r + 0.357580e0 * g + 0.180423e0 * b) / 0.950456e0 AS x, 0.212671e0 * r + 0.715160e0 * g + 0.072169e0 * b AS y,
                   (0.019334e0 * r + 0.119193e0 * g + 0.950227e0 * b) / 1.088754e0 AS z FROM rgb),
    f AS (SELECT p_partkey, {_LAB.format("x")} AS fx, {_LAB.format("y")} AS fy, {_LAB.format("z")} AS fz FROM xyz)
    SELECT p_partkey, round(500 * (fx - fy) + 128) AS a, round(200 * (fy - fz) + 128) AS b FROM f""")
def kit_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chroma of colours written as #rrggbb."""
    a, b = chroma_of_hex(F.format_string("#%06X", F.col("p_partkey") * 7919 % 16777216))
    return view(spark, sf_dir, "part").select("p_partkey", a.alias("a"), b.alias("b"))


@query(f"""
    WITH {_FEATURES} SELECT 'intercept' AS feature, round(avg(is_goal), 3) AS mean FROM f UNION ALL SELECT 'distance_m', round(avg(is_goal * distance_m), 3) FROM f
    UNION ALL SELECT 'angle_rad', round(avg(is_goal * angle_rad), 3) FROM f UNION ALL SELECT 'inverse_distance', round(avg(is_goal * inverse_distance), 3) FROM f""")
def xg_fit_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the penalised likelihood has no slope: each feature's mean over goals is that over
    expected goals, but for the penalty."""
    shots = view(spark, sf_dir, "shots")
    weights = xg.coefficients(xg.fit(shots))
    scored = xg.predict(shots, weights)
    n = F.count(F.lit(1))
    means = [F.avg("xg").alias("intercept"), *(((F.sum(F.col("xg") * F.col(c)) + w) / n).alias(c) for c, w in zip(xg.FEATURES, weights[1:], strict=True))]
    found = scored.agg(*means).unpivot([], ["intercept", *xg.FEATURES], "feature", "mean")
    return found.select("feature", F.round("mean", 3).alias("mean"))


@query("SELECT count(*) AS n_shots, CAST(sum(is_goal) AS double) AS goals FROM {shots}")
def xg_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base model's shape with the intercept under which as many goals are expected as fell."""
    shots = view(spark, sf_dir, "shots")
    scored = xg.predict(shots, xg.offset_intercept(shots, WEIGHTS))
    return scored.agg(F.count(F.lit(1)).alias("n_shots"), F.round(F.sum("xg"), 3).alias("goals"))


@query(f"WITH {_BEST} SELECT match_id, frame, x_px, y_px FROM best ORDER BY match_id, frame LIMIT 25")
def ball_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's first 25 rows of the ball."""
    return report.ball_preview(ball.best_candidates(view(spark, sf_dir, "det"))).select("match_id", "frame", "x_px", "y_px")


@query("SELECT match_id, frame, det_id, track_id, team, CAST(NULL AS smallint) AS shirt, CAST(NULL AS varchar) AS player FROM {tracks_px}")
def identity_abstains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without readings no row has a shirt or a player."""
    return identity.identify(view(spark, sf_dir, "tracks_px")).select("match_id", "frame", "det_id", "track_id", "team", "shirt", "player")


@query("""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n_events, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL""")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming.live import counts_by_window

    found = counts_by_window(view(spark, sf_dir, "events"))
    return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events", F.round("mean_value", 6).alias("mean_value"))


@query("""
    WITH gaps AS (
        SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    ), spells AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS spell FROM gaps)
    SELECT user_id, min(ts) AS spell_start, max(ts) + INTERVAL 6 HOUR AS spell_end, count(*) AS n_events FROM spells GROUP BY user_id, spell""")
def session_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming.live import sightings

    found = sightings(view(spark, sf_dir, "events"), gap="6 hours")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("spell_start", "spell_end")})
