"""A run over one or many matches: stages from detections to the report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, match_kits, squad
from ..contracts import enforce
from ..functions.geometry import PITCH_LENGTH_M
from ..operators import ball, calibrate, detect, events, identity, physical, possession, report, team, tracking
from ..sources.files import frames_up_to, read_homography, write_matches, write_table

#: Stages in the order in which they run, whatever the configuration's order.
ORDER = ("detect", "track", "team", "identity", "calibrate", "ball", "events")


@dataclass
class Inputs:
    """What a run starts from: detections, or a model's raw output, or frames and a model.

    grid is what was read (match_id, pos, frame); without it, the configuration's stride and
    number of frames are applied to frames_read (match_id, frame), or else to all frames
    between a match's first and last detection. matches (match_id, fps, image_width, h: nine
    numbers by rows) has a row for each match whose camera differs from fps, image_width and
    homography; what is null there is as those say. Squads and references may have match_id."""

    detections: DataFrame | None = None
    grid: DataFrame | None = None
    chroma_samples: DataFrame | None = None
    references: DataFrame | None = None
    readings: DataFrame | None = None
    squad: DataFrame | None = None
    homography: Sequence[Sequence[float]] | None = None
    fps: float = 25.0
    image_width: float = 1280.0
    frames_read: DataFrame | None = None
    raw: DataFrame | None = None
    images: DataFrame | None = None
    load_model: Callable[[], detect.Model] | None = None
    matches: DataFrame | None = None


@dataclass
class Run:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    stats: dict[str, DataFrame] = field(default_factory=dict)
    outputs: dict[str, str] = field(default_factory=dict)
    grid: DataFrame | None = None

    def upstream(self, stage: str, *names: str) -> DataFrame:
        """The first of the named stages' tables that there is."""
        for name in names:
            if name in self.tables:
                return self.tables[name]
        raise RuntimeError(f"stage {stage!r} needs one of {list(names)}")


def final_tracks(tracks: DataFrame) -> DataFrame:
    """The tracking table that leaves the engine: smoothed, with speeds, in the contract's types."""
    return enforce(physical.add_kinematics(tracks), "tracks_m", strict=True)


def _detections(config: RunConfig, inputs: Inputs) -> DataFrame:
    """The detections that are given, or those of the model's output by the detector's section."""
    if inputs.detections is not None:
        return inputs.detections
    section, raw = config.section("detector"), inputs.raw
    if raw is None:
        if inputs.images is None:
            raise ValueError("a run needs detections, a model's raw output, or images and a model")
        load = detect.backend(section.get("name", "rtdetr_coco"), section.get("weights"), inputs.load_model)
        raw = detect.infer(inputs.images, load, config.section("runtime").get("batch_size", detect.BATCH))
    classes = section.get("class_map") or {c: c for c in section.get("classes") or (*tracking.TRACKABLE, "ball")}
    return detect.postprocess(raw, classes, section.get("conf_threshold", detect.CONF_THRESHOLD))


def _saved_homography(camera: dict) -> list[list[float]] | None:
    section = camera.get("homography") or camera
    return calibrate.homography_for(camera, read_homography(section["manual_points"]) if section.get("manual_points") else None)


def _cameras(spark: SparkSession, config: RunConfig, inputs: Inputs) -> DataFrame | None:
    """(match_id, fps, image_width, h) of the matches whose cameras differ: those of the inputs,
    with the homographies that match sections have of their own."""
    saved = {m: _saved_homography(section["camera"]) for m, section in config.matches() if config.get("matches") and section.get("camera")}
    rows = [(m, [float(v) for row in h for v in row]) for m, h in saved.items() if h is not None]
    given = inputs.matches
    if not rows:
        return given
    own = spark.createDataFrame(rows, "match_id string, own array<double>")
    if given is None:
        return own.select("match_id", F.lit(None).cast("double").alias("fps"), F.lit(None).cast("double").alias("image_width"), F.col("own").alias("h"))
    return given.join(own, "match_id", "full").select("match_id", "fps", "image_width", F.coalesce("own", "h").alias("h"))


def _check_matches(config: RunConfig, dimensions: dict[str, DataFrame], grid: DataFrame) -> None:
    """An error where a configured squad or kit is of a match that the tables don't have: its
    names and colours would be lost without a word."""
    for name, table in dimensions.items():
        if "match_id" in table.columns:
            lost = table.select("match_id").distinct().join(grid.select("match_id").distinct(), "match_id", "left_anti").orderBy("match_id").limit(5).collect()
            if lost:
                raise ValueError(f"{name} of matches that the tables don't have: {[r.match_id for r in lost]}")


def _own(table: DataFrame, config: RunConfig) -> DataFrame:
    """A dimension from the configuration; that of a match without an id holds for any match."""
    return table.drop("match_id") if config.unnamed else table


def build(config: RunConfig, inputs: Inputs, keep: Callable[[str, DataFrame], DataFrame] = lambda name, table: table) -> Run:
    """The tables of the stages that are switched on. Each is given to keep(name, table),
    which can store it; what it returns is what later stages read. The grid is kept too."""
    run, on = Run(), {s: config.enabled("stages", s) for s in ORDER}
    io = config.section("io")
    step = max(1, io.get("frame_stride") or 1)
    found = _detections(config, inputs)
    if inputs.grid is None:
        frames = inputs.frames_read if inputs.frames_read is not None else ball.frame_grid(found)
        frames = detect.stride(frames.select("match_id", "frame"), step, io.get("max_frames"))
    grid = keep("grid", inputs.grid if inputs.grid is not None else ball.processed_grid(frames))
    run.grid = grid
    found = keep("detect", enforce(found, "detections").join(grid.select("match_id", "frame"), ["match_id", "frame"], "left_semi"))
    spark = found.sparkSession
    cameras = _cameras(spark, config, inputs)
    configured = {"kits": _own(team.kit_references(spark, match_kits(config)), config), "squads": _own(squad(spark, config), config)}
    _check_matches(config, configured, grid)
    if on["detect"]:
        run.tables["detect"] = found
    if on["track"]:
        section = config.section("tracker")
        tracking.check_backend(section.get("backend", section.get("name", "bytetrack")))
        buffer = section.get("lost_track_buffer", tracking.LOST_FRAMES)
        seen, lost = run.upstream("track", "detect"), tracking.lost_frames_at((inputs.fps or 25.0) / step, buffer)
        if cameras is not None:
            seen = seen.join(cameras.select("match_id", F.nullif(F.col("fps").cast("double"), F.lit(0.0)).alias("__fps")), "match_id", "left")
            lost = tracking.lost_frames_at(F.coalesce("__fps", F.lit(float(inputs.fps or 25.0))) / step, buffer)
        tracks = tracking.track(
            seen,
            grid,
            tuple(section.get("track_classes") or tracking.TRACKABLE),
            section.get("track_activation_threshold", tracking.ACTIVATION),
            lost,
            section.get("minimum_matching_threshold", tracking.MATCHING),
        )
        run.tables["track"] = keep("track", tracks.drop("__fps"))
    if on["team"]:
        section, tracks = config.section("team"), run.upstream("team", "track")
        team.check_method(section.get("method", "kit_colour"))
        samples, kits = inputs.chroma_samples, inputs.references
        if samples is None and inputs.images is not None:
            every = section.get("sample_stride", team.SAMPLE_STRIDE)
            boxes = team.sampled_boxes(tracks, every, section.get("min_box_h", team.MIN_BOX_H))
            samples = team.box_chroma(frames_up_to(inputs.images, boxes, every), boxes)
        kits = configured["kits"] if kits is None else kits
        if samples is None:
            teams = tracks.select("match_id", "track_id").limit(0).withColumn("team", F.lit(None).cast("string"))
        else:
            outlier = section.get("outlier_dist", team.OUTLIER_DIST)
            chroma = team.track_chroma(samples, section.get("min_crops", team.MIN_CROPS))
            labelled = team.label_clusters(team.team_centroids(chroma, outlier), kits)
            teams = team.assign_teams(chroma, labelled, kits, outlier, section.get("special_match_dist", team.SPECIAL_DIST))
        run.tables["team"] = keep("team", team.with_teams(tracks, teams))
    if on["identity"]:
        names = inputs.squad if inputs.squad is not None else configured["squads"]
        votes = config.section("identity").get("min_votes", identity.MIN_VOTES)
        run.tables["identity"] = keep("identity", identity.identify(run.upstream("identity", "team", "track"), inputs.readings, names, votes))
    h = inputs.homography
    if h is None and on["calibrate"]:
        h = _saved_homography(config.section("camera"))
    if on["calibrate"]:
        tracks = run.upstream("calibrate", "identity", "team", "track")
        run.tables["calibrate"] = keep("calibrate", calibrate.calibrate(tracks, inputs.fps, h) if cameras is None else calibrate.calibrate_matches(tracks, cameras, inputs.fps, h))
    if on["ball"]:
        section = config.section("ball")
        points = ball.trajectory(
            run.upstream("ball", "detect"),
            grid,
            inputs.fps or 25.0,
            inputs.image_width,
            h if on["calibrate"] else None,
            section.get("max_gap_frames", ball.MAX_GAP),
            section.get("reacquire_s", ball.REACQUIRE_S),
            section.get("max_speed_ms", ball.MAX_SPEED_MS),
            config.section("pitch").get("length_m", PITCH_LENGTH_M),
            cameras if on["calibrate"] or cameras is None else cameras.withColumn("h", F.lit(None).cast("array<double>")),
        )
        run.tables["ball"] = keep("ball", points)
    if on["events"]:
        route = config.section("events").get("route", "manual")
        if route == "tracking":
            tracks, points = run.upstream("events", "calibrate"), run.upstream("events", "ball")
            settled = keep("possession", possession.settled_possession(possession.assign_possession(tracks, points)))
            run.tables["events"] = keep("events", events.from_tracking(tracks, settled, ball.ball_speed(points), inputs.fps, cameras))
        elif route in ("manual", "auto"):
            run.tables["events"] = events.no_events(spark)
        else:
            raise ValueError(f"unknown route of events: {route!r}")
        run.stats["events"] = run.tables["events"].groupBy("match_id").agg(F.count(F.lit(1)).alias("n_events"))
    of = {"detect": detect.class_counts, "track": tracking.tracking_stats, "identity": identity.identity_coverage, "calibrate": calibrate.fraction_on_pitch}
    run.stats.update({s: f(run.tables[s]) for s, f in of.items() if s in run.tables})
    if on["ball"]:
        run.stats["ball"] = ball.coverage(run.tables["ball"], grid)
    return run


def report_tables(run: Run) -> dict[str, DataFrame]:
    tables = {"Stages": report.run_summary(run.tables, run.stats)}
    for name in ("identity", "team"):
        if name in run.tables:
            tables["Teams"] = report.team_split(run.tables[name])
            break
    if "calibrate" in run.tables:
        tables["Physical per player"] = physical.summarise_player(physical.add_kinematics(run.tables["calibrate"])).orderBy("match_id", "team", "player", "track_id")
    if "ball" in run.tables:
        tables["Ball"] = report.ball_preview(run.tables["ball"])
    return tables


def execute(config: RunConfig, inputs: Inputs, out_dir: str) -> Run:
    """build(), and write the outputs that are switched on below out_dir/match_id. Each stage
    is written once, below stages, in a folder for each match, and read back by what follows."""
    base = f"{out_dir}/{config.match_id}"

    def keep(name: str, table: DataFrame) -> DataFrame:
        write_matches(table, f"{base}/stages/{name}")
        return table.sparkSession.read.schema(table.schema).parquet(f"{base}/stages/{name}").select(*table.columns)

    run = build(config, inputs, keep)
    if config.enabled("outputs", "tracks"):
        if "calibrate" in run.tables:
            run.outputs["tracks"] = write_table(final_tracks(run.tables["calibrate"]), f"{base}/tracks.parquet")
        px = [s for s in ("identity", "team", "track", "detect") if s in run.tables]
        if px:
            run.outputs["tracks_px"] = write_table(run.tables[px[0]], f"{base}/tracks_px.parquet")
    for name in ("ball", "events"):
        if config.enabled("outputs", name) and name in run.tables:
            run.outputs[name] = write_table(enforce(run.tables[name], name, strict=True), f"{base}/{name}.parquet")
    if config.enabled("outputs", "report"):
        covered = 0.0
        if "identity" in run.tables:
            covered = identity.identity_coverage(run.tables["identity"]).agg(F.avg("identity_coverage")).first()[0] or 0.0
        run.outputs["report"] = str(report.html_report(config.match_id, covered, report_tables(run), f"{base}/report.html"))
    return run
