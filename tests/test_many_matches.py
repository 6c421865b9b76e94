from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pitchlake import cli
from pitchlake import config as configs
from pitchlake.operators import ball, calibrate, team, tracking
from pitchlake.plans import match_run

from .test_recordings_and_frames import bitmap, mp4, scene

DET = "match_id string, frame long, det_id long, cls string, conf double, x1 double, y1 double, x2 double, y2 double"
FLAT = [[105 / 640, 0, 0], [0, -68 / 360, 68], [0, 0, 1]]


def detections(spark, *matches):
    rows = []
    for m in matches:
        rows += [(m, f, p, "player", 0.9, 100.0 + 200 * p + 4 * f, 100.0, 130.0 + 200 * p + 4 * f, 160.0) for f in range(10) for p in range(2)]
        rows += [(m, f, 2, "ball", 0.8, 300.0 + 40 * f, 100.0, 310.0 + 40 * f, 110.0) for f in range(10)]
    return spark.createDataFrame(rows, DET)


def test_match_files_have_their_own_squads_kits_and_cameras(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps({"solved_homography": FLAT}))
    (tmp_path / "camera.yaml").write_text(f"homography:\n  mode: static\n  manual_points: {tmp_path}/h.json\n")
    (tmp_path / "p.yaml").write_text("outputs:\n  report: false\n")
    (tmp_path / "a.yaml").write_text(f"match_id: a\ncamera: {tmp_path}/camera.yaml\nhome:\n  kit_colour: '#ff0000'\n  squad:\n    9: {{name: Nine}}\n")
    (tmp_path / "b.yaml").write_text("match_id: b\naway:\n  kit_colour: '#0000ff'\n  squad:\n  - {shirt: 9, name: Other}\n")
    config = configs.resolve(tmp_path / "p.yaml", [tmp_path / "a.yaml", tmp_path / "b.yaml"])
    assert [m for m, _ in config.matches()] == ["a", "b"] and config.matches()[0][1]["camera"]["homography"]["mode"] == "static"
    assert sorted(tuple(r) for r in configs.squad(spark, config).collect()) == [("a", "home", 9, "Nine"), ("b", "away", 9, "Other")]
    assert configs.match_kits(config) == [("a", "home", "kit", "#ff0000"), ("b", "away", "kit", "#0000ff")]
    run = match_run.build(config, match_run.Inputs(detections(spark, "a", "b"), image_width=640.0))
    known = {r.match_id: r.n for r in run.tables["calibrate"].groupBy("match_id").agg(F.count("x_m").alias("n")).collect()}
    points = {r.match_id: r.n for r in run.tables["ball"].groupBy("match_id").agg(F.count("x_m").alias("n")).collect()}
    assert known == {"a": 30, "b": 0} and points["a"] > 0 == points["b"]
    assert configs.resolve(tmp_path / "p.yaml", [tmp_path / "a.yaml"]).section("match")["match_id"] == "a"
    (tmp_path / "c.yaml").write_text("match_id: b\n")
    with pytest.raises(ValueError, match="id each"):
        configs.resolve(tmp_path / "p.yaml", [tmp_path / "b.yaml", tmp_path / "c.yaml"])


def test_names_of_a_match_that_is_not_there_are_an_error(spark):
    squad = {"home": {"squad": {9: {"name": "Nine"}}}}
    inputs = match_run.Inputs(detections(spark, "m0"), image_width=640.0)
    with pytest.raises(ValueError, match=r"squads of matches.*\['g1'\]"):
        match_run.build(configs.RunConfig(match={"match_id": "g1", **squad}), inputs)
    with pytest.raises(ValueError, match="kits"):
        match_run.build(configs.RunConfig(match={"match_id": "g1", "referee_colour": "#000000"}), inputs)
    match_run.build(configs.RunConfig(match={"match_id": "g1"}), inputs)


def test_a_match_without_an_id_stands_for_any(spark):
    match = {"home": {"kit_colour": "#D32F2F", "squad": {9: {"name": "Nine"}}}, "away": {"kit_colour": "#1976D2"}}
    refs = {r.label: (r.ref_a, r.ref_b) for r in team.kit_references(spark, configs.kit_colours(configs.RunConfig(match=match))).collect()}
    chroma = spark.createDataFrame([("m0", t, f, *refs[s]) for t, s in ((1, "home"), (2, "away")) for f in range(4)], "match_id string, track_id long, frame long, a double, b double")
    readings = spark.createDataFrame([("m0", 1, i, 9) for i in range(6)], "match_id string, track_id long, seq long, number int")
    run = match_run.build(configs.RunConfig(match=match), match_run.Inputs(detections(spark, "m0"), chroma_samples=chroma, readings=readings, image_width=640.0))
    assert {(r.track_id, r.team, r.player) for r in run.tables["identity"].where("cls = 'player'").collect()} == {(1, "home", "Nine"), (2, "away", None)}


def test_kits_hold_for_their_own_match(spark):
    kits = [("a", "home", "kit", "#D32F2F"), ("a", "away", "kit", "#1976D2"), ("b", "home", "kit", "#1976D2"), ("b", "away", "kit", "#D32F2F"), ("b", "referee", "special", "#FFEB3B")]
    references = team.kit_references(spark, kits)
    colour = {r.label: (r.ref_a, r.ref_b) for r in references.where("match_id = 'a'").collect()} | {"yellow": next((r.ref_a, r.ref_b) for r in references.where("kind = 'special'").collect())}
    rows = [(m, t, *colour[c], 4) for m in "abc" for t, c in enumerate(["home"] * 3 + ["away"] * 2 + ["yellow"])]
    chroma = spark.createDataFrame(rows, "match_id string, track_id long, a double, b double, n_crops long")
    labelled = team.label_clusters(team.team_centroids(chroma), references)
    found = {(r.match_id, r.track_id): r.team for r in team.assign_teams(chroma, labelled, references).collect()}
    assert [found["a", t] for t in range(6)] == ["home"] * 3 + ["away"] * 2 + [None]
    assert [found["b", t] for t in range(6)] == ["away"] * 3 + ["home"] * 2 + ["referee"]
    assert [found["c", t] for t in range(6)] == ["home"] * 3 + ["away"] * 2 + [None]


def test_cameras_set_rates_widths_and_metres(spark):
    h = [float(v) for row in FLAT for v in row]
    cameras = spark.createDataFrame([("a", 50.0, None, h), ("b", 0.0, 64000.0, None)], "match_id string, fps double, image_width double, h array<double>")
    det = detections(spark, "a", "b", "c")
    points = ball.trajectory(det, ball.processed_grid(det), 25.0, 640.0, cameras=cameras).collect()
    at = {m: sorted((r.frame, r.t_s, r.x_m) for r in points if r.match_id == m and not r.interpolated) for m in "abc"}
    # 40 pixels a frame are 1,000 a second at 25 frames, and 2,000 at 50; the limit is 411 for 640 pixels.
    assert len(at["b"]) == 10 and at["b"][1][1] == 1 / 25 and at["b"][0][2] is None
    assert len(at["a"]) < 10 and len(at["c"]) < 10 and at["a"][0][2] == 305 * 105 / 640
    tracks = calibrate.calibrate_matches(det.withColumn("track_id", F.lit(1)), cameras, 25.0, FLAT).where("frame = 5 and det_id = 0").collect()
    assert {r.match_id: r.t_s for r in tracks} == {"a": 0.1, "b": 0.2, "c": 0.2} and all(r.x_m == 135 * 105 / 640 for r in tracks)
    lost = spark.createDataFrame([(x,) for x in (25.0, 12.5, 0.2, 59.94)], "fps double").select("fps", tracking.lost_frames_at(F.col("fps"), 60).alias("n"))
    assert all(r.n == tracking.lost_frames_at(r.fps, 60) for r in lost.collect())


def test_commands_run_many_matches(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / "recordings").mkdir(exist_ok=True)
        (tmp_path / "recordings" / f"{name}.mp4").write_bytes(mp4([(10, 512 if name == "a" else 256)]))
        (tmp_path / "frames" / name).mkdir(parents=True)
        for f in range(10):
            (tmp_path / "frames" / name / f"{f}.bmp").write_bytes(bitmap(scene(f)))
        (tmp_path / f"{name}.yaml").write_text(f"match_id: {name}\nhome:\n  squad:\n    1: {{name: One}}\n")
    detections(spark, "a", "b").write.parquet(f"file://{tmp_path}/det")
    (tmp_path / "p.yaml").write_text("match_id: both\noutputs:\n  report: false\n")
    args = ["run", "--detections", f"file://{tmp_path}/det", "--config", str(tmp_path / "p.yaml"), "--out", f"file://{tmp_path}/out"]
    several = ["--match", str(tmp_path / "a.yaml"), "--match", str(tmp_path / "b.yaml"), "--recording", f"file://{tmp_path}/recordings", "--images", f"file://{tmp_path}/frames"]
    assert cli.main([*args, *several]) == 0
    tracks = spark.read.parquet(f"file://{tmp_path}/out/both/tracks.parquet").where("frame = 9").select("match_id", "t_s").distinct().collect()
    assert {r.match_id: round(r.t_s, 3) for r in tracks} == {"a": 0.36, "b": 0.18}
    with pytest.raises(ValueError, match="images"):
        cli.main([*args, "--images", f"file://{tmp_path}/frames/a"])
