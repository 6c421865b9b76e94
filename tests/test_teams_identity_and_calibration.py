from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake import cli
from pitchlake.functions.geometry import LANDMARKS, chroma_of_hex, project
from pitchlake.operators import calibrate, identity, team
from pitchlake.sources import files

RED, BLUE, YELLOW, GREEN = (30, 30, 200), (200, 60, 30), (30, 220, 220), (30, 160, 30)
BOXES = {0: (50, RED), 1: (150, RED), 2: (350, BLUE), 3: (450, BLUE), 4: (550, YELLOW)}


@pytest.fixture(scope="module")
def chroma(spark):
    image = np.full((360, 640, 3), GREEN, dtype=np.uint8)
    for x, colour in BOXES.values():
        image[100:160, x : x + 30] = colour
    frames = spark.createDataFrame([("m", f, 360, 640, 3, bytes(image.tobytes())) for f in range(6)], "match_id string, frame long, height int, width int, nChannels int, data binary")
    rows = [("m", f, t, "player", float(x), 100.0, x + 30.0, 160.0) for f in range(6) for t, (x, _) in BOXES.items()]
    rows += [("m", f, 9, "player", 5.0, 5.0, 35.0, 65.0) for f in range(6)]  # grass alone
    boxes = spark.createDataFrame(rows, "match_id string, frame long, track_id long, cls string, x1 double, y1 double, x2 double, y2 double")
    return team.track_chroma(team.box_chroma(frames, team.sampled_boxes(boxes, 1))).cache()


def hexed(bgr):
    return "#{:02x}{:02x}{:02x}".format(*bgr[::-1])


def assigned(spark, chroma, kits):
    references = team.kit_references(spark, kits)
    labelled = team.label_clusters(team.team_centroids(chroma), references)
    return {r.track_id: r.team for r in team.assign_teams(chroma, labelled, references).collect()}


def test_teams_by_kit_colours(spark, chroma):
    kits = [("home", "kit", hexed(RED)), ("away", "kit", hexed(BLUE))]
    assert assigned(spark, chroma, [*kits, ("referee", "special", hexed(YELLOW))]) == {0: "home", 1: "home", 2: "away", 3: "away", 4: "referee"}
    assert assigned(spark, chroma, kits)[4] is None
    assert assigned(spark, chroma, [("away", "kit", hexed(RED))]) == {0: "away", 1: "away", 2: "home", 3: "home", 4: None}
    none = assigned(spark, chroma, [])
    assert none[0] == none[1] != none[2] == none[3] and {none[0], none[2]} == {"home", "away"}


def test_grass_and_small_boxes_have_no_colour(spark, chroma):
    assert 9 not in {r.track_id for r in chroma.collect()}
    image = np.full((100, 100, 3), RED, dtype=np.uint8)
    assert team.torso_chroma(image, (0, 0, 20, 7)) is None and team.torso_chroma(image, (0, 0, 3, 40)) is None
    assert team.torso_chroma(image, (200, 200, 240, 280)) is None and team.torso_chroma(image, (0, 0, 40, 80)) is not None


def test_chroma_of_hex_equals_that_of_pixels(spark):
    a, b = chroma_of_hex(F.col("h"))
    colours = [(0, 0, 0), (255, 255, 255), RED, BLUE, YELLOW, GREEN]
    df = spark.createDataFrame([(i, hexed(c)) for i, c in enumerate(colours)], "i int, h string")
    want = team.lab_chroma(np.array(colours, dtype=np.uint8))
    for r in df.select("i", a.alias("a"), b.alias("b")).collect():
        assert abs(r.a - want[r.i][0]) <= 1 and abs(r.b - want[r.i][1]) <= 1


def test_special_colours_at_the_cap_are_rejected(spark):
    chroma = spark.createDataFrame([("m", 1, 0.0, 0.0), ("m", 2, 100.0, 0.0)], "match_id string, track_id long, a double, b double")
    labelled = spark.createDataFrame([("m", 0, 0.0, 0.0, "home"), ("m", 1, -500.0, 0.0, "away")], "match_id string, cluster int, a double, b double, team string")
    for gap, want in ((40.0, None), (39.9, "referee")):
        references = spark.createDataFrame([(0, "referee", "special", 100.0 + gap, 0.0)], "place int, label string, kind string, ref_a double, ref_b double")
        assert {r.track_id: r.team for r in team.assign_teams(chroma, labelled, references).collect()} == {1: "home", 2: want}


def test_outliers_are_peeled_and_few_tracks_have_no_clusters(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal((20, 0), 2, (10, 2)), rng.normal((-20, 0), 2, (8, 2)), [(20, 45)]])
    found = team.peeled_centroids(points)
    assert np.allclose(found, [points[:10].mean(axis=0), points[10:18].mean(axis=0)], atol=1e-6)
    one = spark.createDataFrame([("m", 1, 0.0, 0.0)], "match_id string, track_id long, a double, b double")
    assert team.team_centroids(one).count() == 0


def test_teams_of_tracks(spark):
    tracks = spark.createDataFrame([("m", 1, "player"), ("m", -1, "ball"), ("m", 7, "player")], "match_id string, track_id long, cls string")
    teams = spark.createDataFrame([("m", 1, "home"), ("m", 3, None)], "match_id string, track_id long, team string")
    assert {r.track_id: r.team for r in team.with_teams(tracks, teams).collect()} == {1: "home", -1: "ball", 7: None}
    assert {r.team: r.n_tracks for r in team.team_counts(teams).collect()} == {"home": 1, None: 1}
    with pytest.raises(NotImplementedError):
        team.check_method("siglip_umap_kmeans")
    with pytest.raises(ValueError):
        team.check_method("other")


def votes(spark, numbers, **options):
    rows = [("m", 1, i, n) for i, n in enumerate(numbers)]
    return identity.majority_vote(spark.createDataFrame(rows, "match_id string, track_id long, seq long, number long"), **options).first().shirt


def test_votes(spark):
    assert votes(spark, [7, 7]) is None
    assert votes(spark, [7, 7, 7, 1, 7, 9]) == 7
    assert votes(spark, [7, 1, 9, 3, 4, 5]) is None
    assert votes(spark, [7, 7, 7, 1, 2, 3]) == 7  # exactly half
    assert votes(spark, [4, 9, 9, 4, None, 4, 9]) == 4  # a tie goes to the first read
    assert votes(spark, [None] * 9) is None


def test_squad_and_abstention(spark):
    tracks = spark.createDataFrame([("m", 1, "player", "home"), ("m", 2, "player", "home"), ("m", 3, "ball", "ball"), ("m", 4, "player", None)], "match_id string, track_id long, cls string, team string")
    readings = spark.createDataFrame([("m", t, i, 9) for t in (1, 4) for i in range(5)], "match_id string, track_id long, seq long, number long")
    squad = spark.createDataFrame([("home", 9, "Nine")], "side string, shirt short, name string")
    out = identity.identify(tracks, readings, squad)
    assert {r.track_id: (r.shirt, r.player) for r in out.collect()} == {1: (9, "Nine"), 2: (None, None), 3: (None, None), 4: (9, None)}
    assert identity.identity_coverage(out).first().identity_coverage == 0.333
    assert identity.identity_coverage(identity.identify(tracks)).first().identity_coverage == 0.0


SCALE = [[105 / 640, 0, 0], [0, -68 / 360, 68], [0, 0, 1]]
PIXELS = [(100.0, 80.0), (1180.0, 90.0), (60.0, 640.0), (1230.0, 655.0), (640.0, 300.0), (300.0, 420.0)]


def exact_pairs(points=PIXELS):
    h = np.array([[0.08, 0.01, 1.0], [0.002, -0.1, 70.0], [0.0, 0.0003, 1.0]])
    out = []
    for x, y in points:
        u, v, w = h @ (x, y, 1)
        out.append(((x, y), (u / w, v / w)))
    return out


def test_homography_of_exact_and_of_bad_landmarks():
    h, error = calibrate.solve_homography(exact_pairs())
    assert error < 1e-6
    h, error = calibrate.solve_homography([*exact_pairs(), ((500.0, 300.0), (5.0, 60.0))])
    assert error < 0.5
    u, v, w = h @ (640.0, 300.0, 1)
    assert np.allclose((u / w, v / w), exact_pairs()[4][1], atol=0.1)
    with pytest.raises(ValueError, match="at least 4"):
        calibrate.solve_homography(exact_pairs()[:3])
    with pytest.raises(ValueError, match="no homography"):
        calibrate.solve_homography([((float(i), float(i)), (float(i), 0.0)) for i in range(5)])


def boxes(spark):
    return spark.createDataFrame([("m", 4, 0, "player", 0.9, 100.0, 100.0, 130.0, 160.0, 1)], "match_id string, frame long, det_id long, cls string, conf double, x1 double, y1 double, x2 double, y2 double, track_id long")


def test_calibration(spark):
    row = calibrate.calibrate(boxes(spark), 25, SCALE).first()
    assert abs(row.x_m - 115 * 105 / 640) < 1e-9 and abs(row.y_m - (68 - 160 * 68 / 360)) < 1e-9 and row.t_s == 0.16
    assert (row.team, row.shirt, row.player) == (None, None, None)
    assert calibrate.calibrate(boxes(spark), 0).first().x_m is None and calibrate.calibrate(boxes(spark), 0).first().t_s == 0.16
    matrices = spark.createDataFrame([("m", [float(v) for r in SCALE for v in r])], "match_id string, h array<double>")
    both = boxes(spark).unionByName(boxes(spark).withColumn("match_id", F.lit("n")))
    out = {r.match_id: r.x_m for r in calibrate.calibrate_matches(both, matrices).collect()}
    assert abs(out["m"] - row.x_m) < 1e-9 and out["n"] is None
    assert calibrate.homography_for({}, {"homography": SCALE}) is None
    assert calibrate.homography_for({"mode": "static"}, {"homography": SCALE}) == SCALE and calibrate.homography_for({"mode": "static"}, None) is None


def test_points_on_the_horizon_and_off_the_pitch(spark):
    x, y = project(F.lit(1.0), F.lit(2.0), [[1, 0, 0], [0, 1, 0], [1, 0, -1]])
    assert spark.range(1).select(x.alias("x"), y.alias("y")).first() == (None, None)
    df = spark.createDataFrame([("m", 0.0, 0.0), ("m", -3.0, 71.0), ("m", 108.001, 5.0), ("m", None, None), ("n", None, None)], "match_id string, x_m double, y_m double")
    out = {r.match_id: (r.fraction_on_pitch, r.low) for r in calibrate.fraction_on_pitch(df).collect()}
    assert out == {"m": (0.5, True), "n": (None, None)}


def test_calibrate_command(tmp_path, capsys):
    names = list(LANDMARKS)[:6]
    inverse = np.linalg.inv(np.array(SCALE))
    points = []
    for n in names:
        u, v, w = inverse @ (*LANDMARKS[n], 1)
        points.append({"name": n, "pixels": [u / w, v / w]})
    (tmp_path / "p.json").write_text(json.dumps({"points": points}))
    assert cli.main(["calibrate", "--points", str(tmp_path / "p.json"), "--out", str(tmp_path / "h.json")]) == 0
    saved = files.read_homography(tmp_path / "h.json")
    assert saved["error_m"] < 1e-6 and np.allclose(saved["homography"], SCALE, atol=1e-6)
    (tmp_path / "q.json").write_text(json.dumps({"points": points[:3]}))
    assert cli.main(["calibrate", "--points", str(tmp_path / "q.json"), "--out", str(tmp_path / "none.json")]) == 1
    assert files.read_homography(tmp_path / "none.json") is None
