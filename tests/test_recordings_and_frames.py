from __future__ import annotations

import io
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake import cli
from pitchlake.operators import detect
from pitchlake.sources import files, recordings


def box(kind, *parts, wide=False):
    body = b"".join(parts)
    return (struct.pack(">I4sQ", 1, kind, 16 + len(body)) if wide else struct.pack(">I4s", 8 + len(body), kind)) + body


def track(number, kind, scale, times, width=0, height=0, version=0):
    t = ">Q" if version else ">I"
    stamps = struct.pack(t, 0) * 2
    head = bytes([version, 0, 0, 0]) + stamps
    entry = struct.pack(">I4s", 86, b"avc1") + bytes(6) + struct.pack(">H", 1) + bytes(16) + struct.pack(">HH", width, height) + bytes(50)
    stts = struct.pack(">II", 0, len(times)) + b"".join(struct.pack(">II", *x) for x in times)
    table = box(b"stbl", box(b"stsd", struct.pack(">II", 0, 1), entry), box(b"stts", stts))
    media = box(b"mdia", box(b"mdhd", head, struct.pack(">I", scale), bytes(12)), box(b"hdlr", bytes(8), kind, bytes(12)), box(b"minf", table))
    return box(b"trak", box(b"tkhd", head, struct.pack(">I", number), bytes(60)), media)


def mp4(times=((250, 512),), late=True, version=0, wide=False):
    movie = box(b"moov", box(b"mvhd", bytes(100)), track(1, b"soun", 48000, [(9, 1024)], version=version), track(2, b"vide", 12800, times, 1920, 1080, version))
    data = box(b"mdat", bytes(5000), wide=wide)
    return box(b"ftyp", b"isom", bytes(8)) + (data + movie if late else movie + data)


def fragmented():
    movie = box(b"moov", track(2, b"vide", 30000, [], 640, 360), box(b"mvex", box(b"trex", struct.pack(">IIIIII", 0, 2, 1, 1001, 0, 0))))
    runs = [box(b"moof", box(b"traf", box(b"tfhd", struct.pack(">II", 0, 2)), box(b"trun", struct.pack(">III", 1, n, 99)))) for n in (30, 15)]
    own = struct.pack(">II", 0x000301, 2) + struct.pack(">I", 7) + struct.pack(">IIII", 1001, 5, 2002, 5)
    last = box(b"moof", box(b"traf", box(b"tfhd", struct.pack(">III", 8, 2, 5)), box(b"trun", own)))
    return movie + b"".join(r + box(b"mdat", bytes(100)) for r in runs) + last


def chunk(kind, body):
    return kind + struct.pack("<I", len(body)) + body + bytes(len(body) % 2)


def avi(rate=30000, scale=1001, n=77, width=720, height=-576):
    def stream(kind, form):
        head = kind + bytes(16) + struct.pack("<IIII", scale, rate, 0, n) + bytes(20)
        return chunk(b"LIST", b"strl" + chunk(b"strh", head) + chunk(b"strf", form))

    form = struct.pack("<IiiHH", 40, width, height, 1, 24) + bytes(24)
    body = b"AVI " + chunk(b"LIST", b"hdrl" + chunk(b"avih", bytes(56)) + stream(b"auds", bytes(18)) + stream(b"vids", form)) + chunk(b"LIST", b"movi" + bytes(3001))
    return chunk(b"RIFF", body)


class Watched(io.BytesIO):
    n = 0

    def read(self, size=-1):
        data = super().read(size)
        self.n += len(data)
        return data


def test_containers():
    want = {"fps": 25.0, "width": 1920, "height": 1080, "n_frames": 250}
    for data in (mp4(), mp4(late=False), mp4(version=1), mp4(wide=True), mp4([(100, 512), (150, 512)])):
        assert recordings.container_meta(io.BytesIO(data)) == want
    mixed = recordings.container_meta(io.BytesIO(mp4([(100, 512), (100, 256)])))
    assert mixed["n_frames"] == 200 and mixed["fps"] == 200 * 12800 / (100 * 768)
    found = recordings.container_meta(io.BytesIO(fragmented()))
    assert found == {"fps": 47 * 30000 / (45 * 1001 + 3003), "width": 640, "height": 360, "n_frames": 47}
    assert recordings.container_meta(io.BytesIO(avi())) == {"fps": 30000 / 1001, "width": 720, "height": 576, "n_frames": 77}
    assert recordings.container_meta(io.BytesIO(avi(scale=0)))["fps"] == 0.0
    for data in (b"", b"RIFF", b"not a recording at all", bytes(100), mp4()[:40], box(b"moov", box(b"stts", bytes(8))), box(b"moov", track(1, b"soun", 1, []))):
        assert recordings.container_meta(io.BytesIO(data)) is None


def test_only_headers_are_read():
    file = Watched(box(b"ftyp", bytes(8)) + box(b"mdat", bytes(5_000_000)) + mp4())
    assert recordings.container_meta(file)["n_frames"] == 250 and file.n < 2000


def test_recordings_of_a_folder(spark, tmp_path):
    folder = tmp_path / "recordings"
    folder.mkdir()
    for name, data in (("a b.mp4", mp4()), ("second.half.avi", avi()), ("notes.txt", b"text"), ("still.mp4", mp4([(3, 0)]))):
        (folder / name).write_bytes(data)
    found = {r.match_id: (r.fps, r.width, r.height, r.n_frames, r.duration_s) for r in recordings.read_recordings(spark, f"file://{folder}").collect()}
    assert found["a b"] == (25.0, 1920, 1080, 250, 10.0) and found["notes"] == (None,) * 5 and found["still"] == (0.0, 1920, 1080, 3, 0.0)
    assert found["second.half"][3] == 77
    assert recordings.probe_recording(spark, f"file://{folder}/a b.mp4", "m") == files.video_meta("m", 25.0, 1920, 1080, 250)
    frames = recordings.frames_of(recordings.read_recordings(spark, f"file://{folder}/*.mp4"))
    assert frames.groupBy("match_id").count().collect() != [] and frames.count() == 253
    with pytest.raises(FileNotFoundError):
        recordings.read_recordings(spark, f"file://{folder}/missing.mp4")
    with pytest.raises(ValueError, match="not an MP4"):
        recordings.probe_recording(spark, f"file://{folder}/notes.txt")


def test_commands_take_rate_and_size_from_the_recording(spark, tmp_path, capsys):
    (tmp_path / "r.mp4").write_bytes(mp4([(30, 256)]))
    assert cli.main(["inspect", "--recording", f"file://{tmp_path}/r.mp4"]) == 0
    assert "'fps': 50.0" in capsys.readouterr().out
    with pytest.raises(FileNotFoundError):
        cli.main(["inspect", "--recording", f"file://{tmp_path}/none.mp4"])
    rows = [("r", f, 0, "ball", 0.9, 10.0 + 20 * f, 5.0, 20.0 + 20 * f, 15.0) for f in (0, 5, 25)]
    spark.createDataFrame(rows, "match_id string, frame long, det_id long, cls string, conf double, x1 double, y1 double, x2 double, y2 double").write.parquet(f"file://{tmp_path}/det")
    (tmp_path / "c.yaml").write_text("match_id: r\nio:\n  frame_stride: 5\noutputs:\n  report: false\n")
    args = ["run", "--detections", f"file://{tmp_path}/det", "--recording", f"file://{tmp_path}/r.mp4", "--config", str(tmp_path / "c.yaml"), "--out", f"file://{tmp_path}/out"]
    assert cli.main(args) == 0
    ball = spark.read.parquet(f"file://{tmp_path}/out/r/ball.parquet").orderBy("frame").collect()
    assert [(r.frame, round(r.t_s, 3)) for r in ball] == [(0, 0.0), (5, 0.1), (10, 0.2), (15, 0.3), (20, 0.4), (25, 0.5)]
    assert spark.read.parquet(f"file://{tmp_path}/out/r/stages/grid").count() == 6


def bitmap(pixels):
    """A 24-bit BMP file of rows of BGR pixels."""
    h, w = pixels.shape[:2]
    pad = bytes(-3 * w % 4)
    body = b"".join(row.tobytes() + pad for row in pixels[::-1])
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def scene(frame):
    """Three scenes of noise in different colours, of 8, 5 and 7 frames."""
    base = [(200, 40, 40), (40, 200, 40), (40, 40, 200)][(frame >= 8) + (frame >= 13)]
    noise = np.random.default_rng(frame).integers(-20, 20, (12, 10, 3))
    return (np.array(base) + noise).astype(np.uint8)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("frames")
    for match in ("one", "match_id=two"):
        (root / match).mkdir()
        for f in range(20):
            (root / match / f"frame_{f:05d}.bmp").write_bytes(bitmap(scene(f)))
        (root / match / "readme.txt").write_text("no frame")
    return root


def opened(df):
    """How many files the images' scan of a query opened."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    found, nodes = 0, [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            node.execute().count()
            found += node.metrics().apply("numFiles").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_frames_are_those_of_the_stride_and_only_their_files_are_opened(spark, folder):
    path = f"file://{folder}/one"
    every = files.read_frames(spark, path)
    row = every.where("frame = 3").first()
    assert (row.match_id, row.height, row.width, row.nChannels) == ("match", 12, 10, 3) and bytes(row.data) == scene(3).tobytes()
    assert every.count() == 20
    for some, want in (
        (files.read_frames(spark, path, step=4), [0, 4, 8, 12, 16]),
        (files.read_frames(spark, path, step=3, most=2, start=2), [2, 5]),
        (every.where("frame between 4 and 6"), [4, 5, 6]),
        (files.frames_up_to(every, spark.createDataFrame([("match", 7), ("match", 3)], "match_id string, frame long"), 5), [0, 5]),
        (files.read_frames(spark, path, most=99), list(range(20))),
    ):
        assert sorted(r.frame for r in some.select("frame").collect()) == want
        assert opened(some) == len(want)
    assert files.probe_frames(spark, path, 25.0, "m") == files.video_meta("m", 25.0, 10, 12, 20)
    with pytest.raises(FileNotFoundError):
        files.probe_frames(spark, f"file://{folder}/none")


def test_frames_of_many_matches(spark, folder):
    every = files.read_frames(spark, f"file://{folder}", None)
    assert {(r.match_id, r.n) for r in every.groupBy("match_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {("one", 20), ("two", 20)}
    wanted = spark.createDataFrame([("one", 2), ("two", 9)], "match_id string, frame long")
    some = files.frames_up_to(every, wanted)
    assert sorted((r.match_id, r.frame) for r in some.select("match_id", "frame").collect()) == [("one", f) for f in range(3)] + [("two", f) for f in range(10)]
    assert opened(some) == 13 and opened(every.where("match_id = 'two' and frame < 2")) == 2


def test_cuts_of_images_equal_brute_force(spark, folder):
    frames = files.read_frames(spark, f"file://{folder}", None)
    cuts = detect.image_cuts(frames)
    assert sorted((r.match_id, r.frame) for r in cuts.collect()) == [(m, f) for m in ("one", "two") for f in (8, 13)]

    def histogram(f):
        cell = (scene(f).reshape(-1, 3).astype(int) * 8 // 256) @ (64, 8, 1)
        return np.bincount(cell, minlength=512) / len(cell)

    want = {f: 1 - np.minimum(histogram(f), histogram(f - 1)).sum() for f in range(1, 20)}
    low = {(r.match_id, r.frame): r.change for r in detect.image_cuts(frames, -1.0).collect()}
    assert len(low) == 38 and all(abs(low[m, f] - want[f]) < 1e-9 for m, f in low)
    grid = spark.createDataFrame([("one", f, f) for f in range(20)], "match_id string, pos long, frame long")
    assert [r.scene for r in detect.scenes(grid, cuts).orderBy("pos").collect()] == [0] * 8 + [1] * 5 + [2] * 7


def test_histograms_of_odd_images(spark):
    rows = [("m", 0, 1, 4, 1, bytes([0, 31, 32, 255])), ("m", 1, 1, 1, 4, bytes([255, 0, 0, 9])), ("m", 2, 0, 0, 3, b""), ("m", 3, None, None, None, None)]
    found = detect.frame_histograms(spark.createDataFrame(rows, "match_id string, frame long, height int, width int, nChannels int, data binary"))
    out = {r.frame: r.histogram and {i: v for i, v in enumerate(r.histogram) if v} for r in found.collect()}
    assert out == {0: {0: 0.5, 73: 0.25, 511: 0.25}, 1: {448: 1.0}, 2: None, 3: None}
