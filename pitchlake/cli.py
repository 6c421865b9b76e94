"""Commands: run, inspect, calibrate, fit-xg."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import resolve
from .operators.calibrate import WARN_M, solve_homography
from .sources import files
from .sources.recordings import cameras_of, frames_of, probe_recording, read_recordings


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pitchlake")
    commands = p.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run the stages over detections")
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--detections", help="a parquet table of detections")
    source.add_argument("--raw", help="a parquet table of a model's raw output")
    for name, what in (("frames", "(match_id, frame) of all frames of the recordings"), ("readings", "shirt numbers read"), ("chroma", "colours of boxes")):
        run.add_argument(f"--{name}", help=f"a parquet table of {what}")
    run.add_argument("--images", help="a folder of the frames as images, for colours; with several matches, of a folder for each")
    run.add_argument("--recording", help="an MP4 or AVI file, for rate, size and frames; or a folder of such files, named by their matches")
    run.add_argument("--fps", type=float, help="25 unless --recording tells")
    run.add_argument("--width", type=float, help="of the images in pixels; 1280 unless --images tells")
    run.add_argument("--config", required=True)
    run.add_argument("--match", action="append", help="a match's file; several for several matches")
    run.add_argument("--out", default="outputs")
    run.add_argument("--max-frames", type=int)
    inspect = commands.add_parser("inspect", help="count a detections table's frames and boxes")
    inspect.add_argument("--detections")
    inspect.add_argument("--recording", help="MP4 or AVI files")
    inspect.add_argument("--images", help="a folder of frames as images")
    inspect.add_argument("--fps", type=float, default=0.0)
    calibrate = commands.add_parser("calibrate", help="solve a homography from landmark points")
    calibrate.add_argument("--points", required=True)
    calibrate.add_argument("--out", required=True)
    xg = commands.add_parser("fit-xg", help="fit expected goals on local shots")
    xg.add_argument("--shots", required=True)
    xg.add_argument("--out", required=True)
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    if a.command == "calibrate":
        pairs = files.read_points(a.points)
        if len(pairs) < 4:
            print(f"{len(pairs)} points; at least 4 are needed")
            return 1
        h, error = solve_homography(pairs)
        files.write_homography(a.out, h, error, pairs)
        print(f"error {error:.3f} m" + (", more than it should be" if error > WARN_M else ""))
        return 0
    spark = SparkSession.builder.appName("pitchlake").getOrCreate()
    if a.command == "inspect":
        from .operators.detect import class_counts

        if a.recording:
            for row in read_recordings(spark, a.recording).collect():
                print(row.asDict())
        if a.images:
            print(files.probe_frames(spark, a.images, a.fps))
        if a.detections:
            class_counts(spark.read.parquet(a.detections)).orderBy("match_id", "cls").show(100, False)
    elif a.command == "fit-xg":
        from .operators.xg import fit_local

        print("intercept and weights:", *fit_local(spark, a.shots, a.out))
    else:
        from .plans.match_run import Inputs, execute

        config = resolve(a.config, a.match)
        if a.max_frames is not None:
            config["io"] = {**config.section("io"), "max_frames": a.max_frames}
        tables = {name: spark.read.parquet(path) if path else None for name, path in vars(a).items() if name in ("detections", "raw", "frames", "readings", "chroma")}
        many = bool(config.get("matches"))
        recordings = read_recordings(spark, a.recording) if a.recording and many else None
        meta = {}
        if a.recording and not many:
            meta = probe_recording(spark, a.recording, config.match_id)
            recordings = spark.createDataFrame([(config.match_id, meta["n_frames"])], "match_id string, n_frames long")
        elif a.images and not many:
            meta = files.probe_frames(spark, a.images)
        inputs = Inputs(
            tables["detections"],
            chroma_samples=tables["chroma"],
            readings=tables["readings"],
            fps=a.fps or meta.get("fps") or 25.0,
            image_width=float(a.width or meta.get("width") or 1280),
            frames_read=tables["frames"] if tables["frames"] is not None or recordings is None else frames_of(recordings),
            raw=tables["raw"],
            images=files.read_frames(spark, a.images, None if many else config.match_id) if a.images else None,
            matches=cameras_of(recordings) if many and recordings is not None else None,
        )
        if a.images and not many and tables["detections"] is not None and tables["detections"].where(F.col("match_id") == config.match_id).isEmpty():
            raise ValueError(f"images are of the match {config.match_id!r}, which the detections don't have")
        print(execute(config, inputs, a.out).outputs)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
