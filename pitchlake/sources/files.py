"""Files that runs read and write."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import nan_to_null
from ..operators.detect import stride

TAGGING = "period int, clock_mmss string, team string, shirt int, type_name string, start_x double, start_y double, end_x double, end_y double, result_name string, bodypart_name string, note string"
SHOTS = "start_x double, start_y double, is_goal int"
EXAMPLES = [
    (1, "03:25", "home", 9, "shot", 92.0, 31.5, 105.0, 34.0, "fail", "foot_right", "saved low"),
    (1, "07:10", "away", 4, "pass", 40.0, 20.0, 55.5, 28.0, "success", "foot_left", ""),
]


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share, below the session's checkpoint
    folder; a local session without one takes its warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base or spark.conf.get('spark.sql.warehouse.dir')}/files-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, csv: bool = False) -> str:
    """Write df as parquet, replacing what is there; with csv, also beside it in one file."""
    df.write.mode("overwrite").parquet(path)
    if csv:
        df.coalesce(1).write.mode("overwrite").csv(path.removesuffix(".parquet") + ".csv", header=True)
    return path


def write_matches(df: DataFrame, path: str) -> None:
    """Write df in a folder for each match, which later reads of single matches prune to."""
    df.repartition("match_id").write.mode("overwrite").partitionBy("match_id").parquet(path)


def read_shots(spark: SparkSession, path: str) -> DataFrame:
    """Shots from parquet, or from CSV with a header if the path ends otherwise."""
    if path.endswith(".parquet"):
        return nan_to_null(spark.read.parquet(path))
    names = spark.read.csv(path, header=True).columns
    types = dict(x.split() for x in SHOTS.split(", "))
    return nan_to_null(spark.read.csv(path, header=True).select(*(F.col(c).cast(types.get(c, "string")).alias(c) for c in names)))


def tagging_template(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXAMPLES, TAGGING)


def write_tagging_template(spark: SparkSession, path: str) -> None:
    tagging_template(spark).coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TAGGING).csv(path, header=True)


def read_instances_xml(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Tagged actions of an XML file of <instance> elements with start (seconds) and code:
    t_s and type_name, codes by `types` or as they are in lower case."""
    rows = spark.read.format("xml").option("rowTag", "instance").schema("start double, code string").load(path)
    rows, code = rows.withColumn("code", F.lower(F.regexp_replace("code", r"\s+", "_"))), F.col("code")
    if types:
        known = F.create_map(*(F.lit(x) for pair in types.items() for x in pair))
        code = F.coalesce(F.try_element_at(known, F.col("code")), code)
    return rows.select(F.col("start").alias("t_s"), code.alias("type_name"))


def read_clock_csv(spark: SparkSession, path: str, clock: str = "clock", action: str = "action") -> DataFrame:
    """Tagged actions of a CSV file with a clock column (h:mm:ss or mm:ss): t_s, type_name."""
    rows = spark.read.csv(path, header=True)
    parts = F.split(F.col(clock), ":")
    t_s = F.aggregate(parts, F.lit(0.0), lambda total, p: total * 60 + p.cast("double"))
    return rows.select(t_s.alias("t_s"), F.lower(F.col(action)).alias("type_name"))


def read_homography(path: str | Path) -> dict | None:
    """A saved homography and its error (homography, error_m; null before it is solved), or
    None if the file is missing or empty."""
    file = Path(path)
    text = file.read_text().strip() if file.exists() else ""
    saved = json.loads(text) if text else None
    return saved and {"homography": saved.get("solved_homography", saved.get("homography")), "error_m": saved.get("max_reprojection_error_m", saved.get("error_m"))}


def write_homography(path: str | Path, homography, error: float, pairs=()) -> None:
    """Save a homography, its error and the landmark pairs that it was solved from."""
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    # The keys of a points file.
    points = {"image_points": [list(p) for p, _ in pairs], "pitch_points": [list(m) for _, m in pairs]}
    file.write_text(json.dumps({**points, "solved_homography": [list(map(float, row)) for row in homography], "max_reprojection_error_m": error}, indent=2))


def read_points(path: str | Path) -> list[tuple[tuple[float, float], tuple[float, float]]]:
    """Landmark pairs of a JSON file {"points": [{"name" or "metres", "pixels"}]}, or of one
    with image_points and pitch_points of the same length."""
    from ..functions.geometry import LANDMARKS

    file = json.loads(Path(path).read_text())
    if "image_points" in file:
        return [(tuple(p), tuple(m)) for p, m in zip(file["image_points"], file["pitch_points"], strict=True)]
    points = file["points"]
    return [(tuple(p["pixels"]), tuple(p["metres"]) if "metres" in p else LANDMARKS[p["name"]]) for p in points]


def landmarks(spark: SparkSession) -> DataFrame:
    from ..functions.geometry import LANDMARKS

    return spark.createDataFrame([(n, *xy) for n, xy in LANDMARKS.items()], "name string, x_m double, y_m double")


def video_meta(match_id: str, fps: float, width: int, height: int, n_frames: int) -> dict:
    """What a run knows of its recording; duration is 0 where the rate is unknown."""
    return {"match_id": match_id, "fps": fps, "width": width, "height": height, "n_frames": n_frames, "duration_s": n_frames / fps if fps else 0.0}


def probe_frames(spark: SparkSession, path: str, fps: float = 0.0, match_id: str = "match") -> dict:
    """video_meta of a folder of images: size of the first, number of frames. A missing
    folder, or one without images, is a FileNotFoundError."""
    numbers = frame_numbers(spark, path)
    n, first = numbers.agg(F.count(F.lit(1)), F.min("frame")).first()
    if not n:
        raise FileNotFoundError(path)
    image = read_frames(spark, path, match_id).where(F.col("frame") == first).select("width", "height").first()
    if image is None:
        raise FileNotFoundError(path)
    return video_meta(match_id, fps, image.width, image.height, n)


def _named(match_id: str | None) -> dict[str, Column]:
    """match_id and frame of an image, as its file's path tells."""
    folder = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    folder = F.regexp_replace(folder, "^match_id=", "")
    number = F.regexp_extract("_metadata.file_name", r"(\d+)\.\w+$", 1)
    return {"match_id": folder if match_id is None else F.lit(match_id), "frame": F.nullif(number, F.lit("")).cast("long")}


def _images(spark: SparkSession, kind: str, path: str, match_id: str | None) -> DataFrame:
    reader = spark.read.format(kind).option("recursiveFileLookup", match_id is None)
    if kind == "image":
        reader = reader.option("dropInvalid", True)
    try:
        return reader.load(path)
    except AnalysisException as e:
        raise FileNotFoundError(path) from e


def frame_numbers(spark: SparkSession, path: str, match_id: str | None = "match") -> DataFrame:
    """(match_id, frame) of the images below a path, by their names; no image is opened."""
    files = _images(spark, "binaryFile", path, match_id).select("path")
    return files.select(*(c.alias(n) for n, c in _named(match_id).items())).where("frame is not null")


def read_frames(spark: SparkSession, path: str, match_id: str | None = "match", step: int = 1, most: int | None = None, start: int = 0) -> DataFrame:
    """Images of a folder as frames of a match: match_id, frame, height, width, nChannels,
    data (BGR bytes). frame is the number that ends the file's name; other files are left
    out. Without a match_id, path has a folder for each match, whose name is its id. A missing
    folder is a FileNotFoundError.

    Frames are those of operators.detect.stride: each step-th from start, and of these the
    first `most` of each match. These conditions, and all that a query asks of match_id and
    frame, are conditions on files' names, by which Spark drops files before it opens them.
    """
    files = _images(spark, "image", path, match_id)
    named = _named(match_id)
    frames = files.select(*(c.alias(n) for n, c in named.items()), "image.height", "image.width", "image.nChannels", "image.data")
    frames = frames.where((F.col("frame") >= start) & ((F.col("frame") - start) % max(1, step) == 0))
    if not most:
        return frames
    last = stride(frame_numbers(spark, path, match_id), step, most, start).groupBy("match_id").agg(F.max("frame").alias("last")).collect()  # a row a match
    return frames.where(_up_to({r.match_id: r.last for r in last}))


def _up_to(last: dict[str, int]) -> Column:
    """Whether a frame is not after the last one of its match; matches are told by the same
    condition where all have the same last frame."""
    low = min(last.values(), default=-1)
    wanted = F.col("frame") <= low
    for frame in sorted({v for v in last.values() if v > low}):
        wanted |= F.col("match_id").isin([m for m, v in last.items() if v == frame]) & (F.col("frame") <= frame)
    return wanted


def frames_up_to(frames: DataFrame, wanted: DataFrame, step: int = 1) -> DataFrame:
    """Those of frames of each match that are a multiple of step and not after its last one in
    wanted (match_id, frame), for readers that need only some: what follows is not opened."""
    last = wanted.groupBy("match_id").agg(F.max("frame").alias("last")).collect()  # a row a match
    return frames.where((F.col("frame") % max(1, step) == 0) & _up_to({r.match_id: r.last for r in last}))
