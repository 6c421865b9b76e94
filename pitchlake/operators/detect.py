"""Detections: the adapter to models, and what is done to their raw output."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONF_THRESHOLD, BATCH = 0.35, 8
#: Levels of each colour in a histogram; change of histograms above which a frame is a cut.
LEVELS, CUT_CHANGE = 8, 0.55
RAW = "match_id string, frame long, rank long, label string, score double, x1 double, y1 double, x2 double, y2 double"

Model = Callable[[pd.DataFrame], pd.DataFrame]


def backend(name: str, weights: str | None = None, load: Callable[[], Model] | None = None) -> Callable[[], Model]:
    """What makes a model on each worker. Models are not part of this library: load is
    given by its user, and these errors tell why a backend can't be had."""
    if name == "ultralytics_yolo":
        raise RuntimeError("ultralytics_yolo has a licence that this library can't be used with; run it apart and read its detections")
    if name == "rfdetr":
        if not weights or not Path(weights).exists():
            raise FileNotFoundError(f"rfdetr needs a weights file: {weights!r}")
        raise NotImplementedError("rfdetr has no adapter yet")
    if name != "rtdetr_coco":
        raise ValueError(f"unknown detector backend: {name!r}")
    if load is None:
        raise RuntimeError("rtdetr_coco needs a loader that makes the model on a worker")
    return load


def infer(frames: DataFrame, load: Callable[[], Model], batch: int = BATCH) -> DataFrame:
    """Raw detections of frames (match_id, frame, height, width, nChannels, data): the model
    is loaded once for each task and gets batch frames at a time."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for part in parts:
            for i in range(0, len(part), batch):
                yield model(part.iloc[i : i + batch])

    return frames.mapInPandas(run, RAW)


def postprocess(raw: DataFrame, class_map: dict[str, str], conf_threshold: float = CONF_THRESHOLD) -> DataFrame:
    """Detections of raw model output (rank is the model's order within a frame): those of
    conf_threshold or more whose label the class_map knows, numbered from 0 in each frame."""
    spark = raw.sparkSession
    classes = spark.createDataFrame(list(class_map.items()), "label string, cls string")
    kept = raw.where(F.col("score") >= conf_threshold).join(F.broadcast(classes), "label")  # a few labels
    place = F.row_number().over(Window.partitionBy("match_id", "frame").orderBy("rank")).cast("long") - 1
    return kept.select("match_id", "frame", place.alias("det_id"), "cls", F.col("score").alias("conf"), "x1", "y1", "x2", "y2")


def class_counts(detections: DataFrame) -> DataFrame:
    return detections.groupBy("match_id", "cls").agg(F.count(F.lit(1)).alias("n"))


def stride(frames: DataFrame, step: int = 1, most: int | None = None, start: int = 0) -> DataFrame:
    """Every step-th frame from start; of these the first `most` of each match (0 or none: all)."""
    kept = frames.where((F.col("frame") >= start) & ((F.col("frame") - start) % max(1, step) == 0))
    if not most:
        return kept
    place = F.dense_rank().over(Window.partitionBy("match_id").orderBy("frame"))
    return kept.withColumn("__place", place).where(F.col("__place") <= most).drop("__place")


def frame_histograms(frames: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(match_id, frame, histogram) of frames (height, width, nChannels, data: BGR bytes): the
    shares of an image's pixels in each of levels ** 3 cells of its three colours; of one
    channel, the grey ones. Images without pixels have no histogram. Images are read in
    Arrow batches, and only histograms go on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for channels, data in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                pixels = np.frombuffer(data.as_buffer() if data.is_valid else b"", dtype=np.uint8)
                if not channels or not len(pixels):
                    rows.append(None)
                    continue
                pixels = pixels.reshape(-1, channels)
                cell = np.zeros(len(pixels), dtype=np.int64)
                for c in (0, 1, 2) if channels >= 3 else (0, 0, 0):
                    cell = cell * levels + pixels[:, c].astype(np.int64) * levels // 256
                rows.append(np.bincount(cell, minlength=levels**3) / len(pixels))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["match_id", "frame", "histogram"])

    images = frames.select("match_id", F.col("frame").cast("long").alias("frame"), "nChannels", "data")
    return images.mapInArrow(count, "match_id string, frame long, histogram array<double>")


def shot_boundaries(histograms: DataFrame, threshold: float = CUT_CHANGE) -> DataFrame:
    """Frames (match_id, frame, histogram of shares) that overlap the one before by less
    than 1 - threshold: hard cuts. A frame without a histogram is no cut, and none follows it."""
    order = Window.partitionBy("match_id").orderBy("frame")
    both = F.zip_with("histogram", F.lag("histogram").over(order), lambda a, b: F.least(a, b))
    change = 1 - F.aggregate(both, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return histograms.withColumn("change", F.when(F.lag("frame").over(order).isNotNull(), change)).where(F.col("change") > threshold).select("match_id", "frame", "change")


def image_cuts(frames: DataFrame, threshold: float = CUT_CHANGE, levels: int = LEVELS) -> DataFrame:
    """The hard cuts of frames with pixels: match_id, frame, change (see shot_boundaries)."""
    return shot_boundaries(frame_histograms(frames, levels), threshold)


def scenes(grid: DataFrame, cuts: DataFrame) -> DataFrame:
    """grid (match_id, pos, frame) with scene: how many cuts lie at the frame or before it."""
    order = Window.partitionBy("match_id").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    marked = grid.join(cuts.select("match_id", "frame", F.lit(1).alias("__cut")).distinct(), ["match_id", "frame"], "left")
    return marked.withColumn("scene", F.coalesce(F.sum("__cut").over(order), F.lit(0).cast("long"))).select("match_id", "pos", "frame", "scene")
