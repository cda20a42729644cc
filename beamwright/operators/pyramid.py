"""Multi-resolution levels of reconstructed slices."""

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.operators.recon import add_parts
from beamwright.plans.grouped import SLICE, grouped_kernel
from beamwright.session import materialise


def kernel(sigma: float = math.sqrt(3 / (8 * math.log(2))), radius: int = 2) -> list:
    """Gaussian weights for one halving step."""
    w = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def _targets(i: Column, n: Column, weights: list) -> Column:
    """Outputs that source line ``i`` of ``n`` feeds, with weights; edge lines stand in
    for the lines beyond them."""
    r = len(weights) // 2
    outs = F.floor((n - 1) / 2).cast("int")
    candidates = F.sequence(F.floor((i - r) / 2).cast("int"), F.ceil((i + r) / 2).cast("int"))

    def weight(m):
        total = F.lit(0.0)
        for k in range(-r, r + 1):
            hit = F.greatest(F.lit(0), F.least(n - 1, m * 2 + k)) == i
            total = total + F.when(hit, F.lit(weights[k + r])).otherwise(F.lit(0.0))
        return total

    pairs = F.transform(candidates, lambda m: F.struct(m.alias("m"), weight(m).alias("w")))
    return F.filter(pairs, lambda p: (p["m"] >= 0) & (p["m"] <= outs) & (p["w"] > 0))


def halve_image(img: np.ndarray, weights: list) -> np.ndarray:
    r, (h, w) = len(weights) // 2, img.shape
    p = np.pad(img, r, mode="edge")
    rows = sum(k * p[i:i + h:2] for i, k in enumerate(weights))
    return sum(k * rows[:, i:i + w:2] for i, k in enumerate(weights))


def halve_once(slices: DataFrame, shapes: DataFrame, weights: list | None = None) -> DataFrame:
    """One level: smooth and keep every second pixel along x, y and z.

    x and y stay inside the slice.  Its rows, by then a quarter of the data,
    go to the two or three levels of z they feed, where at most five are added.
    """
    weights = weights or kernel()
    flat = grouped_kernel(slices, SLICE, lambda a, _: halve_image(a, weights), same_rows=False)
    sent = (
        flat.join(shapes.select("scan_id", "nz"), "scan_id")
        .withColumn("_z", F.explode(_targets(F.col("z"), F.col("nz"), weights)))
        .select("scan_id", F.col("_z.m").alias("z2"), "y", "z", F.transform("values", lambda v: v * F.col("_z.w")).alias("values"))
    )
    return add_parts(sent, ["scan_id", "z2", "y"], "z").select("scan_id", F.col("z2").alias("z"), "y", "values")


def shapes_of(slices: DataFrame) -> DataFrame:
    """Sizes counted from the data, for when the geometry is not known."""
    return slices.groupBy("scan_id").agg(
        (F.max("z") + 1).alias("nz"), (F.max("y") + 1).alias("ny"), F.max(F.size("values")).alias("nx"))


def size_at(n: Column, level: int) -> Column:
    return F.ceil(n / 2**level).cast("int")


def level_count(min_size: int) -> Column:
    """Halvings until the smallest side is at most ``min_size``."""
    if min_size < 1:
        raise ValueError("min_size must be at least 1")
    smallest = F.least("nz", "ny", "nx").cast("long")
    # ceil(n / 2**k) <= m exactly when n <= m * 2**k, and 62 halvings bring any size to 1
    enough = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: smallest <= F.lit(min_size).cast("double") * F.pow(F.lit(2.0), k))
    return F.get(enough, 0)


def multires_pyramid(slices: DataFrame, scans: DataFrame, min_size: int = 64) -> tuple[DataFrame, DataFrame]:
    """Levels and their scales.

    ``scans(scan_id, pxsize_um, nz, ny, nx)``, one row per scan.  A scan stops
    halving once its smallest side is at most ``min_size``.  Each level is
    written before the next one reads it, so a lost executor costs one level
    at most; the driver only learns the number of levels.
    """
    shapes = scans.select("scan_id", "pxsize_um", "nz", "ny", "nx").withColumn("_levels", level_count(min_size))
    deepest = shapes.agg(F.max("_levels")).first()[0] or 0
    level = slices.select("scan_id", "z", "y", F.col("values").cast("array<double>").alias("values"))
    levels = level.withColumn("level", F.lit(0))
    for number in range(1, deepest + 1):
        left = shapes.filter(F.col("_levels") >= number).select(
            "scan_id", *[size_at(F.col(c), number - 1).alias(c) for c in ("nz", "ny", "nx")])
        level = materialise(halve_once(level, left), f"pyramid-{number}")
        levels = levels.unionByName(level.withColumn("level", F.lit(number)))
    steps = shapes.withColumn("level", F.explode(F.sequence(F.lit(0), "_levels")))
    scales = steps.select(
        "scan_id", "level", F.explode(F.array(*map(F.lit, ("x", "y", "z")))).alias("axis"),
        (F.col("pxsize_um") * F.pow(F.lit(2.0), F.col("level"))).alias("scale_um"))
    return levels, scales
