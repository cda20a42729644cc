"""Projections to slices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.functions import pixels
from beamwright.operators import kernels
from beamwright.plans.grouped import SLICE, grouped_kernel, to_lists, to_matrix

METHODS = {"gridrec": kernels.grid_project, "fbp": kernels.back_project}


def reconstruct(
    frames: DataFrame, scans: DataFrame, method: str = "gridrec", cutoff: float = 0.25, order: float = 2,
    angle_chunk: int = 1024, ignore: DataFrame | None = None, before: list = (), used: DataFrame | None = None,
) -> DataFrame:
    """Slices ``(scan_id, z, y, values)`` from corrected projections.

    ``scans(scan_id, theta, cor, pxsize_cm, npad)``, one row per scan.  The
    reconstruction is a sum over projections, so each task takes up to
    ``angle_chunk`` projections of one detector row and yields a partial slice;
    partial slices are then added.  A scan of any length is thus spread out.
    ``before`` lists sinogram functions to run in the same task first; they
    need all angles, so with them a group is the whole sinogram.
    ``used(scan_id, projections)`` gives the number of projections that share
    the half turn; without it they are counted, which runs whatever made
    ``frames`` a second time.
    """
    from beamwright.operators.frames import ignore_projections

    solve = METHODS[method]
    if ignore is not None:
        frames = ignore_projections(frames, ignore)
    # each of the scan's projections that take part weighs the same; a selection changes their number
    used = projections_of(frames) if used is None else used
    geo = scans.select("scan_id", "theta", "cor", "npad").join(used.withColumnRenamed("projections", "_used"), "scan_id")
    rows = (
        frames.select("scan_id", "idx", "row", "values").join(geo, "scan_id")
        .withColumn("angle", F.get("theta", F.col("idx")))
        .withColumn("weight", F.lit(float(np.pi)) / F.col("_used"))
        .withColumn("chunk", F.lit(0) if before else F.floor(F.col("idx") / angle_chunk).cast("int"))
        .drop("theta", "_used")
    )
    schema = "scan_id string, z int, chunk int, y int, values array<double>"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        rays, pad, cor = to_matrix(table), table.column("npad")[0].as_py(), table.column("cor")[0].as_py()
        for step in before:
            rays = step(rays)
        size = rays.shape[1]
        rays = np.pad(rays, ((0, 0), (pad, pad)), mode="edge")
        img = solve(rays, table.column("angle").to_numpy(), table.column("weight").to_numpy(), size, cor + pad, cutoff, order)
        first = {c: table.column(c)[0].as_py() for c in ("scan_id", "row", "chunk")}
        return pa.table({
            "scan_id": pa.array([first["scan_id"]] * size), "z": pa.array([first["row"]] * size, pa.int32()),
            "chunk": pa.array([first["chunk"]] * size, pa.int32()), "y": pa.array(np.arange(size), pa.int32()),
            "values": to_lists(img),
        })

    partial = rows.groupBy("scan_id", "row", "chunk").applyInArrow(run, schema)
    whole = partial.drop("chunk") if before else add_parts(partial, ["scan_id", "z", "y"], "chunk")
    return finish_slices(whole, scans)


def projections_of(frames: DataFrame) -> DataFrame:
    """How many projections each scan has, from ``frames(scan_id, idx)``."""
    return frames.groupBy("scan_id").agg(F.countDistinct("idx").alias("projections"))


def add_parts(parts: DataFrame, keys: list, part: str) -> DataFrame:
    """Element-wise sum of the few partial rows per key, in a fixed order."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(part, "values"))), lambda e: e["values"])
    total = F.aggregate(F.slice(ordered, F.lit(2), F.size(ordered)), F.get(ordered, 0), pixels.add)
    return parts.groupBy(*keys).agg(total.alias("values"))


def finish_slices(slices: DataFrame, scans: DataFrame) -> DataFrame:
    """Per-pixel to per-cm values, zero outside the inscribed circle."""
    half = F.size("values") / 2
    dy = F.col("y") - half

    def body(v, x):
        inside = (x - half) * (x - half) + dy * dy < half * half
        return F.when(inside, v / F.col("pxsize_cm")).otherwise(F.lit(0.0))

    out = slices.join(scans.select("scan_id", "pxsize_cm"), "scan_id")
    return out.select("scan_id", "z", "y", F.transform("values", body).alias("values"))


def polar_ring(
    slices: DataFrame, arc: float = 30, width: int = 100, high: float = 3000, limit: float = 3000, low: float = -3000
) -> DataFrame:
    """Ring removal on slices; call it again with other numbers for a second pass."""
    return grouped_kernel(slices, SLICE, lambda a, _: kernels.polar_smooth(a, arc, width, high, limit, low)).select(
        "scan_id", "z", "y", "values")
