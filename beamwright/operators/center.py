"""Finding the centre of rotation of every scan at once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.functions import pixels
from beamwright.operators import kernels
from beamwright.operators.frames import attach_references, opposing_pair, reduce_reference
from beamwright.plans.grouped import to_matrix

METHODS = ("pc", "vo", "nm", "skip")


def center_skip(scans: DataFrame) -> DataFrame:
    return scans.select("scan_id", (F.col("numrays") / 2).alias("center"))


def center_phase_corr(frames: DataFrame, scans: DataFrame, tol: float = 0.25, normalized: bool = False) -> DataFrame:
    """Sub-pixel registration of the first projection with the mirrored opposing one.

    Raw frames are normalised first, with their own flats and darks.  Only two
    projections per scan leave the scan; a group is those two frames.
    """
    upsample = int(round(1 / tol))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("idx", "ascending"), ("row", "ascending")])
        block, idx = to_matrix(table), table.column("idx").to_numpy()
        a, b = block[idx == idx.min()], block[idx == idx.max()][:, ::-1]
        center = (block.shape[1] + kernels.register(a, b, upsample) - 1) / 2
        return pa.table({"scan_id": table.column("scan_id").slice(0, 1), "center": pa.array([center])})

    pair = opposing_pair(frames, scans).select("scan_id", "idx", "row", "values")
    if not normalized:
        held = attach_references(pair, reduce_reference(frames, "flat"), reduce_reference(frames, "dark"))
        pair = held.withColumn("values", pixels.normalize(F.col("values"), F.col("dark"), F.col("flat")))
    rows = pair.select("scan_id", "idx", "row", "values")
    return rows.groupBy("scan_id").applyInArrow(run, "scan_id string, center double")


def _scored(sinos: DataFrame, candidates: Column, score, batch: int, extra: list) -> DataFrame:
    """Score candidate centres of each scan's one sinogram in parallel batches; ``score`` gives None if it cannot tell."""
    many = sinos.withColumn("_c", candidates)
    batches = F.sequence(F.lit(0), F.floor((F.size("_c") - 1) / batch).cast("int"))
    spread = many.withColumn("batch", F.explode(batches)).withColumn("_c", F.slice("_c", F.col("batch") * batch + 1, F.lit(batch)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        centers = np.array(table.column("_c")[0].as_py(), "f8")
        info = {c: table.column(c).to_numpy() for c in extra}
        scores = score(to_matrix(table), centers, info)
        return pa.table({
            "scan_id": pa.array([table.column("scan_id")[0].as_py()] * len(centers)),
            "center": pa.array(centers), "score": pa.nulls(len(centers), pa.float64()) if scores is None else pa.array(np.asarray(scores, "f8")),
        })

    cols = ["scan_id", "batch", "idx", "values", "_c", *extra]
    return spread.select(*cols).groupBy("scan_id", "batch").applyInArrow(run, "scan_id string, center double, score double")


def _best(scores: DataFrame) -> DataFrame:
    """The centre of least score per scan; null for a scan without scores."""
    rank = F.when(F.col("score").isNotNull(), F.struct("score", "center"))
    return scores.groupBy("scan_id").agg(F.min_by("center", rank).alias("center"))


def _steps(middle: Column, reach: Column, step: float) -> Column:
    n = F.floor(reach / step).cast("int")
    return F.transform(F.sequence(-n, n), lambda i: middle + i * F.lit(float(step)))


def center_vo(
    frames: DataFrame, row: int = 0, reach: float = 150, radius: float = 6, step: float = 0.25, ratio: float = 0.5,
    drop: int = 20, batch: int = 16,
) -> DataFrame:
    """Coarse then fine search on one detector row's sinogram per scan.

    A scan with too few projections (``drop`` or fewer beside the first) comes out with a null centre; all others get theirs.
    """
    sino = frames.filter(F.col("row") == row).select("scan_id", "idx", "values")
    middle = (F.size("values") - 1) / 2
    # a centre further out than the detector's edge leaves no overlap to score
    fits = F.lit(float(reach)) <= middle
    limit = F.when(fits, F.lit(float(reach))).otherwise(F.raise_error(F.lit("reach is wider than half the detector")).cast("double"))

    def score(a, centers, _):
        return kernels.mirror_scores(a, centers, ratio, drop)

    coarse = _best(_scored(sino, _steps(middle, limit, 1.0), score, batch, []))
    near = sino.join(coarse.withColumnRenamed("center", "_mid"), "scan_id")
    return _best(_scored(near, _steps(F.col("_mid"), F.lit(float(radius)), step), score, batch, []))


def center_entropy(
    frames: DataFrame, scans: DataFrame, row: int = 0, reach: float = 16, tol: float = 0.5, masked: bool = True,
    ratio: float = 1.0, batch: int = 4,
) -> DataFrame:
    """Centre whose reconstructed slice has least entropy, coarse to fine.

    ``scans(scan_id, theta, init)``; a null ``init`` starts at the middle.
    """
    geo = scans.select("scan_id", "theta", "init")
    sino = (
        frames.filter(F.col("row") == row).select("scan_id", "idx", "values").join(geo, "scan_id")
        .withColumn("angle", F.get("theta", F.col("idx"))).drop("theta")
        .withColumn("values", F.col("values").cast("array<double>"))
        .withColumn("init", F.coalesce("init", (F.size("values") - 1) / 2))
    )

    def score(a, centers, info):
        w = np.full(len(a), np.pi / len(a))
        size = a.shape[1]


        def image(c):
            return kernels.back_project(a, info["angle"], w, size, c, 0.25, 2)

        # one histogram range for all candidates of a scan: that of its first guess, widened
        first = image(info["init"][0])
        span = first.max() - first.min() or 1.0
        low, high = first.min() - span / 2, first.max() + span / 2
        return [kernels.entropy(image(c), low, high, ratio, masked) for c in centers]

    extra = ["angle", "init"]
    coarse = _best(_scored(sino, _steps(F.col("init"), F.lit(float(reach)), 4 * tol), score, batch, extra))
    near = sino.join(coarse.withColumnRenamed("center", "_mid"), "scan_id")
    return _best(_scored(near, _steps(F.col("_mid"), F.lit(4.0 * tol), tol), score, batch, extra))


def find_center(method: str, frames: DataFrame, scans: DataFrame, **options) -> DataFrame:
    """Centre per scan by method name."""
    if method not in METHODS:
        raise ValueError(f"centre method must be one of {METHODS}, not {method!r}")
    if method == "skip":
        return center_skip(scans)
    if method == "pc":
        return center_phase_corr(frames, scans, **options)
    if method == "vo":
        return center_vo(frames, **options)
    return center_entropy(frames, scans, **options)
