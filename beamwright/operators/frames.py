"""The frame model: selection, references, geometry, ordering."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.functions import pixels, values
from beamwright.operators import segments, selection
from beamwright.plans.grouped import from_ray_blocks, grouped_reduce, in_ray_blocks


# --------------------------------------------------------------------- angles
def angle_list(n: Column, theta: Column, start: Column, step: Column, span: Column, offset: float = 0.0) -> Column:
    """Projection angles in radians: stored, else start and step, else evenly spaced."""
    i_seq = F.sequence(F.lit(0), n - 1)
    stepped = F.transform(i_seq, lambda i: start + step * i)
    even = F.transform(i_seq, lambda i: (span + offset) * i / F.greatest(n - 1, F.lit(1)) - F.lit(float(offset)))
    chosen = F.coalesce(theta, F.when(start.isNotNull() & step.isNotNull(), stepped), even)
    return F.transform(chosen, lambda a: -F.radians(a - F.lit(float(offset))))


def stacked_angle_list(n: Column, first: Column, span: Column, rotations: Column | None = None, offset: float = 0.0) -> Column:
    """Stacked layout: from 270° + offset − first angle downwards, or per-frame rotations."""
    base = F.lit(270.0 + offset)
    if rotations is not None:
        return F.transform(rotations, lambda r: F.radians(base - r))
    last = F.greatest(n - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.radians(base - first - span * i / last))


def timed_angle_list(n: Column, theta: Column, aborted: Column) -> Column:
    """Time-resolved layout: stored angles, those of an aborted scan, else 0..180°."""
    last = F.greatest(n - 1, F.lit(1))
    even = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lit(180.0) * i / last)
    return F.transform(F.coalesce(theta, aborted, even), F.radians)


def angle_table(scans: DataFrame) -> DataFrame:
    """``(scan_id, idx, theta_rad)`` from scans that hold a ``theta`` array."""
    return scans.select("scan_id", F.posexplode("theta").alias("idx", "theta_rad"))


# ------------------------------------------------------------------ selection
def clamp_selection(scans: DataFrame) -> DataFrame:
    """Effective projection and row ranges.

    ``scans(scan_id, numangles, numslices, theta, p_start, p_stop, p_step,
    r_start, r_stop, r_step)``; null starts select everything and a negative
    row start asks for ``r_stop`` rows around the middle.
    """
    given = F.col("p_start").isNotNull()
    n, rows = F.col("numangles"), F.col("numslices")
    start = F.when(given, F.greatest("p_start", F.lit(0))).otherwise(0)
    stop = F.when(given, F.least("p_stop", n)).otherwise(n)
    step = F.when(given, F.col("p_step")).otherwise(1)
    mid = values.central_rows(rows, F.col("r_stop"))
    whole, centre = F.col("r_start").isNull(), F.col("r_start") < 0
    out = scans.select(
        "*", start.alias("sel_start"), stop.alias("sel_stop"), step.alias("sel_step"),
        F.when(whole, 0).when(centre, mid["start"]).otherwise(F.col("r_start")).alias("row_start"),
        F.when(whole, rows).when(centre, mid["stop"]).otherwise(F.col("r_stop")).alias("row_stop"),
        F.when(whole | centre, 1).otherwise(F.col("r_step")).alias("row_step"),
    )
    count = F.greatest(F.ceil((F.col("sel_stop") - F.col("sel_start")) / F.col("sel_step")), F.lit(0)).cast("int")
    out = out.withColumn("sel_count", count)
    last = F.col("sel_start") + (F.col("sel_count") - 1) * F.col("sel_step")
    span = F.abs(F.get("theta", last) - F.get("theta", F.col("sel_start")))
    return out.withColumn("sel_range", span)


def select_frames(frames: DataFrame, selection: DataFrame) -> DataFrame:
    """Frames inside each scan's selection; flats and darks keep all projections."""
    s = selection.select("scan_id", "sel_start", "sel_stop", "sel_step", "row_start", "row_stop", "row_step")
    rows = values.strided(F.col("row"), F.col("row_start"), F.col("row_stop"), F.col("row_step"))
    proj = values.strided(F.col("idx"), F.col("sel_start"), F.col("sel_stop"), F.col("sel_step"))
    return frames.join(s, "scan_id").filter(rows & ((F.col("kind") != "tomo") | proj)).select(*frames.columns)


def frame_counts(frames: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """Numbers of projections, flats and darks: declared where known, else counted."""
    kinds = {"ntomo": "tomo", "nflat": "flat", "ndark": "dark"}
    each = frames.select("scan_id", "kind", "idx").distinct()
    counted = each.groupBy("scan_id").agg(
        *[F.count_if(F.col("kind") == k).cast("int").alias(c) for c, k in kinds.items()]
    )
    if declared is None:
        return counted
    stated = declared.select("scan_id", F.col("nflat").alias("_f"), F.col("ndark").alias("_d"))
    return counted.join(stated, "scan_id", "left").select(
        "scan_id", "ntomo", F.coalesce("_f", "nflat").alias("nflat"), F.coalesce("_d", "ndark").alias("ndark")
    )


def opposing_pair(frames: DataFrame, scans: DataFrame) -> DataFrame:
    """The first projection and the one about 180° away, by each scan's geometry."""
    last = F.when(F.col("angularrange") > 300, F.floor(F.col("numangles") / 2) - 1).otherwise(F.col("numangles") - 1)
    ends = scans.select("scan_id", last.cast("int").alias("_last"))
    tomo = frames.filter(F.col("kind") == "tomo").join(ends, "scan_id")
    return tomo.filter((F.col("idx") == 0) | (F.col("idx") == F.col("_last"))).drop("_last")


# ----------------------------------------------------------------- references
def reduce_reference(frames: DataFrame, kind: str, how: str = "mean", by: list = ("scan_id", "row"), ray_block: int = 512) -> DataFrame:
    """One reference row per (scan, row): mean or median of its frames, ray by ray.

    Rays are independent, so each task averages a block of them; medians are found by narrowing histograms,
    whatever the number of frames.
    """
    rows = frames.filter(F.col("kind") == kind).select(*by, "values")
    if how == "median":
        return selection.ray_quantiles(rows, list(by))
    if how != "mean":
        raise ValueError(f"how is 'mean' or 'median', not {how!r}")
    parts = grouped_reduce(in_ray_blocks(rows, ray_block), [*by, "block"], lambda a: np.mean(a, axis=0))
    return from_ray_blocks(parts, list(by))


def attach_references(tomo: DataFrame, flat: DataFrame, dark: DataFrame, bright_scans: DataFrame | None = None) -> DataFrame:
    """Projections with their flat and dark rows.

    ``bright_scans(scan_id, bright_scan_id)`` takes the flats from another scan.
    Rows without both references are left out; ``reference_issues`` names their scans.
    The references are hashed per partition: the projections are shuffled by
    (scan, row), which the sinogram stages need too, but not sorted for the join.
    """
    f = flat.withColumnRenamed("values", "flat")
    d = dark.withColumnRenamed("values", "dark")
    if bright_scans is not None:
        f = f.withColumnRenamed("scan_id", "bright_scan_id").join(bright_scans, "bright_scan_id").drop("bright_scan_id")
    both = f.join(d, ["scan_id", "row"]).hint("shuffle_hash")
    return tomo.join(both, ["scan_id", "row"])


def issue(severity: str, msg) -> list:
    """The columns of an issue row after its scan."""
    return [F.lit(severity).alias("severity"), msg.alias("msg"), F.lit(None).cast("string").alias("exception")]


def reference_issues(tomo: DataFrame, flat: DataFrame, dark: DataFrame) -> DataFrame:
    """An error issue for every scan with projections whose detector row has no flat or no dark."""
    both = flat.select("scan_id", "row").join(dark.select("scan_id", "row"), ["scan_id", "row"])
    bare = tomo.select("scan_id", "idx", "row").join(both, ["scan_id", "row"], "left_anti").groupBy("scan_id").agg(F.count(F.lit(1)).alias("n"))
    return bare.select("scan_id", *issue("error", F.concat("n", F.lit(" detector rows without flat or dark"))))


def geometry_issues(tomo: DataFrame, scans: DataFrame) -> DataFrame:
    """An error issue for every scan with projections that has no geometry row, or no centre in it."""
    centre = F.col("cor") if "cor" in scans.columns else F.lit(None)
    known = scans.select("scan_id", F.lit(True).alias("_known"), centre.isNotNull().alias("_centred"))
    found = tomo.select("scan_id").distinct().join(known, "scan_id", "left").filter("_known is null or not _centred")
    msg = F.when(F.col("_known").isNull(), "no geometry").otherwise("no centre of rotation")
    return found.select("scan_id", *issue("error", msg))


def group_bounds(locations: Column) -> Column:
    """First projection served by each flat group; midpoints round half to even."""
    def start(loc, i):
        before = F.get(locations, i - 1)
        return F.when(i == 0, F.lit(0)).otherwise(before + F.rint((loc - before) / 2).cast("int"))

    return F.transform(locations, start)


def nearest_group(idx: Column, locations: Column) -> Column:
    """Number of the flat group used for a projection."""
    return F.size(F.filter(group_bounds(locations), lambda b: b <= idx)) - 1


def attach_nearest(tomo: DataFrame, frames: DataFrame, scans: DataFrame) -> DataFrame:
    """Projections with the median flat of their group and the median dark.

    ``scans(scan_id, flat_locations)``; flats are shared out evenly, in order,
    over the groups.  The as-of match is arithmetic on the scan's own short
    list of locations, so the join itself is on equal keys.
    """
    loc = scans.select("scan_id", "flat_locations")
    flats = frames.filter(F.col("kind") == "flat")
    counts = flats.groupBy("scan_id").agg(F.countDistinct("idx").alias("_n")).join(loc, "scan_id")
    per = counts.select("scan_id", F.greatest(F.floor(F.col("_n") / F.size("flat_locations")), F.lit(1)).alias("_per"),
                        (F.size("flat_locations") - 1).alias("_top"))
    grouped = flats.join(per, "scan_id").withColumn(
        "grp", F.least(F.floor(F.col("idx") / F.col("_per")), F.col("_top")).cast("int"))
    flat = reduce_reference(grouped, "flat", "median", ["scan_id", "row", "grp"]).withColumnRenamed("values", "flat")
    dark = reduce_reference(frames, "dark", "median").withColumnRenamed("values", "dark")
    numbered = tomo.join(loc, "scan_id").withColumn("grp", nearest_group(F.col("idx"), F.col("flat_locations")))
    both = flat.join(dark, ["scan_id", "row"]).hint("shuffle_hash")
    return numbered.join(both, ["scan_id", "row", "grp"]).drop("flat_locations")


def ignore_projections(frames: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed ``(scan_id, idx)`` projections keep their rows but hold zeros."""
    marks = listed.select("scan_id", "idx").distinct().withColumn("_off", F.lit(True))
    off = F.coalesce("_off", F.lit(False))
    joined = frames.join(marks, ["scan_id", "idx"], "left")
    return joined.withColumn("values", pixels.apply(F.col("values"), pixels.zero_where(off))).drop("_off")


# ------------------------------------------------------------------- ordering
def build_sinograms(frames: DataFrame) -> DataFrame:
    """All projections of a detector row in angle order, as one row per sinogram."""
    ordered = F.sort_array(F.collect_list(F.struct("idx", "values")))
    return frames.groupBy("scan_id", "row").agg(ordered.alias("s")).select(
        "scan_id", "row", F.col("s.idx").alias("idx"), F.col("s.values").alias("sinogram")
    )


def numbered_positions(table: DataFrame, order: str = "idx", width: int = 4096) -> DataFrame:
    """0-based position of each projection inside its scan's selection."""
    out = segments.with_row_number(table, ["scan_id"], [order], segments.number_segment(F.col(order), width), "_p")
    return out.withColumn("position", (F.col("_p") - 1).cast("int")).drop("_p")


def drift_offset(table: DataFrame, dx: float, dy: float) -> DataFrame:
    """Drift of each projection, growing evenly from zero to the full shift."""
    counts = table.groupBy("scan_id").agg(F.count(F.lit(1)).alias("_n"))
    part = F.col("position") / F.greatest(F.col("_n") - 1, F.lit(1))
    out = numbered_positions(table).join(counts, "scan_id")
    return out.withColumn("off_x", part * F.lit(float(dx))).withColumn("off_y", part * F.lit(float(dy))).drop("_n")


def output_number(table: DataFrame, start: int, step: int) -> DataFrame:
    return numbered_positions(table).withColumn("number", F.col("position") * step + start)


def ordered_stack(files: DataFrame) -> DataFrame:
    """``files(scan_id, path)``: lexicographic path order gives z.

    All scans are cut together into even stretches by sampled splitters; a stretch numbers its own paths and
    starts where the scan's stretches before it end.
    """
    cut = segments.with_range_segment(files, ["scan_id"], ["path"])
    out = segments.with_row_number(cut, ["scan_id"], ["path"], F.col("_range"), "_p")
    return out.withColumn("z", (F.col("_p") - 1).cast("bigint")).drop("_p", "_range")


def with_chunk(table: DataFrame, size: int = 100) -> DataFrame:
    return table.withColumn("chunk", values.chunk_of(F.col("position"), size))


# ----------------------------------------------------------------- statistics
def frame_stats(frames: DataFrame, quantiles: tuple = (0.01, 0.5, 0.99), low: float | None = None, high: float | None = None,
                bins: int = 16) -> DataFrame:
    """Minimum, maximum, mean, quantiles and histogram of each whole frame.

    The histogram spans ``[low, high]``, by default the frame's own extremes.
    """
    types = dict(frames.select("scan_id", "idx").dtypes)
    schema = f"scan_id {types['scan_id']}, idx {types['idx']}, low double, high double, mean double, pixels bigint"
    schema += "".join(f", q{int(q * 100)} double" for q in quantiles) + ", histogram array<bigint>"

    def run(table: pa.Table) -> pa.Table:
        v = table.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("f8")
        span = (v.min() if low is None else low, v.max() if high is None else high)
        columns = {c: table.column(c).slice(0, 1) for c in ("scan_id", "idx")}
        columns |= {"low": [v.min()], "high": [v.max()], "mean": [v.mean()], "pixels": [v.size]}
        columns |= {f"q{int(q * 100)}": [x] for q, x in zip(quantiles, np.quantile(v, quantiles))}
        columns["histogram"] = [np.histogram(v, bins, span)[0].tolist()]
        return pa.table(columns)

    return frames.select("scan_id", "idx", "values").groupBy("scan_id", "idx").applyInArrow(run, schema)
