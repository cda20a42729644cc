"""The correction and reconstruction chain as one DataFrame expression.

``stage_names`` turns switches into the fixed order of stages.  ``run`` applies
them: pixel stages become one ``transform``, neighbouring numpy stages on the
same axis share one grouped task, and a change of axis is one shuffle.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.functions import pixels
from beamwright.functions import values as values_
from beamwright.operators import frames as fr
from beamwright.operators import center, imaging, kernels, recon
from beamwright.plans.grouped import PROJECTION, SINOGRAM, grouped_kernel
from beamwright.session import materialise

# fixed values: stages in their order, with the axis they work along
STAGES = {
    "raw_out": "proj",
    "outlier_1d": "sino",
    "outlier_2d": "proj",
    "normalize_nearest": "sino",
    "normalize": "both",
    "minus_log": "both",
    "beam_hardening": "both",
    "stripe_fourier_wavelet": "sino",
    "stripe_titarenko": "sino",
    "stripe_smoothing": "sino",
    "tilt": "proj",
    "lens_distortion": "proj",
    "half_turn": "sino",
    "phase_retrieval": "proj",
    "drift": "proj",
    "reconstruct": "sino",
    "polar_ring": "sino",
    "polar_ring_second": "sino",
    "cast_8bit": "both",
    "slices_out": "both",
    "normalized_out": "proj",
}
# fixed values: stages that are on unless switched off
DEFAULT_ON = {"normalize", "minus_log", "stripe_fourier_wavelet", "reconstruct", "slices_out"}
NEEDS_RECON = {"polar_ring", "polar_ring_second", "cast_8bit", "slices_out"}


@dataclass(frozen=True)
class Settings:
    """Switches and parameters of a chain run."""

    on: frozenset = frozenset(DEFAULT_ON)
    outlier_dif: float = 750
    outlier_size: int = 3
    exposure_ratio: float = 1
    minimum_transmission: float = 0.01
    hardening: tuple = fixed.BEAM_HARDENING
    ring_sigma: float = 3
    ring_level: int = 8
    ring_nblock: int = 0
    ring_alpha: float = 1.5
    ring_size: int = 5
    tilt_degrees: float = 0
    tilt_center: tuple = (None, None)
    first_row: int = 0
    projections: tuple | None = None
    rows: tuple | None = None
    lens_center: tuple = fixed.LENS_CENTER
    lens_factors: tuple = fixed.LENS_FACTORS
    phase_alpha: float = 1e-5
    drift: tuple = (0.0, 0.0)
    method: str = "gridrec"
    cutoff: float = 0.25
    order: float = 2
    polar: dict = field(default_factory=dict)
    polar_second: dict = field(default_factory=dict)
    cast_range: tuple = (-10.0, 30.0)
    center: str | None = None
    center_options: dict = field(default_factory=dict)

    @classmethod
    def of(cls, *extra: str, without: tuple = (), **params) -> "Settings":
        unknown = set(extra) - set(STAGES)
        if unknown:
            raise ValueError(f"unknown stages {sorted(unknown)}")
        return cls(on=frozenset((DEFAULT_ON | set(extra)) - set(without)), **params)


def stage_names(settings: Settings) -> list:
    on = set(settings.on)
    if "normalize_nearest" in on:
        on.discard("normalize")
    if "reconstruct" not in on:
        on -= NEEDS_RECON
    return [s for s in STAGES if s in on]


def passes(names: list) -> list:
    """Consecutive stages that share an axis: ``[(axis, [stage, …]), …]``."""
    first = next((STAGES[n] for n in names if STAGES[n] != "both"), "sino")
    out = [(first, [])]
    for n in names:
        if STAGES[n] not in ("both", out[-1][0]):
            out.append((STAGES[n], []))
        out[-1][1].append(n)
    return out


@dataclass
class Result:
    raw: DataFrame | None
    normalized: DataFrame | None
    slices: DataFrame | None
    issues: DataFrame


def normalized(
    rows: DataFrame, frames: DataFrame, scans: DataFrame, s: Settings, bright_scans: DataFrame | None, *more,
) -> DataFrame:
    """Rows over the flats and darks of ``frames``, by nearest flats or by means as the settings say, then ``more`` pixel steps."""
    if "normalize_nearest" in s.on:
        joined, floor = fr.attach_nearest(rows, frames, scans), 1e-5
    else:
        flat, dark = fr.reduce_reference(frames, "flat"), fr.reduce_reference(frames, "dark")
        joined, floor = fr.attach_references(rows, flat, dark, bright_scans), 1e-6
    values = pixels.normalize(F.col("values"), F.col("dark"), F.col("flat"), pixels.exposure_scale(s.exposure_ratio), *more, floor=floor)
    return joined.select("scan_id", "idx", "row", values.alias("values"))


def with_centers(frames: DataFrame, scans: DataFrame, s: Settings, bright_scans: DataFrame | None = None) -> DataFrame:
    """Scans with the centre that each lacks, searched by ``s.center`` in its normalised projections.

    Only the frames of scans without a centre are read: two projections of each for ``pc``, one detector row (the first
    that is selected, or ``row`` among the options) for ``vo`` and ``nm``.  The centres found, one row per scan, are
    written once, since several steps of a run use them.
    """
    if "cor" not in scans.columns:
        scans = scans.withColumn("cor", F.lit(None).cast("double"))
    lacking = scans.filter("cor is null")
    options = dict(s.center_options)
    if s.center == "skip":
        found = center.center_skip(lacking)
    else:
        wanted = lacking.select("scan_id")
        if bright_scans is not None:
            wanted = wanted.unionByName(bright_scans.join(wanted, "scan_id", "left_semi").select(F.col("bright_scan_id").alias("scan_id")))
        mine = frames.join(wanted, "scan_id", "left_semi")
        if s.center == "pc":
            rows = fr.opposing_pair(mine, lacking).select("scan_id", "idx", "row", "values")
            # the search picks the pair by its kind, and both are projections
            rows = normalized(rows, mine, lacking, s, bright_scans).withColumn("kind", F.lit("tomo"))
            options["normalized"] = True
        else:
            row = options.setdefault("row", s.rows[0] if s.rows else 0)
            mine = mine.filter(F.col("row") == row)
            rows = mine.filter(F.col("kind") == "tomo").join(lacking.select("scan_id"), "scan_id", "left_semi")
            if s.projections:
                rows = rows.filter(values_.strided(F.col("idx"), *s.projections))
            rows = normalized(rows.select("scan_id", "idx", "row", "values"), mine, lacking, s, bright_scans)
        if "init" not in lacking.columns:
            lacking = lacking.withColumn("init", F.lit(None).cast("double"))
        found = center.find_center(s.center, rows, lacking, **options)
    found = materialise(found.withColumnRenamed("center", "_center"), "centres")
    return scans.join(found, "scan_id", "left").withColumn("cor", F.coalesce("cor", "_center")).drop("_center")


def no_issues(scans: DataFrame) -> DataFrame:
    return scans.select("scan_id", *fr.issue("error", F.lit(""))).limit(0)


def run(
    frames: DataFrame, scans: DataFrame, settings: Settings = Settings(), ignore: DataFrame | None = None, bright_scans: DataFrame | None = None,
) -> Result:
    """Run the chain for all scans of ``frames`` at once.

    ``settings.projections`` and ``settings.rows`` are ``(start, stop, step)``
    selections; flats and darks keep all their frames.  ``ignore(scan_id, idx)``
    lists projections that count nothing in the slices, and
    ``bright_scans(scan_id, bright_scan_id)`` takes flats from another scan.

    ``scans`` has one row per scan with the columns the chosen stages use
    (theta, cor, pxsize_cm, npad; flat_locations; numslices; overlap; …).  With
    ``settings.center`` a scan without ``cor`` gets one by that search; half
    turns without ``overlap`` get it by their centre.  ``issues`` of the result
    names the scans of which projections are left out, and why.
    """
    s, names = settings, stage_names(settings)
    if s.center:
        scans = with_centers(frames, scans, s, bright_scans)
    if s.rows:
        frames = frames.filter(values_.strided(F.col("row"), *s.rows))
    if s.projections:
        frames = frames.filter((F.col("kind") != "tomo") | values_.strided(F.col("idx"), *s.projections))
    tomo = frames.filter(F.col("kind") == "tomo").select("scan_id", "idx", "row", "values")
    raw = frames if "raw_out" in names else None
    # the projections that take part, read without their pixels and counted before any correction
    taking = tomo.select("scan_id", "idx")
    issues = []
    if "normalize" in names or "normalize_nearest" in names:
        flat_rows, dark_rows = (frames.filter(F.col("kind") == k).select("scan_id", "row").distinct() for k in ("flat", "dark"))
        if bright_scans is not None and "normalize" in names:
            flat_rows = flat_rows.withColumnRenamed("scan_id", "bright_scan_id").join(bright_scans, "bright_scan_id").select("scan_id", "row")
        issues.append(fr.reference_issues(tomo, flat_rows, dark_rows))
    if "reconstruct" in names:
        issues.append(fr.geometry_issues(taking, scans))
        scans = scans.filter("cor is not null")
    slices, pixel_steps, pending = None, [], []

    def numpy_stage(axis, fn):
        nonlocal tomo
        flush_pixels()
        if pending and pending[0][0] is not axis:
            flush_kernels()
        pending.append((axis, fn))

    def flush_pixels():
        nonlocal tomo
        if pixel_steps:
            tomo = tomo.withColumn("values", pixels.apply(F.col("values"), *pixel_steps))
            pixel_steps.clear()

    def flush_kernels():
        nonlocal tomo
        if pending:
            axis, fns = pending[0][0], [f for _, f in pending]

            def composed(a, _):
                for f in fns:
                    a = f(a)
                return a

            tomo = grouped_kernel(tomo, axis, composed)
            pending.clear()

    def flush():
        flush_pixels()
        flush_kernels()

    def pixel_stage(step):
        flush_kernels()
        pixel_steps.append(step)

    for name in names:
        if name == "outlier_1d":
            numpy_stage(SINOGRAM, lambda a: kernels.despike_angles(a, s.outlier_dif, s.outlier_size))
        elif name == "outlier_2d":
            numpy_stage(PROJECTION, lambda a: kernels.despike_image(a, s.outlier_dif, s.outlier_size))
        elif name in ("normalize", "normalize_nearest"):
            flush()
            steps = []
            if "minus_log" in names:
                steps.append(pixels.minus_log(s.minimum_transmission))
            if "beam_hardening" in names:
                steps.append(pixels.beam_hardening(s.hardening))
            tomo = normalized(tomo, frames, scans, s, bright_scans, *steps)
        elif name == "minus_log" and not {"normalize", "normalize_nearest"} & set(names):
            pixel_stage(pixels.minus_log(s.minimum_transmission))
        elif name == "beam_hardening" and not {"normalize", "normalize_nearest"} & set(names):
            pixel_stage(pixels.beam_hardening(s.hardening))
        elif name == "stripe_fourier_wavelet":
            numpy_stage(SINOGRAM, lambda a: kernels.damp_stripes(a, s.ring_sigma, s.ring_level))
        elif name == "stripe_titarenko":
            numpy_stage(SINOGRAM, lambda a: kernels.flatten_profile(a, s.ring_nblock, s.ring_alpha))
        elif name == "stripe_smoothing":
            numpy_stage(SINOGRAM, lambda a: kernels.smooth_stripes(a, s.ring_size))
        elif name == "tilt":
            numpy_stage(PROJECTION, lambda a: imaging.tilted(a, s.tilt_degrees, *s.tilt_center, s.first_row))
        elif name == "lens_distortion":
            numpy_stage(PROJECTION, lambda a: kernels.undistort(a, *s.lens_center, s.lens_factors))
        elif name == "half_turn":
            flush()
            issues.append(imaging.half_turn_issues(taking, scans))
            taking = imaging.paired_half_turns(taking, scans).filter("paired")
            width = F.col("numrays") if "numrays" in scans.columns else F.lit(None).cast("int")
            tomo = imaging.join_half_turns(tomo, imaging.with_overlap(scans, width))
            n = F.floor(F.col("numangles") / 2).cast("int")
            scans = scans.withColumn("theta", F.slice("theta", 1, n))
        elif name == "phase_retrieval":
            flush()
            tomo = imaging.phase_retrieval(tomo, scans, s.phase_alpha)
        elif name == "drift":
            flush()
            offsets = fr.drift_offset(fr.angle_table(scans), *s.drift)
            tomo = imaging.drift_correction(tomo, offsets, scans, interpolate=False)
        elif name == "reconstruct":
            flush_pixels()
            same = bool(pending) and pending[0][0] is SINOGRAM
            before = [f for _, f in pending] if same else []
            # rows of nearest flats may lack their group, so there the corrected rows are counted
            used = None if "normalize_nearest" in names else recon.projections_of(taking)
            if not same:
                flush_kernels()
            slices = recon.reconstruct(tomo, scans, s.method, s.cutoff, s.order, ignore=ignore, before=before,
                                       used=used)
            if "normalized_out" in names:
                flush_kernels()
            pending.clear()
        elif name == "polar_ring":
            slices = recon.polar_ring(slices, **s.polar)
        elif name == "polar_ring_second":
            slices = recon.polar_ring(slices, **s.polar_second)
        elif name == "cast_8bit":
            slices = slices.withColumn("values", pixels.apply(F.col("values"), pixels.cast_8bit(*s.cast_range)))
    flush()
    return Result(raw, tomo if "normalized_out" in names or slices is None else None, slices,
                  reduce(DataFrame.unionByName, issues) if issues else no_issues(scans))
