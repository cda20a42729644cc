"""Whole runs of the chain: centres it searches itself, overlaps by the centre, and what it leaves out."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_imaging import N, W, back, disc_sinogram, phantom, scan_df, to_df

from beamwright.operators import imaging
from beamwright.plans import chain


def recorded(spark, sino, scan="s"):
    tomo = to_df(spark, 20 + 900 * np.exp(-0.01 * sino)[:, None, :], scan).withColumn("kind", F.lit("tomo"))
    flat = to_df(spark, np.full((4, 1, W), 920.0), scan).withColumn("kind", F.lit("flat"))
    dark = to_df(spark, np.full((3, 1, W), 20.0), scan).withColumn("kind", F.lit("dark"))
    return tomo.unionByName(flat).unionByName(dark)


@pytest.mark.parametrize("method, options", [("pc", {}), ("vo", {"reach": 8, "drop": 4}), ("nm", {"reach": 4})])
def test_a_missing_centre_is_searched_and_a_given_one_kept(spark, method, options):
    sino, theta = phantom(33.5)
    frames = recorded(spark, sino, "s").unionByName(recorded(spark, sino, "t"))
    bare = scan_df(spark, theta, 0.0).withColumn("cor", F.lit(None).cast("double"))
    scans = bare.unionByName(scan_df(spark, theta, 20.25).withColumn("scan_id", F.lit("t")))
    s = chain.Settings.of(without=("stripe_fourier_wavelet",), center=method, center_options=options)
    got = {r.scan_id: r.cor for r in chain.with_centers(frames, scans, s).collect()}
    assert got["t"] == 20.25 and abs(got["s"] - 33.5) <= 0.75


def test_searched_run_equals_the_run_with_that_centre(spark):
    sino, theta = disc_sinogram(31.5, 20)
    frames, scans = recorded(spark, sino), scan_df(spark, theta, 31.5)
    s = chain.Settings.of(without=("stripe_fourier_wavelet",), cutoff=0.5, center="pc")
    out = chain.run(frames, scans.drop("cor"), s)
    img = back(out.slices, ("z", "y"))[0]
    y, x = np.indices((W, W)) - 31.5
    assert abs(img[np.hypot(x, y) < 12].mean() - 0.01) < 4e-4
    assert out.issues.count() == 0


def test_searched_with_borrowed_flats(spark):
    sino, theta = phantom(33.5)
    own = recorded(spark, sino)
    lent = own.filter("kind = 'flat'").withColumn("scan_id", F.lit("bright"))
    frames = own.filter("kind <> 'flat'").unionByName(lent)
    bright = spark.createDataFrame([("s", "bright")], "scan_id string, bright_scan_id string")
    s = chain.Settings.of(center="pc")
    got = chain.with_centers(frames, scan_df(spark, theta, 0.0).drop("cor"), s, bright).first()
    assert abs(got.cor - 33.5) <= 0.5


def test_unknown_centre_method_fails(spark):
    sino, theta = disc_sinogram()
    with pytest.raises(ValueError):
        chain.run(recorded(spark, sino), scan_df(spark, theta, 31.5), chain.Settings.of(center="guess"))


def test_overlap_follows_the_centre(spark):
    rows = [("a", 60.0, 90, None), ("b", 60.0, 91, None), ("c", 60.0, 90, 7), ("d", None, 90, None)]
    scans = spark.createDataFrame(rows, "scan_id string, cor double, numangles int, overlap int")
    got = {r.scan_id: r.overlap for r in imaging.with_overlap(scans, F.lit(64)).collect()}
    want = {k: imaging.overlap_pixels(64, c, n) for k, c, n in (("a", 60.0, 90), ("b", 60.0, 91))}
    assert got == want | {"c": 7, "d": None}


def test_issues_name_all_that_is_left_out(spark):
    sino, theta = disc_sinogram()
    some = [recorded(spark, sino, n) for n in "abcde"]
    frames = some[0]
    for f in some[1:]:
        frames = frames.unionByName(f)
    frames = frames.filter("not (scan_id = 'b' and kind = 'dark') and not (scan_id = 'e' and kind = 'tomo' and idx = 3)")
    one = scan_df(spark, theta, 31.5)
    scans = one.limit(0)
    for n, cor in (("a", 31.5), ("b", 31.5), ("d", None), ("e", 31.5)):
        scans = scans.unionByName(one.withColumn("scan_id", F.lit(n)).withColumn("cor", F.lit(cor).cast("double")))
    out = chain.run(frames, scans.withColumn("overlap", F.lit(8)), chain.Settings.of("half_turn"))
    got = {(r.scan_id, r.severity, r.msg) for r in out.issues.collect()}
    assert got == {("b", "error", f"{N} detector rows without flat or dark"), ("c", "error", "no geometry"),
                   ("d", "error", "no centre of rotation"), ("e", "warning", "1 projections without an opposite one")}
    assert {r.scan_id for r in out.slices.select("scan_id").distinct().collect()} == {"a", "e"}


def test_projections_are_counted_without_their_corrections(spark):
    """The default run holds one numpy pass of the reference reduction per kind and one of the reconstruction."""
    sino, theta = disc_sinogram()
    plan = chain.run(recorded(spark, sino), scan_df(spark, theta, 31.5)).slices._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 3


def test_empty_tables(spark):
    sino, theta = disc_sinogram()
    frames, scans = recorded(spark, sino), scan_df(spark, theta, 31.5)
    s = chain.Settings.of(without=("stripe_fourier_wavelet",), center="pc")
    assert chain.run(frames.limit(0), scans, s).slices.count() == 0
    out = chain.run(frames, scans.limit(0), s)
    assert out.slices.count() == 0 and [r.msg for r in out.issues.collect()] == ["no geometry"]
