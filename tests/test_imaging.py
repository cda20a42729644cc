"""Image operators on phantoms and against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from beamwright.functions import pixels
from beamwright.operators import center, imaging, kernels, pyramid, recon
from beamwright.operators import frames as frames_
from beamwright.plans import chain

W, N = 64, 90
ROWS = "scan_id string, idx int, row int, values array<double>"


def disc_sinogram(cor=31.5, radius=20.0, x0=0.0, y0=0.0, n=N, w=W, span=np.pi):
    theta = np.arange(n) * span / n
    t = np.arange(w)[None, :] - cor
    s = x0 * np.cos(theta)[:, None] + y0 * np.sin(theta)[:, None]
    return 2 * np.sqrt(np.clip(radius**2 - (t - s) ** 2, 0, None)), theta


def phantom(cor=31.5, span=np.pi, n=N):
    a, theta = disc_sinogram(cor, 22, 0, 0, n, span=span)
    b, _ = disc_sinogram(cor, 6, 8, 5, n, span=span)
    return a + b, theta


def to_df(spark, blocks, scan="s"):
    """blocks: array [idx, row, ray]"""
    rows = [(scan, i, r, blocks[i, r].tolist()) for i in range(blocks.shape[0]) for r in range(blocks.shape[1])]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["scan_id", "idx", "row", "values"]), ROWS)


def back(df, order=("idx", "row")):
    rows = df.orderBy(*order).collect()
    n0 = 1 + max(r[order[0]] for r in rows)
    return np.array([r["values"] for r in rows]).reshape(n0, -1, len(rows[0]["values"]))


def scan_df(spark, theta, cor, **extra):
    row = {"scan_id": "s", "theta": [float(x) for x in theta], "cor": float(cor), "pxsize_cm": 1.0, "npad": 13,
           "numangles": len(theta), "numslices": 1, "numrays": W, "angularrange": 180.0} | extra
    types = "scan_id string, theta array<double>, cor double, pxsize_cm double, npad int, numangles int, numslices int, numrays int, angularrange double"
    return spark.createDataFrame([tuple(row.values())], types + "".join(f", {k} {'int' if isinstance(v, int) else 'double'}" for k, v in extra.items()))


@pytest.mark.parametrize("method", ["fbp", "gridrec"])
@pytest.mark.parametrize("cor", [31.5, 30.25])
def test_reconstruction_of_a_disc(spark, method, cor):
    sino, theta = disc_sinogram(cor)
    df = to_df(spark, sino[:, None, :])
    img = back(recon.reconstruct(df, scan_df(spark, theta, cor), method, cutoff=0.5, angle_chunk=17), ("z", "y"))[0]
    y, x = np.indices(img.shape) - 31.5
    r = np.hypot(x, y)
    assert abs(img[r < 12].mean() - 1) < 0.02
    assert abs(img[(r > 23) & (r < 30)].mean()) < 0.05


def test_chunks_do_not_change_the_slice_and_methods_agree(spark):
    sino, theta = phantom()
    df, sc = to_df(spark, sino[:, None, :]), scan_df(spark, theta, 31.5)
    whole = back(recon.reconstruct(df, sc, "gridrec", angle_chunk=1000), ("z", "y"))[0]
    parts = back(recon.reconstruct(df, sc, "gridrec", angle_chunk=7), ("z", "y"))[0]
    fbp = back(recon.reconstruct(df, sc, "fbp"), ("z", "y"))[0]
    assert np.abs(whole - parts).max() < 1e-9
    y, x = np.indices(whole.shape) - 31.5
    inner = np.hypot(x, y) < 28
    assert np.abs(whole - fbp)[inner].mean() < 0.03


def test_off_centre_disc_lands_where_it_should(spark):
    sino, theta = disc_sinogram(31.5, 5, 10, -6)
    img = back(recon.reconstruct(to_df(spark, sino[:, None, :]), scan_df(spark, theta, 31.5), "gridrec"), ("z", "y"))[0]
    y, x = np.indices(img.shape) - 31.5
    m = np.clip(img, 0, None) ** 2
    assert abs((x * m).sum() / m.sum() - 10) < 0.5 and abs((y * m).sum() / m.sum() + 6) < 0.5


def stripe_power(a):
    m = a.mean(axis=0)
    return np.abs(np.diff(m, 2)).mean()


@pytest.mark.parametrize("op", ["fw", "ti", "sf"])
def test_stripes_shrink(spark, op):
    # off-centre, so that nothing in the clean sinogram looks like a stripe
    clean = disc_sinogram(31.5, 6, 14, 5, span=2 * np.pi)[0] + disc_sinogram(31.5, 5, -6, 17, span=2 * np.pi)[0]
    gain = np.zeros(W)
    gain[[15, 28, 40, 51]] = (3.0, 3.0, 2.0, 3.0)
    df = to_df(spark, (clean + gain)[:, None, :])
    out = {"fw": lambda d: imaging.stripe_fourier_wavelet(d, 3, 2), "ti": imaging.stripe_titarenko, "sf": imaging.stripe_smoothing}[op](df)
    got = back(out)[:, 0]
    assert stripe_power(got) < 0.6 * stripe_power(clean + gain)
    assert np.corrcoef(got.ravel(), clean.ravel())[0, 1] > 0.97


def test_wavelet_is_invertible_when_nothing_is_damped():
    a = np.random.default_rng(0).normal(size=(37, 50))
    assert np.abs(kernels.damp_stripes(a, 1e-9, 8).mean() - a.mean()) < 0.5
    low, high = kernels._analysis(a[:36], 0)
    assert np.allclose(kernels._synthesis(low, high, 0), a[:36], atol=1e-8)


def test_ring_profile_solves_its_system():
    m = np.random.default_rng(0).normal(size=20)
    for order in (1, 2):
        q = kernels.ring_profile(m, 0.3, order)
        d = np.diff(np.eye(20), n=order, axis=0)
        assert np.allclose(d.T @ d @ (q + m) + 0.09 * q, 0, atol=1e-9)


def test_spikes(spark):
    clean, _ = phantom()
    blocks = np.repeat(clean[:, None, :], 3, axis=1)
    noisy = blocks.copy()
    noisy[10, 1, 20] += 1000
    noisy[40, 0, 33] -= 1000
    one = back(imaging.remove_outlier_1d(to_df(spark, noisy), 750, chunk=16))
    assert np.abs(one - blocks).max() < 5
    two = back(imaging.remove_outlier_2d(to_df(spark, noisy), 750))
    assert abs(two[10, 1, 20] - blocks[10, 1, 20]) < 5 and two[40, 0, 33] == noisy[40, 0, 33]


@pytest.mark.parametrize("size,chunk", [(3, 4), (5, 7), (4, 8), (7, 100)])
def test_despike_chunks_equal_whole(spark, size, chunk):
    a = np.random.default_rng(2).normal(size=(23, 1, 6))
    got = back(imaging.remove_outlier_1d(to_df(spark, a), 0.1, size, chunk))[:, 0]
    assert np.allclose(got, kernels.despike_angles(a[:, 0], 0.1, size))


@pytest.mark.parametrize("cor", [31.25, 33.5])
@pytest.mark.parametrize("method", ["pc", "vo", "nm"])
def test_centres(spark, method, cor):
    span = np.pi * N / (N - 1) if method == "pc" else np.pi  # the last projection at 180 degrees
    sino, theta = phantom(cor, span)
    if method == "pc":
        up, _ = disc_sinogram(cor, 9, 3, -4, span=span)
        blocks = np.stack([sino, sino + up, up], axis=1)
        tomo = to_df(spark, blocks).withColumn("kind", F.lit("tomo"))
        got = center.find_center("pc", tomo, scan_df(spark, theta, cor), normalized=True).first().center
        gain = np.linspace(500, 900, W)[None, None, :]
        flat = to_df(spark, np.repeat(100 + gain, 3, axis=1)).withColumn("kind", F.lit("flat"))
        dark = to_df(spark, np.full((1, 3, W), 100.0)).withColumn("kind", F.lit("dark"))
        raw = to_df(spark, 100 + gain * blocks).withColumn("kind", F.lit("tomo")).unionByName(flat).unionByName(dark)
        assert abs(center.find_center("pc", raw, scan_df(spark, theta, cor)).first().center - got) < 1e-9
    elif method == "vo":
        got = center.find_center("vo", to_df(spark, sino[:, None, :]), None, radius=2, reach=10, drop=2).first().center
    else:
        scans = scan_df(spark, theta, cor).withColumn("init", F.lit(None).cast("double"))
        got = center.find_center("nm", to_df(spark, sino[:, None, :]), scans, reach=6).first().center
    assert abs(got - cor) <= 0.5
    with pytest.raises(ValueError):
        center.find_center("zz", None, None)


def test_short_scans_have_no_centre_and_stop_no_others(spark):
    """``drop`` frequencies of a scan with too few projections are all it has; the others keep the centre they have alone."""
    sino, _ = phantom(31.25, np.pi)
    whole = to_df(spark, sino[:, None, :]).withColumn("scan_id", F.lit("whole"))
    alone = center.center_vo(whole, radius=2, reach=10, drop=4).first().center
    frames = whole
    for n in (1, 5, 6):
        frames = frames.unionByName(to_df(spark, sino[:n, None, :]).withColumn("scan_id", F.lit(f"short{n}")))
    got = {r.scan_id: r.center for r in center.center_vo(frames, radius=2, reach=10, drop=4).collect()}
    assert got["whole"] == alone and got["short1"] is None and got["short5"] is None
    assert len(got) == 4 and abs(got["short6"] - 31.5) <= 12


def test_half_turn_pair(spark):
    w, n, cor = 48, 40, 41.0
    wide = 2 * np.sqrt(np.clip(30.0**2 - (np.arange(-100, 100)) ** 2, 0, None))
    row = np.interp(np.arange(w) - cor, np.arange(-100, 100), wide)
    df = to_df(spark, np.repeat(row[None, None, :], n, axis=0))
    ov = imaging.overlap_pixels(w, cor + 0.5, n)
    sc = scan_df(spark, np.arange(n), cor, overlap=ov).withColumn("numangles", F.lit(n))
    got = back(imaging.join_half_turns(df, sc))[:, 0]
    assert got.shape == (n // 2, 2 * w - ov)
    assert np.allclose(got[0], got[0][::-1], atol=1e-9)
    assert imaging.overlap_pixels(100, 80.25, 41) == int(np.round(19.25)) * 2


def test_phase_retrieval_equals_brute_force(spark):
    img = np.random.default_rng(3).normal(size=(4, 1, 6)).swapaxes(0, 1)
    df = to_df(spark, img)
    sc = scan_df(spark, [0.0], 0).withColumn("pxsize_cm", F.lit(0.001)).withColumn("distance", F.lit(5.0)).withColumn("kev", F.lit(25.0))
    got = back(imaging.phase_retrieval(df, sc, 1e-3))[0]
    p = np.pad(img[0], ((2, 2), (5, 5)), mode="edge")
    h, w = p.shape
    out = np.zeros_like(p)
    lam = 1.23984198e-7 / 25
    for ky in range(h):
        for kx in range(w):
            fy, fx = (ky - h * (ky > h // 2)) / h / 0.001, (kx - w * (kx > w // 2)) / w / 0.001
            k = 1e-3 / (1e-3 + lam * 5 * (fy**2 + fx**2) / (4 * np.pi))
            wave = np.exp(-2j * np.pi * (ky * np.arange(h)[:, None] / h + kx * np.arange(w)[None, :] / w))
            out = out + (k * (p * wave).sum() * np.conj(wave)).real / (h * w)
    assert np.allclose(got, out[2:6, 5:11], atol=1e-9)


def test_rings_in_slices_shrink(spark):
    y, x = np.indices((W, W)) - 31.5
    r = np.hypot(x, y)
    clean = (r < 25) * 1.0
    ring = 0.5 * (np.abs(r - 14) < 0.7)
    img = kernels.polar_smooth(clean + ring, 30, 9, 3000, 3000, -3000)
    near = np.abs(r - 14) < 0.7
    assert np.abs(img - clean)[near].mean() < 0.5 * np.abs(ring)[near].mean()
    assert np.abs(img - clean)[r < 8].mean() < 0.02


def test_drift_and_translate(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(3, 5, 7))
    sc = scan_df(spark, [0, 1, 2], 0).withColumn("numslices", F.lit(5))
    whole = back(imaging.translate(to_df(spark, a), sc, 2, 1, interpolate=False))
    want = np.zeros_like(a)
    want[:, :-1, 2:] = a[:, 1:, :-2]
    assert np.allclose(whole, want)
    assert np.allclose(back(imaging.translate(to_df(spark, a), sc, 2, 1)), want)
    far = back(imaging.translate(to_df(spark, a), sc, 9, 0, interpolate=False))
    assert not far.any()
    half = back(imaging.translate(to_df(spark, a), sc, 0.5, 0))
    assert np.allclose(half[..., 1:], (a[..., 1:] + a[..., :-1]) / 2)


def test_pyramid_of_a_blob(spark):
    z, y, x = np.indices((20, 16, 16)) - np.array([9.5, 7.5, 7.5])[:, None, None, None]
    v = np.exp(-(x**2 + y**2 + z**2) / 40)
    rows = [("s", i, j, v[i, j].tolist()) for i in range(20) for j in range(16)]
    df = spark.createDataFrame(rows, "scan_id string, z int, y int, values array<double>")
    sc = spark.createDataFrame([("s", 2.0, 20, 16, 16)], "scan_id string, pxsize_um double, nz int, ny int, nx int")
    levels, scales = pyramid.multires_pyramid(df, sc, min_size=4)
    got = {n: back(levels.filter(F.col("level") == n), ("z", "y")) for n in (0, 1, 2)}
    assert [got[n].shape for n in (0, 1, 2)] == [(20, 16, 16), (10, 8, 8), (5, 4, 4)]
    w = np.array(pyramid.kernel())
    p = np.pad(v, 2, mode="edge")
    for axis in range(3):
        p = np.apply_along_axis(lambda r: np.convolve(r, w, "valid"), axis, p)
    assert np.allclose(got[1], p[::2, ::2, ::2], atol=1e-12)
    assert {r.scale_um for r in scales.filter("level = 2").collect()} == {8.0}
    assert scales.agg(F.max("level")).first()[0] == 2


def test_pad_and_crop_are_inverse(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "values array<double>")
    r = df.select(pixels.pad_edge(F.col("values"), 2).alias("p"), pixels.crop(pixels.pad_edge(F.col("values"), 2), 2).alias("c")).first()
    assert r.p == [1, 1, 1, 2, 3, 3, 3] and r.c == [1, 2, 3]


def test_clamps_with_nan(spark):
    df = spark.createDataFrame([([float("nan"), 1e9, -1e9, 10.0],)], "values array<double>")
    r = df.select(pixels.apply(F.col("values"), pixels.cast_8bit()).alias("b"), pixels.apply(F.col("values"), pixels.minus_log()).alias("l")).first()
    assert r.b == [0, 255, 0, 128]
    assert r.l[0] == pytest.approx(-np.log(0.01)) and r.l[2] == r.l[0]


def test_stage_order_and_passes():
    assert chain.stage_names(chain.Settings()) == ["normalize", "minus_log", "stripe_fourier_wavelet", "reconstruct", "slices_out"]
    assert [a for a, _ in chain.passes(chain.stage_names(chain.Settings()))] == ["sino"]
    off = chain.Settings.of("polar_ring", "cast_8bit", without=("reconstruct",))
    assert chain.stage_names(off) == ["normalize", "minus_log", "stripe_fourier_wavelet"]
    mixed = chain.stage_names(chain.Settings.of("outlier_1d", "outlier_2d", "normalize_nearest", "tilt"))
    assert mixed[:3] == ["outlier_1d", "outlier_2d", "normalize_nearest"]
    assert [a for a, _ in chain.passes(mixed)] == ["sino", "proj", "sino", "proj", "sino"]
    with pytest.raises(ValueError):
        chain.Settings.of("nonsense")


def test_whole_chain_recovers_the_disc(spark):
    sino, theta = disc_sinogram(31.5)
    counts = 20 + 900 * np.exp(-0.01 * sino)
    tomo = to_df(spark, counts[:, None, :]).withColumn("kind", F.lit("tomo"))
    flat = to_df(spark, np.full((4, 1, W), 920.0)).withColumn("kind", F.lit("flat"))
    dark = to_df(spark, np.full((3, 1, W), 20.0)).withColumn("kind", F.lit("dark"))
    frames = tomo.unionByName(flat).unionByName(dark)
    sc = scan_df(spark, theta, 31.5)
    s = chain.Settings.of(without=("stripe_fourier_wavelet",), cutoff=0.5)
    y, x = np.indices((W, W)) - 31.5
    img = back(chain.run(frames, sc, s).slices, ("z", "y"))[0]
    assert abs(img[np.hypot(x, y) < 12].mean() - 0.01) < 2e-4
    full = chain.Settings.of("outlier_1d", "outlier_2d", "stripe_titarenko", "stripe_smoothing", "tilt", "lens_distortion", "polar_ring",
                             "polar_ring_second", "cast_8bit", "normalized_out", "raw_out", lens_center=(32.0, 0.0), lens_factors=(1.0,),
                             cast_range=(-0.1, 0.1), polar={"width": 9}, polar_second={"width": 5})
    out = chain.run(frames, sc, full)
    pic = back(out.slices, ("z", "y"))[0]
    assert pic.shape == (W, W) and pic.min() >= 0 and pic.max() <= 255
    assert out.raw is not None and out.normalized.count() == N


def test_a_selection_of_projections_keeps_the_scale(spark):
    sino, theta = disc_sinogram()
    df, sc = to_df(spark, sino[:, None, :]), scan_df(spark, theta, 31.5)
    whole = back(recon.reconstruct(df, sc, "fbp"), ("z", "y"))[0]
    half = back(recon.reconstruct(df.filter("idx % 2 = 0"), sc, "fbp"), ("z", "y"))[0]
    inner = np.s_[24:40, 24:40]
    assert abs(half[inner].mean() / whole[inner].mean() - 1) < 0.03


@pytest.mark.parametrize("chunk", [8, 1000])
def test_neighbours_are_those_of_the_selection(spark, chunk):
    rng = np.random.default_rng(2)
    a = rng.normal(100, 1, (60, 1, 8))
    a[::10] += 5000
    df = to_df(spark, a).filter("idx % 2 = 0")
    got = np.array([r["values"] for r in imaging.remove_outlier_1d(df, 750, 3, chunk=chunk).orderBy("idx").collect()])
    assert np.allclose(got, kernels.despike_angles(a[::2, 0], 750, 3))


def test_parameters_run_as_asked_or_fail(spark):
    a = np.random.default_rng(3).normal(10, 1, (40, 48))
    assert kernels.damp_stripes(a, 3, 8).shape == a.shape
    assert not np.allclose(kernels.damp_stripes(a, 3, 8), kernels.damp_stripes(a, 3, 3))
    wide, narrow = (kernels.polar_smooth(a[:40, :40], 30, n, 1e3, 1e3, -1e3) for n in (100, 11))
    assert not np.allclose(wide, narrow)
    for call in (lambda: kernels.flatten_profile(a, 41, 1.5), lambda: kernels.mirror_scores(a, [20.0], 0.5, 79)):
        with pytest.raises(ValueError):
            call()


def test_projections_without_reference_leave_an_issue(spark):
    tomo = spark.createDataFrame([("s", 0, 0, [1.0]), ("t", 0, 0, [1.0]), ("t", 1, 0, [1.0])], "scan_id string, idx int, row int, values array<double>")
    one = spark.createDataFrame([("s", 0, [1.0])], "scan_id string, row int, values array<double>")
    issues = frames_.reference_issues(tomo, one, one).collect()
    assert [(r.scan_id, r.severity) for r in issues] == [("t", "error")] and "2 detector rows" in issues[0].msg


def test_chain_with_selection_and_borrowed_flats(spark):
    sino, theta = disc_sinogram(31.5)
    tomo = to_df(spark, 20 + 900 * np.exp(-0.01 * sino)[:, None, :]).withColumn("kind", F.lit("tomo"))
    flat = to_df(spark, np.full((4, 1, W), 920.0), "bright").withColumn("kind", F.lit("flat"))
    dark = to_df(spark, np.full((3, 1, W), 20.0)).withColumn("kind", F.lit("dark"))
    scans = scan_df(spark, theta, 31.5)
    bright = spark.createDataFrame([("s", "bright")], "scan_id string, bright_scan_id string")
    s = chain.Settings.of(without=("stripe_fourier_wavelet",), cutoff=0.5, projections=(0, 10_000, 2))
    img = back(chain.run(tomo.unionByName(flat).unionByName(dark), scans, s, bright_scans=bright).slices, ("z", "y"))[0]
    y, x = np.indices((W, W)) - 31.5
    assert abs(img[np.hypot(x, y) < 12].mean() - 0.01) < 4e-4
