"""Order statistics by narrowing histograms against a full sort."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beamwright.operators import frames, selection


@pytest.mark.parametrize("q", [0.5, 0.01, 1.0])
def test_quantiles_of_awkward_rays(spark, q):
    """Ties, wide ranges, infinite values, NaN, nulls and a null key, with few bins so that several passes are needed."""
    rng = random.Random(6)
    rows = []
    for k, n in (("a", 301), ("b", 40), (None, 64), ("one", 1)):
        for i in range(n):
            wide = rng.choice([-1, 1]) * 10.0 ** rng.randint(-30, 30)
            rows.append((k, i % 1, [rng.gauss(0, 1), 5.0, wide, rng.choice([-math.inf, math.inf, 0.0, float(i)]), math.nan if i == 0 else 1.0, None if i % 3 else float(i)]))
    df = spark.createDataFrame(rows, "scan string, row int, values array<double>").repartition(4)
    got = {r.scan: r["values"] for r in selection.ray_quantiles(df, ["scan", "row"], q, bins=4, gather=8).collect()}
    assert len(got) == 4
    for scan, values in got.items():
        mine = [r[2] for r in rows if r[0] == scan]
        for ray in range(6):
            v = np.array([x[ray] for x in mine if x[ray] is not None])
            s = np.sort(v)
            at = q * (len(s) - 1)
            low, high = s[int(at)], s[min(int(at) + 1, len(s) - 1)]
            want = math.nan if np.isnan(v).any() else low if low == high or at == int(at) else low * (1 - at % 1) + high * (at % 1)
            assert values[ray] == pytest.approx(want, nan_ok=True), (scan, ray)


def test_median_of_very_many_frames_of_one_scan(spark):
    """10^5 frames meet in no task: the plan has no Python and no sort of values, and the result is the sort's."""
    n = 100_000
    value = lambda k: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_003)) / 7).cast("float")
    df = spark.range(n, numPartitions=8).select(F.lit("s").alias("scan_id"), F.lit(0).alias("row"), F.lit("dark").alias("kind"), F.array(value(1), value(2)).alias("values"))
    got = frames.reduce_reference(df, "dark", "median")
    assert "Python" not in got._jdf.queryExecution().toString()
    mine = np.array([r[0] for r in df.select("values").collect()])
    assert got.collect()[0]["values"] == pytest.approx(np.median(mine, axis=0).tolist())


def test_no_frames(spark):
    empty = spark.createDataFrame([], "scan_id string, row int, kind string, values array<float>")
    assert frames.reduce_reference(empty, "dark", "median").collect() == []
    with pytest.raises(ValueError):
        frames.reduce_reference(empty, "dark", "mode")
