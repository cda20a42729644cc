"""Exact order statistics ray by ray, by histograms that narrow down: no sort, no task that holds a ray's values.

A pass counts the values of each ray in ``bins`` equal parts of the interval where the wanted one lies, and keeps of the part that holds it
its count, least and greatest value: the next interval. Counts are combined where the frames are read, so what is shuffled does
not grow with the number of frames once every part is filled. When no more than ``gather`` values are left in an interval, or all
are equal, they are picked out. Everything is built-in functions.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beamwright.session import materialise

RANK = ["_key", "ray", "t"]


def _inside(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The values that lie in a wanted interval: _key, ray, t, k, lo, hi, v. Frames meet a row per key, not a row per pixel."""
    held = wanted.groupBy("_key").agg(F.collect_list(F.struct("ray", "t", "k", "lo", "hi")).alias("w"))
    each = F.explode(F.expr("transform(w, e -> struct(e.ray as ray, e.t as t, e.k as k, e.lo as lo, e.hi as hi, cast(get(values, e.ray) as double) as v))"))
    return rows.join(held, "_key").select("_key", each.alias("e")).select("_key", "e.*").filter("v between lo and hi")


def ray_quantiles(rows: DataFrame, keys: list, q: float = 0.5, bins: int = 1024, gather: int = 1024) -> DataFrame:
    """Per key the array of the ``q``-quantiles of its rows' ``values``, element by element, linear between neighbours.

    Null elements are left out, a NaN makes its element's quantile NaN, infinite values are values; a null key is a key. Rows of one key
    have equally many elements.
    """
    rows = rows.select(F.struct(*keys).alias("_key"), "values")
    pixels = rows.select("_key", F.posexplode("values").alias("ray", "v")).withColumn("v", F.col("v").cast("double"))
    real = F.when(~F.isnan("v"), F.col("v"))
    ends = pixels.groupBy("_key", "ray").agg(
        F.count(real).alias("n"), F.min(real).alias("lo"), F.max(real).alias("hi"), F.max(F.isnan("v")).alias("odd"))
    ends = materialise(ends, "ray-ends")
    place = F.lit(float(q)) * (F.col("n") - 1)
    known = ends.filter("n > 0 and not odd").withColumn("first", F.floor(place)).select(
        "_key", "ray", F.explode(F.array(F.lit(0), F.lit(1))).alias("t"), F.least(F.col("first") + F.col("t"), F.col("n") - 1).alias("k"),
        "lo", "hi", F.col("n").alias("left"))
    by_part = Window.partitionBy(*RANK).orderBy("part")
    span = F.col("hi") - F.col("lo")
    part = F.when(F.abs(span) == float("inf"), F.when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), bins - 1).otherwise(1))
    part = part.otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / span * bins), F.lit(bins - 1))).cast("int")
    known, done = materialise(known, "ray-ranks"), []
    while True:
        done.append(known.filter(f"lo = hi or left <= {gather}"))
        wide = known.filter(f"lo < hi and left > {gather}")
        if wide.isEmpty():
            break
        counts = _inside(rows, wide).groupBy(*RANK, "k", part.alias("part")).agg(F.count("*").alias("left"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        counts = counts.withColumn("before", F.sum("left").over(by_part) - F.col("left"))
        chosen = counts.filter("before <= k and k < before + left").withColumn("k", F.col("k") - F.col("before"))
        known = materialise(chosen.select(*RANK, "k", "lo", "hi", "left"), "ray-ranks")
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    few = _inside(rows, settled.filter("lo < hi")).groupBy(*RANK, "k").agg(F.sort_array(F.collect_list("v")).alias("some"))
    found = settled.filter("lo = hi").select(*RANK, F.col("lo").alias("v")).unionByName(few.select(*RANK, F.get("some", F.col("k").cast("int")).alias("v")))
    found = found.groupBy("_key", "ray").agg(F.min("v").alias("below"), F.max("v").alias("above"))
    share = place - F.floor(place)
    value = F.when(F.col("odd"), F.lit(float("nan"))).when(F.col("below") == F.col("above"), F.col("below")).otherwise(
        F.col("below") * (1 - share) + F.col("above") * share)
    whole = ends.join(found, ["_key", "ray"], "left").groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("ray", value.alias("v")))).alias("r"))
    return whole.select("_key.*", F.col("r.v").alias("values"))
