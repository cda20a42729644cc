"""Frames, projections, sinograms and slices built from the embeddings table."""

import math

from pyspark.sql import functions as F

from beamwright.functions import pixels, values
from beamwright.operators import catalogue, center, imaging, pyramid, recon
from beamwright.operators import frames as fr
from beamwright.operators.selection import ray_quantiles
from beamwright.plans import chain
from beamwright.plans.grouped import PROJECTION, grouped_kernel, mean_frame
from beamwright.queries import bindings as b
from beamwright.queries.core import query, six
from beamwright.session import scratch_dir
from beamwright.sources import bricks, readers, sinks

W = 64


def scans(t):
    """One geometry row per scan of 64 rays."""
    n = (F.floor((F.max("k") - 12) / 2) + 1).cast("int")
    g = b._numbered(t).groupBy("scan_id", "label").agg(n.alias("numangles"))
    i = F.sequence(F.lit(0), F.col("numangles") - 1)
    rows = g.select(
        "scan_id", "numangles", F.lit(2).alias("numslices"), F.lit(W).alias("numrays"),
        F.when(F.col("label") % 2 == 0, 360.0).otherwise(180.0).alias("angularrange"),
        F.transform(i, lambda k: F.lit(math.pi) * k / F.col("numangles")).alias("theta"),
        F.lit(31.5).alias("cor"), F.lit(0.125).alias("pxsize_cm"), F.lit(13).alias("npad"), F.lit(20).alias("overlap"),
        F.array(F.lit(0), F.floor(F.col("numangles") / 2).cast("int"), F.col("numangles") - 1).alias("flat_locations"),
        F.lit(5.0).alias("distance"), F.lit(25.0).alias("kev"), F.lit(None).cast("double").alias("init"),
    )
    return rows


SCANS = "sc AS (SELECT scan_id, label, CAST((max(k) - 12) // 2 + 1 AS INTEGER) AS n FROM nb GROUP BY scan_id, label)"


def tile_scans(t):
    g = b._numbered(t).groupBy("scan_id").agg((F.max("k") + 1).alias("numangles"))
    i = F.sequence(F.lit(0), F.col("numangles") - 1)
    rows = g.select(
        "scan_id", "numangles", F.lit(8).alias("numslices"), F.lit(1.25).alias("pxsize_um"),
        F.transform(i, lambda k: F.lit(math.pi) * k / F.col("numangles")).alias("theta"),
        F.col("numangles").alias("nz"), F.lit(8).alias("ny"), F.lit(8).alias("nx"),
        F.lit(0.001).alias("pxsize_cm"), F.lit(5.0).alias("distance"), F.lit(25.0).alias("kev"))
    return rows


def tomo(t):
    return b.frames(t).filter("kind = 'tomo'").select("scan_id", "idx", "row", "values")


def out(df, *keys, name="v"):
    """Pixels as rows, six decimals."""
    rows = df.select(*keys, F.posexplode("values").alias("px", "v"))
    return rows.withColumn("v", six(F.col("v"))).withColumnRenamed("v", name)


def px6(x):
    return f"round({x}, 6) + 0.0"


_REF = """dk AS (SELECT scan_id, row, px, avg(v) AS d FROM px WHERE kind = 'dark' GROUP BY ALL),
fl AS (SELECT scan_id, row, px, avg(v) AS f FROM px WHERE kind = 'flat' GROUP BY ALL),
nm AS (SELECT p.scan_id, p.idx, p.row, p.px, (v - d) / greatest(f - d, 1e-6) AS v FROM px p JOIN dk USING (scan_id, row, px)
  JOIN fl USING (scan_id, row, px) WHERE kind = 'tomo'),
ml AS (SELECT scan_id, idx, row, px, -ln(greatest(v, 0.01)) AS v FROM nm)"""
NORMAL = f"WITH {b.FRAMES}, {_REF} "
_OUT = "SELECT scan_id, idx, row, px, {} AS v FROM {}"


def attached(t):
    f = b.frames(t)
    return fr.attach_references(tomo(t), fr.reduce_reference(f, "flat"), fr.reduce_reference(f, "dark"))


def normalized(t, *steps):
    v = pixels.normalize(F.col("values"), F.col("dark"), F.col("flat"), *steps)
    return attached(t).select("scan_id", "idx", "row", v.alias("values"))


def logged(t):
    return normalized(t, pixels.minus_log())


# ------------------------------------------------------------ pixelwise chain
@query("normalize", NORMAL + _OUT.format(px6("v"), "nm"))
def _(t):
    return out(normalized(t), "scan_id", "idx", "row")


@query("exposure_scale", NORMAL + _OUT.format(px6("v * 1.25"), "nm"))
def _(t):
    return out(normalized(t, pixels.exposure_scale(1.25)), "scan_id", "idx", "row")


@query("minus_log", NORMAL + _OUT.format(px6("-ln(greatest(v, 0.5))"), "nm"))
def _(t):
    return out(normalized(t, pixels.minus_log(0.5)), "scan_id", "idx", "row")


@query("beam_hardening", NORMAL + _OUT.format(px6("v + 0.004 * v * v * v * v * v"), "ml"))
def _(t):
    return out(normalized(t, pixels.minus_log(), pixels.beam_hardening((0, 1, 0, 0, 0, 0.004))), "scan_id", "idx", "row")


@query("cast_8bit", f"""WITH {b.TILES} SELECT scan_id, idx, row, px, CAST(CASE WHEN idx % 7 = 0 AND px = 0 THEN 0
  ELSE floor(least(greatest(0.5 + 255.0 * (v + 10.0) / 40.0, 0.0), 255.0)) END AS SMALLINT) AS v FROM ti""")
def _(t):
    noisy = F.transform("values", lambda x, i: F.when((F.col("idx") % 7 == 0) & (i == 0), F.lit(float("nan"))).otherwise(x))
    v = pixels.apply(noisy, pixels.cast_8bit(-10, 30))
    return b.tiles(t).select("scan_id", "idx", "row", F.posexplode(v).alias("px", "v"))


_NEAREST = f"""WITH {b.FRAMES}, {SCANS}, loc AS (SELECT scan_id, n, [0, n // 2, n - 1] AS l FROM sc),
bd AS (SELECT scan_id, [0, round_even((l[2] - l[1]) / 2, 0), l[2] + round_even((l[3] - l[2]) / 2, 0)] AS s FROM loc),
fg AS (SELECT scan_id, row, px, least(idx, 2) AS grp, median(v) AS f FROM px WHERE kind = 'flat' GROUP BY ALL),
dk AS (SELECT scan_id, row, px, median(v) AS d FROM px WHERE kind = 'dark' GROUP BY ALL),
tm AS (SELECT p.*, CASE WHEN idx >= s[3] THEN 2 WHEN idx >= s[2] THEN 1 ELSE 0 END AS grp FROM px p JOIN bd USING (scan_id) WHERE kind = 'tomo')"""


@query("normalize_nearest", _NEAREST + f""" SELECT scan_id, idx, row, px, {px6('(v - d) / greatest(f - d, 1e-5)')} AS v
FROM tm JOIN fg USING (scan_id, row, px, grp) JOIN dk USING (scan_id, row, px)""")
def _(t):
    near = fr.attach_nearest(tomo(t), b.frames(t), scans(t))
    v = pixels.normalize(F.col("values"), F.col("dark"), F.col("flat"), floor=1e-5)
    return out(near.select("scan_id", "idx", "row", v.alias("values")), "scan_id", "idx", "row")


@query("nearest_flat_group", _NEAREST + " SELECT DISTINCT scan_id, idx, CAST(grp AS INTEGER) AS grp FROM tm")
def _(t):
    j = tomo(t).join(scans(t), "scan_id")
    return j.select("scan_id", "idx", fr.nearest_group(F.col("idx"), F.col("flat_locations")).alias("grp")).distinct()


@query("pad_crop", f"""WITH {b.TILES}, p AS (SELECT unnest(range(14)) AS px), r AS (SELECT DISTINCT scan_id, idx, row FROM ti)
SELECT r.scan_id, r.idx, r.row, p.px, v, 8 AS kept FROM r JOIN p ON true JOIN ti ON ti.scan_id = r.scan_id AND ti.idx = r.idx AND ti.row = r.row
  AND ti.px = greatest(0, least(7, p.px - 3))""")
def _(t):
    p = b.tiles(t).withColumn("p", pixels.pad_edge(F.col("values"), 3))
    same = F.when(pixels.crop(F.col("p"), 3) == F.col("values"), F.size("values")).otherwise(-1)
    return p.select("scan_id", "idx", "row", same.alias("kept"), F.posexplode("p").alias("px", "v")).withColumn("v", F.col("v").cast("double"))


# ------------------------------------------------------------------ references
@query("attach_references", NORMAL + " SELECT scan_id, idx, row, px, round(f - d, 6) + 0.0 AS v FROM px JOIN fl USING (scan_id, row, px) JOIN dk USING (scan_id, row, px) WHERE kind = 'tomo'")
def _(t):
    v = F.zip_with("flat", "dark", lambda a, c: a - c)
    return out(attached(t).select("scan_id", "idx", "row", v.alias("values")), "scan_id", "idx", "row")


@query("bright_field_scan", NORMAL + """, bs AS (SELECT scan_id, min(scan_id) OVER (PARTITION BY label % 2) AS bright FROM (SELECT DISTINCT scan_id, label FROM nb))
SELECT p.scan_id, p.idx, p.row, p.px, round((p.v - d) / greatest(f - d, 1e-6), 6) + 0.0 AS v FROM px p JOIN bs ON bs.scan_id = p.scan_id
JOIN fl ON fl.scan_id = bs.bright AND fl.row = p.row AND fl.px = p.px JOIN dk ON dk.scan_id = p.scan_id AND dk.row = p.row AND dk.px = p.px WHERE kind = 'tomo'""")
def _(t):
    parity = F.regexp_extract("scan_id", r"scan(\d+)_", 1).cast("int") % 2
    named = scans(t).select("scan_id", parity.alias("par"))
    bright = named.join(named.groupBy("par").agg(F.min("scan_id").alias("bright_scan_id")), "par").drop("par")
    f = b.frames(t)
    j = fr.attach_references(tomo(t), fr.reduce_reference(f, "flat"), fr.reduce_reference(f, "dark"), bright)
    v = pixels.normalize(F.col("values"), F.col("dark"), F.col("flat"))
    return out(j.select("scan_id", "idx", "row", v.alias("values")), "scan_id", "idx", "row")


@query("reduce_reference_mean", f"WITH {b.FRAMES} SELECT scan_id, row, px, round(avg(v), 6) + 0.0 AS v FROM px WHERE kind = 'flat' GROUP BY ALL")
def _(t):
    return out(fr.reduce_reference(b.frames(t), "flat"), "scan_id", "row")


@query("reduce_reference_median", f"WITH {b.FRAMES} SELECT scan_id, row, px, round(median(v), 6) + 0.0 AS v FROM px WHERE kind = 'dark' GROUP BY ALL")
def _(t):
    return out(fr.reduce_reference(b.frames(t), "dark", "median"), "scan_id", "row")


_MEASURED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("ray_quantiles", "WITH px AS (" + " UNION ALL ".join(
    f"SELECT l_returnflag AS scan_id, {i} AS px, CAST({c} AS DOUBLE) AS v FROM lineitem" for i, c in enumerate(_MEASURED)) + """)
  SELECT scan_id, px, round(quantile_cont(v, 0.25), 4) + 0.0 AS v FROM px GROUP BY ALL""")
def _(t):
    """Quartiles of very long series: every line item is a frame of four rays, in three scans."""
    frames = t.lineitem.select(F.col("l_returnflag").alias("scan_id"), F.array(*[F.col(c).cast("double") for c in _MEASURED]).alias("values"))
    found = ray_quantiles(frames, ["scan_id"], 0.25)
    rays = found.select("scan_id", F.posexplode("values").alias("px", "v"))
    return rays.withColumn("v", F.round("v", 4) + F.lit(0.0))


@query("mean_frame", f"WITH {b.FRAMES} SELECT scan_id, row, px, round(avg(v), 6) + 0.0 AS v FROM px WHERE kind = 'dark' GROUP BY ALL")
def _(t):
    g = b.frames(t).filter("kind = 'dark'").groupBy("scan_id", "row").agg(mean_frame()("values").alias("values"))
    return out(g, "scan_id", "row")


@query("ignore_projections", f"WITH {b.FRAMES} SELECT scan_id, idx, row, px, CASE WHEN idx % 5 = 2 THEN 0.0 ELSE v END AS v FROM px WHERE kind = 'tomo'")
def _(t):
    bad = tomo(t).filter("idx % 5 = 2").select("scan_id", "idx")
    df = fr.ignore_projections(tomo(t), bad)
    return df.select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v"))


# -------------------------------------------------------------------- geometry
_GEO = """g AS (SELECT scan_id, max(CASE WHEN key LIKE '%num_angles' THEN num_value END)::INTEGER AS n,
  max(CASE WHEN key LIKE '%rotation/range' THEN num_value END) AS span, max(CASE WHEN key LIKE '%rotation_start' THEN num_value END) AS st,
  max(CASE WHEN key LIKE '%rotation_step' THEN num_value END) AS step, max(CASE WHEN key LIKE '%i0cycle' THEN num_value END)::INTEGER AS c,
  max(CASE WHEN key = '/exchange/theta' THEN num_list END) AS th, max(CASE WHEN key LIKE '%dimension_y' THEN num_list[1] END)::INTEGER AS h FROM meta GROUP BY scan_id),
a AS (SELECT *, unnest(range(CASE WHEN th IS NOT NULL THEN len(th) ELSE n END)) AS idx FROM g),
an AS (SELECT scan_id, CAST(idx AS INTEGER) AS idx, n, h, c, CAST(scan_id AS BIGINT) AS k,
  -radians(CASE WHEN th IS NOT NULL THEN th[idx + 1] WHEN st IS NOT NULL AND step IS NOT NULL THEN st + step * idx ELSE span * idx / (n - 1) END) AS rad FROM a)"""


def meta_scans(t):
    g = catalogue.scan_geometry(b.scan_meta(t))
    theta = fr.angle_list(F.col("numangles"), F.col("theta_deg"), F.col("rotation_start"), F.col("rotation_step"), F.col("angularrange"))
    return g.withColumn("theta", theta)


@query("angle_table", f"WITH {b.META}, {_GEO} SELECT scan_id, idx, {px6('rad')} AS theta FROM an")
def _(t):
    return fr.angle_table(meta_scans(t)).select("scan_id", "idx", six(F.col("theta_rad")).alias("theta"))


@query("stacked_angles", f"""WITH {b.META}, {_GEO} SELECT scan_id, CAST(unnest(range(n)) AS INTEGER) AS idx,
  round(radians(270.0 - c - span * unnest(range(n)) / (n - 1)), 6) + 0.0 AS theta, round(radians(270.0 - unnest(range(n)) * 0.5), 6) + 0.0 AS per_frame FROM g""")
def _(t):
    g = catalogue.scan_geometry(b.scan_meta(t))
    even = fr.stacked_angle_list(F.col("numangles"), F.col("i0cycle").cast("double"), F.col("angularrange"))
    turns = F.transform(F.sequence(F.lit(0), F.col("numangles") - 1), lambda i: i * 0.5)
    each = fr.stacked_angle_list(F.col("numangles"), F.lit(0.0), F.lit(0.0), turns)
    rows = g.select("scan_id", each.alias("e"), F.posexplode(even).alias("idx", "theta"))
    return rows.select("scan_id", "idx", six(F.col("theta")).alias("theta"), six(F.get("e", F.col("idx"))).alias("per_frame"))


@query("timed_angles", f"""WITH {b.META}, {_GEO}, m AS (SELECT scan_id, CASE WHEN th IS NULL THEN n ELSE len(th) END AS n, th, unnest(range(CASE WHEN th IS NULL THEN n ELSE len(th) END)) AS idx FROM g)
SELECT scan_id, CAST(idx AS INTEGER) AS idx, round(radians(CASE WHEN th IS NULL THEN 180.0 * idx / (n - 1) ELSE th[idx + 1] END), 6) + 0.0 AS theta FROM m""")
def _(t):
    g = catalogue.scan_geometry(b.scan_meta(t))
    a = fr.timed_angle_list(F.col("numangles"), F.lit(None).cast("array<double>"), F.col("theta_deg"))
    return g.select("scan_id", F.posexplode(a).alias("idx", "theta")).withColumn("theta", six(F.col("theta")))


@query("flat_groups", f"""WITH {b.META}, {_GEO}, f AS (SELECT scan_id, CASE WHEN c > 0 THEN list_distinct(list_concat(list_filter(range(n), lambda i: i % c = 0), [n - 1]))
  WHEN c = 0 THEN [0, n - 1] END AS l, CASE WHEN c = 0 THEN 1 WHEN c > 0 THEN 2 ELSE 0 END AS tag, n FROM g)
SELECT scan_id, array_to_string(list_sort(l), ',') AS locations, CASE WHEN tag = 1 THEN CAST(n - 1 AS VARCHAR) END AS last_only FROM f""")
def _(t):
    g = catalogue.scan_geometry(b.scan_meta(t))
    n, c = F.col("numangles"), F.col("i0cycle")
    text = F.array_join(values.flat_groups(n, c).cast("array<string>"), ",")
    last = F.array_join(values.flat_groups(n, c, True).cast("array<string>"), ",")
    return g.select("scan_id", text.alias("locations"), F.when(c == 0, last).alias("last_only"))


@query("frame_counts", f"""WITH {b.FRAMES} SELECT scan_id, CAST(count(DISTINCT CASE WHEN kind = 'tomo' THEN idx END) AS INTEGER) AS ntomo,
  CASE WHEN label % 3 = 0 THEN 99 ELSE CAST(count(DISTINCT CASE WHEN kind = 'flat' THEN idx END) AS INTEGER) END AS nflat,
  CAST(count(DISTINCT CASE WHEN kind = 'dark' THEN idx END) AS INTEGER) AS ndark FROM fr JOIN (SELECT DISTINCT scan_id, label FROM nb) USING (scan_id) GROUP BY scan_id, label""")
def _(t):
    label = F.regexp_extract("scan_id", r"scan(\d+)_", 1).cast("int")
    stated = scans(t).filter(label % 3 == 0).select("scan_id", F.lit(99).alias("nflat"), F.lit(None).cast("int").alias("ndark"))
    return fr.frame_counts(b.frames(t), stated)


_SEL = f"""WITH {b.META}, {_GEO}, s AS (SELECT scan_id, n, h, k, CASE WHEN k % 3 = 0 THEN 0 WHEN k % 3 = 1 THEN greatest(-2, 0) ELSE 3 END AS s0,
  CASE WHEN k % 3 = 0 THEN n WHEN k % 3 = 1 THEN least(1000, n) ELSE least(8, n) END AS s1, CASE WHEN k % 3 = 0 THEN 1 ELSE 2 END AS s2,
  CASE WHEN k % 2 = 0 THEN h // 2 - 4 ELSE 0 END AS r0, CASE WHEN k % 2 = 0 THEN h // 2 + 3 ELSE h END AS r1 FROM (SELECT DISTINCT scan_id, n, h, k FROM an)),
c AS (SELECT *, CAST(ceil((s1 - s0) / s2) AS INTEGER) AS cnt FROM s)
SELECT c.scan_id, CAST(s0 AS INTEGER) AS sel_start, CAST(s1 AS INTEGER) AS sel_stop, CAST(s2 AS INTEGER) AS sel_step, cnt AS sel_count, CAST(r0 AS INTEGER) AS row_start,
  CAST(r1 AS INTEGER) AS row_stop, round(abs(b.rad - a.rad), 6) + 0.0 AS sel_range FROM c LEFT JOIN an a ON a.scan_id = c.scan_id AND a.idx = s0
  LEFT JOIN an b ON b.scan_id = c.scan_id AND b.idx = s0 + (cnt - 1) * s2"""


def selection(t):
    k = F.col("scan_id").cast("bigint")
    s = meta_scans(t)
    none = F.lit(None).cast("int")
    s = s.withColumns({
        "p_start": F.when(k % 3 == 0, none).when(k % 3 == 1, -2).otherwise(3), "p_stop": F.when(k % 3 == 1, 1000).otherwise(8),
        "p_step": F.lit(2), "r_start": F.when(k % 2 == 0, -1), "r_stop": F.when(k % 2 == 0, 7), "r_step": F.lit(1)})
    return fr.clamp_selection(s)


@query("clamp_selection", _SEL)
def _(t):
    return selection(t).select("scan_id", "sel_start", "sel_stop", "sel_step", "sel_count", "row_start", "row_stop", six(F.col("sel_range")).alias("sel_range"))


@query("select_frames", f"WITH {b.FRAMES} SELECT scan_id, kind, idx, row FROM fr WHERE row = 1 AND (kind <> 'tomo' OR (idx >= 2 AND idx < 12 AND (idx - 2) % 3 = 0))")
def _(t):
    lits = {"sel_start": 2, "sel_stop": 12, "sel_step": 3, "row_start": 1, "row_stop": 2, "row_step": 1}
    sel = scans(t).select("scan_id", *[F.lit(v).alias(c) for c, v in lits.items()])
    return fr.select_frames(b.frames(t), sel).select("scan_id", "kind", "idx", "row")


@query("central_rows", f"WITH {b.TILES} SELECT scan_id, idx, row, px, v FROM ti WHERE row >= 2 AND row < 5")
def _(t):
    c = values.central_rows(F.lit(8), F.lit(3))
    rows = b.tiles(t).filter((F.col("row") >= c["start"]) & (F.col("row") < c["stop"]))
    return rows.select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v")).withColumn("v", F.col("v").cast("double"))


@query("strided", f"WITH {b.TILES} SELECT DISTINCT scan_id, idx, row FROM ti WHERE idx >= 3 AND idx < 40 AND (idx - 3) % 4 = 0")
def _(t):
    return b.tiles(t).filter(values.strided(F.col("idx"), 3, 40, 4)).select("scan_id", "idx", "row")


@query("chunk_index", f"""WITH {b.NUMBERED} SELECT scan_id, CAST(k // 10 AS INTEGER) AS chunk, count(*) AS n,
  CAST((max(max(k)) OVER (PARTITION BY scan_id)) // 10 + 1 AS INTEGER) AS chunks FROM nb GROUP BY scan_id, k // 10""")
def _(t):
    table = fr.with_chunk(fr.numbered_positions(fr.angle_table(tile_scans(t))), 10)
    total = table.groupBy("scan_id").agg(values.chunk_count(F.count(F.lit(1)), 10).alias("chunks"))
    return table.groupBy("scan_id", "chunk").agg(F.count(F.lit(1)).alias("n")).join(total, "scan_id")


@query("opposing_pair", f"""WITH {b.FRAMES}, {SCANS} SELECT scan_id, idx, row FROM fr JOIN sc USING (scan_id)
WHERE kind = 'tomo' AND (idx = 0 OR idx = CASE WHEN label % 2 = 0 THEN n // 2 - 1 ELSE n - 1 END)""")
def _(t):
    return fr.opposing_pair(b.frames(t), scans(t)).select("scan_id", "idx", "row")


@query("drift_offset", f"WITH {b.NUMBERED}, c AS (SELECT *, count(*) OVER (PARTITION BY scan_id) AS n FROM nb) SELECT scan_id, k AS idx, round(k / (n - 1) * 100.5, 6) + 0.0 AS off_x, round(k / (n - 1) * 7.5, 6) + 0.0 AS off_y FROM c")
def _(t):
    d = fr.drift_offset(fr.angle_table(tile_scans(t)), 100.5, 7.5)
    return d.select("scan_id", "idx", six(F.col("off_x")).alias("off_x"), six(F.col("off_y")).alias("off_y"))


@query("output_number", f"WITH {b.NUMBERED} SELECT scan_id, k AS idx, CAST(5 + 3 * (k - 4) // 2 AS INTEGER) AS number FROM nb WHERE k >= 4 AND k % 2 = 0")
def _(t):
    table = fr.angle_table(tile_scans(t)).filter(values.strided(F.col("idx"), 4, 100000, 2))
    return fr.output_number(table, 5, 3).select("scan_id", "idx", "number")


@query("ordered_stack", f"""WITH {b.SOURCE} SELECT split_part(rel_path, '/', 2) AS scan_id, rel_path AS path,
  row_number() OVER (PARTITION BY split_part(rel_path, '/', 2) ORDER BY rel_path) - 1 AS z FROM src""")
def _(t):
    files = b.source_files(t).select(F.split("rel_path", "/")[1].alias("scan_id"), F.col("rel_path").alias("path"))
    return fr.ordered_stack(files)


@query("ordered_stack_deep", f"""WITH {b.SOURCE}, deep AS (SELECT 'one scan' AS scan_id, repeat('deep/', 40) || rel_path AS path FROM src)
  SELECT scan_id, path, row_number() OVER (ORDER BY path) - 1 AS z FROM deep""")
def _(t):
    """All files in one scan, below a folder of 200 characters."""
    deep = F.concat(F.repeat(F.lit("deep/"), 40), "rel_path")
    return fr.ordered_stack(b.source_files(t).select(F.lit("one scan").alias("scan_id"), deep.alias("path")))


@query("frame_stats", f"""WITH {b.TILES} SELECT scan_id, idx, min(v) AS low, max(v) AS high, round(avg(v), 6) + 0.0 AS mean, count(*) AS pixels,
  round(quantile_cont(v, 0.01), 6) + 0.0 AS q1, round(quantile_cont(v, 0.5), 6) + 0.0 AS q50, round(quantile_cont(v, 0.99), 6) + 0.0 AS q99,
  count(*) FILTER (v >= 0 AND v <= 50) AS upper FROM ti GROUP BY scan_id, idx""")
def _(t):
    s = fr.frame_stats(b.tiles(t), low=-50.0, high=50.0, bins=2)
    return s.withColumns({c: six(F.col(c)) for c in ("mean", "q1", "q50", "q99")}).withColumn("upper", F.get("histogram", 1)).drop("histogram")


@query("build_sinograms", f"""WITH {b.FRAMES} SELECT scan_id, row, CAST(row_number() OVER (PARTITION BY scan_id, row, px ORDER BY idx) - 1 AS INTEGER) AS pos, idx, px, v
FROM px WHERE kind = 'tomo'""")
def _(t):
    s = fr.build_sinograms(tomo(t)).select("scan_id", "row", "idx", F.posexplode("sinogram").alias("pos", "ray"))
    s = s.select("scan_id", "row", "pos", F.get("idx", F.col("pos")).alias("idx"), F.posexplode("ray").alias("px", "v"))
    return s.withColumn("v", F.col("v").cast("double"))


# ------------------------------------------------------------- sources, sinks
@query("frame_scan", f"WITH {b.FRAMES} SELECT scan_id, kind, idx, row, CAST(len(vals) AS INTEGER) AS rays FROM fr WHERE kind = 'tomo' AND row = 1 AND idx >= 1 AND idx < 11 AND (idx - 1) % 2 = 0")
def _(t):
    where = scratch_dir(t.spark, "frames")
    sinks.write_frames(b.frames(t), where)
    df = readers.read_frames(t.spark, where, ["tomo"], proj=(1, 11, 2), rows=(1, 2, 1))
    return df.select("scan_id", "kind", "idx", "row", F.size("values").alias("rays"))


@query("stack_sink", f"""WITH {b.FRAMES} SELECT scan_id, scan_id || '_' || lpad(CAST(10 + 2 * idx AS VARCHAR), 5, '0') || '_norm' AS file_name, row FROM fr WHERE kind = 'tomo'""")
def _(t):
    where = scratch_dir(t.spark, "stack")
    sinks.write_stack(tomo(t), where, F.col("scan_id"), "idx", 10, 2, "_norm")
    return t.spark.read.parquet(where).select("scan_id", "file_name", "row")


@query("pyramid_sink", f"""WITH {b.NUMBERED}, s AS (SELECT scan_id, max(k) + 1 AS n FROM nb GROUP BY scan_id),
l AS (SELECT scan_id, n, level FROM s JOIN (SELECT unnest(range(4)) AS level) ON level = 0 OR least(n, 8) > pow(2, level - 1))
SELECT scan_id, CAST(level AS INTEGER) AS level, CAST(ceil(n / pow(2, level)) * 8 / pow(2, level) AS BIGINT) AS lines, 1.25 * pow(2, level) AS scale_um FROM l""")
def _(t):
    where = scratch_dir(t.spark, "pyramid")
    levels, scales = pyramid.multires_pyramid(volume(t), tile_scans(t), min_size=1)
    sinks.write_pyramid(levels, scales, where)
    back = t.spark.read.parquet(f"{where}/levels").groupBy("scan_id", "level").agg(F.count(F.lit(1)).alias("lines"))
    sc = t.spark.read.parquet(f"{where}/scales").filter("axis = 'x'").select("scan_id", "level", "scale_um")
    return back.join(sc, ["scan_id", "level"])


# -------------------------------------------------------------------- outliers
_MED = """md AS (SELECT scan_id, idx, row, px, v, list_sort([v, coalesce(lag(v) OVER w, lead(v) OVER w, v), coalesce(lead(v) OVER w, lag(v) OVER w, v)])[2] AS m
  FROM px WHERE kind = 'tomo' WINDOW w AS (PARTITION BY scan_id, row, px ORDER BY idx))"""


@query("angular_median", f"WITH {b.FRAMES}, {_MED} SELECT scan_id, idx, row, px, m AS v FROM md")
def _(t):
    m = imaging.angular_median(tomo(t), chunk=8)
    return m.select("scan_id", "idx", "row", F.posexplode("median").alias("px", "v"))


@query("remove_outlier_1d", f"WITH {b.FRAMES}, {_MED} SELECT scan_id, idx, row, px, CASE WHEN abs(v - m) >= 40 THEN m ELSE v END AS v FROM md")
def _(t):
    return imaging.remove_outlier_1d(tomo(t), 40, chunk=8).select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v"))


_OFFS = "o AS (SELECT unnest([-1, 0, 1]) AS d)"


@query("remove_outlier_2d", f"""WITH {b.TILES}, {_OFFS}, m AS (SELECT a.scan_id, a.idx, a.row, a.px, a.v, list_sort(list(n.v))[5] AS m FROM ti a JOIN o y ON true JOIN o x ON true
  JOIN ti n ON n.scan_id = a.scan_id AND n.idx = a.idx AND n.row = greatest(0, least(7, a.row + y.d)) AND n.px = greatest(0, least(7, a.px + x.d)) GROUP BY ALL)
SELECT scan_id, idx, row, px, CASE WHEN v - m >= 10 THEN m ELSE v END AS v FROM m""")
def _(t):
    return imaging.remove_outlier_2d(b.tiles(t), 10).select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v"))


# --------------------------------------------------------------------- stripes
@query("stripe_smoothing", NORMAL + f""", m AS (SELECT scan_id, row, px, avg(v) AS m FROM ml GROUP BY ALL),
s AS (SELECT a.scan_id, a.row, a.px, a.m - avg(n.m) AS r FROM m a JOIN (SELECT unnest(range(-2, 3)) AS d) o ON true
  JOIN m n ON n.scan_id = a.scan_id AND n.row = a.row AND n.px = greatest(0, least(63, a.px + d)) GROUP BY a.scan_id, a.row, a.px, a.m)
SELECT scan_id, idx, row, px, {px6('v - r')} AS v FROM ml JOIN s USING (scan_id, row, px)""")
def _(t):
    return out(imaging.stripe_smoothing(logged(t)), "scan_id", "idx", "row")


@query("stripe_titarenko")
def _(t):
    return out(imaging.stripe_titarenko(logged(t)), "scan_id", "idx", "row")


@query("stripe_titarenko_blocks")
def _(t):
    return out(imaging.stripe_titarenko(logged(t), nblock=2), "scan_id", "idx", "row")


@query("stripe_fourier_wavelet")
def _(t):
    return out(imaging.stripe_fourier_wavelet(logged(t)), "scan_id", "idx", "row")


# -------------------------------------------------------------------- geometry
def _bilinear_sql(y, x):
    return f"""WITH {b.TILES}, c AS (SELECT scan_id, idx, row, px, greatest(0.0, least(7.0, {y})) AS y, greatest(0.0, least(7.0, {x})) AS x FROM ti),
f AS (SELECT *, floor(y)::BIGINT AS y0, floor(x)::BIGINT AS x0, y - floor(y) AS fy, x - floor(x) AS fx FROM c), o AS (SELECT unnest([0, 1]) AS d)
SELECT f.scan_id, f.idx, f.row, f.px, round(sum(n.v * CASE oy.d WHEN 0 THEN 1 - fy ELSE fy END * CASE ox.d WHEN 0 THEN 1 - fx ELSE fx END), 6) + 0.0 AS v
FROM f JOIN o oy ON true JOIN o ox ON true JOIN ti n ON n.scan_id = f.scan_id AND n.idx = f.idx AND n.row = least(7, y0 + oy.d) AND n.px = least(7, x0 + ox.d)
GROUP BY f.scan_id, f.idx, f.row, f.px"""


@query("correct_tilt", _bilinear_sql("3.5 + sin(radians(3.0)) * (px - 3.5) + cos(radians(3.0)) * (row - 3.5)",
                                     "3.5 + cos(radians(3.0)) * (px - 3.5) - sin(radians(3.0)) * (row - 3.5)"))
def _(t):
    return out(imaging.correct_tilt(b.tiles(t), 3.0), "scan_id", "idx", "row")


_R = "sqrt((px - 3.0) * (px - 3.0) + (row - 4.0) * (row - 4.0))"


@query("lens_distortion", _bilinear_sql(f"4.0 + (1.0 + 0.01 * {_R} + 0.001 * {_R} * {_R}) * (row - 4.0)",
                                        f"3.0 + (1.0 + 0.01 * {_R} + 0.001 * {_R} * {_R}) * (px - 3.0)"))
def _(t):
    return out(imaging.lens_distortion(b.tiles(t), (3.0, 4.0), (1.0, 0.01, 0.001)), "scan_id", "idx", "row")


_PAIR = f"""WITH {b.FRAMES}, {SCANS}, a AS (SELECT scan_id, idx, row, list(v ORDER BY px) AS a FROM px JOIN sc USING (scan_id) WHERE kind = 'tomo' AND idx < n // 2 GROUP BY ALL),
c AS (SELECT scan_id, idx - n // 2 AS idx, row, list(v ORDER BY px) AS b FROM px JOIN sc USING (scan_id) WHERE kind = 'tomo' AND idx >= n // 2 AND idx < 2 * (n // 2) GROUP BY scan_id, idx, n, row),
j AS (SELECT scan_id, CAST(idx AS INTEGER) AS idx, row, a, b, unnest(range(108)) AS px FROM a JOIN c USING (scan_id, idx, row))"""


@query("join_half_turns", _PAIR + """ SELECT scan_id, idx, row, px, round(CASE WHEN px < 44 THEN a[px + 1] WHEN px >= 64 THEN b[44 - (px - 64)]
  ELSE (19.5 - (px - 44)) / 20 * a[px + 1] + (0.5 + (px - 44)) / 20 * b[64 - (px - 44)] END, 6) + 0.0 AS v FROM j""")
def _(t):
    return out(imaging.join_half_turns(tomo(t), scans(t)), "scan_id", "idx", "row")


@query("join_half_turns_left", _PAIR + """ SELECT scan_id, idx, row, px, round(CASE WHEN px < 44 THEN b[64 - px] WHEN px >= 64 THEN a[px - 64 + 21]
  ELSE (px - 44 + 0.5) / 20 * a[px - 44 + 1] + (19.5 - (px - 44)) / 20 * b[20 - (px - 44)] END, 6) + 0.0 AS v FROM j""")
def _(t):
    return out(imaging.join_half_turns(tomo(t), scans(t), "left"), "scan_id", "idx", "row")


@query("phase_retrieval")
def _(t):
    return out(imaging.phase_retrieval(b.tiles(t), tile_scans(t)), "scan_id", "idx", "row")


def _moved_sql(right, down, extra=""):
    return f"""WITH {b.TILES}, m AS (SELECT ti.*, {right} AS dx, {down} AS dy FROM ti {extra})
SELECT m.scan_id, m.idx, m.row, m.px, coalesce(s.v, 0.0) AS v FROM m LEFT JOIN ti s ON s.scan_id = m.scan_id AND s.idx = m.idx AND s.row = m.row - dy AND s.px = m.px - dx"""


_PART = "JOIN (SELECT scan_id, max(k) AS last FROM nb GROUP BY scan_id) USING (scan_id)"


@query("drift_correction", _moved_sql("round_even(idx / last * 9.4, 0)::BIGINT", "round_even(-(idx / last * 3.3), 0)::BIGINT", _PART))
def _(t):
    offsets = fr.drift_offset(fr.angle_table(tile_scans(t)), 9.4, 3.3)
    d = imaging.drift_correction(b.tiles(t), offsets, tile_scans(t), interpolate=False)
    return d.select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v"))


@query("drift_correction_bilinear", f"""WITH {b.TILES}, o AS (SELECT unnest([0, 1]) AS d), m AS (SELECT ti.*, row + idx / last * 0.5 AS y, px - idx / last * 1.5 AS x FROM ti {_PART}),
f AS (SELECT *, floor(y)::BIGINT AS y0, floor(x)::BIGINT AS x0, y - floor(y) AS fy, x - floor(x) AS fx FROM m)
SELECT f.scan_id, f.idx, f.row, f.px, round(sum(CASE oy.d WHEN 0 THEN 1 - fy ELSE fy END * CASE ox.d WHEN 0 THEN 1 - fx ELSE fx END * coalesce(s.v, 0.0)), 6) + 0.0 AS v
FROM f JOIN o oy ON true JOIN o ox ON true LEFT JOIN ti s ON s.scan_id = f.scan_id AND s.idx = f.idx AND s.row = y0 + oy.d AND s.px = x0 + ox.d
GROUP BY f.scan_id, f.idx, f.row, f.px""")
def _(t):
    offsets = fr.drift_offset(fr.angle_table(tile_scans(t)), 1.5, 0.5)
    return out(imaging.drift_correction(b.tiles(t), offsets, tile_scans(t)), "scan_id", "idx", "row")


@query("translate", _moved_sql("2", "-1"))
def _(t):
    d = imaging.translate(b.tiles(t), tile_scans(t), 2.7, 1.2, interpolate=False)
    return d.select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v"))


@query("translate_bilinear", f"""WITH {b.TILES}, o AS (SELECT unnest([0, 1]) AS d), g AS (SELECT a.scan_id, a.idx, a.row, a.px,
  CASE oy.d WHEN 0 THEN 0.25 ELSE 0.75 END * 0.5 * coalesce(s.v, 0.0) AS p FROM ti a JOIN o oy ON true JOIN o ox ON true
  LEFT JOIN ti s ON s.scan_id = a.scan_id AND s.idx = a.idx AND s.row = a.row + oy.d AND s.px = a.px - 2 + ox.d)
SELECT scan_id, idx, row, px, round(sum(p), 6) + 0.0 AS v FROM g GROUP BY ALL""")
def _(t):
    return out(imaging.translate(b.tiles(t), tile_scans(t), 1.5, 0.75), "scan_id", "idx", "row")


@query("unspiral", f"""WITH {b.TILES}, l AS (SELECT DISTINCT scan_id, idx, floor(4 - idx * 0.0625)::BIGINT AS li, (4 - idx * 0.0625) - floor(4 - idx * 0.0625) AS fc FROM ti), r AS (SELECT unnest(range(3)) AS r)
SELECT a.scan_id, a.idx, CAST(r AS INTEGER) AS row, a.px, round((1 - fc) * a.v + fc * c.v, 6) + 0.0 AS v FROM l JOIN r ON true
JOIN ti a ON a.scan_id = l.scan_id AND a.idx = l.idx AND a.row = li + r JOIN ti c ON c.scan_id = l.scan_id AND c.idx = l.idx AND c.row = li + r + 1 AND c.px = a.px""")
def _(t):
    return out(imaging.unspiral(b.tiles(t), tile_scans(t), 0.0625, 3), "scan_id", "idx", "row")


# -------------------------------------------------------------- reconstruction
def _cos_h(n):
    return f"cos(2 * pi() * k * {n} / 256)"


_FBP = NORMAL + f""", {SCANS}, hk AS (SELECT k, (k / 256.0) / (1 + pow(k / 256.0 / 0.25, 4)) * CASE WHEN k IN (0, 128) THEN 1 ELSE 2 END / 256 AS h FROM (SELECT unnest(range(129)) AS k)),
h AS (SELECT n, sum(h * {_cos_h('n')}) AS h FROM hk JOIN (SELECT unnest(range(256)) AS n) ON true GROUP BY n),
pad AS (SELECT m.scan_id, m.idx, m.row, p.i AS j, m.v FROM (SELECT unnest(range(90)) AS i) p JOIN ml m ON m.px = greatest(0, least(63, p.i - 13))),
q AS (SELECT scan_id, idx, row, i, sum(v * h) AS q FROM pad JOIN (SELECT unnest(range(90)) AS i) ON true JOIN h ON h.n = (i - j + 256) % 256 GROUP BY ALL),
xy AS (SELECT y, x FROM (SELECT unnest(range(64)) AS y) JOIN (SELECT unnest(range(64)) AS x) ON true WHERE (x - 32) * (x - 32) + (y - 32) * (y - 32) < 1024),
tt AS (SELECT scan_id, n, idx, y, x, (x - 31.5) * cos(pi() * idx / n) + (y - 31.5) * sin(pi() * idx / n) + 44.5 AS t
  FROM (SELECT scan_id, n, unnest(range(n)) AS idx FROM sc) JOIN xy ON true),
bp AS (SELECT a.scan_id, a.row, y, x, sum(pi() / n * ((1 - (t - floor(t))) * a.q + (t - floor(t)) * coalesce(c.q, 0))) AS v FROM tt
  JOIN q a ON a.scan_id = tt.scan_id AND a.idx = tt.idx AND a.i = floor(t)::BIGINT
  LEFT JOIN q c ON c.scan_id = tt.scan_id AND c.idx = tt.idx AND c.row = a.row AND c.i = floor(t)::BIGINT + 1 GROUP BY ALL)
SELECT scan_id, CAST(row AS INTEGER) AS z, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS px, round(v / 0.125, 6) + 0.0 AS v FROM bp"""


def circle():
    return F.expr("(px - 32) * (px - 32) + (y - 32) * (y - 32) < 1024")


@query("reconstruct", _FBP)
def _(t):
    s = recon.reconstruct(logged(t), scans(t), "fbp", angle_chunk=8)
    return out(s, "scan_id", "z", "y").filter(circle())


@query("reconstruct_gridding")
def _(t):
    return out(recon.reconstruct(logged(t), scans(t)), "scan_id", "z", "y")


def slices(t):
    return recon.reconstruct(logged(t), scans(t))


@query("polar_ring")
def _(t):
    return out(recon.polar_ring(slices(t)), "scan_id", "z", "y")


@query("center_phase_corr")
def _(t):
    return center.center_phase_corr(b.frames(t), scans(t))


@query("center_vo")
def _(t):
    return center.center_vo(logged(t), reach=31, drop=4)  # half of 64 rays; scans of 18 angles have 17 frequencies


@query("center_entropy")
def _(t):
    return center.center_entropy(logged(t), scans(t))


@query("center_skip", f"WITH {b.NUMBERED} SELECT DISTINCT scan_id, 32.0::DOUBLE AS center FROM nb")
def _(t):
    return center.find_center("skip", b.frames(t), scans(t))


# --------------------------------------------------------- pictures, pyramids
@query("thumbnail_stretch", f"""WITH {b.TILES}, m AS (SELECT *, min(v) OVER w AS lo, max(v) OVER w AS hi FROM ti WINDOW w AS (PARTITION BY scan_id, idx)),
g AS (SELECT scan_id, idx, row, px, floor(205.0 * ln(v - lo + 1.001) / ln(hi - lo + 1.001))::INTEGER AS g FROM m),
c AS (SELECT scan_id, idx, g, count(*) AS n FROM g GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY scan_id, idx ORDER BY g) AS up, sum(n) OVER (PARTITION BY scan_id, idx ORDER BY g DESC) AS dn, floor(sum(n) OVER (PARTITION BY scan_id, idx) * 5.0 / 100) AS cut FROM c),
e AS (SELECT scan_id, idx, min(CASE WHEN up > cut THEN g END) AS l, max(CASE WHEN dn > cut THEN g END) AS h FROM u GROUP BY ALL)
SELECT scan_id, idx, row, px, CAST(CASE WHEN h <= l THEN g ELSE greatest(0, least(255, floor(g * (255.0::DOUBLE / (h - l)) + -l * (255.0::DOUBLE / (h - l))))) END AS SMALLINT) AS v FROM g JOIN e USING (scan_id, idx)""")
def _(t):
    return imaging.thumbnail_stretch(b.tiles(t), 5.0).select("scan_id", "idx", "row", F.posexplode("values").alias("px", "v"))


def volume(t):
    return b.tiles(t).select("scan_id", F.col("idx").alias("z"), F.col("row").alias("y"), "values")


_KERNEL = "(VALUES " + ", ".join(f"({k - 2}, {w!r}::DOUBLE)" for k, w in enumerate(pyramid.kernel())) + ") w{a}(d{a}, w{a})"


def _level_sql(k):
    """Level ``k`` from the level before it, of the scans whose smallest side was still above one."""
    side, sides = 8 >> (k - 1), 8 >> k

    def halved(name, source, axis, others, last):
        return (f"{name}{k} AS (SELECT {others}, m AS {axis}, sum(v * w{axis}) AS v FROM (SELECT unnest(range({sides})) AS m) "
                f"JOIN {_KERNEL.format(a=axis)} ON true JOIN {source} p ON p.{axis} = greatest(0, least({last}, 2 * m + d{axis})) GROUP BY ALL)")

    return f""",
h{k} AS (SELECT scan_id, unnest(range(last // 2 + 1)) AS m, last FROM (SELECT scan_id, CAST(ceil(n / {2 ** (k - 1)}) AS BIGINT) - 1 AS last FROM s WHERE least(n, 8) > {2 ** (k - 1)})),
{halved("x", f"l{k - 1}", "x", "scan_id, z, y", side - 1)},
{halved("y", f"x{k}", "y", "scan_id, z, x", side - 1)},
l{k} AS (SELECT h.scan_id, m AS z, y, x, sum(v * wz) AS v FROM h{k} h JOIN {_KERNEL.format(a='z')} ON true
  JOIN y{k} p ON p.scan_id = h.scan_id AND p.z = greatest(0, least(last, 2 * m + dz)) GROUP BY ALL)"""


_LEVELS = f"""WITH {b.TILES}, s AS (SELECT scan_id, max(k) + 1 AS n FROM nb GROUP BY scan_id),
l0 AS (SELECT scan_id, idx AS z, row AS y, px AS x, v FROM ti)""" + "".join(_level_sql(k) for k in (1, 2, 3))


@query("multires_pyramid", _LEVELS + " UNION ALL ".join(
    f" SELECT scan_id, {k} AS level, CAST(z AS INTEGER) AS z, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS px, round(v, 6) + 0.0 AS v FROM l{k}"
    for k in range(4)))
def _(t):
    """Every level down to a single line."""
    levels, _ = pyramid.multires_pyramid(volume(t), tile_scans(t), min_size=1)
    return out(levels, "scan_id", "level", "z", "y")


@query("pyramid_boxes", _LEVELS + " UNION ALL ".join(
    f" SELECT 'box' || scan_id || '_{k}' AS box_id, {k} AS level, CAST(z AS INTEGER) AS z, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS px, round(v, 6) + 0.0 AS v"
    f" FROM l{k} WHERE z >= {5 >> k} AND z < {5 >> k} + 9 AND y >= 1 AND x < {8 >> k} - 1" for k in range(4)))
def _(t):
    """Every level written as bricks; one box of each scan and level read back from the files that hold it."""
    where = scratch_dir(t.spark, "bricks")
    levels, scales = pyramid.multires_pyramid(volume(t), tile_scans(t), min_size=1)
    bricks.write_bricks(levels, where, edge=3)
    level = F.col("level")
    low, side = F.expr("shiftright(5, level)"), F.expr("shiftright(8, level)")
    boxes = scales.filter("axis = 'x'").select(
        F.concat(F.lit("box"), "scan_id", F.lit("_"), level).alias("box_id"), "scan_id", "level", low.alias("z0"), (low + 9).alias("z1"),
        F.lit(1).alias("y0"), F.lit(99).alias("y1"), F.lit(-2).alias("x0"), (side - 1).alias("x1"))
    got = bricks.read_boxes(t.spark, where, boxes)
    px = got.select("box_id", "level", "z", "y", "x0", F.posexplode("values").alias("at", "v"))
    return px.select("box_id", "level", "z", "y", (F.col("x0") + F.col("at")).alias("px"), six(F.col("v")).alias("v"))


# ------------------------------------------------------------ chain and kernels
@query("correction_chain", NORMAL + f""", {_MED.replace('WHERE kind', "WHERE kind")}, ds AS (SELECT scan_id, idx, row, px, CASE WHEN abs(v - m) >= 40 THEN m ELSE v END AS v FROM md),
cn AS (SELECT ds.scan_id, ds.idx, ds.row, ds.px, -ln(greatest((v - d) / greatest(f - d, 1e-6) * 1.5, 0.01)) AS v FROM ds JOIN dk USING (scan_id, row, px) JOIN fl USING (scan_id, row, px))
SELECT scan_id, idx, row, px, {px6('v + 0.004 * v * v * v * v * v')} AS v FROM cn""")
def _(t):
    s = chain.Settings.of("outlier_1d", "beam_hardening", "normalized_out", without=("reconstruct", "stripe_fourier_wavelet"),
                          outlier_dif=40, exposure_ratio=1.5)
    return out(chain.run(b.frames(t), scans(t), s).normalized, "scan_id", "idx", "row")


@query("default_chain")
def _(t):
    return out(chain.run(b.frames(t), scans(t)).slices, "scan_id", "z", "y")


@query("searched_chain")
def _(t):
    """Every second scan comes without a centre, which is searched in its first and opposing projection."""
    own = F.regexp_extract("scan_id", r"scan(\d+)_", 1).cast("int") % 2 == 0
    held = scans(t).withColumn("cor", F.when(own, F.col("cor")))
    s = chain.Settings.of(without=("stripe_fourier_wavelet",), method="fbp", center="pc")
    return out(chain.run(b.frames(t), held, s).slices, "scan_id", "z", "y")


@query("chain_issues", f"""WITH {b.FRAMES}, {SCANS}, tm AS (SELECT scan_id, label, idx, row, n // 2 AS h FROM fr JOIN sc USING (scan_id)
  WHERE kind = 'tomo' AND NOT (label % 2 = 0 AND idx = 1)),
hp AS (SELECT scan_id, CASE WHEN idx < 2 * h THEN idx % h ELSE idx END AS place, count(DISTINCT idx) AS halves FROM tm WHERE label % 5 NOT IN (1, 2) GROUP BY 1, 2)
SELECT scan_id, 'error' AS severity, CAST(count(*) AS VARCHAR) || ' detector rows without flat or dark' AS msg FROM tm WHERE label % 3 = 0 AND row = 1 GROUP BY 1
UNION ALL SELECT DISTINCT scan_id, 'error', CASE label % 5 WHEN 1 THEN 'no geometry' ELSE 'no centre of rotation' END FROM tm WHERE label % 5 IN (1, 2)
UNION ALL SELECT scan_id, 'warning', CAST(count(*) AS VARCHAR) || ' projections without an opposite one' FROM hp WHERE halves = 1 GROUP BY 1""")
def _(t):
    """What a run leaves out: rows without flats, scans without geometry or centre, half turns without their other half."""
    label = F.regexp_extract("scan_id", r"scan(\d+)_", 1).cast("int")
    lost = ((label % 3 == 0) & (F.col("row") == 1) & (F.col("kind") == "flat")) | ((label % 2 == 0) & (F.col("idx") == 1) & (F.col("kind") == "tomo"))
    held = scans(t).filter(label % 5 != 1).withColumn("cor", F.when(label % 5 != 2, F.col("cor")))
    return chain.run(b.frames(t).filter(~lost), held, chain.Settings.of("half_turn")).issues.select("scan_id", "severity", "msg")


@query("grouped_kernel", f"WITH {b.TILES} SELECT scan_id, idx, row, px, round(v - avg(v) OVER (PARTITION BY scan_id, idx), 6) + 0.0 AS v FROM ti")
def _(t):
    k = grouped_kernel(b.tiles(t).select("scan_id", "idx", "row", "values"), PROJECTION, lambda a, _: a - a.mean())
    return out(k, "scan_id", "idx", "row")
