"""How the given tables stand in for inventories, logs, metadata and frames.

Every binding exists twice: as a DataFrame and as the SQL of a common table
expression for the checks.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------- inventories
_REL_PATH = """
concat('raw/BLS-', lpad(cast(o_custkey % 100000 as {s}), 5, '0'), '_user', cast(o_custkey % 50 as {s}), '/',
  {day}, '_scan', cast(o_orderkey as {s}),
  case when o_orderkey % 13 = 0 then concat('_x', lpad(cast(o_orderkey % 4 as {s}), 2, '0'),
    'y', lpad(cast(o_orderkey % 3 as {s}), 2, '0')) else '' end, '.h5')
"""
_REL_SPARK = _REL_PATH.format(s="string", day="date_format(o_orderdate, 'yyyyMMdd_HHmmss')")
_REL_DUCK = _REL_PATH.format(s="varchar", day="strftime(o_orderdate, '%Y%m%d_%H%M%S')")


def source_files(t) -> DataFrame:
    return t.orders.select(
        F.lit("A").alias("endpoint_key"),
        F.expr(_REL_SPARK).alias("rel_path"),
        F.lit("file").alias("type"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
        F.col("o_orderdate").alias("last_modified"),
        F.expr("concat(o_orderstatus, ':', cast(o_orderkey as string))").alias("checksum"),
        "o_orderkey", "o_custkey",
    )


def check_files(t) -> DataFrame:
    stale = F.col("o_orderkey") % 11 == 0
    return (
        source_files(t).filter(F.col("o_orderkey") % 7 != 0)
        .withColumn("endpoint_key", F.lit("B"))
        .withColumn("last_modified", F.col("last_modified") + F.expr("interval 1 day"))
        .withColumn("checksum", F.when(stale, "stale").otherwise(F.col("checksum")))
    )


SOURCE = f"""src AS (SELECT {_REL_DUCK} AS rel_path, CAST(round(o_totalprice * 100) AS BIGINT) AS size,
  o_orderdate AS last_modified, concat(o_orderstatus, ':', CAST(o_orderkey AS VARCHAR)) AS checksum,
  o_orderkey, o_custkey FROM orders)"""
CHECK = """chk AS (SELECT rel_path, size, last_modified + INTERVAL 1 DAY AS last_modified,
  CASE WHEN o_orderkey % 11 = 0 THEN 'stale' ELSE checksum END AS checksum, o_orderkey, o_custkey
  FROM src WHERE o_orderkey % 7 <> 0)"""


# ------------------------------------------------------------------ transfers
def endpoints(t) -> DataFrame:
    return t.supplier.selectExpr(
        "concat('ep', cast(s_suppkey as string)) as endpoint_key", "s_name as name",
        "cast(s_suppkey as string) as uuid", "concat('ep', cast(s_suppkey as string), '.example.org') as uri",
        "concat('/data/', cast(s_nationkey as string), case when s_suppkey % 2 = 0 then '/' else '' end) as root_path",
    )


ENDPOINTS = """ep AS (SELECT concat('ep', CAST(s_suppkey AS VARCHAR)) AS endpoint_key, s_name AS name,
  concat('/data/', CAST(s_nationkey AS VARCHAR), CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END) AS root_path
  FROM supplier)"""

_TASK = "concat(cast(l_orderkey as {s}), '-', cast(l_linenumber as {s}), '-', cast(l_partkey as {s}), '-', cast(l_suppkey as {s}))"
_DST = "concat('ep', cast(l_suppkey - l_suppkey % 10 + (l_suppkey + 1) % 10 as {s}))"
_MOVED = """concat('ep', cast(l_suppkey as {s})) as src_key,
concat('raw/f', cast(l_orderkey as {s}), '_', cast(l_linenumber as {s}), '.h5') as rel_path,
case when l_returnflag = 'R' then 'FAILED' else 'SUCCEEDED' end as status,
cast(round(l_quantity * 1000000) as bigint) as bytes,
case when l_linenumber <> 3 then cast(round(l_quantity * 1000000) as bigint) end as bytes_checksummed,
cast(l_linenumber as bigint) as files,
case when l_linenumber <> 5 then l_extendedprice end as eff_bps,
l_shipdate as start_ts"""


def transfers(t) -> DataFrame:
    head = f"{_TASK.format(s='string')} as task_id|{_DST.format(s='string')} as dst_key"
    body = [x.strip() for x in _MOVED.format(s="string").split(",\n")]
    end = F.timestamp_micros(F.unix_micros("l_shipdate") + (1 + F.round(F.col("l_tax") * 1000)).cast("bigint") * 1000000)
    return t.lineitem.withColumn("end_ts", end).selectExpr(*head.split("|"), *body, "end_ts")


TRANSFERS = f"""tr AS (SELECT {_TASK.format(s='varchar')} AS task_id, {_DST.format(s='varchar')} AS dst_key,
{_MOVED.format(s='varchar')},
l_shipdate + to_seconds(CAST(1 + round(l_tax * 1000) AS BIGINT)) AS end_ts FROM lineitem)"""


# ----------------------------------------------------------------------- logs
_STATE = """case event_type when 'signup' then 'PENDING' when 'view' then 'RUNNING' when 'click' then 'NOT_FOUND'
 when 'purchase' then 'COMPLETED' else 'FAILED' end"""
_STATUS = "case event_type when 'purchase' then 'SUCCEEDED' when 'signup' then 'FAILED' else 'ACTIVE' end"
_NICE = """case when event_type = 'error' and value > 200 then 'FILE_NOT_FOUND'
 when event_type = 'error' then 'PERMISSION_DENIED' else 'OK' end"""


def job_events(t) -> DataFrame:
    return t.events.selectExpr("user_id as job_id", "event_id", "ts", f"{_STATE} as state")


def task_events(t) -> DataFrame:
    return t.events.selectExpr("user_id as task_id", "event_id", "ts", f"{_STATUS} as status", f"{_NICE} as nice_status")


JOB_EVENTS = f"je AS (SELECT user_id AS job_id, event_id, ts, {_STATE} AS state FROM events)"
TASK_EVENTS = f"te AS (SELECT user_id AS task_id, event_id, ts, {_STATUS} AS status, {_NICE} AS nice_status FROM events)"


# ------------------------------------------------------------------- metadata
# (key, kind, Spark SQL, check SQL where it differs); null means the key is absent
_M = "/measurement/"
_P = "/process/acquisition/"
_META = [
    (_M + "instrument/instrument_name", "s", "case when c_custkey % 10 = 0 then '' else concat('inst', cast(c_nationkey as varchar(20))) end", None),
    (_M + "sample/experiment/beamline", "S", "array(case when c_custkey % 4 = 0 then 'bl832' else n_name end)",
     "[case when c_custkey % 4 = 0 then 'bl832' else n_name end]"),
    (_M + "sample/experiment/pi", "s", "case when c_custkey % 9 <> 0 then c_name end", None),
    (_M + "sample/experiment/proposal", "s", "case when c_custkey % 5 = 0 then 'None' else concat('BLS-', lpad(cast(c_custkey as varchar(20)), 5, '0')) end", None),
    (_M + "sample/experimenter/email", "s", """concat(' "', lower(c_name), case when c_custkey % 6 = 0 then '' else ' @ lab.example' end, '", ')""", None),
    (_M + "sample/file_name", "s", "case when c_custkey % 17 <> 0 then concat(c_mktsegment, '_scan.', cast(c_custkey as varchar(20)), '-x') end", None),
    (_M + "instrument/detector/model", "s", "concat('cam', cast(c_custkey % 3 as varchar(20)))", None),
    (_M + "instrument/detector/temperature", "n", "case when c_custkey % 8 <> 0 then cast(c_custkey % 40 as double) / 4 end", None),
    (_M + "instrument/detector/dimension_x", "N", "array(cast(64 + c_custkey % 100 as double))", "[cast(64 + c_custkey % 100 as double)]"),
    (_M + "instrument/detector/dimension_y", "N", "array(cast(32 + c_custkey % 5 as double))", "[cast(32 + c_custkey % 5 as double)]"),
    (_M + "instrument/detector/pixel_size", "n", "cast(1 + c_custkey % 4 as double) / 64", None),
    (_M + "instrument/camera_motor_stack/setup/camera_distance", "N",
     "case when c_custkey % 4 = 1 then array(0.0D, 75.0D) else array(50.0D) end",
     "case when c_custkey % 4 = 1 then [0.0::double, 75.0::double] else [50.0::double] end"),
    (_M + "instrument/monochromator/energy", "N",
     "case when c_custkey % 50 = 0 then array(2000000.0D) when c_custkey % 7 = 0 then array(0.0D, 25000.0D) else array(cast(24000 + c_custkey % 100 as double)) end",
     "case when c_custkey % 50 = 0 then [2000000.0::double] when c_custkey % 7 = 0 then [0.0::double, 25000.0::double] else [cast(24000 + c_custkey % 100 as double)] end"),
    (_M + "instrument/detector/exposure_time", "N",
     "transform(sequence(0, cast(c_custkey % 35 as int)), i -> cast(i * 2 + 1 as double))",
     "list_transform(range(0, c_custkey % 35 + 1), lambda i: cast(i * 2 + 1 as double))"),
    ("/exchange/theta", "N",
     "case when c_custkey % 6 = 0 then transform(sequence(0, cast(9 + c_custkey % 20 as int)), i -> cast(i * 2 as double)) end",
     "case when c_custkey % 6 = 0 then list_transform(range(0, 10 + c_custkey % 20), lambda i: cast(i * 2 as double)) end"),
    (_P + "rotation/num_angles", "n", "cast(10 + c_custkey % 20 as double)", None),
    (_P + "rotation/range", "n", "case when c_custkey % 3 = 0 then cast(360 as double) else cast(180 as double) end", None),
    (_P + "rotation/rotation_start", "n", "case when c_custkey % 2 = 0 then cast(c_custkey % 5 as double) end", None),
    (_P + "rotation/rotation_step", "n", "case when c_custkey % 2 = 0 then cast(0.5 as double) end", None),
    (_P + "flat_fields/i0cycle", "n", "cast(c_custkey % 7 - 1 as double)", None),
    (_P + "flat_fields/num_flat_fields", "n", "cast(5 as double)", None),
    (_P + "dark_fields/num_dark_fields", "n", "cast(3 as double)", None),
]
_KINDS = {"s": "str_value", "n": "num_value", "S": "str_list", "N": "num_list"}
_TYPES = {"str_value": "string", "num_value": "double", "str_list": "array<string>", "num_list": "array<double>"}
_DUCK_TYPES = {"str_value": "VARCHAR", "num_value": "DOUBLE", "str_list": "VARCHAR[]", "num_list": "DOUBLE[]"}


def scan_meta(t) -> DataFrame:
    nation = t.nation.select("n_nationkey", "n_name")
    base = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = []
    for key, kind, sql, _ in _META:
        cols = [
            (F.expr(sql.replace("varchar(20)", "string")) if _KINDS[kind] == c else F.lit(None)).cast(ty).alias(c)
            for c, ty in _TYPES.items()
        ]
        rows.append(F.struct(F.lit(key).alias("key"), *cols))
    long = base.select(F.col("c_custkey").cast("string").alias("scan_id"), F.explode(F.array(*rows)).alias("m"))
    return long.select("scan_id", "m.*").filter(F.coalesce(
        F.col("str_value").isNotNull(), F.lit(False)) | F.col("num_value").isNotNull()
        | F.col("str_list").isNotNull() | F.col("num_list").isNotNull())


def _meta_sql() -> str:
    parts = []
    for key, kind, sql, duck in _META:
        cols = ", ".join(
            f"CAST({(duck or sql) if _KINDS[kind] == c else 'NULL'} AS {ty}) AS {c}" for c, ty in _DUCK_TYPES.items()
        )
        parts.append(f"SELECT CAST(c_custkey AS VARCHAR) AS scan_id, '{key}' AS key, {cols} FROM cn")
    body = "\nUNION ALL ".join(parts)
    return f"""cn AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
meta AS (SELECT * FROM ({body}) WHERE str_value IS NOT NULL OR num_value IS NOT NULL
  OR str_list IS NOT NULL OR num_list IS NOT NULL)"""


META = _meta_sql()


def scan_files(t) -> DataFrame:
    return t.customer.selectExpr(
        "cast(c_custkey as string) as scan_id",
        "concat('/data/raw/', cast(c_nationkey as string), '/scan', cast(c_custkey as string), '.h5') as path",
        "abs(cast(round(c_acctbal * 100) as bigint)) as size",
        "timestampadd(MINUTE, cast(c_custkey % 500000 as int), timestamp'2001-01-01 00:00:00') as last_modified",
    )


SCAN_FILES = """sf AS (SELECT CAST(c_custkey AS VARCHAR) AS scan_id,
  concat('/data/raw/', CAST(c_nationkey AS VARCHAR), '/scan', CAST(c_custkey AS VARCHAR), '.h5') AS path,
  abs(CAST(round(c_acctbal * 100) AS BIGINT)) AS size,
  TIMESTAMP '2001-01-01 00:00:00' + to_minutes(CAST(c_custkey % 500000 AS BIGINT)) AS last_modified FROM customer)"""


def order_files(t) -> DataFrame:
    """Several files per scan: the orders of a customer."""
    return source_files(t).select(
        F.col("o_custkey").cast("string").alias("scan_id"),
        F.concat(F.lit("/data/"), "rel_path").alias("path"), "size", "last_modified",
    )


ORDER_FILES = """of AS (SELECT CAST(o_custkey AS VARCHAR) AS scan_id, concat('/data/', rel_path) AS path,
  size, last_modified FROM src)"""


# ---------------------------------------------------------------------- specs
_LINE = """concat('scan', cast(conv_id as {s}), '.h5 cor ', cast(turn as {s}), '.5 sinoused "-1,', cast(turn as {s}),
 ',1" outputFilename ', role, case when conv_id % 3 = 0 then ' cor 7' else '' end)"""


def specs(t) -> DataFrame:
    return t.conversations.selectExpr("conv_id", "turn", f"{_LINE.format(s='string')} as line")


SPECS = f"sp AS (SELECT conv_id, turn, {_LINE.format(s='varchar')} AS line FROM conversations)"


# --------------------------------------------------------------------- frames
# Vectors of one label and one block of 500 ids make a scan, so the number of
# scans grows with the table and each scan stays of bounded size.
def _numbered(t) -> DataFrame:
    block = F.floor(F.col("vec_id") / 500).cast("int")
    w = Window.partitionBy("label", "block").orderBy("vec_id")
    name = F.concat(F.lit("scan"), F.col("label").cast("string"), F.lit("_"), F.col("block").cast("string"))
    return (
        t.embeddings.withColumn("block", block)
        .withColumn("k", (F.row_number().over(w) - 1).cast("int"))
        .withColumn("scan_id", name)
    )


def frames(t) -> DataFrame:
    """Detector rows of 64 rays: two rows, two darks, four flats, the rest projections."""
    k = F.col("k")
    kind = F.when(k < 4, "dark").when(k < 12, "flat").otherwise("tomo")
    first = F.when(k < 4, 0).when(k < 12, 4).otherwise(12)
    base = F.when(k < 4, 20.0).when(k < 12, 900.0).otherwise(500.0)
    gain = F.when(k < 4, 10.0).when(k < 12, 100.0).otherwise(400.0)
    return _numbered(t).withColumn("base", base).withColumn("gain", gain).select(
        "scan_id", kind.alias("kind"), F.floor((k - first) / 2).cast("int").alias("idx"),
        (k % 2).cast("int").alias("row"),
        F.expr("transform(embedding, x -> cast(base + gain * cast(x as double) as float))").alias("values"),
    )


NUMBERED = """nb AS (SELECT *, 'scan' || CAST(label AS VARCHAR) || '_' || CAST(vec_id // 500 AS VARCHAR) AS scan_id,
  CAST(row_number() OVER (PARTITION BY label, vec_id // 500 ORDER BY vec_id) - 1 AS INTEGER) AS k FROM embeddings)"""
FRAMES = NUMBERED + """,
fr AS (SELECT scan_id, CASE WHEN k < 4 THEN 'dark' WHEN k < 12 THEN 'flat' ELSE 'tomo' END AS kind,
  CAST((k - CASE WHEN k < 4 THEN 0 WHEN k < 12 THEN 4 ELSE 12 END) // 2 AS INTEGER) AS idx, k % 2 AS row,
  list_transform(embedding, lambda x: CAST(CASE WHEN k < 4 THEN 20.0 WHEN k < 12 THEN 900.0 ELSE 500.0 END
    + CASE WHEN k < 4 THEN 10.0 WHEN k < 12 THEN 100.0 ELSE 400.0 END * CAST(x AS DOUBLE) AS FLOAT)) AS vals FROM nb),
px AS (SELECT scan_id, kind, idx, row, unnest(range(len(vals))) AS px, CAST(unnest(vals) AS DOUBLE) AS v FROM fr)"""


def tiles(t) -> DataFrame:
    """The same vectors as frames of 8 rows by 8 rays, one vector per projection."""
    return (
        _numbered(t).select("scan_id", F.lit("tomo").alias("kind"), F.col("k").alias("idx"), "embedding",
                            F.explode(F.sequence(F.lit(0), F.lit(7))).alias("row"))
        .withColumn("values", F.expr("transform(slice(embedding, row * 8 + 1, 8), x -> cast(100 * cast(x as double) as float))"))
        .drop("embedding")
    )


TILES = NUMBERED + """,
ti AS (SELECT scan_id, k AS idx, i // 8 AS row, i % 8 AS px, CAST(CAST(100 * CAST(x AS DOUBLE) AS FLOAT) AS DOUBLE) AS v
  FROM (SELECT scan_id, k, unnest(range(64)) AS i, unnest(embedding) AS x FROM nb))"""
