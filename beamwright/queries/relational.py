"""Joins, aggregates, windows and set operations over the given tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.functions import paths, text, values
from beamwright.operators import catalogue, digests, intervals, inventory, jobs, retention, routing, transfers
from beamwright.plans import deletions, registry
from beamwright.queries import bindings as b
from beamwright.queries.core import NOW, now, query, stamp
from beamwright.session import scratch_dir
from beamwright.sources import readers, sinks

# ------------------------------------------------------------------ inventory
_VERDICT = f"""CASE WHEN src.rel_path IS NULL THEN 'SOURCE_MISSING' WHEN chk.rel_path IS NULL THEN 'NO_SECOND_COPY'
  WHEN NOT chk.last_modified < TIMESTAMP '{NOW}' - INTERVAL 1000 DAY THEN 'TOO_NEW' ELSE 'PRUNE' END"""


def both(t):
    cols = ["endpoint_key", "rel_path", "last_modified"]
    return b.source_files(t).select(*cols).unionByName(b.check_files(t).select(*cols))


def prune_requests(t):
    """Every source file, plus requests for paths that do not exist."""
    files = b.source_files(t).select("rel_path", F.lit("A").alias("source"), F.lit("B").alias("check"))
    ghosts = t.customer.select(F.concat(F.lit("raw/ghost"), "c_custkey").alias("rel_path"), F.lit("A").alias("source"), F.lit("B").alias("check"))
    return files.unionByName(ghosts)


def guarded(t, days=1000):
    return inventory.prune_guard(prune_requests(t), both(t), now(), days)


@query("prune_guard", f"""WITH {b.SOURCE}, {b.CHECK}, rq AS (SELECT rel_path FROM src UNION ALL
  SELECT 'raw/ghost' || CAST(c_custkey AS VARCHAR) FROM customer)
SELECT rq.rel_path, {_VERDICT} AS verdict FROM rq LEFT JOIN src USING (rel_path) LEFT JOIN chk ON chk.rel_path = rq.rel_path""")
def _(t):
    return guarded(t).select("rel_path", "verdict")


def tiers(t):
    """The three places of a file: all on the first, most on the second, fewer on the third, each a day later than before."""
    cols = ["endpoint_key", "rel_path", "last_modified"]
    third = b.check_files(t).filter("o_orderkey % 3 <> 0").withColumn("last_modified", F.col("last_modified") + F.expr("interval 1 day"))
    named = [(b.source_files(t), "spot832"), (b.check_files(t), "data832"), (third, "nersc832")]
    return reduce(DataFrame.unionByName, [f.withColumn("endpoint_key", F.lit(k)).select(*cols) for f, k in named])


def tier_config(t):
    """One configuration row per place, roots by variables."""
    names = [(k, {"name": k, "root_path": root}) for k, root in (("spot832", "${BASE}/spot/"), ("data832", "${BASE}/data"), ("nersc832", "/cfs"))]
    return t.spark.createDataFrame(names, "endpoint_key string, props map<string,string>")


_TIERS = """tr AS (SELECT 'spot832' AS k, rel_path, last_modified FROM src UNION ALL SELECT 'data832', rel_path, last_modified FROM chk
  UNION ALL SELECT 'nersc832', rel_path, last_modified + INTERVAL 1 DAY FROM chk WHERE o_orderkey % 3 <> 0)"""


@query("prune_plan", f"""WITH {b.SOURCE}, {b.CHECK}, {_TIERS},
pl AS (SELECT loc, src.rel_path, root || src.rel_path AS path, src.size, src.last_modified + to_days(days) AS due,
  CASE WHEN own.rel_path IS NULL THEN 'SOURCE_MISSING' WHEN cp.rel_path IS NULL THEN 'NO_SECOND_COPY'
    WHEN cp.last_modified < TIMESTAMP '{NOW}' - INTERVAL 1000 DAY THEN 'PRUNE' ELSE 'TOO_NEW' END AS verdict
  FROM src JOIN (VALUES ('spot832', 'data832', 2, '/als/spot/'), ('data832', 'nersc832', 3, '/als/data/')) v(loc, other, days, root) ON true
  LEFT JOIN tr own ON own.k = loc AND own.rel_path = src.rel_path LEFT JOIN tr cp ON cp.k = other AND cp.rel_path = src.rel_path
  WHERE src.last_modified < TIMESTAMP '{NOW}' - INTERVAL 1000 DAY)
SELECT loc AS endpoint_key, rel_path, CASE verdict WHEN 'PRUNE' THEN 'PRUNE' ELSE 'KEEP' END AS action, path, size, verdict,
  strftime(CAST(due AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS due_at, 'delete ' || loc || ': ' || split_part(rel_path, '/', 3) AS run_name FROM pl""")
def _(t):
    """Which stale files may go from which place because the next place holds a copy, and when: written, then read back."""
    where = scratch_dir(t.spark, "deletions")
    registry_ = inventory.endpoint_registry(tier_config(t), {"BASE": "/als"})
    sinks.write_plan(deletions.deletion_plan(b.source_files(t), tiers(t), registry_, "move", now(), 1000), where)
    return t.spark.read.parquet(where).select(
        "endpoint_key", "rel_path", "action", "path", "size", "verdict", stamp("due_at").alias("due_at"), "run_name")


@query("present_on", f"WITH {b.SOURCE}, {b.CHECK} SELECT rel_path FROM src SEMI JOIN chk USING (rel_path)")
def _(t):
    return inventory.present_on(b.source_files(t), b.check_files(t)).select("rel_path")


@query("missing_on", f"WITH {b.SOURCE}, {b.CHECK} SELECT rel_path FROM src ANTI JOIN chk USING (rel_path)")
def _(t):
    return inventory.missing_on(b.source_files(t), b.check_files(t)).select("rel_path")


@query("with_check_copy", f"""WITH {b.SOURCE}, {b.CHECK} SELECT src.rel_path, CASE WHEN src.o_orderkey % 3 <> 0
  THEN chk.rel_path IS NOT NULL END AS check_found FROM src LEFT JOIN chk USING (rel_path)""")
def _(t):
    rq = b.source_files(t).select("rel_path", F.when(F.col("o_orderkey") % 3 != 0, "B").alias("check"))
    return inventory.with_check_copy(rq, both(t)).select("rel_path", "check_found")


@query("sync_plan", f"""WITH {b.SOURCE}, {b.CHECK} SELECT src.rel_path, CASE WHEN chk.rel_path IS NULL THEN 'COPY_NEW'
  WHEN src.checksum IS NOT DISTINCT FROM chk.checksum THEN 'SKIP_SAME' ELSE 'COPY_CHANGED' END AS action
FROM src LEFT JOIN chk USING (rel_path)""")
def _(t):
    return inventory.sync_plan(b.source_files(t), b.check_files(t)).select("rel_path", "action")


@query("sync_plan_tree", f"""WITH {b.SOURCE}, {b.CHECK}, pl AS (SELECT src.rel_path, CASE WHEN chk.rel_path IS NULL THEN 'COPY_NEW'
  WHEN src.checksum IS NOT DISTINCT FROM chk.checksum THEN 'SKIP_SAME' ELSE 'COPY_CHANGED' END AS action FROM src LEFT JOIN chk USING (rel_path))
SELECT rel_path, action, bool_or(action <> 'SKIP_SAME') OVER (PARTITION BY regexp_replace(rel_path, '/[^/]*$', '')) AS compared FROM pl""")
def _(t):
    return digests.tree_sync_plan(b.source_files(t), b.check_files(t)).select("rel_path", "action", "compared")


@query("expand_directories", f"""WITH {b.SOURCE}, rq AS (SELECT DISTINCT 'raw/BLS-' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')
  || '_user' || CAST(c_custkey % 50 AS VARCHAR) AS dir_path FROM customer)
SELECT dir_path, rel_path, '/dest/' || regexp_replace(rel_path, '^raw/', '') AS dest_path
FROM src JOIN rq ON starts_with(rel_path, dir_path || '/')""")
def _(t):
    rq = t.customer.select(
        F.expr("concat('raw/BLS-', lpad(cast(c_custkey % 100000 as string), 5, '0'), '_user', cast(c_custkey % 50 as string))").alias("dir_path"),
        F.lit("/dest/").alias("dest")).distinct()
    return inventory.expand_directories(rq, b.source_files(t)).select("dir_path", "rel_path", "dest_path")


@query("expand_directories_deep", f"""WITH {b.SOURCE}, deep AS (SELECT repeat('d/', 28) || rel_path AS rel_path FROM src), rq AS (
  SELECT DISTINCT repeat('d/', 28) || 'raw/BLS-' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || '_user' || CAST(c_custkey % 50 AS VARCHAR) AS dir_path FROM customer
  UNION ALL SELECT 'd' UNION ALL SELECT repeat('d/', 14) || 'd')
SELECT dir_path, rel_path, '/dest/' || substr(rel_path, length(regexp_replace(dir_path, '[^/]+$', '')) + 1) AS dest_path
FROM deep JOIN rq ON starts_with(rel_path, dir_path || '/')""")
def _(t):
    """Folders 30 levels deep; requests for the lowest, for the highest and for one half-way."""
    below = lambda path: F.concat(F.lit("d/" * 28), path)
    lowest = t.customer.select(below(F.expr(
        "concat('raw/BLS-', lpad(cast(c_custkey % 100000 as string), 5, '0'), '_user', cast(c_custkey % 50 as string))")).alias("dir_path")).distinct()
    higher = t.spark.createDataFrame([("d",), ("d/" * 14 + "d",)], "dir_path string")
    rq = lowest.unionByName(higher).withColumn("dest", F.lit("/dest/"))
    files = b.source_files(t).withColumn("rel_path", below(F.col("rel_path")))
    return intervals.expand_directories(rq, files).select("dir_path", "rel_path", "dest_path")


@query("safe_paths", f"WITH {b.SOURCE}, {b.CHECK} SELECT rel_path FROM src INTERSECT SELECT rel_path FROM chk")
def _(t):
    return inventory.safe_paths(b.source_files(t), b.check_files(t))


@query("unsafe_paths", f"WITH {b.SOURCE}, {b.CHECK} SELECT rel_path FROM src EXCEPT ALL SELECT rel_path FROM chk")
def _(t):
    return inventory.unsafe_paths(b.source_files(t), b.check_files(t))


@query("prune_batch", f"""WITH {b.SOURCE} SELECT 'ep' || CAST(o_custkey % 4 AS VARCHAR) AS source, count(*) AS files,
  count(*) AS listed, count(DISTINCT rel_path) AS paths FROM src GROUP BY 1""")
def _(t):
    plan = b.source_files(t).select(F.concat(F.lit("ep"), F.col("o_custkey") % 4).alias("source"), "rel_path")
    batches = inventory.prune_batch(plan, 500)
    listed = batches.select("source", F.explode("paths").alias("p")).groupBy("source").agg(F.countDistinct("p").alias("paths"))
    return inventory.prune_totals(batches).join(listed, "source")


# ------------------------------------------------------------------ retention
def stage_paths(t):
    """The paths each scan file leaves behind, by kind; some steps did not run."""
    f = b.source_files(t).withColumns({"_stem": paths.stem(F.col("rel_path")), "_folder": paths.parent_name(F.col("rel_path"))})
    p = paths.recon_paths_of(F.col("_folder"), F.col("_stem"))
    ok = F.col("o_orderkey") % 6 != 0
    kinds = [("raw", p["raw_path"]), ("tiff", p["tiff_path"]), ("zarr", F.when(ok, p["zarr_path"])),
             ("nersc tiff", F.when(~ok, p["tiff_path"])), ("nersc zarr", F.lit("")), ("file", F.col("rel_path"))]
    rows = F.array(*[F.struct(F.lit(k).alias("path_kind"), v.alias("path")) for k, v in kinds])
    return f.select("o_orderkey", F.col("last_modified").alias("created_at"), F.explode(rows).alias("r")).select(
        "o_orderkey", "created_at", "r.*")


_PATHS = b.SOURCE + """, q AS (SELECT o_orderkey, rel_path, last_modified AS created_at, split_part(rel_path, '/', 2) AS f,
  regexp_replace(split_part(rel_path, '/', 3), '\\.h5$', '') AS s FROM src),
pk AS (SELECT o_orderkey, created_at, 'raw' AS path_kind, f || '/' || s || '.h5' AS path FROM q
  UNION ALL SELECT o_orderkey, created_at, 'tiff', f || '/rec' || s || '/' FROM q
  UNION ALL SELECT o_orderkey, created_at, 'zarr', CASE WHEN o_orderkey % 6 <> 0 THEN f || '/rec' || s || '.zarr/' END FROM q
  UNION ALL SELECT o_orderkey, created_at, 'nersc tiff', CASE WHEN o_orderkey % 6 = 0 THEN f || '/rec' || s || '/' END FROM q
  UNION ALL SELECT o_orderkey, created_at, 'nersc zarr', '' FROM q
  UNION ALL SELECT o_orderkey, created_at, 'file', rel_path FROM q)"""


def _lit(v):
    return "NULL" if v is None else f"'{v}'"


_RULES = ", rules AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(_lit(v) for v in r) + f", {fixed.RETENTION_DAYS[r[3]]})" for r in fixed.RETENTION_RULES
) + ") v(flow, path_kind, location, delay_key, source, \"check\", days))"
_SCHEDULE = "WITH " + _PATHS + _RULES + """ SELECT flow, path_kind, location, path, source, "check",
  strftime(CAST(created_at + to_days(days) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS due_at,
  'delete ' || location || ': ' || regexp_extract(path, '([^/]+)/*$', 1) AS run_name
FROM pk JOIN rules USING (path_kind) WHERE coalesce(path, '') <> ''"""
_SCHED_COLS = ["flow", "path_kind", "location", "path", "source", "check", "due_at", "run_name"]


@query("retention_schedule", _SCHEDULE + " AND flow = 'alcf'")
def _(t):
    return retention.retention_schedule(stage_paths(t), "alcf").withColumn("due_at", stamp("due_at")).select(*_SCHED_COLS)


@query("union_schedules", _SCHEDULE)
def _(t):
    p = stage_paths(t)
    out = retention.union_schedules(retention.retention_schedule(p, "alcf", "nersc"), retention.retention_schedule(p, "move"))
    return out.withColumn("due_at", stamp("due_at")).select(*_SCHED_COLS)


@query("scheduled_only", f"WITH {_PATHS} SELECT path_kind, count(*) AS n FROM pk WHERE coalesce(path, '') <> '' GROUP BY 1")
def _(t):
    return retention.scheduled_only(stage_paths(t)).groupBy("path_kind").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------- routing
def new_files(t):
    return b.source_files(t).select(
        F.concat(F.lit("/global/"), "rel_path").alias("file_path"), "o_orderkey", "last_modified", "size",
        (F.col("o_orderkey") % 4 == 0).alias("is_export_control"), (F.col("o_orderkey") % 9 != 0).alias("send_offsite"))


@query("offsite_eligible", f"WITH {b.SOURCE} SELECT o_orderkey FROM src WHERE NOT (o_orderkey % 4 = 0) AND o_orderkey % 9 <> 0")
def _(t):
    return routing.offsite_eligible(new_files(t)).select("o_orderkey")


_FLOWS = list(fixed.FLOW_PARAMETERS)


@query("route", f"""WITH {b.SOURCE}, fl AS (SELECT * FROM (VALUES ('{_FLOWS[0]}', 1, NULL), ('{_FLOWS[1]}', 0, NULL),
  ('stray/flow', 1, 'unknown flow stray/flow')) v(flow, run_order, error))
SELECT o_orderkey, flow, run_order, error FROM src JOIN fl ON true""")
def _(t):
    decisions = {_FLOWS[0]: True, _FLOWS[1]: True, _FLOWS[2]: False, "stray/flow": True}
    return routing.route(new_files(t), decisions).select("o_orderkey", "flow", "run_order", "error")


def runs(t):
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", (k % 5 != 0).alias("copy_in"), (k % 7 != 0).alias("recon"), (k % 11 != 0).alias("pyramid"),
                           (k % 3 != 0).alias("tiff_back"), (k % 2 != 0).alias("zarr_back"))


_STOP = """CASE WHEN k % 5 = 0 THEN 'copy_in' WHEN k % 7 = 0 THEN 'recon' WHEN k % 11 = 0 THEN 'pyramid' END"""


@query("flow_outcome", f"""WITH r AS (SELECT o_orderkey AS k FROM orders) SELECT k AS o_orderkey, {_STOP} AS stopped_at,
  {_STOP} IS NULL AS success, CASE WHEN {_STOP} IS NULL THEN 3 ELSE 1 END AS copies, {_STOP} IS NULL AS schedules_prune,
  {_STOP} IS NULL AND k % 3 <> 0 AS prune_tiff_copy, {_STOP} IS NULL AND k % 2 <> 0 AS prune_zarr_copy FROM r""")
def _(t):
    return routing.flow_outcome(runs(t)).drop("copy_in", "recon", "pyramid", "tiff_back", "zarr_back")


@query("flow_outcome_ungated", """SELECT o_orderkey, o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AS success, 4 AS copies, true AS schedules_prune,
  NULL::VARCHAR AS stopped_at FROM orders""")
def _(t):
    return routing.flow_outcome(runs(t), gated=False).select("o_orderkey", "stopped_at", "success", "copies", "schedules_prune")


# ------------------------------------------------------------------ transfers
_DUR = "(epoch_us(end_ts) - epoch_us(start_ts)) / 1000000"
_ROOT = "CASE WHEN ends_with({r}, '/') THEN {r} ELSE {r} || '/' END"
_ROUTED = f"""{b.TRANSFERS}, {b.ENDPOINTS}, ro AS (SELECT tr.*, d.name AS machine, {_ROOT.format(r='s.root_path')} || rel_path AS local_path,
  {_ROOT.format(r='d.root_path')} || rel_path AS remote_path FROM tr LEFT JOIN ep s ON src_key = s.endpoint_key
  LEFT JOIN ep d ON dst_key = d.endpoint_key)"""


def routed(t):
    return transfers.resolve_route(b.transfers(t), b.endpoints(t))


@query("resolve_route", f"WITH {_ROUTED} SELECT task_id, local_path, remote_path, machine FROM ro")
def _(t):
    return routed(t).select("task_id", "local_path", "remote_path", "machine")


@query("succeeded_info", f"""WITH {b.TRANSFERS} SELECT task_id, CASE WHEN status = 'SUCCEEDED' THEN bytes END AS bytes,
  CASE WHEN status = 'SUCCEEDED' THEN coalesce(bytes_checksummed, 0) END AS checked, CASE WHEN status = 'SUCCEEDED'
  THEN coalesce(eff_bps, 0) END AS speed FROM tr""")
def _(t):
    i = transfers.succeeded_info(b.transfers(t))
    return i.select("task_id", F.col("info.bytes").alias("bytes"), F.col("info.bytes_checksummed").alias("checked"),
                    F.col("info.eff_bps").alias("speed"))


@query("metric_records", f"""WITH {_ROUTED} SELECT task_id, strftime(start_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
  strftime(end_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS end_timestamp, local_path, remote_path, bytes AS bytes_transferred,
  {_DUR} AS duration_seconds, eff_bps AS transfer_speed, CASE status WHEN 'SUCCEEDED' THEN 'success' ELSE 'failed' END AS status,
  machine FROM ro WHERE bytes > 0""")
def _(t):
    return transfers.metric_records(routed(t)).drop("end_ts")


@query("metric_gate", f"WITH {b.TRANSFERS} SELECT task_id FROM tr WHERE bytes > 0")
def _(t):
    return transfers.metric_gate(b.transfers(t)).select("task_id")


@query("machine_gauges", f"""WITH {_ROUTED} SELECT machine, arg_max(bytes, (end_ts, task_id)) AS bytes_transferred,
  arg_max({_DUR}, (end_ts, task_id)) AS duration_seconds FROM ro WHERE bytes > 0 GROUP BY machine""")
def _(t):
    return transfers.machine_gauges(transfers.metric_records(routed(t))).select("machine", "bytes_transferred", "duration_seconds")


@query("execution_totals", f"""WITH {_ROUTED} SELECT machine, count(*) AS requests, sum(bytes)::BIGINT AS total_bytes
  FROM ro WHERE bytes > 0 GROUP BY ROLLUP (machine)""")
def _(t):
    return transfers.execution_totals(transfers.metric_records(routed(t)))


@query("transfer_summary", f"""WITH {b.TRANSFERS} SELECT dst_key, sum(bytes)::BIGINT AS bytes, sum(bytes_checksummed)::BIGINT AS bytes_checksummed,
  sum(files)::BIGINT AS files, round(avg(eff_bps), 4) AS mean_speed, sum({_DUR}) AS seconds, count(*) FILTER (status = 'SUCCEEDED') AS succeeded,
  count(*) FILTER (status = 'FAILED') AS failed, round(sum(bytes) / sum({_DUR}), 4) AS speed FROM tr GROUP BY dst_key""")
def _(t):
    s = transfers.transfer_summary(b.transfers(t), ["dst_key"])
    return s.withColumns({"mean_speed": F.round("mean_speed", 4), "speed": F.round("speed", 4)})


_TIMEOUT = """v AS (SELECT te.*, CASE WHEN status IN ('SUCCEEDED', 'FAILED') THEN 'COMPLETED'
  WHEN epoch_us(ts) - epoch_us(f) > 600000000 THEN 'TIMEOUT' WHEN nice_status IN ('FILE_NOT_FOUND', 'PERMISSION_DENIED') THEN 'CANCELLED' END AS verdict
  FROM (SELECT *, min(ts) OVER (PARTITION BY task_id) AS f FROM te) te)"""


@query("task_timeout", f"""WITH {b.TASK_EVENTS}, {_TIMEOUT}, f AS (SELECT task_id, count(*) AS polls,
  arg_min(verdict, (ts, event_id)) FILTER (verdict IS NOT NULL) AS v, arg_min(status, (ts, event_id)) FILTER (verdict IS NOT NULL) AS s
  FROM v GROUP BY task_id)
SELECT task_id, polls, coalesce(v, 'WAITING') AS verdict, coalesce(v = 'COMPLETED', false) AS completed, coalesce(s = 'SUCCEEDED', false) AS succeeded FROM f""")
def _(t):
    return transfers.task_timeout(b.task_events(t)).drop("elapsed")


# ----------------------------------------------------------------------- jobs
@query("latest_block", f"""WITH {b.JOB_EVENTS} SELECT job_id, arg_max(state, (ts, event_id)) AS state, max(event_id) AS last_id FROM je GROUP BY job_id""")
def _(t):
    ev = b.job_events(t)
    return jobs.latest_block(ev, ["state"]).join(ev.groupBy("job_id").agg(F.max("event_id").alias("last_id")), "job_id")


@query("state_transitions", f"""WITH {b.JOB_EVENTS}, l AS (SELECT *, lag(state) OVER (PARTITION BY job_id ORDER BY ts, event_id) AS previous FROM je)
SELECT job_id, event_id, state, previous FROM l WHERE state IS DISTINCT FROM previous""")
def _(t):
    return jobs.state_transitions(b.job_events(t)).select("job_id", "event_id", "state", "previous")


_RUNS = """g AS (SELECT *, sum(CASE WHEN state <> 'NOT_FOUND' THEN 1 ELSE 0 END) OVER w AS g FROM je WINDOW w AS (PARTITION BY job_id ORDER BY ts, event_id)),
rr AS (SELECT *, CASE WHEN state = 'NOT_FOUND' THEN sum(CASE WHEN state = 'NOT_FOUND' THEN 1 ELSE 0 END)
  OVER (PARTITION BY job_id, g ORDER BY ts, event_id) ELSE 0 END AS retries FROM g)"""


@query("retry_runs", f"""WITH {b.JOB_EVENTS}, {_RUNS} SELECT job_id, event_id, retries::BIGINT AS retries,
  CASE WHEN retries > 5 THEN 'LOST' END AS verdict FROM rr""")
def _(t):
    return jobs.retry_runs(b.job_events(t)).select("job_id", "event_id", "retries", "verdict")


@query("job_verdicts", f"""WITH {b.JOB_EVENTS}, {_RUNS}, c AS (SELECT *, CASE WHEN state = 'COMPLETED' THEN 'SUCCESS' WHEN state = 'FAILED' THEN 'FAILURE'
  WHEN retries > 5 THEN 'LOST' END AS call FROM rr)
SELECT job_id, coalesce(arg_min(call, (ts, event_id)) FILTER (call IS NOT NULL), 'RUNNING') AS outcome FROM c GROUP BY job_id""")
def _(t):
    return jobs.job_verdicts(b.job_events(t)).select("job_id", "outcome")


@query("stage_durations", f"""WITH {b.JOB_EVENTS} SELECT job_id, state, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS seconds,
  count(*) AS events FROM je GROUP BY ALL""")
def _(t):
    return jobs.stage_durations(b.job_events(t), ["job_id", "state"])


# ------------------------------------------------------------------ catalogue
def _keys_sql(keys):
    return "(VALUES " + ", ".join(f"('{k}')" for k in keys) + ") k(key)"


@query("extract_fields", f"""WITH {b.META} SELECT scan_id, key, str_value FROM meta
  SEMI JOIN (SELECT DISTINCT key FROM {_keys_sql(fixed.CATALOGUE_KEYS)}) USING (key)""")
def _(t):
    return catalogue.extract_fields(b.scan_meta(t), fixed.CATALOGUE_KEYS).select("scan_id", "key", "str_value")


_MISSING = """SELECT scan_id, 'warning' AS severity, 'dataset not found ' || key AS msg FROM sf JOIN {k} ON true
  ANTI JOIN meta USING (scan_id, key)"""


@query("missing_fields", f"WITH {b.META}, {b.SCAN_FILES} " + _MISSING.format(k=_keys_sql(fixed.SCIENTIFIC_KEYS)))
def _(t):
    return catalogue.missing_fields(b.scan_files(t), b.scan_meta(t), fixed.SCIENTIFIC_KEYS).drop("exception")


@query("distinct_keys", f"""WITH {b.META} SELECT key, count(*) AS scans FROM meta
  SEMI JOIN (SELECT DISTINCT key FROM {_keys_sql(fixed.SCIENTIFIC_KEYS)}) USING (key) GROUP BY key""")
def _(t):
    return catalogue.extract_fields(b.scan_meta(t), fixed.SCIENTIFIC_KEYS).groupBy("key").agg(F.count(F.lit(1)).alias("scans"))


_PIVOT = """pv AS (SELECT scan_id, max(CASE WHEN key LIKE '%instrument_name' THEN str_value END) AS inst,
  max(CASE WHEN key LIKE '%experiment/beamline' THEN str_list[1] END) AS bl, max(CASE WHEN key LIKE '%experiment/pi' THEN str_value END) AS pi,
  max(CASE WHEN key LIKE '%experiment/proposal' THEN str_value END) AS pr,
  max(CASE WHEN key LIKE '%file_name' THEN str_value END) AS fn FROM meta GROUP BY scan_id)"""
_DATASET = f"""WITH {b.META}, {b.SCAN_FILES}, {_PIVOT}, t AS (SELECT *,
  array_to_string(list_transform(list_filter(string_split_regex(coalesce(fn, ''), '[^a-zA-Z0-9]'), lambda x: length(x) > 0), lambda x: lower(x)), ' ') AS terms
  FROM sf LEFT JOIN pv USING (scan_id))
SELECT scan_id, coalesce(nullif(pi, ''), 'Unknown') AS owner, coalesce(nullif(inst, ''), 'Unknown') AS creation_location, fn AS dataset_name,
  'raw' AS type, pr AS proposal_id, 'DX' AS data_format, regexp_replace(path, '/[^/]+$', '') AS source_folder, size,
  coalesce(terms, '') AS description, false AS is_published, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS creation_time,
  CASE WHEN pr IN ('', 'None') THEN '8.3.2' ELSE pr END AS owner_group, bl || '|8.3.2' AS access_groups FROM t"""


def records(t):
    return catalogue.dataset_records(b.scan_meta(t), b.scan_files(t))


@query("dataset_records", _DATASET)
def _(t):
    return records(t).select(
        "scan_id", "owner", "creation_location", "dataset_name", "type", "proposal_id", "data_format", "source_folder", "size",
        "description", "is_published", stamp("creation_time").alias("creation_time"), "owner_group",
        F.array_join("access_groups", "|").alias("access_groups"))


@query("scientific_metadata", f"""WITH {b.META} SELECT scan_id, key, CASE WHEN key LIKE '%model' THEN '"' || str_value || '"'
  ELSE CAST(coalesce(num_value, num_list[1]) AS VARCHAR) END AS j FROM meta
  SEMI JOIN (SELECT DISTINCT key FROM {_keys_sql(fixed.SCIENTIFIC_KEYS)}) USING (key)""")
def _(t):
    return catalogue.scientific_metadata(b.scan_meta(t)).select("scan_id", F.explode("scientific_metadata").alias("key", "j"))


_INGEST = f"""WITH {b.META}, {b.SCAN_FILES}, {_PIVOT}, i AS ({_MISSING.format(k=_keys_sql(fixed.CATALOGUE_KEYS))}
  UNION ALL {_MISSING.format(k=_keys_sql(fixed.SCIENTIFIC_KEYS))}),
e AS (SELECT scan_id FROM sf LEFT JOIN pv USING (scan_id) WHERE fn IS NULL)
SELECT sf.scan_id, (SELECT count(*) FROM i WHERE i.scan_id = sf.scan_id) AS warnings,
  (SELECT count(*) FROM e WHERE e.scan_id = sf.scan_id) AS errors,
  (SELECT count(*) FROM e WHERE e.scan_id = sf.scan_id) = 0 AS ok FROM sf"""


@query("ingest_verdict", _INGEST)
def _(t):
    _, issues = registry.run_ingestor("scan", b.scan_meta(t), b.scan_files(t))
    return catalogue.ingest_verdict(b.scan_files(t), issues, strict=False)


@query("ingest_verdict_strict", f"SELECT scan_id, warnings, errors, ok AND warnings = 0 AS ok FROM ({_INGEST})")
def _(t):
    """As the batch ingestor judges by default: a warning fails a scan too."""
    _, issues = registry.run_ingestor("scan", b.scan_meta(t), b.scan_files(t))
    return catalogue.ingest_verdict(b.scan_files(t), issues)


@query("register_ingestor", f"""WITH {b.META}, {b.SCAN_FILES}, {_PIVOT}
SELECT scan_id, 'dataset not found ' || key AS msg FROM sf JOIN {_keys_sql(fixed.CATALOGUE_KEYS)} ON true ANTI JOIN meta USING (scan_id, key)
UNION ALL SELECT scan_id, 'no file name' FROM sf LEFT JOIN pv USING (scan_id) WHERE fn IS NULL""")
def _(t):
    def names_only(meta, files):
        recs = catalogue.dataset_records(meta, files)
        return recs, catalogue.missing_fields(files, meta, fixed.CATALOGUE_KEYS).unionByName(catalogue.name_issues(recs))

    registry.register_ingestor("names", names_only)
    return registry.run_ingestor("names", b.scan_meta(t), b.scan_files(t))[1].select("scan_id", "msg")


def blocks(t, size=5):
    return catalogue.datablocks(b.order_files(t), "/data/raw", "/store/raw", size)


@query("datablocks", f"""WITH {b.SOURCE}, {b.ORDER_FILES} SELECT scan_id, replace(path, '/data/raw', '/store/raw') AS path, size, 'RawDatasets' AS type,
  sum(size) OVER (PARTITION BY scan_id)::BIGINT AS total FROM of""")
def _(t):
    return blocks(t).select("scan_id", F.explode("data_files").alias("f"), F.col("total_size").alias("total")).select(
        "scan_id", "f.path", "f.size", "f.type", "total")


def thumbs(t):
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("scan_id"), F.encode("c_name", "UTF-8").alias("payload"))


@query("attachments", f"""SELECT CAST(c_custkey AS VARCHAR) AS scan_id, 'data:image/jpg;base64,' || to_base64(encode(c_name)) AS thumbnail,
  'raw image' AS caption FROM customer""")
def _(t):
    return catalogue.attachments(thumbs(t), records(t)).select("scan_id", "thumbnail", "caption")


@query("catalogue_lineage", f"""WITH {b.SOURCE}, {b.ORDER_FILES} SELECT scan_id, replace(path, '/data/raw', '/store/raw') AS file_path, size AS file_size,
  CAST(1 AS BIGINT) AS attachments FROM of""")
def _(t):
    r = records(t)
    out = catalogue.catalogue_lineage(r, blocks(t), catalogue.attachments(thumbs(t), r))
    return out.select("scan_id", "file_path", "file_size", "attachments")


# ---------------------------------------------------------- sources and sinks
@query("job_specs", """SELECT conv_id, turn AS pos, 'scan' || CAST(conv_id AS VARCHAR) || '.h5' AS filename, CAST(turn AS VARCHAR) || '.5' AS cor
FROM conversations WHERE turn < (SELECT coalesce(min(c.turn), 1000000000) FROM conversations c WHERE c.conv_id = conversations.conv_id AND c.turn % 4 = 3)""")
def _(t):
    """One text file per conversation; every fourth line is blank and ends the file."""
    line = F.when(F.col("turn") % 4 == 3, F.lit(" ")).otherwise(F.expr(
        "concat('scan', cast(conv_id as string), '.h5 cor ', cast(turn as string), '.5')"))
    files = t.conversations.select("conv_id", "turn", line.alias("line")).groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "line"))), lambda e: e["line"]), "\n").alias("value"))
    where = scratch_dir(t.spark, "specs")
    files.repartition("conv_id").write.partitionBy("conv_id").text(where)
    specs = readers.read_job_specs(t.spark, where)
    conv = F.regexp_extract("path", r"conv_id=(\d+)", 1).cast("bigint")
    return specs.select(conv.alias("conv_id"), F.col("pos").cast("bigint").alias("pos"), text.spec_filename(F.col("line")).alias("filename"),
                        F.get(text.spec_map(F.col("line"))["cor"], 0).alias("cor"))


@query("scan_meta_scan", f"WITH {b.META} SELECT key, count(*) AS n, sum(num_value) AS total FROM meta WHERE key LIKE '/process%' GROUP BY key")
def _(t):
    where = scratch_dir(t.spark, "meta")
    b.scan_meta(t).write.parquet(where)
    meta = readers.read_scan_meta(t.spark, where, [_k for _k, *_r in b._META if _k.startswith("/process")])
    return meta.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("num_value").alias("total"))


@query("inventory_scan", f"""WITH {b.FRAMES}, k AS (SELECT DISTINCT 'scan_id=' || scan_id AS scan, '/kind=' || kind AS kind FROM fr)
SELECT DISTINCT scan AS path, 'dir' AS type, 1::BIGINT AS entries, 0::BIGINT AS sized FROM k
UNION ALL SELECT scan || kind, 'dir', 1, 0 FROM k UNION ALL SELECT scan || kind, 'file', 1, 1 FROM k
UNION ALL SELECT * FROM (VALUES ('.hidden', 'dir', 1, 0), ('.hidden', 'file', 2, 1), ('', 'file', 1, 0))""")
def _(t):
    """Folders of every level by path, hidden ones too, and the files in each; the writer's empty marker is a file as well.
    The checksum files that some file systems put beside each file are not counted."""
    where = scratch_dir(t.spark, "frames")
    sinks.write_frames(b.frames(t), where)
    t.region.coalesce(1).write.parquet(f"{where}/.hidden")
    inv = readers.inventory_scan(t.spark, where, "scratch").filter("type = 'dir' or not name like '.%.crc'")
    path = F.when(F.col("type") == "dir", F.col("rel_path")).otherwise(paths.parent_dir(F.col("rel_path")))
    return inv.groupBy(path.alias("path"), "type").agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("size") > 0).alias("sized"))


_DATED = "ds AS (SELECT *, substr(creation_time, 1, 10) AS ingest_date FROM (" + _DATASET + "))"


@query("catalogue_sink", f"""WITH {b.SOURCE}, {b.ORDER_FILES}, {_DATED}
SELECT 'datasets' AS "table", * FROM ds
UNION ALL BY NAME SELECT 'datablocks' AS "table", scan_id, ingest_date, of.size, replace(path, '/data/raw', '/store/raw') AS file FROM of JOIN ds USING (scan_id)
UNION ALL BY NAME SELECT 'attachments' AS "table", scan_id, ingest_date, owner_group, access_groups, 'raw image' AS caption,
  'data:image/jpg;base64,' || to_base64(encode(c_name)) AS thumbnail FROM customer JOIN ds ON scan_id = CAST(c_custkey AS VARCHAR)""")
def _(t):
    """All three tables, written by ingest date and read back whole."""
    where, recs = scratch_dir(t.spark, "catalogue"), records(t)
    days = recs.select("scan_id", F.to_date("creation_time").alias("ingest_date"))
    tables = {"datasets": recs, "datablocks": blocks(t), "attachments": catalogue.attachments(thumbs(t), recs)}
    sinks.write_catalogue({name: df.join(days, "scan_id") for name, df in tables.items()}, where)
    groups = F.array_join("access_groups", "|").alias("access_groups")
    back = {name: t.spark.read.parquet(f"{where}/{name}").withColumn("table", F.lit(name)) for name in tables}
    head = ("table", "scan_id", F.col("ingest_date").cast("string").alias("ingest_date"))
    datasets = back["datasets"].select(
        *head, "owner", "creation_location", "dataset_name", "type", "proposal_id", "data_format", "source_folder", "size", "description",
        "is_published", stamp("creation_time").alias("creation_time"), "owner_group", groups)
    files = back["datablocks"].select(*head, F.explode("data_files").alias("f")).select(
        "table", "scan_id", "ingest_date", F.col("f.size").alias("size"), F.col("f.path").alias("file"))
    pictures = back["attachments"].select(*head, "owner_group", groups, "caption", "thumbnail")
    return datasets.unionByName(files, allowMissingColumns=True).unionByName(pictures, allowMissingColumns=True)


@query("metric_sink", f"WITH {_ROUTED} SELECT machine, count(*) AS n, sum(bytes)::BIGINT AS total FROM ro WHERE bytes > 0 GROUP BY machine")
def _(t):
    where = scratch_dir(t.spark, "metrics")
    sinks.write_metrics(transfers.metric_records(routed(t)), where)
    return t.spark.read.parquet(where).groupBy("machine").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes_transferred").alias("total"))


@query("plan_sink", f"""WITH {b.SOURCE}, {b.CHECK}, sy AS (SELECT rel_path, CASE WHEN chk.rel_path IS NULL THEN 'COPY_NEW'
  WHEN src.checksum IS DISTINCT FROM chk.checksum THEN 'COPY_CHANGED' END AS action FROM src LEFT JOIN chk USING (rel_path))
SELECT 'A' AS endpoint_key, rel_path, action, NULL::VARCHAR AS verdict, NULL::VARCHAR AS due_at, NULL::VARCHAR AS run_name FROM sy WHERE action IS NOT NULL
UNION ALL SELECT location, rel_path, 'PRUNE', {_VERDICT}, strftime(CAST(src.last_modified + to_days(days) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'),
  'delete ' || location || ': ' || split_part(rel_path, '/', 3)
FROM src LEFT JOIN chk USING (rel_path) JOIN (VALUES ('spot832', 2), ('data832', 3)) v(location, days) ON true""".replace(
    "chk.rel_path IS NULL THEN 'NO", "chk.last_modified IS NULL THEN 'NO"))
def _(t):
    """What to copy, and what to delete by the rule table: when it is due and what the guard says now."""
    where = scratch_dir(t.spark, "plan")
    copies = inventory.sync_plan(b.source_files(t), b.check_files(t)).filter(F.col("action") != "SKIP_SAME").select("endpoint_key", "rel_path", "action")
    kinds = b.source_files(t).select(F.lit("file").alias("path_kind"), F.col("rel_path").alias("path"), F.col("last_modified").alias("created_at"))
    requests = retention.retention_schedule(kinds, "move").select(
        F.col("path").alias("rel_path"), F.col("location").alias("endpoint_key"), "due_at", "run_name", F.lit("A").alias("source"), F.lit("B").alias("check"))
    prunes = inventory.prune_guard(requests, both(t), now(), 1000).select(
        "endpoint_key", "rel_path", F.lit("PRUNE").alias("action"), "verdict", "due_at", "run_name")
    sinks.write_plan(copies.unionByName(prunes, allowMissingColumns=True), where)
    back = t.spark.read.parquet(where)
    return back.select("endpoint_key", "rel_path", "action", "verdict", stamp("due_at").alias("due_at"), "run_name")


@query("scan_geometry", f"""WITH {b.META}, g AS (SELECT scan_id, max(CASE WHEN key LIKE '%num_angles' THEN num_value END) AS n,
  max(CASE WHEN key LIKE '%rotation/range' THEN num_value END) AS r, max(CASE WHEN key LIKE '%dimension_x' THEN num_list[1] END) AS w,
  max(CASE WHEN key LIKE '%dimension_y' THEN num_list[1] END) AS h, max(CASE WHEN key LIKE '%pixel_size' THEN num_value END) AS px,
  max(CASE WHEN key LIKE '%i0cycle' THEN num_value END) AS c, max(CASE WHEN key LIKE '%camera_distance' THEN num_list END) AS d,
  max(CASE WHEN key LIKE '%monochromator/energy' THEN num_list END) AS e FROM meta GROUP BY scan_id),
k AS (SELECT *, CASE WHEN e[1] = 0 THEN e[2] ELSE e[1] END / 1000 AS kv FROM g)
SELECT scan_id, n::INTEGER AS numangles, h::INTEGER AS numslices, w::INTEGER AS numrays, c::INTEGER AS i0cycle, r AS angularrange, px / 10 AS pxsize_cm,
  CASE WHEN d[1] = 0 THEN d[2] ELSE d[1] END AS distance, CASE WHEN kv > 1000 THEN 30.0 ELSE kv END AS kev,
  CAST(floor((ceil(w * sqrt(2.0)) - w) / 2) AS INTEGER) AS npad FROM k""")
def _(t):
    g = catalogue.scan_geometry(b.scan_meta(t))
    return g.select("scan_id", "numangles", "numslices", "numrays", "i0cycle", "angularrange", "pxsize_cm", "distance", "kev", "npad")


@query("normalise_units", """SELECT c_custkey, CAST(c_custkey % 9 AS DOUBLE) / 10 AS pixel_cm, CAST(c_custkey % 9 AS DOUBLE) * 1000 AS pixel_um,
  CASE WHEN c_custkey % 3 = 0 THEN 75.0 ELSE c_custkey % 3 END::DOUBLE AS distance,
  CASE WHEN c_custkey % 5 = 0 THEN 30.0 ELSE CAST(20000 + c_custkey % 50 AS DOUBLE) / 1000 END AS kev FROM customer""")
def _(t):
    k = F.col("c_custkey")
    d = F.array((k % 3).cast("double"), F.lit(75.0))
    e = F.when(k % 5 == 0, F.array(F.lit(float("nan")))).otherwise(F.array((20000 + k % 50).cast("double")))
    u = values.normalise_units((k % 9).cast("double"), d, e)
    return t.customer.select("c_custkey", u.alias("u")).select("c_custkey", "u.*")
