"""Scalar functions and filters over the given tables."""

from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.functions import paths, text, values
from beamwright.operators import catalogue, inventory
from beamwright.queries import bindings as b
from beamwright.queries.core import NOW, now, query, stamp


def _key(t, key):
    return b.scan_meta(t).filter(F.col("key") == key)


_BARE = r"""regexp_replace(regexp_replace(str_value, '^["''\s,]+', ''), '["''\s,]+$', '')"""


@query("clean_email", f"""WITH {b.META}, e AS (SELECT scan_id, {_BARE} AS c FROM meta WHERE key LIKE '%experimenter/email')
SELECT scan_id, CASE WHEN c = '' OR upper(c) = 'NONE' OR strpos(c, '@') = 0 THEN 'unknown@example.com'
  ELSE replace(c, ' ', '') END AS email FROM e""")
def _(t):
    return _key(t, fixed.CATALOGUE_KEYS[5]).select("scan_id", text.clean_email(F.col("str_value")).alias("email"))


@query("search_terms", """WITH w AS (SELECT doc_id, list_transform(list_filter(string_split_regex(text, '[^a-zA-Z0-9]'),
  lambda x: length(x) > 0), lambda x: lower(x)) AS k FROM documents)
SELECT doc_id, md5(coalesce(array_to_string(k, ' '), '')) AS terms, CAST(len(k) AS INTEGER) AS n FROM w""")
def _(t):
    return t.documents.select(
        "doc_id", F.md5(text.search_terms(F.col("text"))).alias("terms"), F.size(text.keywords(F.col("text"))).alias("n")
    )


@query("access_controls", f"""WITH {b.META}, p AS (SELECT scan_id,
  max(CASE WHEN key LIKE '%experiment/beamline' THEN str_list[1] END) AS bl,
  max(CASE WHEN key LIKE '%experiment/proposal' THEN str_value END) AS pr FROM meta GROUP BY scan_id)
SELECT scan_id, CASE WHEN pr IS NULL OR pr IN ('', 'None') THEN 'staff' ELSE pr END AS owner_group,
  CASE WHEN bl = 'bl832' THEN 'bl832|staff|8.3.2' ELSE bl || '|staff' END AS access_groups FROM p""")
def _(t):
    wide = catalogue.pivot_text(b.scan_meta(t), catalogue.CATALOGUE_COLUMNS)
    dirty = F.concat(F.lit(" '"), F.col("beamline"), F.lit("', "))
    a = text.access_controls(F.lit("staff"), dirty, F.col("proposal"))
    return wide.select("scan_id", a["owner_group"].alias("owner_group"),
                       F.array_join(a["access_groups"], "|").alias("access_groups"))


@query("rel_path", f"""WITH {b.SOURCE} SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN rel_path END AS rel FROM src""")
def _(t):
    src = b.source_files(t)
    p = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("/global/"), "rel_path")).otherwise(F.col("rel_path"))
    return src.select("o_orderkey", paths.rel_path(p).alias("rel"))


@query("full_path", f"""WITH {b.SOURCE} SELECT o_orderkey, '/data/raw/x' || CASE WHEN o_orderkey % 3 = 0 THEN ''
  ELSE '/' || rel_path END AS path FROM src""")
def _(t):
    root = F.when(F.col("o_orderkey") % 2 == 0, "/data/raw/x/").otherwise("/data/raw/x")
    part = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("/"), "rel_path"))
    return b.source_files(t).select("o_orderkey", paths.full_path(root, part.otherwise(F.col("rel_path"))).alias("path"))


@query("storage_path", f"""WITH {b.SOURCE} SELECT o_orderkey, '/store/' || rel_path || '/store/' AS path FROM src""")
def _(t):
    p = F.concat(F.lit("/data/"), "rel_path", F.lit("/data/"))
    return b.source_files(t).select("o_orderkey", paths.storage_path(p, "/data/", "/store/").alias("path"))


@query("recon_paths", f"""WITH {b.SOURCE}, q AS (SELECT o_orderkey, split_part(rel_path, '/', 2) AS folder,
  regexp_replace(split_part(rel_path, '/', 3), '\\.h5$', '') AS stem FROM src)
SELECT o_orderkey, stem, folder, folder || '/' || stem || '.h5' AS raw_path, folder || '/rec' || stem || '/' AS tiff_path,
  folder || '/rec' || stem || '.zarr/' AS zarr_path, folder || '/rec' || stem AS tiff_path_bare,
  folder || '/rec' || stem || '.zarr' AS zarr_path_bare, stem AS label FROM q""")
def _(t):
    return b.source_files(t).select("o_orderkey", paths.recon_paths(F.col("rel_path")).alias("p")).select("o_orderkey", "p.*")


@query("parse_scan_name", f"""WITH {b.SOURCE} SELECT rel_path,
  'BLS-' || lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS proposal, 'user' || CAST(o_custkey % 50 AS VARCHAR) AS "user",
  strftime(CAST(last_modified AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS acquired_at, 'scan' || CAST(o_orderkey AS VARCHAR) AS label,
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS tile_x,
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS tile_y FROM src""")
def _(t):
    p = paths.parse_scan_name(paths.parent_name(F.col("rel_path")), paths.base_name(F.col("rel_path")))
    return b.source_files(t).select("rel_path", p.alias("p")).select(
        "rel_path", "p.proposal", "p.user", stamp(F.col("p.acquired_at")).alias("acquired_at"), "p.label", "p.tile_x", "p.tile_y")


@query("json_safe", """SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x:
  CASE WHEN abs(x) > 0.2 OR x > 0.1 THEN 'null' ELSE CAST(round(CAST(x AS DOUBLE) * 100, 2) + 0.0 AS VARCHAR) END), ',') || ']' AS js
FROM embeddings""")
def _(t):
    inf = F.lit(float("inf"))
    noisy = F.transform("embedding", lambda x: F.when(x > 0.2, inf).when(x < -0.2, -inf).when(x > 0.1, F.lit(float("nan")))
                        .otherwise(F.round(x.cast("double") * 100, 2) + F.lit(0.0)))
    return t.embeddings.select("vec_id", values.json_safe(noisy).alias("js"))


_SAMPLED = ", ".join(f"'{k}'" for k in fixed.SAMPLE_KEYS)


@query("decimate", f"""WITH {b.META}, e AS (SELECT scan_id, key, num_list AS a, len(num_list) AS n,
  greatest(1, len(num_list) // 10) AS step FROM meta WHERE key IN ({_SAMPLED}) AND num_list IS NOT NULL)
SELECT scan_id, key, array_to_string(list_transform(list_filter(range(n), lambda i: i % step = 0),
  lambda i: CAST(CAST(round(1000 * a[i + 1]) AS BIGINT) AS VARCHAR)), ',') AS sample FROM e""")
def _(t):
    s = catalogue.data_sample(b.scan_meta(t))
    return s.select("scan_id", "key", F.array_join(F.transform("sample", lambda x: F.round(1000 * x).cast("bigint").cast("string")), ",").alias("sample"))


@query("coerce_value", f"""WITH {b.META} SELECT scan_id, key,
  coalesce(str_value, CASE WHEN len(str_list) = 1 THEN str_list[1] END) AS s,
  coalesce(num_value, CASE WHEN len(num_list) = 1 THEN num_list[1] END) AS n,
  CASE WHEN len(num_list) <> 1 THEN CAST(len(num_list) AS INTEGER) END AS items FROM meta""")
def _(t):
    v = values.coerce_value(*[F.col(c) for c in ("str_value", "num_value", "str_list", "num_list")])
    return b.scan_meta(t).select("scan_id", "key", v.alias("v")).select(
        "scan_id", "key", F.col("v.str_value").alias("s"), F.col("v.num_value").alias("n"), F.size("v.num_list").alias("_c"),
        F.when(F.col("v.num_list").isNotNull(), F.size("v.num_list")).alias("items")).drop("_c")


@query("iso_utc", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN epoch_us(ts) % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END || '+00:00' AS iso FROM events""")
def _(t):
    return t.events.select("event_id", values.iso_utc(F.unix_micros("ts") / 1000000).alias("iso"))


@query("typed_literal", r"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents),
k AS (SELECT doc_id, w, CASE WHEN regexp_matches(trim(w, ' '), '^[+-]?\d+$') AND TRY_CAST(trim(w, ' ') AS BIGINT) IS NOT NULL THEN 'int'
  WHEN regexp_matches(trim(w, ' '), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$') OR regexp_matches(trim(w, ' '), '^(?i)[+-]?(nan|inf|infinity)$')
  THEN 'float' ELSE 'str' END AS type FROM w)
SELECT doc_id, type, count(*) AS n, sum(CASE WHEN type = 'int' THEN TRY_CAST(trim(w, ' ') AS BIGINT) % 1000 END)::BIGINT AS int_mod,
  count(DISTINCT CASE WHEN type = 'str' THEN w END) AS texts FROM k GROUP BY ALL""")
def _(t):
    w = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    w = w.withColumn("l", text.typed_literal(F.col("w")))
    return w.groupBy("doc_id", F.col("l.type").alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l.int_value") % 1000).alias("int_mod"),
        F.countDistinct("l.str_value").alias("texts"))


@query("spec_map", f"""WITH {b.SPECS} SELECT conv_id, turn, 'scan' || CAST(conv_id AS VARCHAR) || '.h5' AS filename,
  CASE WHEN conv_id % 3 = 0 THEN '7' ELSE CAST(turn AS VARCHAR) || '.5' END AS cor,
  '-1;' || CAST(turn AS VARCHAR) || ';1' AS sinoused, role AS output, CASE WHEN conv_id % 3 = 0 THEN 'int' ELSE 'float' END AS cor_type,
  3 AS names FROM sp JOIN conversations USING (conv_id, turn)""")
def _(t):
    m = b.specs(t).withColumn("m", text.spec_map(F.col("line")))
    return m.select(
        "conv_id", "turn", text.spec_filename(F.col("line")).alias("filename"), F.get(F.col("m")["cor"], 0).alias("cor"),
        F.array_join(F.col("m")["sinoused"], ";").alias("sinoused"), F.get(F.col("m")["outputFilename"], 0).alias("output"),
        text.typed_literal(F.get(F.col("m")["cor"], 0))["type"].alias("cor_type"), F.size("m").alias("names"))


@query("overlay_params", """SELECT o_orderkey, CAST(o_orderkey % 900 AS VARCHAR) AS n_iter, '0' AS period_illu_refine,
  CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS use_illu_mask,
  'n_iter,period_illu_refine,period_bg_refine,use_illu_mask' AS names FROM orders""")
def _(t):
    given = F.create_map(F.lit("n_iter"), (F.col("o_orderkey") % 900).cast("string"), F.lit("stray"), F.lit("1"))
    given = F.when(F.col("o_orderkey") % 2 == 0, F.map_concat(given, F.create_map(F.lit("use_illu_mask"), F.lit("True")))).otherwise(given)
    m = text.overlay_params(fixed.CAMERA_SOLVER_DEFAULTS, given)
    return t.orders.select("o_orderkey", m.alias("m")).select(
        "o_orderkey", *[F.col("m")[c].alias(c) for c in ("n_iter", "period_illu_refine", "use_illu_mask")],
        F.array_join(F.map_keys("m"), ",").alias("names"))


@query("extract_job_id", """SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) END AS job_id FROM events""")
def _(t):
    msg = F.when(F.col("event_type") == "error", F.concat(F.lit("x Job not found:  "), "user_id", F.lit(" y"))).otherwise("fine 12")
    return t.events.select("event_id", text.extract_job_id(msg).alias("job_id"))


@query("data_uri", """SELECT conv_id, turn, md5('data:image/jpg;base64,' || to_base64(encode(text))) AS uri FROM conversations""")
def _(t):
    return t.conversations.select("conv_id", "turn", F.md5(text.data_uri(F.encode("text", "UTF-8"))).alias("uri"))


@query("prune_run_name", f"""WITH {b.SOURCE} SELECT o_orderkey, 'delete siteA: ' || split_part(rel_path, '/', 3) AS run_name,
  'prune_siteA/prune_siteA' AS run_key FROM src""")
def _(t):
    return b.source_files(t).select("o_orderkey", paths.prune_run_name(F.lit("siteA"), F.col("rel_path")).alias("run_name"),
                                    paths.prune_key(F.lit("siteA")).alias("run_key"))


@query("endpoint_registry", """SELECT 's' || CAST(s_suppkey AS VARCHAR) AS endpoint_key, s_name AS name,
  '/data/' || CAST(s_nationkey AS VARCHAR) || '/shared/$UNSET' AS root_path, CAST(s_suppkey AS VARCHAR) || '.site.org' AS uri FROM supplier""")
def _(t):
    rows = t.supplier.select(
        F.concat(F.lit("s"), "s_suppkey").alias("endpoint_key"),
        F.create_map(F.lit("name"), "s_name", F.lit("root_path"), F.concat(F.lit("${BASE}/"), "s_nationkey", F.lit("/$DIR/$UNSET")),
                     F.lit("uri"), F.concat("s_suppkey", F.lit(".${HOST}"))).alias("props"))
    reg = inventory.endpoint_registry(rows, {"BASE": "/data", "DIR": "shared", "HOST": "site.org"})
    return reg.select("endpoint_key", "name", "root_path", "uri")


@query("older_than", f"""SELECT o_orderkey, o_orderdate < TIMESTAMP '{NOW}' - INTERVAL 1000 DAY AS older FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", values.older_than(F.col("o_orderdate"), 1000, now()).alias("older"))


@query("stale_files", f"""WITH {b.SOURCE} SELECT rel_path, size FROM src WHERE last_modified < TIMESTAMP '{NOW}' - INTERVAL 1000 DAY""")
def _(t):
    return inventory.stale_files(b.source_files(t), now(), 1000).select("rel_path", "size")


@query("stale_files_compat", f"""WITH {b.SOURCE} SELECT rel_path FROM src WHERE last_modified < TIMESTAMP '{NOW}' - INTERVAL 14 DAY""")
def _(t):
    return inventory.stale_files(b.source_files(t), now(), 1000, compat=True).select("rel_path")


@query("visible_files", """SELECT count(*) AS files, sum(page_id)::BIGINT AS ids FROM pages WHERE page_id % 3 <> 0""")
def _(t):
    name = F.concat(F.when(F.col("page_id") % 3 == 0, ".").otherwise("_"), "page_id", F.lit(".tif"))
    return inventory.visible_files(t.pages.withColumn("name", name)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("page_id").alias("ids"))


@query("classify_frame", """SELECT event_id, event_type AS kind_in, CASE event_id % 4 WHEN 0 THEN 'flat' WHEN 1 THEN 'dark' WHEN 2 THEN 'tomo' END AS kind,
  CASE WHEN event_id % 4 < 3 THEN CAST(user_id % 10000 AS INTEGER) END AS idx FROM events""")
def _(t):
    n = F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0")
    m = F.col("event_id") % 4
    name = (F.when(m == 0, F.concat(F.lit("s1bak_"), n, F.lit(".tif"))).when(m == 1, F.concat(F.lit("s1drk_"), n, F.lit("_0003.tif")))
            .when(m == 2, F.concat(F.lit("s1_0000_"), n, F.lit(".tif"))).otherwise(F.concat(F.lit("s1_"), n, F.lit(".txt"))))
    return t.events.select("event_id", F.col("event_type").alias("kind_in"), paths.classify_frame(name).alias("c")).select(
        "event_id", "kind_in", "c.kind", "c.idx")


@query("params_for", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'config,file_path' WHEN o_orderkey % 4 = 1
  THEN 'config,file_path,is_export_control' WHEN o_orderkey % 4 = 2 THEN 'config,file_path' END AS names FROM orders""")
def _(t):
    flows = list(fixed.FLOW_PARAMETERS)
    flow = F.get(F.array(*map(F.lit, flows)), (F.col("o_orderkey") % 4).cast("int"))
    m = F.create_map(*[F.lit(x) for x in ("file_path", "a", "is_export_control", "b", "config", "c", "other", "d")])
    return t.orders.select("o_orderkey", F.array_join(F.array_sort(F.map_keys(text.params_for(flow, m))), ",").alias("names"))
