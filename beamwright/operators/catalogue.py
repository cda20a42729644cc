"""Scan metadata to catalogue records and issues."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.functions import paths, text, values
from beamwright.operators import segments


def distinct_keys(keys: list) -> list:
    return list(dict.fromkeys(keys))


def extract_fields(meta: DataFrame, keys: list) -> DataFrame:
    """Allow-listed metadata rows; the filter reaches the scan."""
    return meta.filter(F.col("key").isin(distinct_keys(keys)))


def missing_fields(scans: DataFrame, meta: DataFrame, keys: list) -> DataFrame:
    """A warning per scan and absent key; a key listed twice warns twice.

    Only the set of held keys (at most the allow-list) travels per scan.
    """
    held = extract_fields(meta, keys).groupBy("scan_id").agg(F.collect_set("key").alias("held"))
    return absent_fields(scans.join(held, "scan_id", "left"), keys)


def absent_fields(scans: DataFrame, keys: list) -> DataFrame:
    """The warnings of ``missing_fields`` for scans with their set of held keys, ``held``."""
    known = F.coalesce("held", F.array().cast("array<string>"))
    named = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(f"dataset not found {k}").alias("msg")) for k in keys])
    absent = F.filter(named, lambda k: ~F.array_contains(known, k["key"]))["msg"]
    return scans.select("scan_id", F.explode(absent).alias("msg")).select(
        "scan_id", F.lit("warning").alias("severity"), "msg", F.lit(None).cast("string").alias("exception"))


def _text_columns(columns: dict) -> list[Column]:
    """Aggregates: chosen text keys as columns."""
    value = values.coerce_value(*[F.col(c) for c in ("str_value", "num_value", "str_list", "num_list")])["str_value"]
    return [F.max(F.when(F.col("key") == k, value)).alias(c) for c, k in columns.items()]


def pivot_text(meta: DataFrame, columns: dict) -> DataFrame:
    """One row per scan with chosen text keys as columns."""
    return meta.filter(F.col("key").isin(list(columns.values()))).groupBy("scan_id").agg(*_text_columns(columns))


def described(meta: DataFrame, files: DataFrame, keys: list) -> DataFrame:
    """``files`` with the catalogue's text columns and the keys of the allow-list that their scan holds, ``held``, in one pass
    over the metadata."""
    held = F.collect_set(F.when(F.col("key").isin(distinct_keys(keys)), F.col("key"))).alias("held")
    rows = extract_fields(meta, [*keys, *CATALOGUE_COLUMNS.values()])
    return files.join(rows.groupBy("scan_id").agg(*_text_columns(CATALOGUE_COLUMNS), held), "scan_id", "left")


CATALOGUE_COLUMNS = {
    "instrument": fixed.CATALOGUE_KEYS[0], "beamline": fixed.CATALOGUE_KEYS[1], "pi": fixed.CATALOGUE_KEYS[3],
    "proposal": fixed.CATALOGUE_KEYS[4], "email": fixed.CATALOGUE_KEYS[5], "file_name": fixed.CATALOGUE_KEYS[7],
}


def _scalar_json(value: Column) -> Column:
    """JSON text of a scalar: that of a one-element list without its brackets."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def scientific_metadata(meta: DataFrame, keys: list = fixed.SCIENTIFIC_KEYS) -> DataFrame:
    """One map per scan: key -> JSON text of a scalar or list, numbers made safe."""
    v = values.coerce_value(*[F.col(c) for c in ("str_value", "num_value", "str_list", "num_list")])
    text_json = F.coalesce(_scalar_json(v["str_value"]), F.to_json(v["str_list"]))
    number_json = F.coalesce(_scalar_json(values.finite(v["num_value"])), values.json_safe(v["num_list"]))
    rows = extract_fields(meta, keys).withColumn("json", F.coalesce(text_json, number_json, F.lit("null")))
    one = rows.groupBy("scan_id", "key").agg(F.max("json").alias("json"))
    return one.groupBy("scan_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "json")))).alias("scientific_metadata")
    )


def data_sample(meta: DataFrame, n: int = 10, keys: list = fixed.SAMPLE_KEYS) -> DataFrame:
    """Every step-th element of the sampled series; absent series are skipped."""
    rows = meta.filter(F.col("key").isin(keys) & F.col("num_list").isNotNull())
    return rows.select("scan_id", "key", values.decimate(F.col("num_list"), n).alias("sample"))


def dataset_records(meta: DataFrame, files: DataFrame, user: str = fixed.DEFAULT_USER) -> DataFrame:
    """Raw-dataset records for ``files(scan_id, path, size, last_modified)``."""
    return records_of(files.join(pivot_text(meta, CATALOGUE_COLUMNS), "scan_id", "left"), user)


def records_of(wide: DataFrame, user: str = fixed.DEFAULT_USER) -> DataFrame:
    """Raw-dataset records for files with their catalogue columns."""
    owner = values.or_unknown(F.col("pi"))
    place = values.or_unknown(F.col("instrument"))
    terms = text.search_terms(F.col("file_name"))
    access = text.access_controls(F.lit(user), F.col("beamline"), F.col("proposal"))
    return wide.select(
        "scan_id",
        owner.alias("owner"), text.clean_email(F.col("email")).alias("contact_email"),
        place.alias("creation_location"), F.col("file_name").alias("dataset_name"),
        F.lit("raw").alias("type"), place.alias("instrument_id"), F.col("proposal").alias("proposal_id"),
        F.lit("DX").alias("data_format"), owner.alias("principal_investigator"),
        paths.parent_dir(F.col("path")).alias("source_folder"), F.col("size"),
        terms.alias("sample_id"), F.lit(False).alias("is_published"), terms.alias("description"),
        text.keywords(F.col("file_name")).alias("keywords"), F.col("last_modified").alias("creation_time"),
        access["owner_group"].alias("owner_group"), access["access_groups"].alias("access_groups"),
    )


def name_issues(records: DataFrame) -> DataFrame:
    """An error for every record without a file name."""
    return records.filter(F.col("dataset_name").isNull()).select(
        "scan_id", F.lit("error").alias("severity"), F.lit("no file name").alias("msg"),
        F.lit(None).cast("string").alias("exception"),
    )


def ingest_verdict(scans: DataFrame, issues: DataFrame, strict: bool = True) -> DataFrame:
    """Issue counts and outcome; strict fails on warnings too."""
    counts = issues.groupBy("scan_id").agg(
        F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.count_if(F.col("severity") == "error").alias("errors"),
    )
    out = scans.select("scan_id").join(counts, "scan_id", "left").na.fill(0, ["warnings", "errors"])
    bad = (F.col("errors") > 0) | (F.lit(strict) & (F.col("warnings") > 0))
    return out.withColumn("ok", ~bad)


def datablocks(files: DataFrame, source_root: str, storage_root: str, block_size: int = 1000) -> DataFrame:
    """Blocks of data files per dataset ``files(scan_id, path, size, last_modified)``.

    A dataset with very many files gets several blocks of ``block_size`` files;
    every file is in exactly one block, and each block also tells the whole
    dataset's number of blocks and total size.
    """
    whole = Window.partitionBy("scan_id")
    stored = paths.storage_path(F.col("path"), source_root, storage_root)
    entry = F.struct(
        stored.alias("path"), F.col("size"), F.col("last_modified").alias("time"), F.lit("RawDatasets").alias("type")
    )
    return (
        segments.with_batch(files, ["scan_id"], "path", block_size, "block")
        .groupBy("scan_id", "block")
        .agg(F.sum("size").alias("size"), F.sort_array(F.collect_list(entry)).alias("data_files"))
        .withColumn("total_size", F.sum("size").over(whole))
        .withColumn("blocks", F.count(F.lit(1)).over(whole))
    )


def attachments(thumbnails: DataFrame, records: DataFrame, caption: str = "raw image") -> DataFrame:
    """Attachment rows for ``thumbnails(scan_id, payload binary)``."""
    groups = records.select("scan_id", "owner_group", "access_groups")
    return thumbnails.join(groups, "scan_id").select(
        "scan_id", text.data_uri(F.col("payload")).alias("thumbnail"), F.lit(caption).alias("caption"),
        "owner_group", "access_groups",
    )


def catalogue_lineage(records: DataFrame, blocks: DataFrame, attached: DataFrame) -> DataFrame:
    """Dataset to data files and attachments, by dataset id."""
    files = blocks.select("scan_id", "block", F.explode("data_files").alias("f"))
    pictures = attached.groupBy("scan_id").agg(F.count(F.lit(1)).alias("attachments"))
    return (
        records.select("scan_id", "owner_group")
        .join(files, "scan_id")
        .join(pictures, "scan_id", "left")
        .select(
            "scan_id", "owner_group", "block", F.col("f.path").alias("file_path"), F.col("f.size").alias("file_size"),
            F.coalesce("attachments", F.lit(0)).alias("attachments"),
        )
    )


def meta_number(key: str) -> Column:
    """Aggregate: the number (or first number of a list) stored under a key."""
    first = F.coalesce("num_value", F.get("num_list", 0))
    return F.max(F.when(F.col("key") == key, first))


def meta_list(key: str) -> Column:
    listed = F.coalesce("num_list", F.when(F.col("num_value").isNotNull(), F.array("num_value")))
    return F.max(F.when(F.col("key") == key, listed))


def scan_geometry(meta: DataFrame, fallback_kev: float = 30.0) -> DataFrame:
    """One geometry row per scan, units normalised, padding computed."""
    keys = list(fixed.GEOMETRY_KEYS.values()) + [fixed.DISTANCE_KEY, fixed.ENERGY_KEY, fixed.THETA_KEY]
    aggs = [meta_number(k).alias(c) for c, k in fixed.GEOMETRY_KEYS.items()]
    wide = meta.filter(F.col("key").isin(keys)).groupBy("scan_id").agg(
        *aggs, meta_list(fixed.DISTANCE_KEY).alias("distances"), meta_list(fixed.ENERGY_KEY).alias("energies"),
        meta_list(fixed.THETA_KEY).alias("theta_deg"),
    )
    whole = [F.col(c).cast("int").alias(c) for c in ("numangles", "numslices", "numrays", "i0cycle", "nflat", "ndark")]
    units = values.normalise_units(F.col("pixel_mm"), F.col("distances"), F.col("energies"), fallback_kev)
    pad = F.floor((F.ceil(F.col("numrays") * F.sqrt(F.lit(2.0))) - F.col("numrays")) / 2).cast("int")
    return wide.select(
        "scan_id", *whole, "angularrange", "rotation_start", "rotation_step", "theta_deg",
        units["pixel_cm"].alias("pxsize_cm"), units["pixel_um"].alias("pxsize_um"),
        units["distance"].alias("distance"), units["kev"].alias("kev"), pad.alias("npad"),
    )
