"""Storage inventories: what is where, what is stale, what may be deleted."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.functions import paths, text, values
from beamwright.operators import segments

PRUNE, TOO_NEW = "PRUNE", "TOO_NEW"
NO_SECOND_COPY, SOURCE_MISSING = "NO_SECOND_COPY", "SOURCE_MISSING"


def endpoint_registry(config: DataFrame, env: dict) -> DataFrame:
    """``(endpoint_key, props map)`` rows to flat endpoint rows, variables expanded."""

    def prop(name):
        return text.expand_variables(F.try_element_at("props", F.lit(name)), env).alias(name)

    return config.select("endpoint_key", *[prop(n) for n in ("name", "uuid", "uri", "root_path")])


def stale_files(inventory: DataFrame, now: Column, days: int = 14, compat: bool = False) -> DataFrame:
    """Files strictly older than ``days``.

    ``compat`` keeps a known quirk: below the first folder level the limit is
    always 14 days, whatever was asked for.
    """
    limit = F.lit(days)
    if compat:
        limit = F.when(F.col("rel_path").contains("/"), F.lit(14)).otherwise(limit)
    return inventory.filter((F.col("type") == "file") & values.older_than(F.col("last_modified"), limit, now))


def visible_files(inventory: DataFrame) -> DataFrame:
    return inventory.filter(paths.visible(F.col("name")))


def empty_stacks(stacks: DataFrame, inventory: DataFrame) -> DataFrame:
    """An error issue for every stack folder without a visible file."""
    held = visible_files(inventory).select(paths.parent_dir(F.col("rel_path")).alias("scan_id"))
    return stacks.join(held, "scan_id", "left_anti").select(
        "scan_id", F.lit("error").alias("severity"), F.lit("no visible files in stack").alias("msg"),
        F.lit(None).cast("string").alias("exception"),
    )


def present_on(source: DataFrame, check: DataFrame) -> DataFrame:
    """Source files whose path also exists on the check endpoint."""
    return source.join(check.select("rel_path"), "rel_path", "left_semi")


def missing_on(source: DataFrame, check: DataFrame) -> DataFrame:
    return source.join(check.select("rel_path"), "rel_path", "left_anti")


def with_check_copy(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Requests with the state of their check copy; no check endpoint, no check.

    ``requests(rel_path, check, …)`` gains ``check_found`` and ``check_modified``.
    """
    copies = inventory.select(
        F.col("endpoint_key").alias("check"), "rel_path", F.col("last_modified").alias("check_modified"),
        F.lit(True).alias("_hit"),
    )
    hit = F.coalesce("_hit", F.lit(False))
    return (
        requests.join(copies, ["check", "rel_path"], "left")
        .withColumn("check_found", F.when(F.col("check").isNotNull(), hit))
        .drop("_hit")
    )


def prune_guard(requests: DataFrame, inventory: DataFrame, now: Column, days: Column | int) -> DataFrame:
    """Verdict for every ``(source, check, rel_path)`` deletion request.

    The age is that of the check copy where there is one, else of the source.
    ``days`` of zero or less switches the age test off; otherwise an unknown
    age or limit counts as too new, so nothing is deleted on a missing value.
    """
    days = F.lit(days) if isinstance(days, int) else days
    originals = inventory.select(
        F.col("endpoint_key").alias("source"), "rel_path", F.col("last_modified").alias("source_modified"), F.lit(True).alias("_there"),
    )
    joined = with_check_copy(requests.join(originals, ["source", "rel_path"], "left"), inventory)
    age = F.when(F.col("check").isNotNull(), F.col("check_modified")).otherwise(F.col("source_modified"))
    verdict = (
        F.when(F.col("_there").isNull(), SOURCE_MISSING)
        .when(F.col("check").isNotNull() & ~F.col("check_found"), NO_SECOND_COPY)
        .when((days <= 0) | values.older_than(age, days, now), PRUNE)
        .otherwise(TOO_NEW)
    )
    return joined.withColumn("verdict", verdict).drop("_there")


def sync_plan(source: DataFrame, target: DataFrame) -> DataFrame:
    """Checksum sync: what to copy; extras on the target stay untouched."""
    there = target.select("rel_path", F.col("checksum").alias("target_checksum"), F.lit(True).alias("_hit"))
    same = F.col("checksum").eqNullSafe(F.col("target_checksum"))
    action = F.when(F.col("_hit").isNull(), "COPY_NEW").when(same, "SKIP_SAME").otherwise("COPY_CHANGED")
    return source.join(there, "rel_path", "left").withColumn("action", action).drop("_hit")


def expand_directories(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Directory requests ``(dir_path, dest)`` to one row per entry below.

    Each entry names its own ancestors, so this is an equi-join; the entries
    keep their path relative to the directory's parent.
    """
    entries = inventory.select("rel_path", F.explode(paths.ancestors(F.col("rel_path"))).alias("dir_path"))
    return placed_below(entries, requests)


def placed_below(entries: DataFrame, requests: DataFrame) -> DataFrame:
    """Entries ``(rel_path, dir_path)`` with their requests and where they go."""
    parent = F.length(F.col("dir_path")) - F.length(paths.base_name(F.col("dir_path")))
    inner = F.substring(F.col("rel_path"), parent + 1, F.length("rel_path"))
    return entries.join(requests, "dir_path").withColumn("dest_path", paths.full_path(F.col("dest"), inner))


def safe_paths(source: DataFrame, check: DataFrame) -> DataFrame:
    return source.select("rel_path").intersect(check.select("rel_path"))


def unsafe_paths(source: DataFrame, check: DataFrame) -> DataFrame:
    return source.select("rel_path").exceptAll(check.select("rel_path"))


def prune_batch(plan: DataFrame, batch_size: int = 1000) -> DataFrame:
    """Delete batches per endpoint: path count and the paths themselves.

    An endpoint may hold most of all files, so its paths are numbered and cut
    into batches of ``batch_size``; no path is dropped.
    """
    return (
        segments.with_batch(plan, ["source"], "rel_path", batch_size, "batch")
        .groupBy("source", "batch")
        .agg(F.count(F.lit(1)).alias("files"), F.sort_array(F.collect_list("rel_path")).alias("paths"))
    )


def prune_totals(batches: DataFrame) -> DataFrame:
    return batches.groupBy("source").agg(
        F.sum("files").alias("files"), F.sum(F.size("paths").cast("bigint")).alias("listed")
    )
