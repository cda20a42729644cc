"""Which copies may be deleted, where, and when."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.functions import paths
from beamwright.operators import inventory as inv
from beamwright.operators import retention


def deletion_plan(files: DataFrame, inventory: DataFrame, endpoints: DataFrame, flow: str, now: Column, days: int = 14, **rules) -> DataFrame:
    """One row per stale file and place the rules name for it, with its due time and what the guard says now.

    ``files(rel_path, type, size, last_modified)`` are the files to clear, ``inventory(endpoint_key, rel_path,
    last_modified)`` is what lies where, ``endpoints(endpoint_key, root_path)`` the registry.  Settings and rules of the
    retention table pass through ``rules``.  ``action`` is PRUNE where the guard agrees, else KEEP; a place that the
    registry lacks has no path and is kept.  Null paths are left out, as the rules leave them out.
    """
    stale = inv.stale_files(files, now, days)
    kinds = stale.select(F.lit("file").alias("path_kind"), F.col("rel_path").alias("path"), F.col("last_modified").alias("created_at"), "size")
    due = retention.retention_schedule(kinds, flow, **rules).withColumnRenamed("path", "rel_path")
    judged = inv.prune_guard(due, inventory, now, days)
    roots = endpoints.select(F.col("endpoint_key").alias("location"), "root_path")
    placed = judged.join(roots, "location", "left").withColumn("path", paths.full_path(F.col("root_path"), F.col("rel_path")))
    agreed = (F.col("verdict") == inv.PRUNE) & F.col("root_path").isNotNull()
    return placed.select(
        F.col("location").alias("endpoint_key"), "rel_path", F.when(agreed, "PRUNE").otherwise("KEEP").alias("action"),
        "path", "size", "verdict", "due_at", "run_name", "check_modified")
