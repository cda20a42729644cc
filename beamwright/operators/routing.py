"""Which flows a new file starts, and how a multi-stage run ended."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright import fixed


def offsite_eligible(files: DataFrame) -> DataFrame:
    return files.filter(~F.col("is_export_control") & F.col("send_offsite"))


def route(files: DataFrame, decisions: dict) -> DataFrame:
    """One row per file and enabled flow; the new-file flow comes first.

    Decisions are a handful of switches, so they become a literal array that
    each file row expands: no join and no shuffle.
    """
    on = [k for k, v in decisions.items() if v]
    rows = [F.struct(F.lit(k).alias("flow"), F.lit(0 if k == fixed.NEW_FILE_FLOW else 1).alias("run_order")) for k in on]
    options = F.array(*rows) if rows else F.array().cast("array<struct<flow:string,run_order:int>>")
    out = files.withColumn("_r", F.explode(options)).select("*", "_r.flow", "_r.run_order").drop("_r")
    return out.withColumn(
        "error", F.when(~F.col("flow").isin(list(fixed.FLOW_PARAMETERS)), F.concat(F.lit("unknown flow "), "flow"))
    )


def flow_outcome(runs: DataFrame, gated: bool = True) -> DataFrame:
    """Outcome of runs with explicit stage results ``copy_in, recon, pyramid, tiff_back, zarr_back``.

    Gated runs stop at the first failure; copy-back results then only decide
    whether the returned copies may be pruned.  Ungated runs never stop: they
    have no copy-in, always try four copies and always schedule all pruning.
    """
    ok = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("copy_in", "recon", "pyramid", "tiff_back", "zarr_back")}
    if gated:
        stopped = F.when(~ok["copy_in"], "copy_in").when(~ok["recon"], "recon").when(~ok["pyramid"], "pyramid")
        done = stopped.isNull()
        copies, tiff, zarr = F.when(done, 3).otherwise(1), done & ok["tiff_back"], done & ok["zarr_back"]
        success = prune = done
    else:
        stopped = F.lit(None).cast("string")
        success, copies = ok["recon"] & ok["pyramid"], F.lit(4)
        prune = tiff = zarr = F.lit(True)
    return runs.select(
        "*", stopped.alias("stopped_at"), success.alias("success"), copies.alias("copies"), prune.alias("schedules_prune"),
        tiff.alias("prune_tiff_copy"), zarr.alias("prune_zarr_copy"),
    )
