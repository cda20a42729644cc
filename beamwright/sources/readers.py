"""Sources: inventories, frames, metadata, job lists."""

import re
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beamwright import schemas
from beamwright.functions import values
from beamwright.operators import catalogue
from beamwright.session import materialise


LISTING = "rel_path string, name string, type string, size bigint, last_modified timestamp"


def _listed(batches):
    """Entries of each folder, hidden ones too, as the file system of its address tells them."""
    for batch in batches:
        for root, below in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, base = pafs.FileSystem.from_uri(root)
            base = base.rstrip("/")
            found = store.get_file_info(pafs.FileSelector(f"{base}/{below}" if below else base or "/", recursive=False))
            for low in range(0, len(found), 10_000):
                some = found[low : low + 10_000]
                folder = [f.type == pafs.FileType.Directory for f in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{below}/{f.base_name}" if below else f.base_name for f in some], pa.string()),
                    pa.array([f.base_name for f in some], pa.string()), pa.array(["dir" if d else "file" for d in folder], pa.string()),
                    pa.array([None if d else f.size for f, d in zip(some, folder)], pa.int64()),
                    pa.array([f.mtime for f in some], pa.timestamp("us", "UTC"))], ["rel_path", "name", "type", "size", "last_modified"])


def inventory_scan(spark: SparkSession, root: str, endpoint_key: str, depth: int | None = None) -> DataFrame:
    """Files and folders below a root, ``depth`` levels of them or all; file contents are never read.

    Each round lists the folders of one level, a task for some of them, and
    writes what it finds; the driver learns only whether there are more.
    """
    address = root if "://" in root else "file://" + re.sub(r"^file:/*", "/", root)
    folders, levels = spark.createDataFrame([("",)], "rel_path string"), []
    while depth is None or len(levels) < depth:
        spread = folders.select(F.lit(address.rstrip("/")).alias("root"), "rel_path").repartition("rel_path")
        level = materialise(spread.mapInArrow(_listed, LISTING), "listing")
        levels.append(level)
        folders = level.filter("type = 'dir'").select("rel_path")
        if folders.isEmpty():
            break
    entries = reduce(DataFrame.unionByName, levels) if levels else spark.createDataFrame([], LISTING)
    return entries.select(F.lit(endpoint_key).alias("endpoint_key"), "*", F.lit(None).cast("string").alias("checksum"))


def read_frames(
    spark: SparkSession, path: str, kinds: list | None = None, proj: tuple | None = None, rows: tuple | None = None
) -> DataFrame:
    """Frame rows of a partitioned table; kinds prune folders, ranges reach the scan.

    ``proj`` and ``rows`` are ``(start, stop, step)``; the projection range
    selects tomo frames only and leaves flats and darks whole.
    """
    df = spark.read.schema(schemas.struct(schemas.FRAMES)).parquet(path)
    if kinds:
        df = df.filter(F.col("kind").isin(kinds))
    if rows:
        df = df.filter(values.strided(F.col("row"), *rows))
    if proj:
        chosen = values.strided(F.col("idx"), *proj)
        df = df.filter(chosen) if kinds == ["tomo"] else df.filter((F.col("kind") != "tomo") | chosen)
    return df


def read_scan_meta(spark: SparkSession, path: str, keys: list | None = None) -> DataFrame:
    df = spark.read.schema(schemas.struct(schemas.SCAN_META)).parquet(path)
    return catalogue.extract_fields(df, keys) if keys else df


def read_job_specs(spark: SparkSession, path: str) -> DataFrame:
    """``(path, pos, line)`` of job lists; each file ends at its first blank line."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.split("value", r"\r\n|\n|\r").alias("lines"))
    blanks = F.array_position(F.transform("lines", lambda x: F.trim(x) == ""), True)
    kept = F.when(blanks > 0, F.slice("lines", 1, (blanks - 1).cast("int"))).otherwise(F.col("lines"))
    return files.select("path", F.posexplode(kept).alias("pos", "line"))
