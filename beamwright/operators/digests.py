"""Folder digests: trees that tell which parts of two inventories differ.

A folder's digest is a sum of two 64-bit hashes over the rows in it, and over the digests of its subfolders, so it needs no order
and is combined before each shuffle. Files are aggregated once, to their own folder; from there on only folders move upwards, a
level at a time. Two differing folders have equal digests with odds of about 2^-128; a plan that must not rest on that is
``inventory.sync_plan``, which compares every file.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beamwright.operators import inventory
from beamwright.session import materialise

SALTS = 16
TREE = "folder string, depth int, files bigint, own_1 decimal(38,0), own_2 decimal(38,0), below_1 decimal(38,0), below_2 decimal(38,0)"
_DIGEST = ("own_1", "own_2", "below_1", "below_2")


def _above(path: Column) -> Column:
    """The part before the last slash; the root is the empty path, and its own parent."""
    return F.substring(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


def _depth(folder: Column) -> Column:
    return F.when(folder == "", 0).otherwise(F.length(folder) - F.length(F.replace(folder, F.lit("/"), F.lit(""))) + 1).cast("int")


def _mark(seed: int, *cols: Column) -> Column:
    """A hash that tells nulls apart; wide enough to be summed without overflow."""
    return F.xxhash64(F.lit(seed), *[c.isNull() for c in cols], *cols).cast("decimal(38,0)")


def folder_tree(entries: DataFrame) -> DataFrame:
    """One row per folder of ``entries(rel_path, checksum)``, the root as the empty path: digests of its own rows and of what is below.

    ``files`` counts the whole subtree. A path listed several times counts as often; a null checksum is a value of its own; rows without
    path are in no folder. An empty inventory has no folders. Every level is written before the next one reads it; the driver
    learns only how many levels there are.
    """
    path = F.col("rel_path")
    rows = entries.filter(path.isNotNull()).select(
        _above(path).alias("folder"), *[_mark(s, path, F.col("checksum")).alias(f"own_{s}") for s in (1, 2)])
    own = materialise(
        rows.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("own_1").alias("own_1"), F.sum("own_2").alias("own_2"))
        .withColumn("depth", _depth(F.col("folder"))), "tree-own")
    deepest = own.agg(F.max("depth")).first()[0]
    zero, carried, levels = F.lit(0).cast("decimal(38,0)"), None, []
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        here = own.filter(F.col("depth") == depth).withColumns({"below_1": zero, "below_2": zero})
        here = here if carried is None else here.unionByName(carried)
        sums = [F.sum(c).cast("decimal(38,0)").alias(c) for c in _DIGEST]
        level = materialise(here.groupBy("folder", "depth").agg(F.sum("files").alias("files"), *sums), f"tree-{depth}")
        levels.append(level)
        whole = [F.col(c) for c in ("folder", *_DIGEST)]
        carried = level.select(
            _above(F.col("folder")).alias("folder"), (F.col("depth") - 1).alias("depth"), "files", zero.alias("own_1"), zero.alias("own_2"),
            *[_mark(s, *whole).alias(f"below_{s}") for s in (1, 2)])
    empty = entries.sparkSession.createDataFrame([], TREE)
    return reduce(DataFrame.unionByName, levels) if levels else empty


def differing_folders(source: DataFrame, target: DataFrame) -> DataFrame:
    """Folders of the source tree whose own rows differ from the target tree's, or that the target lacks.

    The walk starts at the root and goes below a folder only where the digests differ, so equal subtrees are left unread.
    """
    there = target.select("folder", "depth", *[F.col(c).alias(f"t_{c}") for c in _DIGEST])
    own = F.col("own_1").eqNullSafe(F.col("t_own_1")) & F.col("own_2").eqNullSafe(F.col("t_own_2"))
    below = F.col("below_1").eqNullSafe(F.col("t_below_1")) & F.col("below_2").eqNullSafe(F.col("t_below_2"))
    deepest = source.agg(F.max("depth")).first()[0]
    found, opened = [], None
    for depth in range(0 if deepest is None else deepest + 1):
        here = source.filter(F.col("depth") == depth)
        if opened is not None:
            here = here.withColumn("up", _above(F.col("folder"))).join(opened.select(F.col("folder").alias("up")), "up", "left_semi")
        both = here.join(there.filter(F.col("depth") == depth), ["folder", "depth"], "left")
        level = materialise(both.select("folder", "depth", own.alias("same_files"), below.alias("same_below")).filter("not (same_files and same_below)"), f"walk-{depth}")
        found.append(level.filter("not same_files").select("folder"))
        opened = level.filter("not same_below")
        if opened.isEmpty():
            break
    empty = source.sparkSession.createDataFrame([], "folder string")
    # a path that starts with a slash has the root above it at two depths
    return reduce(DataFrame.unionByName, found).distinct() if found else empty


def tree_sync_plan(source: DataFrame, target: DataFrame, source_tree: DataFrame | None = None, target_tree: DataFrame | None = None) -> DataFrame:
    """As ``inventory.sync_plan``, but only files of differing folders meet the target; ``compared`` tells which those are.

    Trees kept from an earlier scan may be given. Files of equal folders are SKIP_SAME without a join; files without path are always
    compared (and so new). Folders that list the same paths and checksums equally often are equal, so a path is expected once per endpoint.
    A folder may hold most files: the folders to open are spread over ``SALTS`` keys each.
    """
    source_tree = folder_tree(source) if source_tree is None else source_tree
    target_tree = folder_tree(target) if target_tree is None else target_tree
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    opened = materialise(differing_folders(source_tree, target_tree).select(F.col("folder").alias("_folder"), salt), "opened")

    def placed(files):
        path = F.col("rel_path")
        return files.withColumns({"_folder": _above(path), "_salt": F.pmod(F.xxhash64(path), F.lit(SALTS)).cast("int")})

    def within(files, how):
        return placed(files).join(opened, ["_folder", "_salt"], how).drop("_folder", "_salt")

    lost = source.filter(F.col("rel_path").isNull())
    named = source.filter(F.col("rel_path").isNotNull())
    compared = inventory.sync_plan(within(named, "left_semi").unionByName(lost), within(target, "left_semi")).withColumn("compared", F.lit(True))
    skipped = within(named, "left_anti").withColumns(
        {"target_checksum": F.col("checksum"), "action": F.lit("SKIP_SAME"), "compared": F.lit(False)})
    return compared.unionByName(skipped)
