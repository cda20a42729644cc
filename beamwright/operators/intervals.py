"""Nested intervals: folders numbered so that what lies below a folder is a range of numbers.

The folders that hold entries and the borders of the requested folders are put into one order of paths and numbered together. A
requested folder then has a number where it is entered and one where it is left, and the folders below it, at any depth, have the
numbers between. No path is taken apart into its ancestors.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.operators import inventory, segments
from beamwright.session import materialise

BLOCK = 1024


def _folder(path):
    return F.substring(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


def folder_numbers(dirs: DataFrame, folders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(dir_path, enter, leave)`` and ``(folder, number)`` for distinct ``dirs(dir_path)`` and ``folders(folder)``.

    All paths below ``d`` start with ``d/``, so they sort from there to ``d0``, the digit being the next character after the slash.
    """
    borders = dirs.select(
        F.col("dir_path").alias("name"), F.lit(0).alias("kind"),
        F.explode(F.array(F.concat("dir_path", F.lit("/")), F.concat("dir_path", F.lit("0")))).alias("mark"))
    marks = borders.unionByName(folders.select(F.col("folder").alias("name"), F.lit(1).alias("kind"), F.concat("folder", F.lit("/")).alias("mark")))
    cut = segments.with_range_segment(marks.withColumn("_all", F.lit(0)), [], ["mark", "kind"])
    numbered = materialise(segments.with_row_number(cut, ["_all"], ["mark", "kind"], F.col("_range"), "number"), "numbers")
    spans = numbered.filter("kind = 0").groupBy(F.col("name").alias("dir_path")).agg(F.min("number").alias("enter"), F.max("number").alias("leave"))
    return spans, numbered.filter("kind = 1").select(F.col("name").alias("folder"), "number")


def expand_directories(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """As ``inventory.expand_directories``, with one row per entry and request only, however deep the folders are.

    A request is written out as the numbers it spans, in blocks, so that one for a whole endpoint is spread over tasks; there are as
    many as folders it holds, and those of requests inside it. Entries meet the requests by their own folder; adaptive execution
    splits a folder that holds most of them. Null paths match nothing.
    """
    path = F.col("rel_path")
    held = entries.filter(path.contains("/")).select("rel_path", _folder(path).alias("folder"))
    dirs = requests.filter(F.col("dir_path").isNotNull()).select("dir_path").distinct()
    spans, folders = folder_numbers(dirs, held.select("folder").distinct())
    first, last = F.col("enter") + 1, F.col("leave") - 1
    blocks = spans.filter(first <= last).select(
        "dir_path", first.alias("first"), last.alias("last"), F.explode(F.sequence(F.floor(first / BLOCK), F.floor(last / BLOCK))).alias("block"))
    low, high = F.col("block") * BLOCK, F.col("block") * BLOCK + BLOCK - 1
    spread = blocks.repartition("dir_path", "block")
    inside = spread.select("dir_path", F.explode(F.sequence(F.greatest("first", low), F.least("last", high))).alias("number"))
    pairs = inside.join(folders, "number").select("folder", "dir_path")
    return inventory.placed_below(held.join(pairs, "folder").select("rel_path", "dir_path"), requests)
