"""Volumes as three-dimensional bricks, laid out so that a box reads few files.

A level is cut into bricks of ``edge`` voxels a side.  Bricks are numbered along a Morton curve, and the bricks of one
cube of 2^``CUBE_BITS`` a side go to one file together, sorted along the curve.  A manifest holds, for every file,
which cubes of which scans and levels it has.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
BITS = 20
CUBE_BITS = 2


def morton(z: Column, y: Column, x: Column) -> Column:
    """The bits of three numbers below 2^20 in turns, highest bits first; larger or negative numbers are an error."""
    zyx = F.struct(z.cast("bigint").alias("z"), y.cast("bigint").alias("y"), x.cast("bigint").alias("x"))

    # a loop over the bits: written out they are 60 terms of generated code
    def add(code, k, n):
        for name, shift in (("x", 0), ("y", 1), ("z", 2)):
            one = F.call_function("shiftright", n[name], k).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.call_function("shiftleft", one, k * 3 + shift))
        return code

    bits = F.sequence(F.lit(0), F.lit(BITS - 1))
    code = F.aggregate(bits, F.lit(0).cast("bigint"), lambda c, k: add(c, k, zyx))
    fits = (F.least(z, y, x) >= 0) & (F.greatest(z, y, x) < 2**BITS)
    return F.when(fits, code).otherwise(F.raise_error(F.lit("brick number out of range")).cast("bigint"))


def _cube(number: Column) -> Column:
    return F.shiftright(number, CUBE_BITS)


def to_bricks(levels: DataFrame, edge: int = 64) -> DataFrame:
    """Bricks ``(scan_id, level, cube, code, bz, by, bx, lines)`` of ``levels(scan_id, level, z, y, values)``.

    ``lines`` are ``(z, y, values)`` in order, the values from ``bx * edge`` on, at most ``edge``² of them.  Rows are
    shuffled once, by cube; the grouping by brick keeps that order.  A row without values or without a place gives no
    brick, equal rows give equal lines.
    """
    if edge < 1:
        raise ValueError("edge must be at least 1")
    count = F.ceil(F.size("values") / edge).cast("int")
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda c: F.struct(c.alias("bx"), F.slice("values", c * edge + 1, F.lit(edge)).alias("values")))
    placed = levels.filter((F.size("values") > 0) & F.col("z").isNotNull() & F.col("y").isNotNull())
    cut = placed.select(
        "scan_id", "level", "z", "y", *[F.floor(F.col(a) / edge).cast("int").alias(f"b{a}") for a in ("z", "y")], F.explode(parts).alias("part"),
    ).select("scan_id", "level", "z", "y", "bz", "by", "part.bx", "part.values")
    spread = cut.withColumn("cube", morton(*[_cube(F.col(f"b{a}")) for a in AXES])).repartition("scan_id", "level", "cube")
    lines = F.array_sort(F.collect_list(F.struct("z", "y", "values")))
    bricks = spread.groupBy("scan_id", "level", "cube", "bz", "by", "bx").agg(lines.alias("lines"))
    return bricks.withColumn("code", morton(F.col("bz"), F.col("by"), F.col("bx")))


def write_bricks(levels: DataFrame, path: str, edge: int = 64, bricks_per_file: int = 0) -> None:
    """Bricks and their manifest below ``path``; the number of files follows the tasks, not scans or levels."""
    ordered = to_bricks(levels, edge).sortWithinPartitions("scan_id", "level", "code")
    writer = ordered.write
    (writer.option("maxRecordsPerFile", bricks_per_file) if bricks_per_file else writer).parquet(f"{path}/bricks")
    spark = levels.sparkSession
    held = spark.read.schema(ordered.schema).parquet(f"{path}/bricks").select(
        F.col("_metadata.file_name").alias("file"), "scan_id", "level", "cube")
    listed = held.groupBy("file", "scan_id", "level", "cube").agg(F.count(F.lit(1)).alias("bricks"))
    listed.withColumn("edge", F.lit(edge)).coalesce(1).sortWithinPartitions("scan_id", "level", "cube").write.parquet(f"{path}/manifest")


def _numbers(axis: str, edge: int) -> Column:
    """Bricks that a box meets along one axis."""
    return F.sequence(F.floor(F.greatest(F.col(f"{axis}0"), F.lit(0)) / edge).cast("int"), F.floor((F.col(f"{axis}1") - 1) / edge).cast("int"))


def _stay(boxes: DataFrame) -> DataFrame:
    """Boxes that hold anything; a bound that is null holds nothing."""
    for a in AXES:
        boxes = boxes.filter((F.col(f"{a}1") > F.greatest(F.col(f"{a}0"), F.lit(0))) & F.col(f"{a}0").isNotNull())
    return boxes


def files_of(spark: SparkSession, path: str, boxes: DataFrame) -> list:
    """Names of the files that hold any cube the boxes meet: all that goes to the driver, at most one name a file."""
    manifest = spark.read.parquet(f"{path}/manifest")
    first = manifest.select("edge").first()
    if first is None:
        return []
    side = first.edge << CUBE_BITS
    asked = _stay(boxes)
    for a in AXES:
        asked = asked.withColumn(f"c{a}", F.explode(_numbers(a, side)))
    cubes = asked.select("scan_id", "level", morton(F.col("cz"), F.col("cy"), F.col("cx")).alias("cube")).distinct()
    hit = manifest.join(cubes, ["scan_id", "level", "cube"], "left_semi")
    return sorted(r.file for r in hit.select("file").distinct().collect())


def read_boxes(spark: SparkSession, path: str, boxes: DataFrame) -> DataFrame:
    """Lines ``(box_id, scan_id, level, z, y, x0, values)`` inside ``boxes(box_id, scan_id, level, z0, z1, y0, y1, x0, x1)``.

    Bounds are half open and are cut to the volume; an empty box gives nothing.  Only files that the manifest names are
    opened.  Of these the bricks are joined on their numbers, and each brick gives its part of a line, from ``x0`` on.
    """
    names = files_of(spark, path, boxes)
    schema = spark.read.parquet(f"{path}/bricks").schema
    held = spark.read.schema(schema)
    bricks = held.parquet(*[f"{path}/bricks/{n}" for n in names]) if names else held.parquet(f"{path}/bricks").filter(F.lit(False))
    first = spark.read.parquet(f"{path}/manifest").select("edge").first()
    edge = first.edge if first else 1
    asked = _stay(boxes)
    for a in AXES:
        asked = asked.withColumn(f"b{a}", F.explode(_numbers(a, edge)))
    return _inside(bricks.join(asked, ["scan_id", "level", "bz", "by", "bx"]), edge)


def _inside(met: DataFrame, edge: int) -> DataFrame:
    start = F.greatest(F.col("x0"), F.col("bx") * edge, F.lit(0))
    rows = met.withColumns({"_from": start, "_line": F.explode("lines")}).filter(
        "_line.z >= z0 and _line.z < z1 and _line.y >= y0 and _line.y < y1")
    values = F.slice("_line.values", F.col("_from") - F.col("bx") * edge + 1, F.col("x1") - F.col("_from"))
    return rows.select("box_id", "scan_id", "level", "_line.z", "_line.y", F.col("_from").alias("x0"), values.alias("values")).filter(F.size("values") > 0)
