"""Segmented windows equal plain windows, also when one key holds most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from beamwright.operators import inventory, segments


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(4000).withColumn("k", F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 7))
    df = df.withColumn("ts", F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(40000))))
    return df.withColumn("state", F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 8, "bad").otherwise("good")).cache()


@pytest.mark.parametrize("seconds", [60, 1000, 1_000_000])
def test_segmented_equals_plain(rows, seconds):
    seg = segments.time_segment(F.col("ts"), seconds)
    w = Window.partitionBy("k").orderBy("ts", "id")
    order = ["ts", "id"]
    a = segments.with_row_number(rows, ["k"], order, seg, "x").select("id", "x")
    assert a.exceptAll(rows.withColumn("x", F.row_number().over(w).cast("bigint")).select("id", "x")).count() == 0
    a = segments.with_previous(rows, ["k"], order, seg, "state", "x").select("id", "x")
    assert a.count() == 4000
    assert a.exceptAll(rows.withColumn("x", F.lag("state").over(w)).select("id", "x")).count() == 0
    a = segments.with_run_length(rows, ["k"], order, seg, F.col("state") == "bad", "x").select("id", "x")
    b = rows.withColumn("g", F.sum((F.col("state") != "bad").cast("int")).over(w))
    run = Window.partitionBy("k", "g").orderBy("ts", "id")
    b = b.withColumn("x", F.sum((F.col("state") == "bad").cast("int")).over(run)).select("id", "x")
    assert a.exceptAll(b).count() == 0 and a.count() == 4000


def test_prefix_segments_keep_text_order(spark):
    df = spark.range(500).select(F.lit("s").alias("scan_id"), F.md5(F.col("id").cast("string")).alias("path"))
    from beamwright.operators.frames import ordered_stack

    got = [r.path for r in ordered_stack(df).orderBy("z").collect()]
    assert got == sorted(got) and len(got) == 500


def test_prune_batches_split_a_hot_endpoint_and_lose_nothing(spark):
    plan = spark.range(5000).select(F.lit("ep").alias("source"), F.col("id").cast("string").alias("rel_path"))
    b = inventory.prune_batch(plan, 500).collect()
    assert len(b) == 10 and max(r.files for r in b) < 700
    assert len({p for r in b for p in r.paths}) == 5000


def test_rows_without_key_or_order_stay(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3), (None, None), ("a", 9000), ("b", 2)], "k string, n int")
    seg, w = segments.number_segment(F.col("n")), Window.partitionBy("k").orderBy("n")
    same = lambda a, b: a.count() == 6 and a.exceptAll(b.select(a.columns)).count() == 0
    assert same(segments.with_row_number(df, ["k"], ["n"], seg, "x"), df.withColumn("x", F.row_number().over(w).cast("bigint")))
    assert same(segments.with_previous(df, ["k"], ["n"], seg, "n", "x"), df.withColumn("x", F.lag("n").over(w)))
    assert same(segments.with_key_minimum(df, ["k"], seg, "n", "x"), df.withColumn("x", F.min("n").over(Window.partitionBy("k"))))
    plan = spark.createDataFrame([("ep", "a"), (None, "b"), (None, "c")], "source string, rel_path string")
    assert sum(r.files for r in inventory.prune_batch(plan, 10).collect()) == 3


def test_nothing_of_unknown_age_is_pruned(spark):
    held = spark.createDataFrame(
        [("src", "old", 1), ("src", "blank", 1), ("src", "odd", None), ("chk", "old", 1), ("chk", "blank", None)], "endpoint_key string, rel_path string, s long")
    held = held.withColumn("last_modified", F.timestamp_seconds("s")).drop("s")
    asked = spark.createDataFrame(
        [("src", "chk", "old"), ("src", "chk", "blank"), ("src", None, "odd"), ("src", "chk", "gone"), ("src", "nowhere", "old")], "source string, check string, rel_path string")
    got = inventory.prune_guard(asked, held, F.lit("2020-01-01").cast("timestamp"), 1000).select("check", "rel_path", "verdict").collect()
    assert {(r.check, r.rel_path): r.verdict for r in got} == {
        ("chk", "old"): "PRUNE", ("chk", "blank"): "TOO_NEW", (None, "odd"): "TOO_NEW", ("chk", "gone"): "SOURCE_MISSING", ("nowhere", "old"): "NO_SECOND_COPY"}


def test_levels_go_on_until_the_side_is_small(spark):
    from beamwright.operators.pyramid import level_count

    sizes = spark.createDataFrame([(4096, 4096, 4096), (4, 4, 4), (5, 9, 9), (1 << 30, 1 << 30, 1 << 30)], "nz int, ny int, nx int")
    assert [r[0] for r in sizes.select(level_count(4)).collect()] == [10, 0, 1, 28]


def test_listing_tells_hidden_names_and_folders(spark, tmp_path):
    from beamwright.sources.readers import inventory_scan

    (tmp_path / "a" / ".hidden").mkdir(parents=True)
    for name in ("top.h5", "a/_started", "a/.dot", "a/.hidden/deep.tif", "a/plain name.tif"):
        (tmp_path / name).write_text(name)
    rows = {r.rel_path: r for r in inventory_scan(spark, str(tmp_path), "ep").collect()}
    assert {p for p, r in rows.items() if r.type == "file"} == {"top.h5", "a/_started", "a/.dot", "a/.hidden/deep.tif", "a/plain name.tif"}
    assert {p for p, r in rows.items() if r.type == "dir"} == {"a", "a/.hidden"}
    assert rows["a/.dot"].size == 6 and rows["a/.dot"].name == ".dot" and rows["top.h5"].last_modified is not None
    assert {r.rel_path for r in inventory_scan(spark, f"file://{tmp_path}", "ep", depth=1).collect()} == {"top.h5", "a"}
