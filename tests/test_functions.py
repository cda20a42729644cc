"""Literal cases of the scalar functions."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from beamwright import fixed
from beamwright.functions import paths, text, values
from beamwright.operators import catalogue, inventory, routing


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize("raw,want", [
    ("  user@example.com  ", "user@example.com"), (None, fixed.UNKNOWN_EMAIL), ("   ", fixed.UNKNOWN_EMAIL),
    ("invalid-email", fixed.UNKNOWN_EMAIL), ("NONE", fixed.UNKNOWN_EMAIL), ("none", fixed.UNKNOWN_EMAIL),
    (" user @ example.com ", "user@example.com"), (" 'a@b.c', ", "a@b.c"), ("a\t@b.c", "a\t@b.c"),
])
def test_clean_email(spark, raw, want):
    assert one(spark, text.clean_email(F.lit(raw).cast("string"))) == want


def test_search_terms(spark):
    assert one(spark, text.search_terms(F.lit("Time-is_an illusion. Lunchtime/2x\\so."))) == "time is an illusion lunchtime 2x so"
    assert one(spark, text.search_terms(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize("line,proposal,owner,groups", [
    (None, None, "u", []), (None, "42", "42", []), ("10.3.1", None, "u", ["10.3.1", "u"]),
    ("10.3.1", "42", "42", ["10.3.1", "u"]), ("bl832", "42", "42", ["bl832", "u", "8.3.2"]),
    (" 'bl832', ", "None", "u", ["bl832", "u", "8.3.2"]), ("", "", "u", []),
])
def test_access_controls(spark, line, proposal, owner, groups):
    got = one(spark, text.access_controls(F.lit("u"), F.lit(line).cast("string"), F.lit(proposal).cast("string")))
    assert (got.owner_group, got.access_groups) == (owner, groups)


def test_json_safe(spark):
    got = json.loads(one(spark, values.json_safe(F.array(*map(F.lit, (1.5, math.inf, -math.inf, math.nan, 2.0))))))
    assert got == [1.5, None, None, None, 2.0]


def test_older_than_is_strict(spark):
    now = F.lit("2022-11-16 23:17:43").cast("timestamp")
    for day, older in (("2022-11-01 23:17:43", True), ("2022-11-03 23:17:43", False), ("2022-11-02 23:17:43", False)):
        assert one(spark, values.older_than(F.lit(day).cast("timestamp"), 14, now)) is older


def test_endpoint_registry(spark):
    rows = [("test_endpoint", {"name": "n", "root_path": "/data", "uri": "${HOST}.example", "uuid": "$ID-$OTHER"})]
    df = spark.createDataFrame(rows, "endpoint_key string, props map<string,string>")
    r = inventory.endpoint_registry(df, {"HOST": "test", "ID": "12$5"}).first()
    assert (r.root_path, r.uri, r.uuid) == ("/data", "test.example", "12$5-$OTHER")


@pytest.mark.parametrize("raw,kind,value", [
    ("5", "int", 5), ("-7", "int", -7), ("5.5", "float", 5.5), ("1e3", "float", 1000.0), (".5", "float", 0.5), ("x5", "str", "x5"),
    ("5\n", "str", "5\n"), ("99999999999999999999", "float", 1e20),
])
def test_typed_literal(spark, raw, kind, value):
    r = one(spark, text.typed_literal(F.lit(raw)))
    assert r.type == kind and r[f"{kind}_value"] == value


def test_spec_map(spark):
    m = one(spark, text.spec_map(F.lit('f.h5 cor 1196 sinoused "-1,10,1" cor 7 dangling')))
    assert m == {"sinoused": ["-1", "10", "1"], "cor": ["7"]}
    assert one(spark, text.spec_map(F.lit("f.h5"))) == {}


def test_overlay_keeps_order_and_drops_unknown(spark):
    m = text.overlay_params(fixed.SPLIT_SOLVER_DEFAULTS, F.create_map(F.lit("n_modes"), F.lit("3"), F.lit("zz"), F.lit("1")))
    assert one(spark, F.map_keys(m)) == list(fixed.SPLIT_SOLVER_DEFAULTS)
    assert one(spark, m["n_modes"]) == "3"


def test_paths(spark):
    f = F.lit
    assert one(spark, paths.rel_path(f("/global/raw/a/b.h5"))) == "raw/a/b.h5"
    assert one(spark, paths.rel_path(f("/raw/a/b.h5"))) is None
    assert one(spark, paths.full_path(f("/"), f("/a/b"))) == "/a/b"
    assert one(spark, paths.full_path(f("/d/"), f("//a"))) == "/d/a"
    assert one(spark, paths.full_path(f("/d/"), f(""))) == "/d"
    r = one(spark, paths.recon_paths(f("/dabramov/2023_x.y_fast.h5")))
    assert (r.stem, r.raw_path, r.zarr_path) == ("2023_x.y_fast", "dabramov/2023_x.y_fast.h5", "dabramov/rec2023_x.y_fast.zarr/")
    s = one(spark, paths.parse_scan_name(f("ABC-01234_someone"), f("20230224_132553_sea_shell_x01y02.h5")))
    assert (s.proposal, s.user, s.label, s.tile_x, s.tile_y) == ("ABC-01234", "someone", "sea_shell", 1, 2)
    assert s.acquired_at == dt.datetime(2023, 2, 24, 13, 25, 53)
    assert one(spark, paths.ancestors(f("a/b/c.h5"))) == ["a", "a/b"]


def test_data_uri_is_one_line(spark):
    uri = one(spark, text.data_uri(F.encode(F.lit("x" * 500), "UTF-8")))
    assert "\n" not in uri and "\r" not in uri and uri.startswith("data:image/jpg;base64,eHh4")


def test_decimate_and_rows(spark):
    seq = F.sequence(F.lit(0), F.lit(18))
    assert one(spark, values.decimate(seq)) == list(range(19))
    assert one(spark, values.decimate(F.sequence(F.lit(0), F.lit(24)))) == list(range(0, 25, 2))
    c = one(spark, values.central_rows(F.lit(100), F.lit(5)))
    assert (c.start, c.stop) == (47, 52)


def test_flow_gating(spark):
    rows = [(1, True, True, True, True, True), (2, True, False, True, True, True), (3, True, True, False, True, True), (4, False, True, True, True, True)]
    df = spark.createDataFrame(rows, "run int, copy_in boolean, recon boolean, pyramid boolean, tiff_back boolean, zarr_back boolean")
    got = {r.run: (r.success, r.copies, r.schedules_prune) for r in routing.flow_outcome(df).collect()}
    assert got == {1: (True, 3, True), 2: (False, 1, False), 3: (False, 1, False), 4: (False, 1, False)}


def test_route_none_enabled_and_unknown(spark):
    files = spark.createDataFrame([("a",)], "file_path string")
    assert routing.route(files, {k: False for k in fixed.FLOW_PARAMETERS}).count() == 0
    assert routing.route(files, {"stray": True}).first().error == "unknown flow stray"


def test_empty_stack_is_an_error(spark):
    inv = spark.createDataFrame([("s1/.hidden", ".hidden"), ("s2/a.tif", "a.tif")], "rel_path string, name string")
    stacks = spark.createDataFrame([("s1",), ("s2",)], "scan_id string")
    got = inventory.empty_stacks(stacks, inv).collect()
    assert [(r.scan_id, r.severity) for r in got] == [("s1", "error")]


def test_zero_days_skips_age_and_null_check_skips_copy(spark):
    inv = spark.createDataFrame([("A", "p", dt.datetime(2022, 1, 1)), ("A", "q", dt.datetime(2022, 1, 1))],
                                "endpoint_key string, rel_path string, last_modified timestamp")
    rq = spark.createDataFrame([("A", None, "p"), ("A", "B", "q"), ("A", None, "zz")], "source string, check string, rel_path string")
    now = F.lit("2022-01-01 12:00:00").cast("timestamp")
    got = {r.rel_path: r.verdict for r in inventory.prune_guard(rq, inv, now, 0).collect()}
    assert got == {"p": "PRUNE", "q": "NO_SECOND_COPY", "zz": "SOURCE_MISSING"}
    assert {r.verdict for r in inventory.prune_guard(rq.filter("rel_path = 'p'"), inv, now, 3).collect()} == {"TOO_NEW"}


def test_duplicate_key_warns_twice(spark):
    scans = spark.createDataFrame([("s",)], "scan_id string")
    meta = spark.createDataFrame([], "scan_id string, key string, str_value string, num_value double, str_list array<string>, num_list array<double>")
    assert catalogue.missing_fields(scans, meta, fixed.SCIENTIFIC_KEYS).count() == len(fixed.SCIENTIFIC_KEYS)
    assert len(catalogue.distinct_keys(fixed.SCIENTIFIC_KEYS)) == len(fixed.SCIENTIFIC_KEYS) - 1
