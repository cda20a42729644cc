"""Numpy functions over one projection, one sinogram or one slice.

The adapter turns the detector rows of a group into one matrix without a
per-row copy and checks what comes back.  A group is one detector frame, one
(part of a) sinogram or one slice: its size is set by the instrument, not by
the number of scans.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROJECTION = (["scan_id", "idx"], "row")
SINOGRAM = (["scan_id", "row"], "idx")
SLICE = (["scan_id", "z"], "y")


def to_matrix(table: pa.Table, column: str = "values") -> np.ndarray:
    col = table.column(column).combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if len(flat) % max(len(col), 1) or flat.size != sum_lengths(col):
        raise ValueError("detector rows of one group differ in length")
    return flat.reshape(len(col), -1).astype("f8")


def sum_lengths(col) -> int:
    lengths = np.diff(col.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        return -1
    return int(lengths.sum())


def to_lists(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix, dtype="f8")
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype="i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def grouped_kernel(
    df: DataFrame, axis: tuple, fn: Callable, extra_keys: list = (), carry: list = (), same_rows: bool = True,
    order_out: str | None = None,
) -> DataFrame:
    """``fn(matrix, info)`` per group, rows sorted along the axis.

    ``info`` holds the order column and the carried columns as arrays.  With
    ``same_rows`` the result must have one row per input row, and carried
    columns pass through; otherwise rows are numbered from 0.
    """
    keys, order = [*axis[0], *extra_keys], axis[1]
    out_order = order_out or order
    types = dict(df.dtypes)
    kept = list(carry) if same_rows else []
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*keys, *kept])
    schema += f", `{out_order}` int, `values` array<double>"
    want = pa.int32()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        info = {c: table.column(c).to_numpy() for c in (order, *carry)}
        result = np.asarray(fn(to_matrix(table), info))
        if result.ndim != 2 or (same_rows and len(result) != table.num_rows):
            raise ValueError(f"kernel returned shape {result.shape} for {table.num_rows} rows")
        n = len(result)
        columns = {k: pa.array([table.column(k)[0].as_py()] * n, table.column(k).type) for k in keys}
        columns |= {c: table.column(c).combine_chunks() for c in kept}
        columns[out_order] = table.column(order).cast(want).combine_chunks() if same_rows else pa.array(np.arange(n), want)
        columns["values"] = to_lists(result)
        return pa.table(columns)

    rows = df.select(*keys, *[c for c in (order, *carry) if c not in keys], "values")
    return rows.groupBy(*keys).applyInArrow(run, schema)


def grouped_reduce(df: DataFrame, keys: list, fn: Callable) -> DataFrame:
    """``fn(matrix) -> vector`` per group: one row of ``values`` per key."""
    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keys) + ", `values` array<double>"

    def run(table: pa.Table) -> pa.Table:
        columns = {k: table.column(k).slice(0, 1) for k in keys}
        columns["values"] = to_lists(np.asarray(fn(to_matrix(table)))[None, :])
        return pa.table(columns)

    return df.select(*keys, "values").groupBy(*keys).applyInArrow(run, schema)


def in_ray_blocks(df: DataFrame, width: int, block: str = "block") -> DataFrame:
    """Rows cut into pieces of ``width`` rays, so that a group of very many rows
    is spread over several tasks."""
    last = F.floor((F.size("values") - 1) / width).cast("int")
    cut = df.withColumn(block, F.explode(F.sequence(F.lit(0), last)))
    return cut.withColumn("values", F.slice("values", F.col(block) * width + 1, F.lit(width)))


def from_ray_blocks(df: DataFrame, keys: list, block: str = "block") -> DataFrame:
    pieces = F.transform(F.sort_array(F.collect_list(F.struct(block, "values"))), lambda e: e["values"])
    return df.groupBy(*keys).agg(F.flatten(pieces).alias("values"))


def with_halo(df: DataFrame, position: str, size: int, half: int, chunk: str = "chunk") -> DataFrame:
    """Cut a long axis into chunks that also hold ``half`` neighbours on each side.

    Rows near a border are copied to the next chunk; ``core`` marks the one
    copy whose result counts.
    """
    p = F.col(position)
    parts = F.array_distinct(F.array(F.floor((p - half) / size), F.floor(p / size), F.floor((p + half) / size)))
    parts = F.filter(parts, lambda c: c >= 0)
    return df.withColumn(chunk, F.explode(parts)).withColumn("core", F.col(chunk) == F.floor(p / size))


def mean_frame():
    """Grouped aggregate: the element-wise mean of array rows (a user-defined form).

    ``operators.frames.reduce_reference`` is the native way and scales to any
    number of frames; this one serves small groups of reference frames.
    """
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<double>")
    def mean_frame_udf(v: pd.Series) -> list:
        return np.mean(np.stack(v.to_numpy()).astype("f8"), axis=0).tolist()

    return mean_frame_udf
