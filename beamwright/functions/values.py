"""Functions on metadata values, clocks and small arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """The number, or null for NaN and both infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def json_safe(values: Column) -> Column:
    return F.to_json(F.transform(values, finite))


def decimate(values: Column, n: int = 10) -> Column:
    step = F.greatest(F.lit(1), F.floor(F.size(values) / n)).cast("int")
    return F.filter(values, lambda _, i: i % step == 0)


def coerce_value(str_value: Column, num_value: Column, str_list: Column, num_list: Column) -> Column:
    """Scalars stay scalars, one-element lists become scalars, others stay lists."""
    one_s, one_n = F.size(str_list) == 1, F.size(num_list) == 1
    return F.struct(
        F.coalesce(str_value, F.when(one_s, F.get(str_list, 0))).alias("str_value"),
        F.coalesce(num_value, F.when(one_n, F.get(num_list, 0))).alias("num_value"),
        F.when(F.size(str_list) != 1, str_list).alias("str_list"),
        F.when(F.size(num_list) != 1, num_list).alias("num_list"),
    )


def or_unknown(text: Column, unknown: str = "Unknown") -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(unknown))


def iso_utc(epoch: Column) -> Column:
    """Epoch seconds as ISO-8601 text with a zero offset (session zone UTC)."""
    micros = F.rint(epoch.cast("double") * 1000000).cast("bigint")
    ts = F.timestamp_micros(micros)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(micros % 1000000 != 0, part).otherwise(F.lit("")), F.lit("+00:00"))


def older_than(ts: Column, days: Column | int, now: Column) -> Column:
    """Strictly older than ``days`` before ``now``."""
    days = F.lit(days) if isinstance(days, int) else days
    return ts < now - F.make_dt_interval(days)


def normalise_units(pixel_mm: Column, distances: Column, energies: Column, fallback_kev: float = 30.0) -> Column:
    """Pixel size in cm and micrometre, propagation distance, energy in keV."""

    def first_nonzero(a):
        return F.when(F.get(a, 0) == 0, F.get(a, 1)).otherwise(F.get(a, 0))

    kev = first_nonzero(energies) / 1000
    plain = finite(kev)
    return F.struct(
        (pixel_mm / 10).alias("pixel_cm"),
        (pixel_mm * 1000).alias("pixel_um"),
        first_nonzero(distances).alias("distance"),
        F.when(plain.isNull() | (plain > 1000), F.lit(fallback_kev)).otherwise(plain).alias("kev"),
    )


def flat_groups(n: Column, cycle: Column, ends_only_last: bool = False) -> Column:
    """Projection numbers at which bright fields were taken; null when there are none."""
    last = n - 1
    stepped = F.sequence(F.lit(0), last, F.greatest(cycle, F.lit(1)))
    ends = F.array(last) if ends_only_last else F.array(F.lit(0).cast("int"), last)
    return F.when(cycle > 0, F.array_union(stepped, F.array(last))).when(cycle == 0, ends)


def central_rows(total: Column, n: Column) -> Column:
    """struct(start, stop) of the ``n`` rows around the middle."""
    mid = F.floor(total / 2)
    return F.struct(
        (mid - F.ceil(n / 2)).cast("int").alias("start"),
        (mid + F.floor(n / 2)).cast("int").alias("stop"),
    )


def strided(i: Column, start, stop, step) -> Column:
    """True where ``i`` is in ``range(start, stop, step)``."""
    step = F.lit(step) if isinstance(step, int) else step
    return (i >= start) & (i < stop) & (F.pmod(i - start, step) == 0)


def chunk_of(position: Column, size: int = 100) -> Column:
    return F.floor(position / size).cast("int")


def chunk_count(n: Column, size: int = 100) -> Column:
    return (F.floor((n - 1) / size) + 1).cast("int")


def output_name(prefix: Column, number: Column, suffix: str = "") -> Column:
    return F.format_string(f"%s_%05d{suffix}", prefix, number)
