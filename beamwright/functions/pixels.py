"""Pixelwise steps as element expressions.

A step maps one pixel (a double column) to one pixel.  Every step is one
``transform`` over the detector row: inside a lambda Spark shares no common
parts, so a composed expression would compute an input once per mention.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = Callable[[Column], Column]


def apply(values: Column, *steps: Step) -> Column:
    def one(step):
        return lambda x: step(x.cast("double"))

    for step in steps:
        values = F.transform(values, one(step))
    return values


def normalize(values: Column, dark: Column, flat: Column, *steps: Step, floor: float = 1e-6) -> Column:
    """(v − dark) / max(flat − dark, floor), then any further steps."""

    def body(v, i):
        d = F.get(dark, i).cast("double")
        return (v.cast("double") - d) / F.greatest(F.get(flat, i).cast("double") - d, F.lit(floor))

    return apply(F.transform(values, body), *steps)


def exposure_scale(ratio: float) -> Step:
    return lambda x: x if ratio == 1 else x * F.lit(float(ratio))


def minus_log(minimum: float = 0.01) -> Step:
    """−ln of the value held above a minimum; NaN counts as the minimum."""
    low = F.lit(float(minimum))
    return lambda x: -F.log(F.when(F.isnan(x), low).otherwise(F.greatest(x, low)))


def beam_hardening(coefficients) -> Step:
    """Polynomial, lowest order first."""

    def step(x):
        total = F.lit(float(coefficients[-1]))
        for a in reversed(coefficients[:-1]):
            total = total * x + F.lit(float(a))
        return total

    return step


def scale(factor: Column) -> Step:
    return lambda x: x * factor


def cast_8bit(low: float = -10.0, high: float = 30.0) -> Step:
    """0..255 over [low, high], clamped and truncated; NaN becomes 0."""

    def step(x):
        s = F.lit(0.5) + 255.0 * (x - F.lit(float(low))) / F.lit(float(high - low))
        clamped = F.least(F.greatest(s, F.lit(0.0)), F.lit(255.0))
        return F.when(F.isnan(x), F.lit(0)).otherwise(F.floor(clamped)).cast("smallint")

    return step


def zero_where(flag: Column) -> Step:
    return lambda x: F.when(flag, F.lit(0.0)).otherwise(x)


# ------------------------------------------------------------- whole-row forms
def pad_edge(values: Column, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    left = F.array_repeat(F.get(values, 0), n)
    right = F.array_repeat(F.element_at(values, -1), n)
    return F.concat(left, values, right)


def crop(values: Column, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(values, n + 1, F.size(values) - 2 * n)


def zeros_like(values: Column) -> Column:
    return F.transform(values, lambda _: F.lit(0.0))


def shift(values: Column, by: Column) -> Column:
    """Move a row ``by`` whole pixels to the right, zeros coming in."""
    w = F.size(values)
    k = F.least(F.abs(by), w).cast("int")
    zeros = F.array_repeat(F.lit(0.0), k)
    body = values.cast("array<double>")
    right = F.concat(zeros, F.slice(body, F.lit(1), w - k))
    left = F.concat(F.slice(body, k + 1, w - k), zeros)
    return F.when(by >= 0, right).otherwise(left)


def blend(a: Column, b: Column, weight: Column) -> Column:
    """(1 − weight)·a + weight·b, element by element."""
    return F.zip_with(a, b, lambda x, y: (1 - weight) * x.cast("double") + weight * y.cast("double"))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def middle(a: Column, b: Column, c: Column) -> Column:
    """Median of three numbers."""
    return F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))
