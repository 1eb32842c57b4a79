"""Number, array and code expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of weekday codes 1 to 7.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def round_half_even(x: Column, digits: int = 2) -> Column:
    return F.bround(x, digits)


def product(a: Column, b: Column) -> Column:
    """Product in double, so that wide integers cannot overflow."""
    return a.cast("double") * b.cast("double")


def square(a: Column) -> Column:
    return product(a, a)


def row_max(*cols: Column) -> Column:
    """Largest value of the row, NULLs skipped."""
    return F.greatest(*cols)


def array_map(arr: Column, fn: Callable[[Column], Column]) -> Column:
    return F.transform(arr, fn)


def band_from_array(ages: Column) -> Column:
    """[lo] or [lo, hi] as struct (lo, hi); one element means open-ended."""
    return F.struct(F.try_element_at(ages, F.lit(1)).alias("lo"), F.try_element_at(ages, F.lit(2)).alias("hi"))


def code_to_label(code: Column, labels: Sequence[str] = WEEKDAYS) -> Column:
    """Label of a code counted from 1, NULL outside the list."""
    names = F.array(*[F.lit(v) for v in labels])
    return F.when((code >= 1) & (code <= len(labels)), F.try_element_at(names, code.cast("int")))


def same_value(a: Column, b: Column) -> Column:
    """Equality of two values of unlike type, compared as numbers."""
    return a.try_cast("double") == b.try_cast("double")
