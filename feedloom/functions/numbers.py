"""Numeric expressions: rounding, shares and reproducible draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, places: int) -> Column:
    """Round half to even on the scaled double, as numpy and pandas do."""
    scale = float(10**places)
    return F.rint(value * scale) / scale


def round_away(value: Column, places: int) -> Column:
    """Round half away from zero on the scaled double, as spreadsheet measures do."""
    scale = float(10**places)
    scaled = value * scale
    return F.signum(scaled) * F.floor(F.abs(scaled) + 0.5) / scale


def round_exact(value: Column, places: int) -> Column:
    """Round the exact value of the double, as Python's round does: 2.675 is below the tie.

    Scaling rounds the product; its error, found with the halves of the value, tells on
    which side of a tie the exact product lies.
    """
    scale = float(10**places)
    product = value * scale
    high = value * 134217729.0 - (value * 134217729.0 - value)
    error = high * scale - product + (value - high) * scale
    below = F.floor(product).cast("double")
    rest = product - below
    tie = F.when(error > 0, below + 1).when(error < 0, below).otherwise(F.rint(product))
    return F.when(rest == 0.5, tie).otherwise(F.rint(product)) / scale


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null when whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def draw(key: Column, salt: str) -> Column:
    """A 32-bit integer that depends only on the key and the salt.

    Random-looking choices built on it do not change when the data is
    repartitioned, retried or re-read in another order.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit("|" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def unit(key: Column, salt: str) -> Column:
    """A double in [0, 1) that depends only on the key and the salt."""
    return draw(key, salt).cast("double") / F.lit(4294967296.0)


def choose(number: Column, values: list) -> Column:
    """One of the values, chosen by a number."""
    index = F.pmod(number, F.lit(len(values))) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def pick(key: Column, salt: str, values: list) -> Column:
    """One of the values, chosen by the key."""
    return choose(draw(key, salt), values)
