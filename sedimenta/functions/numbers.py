"""Numeric rules. Text that is no number becomes null; nothing here raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own cast also takes `12f`, `1d` and `Infinity`; business text must not. Blanks around
# a number are allowed, and the casts below skip them too. Text is matched before it is cast: a
# refused cast costs an exception, twenty times the match.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Forms too short to overflow: a double of at most 200 digits before the point and an exponent
# below 100, a bigint of at most 18 digits.
_ORDINARY = r"^\s*[+-]?(\d{1,200}\.?\d*|\.\d+)([eE][+-]?\d\d?)?\s*$"
_DIGITS = r"^\s*[+-]?\d{1,18}\s*$"


def to_number(text: Column) -> Column:
    """Numeric text to double; junk, empty text and overflow to null."""
    value = text.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(text.rlike(_ORDINARY), value).when(text.rlike(NUMBER) & finite, value)


def to_integer(text: Column) -> Column:
    """Numeric text to bigint: `1e3` and `12.0` count, fractions and overflow become null.

    Plain digits take the first branch; the rest goes by decimal, which (unlike a detour over
    double) keeps all 19 digits of a key.
    """
    exact = text.try_cast("decimal(38,18)")
    return F.when(text.rlike(_DIGITS), text.try_cast("bigint")).when(
        text.rlike(NUMBER) & (exact % 1 == 0), exact.try_cast("bigint")
    )


def whole(value: Column) -> Column:
    """Double to bigint where it has no fraction, else null."""
    return F.when(value % 1 == 0, value).try_cast("bigint")


def in_range(value: Column, low: float, high: float) -> Column:
    """The value if it lies in [low, high], else null."""
    return F.when(value.between(low, high), value)


def positive_or_zero(value: Column) -> Column:
    """Missing, invalid and non-positive numbers become 0."""
    return F.when((value > 0) & ~F.isnan(value), value).otherwise(F.lit(0.0))


def cents(value: Column) -> Column:
    """Two decimals, binary ties to even: scale, round to the nearest integer, scale back."""
    return F.rint(value * 100) / F.lit(100.0)


def repair_quantity(quantity: Column, total: Column, unit_price: Column) -> Column:
    """A positive quantity, or the nearest one that explains the total (ties to even)."""
    implied = F.rint(F.try_divide(total, unit_price))
    return whole(F.when(quantity > 0, quantity).otherwise(implied))


def _rounded(value: Column, places: int) -> Column:
    """Half away from zero on the decimal value, so 123.44499999999999 from binary noise
    still rounds as 123.445. The decimal is wide enough for every double that has a fraction;
    larger ones are whole already."""
    exact = F.round(value.try_cast(f"decimal(38,{places + 4})"), places)
    return F.coalesce(exact.cast("double"), value)


def money(value: Column) -> Column:
    return _rounded(value, 2)


def fraction(value: Column) -> Column:
    return _rounded(value, 4)


# Amounts from here on are no amounts: no decimal with cents holds them.
_NO_AMOUNT = 1e36
# Amounts from here on are summed in units of 10^18 and what is left of them.
_LARGE, _UNIT = 1e20, 10**18


def money_sum(amount: Column) -> Column:
    """Sum of amounts, the same for any row order: exact decimals throughout, also where the total
    is wider than a decimal. What `money_left_out` counts is no amount and counts as missing."""
    known = F.when(F.abs(amount) < _NO_AMOUNT, amount)
    unit = F.lit(_UNIT).cast("decimal(19,0)")
    # Any whole number of units near the amount will do: what is left is told in decimals.
    units = F.when(F.abs(known) >= _LARGE, (known / _UNIT).cast("bigint")).cast("decimal(18,0)")
    exact = known.try_cast("decimal(38,2)")
    rest = F.coalesce(exact - (units * unit).cast("decimal(38,2)"), exact).cast("decimal(24,2)")
    units, rest = F.sum(units), F.sum(rest)
    in_units = F.coalesce(units, F.lit(0)).try_cast("decimal(18,0)") * unit
    total = F.try_add(in_units.try_cast("decimal(38,2)"), rest).cast("double")
    # Beyond 38 digits, cents are far below what a double tells apart.
    return F.coalesce(total, units.cast("double") * float(_UNIT) + rest.cast("double"))


def money_left_out(amount: Column) -> Column:
    """How many amounts `money_sum` leaves out: infinite, not a number, or 1e36 and more."""
    return F.count_if(amount.isNotNull() & ~(F.abs(amount) < _NO_AMOUNT))


def margin(price: Column, cost: Column) -> Column:
    return money(price - cost)


def margin_share(price: Column, cost: Column) -> Column:
    """Margin as a fraction of the price; null for a price of 0."""
    return fraction(F.try_divide(price - cost, F.nullif(price, F.lit(0.0))))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in deviations; null when there is no spread."""
    return F.try_divide(value - mean, deviation)
