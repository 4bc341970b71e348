"""Arithmetic that gives the same answer however Spark splits the rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICRO = Decimal("0.000001")
#: Amounts from here on are split by powers of two, so that no BIGINT sum can overflow.
_PARTS_BELOW = 1e9
_LIMBS_BELOW = 2.0**68
#: Limbs are multiples of these, of 30 bits at most: what twelve decimals leave of a small amount
#: lies under 2**-39, and a large one has no bits under 2**-22.
_WEIGHTS = {"fine": 2.0**-69, "finest": 2.0**-99, "high": 2.0**38, "mid": 2.0**8, "low": 2.0**-22}
_PARTS = ("whole", "micro", "pico", *_WEIGHTS, "rest")


def _split(value: Column, kind: T.DataType) -> dict[str, Column]:
    """A number as parts whose sums do not depend on the order of the rows.

    These are whole units, millionths and millionths of those, all BIGINT. What they miss of a
    small amount (more than twelve decimals), and the whole of a large one, goes to limbs: whole
    multiples of fixed powers of two that give back the very same DOUBLE. They are NULL for
    other amounts. The DOUBLE at the end is for what has no limb: infinite and undefined
    values, amounts from 2**68 up, bits under 2**-99. Nothing is rounded away. A BIGINT sum
    holds 2**33 of the largest parts.
    """
    zero = F.lit(0).cast("bigint")
    if isinstance(kind, T.IntegralType):
        none, no_limb = F.when(value.isNotNull(), zero), F.lit(None).cast("bigint")
        limbs = dict.fromkeys(_WEIGHTS, no_limb)
        parts = {"whole": value.cast("bigint"), "micro": none, "pico": none}
        return parts | limbs | {"rest": none.cast("double")}
    value = value.cast("double")
    small = F.abs(value) < F.lit(_PARTS_BELOW)  # false for NaN, which is above all numbers
    large = ~small & (F.abs(value) < F.lit(_LIMBS_BELOW))
    held = F.when(small, value).otherwise(F.when(value.isNotNull(), F.lit(0.0)))
    whole = F.floor(held)
    micro = F.rint((held - whole) * 1e6).cast("bigint")
    pico = F.rint(((held - whole) - micro / F.lit(1e6)) * 1e12).cast("bigint")
    back = whole + (micro * 1_000_000 + pico) / F.lit(1e12)
    missed = value - back

    def limb(amount: Column, name: str) -> Column:
        return (amount * F.lit(1 / _WEIGHTS[name])).cast("bigint")

    long = small & (back != value)
    return {
        "whole": whole,
        "micro": micro,
        "pico": pico,
        "fine": F.when(long, limb(missed, "fine")),
        "finest": F.when(long, limb(missed % F.lit(_WEIGHTS["fine"]), "finest")),
        "high": F.when(large, limb(value, "high")),
        "mid": F.when(large, limb(value % F.lit(_WEIGHTS["high"]), "mid")),
        "low": F.when(large, limb(value % F.lit(_WEIGHTS["mid"]), "low")),
        "rest": F.when(long, missed % F.lit(_WEIGHTS["finest"]))
        .when(small | large, F.lit(0.0))
        .otherwise(value),
    }


def _names(name: str) -> list[str]:
    return [f"{name}_{part}" for part in _PARTS]


def sum_parts(df: DataFrame, source: str, name: str) -> list[Column]:
    """Aggregates that hold SUM(source) in several columns, to be summed on and put together later.

    Floating-point sums change with the order of the rows, and DECIMAL sums cost several
    times the rest of a scan. BIGINT sums are exact and stay in generated code.
    """
    parts = _split(F.col(source), df.schema[source].dataType)
    return [F.sum(part).alias(f"{name}_{key}") for key, part in parts.items()]


def _together(sums: dict[str, Column]) -> Column:
    """DOUBLE of the sums of all parts. With no more than six decimals it is rounded only once."""
    limbs = F.lit(0.0)
    for name, weight in sorted(_WEIGHTS.items(), key=lambda item: item[1]):
        limbs = limbs + F.coalesce(sums[name].cast("double"), F.lit(0.0)) * F.lit(weight)
    units = (sums["whole"] + sums["micro"] * F.lit(MICRO)).cast("double")
    return units + ((sums["pico"].cast("double") / 1e12 + limbs) + sums["rest"])


def sum_of_parts(name: str, times: Column | None = None) -> Column:
    """The last aggregate over the columns of ``sum_parts``; each row counts ``times`` times."""
    columns = dict(zip(_PARTS, (F.col(c) for c in _names(name))))
    rest = columns.pop("rest")
    if times is None:
        sums = {part: wide(F.sum(c)) for part, c in columns.items()}
        return _together(sums | {"rest": F.sum(rest)})
    sums = {part: F.sum(wide(c) * times) for part, c in columns.items()}
    return _together(sums | {"rest": F.sum(rest * times.cast("double"))})


def exact_sum(df: DataFrame, name: str, over: WindowSpec | None = None) -> Column:
    """SUM of a numeric column as DOUBLE, not dependent on the order of the rows.

    NaN and infinite values give what a DOUBLE SUM gives; without values it is NULL.
    """
    sums = {key: F.sum(part) for key, part in _split(F.col(name), df.schema[name].dataType).items()}
    if over is not None:
        sums = {key: total.over(over) for key, total in sums.items()}
    rest = sums.pop("rest")
    return _together({key: wide(total) for key, total in sums.items()} | {"rest": rest})


def wide(value: Column) -> Column:
    """An integer as DECIMAL, so products of two large counts cannot overflow a BIGINT."""
    return value.cast(T.DecimalType(20, 0))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, 0 when there is nothing to divide by."""
    quotient = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, quotient).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
