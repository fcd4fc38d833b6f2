"""Order-independent arithmetic on doubles.

A sum of doubles in floating point depends on the order of its terms, and so on how Spark splits the data. Here a
double is cut into its whole part and three LIMBS of its fraction, whole numbers of 25 bits each. The cut is exact, limbs are
summed as integers, and integer sums merge in any order to the same result. Only the finished total becomes a
double, rounded once. Nothing is rounded or cut before that: a value takes part with all its bits.

Range: fractions are exact to 2^-75 (about 2.6e-23) in groups of up to 2^38 rows, wholes as long as their sum stays below 2^63; a sum
that leaves 64 bits is an error, not a wrong number. (A total of 2^50 or more may be rounded twice.) What lies outside, values
of 2^62 or more, infinities, NaN and bits below 2^-75, is kept in one more term, a plain double, and added last.

Averages divide the total by the count, and `round` halves away from zero at the shortest decimal text of the double. A sum
can also be kept unfinished: `state` gives its columns, `merge` adds up such columns, and
`total` or `mean` finish them, so a table of states answers any coarser grouping exactly.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMBS, BITS = 3, 25
_LARGEST = 2.0 ** 62


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _two(power: int) -> Column:
    return F.lit(2.0 ** power)


# --- exact sums -------------------------------------------------------------------------

def limbs(c) -> list[Column]:
    """A double as integers (its whole part, the limbs of its fraction) and, as a double, what they cannot hold."""
    x = _c(c).cast("double")
    fits = F.abs(x) < _LARGEST
    left = F.when(fits, x)
    out = [left.cast("bigint")]
    for _ in range(LIMBS):  # no step repeats the one before it, so the expression stays small
        left = (left % 1.0) * _two(BITS)
        out.append(left.cast("bigint"))
    return [*out, F.when(fits, (left % 1.0) * _two(-BITS * LIMBS)).otherwise(x)]


def _finish(sums: list[Column]) -> Column:
    """The double nearest to the total of limb sums, plus the rest."""
    whole, *parts, rest = (s if i > LIMBS else s.cast("decimal(38,0)") for i, s in enumerate(sums))
    fraction = None
    for p in parts:  # in units of 2^-75, of either sign and with carries
        fraction = p if fraction is None else fraction * F.lit(Decimal(2 ** BITS)) + p
    small = (whole * F.lit(Decimal(2 ** (BITS * LIMBS))) + fraction).cast("double") * _two(-BITS * LIMBS)
    large = whole.cast("double") + fraction.cast("double") * _two(-BITS * LIMBS)
    total = F.when(F.abs(whole) < Decimal(2 ** 50), small).otherwise(large)
    # where no row fits (all infinite or NaN) there are no limbs, only the rest
    return F.coalesce(total + rest, rest)


def exact_sum(c) -> Column:
    """Aggregate: the sum of doubles, rounded once, whatever the order and the partitions; NULL without values."""
    return _finish([F.sum(p) for p in limbs(c)])


def exact_mean(c) -> Column:
    """Aggregate: `exact_sum` divided by the number of values."""
    return F.try_divide(exact_sum(c), F.count(_c(c)))


def state(c, name: str) -> list[Column]:
    """Aggregates: the columns {name}_0 ... {name}_rest and {name}_n of an unfinished sum."""
    return [F.sum(p).alias(s) for p, s in zip(limbs(c), _state_names(name), strict=True)] + [F.count(_c(c)).alias(f"{name}_n")]


def merge(name: str) -> list[Column]:
    """Aggregates: the same columns over rows that hold unfinished sums."""
    return [F.sum(s).alias(s) for s in (*_state_names(name), f"{name}_n")]


def total(name: str) -> Column:
    """The sum that the columns of a state hold."""
    return _finish([F.col(s) for s in _state_names(name)])


def mean(name: str) -> Column:
    """The average that the columns of a state hold; NULL without values."""
    return F.try_divide(total(name), F.nullif(F.col(f"{name}_n"), F.lit(0)))


def _state_names(name: str) -> list[str]:
    return [*(f"{name}_{i}" for i in range(LIMBS + 1)), f"{name}_rest"]


# --- rounded results ------------------------------------------------------------------------

def mean_rounded(c, places: int) -> Column:
    """Aggregate: round(avg(c), places) of raw doubles."""
    return F.round(exact_mean(c), places)


def mean_rounded_int(c, places: int) -> Column:
    """Aggregate: round(avg(c), places) of whole numbers, whose sum is exact as it is."""
    return F.round(F.try_divide(F.sum(_c(c)).cast("double"), F.count(_c(c))), places)


def ratio_rounded(num, den, places: int, scale_by: int = 1) -> Column:
    """round(num / den * scale_by, places); NULL when den is 0 or NULL."""
    quotient = F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))
    return F.round(quotient * F.lit(float(scale_by)), places)


def difference(a: Column, b: Column, places: int) -> Column:
    """a - b of doubles that are already rounded to `places`, without the noise of binary subtraction."""
    kind = f"decimal(22,{places})"
    return (a.cast(kind) - b.cast(kind)).cast("double")


def hundredths(c) -> Column:
    """An amount as an integer number of hundredths: c * 100, halves away from zero."""
    return F.round(_c(c).cast("double") * 100, 0).cast("bigint")


def exact_text(c) -> Column:
    """A text that two doubles share only if they agree to 2^-60: whole part and signed fraction in units of 2^-60."""
    x = _c(c).cast("double")
    return F.concat(x.try_cast("bigint").cast("string"), F.lit(":"), ((x % 1.0) * _two(60)).try_cast("bigint").cast("string"))


def round1_exact(c) -> Column:
    """round(x, 1) of a value known to 4 decimals, half away from zero."""
    return F.round(_c(c).cast("decimal(22,4)"), 1).cast("double")


def share_pct(part, whole, places: int = 2) -> Column:
    """round(part * 100 / whole, places) for integer counts, exactly, as DOUBLE."""
    p = (_c(part).cast("decimal(20,0)") * 100).cast("decimal(22,0)")
    return F.round(F.try_divide(p, _c(whole).cast("decimal(20,0)")), places).cast("double")
