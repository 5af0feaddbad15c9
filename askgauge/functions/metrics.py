"""Evaluation metrics as column expressions.

Literals are Python floats on purpose: a decimal literal would make Spark divide in DECIMAL and lose
digits. Denominators go through ``nullif`` because Spark raises on division by zero.
"""

from pyspark.sql import Column, functions as F

Z_95 = 1.96


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double precision, NULL when the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled value.

    ``F.round(x, 4)`` works on the decimal expansion and disagrees with scale-round-unscale on about
    1 % of ratios; published tables use the latter.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def _wilson(successes: Column, total: Column, z: float, sign: int) -> Column:
    n = F.nullif(total.cast("double"), F.lit(0.0))
    share = successes.cast("double") / n
    spread = F.lit(z) * F.sqrt(share * (F.lit(1.0) - share) / n + F.lit(z * z) / (F.lit(4.0) * n * n))
    middle = share + F.lit(z * z) / (F.lit(2.0) * n)
    return (middle + F.lit(float(sign)) * spread) / (F.lit(1.0) + F.lit(z * z) / n)


def wilson_low(successes: Column, total: Column, z: float = Z_95) -> Column:
    """Lower bound of the Wilson score interval; NULL for an empty sample."""
    return _wilson(successes, total, z, -1)


def wilson_high(successes: Column, total: Column, z: float = Z_95) -> Column:
    """Upper bound of the Wilson score interval; NULL for an empty sample."""
    return _wilson(successes, total, z, +1)


def chance_corrected(accuracy: Column, baseline: Column) -> Column:
    """0 at the guessing level, 1 for a perfect score, negative below guessing."""
    return (accuracy - baseline) / F.nullif(F.lit(1.0) - baseline, F.lit(0.0))


def share_of(flag: Column) -> Column:
    """Mean of a boolean over its non-null rows."""
    return F.avg(flag.cast("int"))
