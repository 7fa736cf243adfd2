"""Column expressions; all of them stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def flag_positive(value: Column | str) -> Column:
    """1.0 where the value is above zero, else 0.0 (also for NULL)."""
    return F.when(as_col(value) > 0, 1.0).otherwise(0.0)


def safe_ratio(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """num / den where den is above zero, else ``default``."""
    den = as_col(den)
    return F.when(den > 0, as_col(num) / den).otherwise(F.lit(default))


def near(value: Column | str, digits: int = 2) -> Column:
    """Round half up, after settling on six digits more.

    The last bits of a sum of doubles depend on the order in which partitions are added up;
    settled, they do not decide which way a half goes. (A double has 15 to 16 digits in all:
    in totals beyond some 10^11 the cents themselves are such last bits.)
    """
    return F.round(F.round(value, digits + 6), digits)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    """100 * num / den, rounded; NULL where den is zero. Doubles throughout, no decimals."""
    return near(num.cast("double") * 100.0 / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def mean_of(total: Column, n: Column, digits: int = 2) -> Column:
    """Mean rebuilt from a sum and a count of partial aggregates."""
    return near(total / F.nullif(n.cast("double"), F.lit(0.0)), digits)


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true."""
    return F.sum(F.when(condition, 1).otherwise(0))


def label_map(value: Column | str, labels: Mapping, default=None) -> Column:
    """Replace codes by labels; a code without a label becomes ``default``."""
    value = as_col(value)
    pairs = list(labels.items())
    first = F.when(value == pairs[0][0], pairs[0][1])
    mapped = reduce(lambda chain, pair: chain.when(value == pair[0], pair[1]), pairs[1:], first)
    return mapped.otherwise(F.lit(default))


def bucket(value: Column | str, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the highest threshold that the value reaches, else ``default``."""
    value = as_col(value)
    steps = sorted(thresholds, reverse=True)
    first = F.when(value >= steps[0][0], steps[0][1])
    return reduce(lambda chain, s: chain.when(value >= s[0], s[1]), steps[1:], first).otherwise(default)


def blank_as(value: Column | str, label: str) -> Column:
    """``label`` in place of NULL and empty text."""
    return F.coalesce(F.nullif(as_col(value), F.lit("")), F.lit(label))


def hash_unit(*key: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key alone, not on how rows are partitioned.

    The first 32 bits of the MD5 of "seed|key|key", with NULL as nothing: any engine can repeat it.
    """
    parts = [F.coalesce(as_col(k).cast("string"), F.lit("")) for k in key]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(float(1 << 32))
