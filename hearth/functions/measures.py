"""Deterministic averages and guarded ratios.

Floating-point sums depend on the order in which partitions are combined, so a plain
``avg(double)`` can differ in the last bit between runs, engines and cluster sizes. Every mean
here is computed from an *exact* decimal sum and a count:

    mean = double(sum_in_cents) / double(count * 100)

The decimal total is exact whatever the grouping, so:

* a mean can be assembled from partial (sum, count) pairs in any grouping — map-side
  pre-aggregation and pre-aggregation before a join give bit-identical results;
* while the cent total stays below 2**53 (about 90 trillion in money units per group) both
  operands are exact doubles and the IEEE division is correctly rounded from the exact rational
  ``sum / count``; hence a join that repeats every row of a group ``k`` times leaves the mean
  unchanged, and such a fan-out can be rewritten away without changing a single bit. Beyond that
  the total is rounded to the nearest double first — still deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

MONEY = "decimal(18,2)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_mean(total: ColumnOrName, count: ColumnOrName) -> Column:
    """Mean from an exact scale-2 decimal ``total`` and a row ``count`` (NULL if count is 0)."""
    total, count = _col(total), _col(count)
    cents = (total * F.lit(100)).cast("decimal(38,0)").cast("double")
    return F.when(count > 0, cents / (count * F.lit(100)).cast("double"))


def exact_avg(c: ColumnOrName) -> Column:
    """Aggregate: exact mean of a money column (NULLs ignored, as ``AVG``)."""
    x = _col(c).cast(MONEY)
    return exact_mean(F.sum(x), F.count(x))


def round_half_up_cents(total: ColumnOrName, count: ColumnOrName) -> Column:
    """Mean rounded to cents as ``DECIMAL(18,2)``, in integer arithmetic (half away from 0).

    Rounding the double mean instead would disagree between engines on half-cent ties. All
    intermediate values are ``DECIMAL(38,0)`` integers: a cent total can exceed the 64-bit range
    when one group holds a large share of the data, and ``/`` on integers would be a double
    division (exact only below 2**53).
    """
    total, count = _col(total), _col(count)
    whole_num = "decimal(38,0)"
    sc = (total * F.lit(100)).cast(whole_num)                    # cent total, exact
    n = count.cast(whole_num)
    mag = (F.abs(sc) * 2 + n).cast(whole_num)
    den = (n * 2).cast(whole_num)
    # floor(mag / den) without a float quotient: subtract the remainder, divide exact multiples
    q = ((mag - mag % den).cast(whole_num) / den).cast(whole_num)
    cents = F.when(sc < 0, -q).otherwise(q)
    return F.when(count > 0, (cents / F.lit(100)).cast(MONEY))


def scaled_mean(total: ColumnOrName, count: ColumnOrName, digits: int = 6) -> Column:
    """Mean of an exact scale-2 decimal ``total``, rounded to ``digits`` places (half away from 0),
    as the integer ``mean * 10**digits``."""
    total, count = _col(total), _col(count)
    whole_num = "decimal(38,0)"
    scaled = (total * F.lit(100)).cast(whole_num) * F.lit(10 ** (digits - 2)).cast("decimal(18,0)")
    n = count.cast(whole_num)
    mag = (F.abs(scaled.cast(whole_num)) * 2 + n).cast(whole_num)
    den = (n * 2).cast(whole_num)
    q = ((mag - mag % den).cast(whole_num) / den).cast(whole_num)
    return F.when(count > 0, F.when(scaled < 0, -q).otherwise(q))


#: Parts of the state of a correlation: counts and sums that are added to merge two states.
MOMENTS = ("n", "sx", "sy", "sxy", "sxx", "syy")


def moments(x: ColumnOrName, y: ColumnOrName) -> list[Column]:
    """Aggregates: exact moments of the pairs (x, y) of integers (up to 18 digits) that both are not
    null. Sums of states are the state of all their pairs, in any order and grouping."""
    x, y = _col(x).cast("decimal(18,0)"), _col(y).cast("decimal(18,0)")
    both = x.isNotNull() & y.isNotNull()
    terms = {"sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y}
    return [F.count_if(both).alias("n"), *[F.sum(F.when(both, t)).cast("decimal(38,0)").alias(k) for k, t in terms.items()]]


def merge_moments() -> list[Column]:
    """Aggregates: the state of all rows' states."""
    return [F.sum(c).cast("bigint" if c == "n" else "decimal(38,0)").alias(c) for c in MOMENTS]


def pearson() -> Column:
    """Sample Pearson correlation from a state; NULL for less than two pairs or a flat series. All
    differences are exact integers; each is rounded to a double once."""
    n = F.col("n").cast("decimal(20,0)")
    less = lambda s, a, b: (n * F.col(s)).cast("decimal(38,0)") - (F.col(a) * F.col(b)).cast("decimal(38,0)")
    vx, vy = less("sxx", "sx", "sx").cast("double"), less("syy", "sy", "sy").cast("double")
    r = less("sxy", "sx", "sy").cast("double") / (F.sqrt(vx) * F.sqrt(vy))
    return F.when((F.col("n") > 1) & (vx > 0) & (vy > 0), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))


def guarded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` when ``den > 0``, else NULL (the insight queries' guard)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den)


def nullif_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` — division that yields NULL instead of failing on zero."""
    num, den = _col(num), _col(den)
    return num / F.nullif(den, F.lit(0))
