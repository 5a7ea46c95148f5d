"""Text cleaning expressions.

The source data is compared under a case-insensitive, trailing-space-insensitive collation.
Spark compares bytes, so every name join goes through :func:`norm` on *both* sides; the
normalised key is computed once per row before the join so the join itself is a plain
equi-join on a string column (hash/broadcast friendly, no expression in the join key).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters stripped from money text before the integer conversion.
MONEY_JUNK_PATTERN = "[,£ ]"
# A string the lenient integer conversion accepts: optional sign, then digits only.
INTEGER_TEXT_PATTERN = r"\A[+-]?[0-9]+\z"  # (a dollar sign would also match before a final line break)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: ColumnOrName) -> Column:
    """Join key for names: ``UPPER(TRIM(x))`` (spaces only, as the source's trims)."""
    return F.upper(F.trim(_col(c)))


def collated(c: ColumnOrName) -> Column:
    """Key under which the source's collation groups and compares text: case and trailing spaces
    do not count."""
    return F.upper(F.rtrim(_col(c)))


def upper_trim(c: ColumnOrName) -> Column:
    """Standardise a name in place (same expression as :func:`norm`)."""
    return norm(c)


def blank_to_null(c: ColumnOrName) -> Column:
    """Trim; an empty result becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_blank(c: ColumnOrName) -> Column:
    """NULL or only spaces; never NULL itself."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def strict_int(text: ColumnOrName, blank_as_zero: bool = False) -> Column:
    """Lenient text -> INT: NULL unless the text is ``[+-]digits`` and fits in an int.

    Decimal text such as ``'1200.50'`` is rejected (NULL), as the source's lenient
    conversion does. ``blank_as_zero`` reproduces the source engine's ``'' -> 0``.
    """
    t = _col(text)
    parsed = F.when(t.rlike(INTEGER_TEXT_PATTERN), t.try_cast("int"))
    if blank_as_zero:
        parsed = F.when(t == F.lit(""), F.lit(0)).otherwise(parsed)
    return parsed


def clean_money_int(c: ColumnOrName, blank_as_zero: bool = False) -> Column:
    """Money text (``'  £31,461 '``) -> INT: trim, drop commas, pound signs and spaces."""
    return strict_int(F.regexp_replace(F.trim(_col(c)), MONEY_JUNK_PATTERN, ""), blank_as_zero)


def clean_count_int(c: ColumnOrName, blank_as_zero: bool = False) -> Column:
    """Count text with thousands separators (``' 1,250 '``) -> INT; inner spaces fail."""
    return strict_int(F.replace(F.trim(_col(c)), F.lit(","), F.lit("")), blank_as_zero)


def period_end_year(label: ColumnOrName) -> Column:
    """Year at the end of a period label (its last four characters), or NULL."""
    return strict_int(F.trim(F.right(_col(label), F.lit(4))))


def month_start(d: ColumnOrName) -> Column:
    """First day of the month of a date or timestamp, as a DATE."""
    return F.trunc(_col(d).cast("date"), "MM")
