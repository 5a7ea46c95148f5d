"""NOT NULL and key rules checked in the pass that writes a table.

Violations are counted by metrics on the rows on their way to the files (no second scan); a table whose
rules are broken is not published (``fail``), or published with the counts at hand.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from hearth.functions.text import collated

MODES = ("report", "filter", "fail")


@dataclass(frozen=True)
class Rules:
    """Columns that may not be null, and column groups that may not repeat."""

    not_null: tuple[str, ...] = ()
    keys: tuple[tuple[str, ...], ...] = ()


@dataclass(frozen=True)
class Report:
    """What a load held: its rows, nulls by column, and keys that occur more than once."""

    table: str
    rows: int
    nulls: dict[str, int]
    repeated: dict[tuple[str, ...], int]

    @property
    def broken(self) -> bool:
        return any(self.nulls.values()) or any(self.repeated.values())

    def __str__(self) -> str:
        told = [f"{n} null {c}" for c, n in self.nulls.items() if n]
        told += [f"{n} repeated ({', '.join(k)})" for k, n in self.repeated.items() if n]
        return f"{self.table}: {'; '.join(told) or 'no violations'} in {self.rows} rows"


class RulesBroken(ValueError):
    """A table was not published because its rules do not hold."""

    def __init__(self, report: Report):
        super().__init__(str(report))
        self.report = report


class Gate:
    """Counts violations of ``rules`` while the rows of :meth:`through` are written.

    A key is checked by numbering equal keys behind one exchange by it (a table that was grouped by
    the key has that already); text counts as the source's collation compares it.
    """

    def __init__(self, table: str, rules: Rules, keys: bool = True):
        self._table, self._rules, self._seen = table, rules, Observation()
        self._keys: Sequence[tuple[str, ...]] = rules.keys if keys else ()

    def through(self, df: DataFrame) -> DataFrame:
        text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
        marks = {}
        for i, key in enumerate(self._keys):
            by = [collated(c) if c in text else F.col(c) for c in key]
            marks[f"_copy{i}"] = F.row_number().over(Window.partitionBy(*by).orderBy(*by))
        seen = [F.count(F.lit(1)).alias("rows")]
        seen += [F.count_if(F.col(c).isNull()).alias(f"null{i}") for i, c in enumerate(self._rules.not_null)]
        seen += [F.count_if(F.col(m) == 2).alias(m) for m in marks]
        return df.withColumns(marks).observe(self._seen, *seen).drop(*marks)

    def report(self) -> Report:
        """The counts, once the rows have been written."""
        got = self._seen.get
        return Report(self._table, got["rows"], {c: got[f"null{i}"] for i, c in enumerate(self._rules.not_null)},
                      {k: got[f"_copy{i}"] for i, k in enumerate(self._keys)})

    def check(self) -> None:
        """Raise if a rule is broken."""
        report = self.report()
        if report.broken:
            raise RulesBroken(report)
