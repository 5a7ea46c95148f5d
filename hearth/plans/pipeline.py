"""End-to-end pipeline: raw inputs -> cleaned inputs -> star schema -> materialised tables.

Every model table that is asked for is written once as Parquet under the shared folder
(``spark.checkpoint.dir``) and read back, so the insight queries and views share the facts
instead of re-scanning the raw inputs, lineage is cut at the model boundary, and a lost
executor recomputes at most one table-writing stage.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from hearth.operators import cleaning as C
from hearth.operators import model as M
from hearth.operators.gate import MODES, Gate, Report
from hearth.session import new_run_dir
from hearth.sources.versions import VersionedTable
from hearth.sources.tpch import RawInputs


RENT_REQUIRED = ("Median_int", "Region", "PeriodLabel")


class CleanedInputs:
    """The cleaning steps of the raw inputs. Each is planned when first asked for, so a query that
    needs one input does not import the others."""

    def __init__(self, raw: RawInputs, remap: Mapping[str, str]):
        self._raw, self._remap = raw, remap

    @property
    def regions(self) -> DataFrame:
        return self._raw.regions

    @property
    def lad(self) -> DataFrame:
        return self._raw.lad

    @property
    def prices_raw(self) -> DataFrame:
        """Prices as imported."""
        return self._raw.prices

    @property
    def prices(self) -> DataFrame:
        """District names standardised."""
        return C.upper_trim(self._raw.prices, "RegionName")

    @property
    def earnings_int(self) -> DataFrame:
        """Earnings with Median_Annual_Earnings_int."""
        return C.add_clean_money_int(self._raw.earnings, "Median_Annual_Earnings")

    @property
    def earnings(self) -> DataFrame:
        """Cleaned column swapped in."""
        return C.swap_clean_column(self.earnings_int, "Median_Annual_Earnings", "Median_Annual_Earnings_int")

    @property
    def rents_trimmed_cols(self) -> DataFrame:
        """Throwaway columns dropped."""
        return C.drop_columns(self._raw.rents, ["throwaway1", "throwaway2"])

    @property
    def rents_int(self) -> DataFrame:
        """Rents with Median_int."""
        return C.add_clean_count_int(self.rents_trimmed_cols, "Median")

    @property
    def rents_blank_null(self) -> DataFrame:
        """Region and PeriodLabel trimmed, blanks NULL."""
        return C.blank_to_null(self.rents_int, ["Region", "PeriodLabel"])

    @property
    def rents_deleted(self) -> DataFrame:
        """All-blank rows deleted - before NOT NULL is enforced (the source does it the other way
        round, which cannot succeed)."""
        return C.drop_blank_rows(self.rents_blank_null, ["Region", "PeriodLabel"], ["Median_int"])

    @property
    def rents_unfixed(self) -> DataFrame:
        """Median_int swapped in, before the label fix."""
        return C.swap_clean_column(self.rents_deleted, "Median", "Median_int")

    @property
    def rents(self) -> DataFrame:
        """Label fix applied."""
        return C.remap_value(self.rents_unfixed, "Region", self._remap)


def clean_inputs(raw: RawInputs, remap: Mapping[str, str]) -> CleanedInputs:
    return CleanedInputs(raw, remap)


@dataclass(frozen=True)
class Model:
    dim_region: DataFrame
    dim_date: DataFrame
    bridge: DataFrame
    fact_earnings: DataFrame
    fact_rent: DataFrame
    fact_house_price: DataFrame
    # the same tables before their NOT NULL rules (what the constraint checks inspect)
    unchecked: Mapping[str, DataFrame] = field(default_factory=dict)
    # ``rows(table)``: row count of a written table (an upper bound of the enforced one), counted on
    # first use from the Parquet footers; None when the model is lazy. Decides broadcast hints.
    rows: Callable[[str], int] | None = None

    def row_bound(self, table: str) -> int | None:
        return self.rows(table) if self.rows is not None else None


#: The model's tables, in an order in which each needs earlier ones only.
MODEL_TABLES = ("dim_region", "dim_date", "bridge_lad_region", "fact_earnings", "fact_rent", "fact_house_price")


def build_model(
    spark: SparkSession,
    cleaned: CleanedInputs,
    country: str = "ENGLAND",
    date_start: str = M.DATE_START,
    date_end: str = M.DATE_END,
    rules: str = "filter",
) -> Model:
    """Lazy star schema over the cleaned inputs. ``rules`` says what becomes of rows that break a
    NOT NULL rule: they are kept (``report``), left out (``filter``) or stop the job (``fail``)."""
    dim = M.dim_region(cleaned.regions, country)
    bridge_u = M.bridge_lad_region_unchecked(cleaned.lad, dim)
    bridge = M.enforce(bridge_u, "bridge_lad_region", rules)
    unchecked = {
        "bridge_lad_region": bridge_u,
        "fact_earnings": M.fact_earnings_unchecked(cleaned.earnings, dim),
        "fact_rent": M.fact_rent_unchecked(cleaned.rents, dim),
        "fact_house_price": M.fact_house_price_unchecked(cleaned.prices, bridge, dim),
    }
    return Model(
        dim_region=dim,
        dim_date=M.dim_date(spark, date_start, date_end),
        bridge=bridge,
        fact_earnings=M.enforce(unchecked["fact_earnings"], "fact_earnings", rules),
        fact_rent=M.enforce(unchecked["fact_rent"], "fact_rent", rules),
        fact_house_price=M.enforce(unchecked["fact_house_price"], "fact_house_price", rules),
        unchecked=unchecked,
    )


class Lazily:
    """Named values, each made once on first use; concurrent callers wait for a single making."""

    def __init__(self, makers: Mapping[str, Callable[[], object]]):
        self._makers, self._made = dict(makers), {}
        self._locks = {name: threading.RLock() for name in makers}

    def __getitem__(self, name: str):
        with self._locks[name]:
            if name not in self._made:
                self._made[name] = self._makers[name]()
            return self._made[name]


class WrittenModel:
    """The star schema, each table written when first asked for, with the tables it needs; later
    tables read the written earlier ones (facts join the written ``dim_region`` and ``bridge``), so
    no table is recomputed and each write is a lineage cut.

    Each table is written once, *before* its NOT NULL rules; the model's table is the written copy
    read through those rules (a filter that reaches the Parquet scan), so the constraint checks
    inspect the written table instead of recomputing it from the raw inputs. The rent fact is loaded
    first as imported, then emptied and loaded again after the label fix; every load replaces the
    table in one step.

    ``rules``: violations of NOT NULL rules are counted while a table is written (``reports``). With
    ``filter`` (the default) the model leaves those rows out, with ``report`` it keeps them, and with
    ``fail`` a table that breaks one is not published: the build stops and an earlier version stays.
    With the latter two, declared keys are checked in the same pass.
    """

    def __init__(self, spark: SparkSession, cleaned: CleanedInputs, country: str = "ENGLAND",
                 date_start: str = M.DATE_START, date_end: str = M.DATE_END, path: str | None = None, rules: str = "filter"):
        if rules not in MODES:
            raise ValueError(f"rules must be one of {MODES}, got {rules!r}")
        self._spark, self._root, self._rules = spark, path or new_run_dir(spark, "model"), rules
        #: What each load held, by table (of the rent fact: after the label fix).
        self.reports: dict[str, Report] = {}

        def rent() -> DataFrame:
            # loaded as imported, whatever its gaps; the rules apply once the labels are fixed
            regions = self.dim_region, self.rows("dim_region")
            self.table("fact_rent").load(M.fact_rent_unchecked(cleaned.rents_unfixed, *regions))
            return self._write("fact_rent", M.fact_rent_unchecked(cleaned.rents, *regions), C.reload_after_fix)

        plans = {
            "dim_region": lambda: M.dim_region(cleaned.regions, country),
            "dim_date": lambda: M.dim_date(spark, date_start, date_end),
            "bridge_lad_region": lambda: M.bridge_lad_region_unchecked(cleaned.lad, self.dim_region, self.rows("dim_region")),
            "fact_earnings": lambda: M.fact_earnings_unchecked(cleaned.earnings, self.dim_region, self.rows("dim_region")),
            "fact_house_price": lambda: M.fact_house_price_unchecked(
                cleaned.prices, self.bridge, self.dim_region, self.rows("bridge_lad_region"), self.rows("dim_region")),
        }
        self.unchecked = Lazily({name: (lambda n, p: lambda: self._write(n, p()))(name, plan) for name, plan in plans.items()}
                                | {"fact_rent": rent})

    def table(self, name: str) -> VersionedTable:
        """The written table of this name, with its versions."""
        return VersionedTable(self._spark, f"{self._root}/{name}")

    def _write(self, name: str, df: DataFrame, load: Callable = VersionedTable.load) -> DataFrame:
        gate = Gate(name, M.rules(name), keys=self._rules != "filter")

        def check() -> None:
            self.reports[name] = gate.report()
            if self._rules == "fail":
                gate.check()

        return load(self.table(name), gate.through(df), check)

    def rows(self, table: str) -> int:
        """Row count of a written table, counted while it was written."""
        self.unchecked[table]
        return self.reports[table].rows

    row_bound = rows

    def _enforced(self, name: str) -> DataFrame:
        # behind a gate that let nothing through there is nothing to filter
        return M.enforce(self.unchecked[name], name, "filter" if self._rules == "filter" else "report")

    @property
    def dim_region(self) -> DataFrame:
        return self.unchecked["dim_region"]

    @property
    def dim_date(self) -> DataFrame:
        return self.unchecked["dim_date"]

    @property
    def bridge(self) -> DataFrame:
        return self._enforced("bridge_lad_region")

    @property
    def fact_earnings(self) -> DataFrame:
        return self._enforced("fact_earnings")

    @property
    def fact_rent(self) -> DataFrame:
        return self._enforced("fact_rent")

    @property
    def fact_house_price(self) -> DataFrame:
        return self._enforced("fact_house_price")
