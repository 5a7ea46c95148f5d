"""A housing workspace over one input folder: raw inputs, cleaned inputs and the materialised
model. Each import and each model table is written when a query first needs it, once, and shared by
every query of the Spark application."""

from __future__ import annotations

import atexit
import contextlib
import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from hearth.operators import model as M
from hearth.plans.pipeline import CleanedInputs, Lazily, Model, WrittenModel, build_model, clean_inputs
from hearth.session import app_id, file_state, new_run_dir, remove_folder
from hearth.sources import tpch
from hearth.sources.files import write_table
from hearth.sources.tpch import RawInputs


class ImportedRaw:
    """The five raw inputs mapped from the test tables, each imported (written to the shared folder)
    when first asked for. Line items are summarised once for rents and earnings."""

    def __init__(self, spark: SparkSession, sf_dir: str, dirty: bool, path: str):
        plans = {
            "regions": lambda: tpch.regions(spark, sf_dir),
            "lad": lambda: tpch.lad_lookup(spark, sf_dir, dirty),
            "prices": lambda: tpch.prices(spark, sf_dir, dirty),
            "means": lambda: tpch.nation_year_means(spark, sf_dir),
            "rents": lambda: tpch.rents(self._written["means"], dirty),
            "earnings": lambda: tpch.earnings(self._written["means"], dirty),
        }
        self._written = Lazily({n: (lambda n, p: lambda: write_table(spark, p(), f"{path}/{n}"))(n, p) for n, p in plans.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("regions", "lad", "prices", "rents", "earnings"):
            return self._written[name]
        raise AttributeError(name)


@dataclass
class Housing:
    """Workspace over one set of raw inputs.

    Either ``sf_dir`` (the TPC-H-shaped test tables, mapped by ``hearth.sources.tpch``) or, via
    :meth:`from_raw`, the five raw inputs read from the publishers' files.
    """

    spark: SparkSession
    sf_dir: str | None = None
    country: str = tpch.COUNTRY
    remap: Mapping[str, str] = field(default_factory=lambda: dict(tpch.REMAP))
    trend_years: Sequence[int] = tpch.TREND_YEARS
    dirty: bool = True
    materialize: bool = True
    # what becomes of rows that break a NOT NULL rule: report, filter or fail (see WrittenModel)
    rules: str = "filter"
    _given_raw: RawInputs | None = field(default=None, repr=False, compare=False)

    @classmethod
    def from_raw(cls, spark: SparkSession, raw: RawInputs, country: str = "ENGLAND",
                 remap: Mapping[str, str] | None = None, trend_years: Sequence[int] = (2023, 2024),
                 materialize: bool = True, rules: str = "filter") -> Housing:
        """Workspace over raw inputs read elsewhere (e.g. ``hearth.sources.read_raw``).

        ``remap`` maps normalised rent region labels to canonical region names.
        """
        return cls(spark, None, country, dict(remap or {}), trend_years, materialize=materialize, rules=rules, _given_raw=raw)

    def __post_init__(self):
        # everything this workspace writes; fixed before any thread uses it
        self.run_dir = new_run_dir(self.spark, "housing") if self.materialize else None
        self._parts = Lazily({"raw": self._raw, "cleaned": lambda: clean_inputs(self.raw, self.remap), "model": self._model})

    def _raw(self) -> RawInputs | ImportedRaw:
        if self._given_raw is not None:
            return self._given_raw
        if self.materialize:
            return ImportedRaw(self.spark, self.sf_dir, self.dirty, f"{self.run_dir}/import")
        return tpch.raw_inputs(self.spark, self.sf_dir, self.dirty)

    def _model(self) -> Model | WrittenModel:
        if self.materialize:
            return WrittenModel(self.spark, self.cleaned, self.country, path=f"{self.run_dir}/model", rules=self.rules)
        return build_model(self.spark, self.cleaned, self.country, rules=self.rules)

    @property
    def raw(self) -> RawInputs | ImportedRaw:
        return self._parts["raw"]

    @property
    def cleaned(self) -> CleanedInputs:
        return self._parts["cleaned"]

    @property
    def model(self) -> Model | WrittenModel:
        return self._parts["model"]

    @property
    def fact_rent_before_fix(self) -> DataFrame:
        """Rent fact as first loaded, before the label fix (what the gap checks inspect)."""
        return M.fact_rent(self.cleaned.rents_unfixed, self.model.dim_region, self.model.row_bound("dim_region"))

    def close(self) -> None:
        """Remove the folder of this workspace; its tables cannot be read afterwards."""
        if self.run_dir:
            remove_folder(self.spark, self.run_dir)

    def __enter__(self) -> Housing:
        return self

    def __exit__(self, *_) -> None:
        self.close()


_CACHE: dict[tuple, Housing] = {}
_LOCK = threading.Lock()
_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def _close_all() -> None:
    for h in _CACHE.values():
        with contextlib.suppress(Exception):  # the session may have ended before
            h.close()
    _CACHE.clear()


def housing(spark: SparkSession, sf_dir: str) -> Housing:
    """The workspace for ``sf_dir`` in this Spark application, made on first use and again when an
    input file has changed. Its folder is removed when the application ends (an earlier one stays
    until then: results made from it may still be read)."""
    sf_dir = sf_dir.rstrip("/")
    key = (app_id(spark), sf_dir, tuple(file_state(spark, f"{sf_dir}/{t}.parquet") for t in _TABLES))
    with _LOCK:
        h = _CACHE.get(key)
        if h is None:
            if not _CACHE:
                atexit.register(_close_all)
            h = _CACHE[key] = Housing(spark, sf_dir)
        return h
