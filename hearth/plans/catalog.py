"""The model and its 23 views in the catalog, so that other sessions and tools can select from them.

Each version of a written model table is registered as an external table, and every view as SQL text
over the present ones. Base views select from the newest version and apply the NOT NULL rules; the
others are built on these, so a re-publication moves all of them, in every session, at once. With a
persistent metastore they outlive the application.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hearth.operators import model as M
from hearth.operators.levels import MEASURES
from hearth.plans.pipeline import MODEL_TABLES, WrittenModel

DATABASE = "hearth"

# view suffix -> measure, fact table
_FACTS = {"house_prices": ("price", "fact_house_price"), "house_rent": ("rent", "fact_rent"), "earnings": ("earnings", "fact_earnings")}
_WRAPPERS = {"vw_fact_house_prices": "fact_house_price", "vw_fact_earnings": "fact_earnings", "vw_fact_rent": "fact_rent",
             "vw_dim_region": "dim_region", "vw_dim_date": "dim_date", "vw_bridge_lad_region": "bridge_lad_region"}
_MEMBER = {"national": "", "region": "RegionName", "lad": "LADName"}


def _mean(total: str, count: str) -> str:
    """Exact mean, as ``hearth.functions.measures.exact_mean`` has it."""
    return (f"CASE WHEN {count} > 0 THEN CAST(CAST({total} * 100 AS DECIMAL(38,0)) AS DOUBLE) / CAST({count} * 100 AS DOUBLE) END")


def _average(fact: str, measure: str, level: str) -> str:
    m = MEASURES[measure]
    v, t, out = f"CAST({m.value_col} AS DECIMAL(18,2))", m.time_col, m.out_cols[level]
    mean = _mean(f"SUM({v})", f"COUNT({m.value_col})")
    if level == "national":
        return f"SELECT {t}, {mean} AS {out} FROM {fact} GROUP BY {t}"
    if level == "region":
        return f"SELECT {t}, RegionName, {mean} AS {out} FROM {fact} JOIN dim_region USING (RegionKey) GROUP BY {t}, RegionName"
    # a district has its regions' sums, once for each of its bridge rows
    weighted = _mean("SUM(s * CAST(copies AS DECIMAL(20,0)))", "SUM(n * copies)")
    return f"""
        WITH sums AS (SELECT {t}, RegionKey, SUM({v}) AS s, COUNT({m.value_col}) AS n FROM {fact} GROUP BY {t}, RegionKey),
        districts AS (SELECT LAD23NM AS LADName, RegionKey, COUNT(*) AS copies FROM bridge_lad_region GROUP BY LAD23NM, RegionKey)
        SELECT {t}, LADName, {weighted} AS {out} FROM districts JOIN sums USING (RegionKey) GROUP BY {t}, LADName"""


def _ratio(numerator: str, level: str) -> str:
    top, pay, member = MEASURES[numerator], MEASURES["earnings"], _MEMBER[level]
    a, b = top.out_cols[level], pay.out_cols[level]
    year = "year(YearMonth)" if numerator == "price" else "PeriodEndYear"
    factor, out = (" * 12.0D", "Rent_Income_Ratio") if numerator == "rent" else ("", "Price_Income_Ratio")
    names = "house_rent" if numerator == "rent" else "house_prices"
    keys = f"{top.time_col}, {member}, {a}" if member else f"{top.time_col}, {a}"
    using = f"(Year, {member})" if member else "(Year)"
    return f"""
        SELECT {keys}, {b}, {a}{factor} / NULLIF({b}, 0) AS {out}
        FROM (SELECT *, {year} AS Year FROM vw_{level}_avg_{names}) JOIN vw_{level}_avg_earnings USING {using}"""


def view_sql() -> dict[str, str]:
    """SQL text of the 23 views, in an order in which each needs earlier ones only."""
    views = {name: f"SELECT * FROM {table}" for name, table in _WRAPPERS.items()}
    for level in ("national", "region", "lad"):
        for suffix, (measure, fact) in _FACTS.items():
            views[f"vw_{level}_avg_{suffix}"] = _average(fact, measure, level)
    views["vw_lad_price_ratios"] = """
        SELECT YearMonth, LADName, LAD_AvgPrice, Region_AvgPrice, National_AvgPrice,
               LAD_AvgPrice / NULLIF(Region_AvgPrice, 0) AS LAD_vs_Region_Ratio, LAD_AvgPrice / NULLIF(National_AvgPrice, 0) AS LAD_vs_National_Ratio
        FROM vw_lad_avg_house_prices JOIN (SELECT DISTINCT LAD23NM AS LADName, RegionName FROM bridge_lad_region) USING (LADName)
        JOIN vw_region_avg_house_prices USING (YearMonth, RegionName) JOIN vw_national_avg_house_prices USING (YearMonth)"""
    for numerator in ("price", "rent"):
        for level in ("national", "region", "lad"):
            views[f"vw_{level}_{numerator}_income_ratio"] = _ratio(numerator, level)
    views["vw_housing_affordability_index"] = """
        SELECT YearMonth, National_AvgPrice, p.National_AvgAnnualEarnings, Price_Income_Ratio, National_AvgMonthlyRent, Rent_Income_Ratio
        FROM vw_national_price_income_ratio p JOIN vw_national_rent_income_ratio ON PeriodEndYear = year(YearMonth)"""
    return views


def publish(spark: SparkSession, model: WrittenModel, database: str = DATABASE) -> list[str]:
    """Register the model's tables on their present versions, and the base and the 23 published views, under ``database``;
    returns the names of the published views. May be run again after a reload."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in MODEL_TABLES:
        loaded, versions = model.unchecked[name], [v.rsplit("/", 1)[-1] for v in model.table(name).versions()]
        known = [f"{name}__{v.replace('-', '_')}" for v in versions]  # a table for each version: sessions cache files by table
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in loaded.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{known[-1]}` ({columns}) USING parquet "
                  f"LOCATION '{model.table(name).root}/{versions[-1]}'")
        rule = " AND ".join(f"{c} IS NOT NULL" for c in M.NOT_NULL.get(name, ()))
        where = f" WHERE {rule}" if rule else ""
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM `{database}`.`{known[-1]}`{where}")
        for r in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{name}__v_*'").collect():
            if r.tableName not in known:  # its files have been removed
                spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{r.tableName}`")
    views = view_sql()
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)  # names in a view's text are those of this database, for ever
    try:
        for name, text in views.items():
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    finally:
        spark.catalog.setCurrentDatabase(before)
    return list(views)
