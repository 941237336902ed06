"""Rule-based anomaly flags: z-score, IQR fence, leverage; merging and summaries.

Statistics are taken on the wide frame, one exchange by company for all metrics, and only
flagged cells are turned into rows. Unpivoting first would multiply the shuffled rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.functions.scalars import over_nonzero
from quarterwise.operators.isolation import isolation_forest_anomalies

Z_METRICS = ("revenue", "expenses", "profit", "operating_cost")
IQR_METRICS = ("revenue", "expenses", "profit")
Z_FLAG, Z_SEVERE = 2.0, 3.0
Z_MIN_ROWS = 4
FENCE = 1.5
DEBT_FLAG, DEBT_SEVERE = 0.70, 0.80

# Fixed order: which method's row survives among flags of equal severity.
METHODS = ("Z-Score", "IQR", "IsolationForest", "DebtRatioThreshold")


def _flag(metric: str, value: str, z: str, level: str, method: str) -> str:
    return (
        f"struct('{metric}' AS metric, {value} AS value, round({z}, 3) AS z_score, "
        f"{level} AS severity, '{method}' AS method)"
    )


def _level(score: str, severe_above: float) -> str:
    return f"if({score} > {severe_above}D, 'SEVERE', 'WARNING')"


def _with_moments(records: DataFrame, metrics: Sequence[str], quartiles: Sequence[str] = ()) -> DataFrame:
    """Row count, mean and std (and quartiles) of the company's metrics on every row."""
    company = "OVER (PARTITION BY company_id)"
    stats = [f"count(1) {company} AS rows_n"]
    for m in metrics:
        stats += [f"avg({m}) {company} AS {m}_mean", f"stddev_pop({m}) {company} AS {m}_std"]
    stats += [f"percentile({m}, array(0.25D, 0.75D)) {company} AS {m}_q" for m in quartiles]
    return records.selectExpr("*", *stats)


def _z_flag(m: str) -> str:
    z = f"(({m} - {m}_mean) / nullif({m}_std, 0D))"
    flag = _flag(m, f"round({m}, 2)", z, _level(f"abs({z})", Z_SEVERE), "Z-Score")
    return f"CASE WHEN rows_n >= {Z_MIN_ROWS} AND abs({z}) > {Z_FLAG}D THEN {flag} END"


def _iqr_flag(m: str) -> str:
    reach = f"{FENCE}D * ({m}_q[1] - {m}_q[0])"
    z = f"({m} - {m}_mean) / coalesce(nullif({m}_std, 0D), 1D)"
    flag = _flag(m, f"round({m}, 2)", z, "'WARNING'", "IQR")
    return f"CASE WHEN {m} < {m}_q[0] - {reach} OR {m} > {m}_q[1] + {reach} THEN {flag} END"


def debt_statistics(records: DataFrame) -> DataFrame:
    """Mean and sample std of the debt ratio over all companies: always one row."""
    debt = over_nonzero("liabilities", "assets")
    return records.agg(F.avg(debt).alias("mean"), F.stddev_samp(debt).alias("std"))


def _with_debt(staged: DataFrame, records: DataFrame) -> DataFrame:
    """The row's debt ratio and the one-row statistics of all companies."""
    panel = debt_statistics(records).select(F.struct("mean", "std").alias("s")).scalar()
    return staged.withColumns({"debt": over_nonzero("liabilities", "assets"), "panel": panel})


def _debt_flag(threshold: float) -> str:
    z = "(debt - panel.mean) / coalesce(nullif(panel.std, 0D), 1D)"
    flag = _flag("debt_to_assets", "round(debt, 4)", z, _level("debt", DEBT_SEVERE), "DebtRatioThreshold")
    return f"CASE WHEN debt > {threshold}D THEN {flag} END"


def _flag_rows(staged: DataFrame, flags: Sequence[str]) -> DataFrame:
    return staged.selectExpr("company_id", "date", f"inline(array_compact(array({', '.join(flags)})))")


def zscore_anomalies(records: DataFrame, metrics: Sequence[str] = Z_METRICS) -> DataFrame:
    """Cells more than two population standard deviations off their company's mean."""
    metrics = [m for m in metrics if m in records.columns]
    return _flag_rows(_with_moments(records, metrics), [_z_flag(m) for m in metrics])


def iqr_anomalies(records: DataFrame, metrics: Sequence[str] = IQR_METRICS) -> DataFrame:
    """Cells outside the quartile fences of their company."""
    metrics = [m for m in metrics if m in records.columns]
    return _flag_rows(_with_moments(records, metrics, metrics), [_iqr_flag(m) for m in metrics])


def debt_risk_flags(records: DataFrame, threshold: float = DEBT_FLAG) -> DataFrame:
    """Quarters with more debt than ``threshold`` of assets; z against all companies."""
    return _flag_rows(_with_debt(records, records), [_debt_flag(threshold)])


def rule_flags(records: DataFrame) -> DataFrame:
    """All rule-based flags from one pass and one exchange by company."""
    staged = _with_debt(_with_moments(records, Z_METRICS, IQR_METRICS), records)
    flags = [*map(_z_flag, Z_METRICS), *map(_iqr_flag, IQR_METRICS), _debt_flag(DEBT_FLAG)]
    return _flag_rows(staged, flags)


def keep_most_severe(flags: DataFrame) -> DataFrame:
    """One flag per (company, date, metric): SEVERE first, then by method order."""
    rank = F.struct(
        F.when(F.col("severity") == "SEVERE", 0).otherwise(1).alias("level"),
        F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.col("method")).alias("method"),
        F.col("value"),
        F.col("z_score"),
        F.col("severity"),
    )
    kept = flags.groupBy("company_id", "date", "metric").agg(F.min(rank).alias("top"))
    return kept.select("company_id", "date", "metric", "top.value", "top.z_score", "top.severity")


def run_anomaly_detection(records: DataFrame, isolation: bool = True) -> DataFrame:
    """Flags of all detectors, one per cell, in the stored layout."""
    flags = rule_flags(records)
    if isolation:
        flags = flags.unionByName(isolation_forest_anomalies(records))
    return keep_most_severe(flags)


def anomaly_summary(flags: DataFrame, companies: DataFrame) -> DataFrame:
    """Flag counts and affected metrics (in alphabetical order) per company."""
    per_company = flags.groupBy("company_id").agg(
        F.count("metric").alias("total_flags"),
        F.count_if(F.col("severity") == "SEVERE").alias("severe_flags"),
        F.array_join(F.array_sort(F.collect_set("metric")), ", ").alias("metrics_affected"),
    )
    return per_company.join(companies.select("company_id", "company_name"), "company_id")


def severity_totals(flags: DataFrame) -> DataFrame:
    return flags.agg(
        F.count(F.lit(1)).alias("total_flags"),
        F.count_if(F.col("severity") == "SEVERE").alias("severe_flags"),
        F.count_if(F.col("severity") == "WARNING").alias("warning_flags"),
    )


def severe_flags(flags: DataFrame) -> DataFrame:
    return flags.where(F.col("severity") == "SEVERE").select("company_id", "date", "metric", "value", "z_score")
