"""Quarterly company financials on Spark: cleaning, KPIs, anomalies, forecasts, reports.

Every public function takes DataFrames (or a SparkSession and paths) and returns lazy
DataFrames. Nothing here creates a session, loops over companies or collects a series.
"""
