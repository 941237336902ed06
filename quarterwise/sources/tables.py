"""The five stored tables under one root.

A table is a folder of versions, each a Parquet directory, and a small file that names the current
one. A write makes a new version and swaps that file last, so readers see the old table until
the new one is whole, and a failed write changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterwise import schema


#: The file that names a table's current version.
POINTER = "_current"


class TableStore:
    """Named tables below ``root``, a folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        if table not in schema.TABLES:
            raise ValueError(f"Unknown table '{table}'. Available: {list(schema.TABLES)}")
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str) -> int:
        """Replace a table and return its row count, observed during the write itself.

        The version before the replaced one is deleted; the replaced one stays for readers that are
        still at it. Rows are range-partitioned by company, which keeps the Parquet min/max statistics
        narrow: a read of one company skips the other files. A company too large for one
        range is split by date.
        """
        second = "forecast_date" if "forecast_date" in df.columns else "date"
        keys = [c for c in ("company_id", second) if c in df.columns]
        rows = Observation(f"rows_{table}")
        laid_out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
        version = f"version-{uuid.uuid4().hex}"
        laid_out.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path(table)}/{version}")
        replaced = self._current(table)
        self._point(table, version)
        self._delete_versions(table, keep={version, replaced})
        return int(rows.get["n"])

    def _folder(self, table: str):
        """The table's folder and its file system."""
        hadoop = self.spark._jvm.org.apache.hadoop
        path = hadoop.fs.Path(self.path(table))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _current(self, table: str) -> str:
        """Name of the current version; there is no folder of that name if nothing was written yet."""
        path, files = self._folder(table)
        pointer = self.spark._jvm.org.apache.hadoop.fs.Path(path, POINTER)
        if not files.exists(pointer):
            return "none"
        stream = files.open(pointer)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _point(self, table: str, version: str) -> None:
        """Write the pointer beside and rename it over the old one, in one step where the file system can."""
        jvm = self.spark._jvm
        fs = jvm.org.apache.hadoop.fs
        path, files = self._folder(table)
        fresh = fs.Path(path, f"{POINTER}-{version}")
        stream = files.create(fresh, True)
        stream.write(bytearray(version.encode()))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = fs.FileContext.getFileContext(files.makeQualified(path).toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(files.makeQualified(fresh), files.makeQualified(fs.Path(path, POINTER)), options)

    def _delete_versions(self, table: str, keep: set[str]) -> None:
        path, files = self._folder(table)
        for found in files.listStatus(path):
            name = found.getPath().getName()
            if name.startswith("version-") and name not in keep:
                files.delete(found.getPath(), True)

    def read(self, table: str) -> DataFrame:
        """A stored table. Every column it was saved with is kept."""
        return self.spark.read.parquet(f"{self.path(table)}/{self._current(table)}")

    def companies(self) -> DataFrame:
        return companies_by_id(self.read("companies"))

    def financial_records(self, company_id: int | None = None) -> DataFrame:
        return by_company(self.read("financial_records"), company_id)

    def kpi_results(self, company_id: int | None = None) -> DataFrame:
        return by_company(self.read("kpi_results"), company_id)

    def forecast_results(self, company_id: int | None = None) -> DataFrame:
        return by_company(self.read("forecast_results"), company_id, "forecast_date")

    def anomaly_flags(self, company_id: int | None = None) -> DataFrame:
        return by_company(self.read("anomaly_flags"), company_id)

    def register_views(self) -> list[str]:
        """Temp views under the five table names; a table not written yet is empty."""
        for table, layout in schema.TABLES.items():
            try:
                df = self.read(table)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                df = self.spark.createDataFrame([], layout)
            df.createOrReplaceTempView(table)
        return list(schema.TABLES)


def companies_by_id(companies: DataFrame) -> DataFrame:
    return companies.orderBy("company_id")


def by_company(df: DataFrame, company_id: int | None = None, date_column: str = "date") -> DataFrame:
    """All rows in (company, date) order, or one company's in date order. Key 0 is a company."""
    if company_id is None:
        return df.orderBy("company_id", date_column)
    return df.where(F.col("company_id") == company_id).orderBy(date_column)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
