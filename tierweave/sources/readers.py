"""Document and table scans. The schema is always declared, never inferred."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_documents(
    spark: SparkSession,
    ddl: str | StructType,
    path: str | None = None,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Load a document collection with a declared schema.

    ``fmt`` is any data source that yields a DataFrame: line JSON by default, parquet, or a
    document-database connector whose jar is on the cluster (then ``path`` stays None and
    ``options`` name the collection). Undeclared fields are dropped by the scan itself.
    """
    schema = StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table (``schema.table`` or ``catalog.schema.table``)."""
    return spark.read.table(name)


def read_parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_dependencies(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame]:
    """Dependency tables keyed by bare table name; read in full, never windowed."""
    return {name.rsplit(".", 1)[-1]: read_table(spark, name) for name in names}


def spread(df: DataFrame) -> DataFrame:
    """Share a scan with fewer splits than the cluster has cores among all of them.

    A small single-file table would otherwise be computed on by one task up to the first shuffle. Inputs
    with enough splits are returned as they are, so large scans never pay for a shuffle here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
