"""Reading stored predictions back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from alertflow.schemas import DOCUMENT, DOCUMENT_DAY, EVENT_DAY, STORED, TYPE_FOLDER


def read_files(spark: SparkSession, path: str, by_type: bool = False) -> DataFrame:
    """Stored prediction files, in folders by day or by type, and above them by run and batch if a stream wrote them."""
    schema = T.StructType([*STORED.fields, TYPE_FOLDER if by_type else EVENT_DAY])
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """What the runs of ``start_new_rows`` have stored below ``path``, each by its own log of finished batches."""
    schema = T.StructType([*STORED.fields, EVENT_DAY])
    rows = spark.createDataFrame([], schema)
    for folder in sub_folders(spark, path, "run="):
        rows = rows.unionByName(spark.read.schema(schema).parquet(folder))
    return rows


def sub_folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """The folders right below ``path`` whose names begin so; none if there is no such path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found = [status.getPath() for status in system.listStatus(root) if status.isDirectory()]
    return sorted(p.toString() for p in found if p.getName().startswith(prefix))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents in folders by the day of processing, which comes as a last column."""
    return spark.read.schema(T.StructType([*DOCUMENT.fields, DOCUMENT_DAY])).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 32,
    **options: str,
) -> DataFrame:
    """A database table. Filters and columns are pushed down.

    With ``split_column`` and its ``bounds`` the table is read by ``splits`` tasks; without
    them one task reads it, which suits pushed-down reads of a few rows only.
    """
    settings = {"url": url, "dbtable": table, "preferTimestampNTZ": "true", **options}
    if split_column is not None:
        if bounds is None:
            raise ValueError("split_column needs bounds")
        settings.update(
            partitionColumn=split_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(splits),
        )
    return spark.read.format("jdbc").options(**settings).load()


def read_mongo(spark: SparkSession, uri: str, database: str, collection: str) -> DataFrame:
    """A document collection, through the Mongo connector that the cluster supplies."""
    reader = spark.read.format("mongodb").schema(DOCUMENT)
    return reader.options(**{"connection.uri": uri, "database": database, "collection": collection}).load()


_READERS = {
    "files": read_files,
    "table": read_table,
    "json": read_documents,
    "mongodb": read_mongo,
    "jdbc": read_jdbc,
    "postgresql": read_jdbc,
    "mysql": read_jdbc,
    "sqlite": read_jdbc,
}


def read_store(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Read the store of the given kind, the counterpart of ``write_store``."""
    reader = _READERS.get(kind.lower())
    if reader is None:
        raise ValueError(f"unknown store {kind!r}; known: {', '.join(sorted(_READERS))}")
    return reader(spark, **options)
