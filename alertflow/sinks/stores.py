"""Prediction stores: Parquet files, catalog tables, JSON documents, databases."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.functions.times import in_utc
from alertflow.operators.storage import stamped, type_folder
from alertflow.schemas import DATABASE_TYPES, DOCUMENT_DAY, EVENT_DAY, STORED_DDL, TYPE_FOLDER
from alertflow.sources.store import read_files, sub_folders
from alertflow.streaming.scratch import new_folder, remove_folder

# What an index would serve is served by the file layout: folders by day (or by type), rows
# sorted inside a file (min/max statistics), Bloom filters for places and ids.
BLOOM = {f"parquet.bloom.filter.enabled#{c}": "true" for c in ("location", "tweet_id")}


def with_folder(stored: DataFrame, by_type: bool = False) -> DataFrame:
    """Add the column that names the folder of a row."""
    if not by_type:
        return stored.withColumn(EVENT_DAY.name, F.to_date("kafka_timestamp"))
    return stored.withColumn(TYPE_FOLDER.name, type_folder(F.col("disaster_type")))


def write_files(
    stored: DataFrame,
    path: str,
    mode: str = "append",
    by_type: bool = False,
    compact: bool = False,
) -> None:
    """Add stored rows to a folder of Parquet files, with one sub-folder per day.

    ``by_type`` makes it one per event type, for types that come from a word list; an open set
    of types would make too many folders. Each task sorts and writes its own rows, without a
    shuffle. ``compact`` adds one that gathers each sub-folder into files of even size, large
    ones split over several tasks; it is for input in which every task holds rows of many days.
    """
    folder = (TYPE_FOLDER if by_type else EVENT_DAY).name
    rows = with_folder(stored, by_type)
    if compact:
        rows = rows.hint("rebalance", folder)
    rows = rows.sortWithinPartitions(folder, "disaster_type", "confidence")
    rows.write.mode(mode).partitionBy(folder).options(**BLOOM).parquet(path)


def write_new_files(stored: DataFrame, path: str, **options) -> None:
    """``write_files`` for rows that may have been written before: each row key is in the store once.

    The rows are worked out once, into a table in the shared folder. Their keys are looked up in the store's folders of the
    same days only; one more shuffle, by key, keeps one of each. A write that failed half way is completed by the
    next. One writer at a time: two at once do not see each other's rows.
    """
    spark, folder = stored.sparkSession, new_folder(stored.sparkSession, "new")
    try:
        stored.dropDuplicates(["row_key"]).write.parquet(folder)
        rows = with_folder(spark.read.schema(stored.schema).parquet(folder))
        # As many as folders that this write would make.
        days = [row[0] for row in rows.select(EVENT_DAY.name).distinct().collect()]
        known = stored_days(spark, path, days)
        if known is not None:
            rows = rows.join(known.select("row_key"), "row_key", "left_anti")
        write_files(rows.drop(EVENT_DAY.name), path, **options)
    finally:
        remove_folder(spark, folder)


def stored_days(spark: SparkSession, path: str, days: list[date | None]) -> DataFrame | None:
    """The rows of these days in stored files, from their folders alone; None if there is no store."""
    if not sub_folders(spark, path):
        return None
    day = F.col(EVENT_DAY.name)
    named = [d for d in days if d is not None]
    return read_files(spark, path).filter(day.isin(named) | day.isNull() if None in days else day.isin(named))


def create_table(spark: SparkSession, name: str) -> None:
    """Create the prediction table unless it is there."""
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({STORED_DDL}) USING parquet PARTITIONED BY ({EVENT_DAY.name})"
        )


def write_table(stored: DataFrame, name: str) -> None:
    """Append to the catalog table, creating it first if need be."""
    create_table(stored.sparkSession, name)
    columns = stored.sparkSession.table(name).columns
    rows = with_folder(stored).sortWithinPartitions(EVENT_DAY.name, "disaster_type", "confidence")
    rows.select(*columns).write.insertInto(name)


def write_documents(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Append alerts as JSON documents, stamped with the processing time, in folders by its day."""
    documents = documents_of(alerts).withColumn(DOCUMENT_DAY.name, F.to_date("processing_timestamp"))
    documents.write.mode(mode).partitionBy(DOCUMENT_DAY.name).json(path)


def documents_of(alerts: DataFrame) -> DataFrame:
    """Alerts with a processing time; all times are zone-less, in UTC."""
    return in_utc(stamped(in_utc(alerts, "kafka_timestamp")).drop("created_at"), "processing_timestamp")


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batch_size: int = 10_000,
    connections: int = 32,
    column_types: str | None = DATABASE_TYPES,
    **more: str,
) -> dict[str, str]:
    """Options of a database write: batched inserts, one transaction per task, few connections.

    A table that is not there is created with ``column_types``; ``more`` goes to the connector.
    """
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        "isolationLevel": "READ_COMMITTED",
    }
    optional = {"user": user, "password": password, "driver": driver, "createTableColumnTypes": column_types}
    return options | {k: v for k, v in optional.items() if v is not None} | more


def write_jdbc(stored: DataFrame, row_key: bool = True, **options) -> None:
    """Append to a database table; ``row_key=False`` is for tables without that column."""
    if not row_key:
        stored = stored.drop("row_key")
    stored.write.format("jdbc").mode("append").options(**jdbc_options(**options)).save()


def write_sqlite(stored: DataFrame, **options) -> None:
    """A SQLite file is on one machine only, so a cluster's tasks cannot share it."""
    master = stored.sparkSession.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("a SQLite file cannot be written from several machines; name another store")
    write_jdbc(stored, **options)


def write_mongo(alerts: DataFrame, uri: str, database: str, collection: str) -> None:
    target = {"connection.uri": uri, "database": database, "collection": collection}
    documents_of(alerts).write.format("mongodb").mode("append").options(**target).save()


_WRITERS = {
    "files": write_files,
    "new_files": write_new_files,
    "table": write_table,
    "json": write_documents,
    "mongodb": write_mongo,
    "jdbc": write_jdbc,
    "postgresql": write_jdbc,
    "mysql": write_jdbc,
    "sqlite": write_sqlite,
}


def write_store(df: DataFrame, kind: str, **options) -> None:
    """Write to the store of the given kind; the table-shaped kinds take ``storage_rows``."""
    writer = _WRITERS.get(kind.lower())
    if writer is None:
        raise ValueError(f"unknown store {kind!r}; known: {', '.join(sorted(_WRITERS))}")
    writer(df, **options)
