"""The registered queries' own steps on tables of several files: no task gets a share of the table that grows with it."""

from pathlib import Path

from compare import difference

from alertflow.plans import catalog
from alertflow.plans.oracle import SQL
from alertflow.streaming import jobs


def folders(monkeypatch, purpose):
    """The folders that the catalog makes for a purpose, as they come."""
    made, new = [], catalog.new_folder

    def recorded(spark, name):
        made.append((name, new(spark, name)))
        return made[-1][1]

    monkeypatch.setattr(catalog, "new_folder", recorded)
    return lambda: [Path(folder) for name, folder in made if name == purpose]


def test_csv_files_are_written_by_the_tasks_that_read_the_table(spark, sf_dir, tmp_path, monkeypatch):
    made = folders(monkeypatch, "csv")
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        found = catalog.csv_split(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list(made()[0].glob("*.csv"))) == 3
    want = catalog.csv_split(spark, sf_dir)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert difference(spark, sf_dir, catalog.csv_split, SQL["csv_split"]) is None


def test_streams_of_large_tables_have_more_files_in_as_many_batches(spark, sf_dir, monkeypatch):
    made = folders(monkeypatch, "documents")
    monkeypatch.setattr(catalog, "ROWS_PER_STREAM_FILE", 20)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert difference(spark, sf_dir, catalog.running_totals, SQL["running_totals"]) is None
    assert all(len(list(folder.glob("*.parquet"))) == 4 * -(-rows // 80) > 4 for folder in made())


def test_replayed_messages_are_scored_once(spark, sf_dir, monkeypatch):
    plans, start = [], jobs.start_new_rows

    def recorded(alerts, *args, **kwargs):
        plans.append(alerts._jdf.queryExecution().analyzed().toString())
        return start(alerts, *args, **kwargs)

    monkeypatch.setattr(jobs, "start_new_rows", recorded)
    assert difference(spark, sf_dir, catalog.replayed_stream, SQL["replayed_stream"]) is None
    assert len(plans) == 2 and not any("from_json" in plan for plan in plans)
