"""CSV files read in ranges, against Spark's own reading of whole files."""

import csv

import pytest
from pyspark.sql import functions as F

from alertflow.plans.catalog import split_at
from alertflow.sources import csv_feed, csv_ranges

VALUES = ["plain", "", 'a "quoted" word', "two\nlines", '"', '""\n"', "a,b\n\n\nc", " spaces ", "\n", "é😀\n,", "x" * 300, "y\n" * 200, "end"]


def write(path, rows, end="\n", header=("id", "text", "more")):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def counted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["7b", "1k"])
def test_ranges_equal_the_whole_file(spark, tmp_path, end, size):
    rows = [(str(i), VALUES[i % len(VALUES)], VALUES[(i * 5) % len(VALUES)]) for i in range(60)]
    write(tmp_path / "a.csv", rows[:45], end)
    write(tmp_path / "b.csv", rows[45:], end)
    write(tmp_path / "c.csv", [], end)
    with split_at(spark, size), split_at_open_cost(spark):
        found = csv_ranges.read_csv_ranges(spark, str(tmp_path))
        assert found.schema == csv_feed.read_csv(spark, str(tmp_path)).schema
        assert counted(found) == counted(csv_feed.read_csv(spark, str(tmp_path))) == sorted(rows, key=str)
        states = csv_ranges.range_states(csv_ranges._lines(spark, str(tmp_path)))
        assert states.count() > 5 and states.filter("inside").count() > 2


class split_at_open_cost:
    """Without the cost of opening a file, small ranges are not packed into one task."""

    def __init__(self, spark):
        self.spark, self.name = spark, "spark.sql.files.openCostInBytes"

    def __enter__(self):
        self.before = self.spark.conf.get(self.name)
        self.spark.conf.set(self.name, "0b")

    def __exit__(self, *_):
        self.spark.conf.set(self.name, self.before)


def test_many_ranges_are_shuffled_to_their_states(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_ranges, "RANGES_SENT", 0)
    rows = [(str(i), VALUES[i % len(VALUES)], "z") for i in range(60)]
    write(tmp_path / "a.csv", rows)
    with split_at(spark, "50b"):
        assert counted(csv_ranges.read_csv_ranges(spark, str(tmp_path))) == sorted(rows, key=str)


def test_another_header_raises(spark, tmp_path):
    write(tmp_path / "a.csv", [("1", "x", "y")])
    write(tmp_path / "b.csv", [("1", "x", "y")], header=("id", "other", "more"))
    with pytest.raises(Exception, match="another header"):
        csv_ranges.read_csv_ranges(spark, str(tmp_path)).collect()


def test_an_open_quote_at_the_end_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"open\nstill')
    assert csv_ranges.records(spark, str(tmp_path)).filter(F.col("record") == 1).first().value == '1,"open\nstill'
