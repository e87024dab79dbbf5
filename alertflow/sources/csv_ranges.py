"""Large CSV files with line breaks inside quotes, read by many tasks.

Spark's text source cuts a file into byte ranges at line ends, and some of these stand inside quotes. Whether one does
follows from the number of quotes before it: an odd number leaves a field open. So

* the first pass counts the quotes of every range;
* sums over the ranges of a file, one row each, tell in which state a range begins, and which range holds the beginning of the record
  that is open there;
* the second pass joins the lines of each range to records from that state. Records inside a range are whole; the
  pieces of those that cross a cut are put together by file and place.

Quotes have to follow the rules: a field with quotes, line breaks or commas stands in quotes, and quotes inside it are doubled. A
file that breaks them is for ``read_csv``, which also reads other encodings than UTF-8. Files that are compressed as a whole
are one range. A record has to fit in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertflow.sources.csv_feed import QUOTING, csv_schema, filled
from alertflow.streaming.scratch import new_folder

#: Kinds of pieces: a whole record, the end of the record that was open before the range, the record left open at its end.
WHOLE, END, OPEN = range(3)
_PIECE = pa.schema(
    [("file", pa.string()), ("begin", pa.int64()), ("opener", pa.int64()), ("part", pa.int32()), ("record", pa.int64()), ("value", pa.string())]
)
_PIECE_DDL = "file string, begin long, opener long, part int, record long, value string"
_STATE = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("odd", pa.int32()), ("even_end", pa.bool_()), ("odd_end", pa.bool_())])
#: Pieces that a task holds before it hands them on.
HELD = 10_000
#: Ranges whose states are sent to every task; with more, lines are shuffled to the state of their range.
RANGES_SENT = 1 << 20


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("line"), "value",
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, schema.types, strict=True)], schema=schema)


def range_states(lines: DataFrame) -> DataFrame:
    """(file, begin, inside, opener) per range: whether it begins inside quotes, and the range where the record began that is open there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range is read by one task, which reads few.
        ranges: dict[tuple, list] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "begin", "quotes"))
            for file, begin, quotes in zip(*columns, strict=True):
                # Odd or even so far, and whether a line ended in either state.
                state = ranges.setdefault((file, begin), [0, False, False])
                state[0] ^= quotes & 1
                state[1 + state[0]] = True
        yield _batch([(*place, *state) for place, state in ranges.items()], _STATE)

    quotes = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes")
    counted = lines.select("file", "begin", quotes).mapInArrow(
        count, "file string, begin long, odd int, even_end boolean, odd_end boolean"
    )
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    # A record begins in a range after another has ended there, or with the range.
    begins = ~F.col("inside") | F.when(F.col("inside"), F.col("odd_end")).otherwise(F.col("even_end"))
    opener = F.last(F.when(begins, F.col("begin")), ignorenulls=True).over(before)
    return placed.select("file", "begin", "inside", opener.alias("opener"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place: tuple | None = None
    number, is_open, leads = 0, False, False
    held: list[str] = []
    out: list[tuple] = []

    def piece(part: int) -> None:
        nonlocal number
        file, begin, opener = place
        out.append((file, begin, opener if part == END else begin, part, number, "\n".join(held)))
        number += 1
        held.clear()

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("file", "begin", "inside", "opener", "value"))
        for file, begin, inside, opener, value in zip(*columns, strict=True):
            if place is None or (file, begin) != place[:2]:
                if held:
                    piece(END if leads else OPEN)
                place, number, is_open, leads = (file, begin, opener), 0, inside, inside
            held.append(value)
            is_open ^= value.count('"') & 1 == 1
            if not is_open:
                piece(END if leads else WHOLE)
                leads = False
            if len(out) >= HELD:
                yield _batch(out, _PIECE)
                out = []
    if held:
        piece(END if leads else OPEN)
    yield _batch(out, _PIECE)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, record, value): every record of the files as one text; range and number order those of a file."""
    lines = _lines(spark, path)
    states, folder = range_states(lines), new_folder(spark, "ranges")
    states.write.parquet(folder)
    states = spark.read.schema(states.schema).parquet(folder)
    if states.count() <= RANGES_SENT:
        # Lines stay where they were read, in order.
        placed = lines.join(F.broadcast(states), ["file", "begin"])
    else:
        placed = lines.join(states, ["file", "begin"]).repartition("file", "begin").sortWithinPartitions("file", "begin", "line")
    pieces = placed.select("file", "begin", "inside", "opener", "value").mapInArrow(_pieces, _PIECE_DDL)
    whole = pieces.filter(F.col("part") == WHOLE).select("file", "begin", "record", "value")
    parts = F.array_sort(F.collect_list(F.struct("begin", "value"))).alias("parts")
    first = F.min_by("record", "begin").alias("record")
    cut = pieces.filter(F.col("part") != WHOLE).groupBy("file", "opener").agg(parts, first)
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")
    return whole.unionByName(cut.select("file", F.col("opener").alias("begin"), "record", joined))


def read_csv_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``read_csv`` with every file read by as many tasks as it has ranges.

    Rows come without an order. All files must have the header of the first; another one raises.
    """
    schema = csv_schema(spark, path)
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)
    found = records(spark, path).withColumn("value", F.regexp_replace("value", "\r$", ""))
    parsed = found.filter("value <> ''").select(
        ((F.col("begin") == 0) & (F.col("record") == 0)).alias("_is_header"),
        F.from_csv("value", columns, {"escape": QUOTING["escape"]}).alias("_row"),
    )
    named = F.array(*[F.col("_row")[name] for name in schema.names]) == F.array(*map(F.lit, schema.names))
    other = F.raise_error(F.lit(f"a file below {path} has another header than {schema.names}"))
    is_row = F.when(~F.col("_is_header"), True).when(named, False).otherwise(other.cast("boolean"))
    return filled(parsed.filter(is_row).select("_row.*"))
