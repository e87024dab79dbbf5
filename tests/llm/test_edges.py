"""Empty tables, clashing columns, null and repeated ids where the other tests have none of them."""

import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from alertflow.llm import chat, curves, mixing, polytope, secret_scan, sharding, warc
from alertflow.llm.queries import QUERIES, page_archive

BIG = 2**53 + 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_empty_tables(spark, sf_dir, tmp_path, name):
    for table in Path(sf_dir).iterdir():
        whole = pq.read_table(table) if name in ("op4_mixing", "op5_toxicity") and table.name == "labels.parquet" else pq.read_table(table).slice(0, 0)
        pq.write_table(whole, tmp_path / table.name)
    found = QUERIES[name](spark, str(tmp_path))
    full = QUERIES[name](spark, sf_dir) if name == "op1_chat" else None
    assert found.count() == (1 if name == "op1_chat" else 0)
    assert full is None or found.columns == full.columns


def test_a_good_part_of_the_pages_is_segmented(spark, sf_dir):
    records = warc.read_records(spark, page_archive(spark, sf_dir))
    parts = records.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    assert parts.filter("n > 1").count() > 0.15 * parts.count() and parts.filter("n > 2").count() > 1


def test_warc_rows_with_null_and_repeated_ids(spark, sf_dir, tmp_path):
    pages = [(None, "u", "x" * 2000, 1), (BIG, None, "x" * 2000, 1), (BIG + 2, "u", "x" * 2000, 1), (BIG + 2, "u", "y\r\n\r\nWARC/1.1\r\n" * 900, 1),
             (7, "u", None, 1), (7, "u", "", 1), (8, "u", "é" * 3000, 1)]
    for table in Path(sf_dir).iterdir():
        shutil.copyfile(table, tmp_path / table.name)
    clash = spark.createDataFrame(pages, "page_id long, url string, html string, digest int")
    pq.write_table(clash.toArrow(), tmp_path / "pages.parquet")
    rows = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in QUERIES["op2_warc"](spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == sorted(
        [(None, 2000, "response", None), (BIG, 2000, "revisit", BIG + 2), (BIG + 2, 2000, "response", None),
         (BIG + 2, 15 * 900, "response", None), (7, 0, "response", None), (7, 0, "response", None), (8, 6000, "response", None)], key=str,
    )


def test_clashing_columns_are_carried_or_ignored(spark):
    rows = [(None, "a b", 1), (BIG, "password=abcdefghijklmnop", 2), (BIG, "password=abcdefghijklmnop", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _words int")
    scanned = secret_scan.find_secrets(docs.withColumnsRenamed({"_words": "_rows"}))
    assert sorted((str(r.doc_id), len(r._spans)) for r in scanned.collect()) == [(str(BIG), 1), (str(BIG), 1), ("None", 0)]
    placed = sharding.with_slots(sharding.with_shards(docs.withColumnRenamed("_words", "size"), "doc_id", 3), "doc_id")
    assert sorted(str(r.doc_id) for r in placed.collect()) == [str(BIG), str(BIG), "None"]
    labels = spark.createDataFrame([(BIG, "r"), (None, "b")], "doc_id long, domain string")
    rated = mixing.fit(docs.select("doc_id", "text"), labels, {"r": 1.0, "b": 1.0}).rates(docs.select("doc_id", "text"))
    assert sorted(str(r.doc_id) for r in rated.collect()) == [str(BIG), str(BIG), "None"]
    turns = spark.createDataFrame([(BIG, 0, "user", "q", 1), (None, 0, "user", "r", 2)], "conv_id long, turn long, role string, text string, depth int")
    done = chat.format_trees(chat.turns_as_tree(turns), keep=1)
    assert sorted(str(r.tree) for r in done.collect()) == [str(BIG), "None"]


def test_vectors_of_other_lengths_and_repeated_ids(spark):
    data = [(100, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [0.9, 0.1]), (2, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (BIG, [1.0, 0.001])]
    vectors = spark.createDataFrame([(*r, 0, "clash") for r in data], "vec_id long, embedding array<double>, label int, key string")
    found = curves.nearest(vectors)
    assert [(r.vec_id, r["rank"]) for r in found.filter("query_id = 100").orderBy("rank").collect()] == [(BIG, 1), (1, 2)]
    near = {(r.vec_id, r.component_id) for r in polytope.near_duplicates(vectors).collect()}
    assert (2, 2) in near and (BIG, 1) in near and (100, 1) in near
