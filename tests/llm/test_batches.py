"""The batches in which texts go to Python."""

import pyarrow as pa
from test_operators import docs_of

from alertflow.llm import common, jaccard, toxicity

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    before, seen = spark.conf.get(BATCH_SETTING), []

    def spied(module, name):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *args: seen.append(spark.conf.get(BATCH_SETTING)) or plain(*args))

    spied(jaccard, "_components")
    spied(toxicity, "evidence")
    docs = docs_of(spark, ["a b c d e f", "bad bad", "g", "bad"] * 5)
    jaccard.join_similar(docs)
    jaccard.one_of_each(docs)
    labels = docs.selectExpr("doc_id", "CAST(text LIKE 'bad%' AS int) AS toxic")
    toxicity.fit(spark, docs, labels).score(docs)
    assert seen == [str(common.BATCH_BYTES)] * 4 and spark.conf.get(BATCH_SETTING) == before


def test_small_batches_bound_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS n", "repeat('x', 8192) AS text")
    with common.small_batches(spark):
        found = [r.n for r in common.written(docs.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(found) > 3000 * 8192 and max(found) < 1.1 * common.BATCH_BYTES
