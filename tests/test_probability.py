import numpy as np
from pyspark.sql import functions as F

from alertflow.functions.probability import softmax, top_class


def test_softmax_and_top_class_agree_with_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [rng.normal(0, 5, size=n).tolist() for n in (1, 2, 3, 64) for _ in range(20)]
    rows += [[1000.0, 999.0], [-1000.0, -1000.0], [0.0, 0.0, 0.0], [3.0, 5.0, 5.0]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, logits array<double>")
    got = df.select("i", softmax(F.col("logits")).alias("p"), top_class(F.col("logits")).alias("t")).orderBy("i").collect()
    for logits, row in zip(rows, got):
        weights = np.exp(np.array(logits) - max(logits))
        expected = weights / weights.sum()
        np.testing.assert_allclose(row["p"], expected, rtol=1e-12)
        assert row["t"]["prediction"] == int(np.argmax(logits))
        np.testing.assert_allclose(row["t"]["confidence"], expected.max(), rtol=1e-12)
