import numpy as np
import pytest
from pyspark.sql import functions as F

from msgloom.operators import embeddings

ROWS = [("u", [1.0, -2.0]), ("u", [3.0, 0.0]), ("v", [-1.0, -1.0]), (None, [9.0, 9.0]), ("u", None)]


@pytest.mark.parametrize(
    "pooling, u", [("mean", [2.0, -1.0]), ("max", [3.0, 0.0]), ("min", [1.0, -2.0]), ("sum", [4.0, -2.0]), ("what", [2.0, -1.0])]
)
def test_pooling(spark, pooling, u):
    df = spark.createDataFrame(ROWS, "id string, embedding array<float>")
    found = {r["id"]: r["embedding"] for r in embeddings.pool_embeddings(df, pooling).collect()}
    assert found == {"u": u, "v": [-1.0, -1.0]}


def test_pooling_without_vectors(spark):
    df = spark.createDataFrame([("u",), ("u",), (None,)], "id string")
    assert embeddings.pool_embeddings(df).collect() == [("u",)]


def test_sum_is_mean_times_count(spark):
    df = spark.range(200).select((F.col("id") % 7).cast("string").alias("id"), F.array(F.rand(1), F.rand(2)).alias("embedding")).cache()
    total = {r["id"]: r["embedding"] for r in embeddings.pool_embeddings(df, "sum").collect()}
    mean = {r["id"]: r["embedding"] for r in embeddings.pool_embeddings(df.repartition(9), "mean").collect()}
    count = {r["id"]: r["count"] for r in df.groupBy("id").count().collect()}
    for user in count:
        assert total[user] == pytest.approx([x * count[user] for x in mean[user]])


def test_methods(spark):
    df = spark.createDataFrame([("u", "Hello world"), ("u", None)], "id string, message string")
    hashed = [r["embedding"] for r in embeddings.embed_messages(df, "hashing", size=16).collect()]
    assert np.linalg.norm(hashed[0]) == pytest.approx(1) and hashed[1] == [0.0] * 16
    with pytest.raises(ValueError, match="register"):
        embeddings.embed_messages(df, "qwen3")
    with pytest.raises(ValueError, match="unsupported"):
        embeddings.embed_messages(df, "nope")

    def loader(language):
        sizes = []

        def encode(texts):
            sizes.append(len(texts))
            return [[float(len(t)), float(len(texts)), 1.0 if language == "en" else 0.0] for t in texts]

        return encode

    embeddings.register_encoder("lengths", loader)
    rows = spark.createDataFrame([("u", "a" * i) for i in range(5)], "id string, message string").coalesce(1)
    found = [r["embedding"] for r in embeddings.embed_messages(rows, "lengths", "en", batch_size=2).collect()]
    assert found == [[0, 2, 1], [1, 2, 1], [2, 2, 1], [3, 2, 1], [4, 1, 1]]
