"""Tag vectors keep every tag."""

from pyspark.sql import functions as F

from docloom.operators.terms import tf_idf


def test_more_tags_than_the_default_vocabulary(spark):
    docs = spark.range(263).selectExpr("id", "transform(sequence(0, 999), i -> concat('t', id * 1000 + i)) AS tags")
    rows, words = tf_idf(docs, "id", F.col("tags"))
    assert words.count() == 263_000 == words.select(F.max("term_id") + 1).first()[0] and rows.count() == 263_000
