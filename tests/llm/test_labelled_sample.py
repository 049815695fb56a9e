"""The labelled sample is bounded in rows."""

from pyspark.sql import functions as F

from geoloom.llm.labelled import sample


def test_one_text_of_an_id(spark):
    documents = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(2, "other"), (3, None)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    found = [sample(d, labels, "quality", F.lit(True), 5, 100) for d in (documents, documents.repartition(7))]
    texts, own = found[0]
    assert found[0] == found[1] and own == [1, 0] and texts[0].startswith("text ") and texts[1] == "other"
