"""Near-duplicates go by row, not by id."""

from geoloom.llm import simhash


def test_rows_of_a_repeated_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (4, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    left = sorted(map(tuple, simhash.drop_near_duplicates(df).collect()))
    assert left == [(1, a), (2, b), (3, c)]
