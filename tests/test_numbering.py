import random

from pyspark.sql import functions as F

from trendengine.operators.numbering import counts_before, number_rows


def test_numbers_are_dense_and_in_order(spark):
    rng = random.Random(7)
    seqs = rng.sample(range(1 << 50), 200) + list(range(100)) + [1 << 40, (1 << 40) + 1, 1 << 62]
    df = spark.createDataFrame([(s, f"k{s}") for s in seqs], "seq long, k string").repartition(5)
    rows = number_rows(df, "seq", ["k"], "n").orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, len(seqs) + 1))
    assert [r["seq"] for r in rows] == sorted(seqs)


def test_ties_are_numbered_by_the_second_column(spark):
    df = spark.createDataFrame([(5, "b"), (5, "a"), (1, "z")], "seq long, k string")
    assert [r["k"] for r in number_rows(df, "seq", ["k"], "n").orderBy("n").collect()] == ["z", "a", "b"]


def test_counts_before_with_negative_codes(spark):
    cells = [(-(1 << 45), 2), (-1, 3), (0, 5), (1 << 30, 7), ((1 << 30) + 1, 11)]
    df = spark.createDataFrame(cells, "code long, n long")
    found = {r["code"]: r["before"] for r in counts_before(df, "code", "n", "before").collect()}
    total, wanted = 0, {}
    for code, n in cells:
        wanted[code], total = total, total + n
    assert found == wanted


def test_no_window_takes_all_rows(spark):
    """Only the block totals may share one task."""
    df = spark.range(10).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("k"))
    plan = number_rows(df, "seq", ["k"], "n")._jdf.queryExecution().executedPlan().toString()
    singles = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(singles) <= 1
