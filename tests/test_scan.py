import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave.operators.scan import ordered_scan, position_in_group


def test_scan_equals_plain_windows_for_any_chunking(spark):
    rng = random.Random(7)
    rows = []
    for doc in ("a", "b", "c"):
        chunk = 0
        for i in range(rng.randint(1, 60)):
            chunk += rng.random() < 0.3
            rows.append((doc, chunk, i, rng.choice([None, None, rng.randint(0, 9)]), rng.randint(-5, 5)))
    df = spark.createDataFrame(rows, "doc string, chunk bigint, i bigint, v int, n int").repartition(5)
    got = ordered_scan(
        df, ["doc"], "chunk", ["i"], last={"carried": F.col("v")}, sums={"total": F.col("n")}, mins={"least": F.col("n")},
        lead={"after": F.col("n")}, lag={"before": F.col("n")},
    )
    w = Window.partitionBy("doc").orderBy("i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns(
        {
            "carried": F.last("v", True).over(upto), "total": F.sum("n").over(upto), "least": F.min("n").over(upto),
            "after": F.lead("n").over(w), "before": F.lag("n").over(w),
        }
    )
    columns = ["doc", "i", "carried", "total", "least", "after", "before"]
    key = lambda r: (r.doc, r.i)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(map(tuple, want.select(columns).collect()), key=str)
    assert len(set(map(key, got.collect()))) == len(rows)


def test_hot_group_is_numbered_across_its_chunks(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("i"), F.floor(F.col("id") / 100).alias("chunk"))
    numbered = position_in_group(df, ["k"], "chunk", ["i"], "n")
    assert numbered.where("n != i + 1").count() == 0
    # The only window over the whole group runs on one row per chunk.
    assert df.select("chunk").distinct().count() == 50


def test_written_scan_equals_the_other(spark):
    rows = [("a", c, c * 10 + i, v) for c in range(3) for i, v in enumerate([None, "x", None] if c != 1 else [None, None])] + [("b", 0, 0, "y")]
    df = spark.createDataFrame(rows, "k string, chunk int, at int, v string")
    asked = dict(
        last={"seen": F.col("v")}, sums={"n": F.lit(1).cast("bigint")}, mins={"least": F.col("at")}, lead={"then": F.col("at")}, lag={"was": F.col("at")}
    )
    plain, written = (ordered_scan(df, ["k"], "chunk", ["at"], **asked, **more) for more in ({}, {"label": "t"}))
    assert sorted(map(str, written.collect())) == sorted(map(str, plain.collect()))
    assert "parquet" in written._jdf.queryExecution().optimizedPlan().toString()
