"""Hot keys: one loan / one group holding most rows must give the same answers as the
plain formulations (the operators pre-aggregate and split such groups)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrisk.operators.labels import forward_default_label, forward_default_label_naive
from tallyrisk.operators.ranking import cumulative


def test_hot_loan_label_matches_naive(spark):
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(2000):  # one loan: 24 months, each repeated many times
        m = i % 24
        rows.append(("HOT", dt.date(base.year + (base.month - 1 + m) // 12, (base.month - 1 + m) % 12 + 1, 1),
                     90 if m in (7, 19) else 0))
    for j in range(50):
        rows.append((f"L{j}", base, 0))
    df = spark.createDataFrame(rows, "loan_id string, reporting_month date, dpd int")
    a = forward_default_label(df).groupBy("reporting_month", "label").count()
    b = forward_default_label_naive(df).groupBy("reporting_month", "label").count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert forward_default_label(df).count() == len(rows)


def test_cumulative_with_one_dominant_group(spark):
    data = [(0, float(i % 997), 1) for i in range(5000)] + [(1, float(i), 1) for i in range(50)]
    df = spark.createDataFrame(data, "g int, v double, c int")
    got = cumulative(df, ["g"], "v", ["c"], buckets=16)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.groupBy("g", "v").agg(F.sum("c").alias("c")).select("g", "v", F.sum("c").over(w).alias("cum_c"))
    assert sorted(map(tuple, got.select("g", "v", "cum_c").collect())) == sorted(map(tuple, ref.collect()))
