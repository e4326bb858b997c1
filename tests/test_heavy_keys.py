from collections import Counter

from pyspark.sql import functions as F

from sitewright.functions.genome import canonical_posid
from sitewright.operators.heavy_keys import aggregate_skewed


def test_crowded_keys(spark):
    keys = ["hot"] * 3000 + [None] * 50 + [f"k{i % 700}" for i in range(2100)] + [""] * 4
    df = spark.createDataFrame([(k, i, None if i % 5 == 0 else 1) for i, k in enumerate(keys)], "key string, n long, v int")
    got = {r.key: (r.c, r.s) for r in aggregate_skewed(df, "key", [F.count("*").alias("c"), F.sum("v").alias("s")]).collect()}
    counts = Counter(k for k in keys if k is not None)
    sums = Counter(k for i, k in enumerate(keys) if k is not None and i % 5)
    assert got == {k: (n, sums[k] or None) for k, n in counts.items()}


def test_empty(spark):
    df = spark.createDataFrame([], "key string, v int")
    assert aggregate_skewed(df, "key", [F.sum("v").alias("s")]).collect() == []


def test_spellings(spark):
    cases = {"chr1+123456": "chr1+123456", " CHR1+1.23456E5\t": "chr1+123456", " Chr1+123456.0": "chr1+123456", "chrx-7": "chrX-7", "chr20+4.45587990e+07": "chr20+44558799", "  ": None, "odd": "odd", "chr1+": "chr1+", "chr2*5": "chr2*5"}
    df = spark.createDataFrame([*cases.items(), (None, None)], "a string, b string").select("a", "b", canonical_posid(F.col("a")).alias("c"))
    assert [r for r in df.collect() if r.b != r.c] == []
