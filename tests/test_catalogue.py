import __spark_entry__ as entry
import catalogue


def test_entry_and_registry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["kmer", "cnt"] and df.limit(1).count() == 1


def test_last_written_and_cleanup(spark):
    from pyspark.sql import functions as F

    from weftline.operators import annotate as N

    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "name string, o int, v string")
    assert {r.name: r.v for r in N.last_written(df, "name", "o").collect()} == {"a": "y", "b": "z"}
    got = spark.createDataFrame([(["X", "X-1", "Y-2"],)], "g array<string>").select(N.without_shadowed(F.col("g"))).first()[0]
    assert got == ["X", "Y-2"]
    assert catalogue.QUERIES
