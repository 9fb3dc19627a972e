"""Queries on tables beyond the size of the test data."""

from terravane.plans import queries


def test_validation_has_a_row_for_every_supplier(spark, tmp_path):
    spark.range(1, 9001).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    got = {r.s_suppkey: r.power for r in queries.queries()["p19_p22_validation"](spark, str(tmp_path)).collect()}
    assert got == {k: k & (k - 1) == 0 for k in range(1, 9001)}
