"""Every order passes the FHIR operator and its census, also of a customer that holds most of them."""
from veilspark.plans.queries import QUERIES


def test_no_order_is_left_out(spark, tmp_path):
    spark.createDataFrame([(1, "Ann", "A"), (2, "Bob", "B"), (3, "Cyd", "C")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(i, 1 if i < 23 else 2, i + 0.5) for i in range(28)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.file_name: r.entries for r in QUERIES["fhir_entries"](spark, str(tmp_path)).collect()}
    assert got == {"1.json": 6, "1-2.json": 6, "1-3.json": 6, "1-4.json": 6, "1-5.json": 4, "2.json": 6, "3.json": 1}
    census = {r.path: r.documents_seen for r in QUERIES["fhir_census"](spark, str(tmp_path)).collect()}
    assert census["Observation.id"] == 28 and census["Patient.id"] == 7
