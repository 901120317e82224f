import json

from pyspark.sql import functions as F

from citypulse.sources import reports as R


def sections(spark):
    def broken():
        return spark.range(1).select("no_such_column")

    def late():
        return spark.range(1).select(F.raise_error(F.lit("boom")).cast("int").alias("x"))
    return {"kpis": lambda: spark.range(1).select(F.lit(2.5).alias("rate"), F.array(F.struct(
                F.lit(1).alias("zone"), F.lit("Low").alias("risk"))).alias("assignments"), F.lit(None).alias("none")),
            "broken": broken, "late": late, "two rows": lambda: spark.range(2)}


def test_failing_sections_are_data_and_documents_round_trip(spark, tmp_path):
    R.write_document(R.build_document(spark, sections(spark), "t0"), str(tmp_path / "r"))
    doc = R.read_document(spark, str(tmp_path / "r"))
    got = json.loads(doc.select(F.to_json("document")).first()[0])
    assert got["kpis"]["rate"] == 2.5 and got["kpis"]["assignments"] == [{"zone": 1, "risk": "Low"}]
    assert got["broken"]["error"].startswith("UNRESOLVED_COLUMN")
    assert "error" in got["late"] and got["two rows"]["error"] == "ValueError: 2 rows where one was expected"
    assert got["metadata"] == {"generated_at": "t0", "overall_status": "PARTIAL"}
    row = doc.select(R.at("$.kpis.rate", "double"), R.at("$.kpis.assignments[0].risk"), R.at("$.absent.x")).first()
    assert tuple(row) == (2.5, "Low", None)


def test_merge_by_path(spark):
    old = R.build_document(spark, {
        "a": lambda: spark.range(1).select(F.lit(1).alias("x"), F.lit("kept").alias("y")),
        "b": lambda: spark.range(1).select("no_such_column")}, "t0")
    new = R.build_document(spark, {
        "a": lambda: spark.range(1).select(F.lit(2).alias("x")),
        "b": lambda: spark.range(1).select(F.lit(True).alias("z"))}, "t1")
    got = json.loads(R.merge_documents(old, new).select(F.to_json("document")).first()[0])
    assert got == {"a": {"x": 2, "y": "kept"}, "b": {"z": True},
                   "metadata": {"generated_at": "t1", "overall_status": "OK"}}
    back = json.loads(R.merge_documents(new, old).select(F.to_json("document")).first()[0])
    assert back["metadata"]["overall_status"] == "PARTIAL" and back["a"]["x"] == 1 and "error" in back["b"]


def test_all_failed(spark):
    doc = R.build_document(spark, {"b": lambda: spark.range(0)}, "t")
    assert doc.select(R.at("$.metadata.overall_status")).first()[0] == "FAILED"
