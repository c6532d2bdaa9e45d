"""Row-local operators take a streaming frame unchanged."""

from pyspark.sql import functions as F

from chalkline.operators import pii, quality


def test_masking_and_rules_on_a_stream(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    data = [("1", "Ann", "ann@example.com", "2015-03-14", "x"), (None, "Bob", "bob@example.com", "soon", "x")]
    schema = "id string, name string, mail string, born string, _source_system string"
    spark.createDataFrame(data, schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    masked = pii.hash_pii_columns(stream, ["name"], "mail", "born")
    rule = quality.Rule("id_present", "needs an id", "id", "non-null", F.col("id").isNull(), "person", F.lit("NULL"))
    log = quality.violations(masked, [rule], F.lit("2026-01-01 00:00:00"), "id")
    handle = (
        log.writeStream.format("memory").queryName("held").option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    try:
        handle.processAllAvailable()
        assert rows(spark.table("held"), "record_id", "rule_name", "field_value") == [("UNKNOWN", "id_present", "NULL")]
    finally:
        handle.stop()
