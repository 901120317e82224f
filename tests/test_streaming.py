"""ST0: the streaming face - watermark de-duplication and windowed counts
driven to completion from the events parquet through a memory sink."""

from pyspark.sql import functions as F

from citypulse.streaming.scoring import dedup_stream, windowed_counts

SF = "/root/testdata/sf0.001"


def test_stream_dedup_and_windowed_counts(spark):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF)
           .withColumn("ts", F.col("ts").cast("timestamp")))
    batch_n = spark.read.parquet(f"{SF}/events.parquet").count()
    q1 = (dedup_stream(src, ["event_id"], "ts", "1 hour").writeStream.format("memory")
          .queryName("dedup_out").outputMode("append").start())
    q1.processAllAvailable()
    q1.stop()
    assert spark.sql("SELECT count(*) c, count(DISTINCT event_id) d FROM dedup_out").first() == (batch_n, batch_n)
    q2 = (windowed_counts(src, "ts", "event_type", "1 day", "1 day").writeStream.format("memory")
          .queryName("win_out").outputMode("complete").start())
    q2.processAllAvailable()
    q2.stop()
    assert spark.sql("SELECT sum(n) FROM win_out").first()[0] == batch_n
