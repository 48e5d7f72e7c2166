from pyspark.sql import functions as F

from strandline.streaming.bins import read_stream, windowed


def test_stream_equals_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet")
    e.repartitionByRange(3, "ts").write.parquet(str(tmp_path / "in"))
    q = windowed(read_stream(spark, str(tmp_path / "in"), e.schema), "ts", "event_type", "value", "1 day").writeStream.outputMode("complete").format("memory").queryName("bins").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.sql("SELECT event_type, bin_start, n, low FROM bins").collect()))
    want = e.groupBy("event_type", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("b")).agg(F.count("value").alias("n"), F.min("value").alias("low"))
    assert got == sorted(map(tuple, want.select("event_type", "b", "n", "low").collect()))
