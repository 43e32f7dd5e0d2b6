"""A stream run to its end gives the batch's windows."""

from tests.conftest import DATA

from strandline.streaming import events


def test_stream_equals_batch(spark, tmp_path):
    batch = spark.read.parquet(f"{DATA}/events.parquet")
    want = {tuple(r) for r in events.tumbling(batch, "1 hour", "10 days", ["event_type"]).select("start", "event_type", "n").collect()}
    batch.write.parquet(str(tmp_path / "in"))
    stream = events.tumbling(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")), "1 hour", "10 days", ["event_type"])
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windows_out").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.table("windows_out").select("start", "event_type", "n").collect()}
    assert got == want and want


def test_sessions(spark):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:04:00"), (1, "2024-01-01 01:00:00")], "user_id int, ts string")
    assert sorted(r["n"] for r in events.sessions(rows, "5 minutes", "1 day", ["user_id"]).collect()) == [1, 2]
