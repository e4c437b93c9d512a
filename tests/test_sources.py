"""Files and streams: strict reading, sinks, and event-time windows over a directory that grows."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources import documents
from skyledger.streaming import windows


def test_strict_reading_and_sinks(spark, tmp_path):
    texts = {"a.json": {"schema_version": "v1", "n": 1}, "b.json": {"schema_version": "v0", "n": 1}, "c.json": {"schema_version": "v1", "odd": 1}}
    for name, doc in texts.items():
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
    (tmp_path / "d.json").write_text("{broken")
    schema = T.StructType([T.StructField("schema_version", T.StringType()), T.StructField("n", T.LongType())])
    good, bad = documents.read_strict(spark, str(tmp_path / "*.json"), schema, "v1")
    assert [r.n for r in good.collect()] == [1]
    assert {os.path.basename(r.path): r.error for r in bad.collect()} == {"b.json": "another schema version", "c.json": "unknown keys: odd", "d.json": "not a JSON object"}
    x = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    documents.write_catalog(x, str(tmp_path / "out"), ["id"])
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    for _ in range(2):
        documents.append_log(x, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    plan = documents.planned(x, spark.createDataFrame([("b", 1), ("z", 1)], "id string, v int"), "id")
    assert sorted(map(tuple, plan.collect())) == [("a", "write"), ("b", "write"), ("z", "delete")]


def test_windows_over_a_stream_leave_out_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def drop(name, rows):
        (source / name).write_text("\n".join(json.dumps({"ts": t, "k": k}) for t, k in rows))

    def run(frame, out, mode):
        q = frame.writeStream.format("memory").queryName(out).outputMode(mode).option("checkpointLocation", str(tmp_path / out)).trigger(availableNow=True).start()
        q.awaitTermination()

    stream = lambda: spark.readStream.schema("ts timestamp, k string").json(str(source))
    drop("1.json", [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", "a"), ("2024-01-01 09:00:00", "b")])
    counts = lambda: windows.windowed_counts(stream(), "ts", "k").select(F.col("window.start").cast("string").alias("s"), "k", "n")
    firsts = lambda: windows.first_seen(stream(), "ts", ["k"], "1 hour")
    run(counts(), "counts1", "append")
    run(firsts(), "firsts1", "append")
    assert {tuple(r) for r in spark.table("counts1").collect()} <= {("2024-01-01 00:00:00", "a", 2), ("2024-01-01 09:00:00", "b", 1)}
    assert sorted(r.k for r in spark.table("firsts1").collect()) == ["a", "b"]
    batch = spark.read.schema("ts timestamp, k string").json(str(source))
    assert sorted((r.k, r.n) for r in windows.windowed_counts(batch, "ts", "k").collect()) == [("a", 2), ("b", 1)]
