import pytest
from pyspark.sql import functions as F

from echolex.sources import message_log as M
from echolex.streaming import posts as stream

NOW = {"processingTime": "0 seconds"}


def numbered(spark, low, high, tasks=1):
    return spark.range(low, high, 1, tasks).select(F.col("id").cast("string").alias("value"))


def read(spark, path):
    M.register(spark)
    return sorted((r["partition"], r["offset"], r["value"]) for r in spark.read.format("message_log").load(path).collect())


def follow(spark, path, out, checkpoint, **options):
    """Store a stream of the log; the number of batches it took."""
    rows = stream.read_messages_stream(spark, "message_log", path=path, **options)
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**NOW).start()
    try:
        stream.drain(query)
        return sum(p["numInputRows"] > 0 for p in query.recentProgress)
    finally:
        query.stop()


def stored(spark, out):
    return sorted(int(r["value"]) for r in spark.read.parquet(out).collect())


def test_offsets_run_on_in_every_partition(spark, tmp_path):
    path = f"{tmp_path}/log"
    M.append(numbered(spark, 0, 10, 2), path, partitions=2)
    M.append(numbered(spark, 10, 13), path, partitions=2)
    M.append(numbered(spark, 0, 0), path, partitions=2)
    rows = read(spark, path)
    assert [r[:2] for r in rows] == [(0, k) for k in range(8)] + [(1, k) for k in range(5)]
    assert [r[2] for r in rows] == list("01234") + ["10", "11", "12"] + list("56789")


def test_empty_and_null_messages(spark, tmp_path):
    assert read(spark, f"{tmp_path}/none") == []
    M.append(spark.createDataFrame([("",), (None,)], "value string").coalesce(1), f"{tmp_path}/log")
    assert read(spark, f"{tmp_path}/log") == [(0, 0, ""), (0, 1, None)]


@pytest.mark.parametrize("rows_per_task", [3, 1000])
def test_the_cap_changes_batches_and_not_rows(spark, tmp_path, rows_per_task):
    path = f"{tmp_path}/log"
    M.append(numbered(spark, 0, 40, 2), path, partitions=2)
    M.append(numbered(spark, 40, 50), path, partitions=2)
    batches = {}
    for cap in (7, 20, 1000):
        out = f"{tmp_path}/out{cap}"
        batches[cap] = follow(
            spark, path, out, f"{out}-c", maxOffsetsPerTrigger=cap, group=f"g{cap}", rowsPerTask=rows_per_task
        )
        assert stored(spark, out) == list(range(50))
    assert batches == {7: 8, 20: 3, 1000: 1}


def test_a_restarted_stream_goes_on(spark, tmp_path):
    path, out, c = f"{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/c"
    for low in (0, 20, 40):
        M.append(numbered(spark, low, low + 20), path)
        assert follow(spark, path, out, c, maxOffsetsPerTrigger=8, group="g") == 3
        assert stored(spark, out) == list(range(low + 20))


def test_only_new_messages(spark, tmp_path):
    path, out, c = f"{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/c"
    M.append(numbered(spark, 0, 5), path)
    assert follow(spark, path, out, c, startingOffsets="latest") == 0
    M.append(numbered(spark, 5, 8), path)
    follow(spark, path, out, c, startingOffsets="latest")
    assert stored(spark, out) == [5, 6, 7]


@pytest.mark.parametrize("fail", ["true", "false"])
def test_expired_offsets(spark, tmp_path, fail):
    path, out, c = f"{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/c"
    M.append(numbered(spark, 0, 5), path)
    follow(spark, path, out, c, failOnDataLoss=fail)
    for low in (5, 10, 15):
        M.append(numbered(spark, low, low + 5), path)
    M.expire(path, 0, 12)
    assert [r[1] for r in read(spark, path)] == list(range(10, 20))
    if fail == "true":
        with pytest.raises(Exception, match="messages 5 to 9 of partition 0 have expired"):
            follow(spark, path, out, c, failOnDataLoss=fail)
    else:
        follow(spark, path, out, c, failOnDataLoss=fail)
        assert stored(spark, out) == [*range(5), *range(10, 20)]


def test_caps_need_a_group():
    with pytest.raises(ValueError):
        M.StreamReader({"path": "/nowhere", "maxOffsetsPerTrigger": "5"})


def test_capped_offsets():
    bounds = {0: (0, 90), 1: (5, 15), 2: (0, 0)}
    end = M.capped({}, bounds, 10)
    assert sum(end.values()) - 5 == 10 and end["0"] == 9 and end["1"] == 6
    assert M.capped({"0": 90, "1": 14}, bounds, 10) == {"0": 90, "1": 15, "2": 0}


def files(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.parquet"))


def test_a_failed_batch_leaves_no_trace(spark, tmp_path):
    path = f"{tmp_path}/log"
    M.append(numbered(spark, 0, 4), path)
    before = files(tmp_path / "log")
    broken = numbered(spark, 4, 8, 2).select(
        F.when(F.col("value") == "7", F.raise_error(F.lit("lost"))).otherwise(F.col("value")).alias("value")
    )
    with pytest.raises(Exception, match="lost"):
        M.append(broken, path)
    assert files(tmp_path / "log") == before
    assert len(read(spark, path)) == 4


def test_a_broken_off_commit_is_finished_once(tmp_path):
    writer = M.StreamWriter({"path": f"{tmp_path}/log", "stream": "s"})
    log = M.Log(writer.path)
    staged = f"{log.root}/_staged/{writer.run}"
    log.fs.create_dir(staged, recursive=True)
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name in "ab":
        pq.write_table(pa.table({"value": [name]}), f"{staged}/{name}.parquet")
    message = M.Staged(0, [[f"{staged}/a.parquet", 1], [f"{staged}/b.parquet", 1]])
    moves = [[f"{staged}/a.parquet", log.segment_path(0, 0)], [f"{staged}/b.parquet", log.segment_path(0, 1)]]
    log.write_note("_commits/s/4", moves)  # as far as the first attempt came
    writer.commit([message, None], 4)
    writer.commit([message], 4)
    assert log.bounds() == {0: (0, 2)} and not files(tmp_path / "log" / "_staged")


def test_a_new_checkpoint_needs_a_new_name(spark, tmp_path):
    numbered(spark, 0, 6).write.parquet(f"{tmp_path}/in")

    def send(checkpoint, name):
        rows = spark.readStream.schema("value string").parquet(f"{tmp_path}/in")
        M.start_message_sink(rows, f"{tmp_path}/log", f"{tmp_path}/{checkpoint}", name, trigger={"availableNow": True}).awaitTermination()

    send("c1", "one")
    with pytest.raises(ValueError, match="new stream name"):
        send("c2", "one")
    send("c1", "one")
    assert len(read(spark, f"{tmp_path}/log")) == 6
    send("c2", "two")
    assert len(read(spark, f"{tmp_path}/log")) == 12
