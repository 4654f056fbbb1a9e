import datetime as dt

from pyspark.sql import functions as F

from martloom.streaming import ingest, tables, windows

SCHEMA = "event_id bigint, user_id bigint, ts timestamp"


def _put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _t(minute, day=1):
    return dt.datetime(2024, 1, day, 0, 0) + dt.timedelta(minutes=minute)


def test_sessions_close_after_the_sentinel(spark, folder):
    src, out, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "cp"))

    def run():
        events = ingest.source(spark, src, SCHEMA)
        query = ingest.start(windows.sessions(events, "user_id", "ts"), out, checkpoint)
        query.awaitTermination()
        return query

    _put(spark, src, [(1, 1, _t(0)), (2, 1, _t(20)), (3, 1, _t(80)), (4, 2, _t(5))])
    run()
    _put(spark, src, [(9, 9, _t(0, 20))])
    run()
    found = sorted((r["user_id"], r["events"]) for r in spark.read.parquet(out).collect())
    assert found == [(1, 1), (1, 2), (2, 1)]
    # Late by far: left out and counted, and the files already read stay read.
    _put(spark, src, [(10, 1, _t(1))])
    query = run()
    assert windows.dropped_late(query) == 1
    assert spark.read.parquet(out).count() == 3


def test_replayed_batch_is_written_once(spark, folder):
    out = f"{folder}/out"
    batch = spark.createDataFrame([(1, 1, _t(0))], SCHEMA)
    for _again in range(2):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id=0")
    assert spark.read.parquet(out).count() == 1

    src = f"{folder}/in"
    _put(spark, src, [(i, 1, _t(i)) for i in range(5)])
    calls = []

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{folder}/each/batch_id={batch_id}")
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost after the write, before the commit")

    def start():
        return ingest.per_batch(ingest.source(spark, src, SCHEMA), f"{folder}/cp", write)

    try:
        start().awaitTermination()
    except Exception:
        pass
    start().awaitTermination()
    assert calls == [0, 0] and spark.read.parquet(f"{folder}/each").count() == 5


def test_late_facts_touch_only_their_month(spark, folder):
    schema = "order_id string, order_line_id int, month int, net int"
    src, base, checkpoint = (f"{folder}/{n}" for n in ("in", "fact", "cp"))

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        feed = ingest.source(spark, src, schema)
        tables.keep_facts(feed, base, ["order_id", "order_line_id"], [F.desc("net")], "month",
                          checkpoint).awaitTermination()

    from martloom.sources import sinks

    run([("a", 1, 202401, 5), ("b", 1, 202402, 6)])
    run([("a", 1, 202401, 7), ("c", 1, 202401, 8)])
    found = sorted((r["order_id"], r["net"]) for r in sinks.get_batch(spark, base).collect())
    assert found == [("a", 7), ("b", 6), ("c", 8)]
    paths = {r["part"]: r["version"] for r in sinks._batch_commits(spark, base, None).groupBy("part").agg(
        F.max("version").alias("version")).collect()}
    assert paths == {"202401": 1, "202402": 0}


def test_sessions_of_a_hot_user_merge_before_the_shuffle(spark, folder):
    """A third of all events are one user's; the result equals the sessions of the whole table."""
    from martloom.streaming import windows

    schema = "user string, ts timestamp, n long"
    rows = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE concat('u', id % 40) END AS user",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * 7919) % 90000) AS ts", "id AS n")
    end = spark.createDataFrame([("end", dt.datetime(2030, 1, 1), 0)], schema)
    rows.repartition(3).write.parquet(f"{folder}/in")
    plans = []
    for _ in range(2):
        found = windows.sessions(ingest.source(spark, f"{folder}/in", schema), "user", "ts", "30 seconds", "2 days")
        with windows.merged_in_tasks(spark):
            query = ingest.start(found, f"{folder}/out", f"{folder}/checkpoint")
        query.awaitTermination()
        plans.append(query._jsq.explainInternal(False))
        end.write.mode("append").parquet(f"{folder}/in")
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    assert spark.conf.get(name) == "false"
    below_the_shuffle = plans[0].partition("Exchange")[2]
    assert "MergingSessions" in below_the_shuffle
    got = sorted(map(str, spark.read.parquet(f"{folder}/out").filter("user IS NULL OR user <> 'end'").collect()))
    want = rows.groupBy("user", F.session_window("ts", "30 seconds")).agg(
        F.count("*").alias("events"), F.min("ts").alias("first_event"), F.max("ts").alias("last_event")).drop("session_window")
    assert got == sorted(map(str, want.collect()))
