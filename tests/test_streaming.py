import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from support import plan_of, rows
from wellspark.sources.schemas import RECORD
from wellspark.streaming import events as ev
from wellspark.streaming import offsets, sinks


def record(event_id, partition=0, offset=None, **changes):
    event = {
        "event_id": event_id, "user_id": event_id % 5, "ts": 1700000000.25,
        "heart_rate": 70, "steps_delta": 3, "device": "Apple",
    }
    event.update(changes)
    return (str(event["user_id"]), json.dumps(event), partition, event_id if offset is None else offset)


class Topic:
    """A folder of record files with a table, an error table and checkpoints beside it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, str(path), 0

    def send(self, *records):
        batch = self.spark.createDataFrame(records, RECORD).coalesce(1)
        batch.write.mode("append").parquet(f"{self.path}/in")

    def run(self, checkpoint="c", max_rows=None, **options):
        stream = ev.read_files(self.spark, f"{self.path}/in", **options)
        return sinks.run_available(
            stream, f"{self.path}/t", f"{self.path}/{checkpoint}", f"{self.path}/e", max_rows
        )

    def stored(self, *columns):
        return rows(self.spark.read.parquet(f"{self.path}/t"), *columns)

    def errors(self, *columns):
        return rows(self.spark.read.parquet(f"{self.path}/e"), *columns)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_restart_and_replay_add_nothing(topic):
    topic.send(*[record(i) for i in range(5)])
    assert topic.run() == 5
    topic.send(*[record(i) for i in range(3, 9)])
    assert topic.run() == 6  # continues after the first file
    assert topic.run() == 0
    before = topic.stored("event_id", "heart_rate")
    assert before == [(i, 70) for i in range(9)]
    assert topic.run("another") == 11  # a full replay
    assert topic.stored("event_id", "heart_rate") == before


def test_first_event_wins_within_a_batch_and_against_the_table(topic):
    topic.send(record(1, 2, 0, heart_rate=60), record(1, 0, 9, heart_rate=61), record(1, 0, 10, heart_rate=62))
    topic.run()
    topic.send(record(1, 0, 1, heart_rate=99))
    topic.run()
    assert topic.stored("event_id", "heart_rate", "partition", "offset") == [(1, 61, 0, 9)]


def test_a_crashed_batch_can_be_repeated(spark, tmp_path):
    """A batch of which a part was stored before the crash is completed without duplicates."""
    path = f"{tmp_path}/t"
    batch = ev.decode(spark.createDataFrame([record(i) for i in range(20)], RECORD))
    sinks.upsert_ignore(batch.where("event_id < 7"), path, span_size=4)
    for _ in range(2):
        sinks.upsert_ignore(batch, path, span_size=4)
    assert rows(spark.read.parquet(path), "event_id") == [(i,) for i in sorted(range(20), key=repr)]


def test_only_reached_spans_are_compared(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.upsert_ignore(ev.decode(spark.createDataFrame([record(i) for i in range(100)], RECORD)), path, 10)
    spans = {r[0] for r in spark.read.parquet(path).select(sinks.SPAN).distinct().collect()}
    assert spans == set(range(0, 100, 10))


def test_random_ids_meet_only_their_buckets(spark, tmp_path):
    """A batch of few ids prunes the table's buckets at run time, whatever the ids are."""
    path, rng = f"{tmp_path}/t", random.Random(3)
    ids = [rng.randrange(-(2**62), 2**62) for _ in range(400)]
    send = lambda some: ev.decode(spark.createDataFrame([record(i, 0, 1) for i in some], RECORD))
    sinks.upsert_ignore(send(ids[:300]), path, buckets=64)
    for _ in range(2):
        sinks.upsert_ignore(send(ids[200:] + ids[:3]), path, buckets=64)
        assert rows(spark.read.parquet(path), "event_id") == sorted(((i,) for i in ids), key=repr)
    few = send([ids[0], ids[1], 17])
    held = sinks.held_keys(spark.read.parquet(path), few, ["event_id"], sinks.bucket_of(["event_id"], 64))
    assert rows(held, "event_id") == sorted([(ids[0],), (ids[1],)], key=repr)
    plan = plan_of(held)
    assert "dynamicpruning" in plan and "ReadSchema: struct<event_id:bigint>" in plan
    scans = held._jdf.queryExecution().executedPlan().toString()
    assert scans.count("FileScan") == 1


def test_many_copies_of_one_event(spark, tmp_path):
    copies = spark.range(5000).select(
        F.lit("1").alias("key"),
        F.lit(record(1)[1]).alias("value"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.col("id").alias("offset"),
    )
    sinks.upsert_ignore(ev.decode(copies), f"{tmp_path}/t")
    assert rows(spark.read.parquet(f"{tmp_path}/t"), "event_id", "partition", "offset") == [(1, 0, 0)]


def test_bounded_run_stops_and_resumes(topic):
    for start in range(0, 12, 3):
        topic.send(*[record(i) for i in range(start, start + 3)])
    first = topic.run(max_rows=1, maxFilesPerTrigger="1")
    assert first == 3 and len(topic.stored("event_id")) == 3
    assert topic.run(max_rows=4, maxFilesPerTrigger="1") == 6
    assert len(topic.stored("event_id")) == 9
    topic.run(maxFilesPerTrigger="1")
    assert topic.stored("event_id") == [(i,) for i in sorted(range(12), key=repr)]


def test_bad_records_go_to_the_side_table(topic):
    topic.send(
        record(1),
        ("k", "{not json", 0, 100),
        ("k", None, 0, 101),
        ("k", json.dumps({"event_id": 5, "ts": 1.0}), 0, 102),
        record(2, offset=103, heart_rate="fast"),
    )
    topic.run()
    topic.run("again")
    assert topic.stored("event_id") == [(1,)]
    assert topic.errors("offset", "reason") == [
        (100, "not decodable"),
        (101, "no value"),
        (102, "missing field"),
        (103, "not decodable"),
    ]


def test_publish_and_decode_round_trip(spark):
    schema = "event_id bigint, user_id int, ts double, heart_rate int, steps_delta int, device string"
    sent = spark.createDataFrame([(1, 7, 1700000000.123456, 70, 3, "Apple"), (2, 8, 0.5, None, 0, None)], schema)
    records = ev.place(ev.to_records(sent), F.lit(5))
    assert rows(records, "key") == [("7",), ("8",)]
    assert rows(ev.decode(records).drop("partition", "offset")) == rows(sent)


def test_event_time_keeps_microseconds(spark):
    micros = [1704067207179575, 1704067432824425, 0, 999999]
    df = spark.createDataFrame([(m / 1e6,) for m in micros], "ts double")
    assert sorted(r[0] for r in df.select(F.unix_micros(ev.event_time("ts"))).collect()) == sorted(micros)


def test_partitions_keep_users_together(spark):
    users = spark.range(600).select(F.col("id").alias("user_id"), ev.partition_of("id").alias("partition"))
    twice = users.unionByName(users)
    assert ev.users_spanning(twice).isEmpty()
    assert [n for _, n, _ in rows(ev.partition_spread(users))] and len(rows(ev.partition_spread(users))) == 3
    torn = users.unionByName(users.limit(1).withColumn("partition", F.col("partition") + 1))
    assert ev.users_spanning(torn).count() == 1


@pytest.mark.parametrize("width", [2, 1000])
def test_offset_gaps(spark, width):
    offsets = [(0, 0), (0, 1), (0, 5), (0, 5), (0, 6), (1, 3), (1, 4)]
    df = spark.createDataFrame(offsets, "partition int, offset bigint")
    assert rows(ev.offset_gaps(df, width=width)) == [(0, 1, 5, 3, 1)]


def plain_gaps(data):
    seen = Counter((p, o) for p, o in data if o is not None)
    out = []
    for p in {p for p, _ in seen}:
        last = None
        for o in sorted(o for q, o in seen if q == p):
            missing, repeats = (0 if last is None else o - last - 1), seen[p, o] - 1
            if missing or repeats:
                out.append((p, last, o, missing, repeats))
            last = o
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, held", [(7, 50), (64, 10**6), (32_768, 300)])
def test_offset_gaps_equal_brute_force(spark, monkeypatch, width, held):
    """A full partition, a sparse one, many tiny ones, repeats within and over tasks, no partition."""
    monkeypatch.setattr(offsets, "HELD", held)
    rng = random.Random(width)
    data = [("full", o) for o in range(-40, 900) if o not in (5, 6, 500)]
    data += [("sparse", rng.randrange(10**9)) for _ in range(60)] + [("far", 2**62), ("far", -(2**61))]
    data += [(f"p{rng.randrange(200)}", rng.randrange(7)) for _ in range(500)]
    data += [(None, rng.randrange(30)) for _ in range(40)] + [("full", None), (None, None)]
    data += [rng.choice(data) for _ in range(200)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "owner string, at bigint").repartition(5)
    assert rows(ev.offset_gaps(df, "owner", "at", width)) == plain_gaps(data)
    assert ev.offset_gaps(df.limit(0), "owner", "at", width).isEmpty()


def test_offset_gaps_read_once_and_deal_out_no_offsets(spark, tmp_path):
    spark.range(200_000).selectExpr("cast(id % 3 as int) as partition", "id div 3 as offset").write.parquet(f"{tmp_path}/o")
    stored = spark.read.parquet(f"{tmp_path}/o")
    found = ev.offset_gaps(stored)
    assert found.isEmpty()
    plan = plan_of(found)
    assert plan.count("FileScan") == 1
    assert "hashpartitioning(partition" in plan and "offset" not in " ".join(
        line for line in plan.splitlines() if "hashpartitioning" in line
    )
    # A bitmap of 4 KB for a stretch and task: 200,000 rows become some tens.
    summed = offsets.summaries(stored, "partition", "offset", offsets.STRETCH)
    assert summed.count() <= 3 * 3 * stored.rdd.getNumPartitions()
    assert summed.where("bits is not null").count() > 0


def test_crash_after_storing_repeats_the_batch_without_duplicates(topic, monkeypatch):
    """The batch is stored but not recorded as done; the restarted run stores it again."""
    topic.send(*[record(i) for i in range(6)], ("k", "{", 0, 50))
    real, calls = sinks.store_errors, []

    def failing(batch, path, **options):
        real(batch, path, **options)
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "store_errors", failing)
    with pytest.raises(Exception, match="lost"):
        topic.run()
    assert topic.stored("event_id") == [(i,) for i in range(6)]
    topic.run()
    assert len(calls) == 2  # the same batch, from the same checkpoint
    assert topic.stored("event_id") == [(i,) for i in range(6)]
    assert topic.errors("offset") == [(50,)]
