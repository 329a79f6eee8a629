"""State, versions, shards, resources, write ids and vacuum."""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_streaming import BY_NAME, COPY, MESSAGE, append, copy_stream, drain, seqs
from topicstream import (
    FieldDef,
    TopicDef,
    add_producer,
    alter_topic,
    append_topic,
    create_topic,
    decode_record,
    map_rows,
    number_batches,
    open_topic,
    prepare_records,
    read_gauges,
    read_topic,
    read_topic_batch,
    start_gauges,
    storage,
    topic_versions,
    vacuum_topic,
    write_topic,
)

UTC = dt.timezone.utc


def written(stream, path, checkpoint):
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# Batches of a stream


def test_batches_of_a_stream_go_on_over_triggers_and_restarts(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, max_records_per_file=40)
    for first, last in ((0, 130), (130, 131), (131, 400)):
        append(spark, source, first, last)
        stream = read_topic(spark, source).select("seq", "shard_id", F.lit("x").alias("note"))
        written(number_batches(stream, 7), f"{root}/out", f"{root}/c")
    found = spark.read.schema("seq long, shard_id string, note string, batch_no long").parquet(f"{root}/out")
    by_shard = {}
    for r in found.orderBy("seq").collect():
        by_shard.setdefault(r.shard_id, []).append((r.seq, r.batch_no))
        assert r.note == "x"
    assert sorted(s for rows in by_shard.values() for s, _ in rows) == list(range(400))
    for rows in by_shard.values():
        assert [b for _, b in rows] == [i // 7 for i in range(len(rows))]


@pytest.mark.parametrize("again", ["same trigger", "later trigger"])
def test_an_order_that_repeats_or_goes_back_fails_the_stream(spark, root, again):
    source = create_topic(spark, root, "p", MESSAGE)
    append(spark, source, 5, 30)
    if again == "later trigger":
        written(number_batches(read_topic(spark, source).select("seq", "shard_id")), f"{root}/out", f"{root}/c")
        append(spark, source, 0, 6)
    else:
        append(spark, source, 5, 6)
    with pytest.raises(Exception, match="repeats or goes back"):
        written(number_batches(read_topic(spark, source).select("seq", "shard_id")), f"{root}/out", f"{root}/c")


def test_number_batches_checks_what_it_is_given(spark, root):
    stream = read_topic(spark, create_topic(spark, root, "p", MESSAGE))
    for bad, match in ((lambda: number_batches(spark.range(3)), "stream"), (lambda: number_batches(stream, 0), "positive"),
                       (lambda: number_batches(stream, order_by="no"), "no column")):
        with pytest.raises(ValueError, match=match):
            bad()


# Gauges


def test_gauges_by_shard_follow_a_stream(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    for first, last in ((0, 100), (100, 130), (130, 131)):
        append(spark, source, first, last)
        start_gauges(read_topic(spark, source), f"{root}/g", checkpoint=f"{root}/c", order_by="seq", available_now=True).awaitTermination()
        as_of = F.timestamp_millis(F.lit(4_000_000_000_000))
        found = {r.shard_id: (r.records, r.delay) for r in read_gauges(spark, f"{root}/g", as_of).collect()}
        counted = read_topic_batch(spark, source).groupBy("shard_id").agg(
            F.count("*"), 4_000_000_000_000 - F.max_by(F.unix_millis("system_time"), "seq")
        )
        assert found == {s: (n, d) for s, n, d in counted.collect()}


# Versions of a topic


def test_records_keep_the_columns_they_were_written_with(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 10)
    more = TopicDef("tp", 4, "", (*MESSAGE.fields, FieldDef("age", "BIGINT")))
    new = alter_topic(spark, source, more)
    assert open_topic(spark, root, "p", "tp") == new
    assert [v.fieldNames() for v in topic_versions(spark, new)] == [
        ["seq", "name", "event_time"],
        ["seq", "name", "age", "event_time"],
    ]
    rows = spark.range(10, 20).selectExpr("id as seq", "concat('k', id) as name", "id * 2 as age")
    append_topic(prepare_records(rows, new, BY_NAME), new)
    # A job that opened the topic before goes on.
    append(spark, source, 20, 25)
    expected = [(i, i * 2 if 10 <= i < 20 else None) for i in range(25)]
    batch = decode_record(read_topic_batch(spark, new), more).select("seq", "age")
    assert sorted(map(tuple, batch.collect())) == expected
    written(read_topic(spark, new).select("seq", "age"), f"{root}/out", f"{root}/c")
    assert sorted(map(tuple, spark.read.parquet(f"{root}/out").collect())) == expected
    assert seqs(spark, source) == list(range(25))
    # A stream goes on under its subscription with the new columns.
    drain(copy_stream(spark, source, sink), sink, f"{root}/sub")
    append(spark, source, 25, 30)
    drain(copy_stream(spark, new, sink), sink, f"{root}/sub")
    assert seqs(spark, sink) == list(range(30))
    # A column that is gone is not read, and comes back with its type only.
    fewer = alter_topic(spark, new, MESSAGE)
    assert "age" not in read_topic_batch(spark, fewer).columns
    with pytest.raises(ValueError, match="keep their types"):
        alter_topic(spark, fewer, TopicDef("tp", 4, "", (*MESSAGE.fields, FieldDef("age", "STRING"))))
    assert alter_topic(spark, fewer, more).schema == new.schema


def test_files_with_narrower_numbers_are_read(spark, root):
    """Another writer's 32-bit column is read as the topic's 64-bit one, in batch and as a stream."""
    source = create_topic(spark, root, "p", MESSAGE)
    append(spark, source, 0, 5)
    folder = f"{source.producer_path('main')}/arrival_date=2024-01-01/shard_id=1"
    spark.range(5, 8).selectExpr("cast(id as int) as seq").write.parquet(folder)
    assert seqs(spark, source) == list(range(8))
    written(read_topic(spark, source).select("seq"), f"{root}/out", f"{root}/c")
    assert sorted(r.seq for r in spark.read.parquet(f"{root}/out").collect()) == list(range(8))


@pytest.mark.parametrize("changed", [dict(name="other"), dict(shard_num=5), dict(fields=(FieldDef("shard_id", "STRING"),))])
def test_alter_topic_refuses(spark, root, changed):
    source = create_topic(spark, root, "p", MESSAGE)
    wrong = TopicDef(**({"name": "tp", "shard_num": 4, "comment": "", "fields": MESSAGE.fields} | changed))
    with pytest.raises(ValueError):
        alter_topic(spark, source, wrong)


def test_two_jobs_that_add_at_a_time_do_not_both_get_a_number(spark, root, monkeypatch):
    source = create_topic(spark, root, "p", MESSAGE)
    add_producer(spark, source, "first")
    real = storage.list_names
    monkeypatch.setattr(storage, "list_names", lambda s, p: real(s, p)[:-1] if p.endswith("producers") else real(s, p))
    with pytest.raises(Exception, match="exists"):
        add_producer(spark, source, "second")
    monkeypatch.undo()
    assert open_topic(spark, root, "p", "tp").producers == ("main", "first")


# Streams of some shards


def test_a_stream_of_shards_lists_no_others(spark, root):
    source = create_topic(spark, root, "p", MESSAGE, producers=("a", "b"))
    append(spark, source, 0, 300, "a")
    query = written(read_topic(spark, source, shards=["1", "2"]).select("seq", "shard_id"), f"{root}/out", f"{root}/c")
    expected = read_topic_batch(spark, source, shards=["1", "2"]).count()
    assert sum(p["numInputRows"] for p in query.recentProgress) == expected < 300
    seen = "".join(p.read_text() for p in Path(f"{root}/c/sources").rglob("*") if p.is_file() and p.name[0] != ".")
    assert "shard_id=1" in seen and "shard_id=0" not in seen and "shard_id=3" not in seen
    append(spark, source, 300, 340, "b")
    written(read_topic(spark, source, shards=["1", "2"]).select("seq", "shard_id"), f"{root}/out", f"{root}/c")
    found = spark.read.schema("seq long, shard_id string").parquet(f"{root}/out")
    both = read_topic_batch(spark, source, shards=["1", "2"]).select("seq", "shard_id")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, both.collect()))


# Row maps with a resource


def mapped_with_resource(spark, root, fail):
    log = Path(root)
    log.mkdir(parents=True)

    def note(what):
        from pyspark import TaskContext

        task = TaskContext.get()
        (log / f"{what}-{task.partitionId()}-{task.attemptNumber()}-{time.time_ns()}").touch()

    def opened():
        note("open")
        return 100

    def change(factor, batch):
        if fail:
            raise RuntimeError("broken")
        return batch.assign(id=batch["id"] * factor)

    df = spark.range(0, 60, 1, 1 if fail else 3)  # of several failing tasks, Spark kills those that it no longer needs
    return map_rows(df, change, "id long", open=opened, close=lambda factor: note("close")), log


def test_a_task_opens_and_closes_once(spark, root):
    df, log = mapped_with_resource(spark, root, False)
    assert sorted(r.id for r in df.collect()) == [i * 100 for i in range(60)]
    assert sorted(p.name.rsplit("-", 1)[0] for p in log.iterdir()) == sorted(f"{w}-{t}-0" for w in ("open", "close") for t in range(3))


def test_a_failed_task_closes_too(spark, root):
    df, log = mapped_with_resource(spark, root, True)
    with pytest.raises(Exception, match="broken"):
        df.collect()
    names = [p.name.rsplit("-", 1)[0] for p in log.iterdir()]
    opened = sorted(n.removeprefix("open-") for n in names if n.startswith("open"))
    assert opened and opened == sorted(n.removeprefix("close-") for n in names if n.startswith("close"))


def test_a_resource_is_for_batches(spark):
    with pytest.raises(ValueError, match="schema"):
        map_rows(spark.range(1), lambda df: df, open=list)
    with pytest.raises(ValueError, match="open makes"):
        map_rows(spark.range(1), lambda df: df, "id long", close=list)


# Writes with an id


def records_of(spark, topic, start, end):
    rows = spark.range(start, end).selectExpr("id as seq", "concat('k', id) as name")
    return prepare_records(rows, topic, BY_NAME)


def test_a_write_with_an_id_is_there_once(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    for _ in range(2):
        append_topic(records_of(spark, source, 0, 100), source, write_id="one")
    append_topic(records_of(spark, source, 100, 150), source, write_id="two")
    append(spark, source, 150, 160)
    assert seqs(spark, source) == list(range(160))


@pytest.mark.parametrize("at", ["mark", "first move", "third move", "done"])
def test_a_write_that_was_cut_off_is_finished_by_the_next_try(spark, root, monkeypatch, at):
    source = create_topic(spark, root, "p", MESSAGE)
    real_text, real_move, moves = storage.create_text, storage.move, []

    def text(s, path, content):
        if (at, path.rsplit("/", 1)[1]) in (("mark", "whole"), ("done", "done")):
            raise ConnectionError("cut off")
        real_text(s, path, content)

    def move(s, a, b):
        moves.append(b)
        if len(moves) == {"first move": 1, "third move": 3}.get(at):
            raise ConnectionError("cut off")
        real_move(s, a, b)

    monkeypatch.setattr(storage, "create_text", text)
    monkeypatch.setattr(storage, "move", move)
    with pytest.raises(ConnectionError):
        append_topic(records_of(spark, source, 0, 100), source, write_id="one")
    monkeypatch.undo()
    for _ in range(2):
        append_topic(records_of(spark, source, 0, 100), source, write_id="one")
    assert seqs(spark, source) == list(range(100))


def test_ids_of_writes_are_names(spark, root):
    source = create_topic(spark, root, "p", MESSAGE)
    for bad in ("", " ", "a/b", "_a", "x=1"):
        with pytest.raises(ValueError, match="id of a write"):
            append_topic(records_of(spark, source, 0, 1), source, write_id=bad)


# Topics without an event time


def test_writers_need_an_event_time(spark, root):
    plain = create_topic(spark, root, "p", MESSAGE, need_event_time=False)
    timed = create_topic(spark, root, "q", MESSAGE)
    given = records_of(spark, timed, 0, 3).drop("event_time")
    with pytest.raises(ValueError, match="no event_time"):
        append_topic(given, plain)
    append(spark, timed, 0, 3)
    with pytest.raises(ValueError, match="no event_time"):
        write_topic(read_topic(spark, timed).drop("event_time"), plain, checkpoint=f"{root}/c")


# Vacuum


def files_of(topic):
    return {p.relative_to(topic.producer_path("main")).as_posix() for p in Path(topic.producer_path("main")).rglob("*.parquet")}


def age_log(topic, days):
    """Make all that the commit log names, and all files, as old as that."""
    folder = Path(topic.producer_path("main"))
    past = time.time() - days * 86400
    for log in (folder / "_spark_metadata").iterdir():
        if log.name.split(".")[0].isdigit():
            head, *lines = log.read_text().splitlines()
            entries = [json.loads(line) | {"modificationTime": int(past * 1000)} for line in lines]
            log.write_text("\n".join([head, *map(json.dumps, entries)]))
            log.with_name(f".{log.name}.crc").unlink(missing_ok=True)
            os.utime(log, (past, past))
    for file in folder.rglob("*.parquet"):
        os.utime(file, (past, past))


def test_files_that_a_stream_dropped_are_deleted_after_a_time(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    interval = "spark.sql.streaming.fileSink.log.compactInterval"
    spark.conf.set(interval, "2")
    try:
        for i in range(6):
            if i == 3:
                age_log(sink, 10)
                old = files_of(sink)
                stray = next(Path(sink.producer_path("main")).rglob("*.parquet"))
                stray.with_name("part-stray.parquet").write_bytes(stray.read_bytes())
                os.utime(stray.with_name("part-stray.parquet"), (time.time() - 864000,) * 2)
            append(spark, source, 50 * i, 50 * i + 50)
            drain(copy_stream(spark, source, sink), sink, f"{root}/c", expire=True)
        assert seqs(spark, sink) == list(range(150, 300))
        now = dt.datetime.now(UTC)
        reader = read_topic_batch(spark, sink)
        # The log named them a moment ago: a reader may still hold them. A failed trigger's file nobody ever named.
        (gone,) = vacuum_topic(spark, sink, now)
        assert gone.endswith("part-stray.parquet") and old <= files_of(sink)
        later = now + dt.timedelta(days=1, minutes=1)
        for log in (Path(sink.producer_path("main")) / "_spark_metadata").iterdir():
            os.utime(log)
        dropped = vacuum_topic(spark, sink, later)
        assert {"/".join(p.split("/")[-3:]) for p in dropped} == old
        assert sorted(r.seq for r in reader.collect()) == seqs(spark, sink) == list(range(150, 300))
        assert vacuum_topic(spark, sink, later) == []
        append(spark, source, 300, 310)
        drain(copy_stream(spark, source, sink), sink, f"{root}/c", expire=True)
        assert seqs(spark, sink) == list(range(150, 310))
    finally:
        spark.conf.unset(interval)


def test_vacuum_leaves_young_files_and_bounded_producers(spark, root):
    source, sink = create_topic(spark, root, "p", MESSAGE), create_topic(spark, root, "p", COPY)
    append(spark, source, 0, 50)
    drain(copy_stream(spark, source, sink), sink, f"{root}/c")
    young = next(Path(sink.producer_path("main")).rglob("*.parquet"))
    young.with_name("part-running.parquet").write_bytes(young.read_bytes())
    assert vacuum_topic(spark, sink, dt.datetime.now(UTC)) == []
    assert vacuum_topic(spark, source, dt.datetime.now(UTC) + dt.timedelta(days=900)) == []
    (gone,) = vacuum_topic(spark, sink, dt.datetime.now(UTC) + dt.timedelta(days=2))
    assert gone.endswith("part-running.parquet")
    assert seqs(spark, sink) == list(range(50))
