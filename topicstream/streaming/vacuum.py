"""Deleting what streaming sinks no longer name."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession

from topicstream import storage
from topicstream.sources.topics import Topic
from topicstream.streaming.records import live_entries, log_entries

DEFAULT_GRACE = dt.timedelta(days=1)


def vacuum_topic(spark: SparkSession, topic: Topic, as_of: dt.datetime, grace: dt.timedelta = DEFAULT_GRACE) -> list[str]:
    """Delete files of streamed producers that no commit has named for ``grace`` up to ``as_of``, and return their paths.

    Those are files that ``write_topic(expire=True)`` took out of the commit log as older than the topic's lifecycle, and
    files that a failed trigger left. A file stays while it is younger than ``grace``, so a trigger that runs now keeps what it
    is to commit; and it stays while the log named it at any time in the last ``grace``, so a reader that listed the topic
    since then still finds it. Make ``grace`` longer than any trigger and any query over the topic. Bounded
    producers are those of :func:`topicstream.drop_expired`.

    A producer's log and the names of its files go through the driver, as they do for the sink and for every reader of it.
    """
    instant = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    until = int((instant - grace).timestamp() * 1000)
    dropped = []
    for producer in topic.producers:
        if not storage.exists(spark, topic.claim_path(producer)):
            continue
        folder = topic.producer_path(producer)
        kept = _named_since(spark, storage.join(folder, "_spark_metadata"), until)
        for name, changed in list(storage.file_times(spark, folder)):
            hidden = any(part[0] in "._" for part in name.split("/"))
            if hidden or changed > until or _key(name) in kept:
                continue
            dropped.append(storage.join(folder, name))
            storage.delete(spark, dropped[-1])
    return dropped


def _named_since(spark: SparkSession, log: str, until: int) -> set[str]:
    """Files that the log named at ``until`` (epoch ms) or later."""
    times = {name: at for name, at in storage.file_times(spark, log) if name.split(".")[0].isdigit()}
    # The log as it was then: its last joined list of that time, and all lists after it, joined ones of later included.
    old = [name for name, at in times.items() if at <= until]
    joined = [name for name in live_entries(old) if name.endswith(".compact")]
    first = int(joined[0].split(".")[0]) if joined else -1
    wanted = [name for name in times if int(name.split(".")[0]) > first] + joined
    found: set[str] = set()
    for name in wanted:
        text = storage.read_text(spark, storage.join(log, name))
        found.update(_key(unquote(urlsplit(entry["path"]).path)) for entry in log_entries(text or ""))
    return found


def _key(path: str) -> str:
    """A file's path below its producer: day, shard and name."""
    return "/".join(path.split("/")[-3:])
