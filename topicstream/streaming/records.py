"""Topic scan whose triggers admit an exact number of records.

Spark's file source admits whole files. This source's read position is a place inside a file, so a trigger ends where the
allowed number of records is reached, be it in the middle of a file. Files get numbers in the order in which the source
finds them, kept in a log beside the subscription's checkpoint; an offset is (number of the file, row in it).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from topicstream import storage
from topicstream.options import COMMIT_INTERVAL_SECONDS
from topicstream.schema import ARRIVAL_DATE, SHARD_ID
from topicstream.sources.bounded import wanted_shards
from topicstream.sources.topics import Topic
from topicstream.streaming.source import records_per_trigger

FORMAT = "topic_records"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of a null
_COMPACT_EVERY = 32
_FOOTERS_AT_ONCE = 32
_ROWS_OF_A_TASK = 1 << 17
_BATCH_ROWS = 1 << 13


def read_topic_records(
    spark: SparkSession,
    topic: Topic,
    subscription: str,
    *,
    rate: int,
    interval_seconds: float = COMMIT_INTERVAL_SECONDS,
    slots: int | None = None,
    shards: Iterable[str] | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """A topic's records as a stream of which no trigger reads more than ``rate`` records per second and task slot.

    Give the query that writes the result the checkpoint ``topic.subscription_path(subscription)``: the files' numbers are
    kept in there, too. ``interval_seconds`` and ``slots`` are as in :func:`topicstream.read_topic`. Only folders of the
    given ``shards`` are listed, and only ``columns`` are read. A run with ``availableNow`` is one trigger of such
    a source; :func:`drain` reads on until nothing is left.

    The file system must be one that Arrow reaches (local, HDFS and the usual object stores).
    """
    spark.dataSource.register(TopicRecords)
    schema = topic.record_schema
    if columns is not None:
        schema = T.StructType([schema[c] for c in columns])
    wanted = None if shards is None else wanted_shards(topic, shards)
    return (
        spark.readStream.format(FORMAT)
        .schema(schema)
        .option("folders", json.dumps([topic.producer_path(p) for p in topic.producers]))
        .option("shards", json.dumps(wanted))
        .option("log", storage.join(topic.subscription_path(subscription), "files"))
        .option("records", max(1, records_per_trigger(spark, rate, interval_seconds, slots)))
        .load()
    )


def drain(query: StreamingQuery) -> None:
    """Let a running query read all there is now, then stop it; raises what it fails with."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


class TopicRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError(f"{FORMAT} needs the topic's schema; use read_topic_records")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Reader(self.options, schema)


class _Slice(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self._schema, self._cap = schema, int(options["records"])
        self._folders, self._shards = json.loads(options["folders"]), json.loads(options["shards"])
        self._log_path = options["log"]
        self._log: _FileLog | None = None
        self._position: list[int] | None = None
        self._groups: dict[int, list[int]] = {}  # rows of the row groups of files about to be read

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def latestOffset(self) -> dict:
        # A query that goes on plans its last trigger again before it asks for more, which tells where it is.
        at, row = self._position or (0, 0)
        left = self._cap
        log = self._files()
        log.extend(_found(self._folders, self._shards), at)
        while left and at < len(log.paths):
            rows = sum(self._rows(at))
            taken = min(left, rows - row)
            left, row = left - taken, row + taken
            if row < rows:
                break
            at, row = at + 1, 0
        self._position = [at, row]
        return {"file": at, "row": row}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self._position is None:
            self._position = [end["file"], end["row"]]
        parts = []
        log = self._files()
        for at in range(start["file"], end["file"] + 1):
            first = start["row"] if at == start["file"] else 0
            if at == end["file"] and first >= end["row"]:
                continue
            groups = self._rows(at)
            last = end["row"] if at == end["file"] else sum(groups)
            # A task reads whole row groups where it can, as a part of one costs as much as all of it.
            begin, seen = first, 0
            for rows in groups:
                seen += rows
                if begin < seen and (seen - begin >= _ROWS_OF_A_TASK or seen >= last):
                    parts.append(_Slice(log.paths[at], begin, min(seen, last)))
                    begin = seen
                if seen >= last:
                    break
        return parts

    def commit(self, end: dict) -> None:
        for at in [n for n in self._groups if n < end["file"]]:
            del self._groups[at]

    def read(self, partition: _Slice) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        target = pa.schema([(f.name, _arrow_type(f.dataType, pa)) for f in self._schema])
        levels = dict(part.split("=", 1) for part in partition.path.split("/")[:-1] if "=" in part)
        given = {name: unquote(value) for name, value in levels.items() if value != _NO_VALUE}
        fs, path = _located(partition.path)
        with fs.open_input_file(path) as file:
            parquet = pq.ParquetFile(file)
            names = [n for n in target.names if n in parquet.schema_arrow.names]
            seen = 0
            for group in range(parquet.num_row_groups):
                rows = parquet.metadata.row_group(group).num_rows
                if seen + rows > partition.start and seen < partition.end:
                    at = seen
                    for batch in parquet.iter_batches(_BATCH_ROWS, row_groups=[group], columns=names or None):
                        low, high = max(partition.start - at, 0), min(partition.end - at, batch.num_rows)
                        at += batch.num_rows
                        if low < high:
                            yield _conformed(batch.slice(low, high - low), target, given, pa)
                seen += rows

    def _files(self) -> _FileLog:
        if self._log is None:
            self._log = _FileLog(self._log_path)
        return self._log

    def _rows(self, at: int) -> list[int]:
        """Rows of each row group of a file; some footers after it are read at the same time."""
        if at not in self._groups:
            paths = self._files().paths
            numbers = [n for n in range(at, min(at + _FOOTERS_AT_ONCE, len(paths))) if n not in self._groups]
            with ThreadPoolExecutor(len(numbers)) as pool:
                self._groups |= zip(numbers, pool.map(_row_groups, [paths[n] for n in numbers]))
        return self._groups[at]


class _FileLog:
    """The files in the order of their numbers: lists of new ones, joined to one list now and then."""

    def __init__(self, path: str):
        self._fs, self._path = _located(path)
        self._fs.create_dir(self._path, recursive=True)
        self.paths: list[str] = []
        self._entries = 0
        names = sorted(info.base_name for info in self._listed() if info.base_name.endswith(".json"))
        joined = [n for n in names if n.endswith(".all.json")]
        # A list of all files holds those of every entry up to its own number.
        for name in joined[-1:] + [n for n in names if not joined or n.split(".")[0] > joined[-1].split(".")[0]]:
            with self._fs.open_input_file(f"{self._path}/{name}") as file:
                self.paths += json.loads(file.read())
            self._entries = int(name.split(".")[0]) + 1
        self._seen = set(self.paths)

    def extend(self, found: list[str], position: int) -> None:
        new = [path for path in found if path not in self._seen]
        if not new:
            return
        self.paths += new
        self._seen.update(new)
        number = f"{self._entries:012d}"
        self._entries += 1
        if self._entries % _COMPACT_EVERY:
            self._write(f"{number}.json", new)
            return
        old = [info.path for info in self._listed()]
        self._write(f"{number}.all.json", self.paths)
        for path in old:
            self._fs.delete_file(path)

    def _listed(self) -> list:
        from pyarrow.fs import FileSelector, FileType

        return [info for info in self._fs.get_file_info(FileSelector(self._path)) if info.type == FileType.File]

    def _write(self, name: str, paths: list[str]) -> None:
        # Under another name first: a list is there whole or not at all.
        with self._fs.open_output_stream(f"{self._path}/{name}.part") as out:
            out.write(json.dumps(paths).encode())
        self._fs.move(f"{self._path}/{name}.part", f"{self._path}/{name}")


def _found(folders: list[str], shards: list[str] | None) -> list[str]:
    """Data files of the producers, oldest first: of a streamed producer the committed ones."""
    from pyarrow.fs import FileSelector, FileType

    files = []
    for folder in folders:
        fs, path = _located(folder)
        committed = _committed(fs, path)
        if committed is not None:
            files += [(when, p) for when, p in committed if shards is None or _shard_of(p) in shards]
            continue
        if shards is None:
            selected = [FileSelector(path, recursive=True, allow_not_found=True)]
        else:
            days = fs.get_file_info(FileSelector(path, allow_not_found=True))
            selected = [
                FileSelector(f"{day.path}/{SHARD_ID}={shard}", allow_not_found=True)
                for day in days
                if day.type == FileType.Directory and day.base_name.startswith(f"{ARRIVAL_DATE}=")
                for shard in shards
            ]
        prefix = folder.rstrip("/").removesuffix(path.rstrip("/"))
        for selector in selected:
            for info in fs.get_file_info(selector):
                inner = info.path.removeprefix(path).split("/")
                if info.type == FileType.File and not any(part[:1] in ("_", ".") for part in inner):
                    files.append((info.mtime_ns or 0, prefix + info.path))
    return [path for _, path in sorted(files)]


def _committed(fs, folder: str) -> list[tuple[int, str]] | None:
    """Files of a streaming sink's commit log with their times; None for a folder without one."""
    from pyarrow.fs import FileSelector

    entries = fs.get_file_info(FileSelector(f"{folder}/_spark_metadata", allow_not_found=True))
    names = {info.base_name: info.path for info in entries if info.base_name.split(".")[0].isdigit()}
    if not names:
        return None
    found = []
    for name in live_entries(names):
        with fs.open_input_file(names[name]) as file:
            found += [(entry["modificationTime"] * 1_000_000, unquote_path(entry["path"])) for entry in log_entries(file.read().decode())]
    return found


def live_entries(names: Iterable[str]) -> list[str]:
    """Of the files of a sink's commit log, those that hold what is committed: the last joined one and all after it."""
    by_number = sorted((int(name.split(".")[0]), not name.endswith(".compact"), name) for name in names)
    joined = [number for number, plain, _ in by_number if not plain]
    start = joined[-1] if joined else -1
    return [name for number, plain, name in by_number if number > start or (number == start and not plain)]


def log_entries(text: str) -> list[dict]:
    """Entries of one file of a commit log: a version, then a line of JSON for each file."""
    return [entry for entry in map(json.loads, text.splitlines()[1:]) if entry.get("action") != "delete"]


def unquote_path(uri: str) -> str:
    return unquote(uri) if "%" in uri and urlsplit(uri).scheme else uri


def _shard_of(path: str) -> str | None:
    return next((unquote(part.partition("=")[2]) for part in path.split("/") if part.startswith(f"{SHARD_ID}=")), None)


def _located(path: str):
    """A path's file system and its path there."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    scheme = urlsplit(path).scheme
    if not scheme or scheme == "file":
        return LocalFileSystem(), urlsplit(path).path if scheme else path
    return FileSystem.from_uri(path)


def _row_groups(path: str) -> list[int]:
    import pyarrow.parquet as pq

    fs, inner = _located(path)
    with fs.open_input_file(inner) as file:
        footer = pq.ParquetFile(file).metadata
        return [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]


def _arrow_type(kind: T.DataType, pa):
    """The Arrow type of a column that a record can have."""
    if isinstance(kind, T.MapType):
        return pa.map_(_arrow_type(kind.keyType, pa), _arrow_type(kind.valueType, pa))
    known = {
        T.StringType(): pa.string(),
        T.LongType(): pa.int64(),
        T.DoubleType(): pa.float64(),
        T.TimestampType(): pa.timestamp("us", "UTC"),
        T.DateType(): pa.date32(),
    }
    return known[kind]


def _conformed(batch, target, given: dict[str, str | None], pa):
    """A batch in the topic's columns and types: columns of its file by name, folder levels, nulls for the rest."""
    columns = []
    for field in target:
        if field.name in batch.schema.names:
            columns.append(batch.column(field.name).cast(field.type))
        elif given.get(field.name) is not None:
            value = pa.array([given[field.name]]).cast(field.type)[0]
            columns.append(pa.repeat(value, batch.num_rows))
        else:
            columns.append(pa.nulls(batch.num_rows, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=target)
