"""A log of messages with offsets, as a Spark data source for batches and streams.

A log is a folder of partitions, a partition a folder of Parquet segments named
by the offset of their first message. Offsets of a partition never change and
only its oldest segments expire, so a stream can say how far it has read, be
capped, be restarted, and notice what it has missed.

    spark.dataSource.register(MessageLog)
    spark.readStream.format("message_log").option("path", path).load()

Options for reading: `startingOffsets` (earliest, latest), `failOnDataLoss`
(true: expired offsets end the query), `maxOffsetsPerTrigger` (messages a
batch, needs `group`, under whose name the log notes how far batches were
handed out), `rowsPerTask`. For writing: `partitions`, and `stream`, the name
under which a stream's batches are noted so that a repeated one is not sent
twice. A log has one writer at a time. Paths are those of `pyarrow.fs`: local
folders, `file://`, `hdfs://`, `s3://`, `gs://`.
"""

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = "value string, partition int, offset long"
ROWS_PER_TASK = 250_000
SEGMENT_ROWS = 1_000_000
DIGITS = 20  # segments sort by name as by offset


class Log:
    """The files of a log."""

    def __init__(self, path):
        self.fs, self.root = pafs.FileSystem.from_uri(path)

    def segments(self):
        """{partition: [(first offset, file)]}, each in order."""
        found = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            folder, _, name = info.path[len(self.root) :].strip("/").rpartition("/")
            if info.type == pafs.FileType.File and folder.startswith("partition=") and name.endswith(".parquet"):
                found.setdefault(int(folder[10:]), []).append((int(name[:-8]), info.path))
        return {p: sorted(files) for p, files in sorted(found.items())}

    def rows(self, file):
        with self.fs.open_input_file(file) as source:
            return pq.ParquetFile(source).metadata.num_rows

    def bounds(self, segments=None):
        """{partition: (first offset that is left, offset after the last)}."""
        segments = self.segments() if segments is None else segments
        return {p: (s[0][0], s[-1][0] + self.rows(s[-1][1])) for p, s in segments.items()}

    def segment_path(self, partition, offset):
        return f"{self.root}/partition={partition:05d}/{offset:0{DIGITS}d}.parquet"

    def note(self, name):
        """A small JSON file of the log, or None."""
        path = f"{self.root}/{name}.json"
        if self.fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(path) as source:
            return json.loads(source.read())

    def write_note(self, name, value):
        """Replace the file in one move, so that no reader finds a part of it."""
        path, new = f"{self.root}/{name}.json", f"{self.root}/{name}.json.{uuid.uuid4().hex}"
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        with self.fs.open_output_stream(new) as out:
            out.write(json.dumps(value).encode())
        self.fs.move(new, path)

    def remove(self, folder):
        if self.fs.get_file_info(folder).type == pafs.FileType.Directory:
            self.fs.delete_dir(folder)


def expire(path, partition, before):
    """Remove the segments of a partition that lie wholly below the offset `before`; the last one stays."""
    log = Log(path)
    files = log.segments().get(partition, [])
    for (_, file), (following, _) in zip(files, files[1:]):
        if following <= before:
            log.fs.delete_file(file)


# --- reading -----------------------------------------------------------------------


@dataclass
class Span(InputPartition):
    """Rows `first` to `last` (left out) of a segment."""

    file: str
    partition: int
    offset: int  # of the segment's first message
    first: int
    last: int


def spans(log, start, end, rows_per_task, fail_on_loss):
    """The spans of segments between two offset tables."""
    out, segments = [], log.segments()
    for name, high in end.items():
        files, partition = segments.get(int(name), []), int(name)
        low = start.get(name, 0)
        if low >= high:
            continue
        left = files[0][0] if files else high
        if low < left:
            if fail_on_loss and (name in start or left > 0):
                raise ValueError(f"messages {low} to {left - 1} of partition {partition} have expired")
            low = left
        following = [offset for offset, _ in files[1:]] + [high]
        for (offset, file), after in zip(files, following):
            a, b = max(low, offset), min(high, after)
            for at in range(a, b, rows_per_task):
                out.append(Span(file, partition, offset, at - offset, min(b, at + rows_per_task) - offset))
    return out


def read_span(path, span):
    """Record batches of a span; row groups outside of it are not read."""
    with Log(path).fs.open_input_file(span.file) as source:
        file, at = pq.ParquetFile(source), 0
        for group in range(file.num_row_groups):
            size = file.metadata.row_group(group).num_rows
            if at < span.last and at + size > span.first:
                done = at
                for batch in file.iter_batches(row_groups=[group], columns=["value"]):
                    low, high = max(span.first - done, 0), min(span.last - done, len(batch))
                    if low < high:
                        value = batch.column(0).slice(low, high - low)
                        offsets = range(span.offset + done + low, span.offset + done + high)
                        yield pa.RecordBatch.from_arrays(
                            [
                                value.cast(pa.string()),
                                pa.array([span.partition] * len(value), pa.int32()),
                                pa.array(offsets, pa.int64()),
                            ],
                            ["value", "partition", "offset"],
                        )
                    done += len(batch)
            at += size


def capped(start, bounds, cap):
    """Offsets at most `cap` messages after `start`, dealt by what is left in each partition."""
    ends = {str(p): end for p, (_, end) in bounds.items()}
    from_ = {str(p): max(start.get(str(p), 0), low) for p, (low, _) in bounds.items()}
    left = {p: max(0, end - from_[p]) for p, end in ends.items()}
    total = sum(left.values())
    if cap is None or total <= cap:
        return {**start, **ends}
    share = {p: cap * n // total for p, n in left.items()}
    for p in sorted(left, key=lambda p: (share[p] - cap * left[p] / total, p))[: cap - sum(share.values())]:
        share[p] += 1
    return {**start, **{p: from_[p] + share[p] for p in ends}}


class StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.log = Log(self.path)
        self.latest = options.get("startingOffsets", "earliest") == "latest"
        self.fail_on_loss = options.get("failOnDataLoss", "true").lower() == "true"
        self.rows_per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.cap = int(options["maxOffsetsPerTrigger"]) if "maxOffsetsPerTrigger" in options else None
        self.group = options.get("group")
        if self.cap is not None and (self.cap < 1 or not self.group):
            raise ValueError("maxOffsetsPerTrigger is at least 1 and needs a group")
        self.handed_out = None

    def initialOffset(self):
        bounds = self.log.bounds()
        start = {str(p): end if self.latest else low for p, (low, end) in bounds.items()}
        self._hand_out(start)
        return start

    def latestOffset(self):
        if self.handed_out is None and self.cap is not None:
            # A restarted query does not say where it is; the log's note is there or a batch ahead.
            self.handed_out = self.log.note(f"_groups/{self.group}") or {}
        end = capped(self.handed_out or {}, self.log.bounds(), self.cap)
        if end != self.handed_out:
            self._hand_out(end)
        return end

    def _hand_out(self, offsets):
        self.handed_out = offsets
        if self.cap is not None:
            self.log.write_note(f"_groups/{self.group}", offsets)

    def partitions(self, start, end):
        return spans(self.log, start, end, self.rows_per_task, self.fail_on_loss)

    def read(self, partition):
        return read_span(self.path, partition)

    def commit(self, end):
        pass


class BatchReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.rows_per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))

    def partitions(self):
        log = Log(self.path)
        bounds = log.bounds()
        start = {str(p): low for p, (low, _) in bounds.items()}
        end = {str(p): high for p, (_, high) in bounds.items()}
        return spans(log, start, end, self.rows_per_task, True) or [Span("", 0, 0, 0, 0)]

    def read(self, partition):
        return read_span(self.path, partition) if partition.file else iter(())


# --- writing -----------------------------------------------------------------------


@dataclass
class Staged(WriterCommitMessage):
    """Files a task has written beside the log: (file, rows), for one partition."""

    task: int
    files: list


class _Writer:
    """Tasks write beside the log; the driver moves whole files in, or removes them."""

    def __init__(self, options):
        self.path = options["path"]
        self.n_partitions = int(options.get("partitions", 1))
        self.name = options.get("stream")
        self.run = uuid.uuid4().hex

    def write(self, iterator):
        from pyspark import TaskContext

        log, files, schema = Log(self.path), [], pa.schema([("value", pa.string())])
        folder = f"{log.root}/_staged/{self.run}"
        log.fs.create_dir(folder, recursive=True)
        out, rows = None, 0
        for batch in iterator:
            if not len(batch):
                continue
            if out is None:
                files.append([f"{folder}/{uuid.uuid4().hex}.parquet", 0])
                out, rows = pq.ParquetWriter(files[-1][0], schema, filesystem=log.fs), 0
            out.write_batch(pa.RecordBatch.from_arrays([batch.column("value").cast(pa.string())], schema=schema))
            rows += len(batch)
            files[-1][1] = rows
            if rows >= SEGMENT_ROWS:
                out.close()
                out = None
        if out is not None:
            out.close()
        return Staged(TaskContext.get().partitionId(), files)

    def _commit(self, messages, number):
        log = Log(self.path)
        note = f"_commits/{number}"
        moves = log.note(note)
        if moves is None:
            ends = {p: end for p, (_, end) in log.bounds().items()}
            moves = []
            for message in sorted((m for m in messages if m is not None), key=lambda m: m.task):
                partition = message.task % self.n_partitions
                for file, rows in message.files:
                    moves.append([file, log.segment_path(partition, ends.get(partition, 0))])
                    ends[partition] = ends.get(partition, 0) + rows
            # Noted before the first move: a commit that broke off is finished, not done again.
            log.write_note(note, moves)
        for file, target in moves:
            if log.fs.get_file_info(file).type == pafs.FileType.File:
                log.fs.create_dir(target.rpartition("/")[0], recursive=True)
                log.fs.move(file, target)
        self._forget(log)

    def _forget(self, log):
        log.remove(f"{log.root}/_staged/{self.run}")


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages):
        self._commit(messages, f"batch-{self.run}")

    def abort(self, messages):
        self._forget(Log(self.path))


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def __init__(self, options):
        super().__init__(options)
        if not self.name:
            raise ValueError("a stream that writes to a log needs the option `stream`")

    def commit(self, messages, batchId):
        self._commit(messages, f"{self.name}/{batchId}")

    def abort(self, messages, batchId):
        self._forget(Log(self.path))


class MessageLog(DataSource):
    @classmethod
    def name(cls):
        return "message_log"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return BatchReader(self.options)

    def streamReader(self, schema):
        return StreamReader(self.options)

    def writer(self, schema, overwrite):
        return BatchWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return StreamWriter(self.options)


def register(spark):
    """Make the format known to the session."""
    spark.dataSource.register(MessageLog)


def append(messages, path, partitions=1):
    """Add messages (column `value`) to a log; the rows of a task stay together and in order."""
    register(messages.sparkSession)
    messages.select("value").write.format("message_log").mode("append").options(path=path, partitions=partitions).save()


def start_message_sink(messages, path, checkpoint, stream, partitions=1, trigger=None):
    """Send a stream of messages (column `value`) to a log, each batch once.

    A failed batch leaves nothing behind, a repeated one adds nothing. Batch
    numbers restart with a new checkpoint, so that needs a new stream name.
    """
    from echolex.sources.tables import path_exists

    spark = messages.sparkSession
    register(spark)
    log = Log(path)
    used = log.fs.get_file_info(f"{log.root}/_commits/{stream}").type != pafs.FileType.NotFound
    if used and not path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"stream {stream!r} has sent messages to {path}: new checkpoints need a new stream name")
    writer = messages.select("value").writeStream.format("message_log")
    writer = writer.options(path=path, partitions=partitions, stream=stream, checkpointLocation=checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()
