"""K4 as a Spark data source: a streaming sink that publishes a batch's bodies at once.

``df.writeStream.format("label_load")`` takes (shard, n_rows, body) rows.  Each task
stages its bodies in a file of its own; the commit publishes them by one small
manifest, ``<path>/published/batch=<id>.json``, which names the staged files in
order.  A body's label, ``<table>-<batch>-<shard>-<file's number>-<place in file>``,
exists only through the manifest, so it belongs to one body for good: a batch that
is written again, by however many tasks, finds its manifest and removes what it
staged.  A task that fails removes its file, and an aborted batch those of its other
tasks.  Files that no manifest names are never read.

``delivery_stream`` follows the manifests and hands label and body to the senders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from lograft.session import open_folder
from lograft.sinks.stream_load import send_envelopes

FORMAT = "label_load"
ENVELOPES = "shard INT, n_rows INT, body STRING"
_STAGED = pa.schema([("shard", pa.int32()), ("place", pa.int32()), ("n_rows", pa.int32()), ("body", pa.string())])
_STAGED_SQL = "shard INT, place INT, n_rows INT, body STRING"
_MANIFEST_SQL = "batch BIGINT, number INT, file STRING, load_table STRING"
#: Bodies that a task holds before it writes them out.
GROUP = 16


@dataclass
class Staged(WriterCommitMessage):
    partition: int
    file: str | None


class LoadWriter(DataSourceStreamWriter):
    def __init__(self, path: str, table: str):
        self.path, self.table = path.rstrip("/"), table

    def write(self, iterator: Iterator) -> Staged:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        files, folder = open_folder(f"{self.path}/bodies")
        name, writer, waiting, place = f"{uuid.uuid4().hex}.parquet", None, [], 0
        try:
            for row in iterator:
                waiting.append((row["shard"], place, row["n_rows"], row["body"]))
                place += 1
                if len(waiting) >= GROUP:
                    writer = self._flush(writer, files, folder, name, waiting)
            if waiting:
                writer = self._flush(writer, files, folder, name, waiting)
            if writer is not None:
                writer.close()
        except BaseException:
            if writer is not None:
                writer.close()
                files.delete_file(f"{folder}/{name}")
            raise
        return Staged(part, name if writer is not None else None)

    @staticmethod
    def _flush(writer, files, folder: str, name: str, waiting: list):
        if writer is None:
            files.create_dir(folder, recursive=True)
            writer = pq.ParquetWriter(f"{folder}/{name}", _STAGED, filesystem=files)
        writer.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*waiting), _STAGED)], schema=_STAGED))
        waiting.clear()
        return writer

    def _remove(self, messages) -> None:
        files, folder = open_folder(f"{self.path}/bodies")
        for message in messages:
            if message is not None and message.file is not None:
                files.delete_file(f"{folder}/{message.file}")

    def commit(self, messages, batchId: int) -> None:
        from pyarrow import fs
        files, folder = open_folder(f"{self.path}/published")
        name = f"{folder}/batch={batchId}.json"
        if files.get_file_info(name).type != fs.FileType.NotFound:  # published before a restart
            self._remove(messages)
            return
        staged = sorted((m.partition, m.file) for m in messages if m is not None and m.file is not None)
        if not staged:
            return
        lines = [json.dumps({"batch": batchId, "number": i, "file": f, "load_table": self.table}) for i, (_, f) in enumerate(staged)]
        files.create_dir(folder, recursive=True)
        # readers skip names that begin with a dot; the rename makes the manifest whole at once
        with files.open_output_stream(f"{folder}/.batch={batchId}") as out:
            out.write("".join(x + "\n" for x in lines).encode())
        files.move(f"{folder}/.batch={batchId}", name)

    def abort(self, messages, batchId: int) -> None:
        self._remove(messages)


class LoadSink(DataSource):
    """Options: ``path`` (a shared folder) and ``table`` (first part of the labels)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ENVELOPES

    def streamWriter(self, schema, overwrite: bool) -> LoadWriter:
        return LoadWriter(self.options["path"], self.options.get("table", "app"))


def load_stream(envelopes: DataFrame, path: str, checkpoint: str, table: str = "app", available_now: bool = False,
                interval: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Write a stream of bodies to the sink; each is published once, whatever fails or restarts."""
    from lograft.streaming.jobs import _start, _trigger
    spark = envelopes.sparkSession
    spark.dataSource.register(LoadSink)
    w = (envelopes.select("shard", "n_rows", "body").writeStream.format(FORMAT).option("path", path).option("table", table)
         .option("checkpointLocation", checkpoint))
    return _start(_trigger(w, available_now, interval), spark, state_partitions)


def _labelled(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    bodies = spark.read.schema(_STAGED_SQL).parquet(f"{path}/bodies").select("*", F.col("_metadata.file_name").alias("file"))
    label = F.concat_ws("-", "load_table", "batch", "shard", "number", "place")
    return bodies.join(manifest, "file").select(label.alias("label"), "shard", "n_rows", "body")


def read_load(spark: SparkSession, path: str) -> DataFrame:
    """(label, shard, n_rows, body) of everything published."""
    return _labelled(spark, path, spark.read.schema(_MANIFEST_SQL).json(f"{path}/published"))


def delivery_stream(spark: SparkSession, path: str, checkpoint: str, senders: list, available_now: bool = False,
                    interval: str | None = None) -> StreamingQuery:
    """Send what is published, in the tasks: ``senders[shard](label, body)``.

    A batch of manifests that failed half-way is sent again with the same labels and
    bodies, which the receiver applies once.
    """
    from lograft.streaming.jobs import _trigger

    def run_batch(manifest: DataFrame, batch_id: int) -> None:
        send_envelopes(_labelled(manifest.sparkSession, path, manifest), senders)

    w = spark.readStream.schema(_MANIFEST_SQL).json(f"{path}/published").writeStream.foreachBatch(run_batch) \
        .option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()
