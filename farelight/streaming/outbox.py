"""A message sink that holds each message once, whatever fails and is repeated.

Tasks write messages to files of their own; what they have written does not count yet. The
commit of a batch then lists its files in one manifest, named by stream and batch number,
which comes into being by a rename: all messages of the batch are there from then on. A
batch that is repeated, because a task, the driver or the checkpoint failed after some files
or even after the commit, finds its manifest, or else writes new files next to files that
no manifest names. Readers read what manifests name.

    register(spark)
    stream.writeStream.format("outbox").option("path", uri).option("stream", "kpis")...
    spark.read.format("outbox").load(uri)

The path is any that pyarrow can open (a local one, ``hdfs://``, ``s3://``), shared by
executors and driver. One running query per stream name.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

# Executors get the code with the plan and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "outbox"
MESSAGES = "key string, value string"
PARTS, MANIFESTS = "parts", "manifests"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: the name of its file, and the messages in it."""

    part: str | None
    messages: int


@dataclass
class Part(InputPartition):
    name: str
    stream: str
    batch: str


class Folder:
    """The files of an outbox."""

    def __init__(self, uri: str):
        self.uri = uri

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.uri or self.uri.startswith("file:"):
            system, path = fs.FileSystem.from_uri(self.uri.replace("file:/", "file:///", 1) if "://" not in self.uri else self.uri)
        else:
            system, path = fs.LocalFileSystem(), self.uri
        return system, path.rstrip("/")

    def write_part(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """The messages of one task as one file; none if there are no messages."""
        system, path = self._open()
        name, writer, messages = f"{uuid.uuid4().hex}.parquet", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(f"{path}/{PARTS}", recursive=True)
                writer = pq.ParquetWriter(f"{path}/{PARTS}/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
            messages += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(name, messages)

    def read_part(self, name: str) -> pa.Table:
        system, path = self._open()
        return pq.read_table(f"{path}/{PARTS}/{name}", filesystem=system)

    def commit(self, stream: str, batch: int | str, messages: list[Written | None]) -> bool:
        """Make a batch count; False if it does already, and these files are not needed."""
        system, path = self._open()
        manifest = f"{path}/{MANIFESTS}/{stream}-{batch}.json"
        if system.get_file_info(manifest).type != fs.FileType.NotFound:
            self.discard(messages)
            return False
        parts = [m.part for m in messages if m and m.part]
        entry = {"stream": stream, "batch": batch, "parts": parts, "messages": sum(m.messages for m in messages if m)}
        system.create_dir(f"{path}/{MANIFESTS}", recursive=True)
        draft = f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(entry).encode())
        system.move(draft, manifest)
        return True

    def discard(self, messages: list[Written | None]) -> None:
        """Delete files that will not be committed; what is left over does no harm."""
        system, path = self._open()
        for message in messages:
            if message and message.part:
                system.delete_file(f"{path}/{PARTS}/{message.part}")

    def manifests(self) -> list[dict]:
        """One small entry per committed batch."""
        system, path = self._open()
        found = system.get_file_info(fs.FileSelector(f"{path}/{MANIFESTS}", allow_not_found=True))
        entries = []
        for info in sorted(found, key=lambda f: f.path):
            if info.base_name.endswith(".json"):
                with system.open_input_stream(info.path) as file:
                    entries.append(json.loads(file.read()))
        return entries


class OutboxWriter(DataSourceArrowWriter):
    """A batch write: a batch of its own, under the name given as option ``batch`` or a new one."""

    def __init__(self, folder: Folder, stream: str, batch: str):
        self.folder, self.stream, self.batch = folder, stream, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write_part(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.folder.commit(self.stream, self.batch, messages)

    def abort(self, messages: list[Written | None]) -> None:
        self.folder.discard(messages)


class OutboxStreamWriter(DataSourceStreamArrowWriter):
    """A streaming write: Spark numbers the batches and repeats one under its number."""

    def __init__(self, folder: Folder, stream: str):
        self.folder, self.stream = folder, stream

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write_part(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.folder.commit(self.stream, batchId, messages)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.folder.discard(messages)


class OutboxReader(DataSourceReader):
    """Messages of committed batches, a task for each file."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def partitions(self) -> list[Part]:
        return [Part(p, str(e["stream"]), str(e["batch"])) for e in self.folder.manifests() for p in e["parts"]]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        # The reader gets a placeholder if there is no partition at all.
        if not isinstance(partition, Part):
            return
        table = self.folder.read_part(partition.name)
        for name in ("stream", "batch"):
            table = table.append_column(name, pa.array([getattr(partition, name)] * len(table), pa.string()))
        yield from table.to_batches()


class Outbox(DataSource):
    """Data source ``outbox`` of ``key, value``, read with ``stream, batch`` of each message."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{MESSAGES}, stream string, batch string"

    def _folder(self) -> Folder:
        if not self.options.get("path"):
            raise ValueError("outbox needs a path")
        return Folder(self.options["path"])

    def _stream(self) -> str:
        return self.options.get("stream", "messages")

    def _check(self, schema: StructType, overwrite: bool) -> None:
        if overwrite:
            raise ValueError("an outbox is only appended to")
        if schema.names != ["key", "value"]:
            raise ValueError(f"messages have key and value, not {', '.join(schema.names)}")

    def reader(self, schema: StructType) -> DataSourceReader:
        return OutboxReader(self._folder())

    def writer(self, schema: StructType, overwrite: bool) -> OutboxWriter:
        self._check(schema, overwrite)
        return OutboxWriter(self._folder(), self._stream(), self.options.get("batch", uuid.uuid4().hex))

    def streamWriter(self, schema: StructType, overwrite: bool) -> OutboxStreamWriter:
        self._check(schema, overwrite)
        return OutboxStreamWriter(self._folder(), self._stream())


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(Outbox)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """``key, value, stream, batch`` of all committed messages."""
    register(spark)
    return spark.read.format(FORMAT).load(path)
