"""Arrow IPC files as a Spark data source: ``spark.read.format("arrow_files").schema(..).load(path)`` and ``df.write.format("arrow_files").save(path)``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

BATCHES_PER_TASK = 64


class BatchRange(InputPartition):
    """Some record batches of a file; ``stop`` is None for the stream format, which has no index."""

    def __init__(self, path: str, start: int, stop: int | None):
        self.path, self.start, self.stop = path, start, stop


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)
    return system, inner


def _files(path: str) -> list[str]:
    from pyarrow import fs

    system, inner = _open(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [path]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    names = sorted(f.path for f in found if f.is_file and f.path.endswith(".arrow"))
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return [prefix + n for n in names]


class ArrowReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str):
        self.schema, self.path = schema, path

    def partitions(self) -> list[InputPartition]:
        """A task per range of record batches; a file without an index is one task."""
        out: list[InputPartition] = []
        for name in _files(self.path):
            system, inner = _open(name)
            try:
                with system.open_input_file(inner) as f:
                    n = pa.ipc.open_file(f).num_record_batches
                out += [BatchRange(name, i, min(i + BATCHES_PER_TASK, n)) for i in range(0, n, BATCHES_PER_TASK)]
            except pa.ArrowInvalid:
                out.append(BatchRange(name, 0, None))
        return out

    def read(self, partition: BatchRange) -> Iterator[pa.RecordBatch]:
        names = self.schema.fieldNames()
        system, inner = _open(partition.path)
        if partition.stop is None:
            with system.open_input_stream(inner) as f:
                for batch in pa.ipc.open_stream(f):
                    yield batch.select(names)
            return
        with system.open_input_file(inner) as f:
            reader = pa.ipc.open_file(f)
            for i in range(partition.start, partition.stop):
                yield reader.get_batch(i).select(names)


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class ArrowWriter(DataSourceArrowWriter):
    """A file per task, in the folder under a name that readers skip until all tasks are done."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, inner = _open(self.path)
        system.create_dir(inner, recursive=True)
        name, sink = f"part-{self.job}-{uuid.uuid4().hex}", None
        for batch in iterator:
            if sink is None:
                file = system.open_output_stream(f"{inner}/{name}.unfinished")
                sink = pa.ipc.new_file(file, batch.schema)
            sink.write_batch(batch)
        if sink is None:
            return Written(None)
        sink.close()
        file.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, inner = _open(self.path)
        old = _files(self.path) if self.overwrite and any(m and m.name for m in messages) else []
        for m in messages:
            if m and m.name:
                system.move(f"{inner}/{m.name}.unfinished", f"{inner}/{m.name}.arrow")
        for name in old:
            system.delete_file(_open(name)[1])

    def abort(self, messages: list[Written | None]) -> None:
        system, inner = _open(self.path)
        for m in messages:
            if m and m.name:
                system.delete_file(f"{inner}/{m.name}.unfinished")


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow_files"

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        system, inner = _open(_files(self.options["path"])[0])
        try:
            with system.open_input_file(inner) as f:
                return from_arrow_schema(pa.ipc.open_file(f).schema)
        except pa.ArrowInvalid:
            with system.open_input_stream(inner) as f:
                return from_arrow_schema(pa.ipc.open_stream(f).schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowReader(schema, self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowWriter(self.options["path"], overwrite)
