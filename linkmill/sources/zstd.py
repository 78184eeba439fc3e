"""Writing JSON lines as zstd files; Spark's own text writer cannot.

Tasks write files below a staging folder, under names of their own. Which of them count is said by a manifest, a table
that Spark's writer commits, so files of lost or repeated attempts don't. Further tasks then move the files to their
names; a move that was done already is no error, so the manifest can be followed again after a failure.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.session import written

# Fixed value: compression level of published files.
ZSTD_LEVEL = 3

MANIFEST = "staged string, name string, n_lines bigint"


def filesystem_of(path: str):
    from pyarrow import fs

    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))


def _packer(staging: str, prefix: str, max_records: int, frame_bytes: int):
    """Rows to files, for ``mapInArrow``; gives the manifest's rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        filesystem, base = filesystem_of(staging)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        files: list[list] = []
        packer, sink, current, size = None, None, None, 0

        def opened():
            return zstandard.ZstdCompressor(level=ZSTD_LEVEL).stream_writer(sink, closefd=False)

        def close() -> None:
            packer.close()
            sink.close()

        for batch in batches:
            lines = batch.column("value").to_pylist()
            names = batch.column("file_name").to_pylist() if "file_name" in batch.schema.names else [None] * len(lines)
            for line, name in zip(lines, names):
                if packer is None or name != current or (max_records and files[-1][2] == max_records):
                    if packer is not None:
                        close()
                    staged = f"{prefix}{task:05d}-{len(files):04d}-{attempt}.jsonl.zst"
                    files.append([staged, name or staged, 0])
                    sink = filesystem.open_output_stream(f"{base}/{staged}", compression=None)
                    packer, current, size = opened(), name, 0
                elif frame_bytes and size >= frame_bytes:
                    packer.close()
                    packer, size = opened(), 0
                raw = line.encode("utf-8") + b"\n"
                packer.write(raw)
                size += len(raw)
                files[-1][2] += 1
        if packer is not None:
            close()
        columns = list(zip(*files)) or [[], [], []]
        arrays = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["staged", "name", "n_lines"])

    return pack


def _mover(staging: str, path: str):
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, source = filesystem_of(staging)
        _, base = filesystem_of(path)
        for batch in batches:
            for staged, name in zip(batch.column("staged").to_pylist(), batch.column("name").to_pylist()):
                if filesystem.get_file_info(f"{source}/{staged}").type == fs.FileType.File:
                    filesystem.move(f"{source}/{staged}", f"{base}/{name}")
                elif filesystem.get_file_info(f"{base}/{name}").type != fs.FileType.File:
                    raise FileNotFoundError(f"{staged} is neither staged nor moved to {name}")
            yield batch.select(["name"])

    return move


def _remover(path: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = filesystem_of(path)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                filesystem.delete_file(f"{base}/{name}")
            yield batch

    return remove


def follow_manifest(manifest: DataFrame, staging: str, path: str) -> None:
    """Move every staged file to its name; again after a failure, if need be. Files of one name go by the last move, so
    names should differ."""
    manifest.select("staged", "name").repartition("staged").mapInArrow(_mover(staging, path), "name string").write.format("noop").mode("overwrite").save()


def write_zst_lines(lines: DataFrame, path: str, prefix: str = "part-", max_records_per_file: int = 0, mode: str = "overwrite", frame_bytes: int = 0) -> DataFrame:
    """Write the column ``value`` as lines of ``.jsonl.zst`` files; the manifest ``(staged, name, n_lines)``.

    Rows with a column ``file_name`` go to the file of that name; they must arrive grouped by it, each name in one task.
    Otherwise files are numbered by task. A new frame begins after ``frame_bytes`` bytes of text, if that is given, so that
    ``read_lines`` can split a file. With ``overwrite`` older ``.jsonl.zst`` files go once the new ones are there.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(mode)
    spark, staging = lines.sparkSession, f"{path}/_staging-{uuid.uuid4().hex}"
    filesystem, base = filesystem_of(staging)
    filesystem.create_dir(base, recursive=True)
    sent = lines.select(*[c for c in ("value", "file_name") if c in lines.columns])
    manifest = written(sent.mapInArrow(_packer(staging, prefix, max_records_per_file, frame_bytes), MANIFEST), "zst-manifest")
    if mode == "overwrite":
        there = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl.zst").load(path)
        old = there.select(F.element_at(F.split("path", "/"), -1).alias("name")).join(manifest.select("name"), "name", "left_anti")
        follow_manifest(manifest, staging, path)
        old.mapInArrow(_remover(path), "name string").write.format("noop").mode("overwrite").save()
    else:
        follow_manifest(manifest, staging, path)
    filesystem.delete_dir(base)
    return manifest
