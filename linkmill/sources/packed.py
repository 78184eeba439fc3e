"""Lines of packed files whose name tells Spark no codec; it would read the packed bytes as text."""

from __future__ import annotations

import io
import lzma
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.session import scratch_path, written_with

#: Lines are handed over in batches of about this many bytes.
BATCH_BYTES = 8 << 20


def open_stream(path: str):
    """A readable byte stream for a local, HDFS or object-store path, given as it is named and not as a URI."""
    from urllib.parse import quote

    from pyarrow import fs

    uri = quote(path if "://" in path else "file://" + path.removeprefix("file:"), safe=":/@[]")
    filesystem, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
    return filesystem.open_input_stream(name, compression=None)


# Fixed value: dumps are packed with windows of up to 2 GB.
MAX_WINDOW = 1 << 31

# Xz dumps, and score-filtered zstd files that carry a suffix after ``.zst``.
PACKED_EXTENSIONS = ["xz", "minscored"]


def unpack(path: str, packed):
    if path.lower().endswith(".xz"):
        return lzma.open(packed)
    import zstandard

    return io.BufferedReader(zstandard.ZstdDecompressor(max_window_size=MAX_WINDOW).stream_reader(packed, read_across_frames=True))


# --- splitting ------------------------------------------------------------------------------------------------

#: Packed bytes that one task reads, where a file has several parts that can be unpacked on their own.
RUN_BYTES = 64 << 20
#: Short runs share tasks: so many of them for each core, and more where a task would have more packed bytes than this.
TASKS_PER_CORE, TASK_BYTES = 4, 16 << 20

RUN = "path string, first bigint, stop bigint"


def open_file(path: str):
    """The same as a file that can be read from any place."""
    from urllib.parse import quote

    from pyarrow import fs

    uri = quote(path if "://" in path else "file://" + path.removeprefix("file:"), safe=":/@[]")
    filesystem, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
    return filesystem.open_input_file(name)


class _Window(io.RawIOBase):
    """``size`` bytes of a file from ``start`` on, as a stream."""

    def __init__(self, file, start: int, size: int):
        self.file, self.at, self.end = file, start, start + size

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read_at(min(len(buffer), self.end - self.at), self.at) if self.at < self.end else b""
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


def _zstd_frames(file, at: int) -> Iterator[tuple[int, int, None]]:
    """(start, size, None) of each frame from ``at`` on, by the sizes in the headers of its blocks."""
    end = file.size()
    while at < end:
        start, head = at, file.read_at(18, at)
        magic = int.from_bytes(head[:4], "little")
        if magic & ~0xF == 0x184D2A50:  # a frame to be skipped
            at += 8 + int.from_bytes(head[4:8], "little")
        elif magic == 0xFD2FB528:
            flags = head[4]
            alone = flags >> 5 & 1
            at += 5 + (1 - alone) + (0, 1, 2, 4)[flags & 3] + (alone, 2, 4, 8)[flags >> 6]
            last = False
            while not last:
                block = int.from_bytes(file.read_at(3, at), "little")
                last, kind, size = block & 1, block >> 1 & 3, block >> 3
                at += 3 + (1 if kind == 1 else size)
            at += 4 * (flags >> 2 & 1)
        else:
            raise ValueError(f"no zstd frame at {at}")
        yield start, at - start, None


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A number of seven bits a byte, and the place after it."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _xz_blocks(file) -> list[tuple[int, int, int]]:
    """(start, size, check size) of each block, from the index at the end of each stream."""
    end, blocks = file.size(), []
    while end > 0:
        foot = file.read_at(12, end - 12)
        if foot[8:] == b"\0\0\0\0":  # padding between streams
            end -= 4
            continue
        if foot[10:] != b"YZ":
            raise ValueError(f"no xz stream ends at {end}")
        size = (int.from_bytes(foot[4:8], "little") + 1) * 4
        index = file.read_at(size, end - 12 - size)
        records, at = _number(index, 1)
        sizes = []
        for _ in range(records):
            unpadded, at = _number(index, at)
            _, at = _number(index, at)
            sizes.append(unpadded)
        whole = sum((s + 3) & ~3 for s in sizes)
        start = end - 12 - size - whole
        check = (0, 4, 4, 4, 8, 8, 8, 16, 16, 16, 32, 32, 32, 64, 64, 64)[foot[9] & 15]
        own = []
        for s in sizes:
            own.append((start, s, check))
            start += (s + 3) & ~3
        blocks = own + blocks
        end -= 12 + size + whole + 12
    return blocks


def _parts(file, path: str, at: int) -> Iterator[tuple[int, int, int | None]]:
    """The parts from ``at`` on that can be unpacked on their own."""
    if path.lower().endswith(".xz"):
        return iter([b for b in _xz_blocks(file) if b[0] >= at])
    return _zstd_frames(file, at)


def _unpacked(file, part: tuple[int, int, int | None]) -> Iterator[bytes]:
    """The bytes of one part, piece by piece."""
    start, size, check = part
    if check is None:
        import zstandard

        with zstandard.ZstdDecompressor(max_window_size=MAX_WINDOW).stream_reader(_Window(file, start, size), read_across_frames=True) as reader:
            while piece := reader.read(1 << 20):
                yield piece
        return
    head = file.read_at((file.read_at(1, start)[0] + 1) * 4, start)
    if head[1] & 3:
        raise ValueError("only blocks with one filter can be split")
    at = 2
    for bit in (64, 128):
        if head[1] & bit:
            _, at = _number(head, at)
    kind, at = _number(head, at)
    _, at = _number(head, at)
    if kind != lzma.FILTER_LZMA2:
        raise ValueError("only LZMA2 blocks can be split")
    bits = head[at]
    filters = [{"id": lzma.FILTER_LZMA2, "dict_size": 0xFFFFFFFF if bits == 40 else (2 | bits & 1) << (bits // 2 + 11)}]
    unpacker = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=filters)
    source = io.BufferedReader(_Window(file, start + len(head), size - len(head) - check), 1 << 20)
    while not unpacker.eof and (packed := source.read(1 << 20)):
        yield unpacker.decompress(packed)


def runs_of(path: str, run_bytes: int = RUN_BYTES) -> list[tuple[int, int]]:
    """Where runs of neighbouring parts of about ``run_bytes`` begin and end in a file."""
    found, begun = [], None
    with open_file(path) as file:
        for start, size, _ in _parts(file, path, 0):
            begun = start if begun is None else begun
            if start + size - begun >= run_bytes:
                found.append((begun, start + size))
                begun = None
        if begun is not None:
            found.append((begun, file.size()))
    return found


def _finder(run_bytes: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(path, *run) for path in batch.column("path").to_pylist() for run in runs_of(path, run_bytes)]
            columns = list(zip(*rows)) or [[], [], []]
            arrays = [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=["path", "first", "stop"])

    return find


def run_lines(path: str, first: int, stop: int) -> Iterator[bytes]:
    """The lines that begin in a run, or right at its end; the first one only in a file's first run, as the run before
    has read it to its end."""
    with open_file(path) as file:
        first_of_file = first == next(iter(_parts(file, path, 0)))[0]
        rest, skipping, own = b"", not first_of_file, True
        for part in _parts(file, path, first):
            if own and part[0] >= stop:
                if skipping:
                    return  # no line begins in this run
                own = False
            for piece in _unpacked(file, part):
                if skipping:
                    cut = piece.find(b"\n")
                    if cut < 0:
                        continue
                    piece, skipping = piece[cut + 1 :], False
                if not own:
                    cut = piece.find(b"\n")
                    if cut < 0:
                        rest += piece
                        continue
                    yield rest + piece[:cut]
                    return
                lines = (rest + piece).split(b"\n")
                rest = lines.pop()
                yield from lines
        if rest and not skipping:
            yield rest


def _split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "stop"))):
            lines, size = [], 0
            for raw in run_lines(path, first, stop):
                lines.append(raw.rstrip(b"\r"))
                size += len(raw)
                if size >= BATCH_BYTES:
                    yield _batch(lines, path)
                    lines, size = [], 0
            if lines:
                yield _batch(lines, path)


def read_split(files: DataFrame, tasks: int, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(value, source_file): the lines of the ``.xz`` and ``.zst`` files in ``path``, read by runs of xz blocks and zstd frames.

    A first pass finds the runs: from the index of an xz file, and from block headers of a zstd file, a few bytes for
    every 128 KB. A line belongs to the run in which it begins, and is read on beyond that. A file of one part is one run.
    A task reads several runs where they are short: there are tasks for all cores, and one for each ``TASK_BYTES`` in all.
    """
    spark = files.sparkSession
    found = files.select("path").repartition(tasks, "path").mapInArrow(_finder(run_bytes), RUN)
    seen = F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("stop") - F.col("first")), F.lit(0)).alias("size"))
    runs, total = written_with(found, scratch_path(spark, "packed-runs"), seen)
    enough = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, total.size // TASK_BYTES + 1)
    return runs.repartition(max(1, min(total.n, enough)), "path", "first").mapInArrow(_split_lines, "value string, source_file string")


# --- whole streams --------------------------------------------------------------------------------------------


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            lines, size = [], 0
            with open_stream(path) as packed, unpack(path, packed) as unpacked:
                for raw in unpacked:
                    lines.append(raw.rstrip(b"\r\n"))
                    size += len(raw)
                    if size >= BATCH_BYTES:
                        yield _batch(lines, path)
                        lines, size = [], 0
            if lines:
                yield _batch(lines, path)


def _batch(lines: list[bytes], path: str) -> pa.RecordBatch:
    """Bytes that are no UTF-8 stay as they are, as in Spark's own reader, and are told apart where lines are parsed."""
    return pa.RecordBatch.from_arrays(
        [pa.array(lines, pa.binary()).cast(pa.string(), safe=False), pa.array([path] * len(lines), pa.string())],
        names=["value", "source_file"],
    )


def read_packed(files: DataFrame, tasks: int) -> DataFrame:
    """(value, source_file): the lines of the files in ``path``. A stream can only be unpacked from its start, so a file is
    one task; their names stay in the table."""
    return files.select("path").repartition(tasks, "path").mapInArrow(_lines, "value string, source_file string")
