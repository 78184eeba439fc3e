import lzma
import random
import shutil
import subprocess

import pytest
import zstandard

from linkmill.sources import files, packed
from linkmill.sources.packed import read_split, run_lines, runs_of


def lines(seed, n):
    rng = random.Random(seed)
    # Empty lines, short ones, and some longer than a whole part.
    return [bytes(rng.choice(b"abc \xc3\xa9") for _ in range(rng.choice([0, 1, 30, 200, 3000 if i % 17 == 0 else 50]))) for i in range(n)]


def zst_frames(pieces):
    """One frame each, some without a content size, some with a checksum, and one to be skipped between them."""
    out = b""
    for i, piece in enumerate(pieces):
        packer = zstandard.ZstdCompressor(level=i % 5 + 1, write_content_size=i % 2 == 0, write_checksum=i % 3 == 0)
        if i % 4 == 3:
            stream = packer.compressobj()
            out += stream.compress(piece) + stream.flush()
        else:
            out += packer.compress(piece)
        if i == 2:
            out += (0x184D2A50).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"other"
    return out


def xz_streams(pieces):
    return b"".join(lzma.compress(p, check=[lzma.CHECK_CRC32, lzma.CHECK_CRC64, lzma.CHECK_SHA256, lzma.CHECK_NONE][i % 4]) + b"\0" * (4 * (i % 3)) for i, p in enumerate(pieces))


def xz_blocks(pieces):
    tool = shutil.which("xz")
    if not tool:
        pytest.skip("no tool that writes blocks")
    return subprocess.run([tool, "--block-size=1500", "-T1", "-c"], input=b"".join(pieces), capture_output=True, check=True).stdout


@pytest.mark.parametrize("pack, name", [(zst_frames, "a.zst"), (xz_streams, "a.xz"), (xz_blocks, "a.xz")])
@pytest.mark.parametrize("seed", range(6))
def test_runs_hold_every_line_once(tmp_path, pack, name, seed):
    rng = random.Random(seed)
    whole = b"\n".join(lines(seed, 60)) + rng.choice([b"", b"\n", b"\n\n"])
    cuts = sorted(rng.sample(range(len(whole) + 1), 12))
    if seed % 2:  # parts that end with a line
        cuts = sorted({whole.rfind(b"\n", 0, c) + 1 for c in cuts})
    pieces = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)])]
    path = tmp_path / name
    path.write_bytes(pack(pieces))
    want = whole.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    for run_bytes in (1, 700, 1 << 30):
        runs = runs_of(str(path), run_bytes)
        assert len(runs) > 2 if run_bytes == 1 else len(runs) == 1 or run_bytes == 700
        assert [line for run in runs for line in run_lines(str(path), *run)] == want


def test_a_file_of_many_frames_is_read_by_several_tasks(spark, tmp_path):
    rows = [f"line {i}".encode() for i in range(5000)]
    many = b"\n".join(rows) + b"\n"
    step = 1 + len(many) // 40
    (tmp_path / "many.zst").write_bytes(zst_frames([many[i : i + step] for i in range(0, len(many), step)]))
    (tmp_path / "one.zst").write_bytes(zstandard.ZstdCompressor().compress(many))
    (tmp_path / "one.xz").write_bytes(lzma.compress(many))
    (tmp_path / "empty.zst").write_bytes(b"")
    (tmp_path / "plain.txt").write_bytes(many)
    found = files.find_files(spark, str(tmp_path), "many.zst")
    split = read_split(found, 1, run_bytes=500)
    assert split.rdd.getNumPartitions() >= 5
    assert sorted(r.value.encode() for r in split.collect()) == sorted(rows)
    both = files.read_lines(spark, str(tmp_path), split=True).groupBy("source_file").count().collect()
    assert sorted((r.source_file.rsplit("/", 1)[1], r["count"]) for r in both) == [(n, 5000) for n in ("many.zst", "one.xz", "one.zst", "plain.txt")]
    assert files.read_lines(spark, str(tmp_path), "many.zst", split=True).count() == files.read_lines(spark, str(tmp_path), "many.zst").count()


def test_short_runs_share_tasks(spark, tmp_path, monkeypatch):
    rows = [f"line {i}".encode() for i in range(4000)]
    (tmp_path / "many.zst").write_bytes(zst_frames([b"\n".join(rows[i : i + 10]) + b"\n" for i in range(0, 4000, 10)]))
    found = files.find_files(spark, str(tmp_path), "many.zst")
    assert len(runs_of(str(tmp_path / "many.zst"), 1)) > 300
    split = read_split(found, 1, run_bytes=1)
    assert split.rdd.getNumPartitions() <= packed.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert sorted(r.value.encode() for r in split.collect()) == sorted(rows)
    monkeypatch.setattr(packed, "TASK_BYTES", 100)
    assert read_split(found, 1, run_bytes=1).rdd.getNumPartitions() > 50
