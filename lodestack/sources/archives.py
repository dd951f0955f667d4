"""Archives: members of zip (stored, deflate, zstd, deflate64 by 7z), nested archives, 7z by an external tool."""

from __future__ import annotations

import io
import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, content binary, error string"
# Compression methods of zip.
DEFLATE64, ZSTD = 9, (20, 93)


def safe(name: str) -> bool:
    """A member that stays inside the target folder and is no folder, resource fork or metadata."""
    parts = PurePosixPath(name.replace("\\", "/")).parts
    return bool(parts) and not name.endswith("/") and not name.startswith(("/", "\\")) and ".." not in parts and ":" not in parts[0] and "__MACOSX" not in parts and not parts[-1].startswith("._")


def sevenzip() -> str | None:
    return next(filter(None, map(shutil.which, ("7z", "7zz", "7za"))), None)


def sevenzip_ok(path: str) -> bool:
    """Whether the external tool finds an archive whole; False without the tool."""
    tool = sevenzip()
    return tool is not None and subprocess.run([tool, "t", path], capture_output=True).returncode == 0


def _by_7z(data: bytes, name: str) -> bytes:
    tool = sevenzip()
    if tool is None:
        raise RuntimeError("no 7z tool on this machine")
    with tempfile.TemporaryDirectory() as folder:
        archive = Path(folder, "archive")
        archive.write_bytes(data)
        return subprocess.run([tool, "x", "-so", str(archive), name], check=True, capture_output=True).stdout


def member_bytes(data: bytes, info: zipfile.ZipInfo) -> bytes:
    if info.compress_type in ZSTD:
        import zstandard

        with io.BytesIO(data) as f:  # the local header tells where the data begins
            f.seek(info.header_offset + 26)
            name, extra = int.from_bytes(f.read(2), "little"), int.from_bytes(f.read(2), "little")
            f.seek(info.header_offset + 30 + name + extra)
            out = zstandard.ZstdDecompressor().decompressobj().decompress(f.read(info.compress_size))
        if len(out) != info.file_size:
            raise ValueError(f"member {info.filename} has {len(out)} bytes, not {info.file_size}")
        return out
    if info.compress_type == DEFLATE64:
        return _by_7z(data, info.filename)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return z.read(info)


def zip_members(data: bytes) -> Iterator[tuple[str, bytes | None, str | None]]:
    """(name, content, error) of safe members in order of name."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        infos = sorted((i for i in z.infolist() if safe(i.filename)), key=lambda i: i.filename)
    for info in infos:
        try:
            yield info.filename, member_bytes(data, info), None
        except Exception as e:
            yield info.filename, None, f"{type(e).__name__}: {e}"


def _expand(name: str, data: bytes, depth: int) -> Iterator[tuple[str, bytes | None, str | None]]:
    if data[:4] in (b"PK\x03\x04", b"PK\x05\x06"):
        for member, content, error in zip_members(data):
            path = f"{name}!{member}" if name else member
            if content is not None and depth > 1 and content[:4] in (b"PK\x03\x04", b"PK\x05\x06") and not member.lower().endswith((".xlsx", ".ods", ".docx", ".pptx")):
                yield from _expand(path, content, depth - 1)
            else:
                yield path, content, error
    elif data[:6] == b"7z\xbc\xaf\x27\x1c":
        tool = sevenzip()
        if tool is None:
            yield name, None, "RuntimeError: no 7z tool on this machine"
            return
        with tempfile.TemporaryDirectory() as folder:
            archive, out = Path(folder, "archive.7z"), Path(folder, "out")
            archive.write_bytes(data)
            subprocess.run([tool, "x", "-y", f"-o{out}", str(archive)], check=True, capture_output=True)
            root = out.resolve()
            for f in sorted(p for p in out.rglob("*") if p.is_file() and not p.is_symlink()):
                if f.resolve().is_relative_to(root) and safe(f.relative_to(out).as_posix()):
                    yield f"{name}!{f.relative_to(out).as_posix()}" if name else f.relative_to(out).as_posix(), f.read_bytes(), None


def read_members(spark: SparkSession, path: str, depth: int = 4) -> DataFrame:
    """archive, member, content, error: a row for each safe member, nested archives expanded to depth levels.

    A task reads whole archives; one member is in memory at a time besides its archive. A broken
    archive or member gives a row with its error instead of failing the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = _expand("", data, depth)
                while True:
                    try:
                        row = next(rows, None)
                    except Exception as e:
                        row, rows = ("", None, f"{type(e).__name__}: {e}"), iter(())
                    if row is None:
                        break
                    yield pa.RecordBatch.from_arrays([pa.array([archive]), *(pa.array([v], t) for v, t in zip(row, (pa.string(), pa.binary(), pa.string())))], ["archive", "member", "content", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, MEMBERS)


def read_member_lines(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """archive, value: lines of the one member with this suffix in each archive; none or several raise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    infos = [i for i in z.infolist() if safe(i.filename) and i.filename.lower().endswith(suffix)]
                    if len(infos) != 1:
                        raise ValueError(f"{archive} holds {len(infos)} members ending in {suffix}, not one")
                    with z.open(infos[0]) as f:
                        text = io.TextIOWrapper(f, encoding="utf-8", newline="\n")
                        while part := text.readlines(4 << 20):
                            yield pa.RecordBatch.from_arrays([pa.array([archive] * len(part)), pa.array([x.rstrip("\r\n") for x in part])], ["archive", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, value string")


def archive_health(spark: SparkSession, path: str) -> DataFrame:
    """archive, members, error: whether each zip can be read whole (checksums included)."""
    rows = read_members(spark, path, depth=1)
    return rows.groupBy("archive").agg(F.count_if(F.col("content").isNotNull()).alias("members"), F.max("error").alias("error"))
