"""Byte streams of files by path or URI, and small driver-side writes."""

from __future__ import annotations

import gzip
import io
import json
import os
from datetime import UTC, datetime
from pathlib import Path
from typing import Any, BinaryIO

from pyarrow import fs


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; plain paths are local (or mounted on all nodes)."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def open_bytes(path: str, gzipped: bool = False) -> BinaryIO:
    system, inside = filesystem(path)
    raw = system.open_input_file(inside)
    return gzip.open(io.BufferedReader(raw), "rb") if gzipped else raw  # type: ignore[return-value]


def head(path: str, size: int, gzipped: bool = False) -> bytes:
    with open_bytes(path, gzipped) as f:
        return f.read(size)


def identity(path: str) -> dict[str, Any]:
    """What tells one version of a source from another: path, size, modification time."""
    system, inside = filesystem(path)
    info = system.get_file_info(inside)
    return {"path": path, "size": info.size, "mtime_ns": info.mtime_ns}


def utc_now() -> str:
    return datetime.now(UTC).isoformat()


def write_atomically(path: str | Path, data: bytes) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_name(path.name + ".tmp")
    beside.write_bytes(data)
    os.replace(beside, path)


def atomic_json(path: str | Path, value: Any) -> None:
    write_atomically(path, (json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode())


def append_jsonl(path: str | Path, *records: dict[str, Any]) -> None:
    """Append records and wait until they are on disk."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a", encoding="utf-8") as f:
        f.writelines(json.dumps(r, ensure_ascii=False, separators=(",", ":")) + "\n" for r in records)
        f.flush()
        os.fsync(f.fileno())


def encoding_of(data: bytes) -> str:
    """utf-8-sig if the bytes are UTF-8 (a character cut at the end is no fault), else cp1252."""
    try:
        data.decode("utf-8-sig")
    except UnicodeDecodeError as e:
        return "utf-8-sig" if e.reason == "unexpected end of data" else "cp1252"
    return "utf-8-sig"
