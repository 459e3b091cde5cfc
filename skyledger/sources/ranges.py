"""Task-side reading of text by byte range. Only the standard library, numpy and pyarrow.

A range owns the lines whose first byte lies in it, so any cut of a file into ranges yields every
line exactly once. Lines are cut as Arrow strings inside the block just read; no Python object is
made per line.
"""

from __future__ import annotations

import os
import re
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..schemas import LARGEST_STATION

BLOCK = 4 << 20


def open_input(path: str):
    """A seekable binary stream for a local path or for a file system pyarrow knows."""
    if path.startswith("file:"):
        return open(re.sub("^file:/*", "/", path), "rb")
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
    return system.open_input_file(inner)


def file_system(path: str):
    """(file system, path in it) of a local path or of a URI that pyarrow knows."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", re.sub("^file:/*", "file:///", path)))


def open_output(path: str):
    """A binary stream to a new file on a local path or on a file system pyarrow knows."""
    system, inner = file_system(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner)


def rename(old: str, new: str) -> None:
    """Moves a file within one file system; on local disks and HDFS in one step."""
    system, inner = file_system(old)
    system.move(inner, file_system(new)[1])


def listed(path: str, recursive: bool = False) -> list[tuple[str, str, int]]:
    """(path, name, bytes) of the regular files in the folder `path`, or of the file `path` itself.

    The file system is asked itself, so names that begin with `_` or `.` are found as well. Paths come
    back with the scheme they were asked for.
    """
    from pyarrow import fs

    system, inner = file_system(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise ValueError(f"no such file or folder: {path}")
    files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=recursive))
    head = path.rstrip("/")
    return [(head + f.path.removeprefix(inner.rstrip("/")), f.base_name, f.size) for f in files if f.type == fs.FileType.File]


def walked(path: str, recursive: bool = True) -> Iterator[tuple[str, str, int, int]]:
    """(path, name, bytes, microseconds of the last change) of the regular files in the folder `path`, one after another.

    Names that begin with `_` or `.` are left out, as Spark's readers do. A local folder of any size is never
    held as a whole; of another file system, one folder at a time is.
    """
    system, inner = file_system(path)
    head, below = path.rstrip("/"), [inner.rstrip("/")]
    while below:
        at = below.pop()
        for full, name, is_folder, size, changed in _entries(system, at):
            if re.match(r"\.|_(?!.*=)", name) or name.endswith("._COPYING_"):
                continue
            if not is_folder:
                yield head + full.removeprefix(inner.rstrip("/")), name, size, changed
            elif recursive:
                below.append(full)


def subfolders(path: str) -> list[str]:
    """Folders right below the folder `path`, without hidden ones; its files are passed over."""
    system, inner = file_system(path)
    head = path.rstrip("/")
    return sorted(f"{head}/{name}" for _, name, is_folder, *_ in _entries(system, inner.rstrip("/")) if is_folder and not re.match(r"\.|_(?!.*=)", name))


def _entries(system, folder: str) -> Iterator[tuple[str, str, bool, int, int]]:
    """(path, name, whether it is a folder, bytes, microseconds of the last change) of what is in a folder."""
    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder or "/") as found:
            for entry in found:
                try:
                    info = entry.stat()
                except FileNotFoundError:  # gone meanwhile
                    continue
                yield f"{folder}/{entry.name}", entry.name, entry.is_dir(), info.st_size, info.st_mtime_ns // 1000
        return
    for f in system.get_file_info(fs.FileSelector(folder)):
        yield f.path, f.base_name, f.type == fs.FileType.Directory, f.size or 0, (f.mtime_ns or 0) // 1000


def _after_lines(stream, count: int) -> int:
    """Offset behind the first `count` physical lines, or behind the end of a shorter file."""
    at, left = 0, count
    while left > 0:
        data = stream.read(1 << 16)
        if not data:
            return at + 1
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        if len(ends) >= left:
            return at + int(ends[left - 1]) + 1
        left -= len(ends)
        at += len(data)
    return at


def lines_in_range(stream, lo: int, hi: int, header_lines: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(offsets, lines) per block for the data lines that start in [lo, hi)."""
    for offsets, text in text_in_range(stream, lo, hi, header_lines):
        yield offsets, _as_strings(text, len(offsets))


def text_in_range(stream, lo: int, hi: int, header_lines: int, size: int | None = None) -> Iterator[tuple[np.ndarray, bytes]]:
    """(offsets, text) per block for the data lines that start in [lo, hi).

    A file whose `size` is known to be within a block is read at once and in one go; most station files are.
    """
    if lo == 0 and size is not None and size <= BLOCK:
        yield from _whole_text(stream.read(), hi, header_lines)
        return
    first = max(lo, _after_lines(stream, header_lines))
    if first >= hi:
        return
    # One byte earlier, so that a line starting exactly at `first` is seen as a start.
    at = max(first - 1, 0)
    stream.seek(at)
    rest = b""
    while at < hi:
        data = stream.read(BLOCK)
        text = rest + data
        if not text:
            return
        cut = len(text) if not data else text.rfind(b"\n") + 1
        rest = text[cut:]
        if cut:
            ends = np.flatnonzero(np.frombuffer(text, np.uint8, cut) == 10) + 1
            if not len(ends) or ends[-1] != cut:
                ends = np.append(ends, cut)
            starts = np.concatenate(([0], ends[:-1]))
            a, b = np.searchsorted(at + starts, [first, hi])
            if a < b:
                yield at + starts[a:b], text[starts[a] : ends[b - 1]]
        at += cut
        if not data:
            return


def _whole_text(text: bytes, hi: int, header_lines: int) -> Iterator[tuple[np.ndarray, bytes]]:
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if text and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    starts = np.concatenate(([0], ends[:-1]))
    last = np.searchsorted(starts[: len(ends)], hi)
    if header_lines < last:
        yield starts[header_lines:last], text[starts[header_lines] : ends[last - 1]]


def _as_strings(text: bytes, count: int) -> pa.Array:
    """The `count` lines of `text` without their line ends."""
    try:
        text.decode("utf-8")
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode("utf-8")
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    bounds = np.concatenate(([0], ends)).astype(np.int32)
    if len(bounds) == count:
        bounds = np.append(bounds, np.int32(len(text)))
    lines = pa.StringArray.from_buffers(count, pa.py_buffer(bounds), pa.py_buffer(text))
    return pc.utf8_rtrim(lines, "\r\n")


def in_large_batches(pieces: Iterator[tuple[tuple, np.ndarray, bytes]], names: pa.Schema, place: str, rows: int = 1 << 15, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of the columns `names`, `place` and `line` from (names of a file, places of lines, their text).

    Lines of many small files are cut as one text, and a file's names are repeated by Arrow: both a file
    and a batch handed to Spark have a fixed cost.
    """
    held: list[tuple[tuple, np.ndarray, bytes]] = []
    count = held_bytes = 0
    for piece in pieces:
        held.append(piece)
        count += len(piece[1])
        held_bytes += len(piece[2])
        if count >= rows or held_bytes >= size:
            yield _batch(held, names, place)
            held, count, held_bytes = [], 0, 0
    if held:
        yield _batch(held, names, place)


def _batch(pieces: list[tuple[tuple, np.ndarray, bytes]], names: pa.Schema, place: str) -> pa.RecordBatch:
    counts = [len(places) for _, places, _ in pieces]
    owner = pa.array(np.repeat(np.arange(len(pieces)), counts))
    columns = {f.name: pa.array([p[0][i] for p in pieces], f.type).take(owner) for i, f in enumerate(names)}
    columns[place] = pa.array(np.concatenate([p[1] for p in pieces]), pa.int64())
    text = b"".join(t if t.endswith(b"\n") else t + b"\n" for _, _, t in pieces)
    return pa.RecordBatch.from_pydict(columns | {"line": _as_strings(text, sum(counts))})


# --- archives ----------------------------------------------------------------------------------


def data_entry(name: str, prefixes: list[str]) -> tuple[str, int | None] | None:
    """(element, station id) of a data entry name, None for any other entry."""
    if not name.endswith(".txt") or "_STAID" not in name[:-4]:
        return None
    element = name[:-4].split("_STAID", 1)[0]
    if element not in prefixes:
        return None
    digits = re.match(r"\+?[0-9]+$", name.split("STAID", 1)[1].split(".", 1)[0].lstrip("0"))
    number = int(digits.group()) if digits else None
    return element, number if number is not None and number <= LARGEST_STATION else None


def processing_order(entries: list[zipfile.ZipInfo], prefixes: list[str]) -> list[tuple]:
    """(info, entry number, element, station id, base) of the data entries, in processing order.

    Elements come in the order of their first entry, entries of one element in archive order.
    `base` is the number of text bytes processed before the entry.
    """
    found, rank = [], {}
    for number, info in enumerate(entries):
        named = data_entry(info.filename, prefixes)
        if named:
            rank.setdefault(named[0], len(rank))
            found.append((info, number, *named))
    found.sort(key=lambda e: (rank[e[2]], e[1]))
    ordered, base = [], 0
    for entry in found:
        ordered.append((*entry, base))
        # one spare byte keeps the bases of empty entries apart
        base += entry[0].file_size + 1
    return ordered


def usable_entries(archive: zipfile.ZipFile, prefixes: list[str], stations_file: str, marks: list[str]) -> list[tuple]:
    """The data entries of an archive in processing order; a ValueError says why it can't be used."""
    data = processing_order(archive.infolist(), prefixes)
    if not data:
        raise ValueError("no station data files in archive")
    if stations_file not in archive.NameToInfo:
        raise ValueError(f"{stations_file} not found in archive")
    if not has_country(archive, stations_file, marks):
        raise ValueError(f"no country code in {stations_file}")
    return data


def open_entry(raw, row: dict):
    """The text of an archive entry from its place in the archive; the directory isn't read again."""
    raw.seek(row["header_offset"])
    head = raw.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile(f"no entry header at {row['header_offset']} of {row['path']}")
    raw.seek(int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"), 1)
    info = zipfile.ZipInfo(row["entry"])
    info.compress_type, info.CRC = row["method"], row["crc"]
    info.compress_size, info.file_size = row["stored_bytes"], row["entry_bytes"]
    return zipfile.ZipExtFile(raw, "r", info)


def has_country(archive: zipfile.ZipFile, stations_file: str, marks: list[str]) -> bool:
    """Whether the station list names at least one two-letter country."""
    with archive.open(stations_file) as stream:
        for raw in stream:
            line = raw.decode("utf-8", "replace")
            bare = line.strip()
            if not bare or bare.startswith(("STAID", "---")) or any(m in bare for m in marks):
                continue
            parts = line.split(",")
            if len(parts) >= 3 and len(parts[2].strip().encode()) == 2:
                return True
    return False
