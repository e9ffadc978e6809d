"""A Spark data source for record dumps of any size: plain, or compressed as zstd frames (gzip and bzip2 as one stream).

A file is cut into byte ranges, one for each task. A task owns the frames that begin in its range, found by their magic number and
verified along their block headers, and the records whose separator begins in those frames' text; it reads on into the next frames until
its last record is complete. So frames may be cut anywhere, also within a record or a separator. Text is
decompressed and handed on in pieces, whatever the size of a file, a frame or a range. A file that was cut short gives
what can be decompressed, its last, broken record included.
"""

from __future__ import annotations

import bz2
import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Begin of a zstd frame, and of one to be skipped but for its last four bits (fixed values of the format).
MAGIC = b"\x28\xb5\x2f\xfd"
_SKIPPED = b"\x2a\x4d\x18"
_BLOCK = 128 << 10
#: Blocks after which a frame's begin counts as verified.
_ENOUGH = 64
_READ = 64 << 10
#: Bytes of text of a batch.
_BATCH = 2 << 20


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _skips(head: bytes) -> bool:
    return len(head) >= 4 and head[1:4] == _SKIPPED and head[0] >> 4 == 5


def _at(f, pos: int, n: int) -> bytes:
    f.seek(pos)
    return f.read(n)


def _begins(f, pos: int, size: int) -> bool:
    """Whether a frame begins at pos, where a magic number stands: its blocks' headers must be possible, up to its end and another frame, or for long enough."""
    import zstandard

    head = _at(f, pos, 18)
    if _skips(head):  # four bytes alone are common in compressed data: its end must be the file's, or another frame's begin
        end = pos + 8 + int.from_bytes(head[4:8], "little")
        return len(head) >= 8 and (end == size or end + 4 <= size and (_at(f, end, 4) == MAGIC or _skips(_at(f, end, 4))))
    try:
        at, checked = pos + zstandard.frame_header_size(head), zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError:
        return False
    for _ in range(_ENOUGH):
        if at + 3 > size:
            break
        block = int.from_bytes(_at(f, at, 3), "little")
        last, kind, n = block & 1, block >> 1 & 3, block >> 3
        if kind == 3 or n > _BLOCK:
            return False
        at += 3 + (1 if kind == 1 else n)
        if last:
            at += 4 * checked
            return at >= size or _starts(_at(f, at, 4))
    if at < size:
        return True
    try:  # cut short: what there is must decompress
        zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj().decompress(_at(f, pos, 1 << 20))
    except zstandard.ZstdError:
        return False
    return True


def _starts(head: bytes) -> bool:
    """A frame's first bytes, or what is left of them."""
    return MAGIC.startswith(head[:4]) or len(head) < 4 or _skips(head)


def _first_frame(f, start: int, end: int, size: int) -> int | None:
    """The first frame that begins in [start, end); None if there is none."""
    if start == 0:
        return 0
    pos = start
    while pos < end:
        data = _at(f, pos, min(1 << 20, end - pos) + 3)
        here = 0
        while here < len(data) - 3:
            found = [i for i in (data.find(MAGIC, here), data.find(_SKIPPED, here + 1) - 1) if i >= here]
            if not found:
                break
            here = min(found)
            if pos + here < end and (data[here : here + 4] == MAGIC or _skips(data[here : here + 4])) and _begins(f, pos + here, size):
                return pos + here
            here += 1
        pos += 1 << 20
    return None


def _zstd(f, start: int, end: int, size: int) -> Iterator[tuple[bytes, bool]]:
    """(text, whether it is of a frame that begins before end) from the first frame at or after start on, in pieces, up to the file's end."""
    import zstandard

    pos = _first_frame(f, start, end, size)
    while pos is not None and pos < size:
        own = pos < end
        head = _at(f, pos, 8)
        if _skips(head):
            pos += 8 + int.from_bytes(head[4:8].ljust(4, b"\0"), "little")
            continue
        if len(head) < 4:
            return
        frame, f_pos = zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj(write_size=_READ), pos
        while not frame.eof:
            data = _at(f, f_pos, _READ)
            if not data:
                return
            f_pos += len(data)
            text = frame.decompress(data)
            if text:
                yield text, own
        pos = f_pos - len(frame.unused_data)


def _plain(f, start: int, end: int, size: int) -> Iterator[tuple[bytes, bool]]:
    pos = start
    while pos < size:
        data = _at(f, pos, min(1 << 20, end - pos) if pos < end else _READ)
        yield data, pos < end
        pos += len(data)


def _stream(f) -> Iterator[tuple[bytes, bool]]:
    """A decompressing file object that may end too early."""
    while True:
        try:
            data = f.read(1 << 20)
        except EOFError:
            return
        if not data:
            return
        yield data, True


def cut_records(pieces: Iterator[tuple[bytes, bool]], sep: bytes, whole: bool) -> Iterator[tuple[bytes, bool]]:
    """(record without its separator, whether it is the file's first) of those that begin in owned pieces, which come first. whole: the pieces begin with the file."""
    rest, skipping, first, looked, owned = b"", not whole, whole, 0, 0
    for text, own in pieces:
        if own:
            rest += text
            i = rest.find(sep, max(0, looked - len(sep)))
            if i < 0:
                if skipping:
                    rest = rest[1 - len(sep) :] if len(sep) > 1 else b""
                looked = owned = len(rest)
                continue
            parts = (rest if not skipping else rest[i:]).split(sep)
            rest = parts.pop()
            for p in parts[1:] if skipping else parts:
                yield p, first
                first = False
            skipping, looked = False, 0
            owned = len(rest)
            continue
        rest += text
        while True:
            i = rest.find(sep, max(0, looked - len(sep)))
            if i < 0 or i >= owned:
                break
            if not skipping:  # a separator that begins in an owned piece and ends in this one
                yield rest[:i], first
                first = False
            rest, skipping, looked = rest[i + len(sep) :], False, 0
            owned = 0
        if i >= 0:
            rest = rest[:i]
            break
        if skipping and len(rest) >= owned + len(sep):
            return
        looked = len(rest)
    if not skipping and rest.strip():
        yield rest, first


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int):
        self.path, self.start, self.end, self.size = path, start, end, size


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitbytes", 64 << 20))
        self.sep = options.get("separator", "\n\n[Event ").encode()

    def partitions(self) -> list[_Range]:
        from pyarrow import fs

        out = []
        for path in self.path.split(","):
            system, inner = _file_system(path)
            info = system.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
            for x in sorted((x for x in found if x.type == fs.FileType.File and x.size and not x.base_name.startswith(("_", "."))), key=lambda x: x.path):
                step = x.size if x.path.endswith((".gz", ".bz2")) else self.split
                out += [_Range(path if x is info else f"{path.rstrip('/')}{x.path[len(inner.rstrip('/')):]}", i, min(i + step, x.size), x.size) for i in range(0, x.size, step)]
        return out or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        system, inner = _file_system(part.path)
        with system.open_input_file(inner) as f:
            if inner.endswith(".zst"):
                pieces = _zstd(f, part.start, part.end, part.size)
            elif inner.endswith((".gz", ".bz2")):
                pieces = _stream((gzip.open if inner.endswith(".gz") else bz2.open)(f, "rb"))
            else:
                pieces = _plain(f, part.start, part.end, part.size)
            head, held, size = self.sep.lstrip(b"\n"), [], 0
            for record, first in cut_records(pieces, self.sep, part.start == 0):
                if not record.strip():
                    continue
                held.append((record if first else head + record).decode("utf-8", "replace"))
                size += len(record)
                if size > _BATCH:
                    yield self._batch(held, part.path)
                    held, size = [], 0
            if held:
                yield self._batch(held, part.path)

    @staticmethod
    def _batch(texts: list[str], path: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([path] * len(texts), pa.string())], ["value", "file"])


class Dump(DataSource):
    """Options: path (a file, a folder, or several with commas), separator, splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "tickmill_dump"

    def schema(self) -> str:
        return "value string, file string"

    def reader(self, schema) -> _Reader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_records(spark: SparkSession, path: str, separator: str = "\n\n[Event ", split_bytes: int = 64 << 20) -> DataFrame:
    """(value, file) of each record of a dump; what of the separator isn't a line feed begins the next record. Blank records are left out."""
    spark.dataSource.register(Dump)
    return spark.read.format("tickmill_dump").option("separator", separator).option("splitBytes", split_bytes).load(path)
