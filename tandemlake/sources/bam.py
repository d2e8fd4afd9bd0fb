"""BAM as a Python data source: BGZF blocks and alignment records, split and filtered, and written by tasks.

``spark.read.format("bam").load(path)`` after ``register(spark)``. A file is cut into ranges of bytes; a task finds the
first block in its range and the first record in that block, and reads the records that begin there, block by block.
Filters on flag, contig, position and mapping quality are tested on a record's fixed fields, before its name, sequence or
qualities are decoded; all others on the row. With an index beside the file (``.bai``, ``.csi``) only the stretches are read that
its bins name for the filtered region; in a file sorted by position reading ends after it.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual

from tandemlake.sources import files, parts

SCHEMA = "read_name string, flag int, chrom string, pos int, pos_end int, mapq int, cigar string, seq string, qual string, place long"
# Codes of the format.
_BASES = "=ACMGRSVTWYHKDBN"
_CIGAR = "MIDNSHP=X"
_CONSUMES_REFERENCE = frozenset("MDN=X")
_EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_OPERATION = re.compile("([0-9]+)([MIDNSHP=X])")
_BLOCK = bytes.fromhex("1f8b0804")
_FIXED = struct.Struct("<iiBBHHHiiii")
_PAIRS = [a + b for a in _BASES for b in _BASES]


def blocks(f, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Offset and contents of each BGZF block from ``at`` on; at is a block's offset."""
    held, base = b"", at
    f.seek(at)
    while True:
        if len(held) < 1 << 16:
            more = f.read(1 << 20)
            held += more
            if not held:
                return
        (extra,) = struct.unpack_from("<H", held, 10)
        fields, p = held[12 : 12 + extra], 0
        while fields[p : p + 2] != b"BC":
            p += 4 + struct.unpack_from("<H", fields, p + 2)[0]
        whole = struct.unpack_from("<H", fields, p + 4)[0] + 1
        yield base, zlib.decompress(held[12 + extra : whole - 8], -15)
        held, base = held[whole:], base + whole


def first_block(f, start: int, size: int) -> int:
    """The offset of the first block at or after start: one whose successor, or the file's end, stands where it says."""
    f.seek(start)
    window = f.read(1 << 18)
    at = window.find(_BLOCK)
    while at >= 0:
        if window[at + 12 : at + 14] == b"BC" and len(window) >= at + 18:
            after = start + at + struct.unpack_from("<H", window, at + 16)[0] + 1
            if after == size or window[after - start : after - start + 4] == _BLOCK:
                return start + at
        at = window.find(_BLOCK, at + 1)
    return size


@dataclass
class Header:
    contigs: list[str]
    sorted_: bool
    block: int  # where the first record begins
    inside: int


def read_header(path: str) -> Header:
    """Contigs, order and the place of the first record, from the file's first blocks."""
    data, starts = b"", []
    with files.opened(path) as f:
        size = f.size()
        for offset, body in blocks(f, 0, size):
            starts.append((len(data), offset))
            data += body
            if data[:4] != b"BAM\1":
                raise ValueError("not a BAM file")
            try:
                (text,) = struct.unpack_from("<i", data, 4)
                at = 8 + text
                (n,) = struct.unpack_from("<i", data, at)
                at += 4
                names = []
                for _ in range(n):
                    (length,) = struct.unpack_from("<i", data, at)
                    names.append(data[at + 4 : at + 3 + length].decode())
                    at += 8 + length
                if at > len(data):
                    continue
            except struct.error:
                continue
            k = bisect.bisect_right(starts, (at, size)) - 1
            return Header(names, b"SO:coordinate" in data[8 : 8 + text].split(b"\n")[0], starts[k][1], at - starts[k][0])
    raise ValueError("not a BAM file")


def _plausible(data: bytes, at: int, contigs: int) -> int:
    """Where the record that may begin here ends; -1 if none can, -2 if the data end before that is known."""
    if at + 36 > len(data):
        return -2
    (size,) = struct.unpack_from("<i", data, at)
    ref, pos, name, _, _, ops, _, bases, other, place, _ = _FIXED.unpack_from(data, at + 4)
    if not (-1 <= ref < contigs and -1 <= other < contigs and pos >= -1 and place >= -1 and name > 0 and bases >= 0):
        return -1
    if size < 32 + name + 4 * ops + (bases + 1) // 2 + bases:
        return -1
    if at + 36 + name <= len(data) and (data[at + 35 + name] or 0 in data[at + 36 : at + 35 + name]):
        return -1
    return at + 4 + size


def first_record(data: bytes, contigs: int, owned: int) -> int | None:
    """The first place before ``owned`` from which records follow one another to the end of the data."""
    a = np.frombuffer(data, np.uint8)
    n = min(owned, len(a) - 36)
    if n <= 0:
        return None
    word = lambda k: a[k : k + n].astype(np.int64) | a[k + 1 : k + 1 + n].astype(np.int64) << 8 | a[k + 2 : k + 2 + n].astype(np.int64) << 16 | a[k + 3 : k + 3 + n].astype(np.int64) << 24
    ref = word(4)
    likely = ((ref < contigs) | (ref == 0xFFFFFFFF)) & (word(0) >= 32) & (word(0) < 1 << 28) & (a[12 : 12 + n] > 0)
    for at in np.flatnonzero(likely).tolist():
        end, seen = at, 0
        while end >= 0 and end < len(data):
            following = _plausible(data, end, contigs)
            if following == -2:
                break
            end, seen = following, seen + 1
        if end >= 0 and seen:
            return at
    return None


_TESTS = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b}
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_EARLY = {"flag": 0, "chrom": 1, "pos": 2, "mapq": 3}


#: Bases that an index of the common form can tell apart.
_FARTHEST = 1 << 29


def bins_of(start: int, end: int, shift: int = 14, depth: int = 5) -> list[int]:
    """Numbers of the bins that may hold records over [start, end): at each level, from the whole contig down to windows of
    2**shift bases, a bin has eight of the next."""
    out, first = [], 0
    for level in range(depth + 1):
        wide = shift + 3 * (depth - level)
        out += range(first + (start >> wide), first + (max(end - 1, start) >> wide) + 1)
        first += 1 << 3 * level
    return out


def indexed_chunks(path: str, contig: int, start: int, end: int) -> list[tuple[int, int]] | None:
    """Virtual offsets (begin, end) of the stretches of a file that hold all records over [start, end) of a contig, from the
    index beside it (.bai or .csi); None without one. Stretches that meet in one block are one, so that no record is read
    twice; those that end before the first record over the region's window are left out."""
    if files.there(path + ".bai"):
        with files.opened(path + ".bai") as f:
            data = f.read()
        shift, depth, at, wide = 14, 5, 8, 0
        (contigs,) = struct.unpack_from("<i", data, 4)
    elif files.there(path + ".csi"):
        with files.opened(path + ".csi") as f:
            data = b"".join(body for _, body in blocks(f, 0, f.size()))
        shift, depth, extra = struct.unpack_from("<iii", data, 4)
        (contigs,) = struct.unpack_from("<i", data, 16 + extra)
        at, wide = 20 + extra, 8
    else:
        return None
    wanted = set(bins_of(start, min(end, 1 << shift + 3 * depth), shift, depth))
    for ref in range(contigs):
        (n,) = struct.unpack_from("<i", data, at)
        at += 4
        chunks, least, total = [], 0, n
        for _ in range(n):
            number, *first, pieces = struct.unpack_from("<IQi" if wide else "<Ii", data, at)
            at += 8 + wide
            if ref == contig and number in wanted:
                found = struct.unpack_from(f"<{2 * pieces}Q", data, at)
                # a bin of the second form tells its own first record's place
                chunks += [c for c in zip(found[::2], found[1::2], strict=True) if not first or c[1] > first[0]]
            at += 16 * pieces
        if not wide:
            (n,) = struct.unpack_from("<i", data, at)
            if ref == contig and n:
                windows = struct.unpack_from(f"<{n}Q", data, at + 4)
                least = next((w for w in windows[min(start >> 14, n - 1) :] if w), 0)
            at += 4 + 8 * n
        if ref == contig:
            if not wide and not chunks and not total and least:
                return [(least, files.length(path) << 16)]  # windows alone: where to begin
            out: list[tuple[int, int]] = []
            for a, b in sorted((max(a, least), b) for a, b in chunks if b > least):
                if out and a >> 16 <= out[-1][1] >> 16:
                    out[-1] = out[-1][0], max(out[-1][1], b)
                else:
                    out.append((a, b))
            return out
    return []


class BamReader(DataSourceReader):
    def __init__(self, path: str, size: int = files.SPLIT) -> None:
        self.path, self.size = path, size
        self.early: list[tuple[int, type, object]] = []
        self.late: list[tuple[int, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if type(f) in _TESTS and len(f.attribute) == 1 else None
            if name in _EARLY:
                self.early.append((_EARLY[name], type(f), f.value))
            elif name in _COLUMNS:
                self.late.append((_COLUMNS.index(name), type(f), f.value))
            else:
                yield f

    def _region(self, head: Header) -> tuple[int, int, int] | None:
        """Number of the contig, and first and last base (from 0, end exclusive), of the region that the filters ask for."""
        chrom = next((v for i, kind, v in self.early if i == _EARLY["chrom"] and kind is EqualTo), None)
        least = max((v for i, kind, v in self.late if i == _COLUMNS.index("pos_end") and kind in (GreaterThan, GreaterThanOrEqual)), default=None)
        most = min((v for i, kind, v in self.early if i == _EARLY["pos"] and kind in (LessThan, LessThanOrEqual)), default=None)
        if chrom not in head.contigs or (least is None and most is None):
            return None
        return head.contigs.index(chrom), max(0, (least or 1) - 1), min(max(0, most), _FARTHEST) if most is not None else _FARTHEST

    def partitions(self) -> list[files.Split]:
        out = []
        for path, size in files.listed(self.path, ".bam"):
            head = read_header(path)
            region = self._region(head)
            chunks = indexed_chunks(path, *region) if region else None
            if chunks is None:
                chunks = [((head.block << 16) | head.inside, size << 16)]
            for begin, end in chunks:
                first, last = begin >> 16, min((end >> 16) + (end & 0xFFFF > 0), size)
                out.append(_Part(path, first, min(first + self.size, last), head, begin & 0xFFFF))
                out += [_Part(path, a, min(a + self.size, last), head, None) for a in range(first + self.size, last, self.size)]
        return out

    def read(self, partition) -> Iterator[tuple]:
        head = partition.head
        names = head.contigs
        target = next((names.index(v) for i, kind, v in self.early if i == 1 and kind is EqualTo and v in names), None)
        most = min((v for i, kind, v in self.early if i == 2 and kind in (LessThan, LessThanOrEqual)), default=None)
        with files.opened(partition.path) as f:
            size = f.size()
            start = partition.start if partition.inside is not None else first_block(f, partition.start, size)
            if start >= size:
                return
            source = blocks(f, start, size)
            data, marks, owned, ended = b"", [], 0, False

            def more() -> bool:
                nonlocal data, owned, ended
                for offset, body in source:
                    marks.append((len(data), offset))
                    data += body
                    if offset < partition.end:
                        owned = len(data)
                    return True
                ended = True
                return False

            at = partition.inside
            while at is None:
                # enough data that a chance record would break off
                while not ended and len(data) - owned < 1 << 17 and more():
                    pass
                at = first_record(data, len(names), owned)
                if at is None and ended or (at is None and owned < len(data)):
                    return
            while True:
                while at + 36 > len(data) and more():
                    pass
                if at >= owned and (owned < len(data) or ended) or at + 36 > len(data):
                    return
                (length,) = struct.unpack_from("<i", data, at)
                while at + 4 + length > len(data) and more():
                    pass
                ref, pos, name_size, mapq, _, ops, flag, bases, _, _, _ = _FIXED.unpack_from(data, at + 4)
                if head.sorted_ and target is not None and most is not None and (ref > target or ref < 0 or (ref == target and pos + 1 > most)):
                    return
                early = (flag, names[ref] if ref >= 0 else None, pos + 1, mapq)
                if all(early[i] is not None and _TESTS[kind](early[i], value) for i, kind, value in self.early):
                    k = bisect.bisect_right(marks, (at, size)) - 1
                    row = _row(data, at + 36, early, name_size, ops, bases, marks[k][1] << 16 | at - marks[k][0])
                    if all(row[i] is not None and _TESTS[kind](row[i], value) for i, kind, value in self.late):
                        yield row
                at += 4 + length
                if at > 1 << 22:
                    # what has been read goes
                    k = max(0, bisect.bisect_right(marks, (at, size)) - 1)
                    cut = min(marks[k][0], owned)
                    data, marks, at, owned = data[cut:], [(a - cut, b) for a, b in marks[k:]], at - cut, owned - cut


class _Part(files.Split):
    """A split whose first record is known (inside its first block), or is to be found."""

    def __init__(self, path: str, start: int, end: int, head: Header, inside: int | None) -> None:
        super().__init__(path, start, end)
        self.head, self.inside = head, inside


def _row(data: bytes, p: int, early: tuple, name_size: int, ops: int, bases: int, place: int) -> tuple:
    """A row of SCHEMA; p is where the record's name begins."""
    flag, chrom, pos, mapq = early
    name = data[p : p + name_size - 1].decode()
    p += name_size
    cigar = [(v >> 4, _CIGAR[v & 15]) for v in struct.unpack_from(f"<{ops}I", data, p)]
    p += 4 * ops
    seq = "".join([_PAIRS[b] for b in data[p : p + (bases + 1) // 2]])[:bases]
    p += (bases + 1) // 2
    raw = data[p : p + bases]
    qual = None if raw[:1] == b"\xff" else (np.minimum(np.frombuffer(raw, np.uint8), 93) + 33).astype(np.uint8).tobytes().decode()
    span = sum(k for k, op in cigar if op in _CONSUMES_REFERENCE) or 1
    return name, flag, chrom, pos, pos - 1 + span, mapq, "".join(f"{k}{op}" for k, op in cigar) or "*", seq, qual, place


class BamWriter(parts.PartWriter):
    """Rows of read_name, flag, chrom, pos, mapq, cigar, seq and qual as BAM parts: blocks of the header, blocks of records,
    the end mark. Blocks end where records do, and a part's records begin at a block, so parts can be joined by blocks."""

    suffix = ".bam"

    def __init__(self, path: str, overwrite: bool, contigs: list[tuple[str, int]], order: str) -> None:
        super().__init__(path, overwrite)
        self.contigs, self.order = contigs, order

    def encode(self, rows: Iterator) -> Iterator[bytes]:
        yield b"".join(_blocks_of(_header(self.contigs, self.order)))
        numbers = {name: i for i, (name, _) in enumerate(self.contigs)}
        held, size = [], 0
        for r in rows:
            cigar = [(int(k), op) for k, op in _OPERATION.findall(r.cigar or "")]
            held.append(_record(r.read_name, r.flag, numbers[r.chrom] if r.chrom is not None else -1, r.pos or 0, r.mapq or 0, cigar, r.seq or "", r.qual))
            size += len(held[-1])
            if size >= 60_000:
                yield b"".join(_blocks_of(b"".join(held)))
                held, size = [], 0
        yield b"".join([*_blocks_of(b"".join(held)), _EOF])


def _records_block(f, head: Header) -> int:
    """The offset of a part's first block of records: the one after the header's last."""
    found = blocks(f, head.block, f.size())
    offset, body = next(found)
    if not head.inside:
        return offset
    if head.inside != len(body):
        raise ValueError("records begin within the header's block; such a file isn't a part")
    return next(found, (f.size() - len(_EOF), b""))[0]


def join_parts(folder: str, target: str) -> None:
    """One BAM file of a folder's parts in order: their blocks as they are, without all headers but the first and all end
    marks but the last. Bytes are copied a stretch at a time."""
    with files.created(target) as out:
        for i, (path, size) in enumerate(files.listed(folder, ".bam")):
            with files.opened(path) as f:
                start = 0 if i == 0 else _records_block(f, read_header(path))
                f.seek(start)
                left = size - len(_EOF) - start
                while left > 0:
                    piece = f.read(min(left, 1 << 22))
                    out.write(piece)
                    left -= len(piece)
        out.write(_EOF)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options["path"], int(self.options.get("splitsize", files.SPLIT)))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        """Options: path, contigs (JSON: a list of name and length) and order (of the records: unsorted, coordinate)."""
        return BamWriter(self.options["path"], overwrite, [(n, int(k)) for n, k in json.loads(self.options["contigs"])], self.options.get("order", "unsorted"))


def register(spark) -> None:
    """Makes the format known to a session and lets it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)


def _blocks_of(data: bytes) -> Iterator[bytes]:
    for i in range(0, len(data), 60_000):
        part = data[i : i + 60_000]
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(part) + z.flush()
        head = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
        yield head + body + struct.pack("<II", zlib.crc32(part), len(part))


def _header(contigs: list[tuple[str, int]], order: str = "coordinate") -> bytes:
    text = f"@HD\tVN:1.6\tSO:{order}\n".encode() + b"".join(f"@SQ\tSN:{n}\tLN:{k}\n".encode() for n, k in contigs)
    out = [b"BAM\1", struct.pack("<i", len(text)), text, struct.pack("<i", len(contigs))]
    for name, size in contigs:
        out.append(struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size))
    return b"".join(out)


def _record(name: str, flag: int, ref: int, pos: int, mapq: int, cigar: list[tuple[int, str]], seq: str, qual: str | None) -> bytes:
    codes = [_BASES.index(b) for b in seq] + [0] * (len(seq) % 2)
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
    quals = bytes(ord(c) - 33 for c in qual) if qual else b"\xff" * len(seq)
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, mapq, 4680, len(cigar), flag, len(seq), -1, -1, 0)
    body += name.encode() + b"\0" + b"".join(struct.pack("<I", k << 4 | _CIGAR.index(op)) for k, op in cigar) + packed + quals
    return struct.pack("<i", len(body)) + body


def write_index(path: str, bins: bool = True) -> None:
    """An index (.bai) beside a BAM file sorted by position, with bins or with windows alone. For fixtures: one process reads
    the file."""
    head = read_header(path)
    windows: list[dict[int, int]] = [{} for _ in head.contigs]
    chunks: list[dict[int, list[list[int]]]] = [{} for _ in head.contigs]
    reader = BamReader(path)
    open_: list[int] | None = None
    for part in reader.partitions():
        for row in reader.read(part):
            if open_ is not None:
                open_[1] = row[9]
            open_ = None
            if row[2] is not None:
                contig, start, end = head.contigs.index(row[2]), row[3] - 1, row[4]
                own = windows[contig]
                for w in range(start >> 14, ((end - 1) >> 14) + 1):
                    own[w] = min(own.get(w, row[9]), row[9])
                # the smallest bin that holds the whole record
                level = next(k for k in range(5, -1, -1) if start >> 29 - 3 * k == end - 1 >> 29 - 3 * k)
                number = ((1 << 3 * level) - 1) // 7 + (start >> 29 - 3 * level)
                mine = chunks[contig].setdefault(number, [])
                if mine and mine[-1][1] == row[9]:
                    open_ = mine[-1]
                else:
                    open_ = [row[9], 0]
                    mine.append(open_)
    if open_ is not None:
        with files.opened(path) as f:
            open_[1] = f.size() << 16
    out = [b"BAI\1", struct.pack("<i", len(windows))]
    for own, mine in zip(windows, chunks, strict=True):
        out.append(struct.pack("<i", len(mine) if bins else 0))
        for number, pieces in sorted(mine.items()) if bins else ():
            out += [struct.pack("<Ii", number, len(pieces)), *(struct.pack("<QQ", *p) for p in pieces)]
        n = max(own, default=-1) + 1
        out.append(struct.pack("<i", n) + b"".join(struct.pack("<Q", own.get(w, 0)) for w in range(n)))
    Path(path + ".bai").write_bytes(b"".join(out))


def write_bam(path: str, contigs: list[tuple[str, int]], records: list[tuple]) -> None:
    """Records (name, flag, contig index, 1-based pos, mapq, [(length, op)], seq, qual) as one BAM file, for fixtures."""
    data = _header(contigs) + b"".join(_record(*r) for r in records)
    Path(path).write_bytes(b"".join([*_blocks_of(data), _EOF]))
