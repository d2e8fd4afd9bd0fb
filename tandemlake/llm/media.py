"""Media columns: GIF.

``store_gif`` writes bytes as the 8-bit samples of an animated GIF: frames of 24 x 24 palette indices in LZW code streams
with a growing table. ``decode_gifs`` reads any GIF: code streams, global and local palettes, interlacing, transparency,
disposal, and frames with their times. ``media_columns`` makes columns of what it reads.

A code stream is decoded without a loop over its codes. The table's entry j is the string of code j and one more byte, so
an entry is a place in the output and a length; lengths follow from each code's chain of entries, and a byte that copies
another one leads to a literal, both by pointer doubling over all streams of a batch at once.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import documents, in_chunks, table

SIDE = 24
PIXELS = SIDE * SIDE
FILLER = 255
DELAY = 10  # hundredths of a second
MOST_CODES = 4096


def pad(payload: bytes) -> bytes:
    """The payload with filler up to a positive multiple of a frame's samples."""
    return payload + bytes([FILLER]) * (-len(payload) % PIXELS if payload else PIXELS)


def _width(t: np.ndarray, least: int) -> np.ndarray:
    """Bits of the t-th code after a clear code: the table has 2^least + 2 codes, and one more from each code but the first."""
    entries = (1 << least) + 2 + np.maximum(t - 1, 0)
    return np.clip(np.floor(np.log2(entries)).astype(np.int64) + 1, least + 1, 12)


def _phrases(pixels: bytes) -> list[int]:
    """LZW codes of at most 3800 pixels of 8 bits: the longest known string each, then the table grows by it and the next pixel."""
    known: dict[int, int] = {}
    code, free, out = pixels[0], 258, []
    for c in pixels[1:]:
        key = code << 8 | c
        longer = known.get(key)
        if longer is None:
            out.append(code)
            known[key] = free
            free += 1
            code = c
        else:
            code = longer
    out.append(code)
    return out


#: The global palette: three bits of red and green and two of blue, the first ones of the index first.
_INDEX = np.arange(256)
PALETTE = np.column_stack([(_INDEX >> 5) * 255 // 7, (_INDEX >> 2 & 7) * 255 // 7, (_INDEX & 3) * 255 // 3]).astype(np.uint8)
_HEAD = b"GIF89a" + struct.pack("<HHBBB", SIDE, SIDE, 0xF7, 0, 0) + PALETTE.tobytes()
_FRAME = b"\x21\xf9\x04" + struct.pack("<BHBB", 1 << 2, DELAY, 0, 0) + b"\x2c" + struct.pack("<HHHHB", 0, 0, SIDE, SIDE, 0) + b"\x08"


def store_gif(payloads: list[bytes]) -> list[bytes]:
    """A GIF for each padded payload: a frame of 24 x 24 samples for each 576 bytes."""
    frames = [p[i : i + PIXELS] for p in payloads for i in range(0, len(p), PIXELS)]
    codes = [_phrases(f) for f in frames]
    # clear code, the phrases, end code
    count = np.array([len(c) + 2 for c in codes])
    flat = np.concatenate([np.array([256, *c, 257], np.uint32) for c in codes]) if codes else np.zeros(0, np.uint32)
    first = np.cumsum(count) - count
    nth = np.arange(len(flat)) - np.repeat(first, count)
    width = np.where(nth == 0, 9, _width(nth - 1, 8))
    place = np.cumsum(width) - width
    place -= np.repeat(place[first], count)
    sizes = (place[first + count - 1] + width[first + count - 1] + 7) // 8 if codes else count
    begin = np.cumsum(sizes) - sizes
    # a code of at most 12 bits touches three bytes; two codes share no bits, so sums are unions
    low = np.repeat(begin, count) + place // 8
    value = flat << (place % 8).astype(np.uint32)
    body = np.zeros(int(sizes.sum()) + 3, np.uint32)
    for j in range(3):
        body += np.bincount(low + j, weights=(value >> np.uint32(8 * j) & np.uint32(255)), minlength=len(body)).astype(np.uint32)
    streams = body.astype(np.uint8).tobytes()
    out, at = [], 0
    for p in payloads:
        parts = [_HEAD]
        for k in range(at, at + len(p) // PIXELS):
            parts.append(_FRAME)
            for i in range(int(begin[k]), int(begin[k] + sizes[k]), 255):
                cut = streams[i : min(i + 255, int(begin[k] + sizes[k]))]
                parts += [bytes([len(cut)]), cut]
            parts.append(b"\0")
        at += len(p) // PIXELS
        out.append(b"".join([*parts, b"\x3b"]))
    return out


def _doubled(pointer: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Where each chain of pointers ends (at one that points at itself), and the sum of weights along it."""
    while True:
        further = pointer[pointer]
        if weight is not None:
            weight = weight + weight[pointer]
        if (further == pointer).all():
            return pointer, weight
        pointer = further


def lzw_decode(streams: list[bytes], least: int, pixels: list[int]) -> list[np.ndarray]:
    """The pixels of code streams whose literals have ``least`` bits. A stream that breaks off or has an impossible code
    gives fewer pixels than asked for."""
    clear, end = 1 << least, (1 << least) + 1
    out: list[list[np.ndarray]] = [[] for _ in streams]
    wanted = np.array(pixels, np.int64)
    data = np.frombuffer(b"".join(streams) + b"\0\0\0", np.uint8).astype(np.uint32)
    sizes = np.array([len(s) for s in streams], np.int64)
    base = (np.cumsum(sizes) - sizes) * 8
    last = base + sizes * 8
    at = base.copy()
    live = np.flatnonzero(wanted > 0)
    while len(live):
        # the codes from here to the next clear or end code, as if there were none
        most = int((last[live] - at[live]).max()) // (least + 1) + 1
        t = np.arange(most)
        width = _width(t, least)
        offset = np.cumsum(width) - width
        bit = at[live][:, None] + offset
        inside = bit + width <= last[live][:, None]
        byte = np.where(inside, bit >> 3, 0)
        codes = (data[byte] | data[byte + 1] << np.uint32(8) | data[byte + 2] << np.uint32(16)) >> (bit & 7).astype(np.uint32)
        codes = (codes & ((1 << width) - 1).astype(np.uint32)).astype(np.int64)
        stops = ~inside | (codes == clear) | (codes == end) | (codes > np.minimum(clear + 1 + t, MOST_CODES - 1)) | ((t == 0) & (codes > end))
        stops[:, -1] = True
        count = stops.argmax(1)
        stop = codes[np.arange(len(live)), count]
        goes_on = inside[np.arange(len(live)), count] & (stop == clear)
        at[live] += offset[count] + width[count]
        owner = np.repeat(np.arange(len(live)), count)
        if len(owner):
            first = np.cumsum(count) - count
            code = codes[owner, np.arange(len(owner)) - first[owner]]
            literal = code < clear
            me = np.arange(len(code))
            parent = np.where(literal, me, first[owner] + code - clear - 2)
            length = 1 + _doubled(parent, (~literal).astype(np.int64))[1]
            # bytes beyond those wanted needn't be made
            begin = np.cumsum(length) - length
            begin_own = begin - begin[first[owner]]
            used = begin_own < wanted[live][owner]
            code, literal, length, parent = code[used], literal[used], length[used], (np.cumsum(used) - 1)[parent[used]]
            begin = np.cumsum(length) - length
            phrase = np.repeat(np.arange(len(code)), length)
            x = np.arange(len(phrase))
            source, _ = _doubled(np.where(literal[phrase], x, begin[parent[phrase]] + x - begin[phrase]))
            made = code[phrase[source]].astype(np.uint8)
            ends = np.cumsum(np.bincount(owner[used], weights=length, minlength=len(live)).astype(np.int64))
            for i, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True)):
                part = made[a:b][: wanted[live[i]]]
                out[live[i]].append(part)
                wanted[live[i]] -= len(part)
        live = live[goes_on & (wanted[live] > 0)]
    return [np.concatenate(p) if p else np.zeros(0, np.uint8) for p in out]


@dataclass
class Frame:
    start_ms: int
    duration_ms: int
    disposal: int
    indices: np.ndarray  # the block's own samples, row by row
    canvas: np.ndarray  # height x width x 4, after this frame is drawn


@dataclass
class _Block:
    """An image block as it stands in the file."""

    place: tuple[int, int, int, int]  # x, y, width, height
    interlaced: bool
    palette: np.ndarray | None
    least: int
    stream: bytes
    disposal: int
    duration_ms: int
    clear: int  # transparent index, -1 for none


class Damaged(ValueError):
    """Bytes that aren't a whole GIF."""


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise Damaged("the file ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def palette(self, packed: int) -> np.ndarray | None:
        return np.frombuffer(self.take(3 << (packed & 7) + 1), np.uint8).reshape(-1, 3) if packed & 0x80 else None

    def blocks(self) -> bytes:
        parts = []
        while n := self.take(1)[0]:
            parts.append(self.take(n))
        return b"".join(parts)


def parse_gif(data: bytes) -> tuple[int, int, np.ndarray | None, list[_Block]]:
    """Width, height, global palette and image blocks. Damaged if the bytes aren't a GIF with its trailer."""
    r = _Reader(data)
    if r.take(6) not in (b"GIF87a", b"GIF89a"):
        raise Damaged("not a GIF")
    width, height, packed, _, _ = struct.unpack("<HHBBB", r.take(7))
    common = r.palette(packed)
    control, images = (0, 0, -1), []
    while (kind := r.take(1)) != b"\x3b":
        if kind == b"\x21":
            label, body = r.take(1), r.blocks()
            if label == b"\xf9" and len(body) >= 4:
                control = (body[0] >> 2 & 7, struct.unpack_from("<H", body, 1)[0] * 10, body[3] if body[0] & 1 else -1)
        elif kind == b"\x2c":
            *place, packed = struct.unpack("<HHHHB", r.take(9))
            own = r.palette(packed)
            least = r.take(1)[0]
            if not 1 <= least <= 8:
                raise Damaged("no such code size")
            images.append(_Block(tuple(place), bool(packed & 0x40), own, least, r.blocks(), *control))
            control = (0, 0, -1)
        else:
            raise Damaged("no such block")
    return width, height, common, images


_GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(-1, 3)


def _draw(width: int, height: int, common: np.ndarray | None, decoded: Iterator[tuple[_Block, np.ndarray]]) -> Iterator[Frame]:
    """The frames one after another: indices through local or else global palettes, but for transparent ones, on a canvas that
    disposal 2 clears in the frame's area and 3 restores."""
    canvas, clock = np.zeros((height, width, 4), np.uint8), 0
    for image, indices in decoded:
        x, y, w, h = image.place
        grid = indices[: w * h].reshape(h, w)
        if image.interlaced and h:
            straight = np.empty_like(grid)
            straight[[*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]] = grid
            grid = straight
        colours = image.palette if image.palette is not None else common if common is not None else _GREY
        before = canvas
        canvas = canvas.copy()
        area = canvas[y : y + h, x : x + w]
        shown = grid[: area.shape[0], : area.shape[1]]
        rgba = np.full((*shown.shape, 4), 255, np.uint8)
        rgba[..., :3] = colours.take(shown, axis=0, mode="clip")
        if image.clear < 0:
            area[:] = rgba
        else:
            drawn = shown != image.clear
            area[drawn] = rgba[drawn]
        yield Frame(clock, image.duration_ms, image.disposal, grid.reshape(-1), canvas)
        clock += image.duration_ms
        if image.disposal == 2:
            canvas = canvas.copy()
            canvas[y : y + h, x : x + w] = 0
        elif image.disposal == 3:
            canvas = before


#: Pixels of a screen or an image above which a file counts as damaged, and pixels that are decoded at once.
MOST_PIXELS, DECODED_PIXELS = 1 << 22, 1 << 23


def _area(image: _Block) -> int:
    return image.place[2] * image.place[3]


def _decode(images: list[_Block]) -> Iterator[tuple[_Block, np.ndarray]]:
    """Images with their indices, in order, as many at once as DECODED_PIXELS allow."""
    at = 0
    while at < len(images):
        end, pixels = at, 0
        while end < len(images) and (end == at or pixels + _area(images[end]) <= DECODED_PIXELS):
            pixels += _area(images[end])
            end += 1
        part, found = images[at:end], {}
        for least in {image.least for image in part}:
            mine = [i for i, image in enumerate(part) if image.least == least]
            found |= zip(mine, lzw_decode([part[i].stream for i in mine], least, [_area(part[i]) for i in mine]), strict=True)
        for i, image in enumerate(part):
            if len(found[i]) < _area(image):
                raise Damaged("a code stream ends early")
            yield image, found[i]
        at = end


def gif_frames(files: list[bytes | None], most_pixels: int = MOST_PIXELS) -> Iterator[Iterator[Frame] | None]:
    """For each file in order its frames, one at a time; None for a null or damaged file, or one whose screen or an image of it
    has more than most_pixels. Streams of many small files are decoded together, those of a large one in parts, after a pass
    that finds whether it is whole; so memory holds a few screens and DECODED_PIXELS, whatever a header claims."""
    parsed: list = []
    for data in files:
        try:
            p = parse_gif(data) if data is not None else None
            parsed.append(p if p is None or max(p[0] * p[1], *map(_area, p[3]), 0) <= most_pixels else None)
        except Damaged:
            parsed.append(None)
    at = 0
    while at < len(parsed):
        end, pixels = at, 0
        while end < len(parsed):
            more = sum(map(_area, parsed[end][3])) if parsed[end] is not None else 0
            if end > at and pixels + more > DECODED_PIXELS:
                break
            pixels += more
            end += 1
        yield from _group(parsed[at:end], pixels > DECODED_PIXELS)
        at = end


def _group(parsed: list, large: bool) -> Iterator[Iterator[Frame] | None]:
    for p in parsed if large else ():
        try:
            for _ in _decode(p[3]):
                pass
        except Damaged:
            yield None
        else:
            yield _draw(*p[:3], _decode(p[3]))
    if large:
        return
    images = [image for p in parsed if p is not None for image in p[3]]
    found: dict[int, np.ndarray] = {}
    for least in {image.least for image in images}:
        mine = [i for i, image in enumerate(images) if image.least == least]
        found |= zip(mine, lzw_decode([images[i].stream for i in mine], least, [_area(images[i]) for i in mine]), strict=True)
    at = 0
    for p in parsed:
        if p is None:
            yield None
            continue
        own = list(zip(p[3], [found[at + i] for i in range(len(p[3]))], strict=True))
        at += len(p[3])
        yield _draw(*p[:3], iter(own)) if all(len(x) >= _area(image) for image, x in own) else None


def decode_gifs(files: list[bytes | None]) -> list[list[Frame] | None]:
    """All frames of a few files at once; None for a null or damaged one."""
    return [None if frames is None else list(frames) for frames in gif_frames(files)]


def _runs(frames: Iterator[Frame], most: int = 1 << 18) -> Iterator[list[Frame]]:
    """The frames in lists of about ``most`` pixels of canvas and image."""
    held, pixels = [], 0
    for f in frames:
        held.append(f)
        pixels += f.canvas.size // 4 + len(f.indices)
        if pixels >= most:
            yield held
            held, pixels = [], 0
    if held:
        yield held


def histograms(frames: list[Frame]) -> np.ndarray:
    """For each frame the opaque pixels of 64 colours (two bits of each channel)."""
    if not frames:
        return np.zeros((0, 64), np.int64)
    shown = np.stack([f.canvas.reshape(-1, 4) for f in frames])
    bins = (shown[..., 0] >> 6 << 4 | shown[..., 1] >> 6 << 2 | shown[..., 2] >> 6).astype(np.int64) + 64 * np.arange(len(frames))[:, None]
    return np.bincount(bins[shown[..., 3] > 0], minlength=64 * len(frames)).reshape(-1, 64)


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the text) and media, a GIF that holds the whole text.

    A null text is an empty one: one frame of the filler. Equal texts have equal media; repeated rows stay."""

    def store(batch: pd.DataFrame) -> pd.DataFrame:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch["text"]]
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": [len(r) for r in raw], "media": store_gif([pad(r) for r in raw])})

    return documents(docs, "doc_id", "text").mapInPandas(in_chunks(store), "doc_id long, n_bytes long, media binary")


_COLUMNS = [
    ("doc_id", "long"), ("n_bytes", "long"), ("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"),
    ("feature", "string"), ("n_frames", "long"), ("duration_ms", "long"), ("histogram", "array<long>"),
]


def media_columns(media: DataFrame) -> DataFrame:
    """What the decoder reads in the stored bytes (doc_id, n_bytes, media): digests of the payload (all frames' samples),
    number of frames, their time, and the histogram of 64 colours over all of them, also rendered in ``feature``.

    A null file gives nulls in all but doc_id and n_bytes; a damaged one, or one of too large a screen (MOST_PIXELS), has
    media_bytes and media_sha256 besides. Frames are drawn and counted one after another."""

    def read(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        files = [None if d is None else bytes(d) for d in batch["media"]]
        for doc_id, n, data, frames in zip(batch["doc_id"], batch["n_bytes"], files, gif_frames(files), strict=True):
            stored = (None, None) if data is None else (len(data), hashlib.sha256(data).hexdigest())
            if frames is None:
                rows.append((doc_id, n, None, None, None, *stored, None, None, None, None))
                continue
            digest, tail, size, count, ms, bins = hashlib.sha256(), b"", 0, 0, 0, np.zeros(64, np.int64)
            for some in _runs(frames):
                part = b"".join(f.indices.tobytes() for f in some)
                digest.update(part)
                tail, size, count, ms = (tail + part[-32:])[-32:], size + len(part), count + len(some), ms + sum(f.duration_ms for f in some)
                bins += histograms(some).sum(0)
            feature = f"frames={count};ms={ms};hist=" + ",".join(map(str, bins.tolist()))
            rows.append((doc_id, n, size, digest.hexdigest(), zlib.crc32(tail), *stored, feature, count, ms, bins.tolist()))
        out = pd.DataFrame(rows, columns=[c for c, _ in _COLUMNS])
        return out.astype({c: "Int64" for c, kind in _COLUMNS if kind == "long"})

    return media.select("doc_id", "n_bytes", "media").mapInPandas(in_chunks(read, "media", 1 << 19), ", ".join(" ".join(c) for c in _COLUMNS))


def frames_table(media: DataFrame) -> DataFrame:
    """One row for each frame of any GIF: doc_id, frame, start_ms, duration_ms, disposal, rgba (the canvas) and histogram
    (64 colours: two bits of each channel, opaque pixels). Null and damaged files have no rows."""

    columns = ["doc_id", "frame", "start_ms", "duration_ms", "disposal", "rgba", "histogram"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for batch in in_chunks(lambda b: b, "media", 1 << 19)(batches):
            for doc_id, frames in zip(batch["doc_id"], gif_frames([None if d is None else bytes(d) for d in batch["media"]]), strict=True):
                for i, f in enumerate(frames or ()):
                    rows.append((doc_id, i, f.start_ms, f.duration_ms, f.disposal, f.canvas.tobytes(), histograms([f])[0].tolist()))
                    held += f.canvas.nbytes
                    if held > 4 * DECODED_PIXELS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
        yield pd.DataFrame(rows, columns=columns)

    return media.select("doc_id", "media").mapInPandas(read, "doc_id long, frame int, start_ms long, duration_ms long, disposal int, rgba binary, histogram array<long>")


def op10_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(to_media(table(spark, sf_dir, "documents")))


QUERIES = {"op10_gif_media": op10_gif_media}
ORACLES: dict[str, str] = {}
