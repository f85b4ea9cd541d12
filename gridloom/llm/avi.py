"""Texts as AVI motion-JPEG clips: payloads stored as frames, read back through the RIFF index, and shots told by histograms.

A payload is the UTF-8 bytes of a text, filled up with bytes 255 to frames of 576.  A frame is a baseline JPEG in grey of
24 by 24 blocks; each block is flat and holds one byte as its DC coefficient (quantiser 8, so DC / 8 + 128 is the value of
all its 64 samples), which makes the format lossless: its unit is the block.  Reading parses the RIFF chunks, follows idx1
to the frames and decodes their Huffman code, all frames of a group in step; a frame that doesn't begin with the writer's
tables goes through a whole baseline decoder, and its blocks' mean samples are the values.  A shot ends where the histogram difference of
neighbouring frames exceeds an adaptive threshold: the mean and CUT times the deviation of the differences in the WINDOW
frames before it, and FLOOR at least.  Frames last 1 / RATE seconds, so shots are timed clips.

Defined results: a null or empty text has one frame of bytes 255 and one clip; texts of any length are stored whole, and
frames are coded GROUP at a time, so that memory grows only with the stored file; equal texts give equal files; repeated
rows are stored each for itself; of equal differences none ends a shot unless all do; an empty table gives no rows; other columns aren't read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import common, jpeg

SIDE = 24
FRAME = SIDE * SIDE
PIXELS = SIDE * 8
RATE = 25
#: Frames that are coded together, and those of a batch of texts.
GROUP = 2048
WINDOW, CUT, FLOOR = 8, 3.0, 0.25
BINS = 16
#: Sizes of DC differences by the number of bits they take; each has a code of 4 bits, so that the codes are 0 to 11.
SIZES = 12


def jpeg_head() -> bytes:
    """All of a frame before its scan data: the same for every frame."""
    quantiser = b"\xff\xdb" + struct.pack(">HB", 67, 0) + bytes([8]) + bytes([1]) * 63
    frame = b"\xff\xc0" + struct.pack(">HBHHBBBB", 11, 8, PIXELS, PIXELS, 1, 1, 0x11, 0)
    dc = b"\xff\xc4" + struct.pack(">HB", 19 + SIZES, 0x00) + bytes([0, 0, 0, SIZES] + [0] * 12) + bytes(range(SIZES))
    ac = b"\xff\xc4" + struct.pack(">HB", 20, 0x10) + bytes([1] + [0] * 15) + b"\x00"
    scan = b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0x00, 0, 63, 0)
    return b"\xff\xd8" + quantiser + frame + dc + ac + scan


HEAD = jpeg_head()
TAIL = b"\xff\xd9"


def padded(text: str | None) -> tuple[bytes, int]:
    """The payload of a text, and its length without the filling."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % FRAME or (FRAME if not raw else 0)), len(raw)


def scans(frames: np.ndarray) -> list[bytes]:
    """Entropy-coded data of each frame (rows of FRAME bytes)."""
    value = frames.astype(np.int64) - 128
    diff = np.diff(value, axis=1, prepend=0)
    size = np.ceil(np.log2(np.abs(diff) + 1)).astype(np.int64)
    extra = np.where(diff < 0, diff + (1 << size) - 1, diff)
    # Code of the size, the difference, and the one bit 0 that ends a block without AC coefficients.
    code, length = ((size << size) | extra) << 1, size + 5
    ends = length.cumsum(axis=1)
    n_bytes = (ends[:, -1] + 7) >> 3
    base = np.concatenate(([0], n_bytes.cumsum()[:-1]))
    at = (ends - length + (base << 3)[:, None]).ravel()
    out = np.zeros(int(n_bytes.sum()) + 4, np.int64)
    shifted = code.ravel() << (24 - length.ravel() - (at & 7))
    for k in range(3):
        out += np.bincount((at >> 3) + k, (shifted >> (16 - 8 * k)) & 255, len(out)).astype(np.int64)  # codes share bytes, not bits
    free = (n_bytes << 3) - ends[:, -1]
    last = base + n_bytes - 1
    out[last] |= (1 << free) - 1  # the rest of the last byte is filled with ones
    data = out.astype(np.uint8).tobytes()
    return [data[a : a + n].replace(b"\xff", b"\xff\x00") for a, n in zip(base.tolist(), n_bytes.tolist(), strict=True)]


def unscanned(data: list[bytes]) -> np.ndarray:
    """The FRAME bytes of each scan: all are decoded in step, one block after the other."""
    plain = [d.replace(b"\xff\x00", b"\xff") for d in data]
    lengths = np.array([len(p) for p in plain])
    joined = np.frombuffer(b"".join(plain) + b"\0" * 4, np.uint8).astype(np.uint32)
    # 32 bits from each byte on
    words = (joined[:-3] << 24) | (joined[1:-2] << 16) | (joined[2:-1] << 8) | joined[3:]
    words = words.astype(np.int64)
    at = (np.concatenate(([0], lengths.cumsum()[:-1])) << 3).astype(np.int64)
    diff = np.empty((len(plain), FRAME), np.int64)
    for k in range(FRAME):
        seen = (words[at >> 3] << (at & 7)) & 0xFFFFFFFF
        size = seen >> 28
        bits = (seen >> (28 - size)) & ((1 << size) - 1)
        diff[:, k] = np.where(bits < (1 << size >> 1), bits - (1 << size) + 1, bits)
        at += size + 5
    return (diff.cumsum(axis=1) + 128).astype(np.uint8)


def chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def avi(frames: list[bytes]) -> bytes:
    """A RIFF file of JPEG frames with its index."""
    n = len(frames)
    main = struct.pack("<14I", 1_000_000 // RATE, 0, 0, 0x10, n, 0, 1, 0, PIXELS, PIXELS, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, RATE, 0, n, 0, 0xFFFFFFFF, 0, 0, 0, PIXELS, PIXELS)
    image = struct.pack("<IiiHH4sIiiII", 40, PIXELS, PIXELS, 1, 8, b"MJPG", PIXELS * PIXELS, 0, 0, 0, 0)
    head = chunk(b"LIST", b"hdrl" + chunk(b"avih", main) + chunk(b"LIST", b"strl" + chunk(b"strh", stream) + chunk(b"strf", image)))
    chunks, index, at = [b"movi"], [], 4
    for f in frames:
        c = chunk(b"00dc", f)
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        chunks.append(c)
        at += len(c)
    return chunk(b"RIFF", b"AVI " + head + chunk(b"LIST", b"".join(chunks)) + chunk(b"idx1", b"".join(index)))


def riff(data: bytes) -> dict[bytes, list[tuple[int, int]]]:
    """Start and length of the content of every chunk and list in a RIFF file, by name."""
    out: dict[bytes, list[tuple[int, int]]] = {}
    open_ = [(0, len(data))]
    while open_:
        at, end = open_.pop()
        while at + 8 <= end:
            name, length = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            if at + 8 + length > len(data):
                raise ValueError("a chunk ends beyond the file")
            if name in (b"RIFF", b"LIST"):
                out.setdefault(data[at + 8 : at + 12], []).append((at + 12, length - 4))
                if data[at + 8 : at + 12] != b"movi":  # frames are found by the index
                    open_.append((at + 12, at + 8 + length))
            else:
                out.setdefault(name, []).append((at + 8, length))
            at += 8 + length + (length & 1)
    return out


def read_frames(data: bytes) -> list[bytes]:
    """The JPEG frames that the index names, in its order."""
    chunks = riff(data)
    start, length = chunks[b"idx1"][0]
    movi = chunks[b"movi"][0][0] - 4
    out = []
    for at in range(start, start + length, 16):
        name, _, place, size = struct.unpack_from("<4sIII", data, at)
        if name == b"00dc":
            out.append(data[movi + place + 8 : movi + place + 8 + size])
    return out


def scan_data(frame: bytes) -> bytes:
    """The entropy-coded data of a frame that begins with HEAD."""
    return frame[len(HEAD) : -len(TAIL)]


def stored(payloads: list[bytes]) -> list[bytes]:
    """The AVI file of each payload."""
    frames = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME)
    coded = [HEAD + s + TAIL for a in range(0, len(frames), GROUP) for s in scans(frames[a : a + GROUP])]
    out, at = [], 0
    for p in payloads:
        n = len(p) // FRAME
        out.append(avi(coded[at : at + n]))
        at += n
    return out


def read_back(files: list[bytes]) -> list[np.ndarray]:
    """The frames of each file, as rows of bytes: frames that begin as the writer's do are decoded in step, any others one by one."""
    coded = [read_frames(f) for f in files]
    every = [j for c in coded for j in c]
    frames, own = np.empty((len(every), FRAME), np.uint8), [k for k, j in enumerate(every) if j.startswith(HEAD)]
    for a in range(0, len(own), GROUP):
        frames[own[a : a + GROUP]] = unscanned([scan_data(every[k]) for k in own[a : a + GROUP]])
    for k in set(range(len(every))).difference(own):  # with other tables, coefficients or markers
        blocks = jpeg.block_means(every[k])
        if blocks.shape != (SIDE, SIDE):
            raise ValueError(f"a frame has {blocks.shape} blocks, not {SIDE} by {SIDE}")
        frames[k] = blocks.ravel()
    cuts = np.cumsum([len(c) for c in coded])
    return np.split(frames, cuts[:-1])


def shots(frames: np.ndarray) -> list[tuple[int, int]]:
    """First and last + 1 frame of each shot."""
    n = len(frames)
    if n < 2:
        return [(0, n)]
    bins = frames >> 4
    histogram = np.bincount((np.arange(n)[:, None] * BINS + bins).ravel(), minlength=n * BINS).reshape(n, BINS)
    diff = np.abs(np.diff(histogram, axis=0)).sum(axis=1) / (2 * FRAME)
    sums, squares = np.concatenate(([0.0], diff.cumsum())), np.concatenate(([0.0], (diff * diff).cumsum()))
    k = np.arange(n - 1)
    low = np.maximum(k - WINDOW, 0)
    many = np.maximum(k - low, 1)
    mean = (sums[k] - sums[low]) / many
    deviation = np.sqrt(np.maximum((squares[k] - squares[low]) / many - mean * mean, 0))
    ends = [*(np.flatnonzero(np.round(diff - np.maximum(FLOOR, mean + CUT * deviation), 9) > 0) + 1).tolist(), n]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def by_group(batch: pa.RecordBatch):
    """(doc_ids, lengths, files, read frames) of groups of texts with some GROUP frames together."""
    ids, texts, at = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), 0
    while at < len(ids):
        payloads, lengths, total, start = [], [], 0, at
        while at < len(ids) and (not payloads or total < GROUP * FRAME):
            p, n = padded(texts[at])
            payloads.append(p)
            lengths.append(n)
            total += len(p)
            at += 1
        files = stored(payloads)
        yield ids[start:at], lengths, files, read_back(files)


def clips(docs: DataFrame) -> DataFrame:
    """doc_id, clip, first_frame, n_frames, start_s, end_s: the timed shots of every stored text."""

    def run(batches):
        for batch in batches:
            for ids, _, _, frames in by_group(batch):
                rows = [(d, k, a, b - a, a / RATE, b / RATE) for d, f in zip(ids, frames, strict=True) for k, (a, b) in enumerate(shots(f))]
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "clip", "first_frame", "n_frames", "start_s", "end_s"])

    common.ready_for_python(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, clip int, first_frame int, n_frames int, start_s double, end_s double")


def files(docs: DataFrame) -> DataFrame:
    """doc_id, media binary: the stored file of every text."""

    def run(batches):
        for batch in batches:
            for ids, _, media, _ in by_group(batch):
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "media"])

    common.ready_for_python(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, media binary")


def summary(docs: DataFrame) -> DataFrame:
    """Sizes and digests of every text's payload as read back and of its file, and its clips in short as feature."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches):
        for batch in batches:
            for ids, lengths, media, frames in by_group(batch):
                rows = []
                for d, n, m, f in zip(ids, lengths, media, frames, strict=True):
                    payload, own = f.tobytes(), shots(f)
                    feature = f"{len(f)} frames, {len(own)} clips: " + " ".join(f"{a / RATE:.2f}-{b / RATE:.2f}" for a, b in own)
                    rows.append((d, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    common.ready_for_python(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types, strict=True)))
