"""GeoTIFF files as arrays: strips or tiles, plain or compressed, read block by block; written as plain strips."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: TIFF field types: size and struct code (fixed values).
FIELD_TYPES = {1: (1, "B"), 2: (1, "c"), 3: (2, "H"), 4: (4, "I"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS_PER_STRIP, COUNTS, PLANAR, PREDICTOR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 339
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA_TAG = 33550, 33922, 34735, 42113
#: Sample types by format and bits (fixed values).
SAMPLE_TYPES = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


def tiff_tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """The byte order and the tags of the first image, of classic and of big files."""
    order = "<" if data[:2] == b"II" else ">"
    big = struct.unpack_from(order + "H", data, 2)[0] == 43
    entry, inline, place = (20, 8, "Q") if big else (12, 4, "I")
    at = struct.unpack_from(order + place, data, 8 if big else 4)[0]
    n, at = struct.unpack_from(order + ("Q" if big else "H"), data, at)[0], at + (8 if big else 2)
    tags = {}
    for k in range(at, at + n * entry, entry):
        tag, kind, count = struct.unpack_from(order + "HH" + place, data, k)
        size, code = FIELD_TYPES.get(kind, (1, "B"))
        value = k + entry - inline
        tags[tag] = struct.unpack_from(f"{order}{count}{code}", data, value if size * count <= inline else struct.unpack_from(order + place, data, value)[0])
    return order, tags


def tiff_metadata(data: bytes) -> dict:
    """The metadata of a GeoTIFF; no pixel is decoded."""
    _, tags = tiff_tags(data)
    scale, tie = tags.get(PIXEL_SCALE, (1.0, 1.0, 0.0)), tags.get(TIE_POINT, (0.0,) * 6)
    keys = tags.get(GEO_KEYS, ())
    srid = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] in (3072, 2048)), 0)
    nodata = b"".join(tags[NODATA_TAG]).strip(b"\0 ") if NODATA_TAG in tags else b""
    kind = SAMPLE_TYPES[tags.get(FORMAT, (1,))[0], tags[BITS][0]]
    transform = (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1])
    return {"width": tags[WIDTH][0], "height": tags[HEIGHT][0], "bands": tags.get(SAMPLES, (1,))[0], "srid": srid, "transform": transform, "nodata": float(nodata) if nodata else None, "dtype": kind}


def _unpacked_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, first bit first; 256 clears the table, 257 ends; a code grows one entry early."""
    out, table, width, bits, have, last = bytearray(), [], 9, 0, 0, None
    for byte in data:
        bits, have = bits << 8 | byte, have + 8
        if have < width:
            continue
        have -= width
        code, bits = bits >> have, bits & (1 << have) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        if last is not None:
            table.append(last + (table[code][:1] if code < len(table) else last[:1]))
            width = min(12, max(width, (len(table) + 1).bit_length()))
        last = table[code]
        out += last
    return bytes(out)


def _unpacked_bits(data: bytes) -> bytes:
    """Runs: a count below 128 copies count + 1 bytes, one above repeats the next byte 257 - count times."""
    out, at = bytearray(), 0
    while at < len(data):
        n, at = data[at], at + 1
        if n < 128:
            out += data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            out += data[at : at + 1] * (257 - n)
            at += 1
    return bytes(out)


#: How blocks are compressed (fixed values): not at all, LZW, deflate under two numbers, runs.
UNPACK = {1: bytes, 5: _unpacked_lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _unpacked_bits}


def _undone(raw: bytes, predictor: int, order: str, kind: str, shape: tuple[int, int, int]) -> np.ndarray:
    """(rows, columns, samples) of a block whose rows hold differences to the sample before (2) or of the bytes by significance (3)."""
    h, w, n = shape
    if predictor == 3:
        size = int(kind[1:])
        planes = np.cumsum(np.frombuffer(raw, "u1").reshape(h, size * w, n), axis=1, dtype="u1").reshape(h, size, w * n)
        return np.ascontiguousarray(np.moveaxis(planes, 1, 2)).view(">" + kind).reshape(shape)
    cells = np.frombuffer(raw, order + kind).reshape(shape)
    return np.cumsum(cells, axis=1, dtype=kind) if predictor == 2 else cells


def tiff_blocks(data: bytes) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first band, first row, first column, (bands, rows, columns)) of each strip or tile of a GeoTIFF; one that a sparse file leaves out holds nodata, or zero."""
    order, tags = tiff_tags(data)
    meta = tiff_metadata(data)
    w, h, n, kind = meta["width"], meta["height"], meta["bands"], meta["dtype"]
    unpack, predictor = UNPACK.get(tags.get(COMPRESSION, (1,))[0]), tags.get(PREDICTOR, (1,))[0]
    if unpack is None or predictor not in (1, 2, 3):
        raise ValueError(f"compression {tags[COMPRESSION][0]} with predictor {predictor} isn't read")
    tiled, apart = TILE_OFFSETS in tags, tags.get(PLANAR, (1,))[0] == 2
    bw, bh = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (w, min(h, tags.get(ROWS_PER_STRIP, (h,))[0]))
    across, down, samples = -(-w // bw), -(-h // bh), 1 if apart else n
    places = zip(*(tags[t] for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (OFFSETS, COUNTS))), strict=True)
    for k, (at, size) in enumerate(places):
        band, k = divmod(k, across * down)
        r, c = k // across * bh, k % across * bw
        rows = bh if tiled else min(bh, h - r)
        if size:
            raw = unpack(data[at : at + size])[: rows * bw * samples * int(kind[1:])]
            block = _undone(raw, predictor, order, kind, (rows, bw, samples))
        else:
            block = np.full((rows, bw, samples), meta["nodata"] or 0, kind)
        yield band, r, c, np.moveaxis(block[: h - r, : w - c], 2, 0)


def decode_tiff(data: bytes) -> tuple[np.ndarray, dict]:
    """(bands, height, width) and the metadata of a GeoTIFF."""
    meta = tiff_metadata(data)
    out = np.empty((meta["bands"], meta["height"], meta["width"]), meta["dtype"])
    for band, r, c, block in tiff_blocks(data):
        n, h, w = block.shape
        out[band : band + n, r : r + h, c : c + w] = block
    return out, meta


def encode_tiff(bands: np.ndarray, transform: tuple[float, ...], srid: int, nodata: float | None) -> bytes:
    """An uncompressed GeoTIFF of float32 in one strip for each band."""
    n, h, w = bands.shape
    raw = bands.astype("<f4").tobytes()
    a, _, x0, _, e, y0 = transform
    entries = [
        (WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [32] * n), (COMPRESSION, 3, [1]), (262, 3, [1]), (OFFSETS, 4, [8 + k * h * w * 4 for k in range(n)]), (SAMPLES, 3, [n]), (ROWS_PER_STRIP, 4, [h]), (COUNTS, 4, [h * w * 4] * n),
        (PLANAR, 3, [2]), (FORMAT, 3, [3] * n), (PIXEL_SCALE, 12, [a, -e, 0.0]), (TIE_POINT, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (GEO_KEYS, 3, [1, 1, 0, 1, 3072 if srid != 4326 else 2048, 0, 1, srid]),
    ]
    if nodata is not None:
        entries.append((NODATA_TAG, 2, [bytes([b]) for b in f"{nodata:g}".encode() + b"\0"]))
    out = io.BytesIO()
    out.write(b"II*\0" + struct.pack("<I", 8 + len(raw)) + raw)
    directory = struct.pack("<H", len(entries))
    extra, place = b"", 8 + len(raw) + 2 + 12 * len(entries) + 4
    for tag, kind, values in entries:
        packed = struct.pack(f"<{len(values)}{FIELD_TYPES[kind][1]}", *values)
        field = packed.ljust(4, b"\0") if len(packed) <= 4 else struct.pack("<I", place + len(extra))
        extra += packed + b"\0" * (len(packed) % 2) if len(packed) > 4 else b""
        directory += struct.pack("<HHI", tag, kind, len(values)) + field
    out.write(directory + b"\0" * 4 + extra)
    return out.getvalue()
