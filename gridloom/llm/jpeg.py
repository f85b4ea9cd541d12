"""A baseline JPEG decoder in numpy: quantisers and Huffman codes as a file defines them, AC coefficients, the inverse cosine
transform, restart markers, several components and their sampling.  What it can't decode raises a ValueError."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

#: Rows and columns of the coefficients in the order of a file: along the diagonals, to and fro.
ZIGZAG = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
COSINES = np.array([[np.sqrt((1 if u else 0.5) / 4) * np.cos((2 * x + 1) * u * np.pi / 16) for u in range(8)] for x in range(8)])


@dataclass
class Component:
    name: int
    across: int
    down: int
    quantiser: int
    dc: int = 0
    ac: int = 0


@dataclass
class Tables:
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    codes: dict[tuple[int, int], dict[tuple[int, int], int]] = field(default_factory=dict)
    restart: int = 0


class Bits:
    """The bits of entropy-coded data between two restart markers."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data.replace(b"\xff\x00", b"\xff"), 0

    def take(self, n: int) -> int:
        first, self.at = self.at >> 3, self.at + n
        if self.at > 8 * len(self.data):
            raise ValueError("the scan ends too early")
        return int.from_bytes(self.data[first : (self.at + 7) >> 3], "big") >> (-self.at & 7) & ((1 << n) - 1)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no such Huffman code")

    def signed(self, size: int) -> int:
        """A number of size bits, of which those that begin with 0 are negative."""
        n = self.take(size)
        return n if not size or n >> (size - 1) else n - (1 << size) + 1


def huffman(part: bytes, tables: Tables) -> None:
    """Canonical codes from the numbers of codes of each length, and their symbols."""
    at = 0
    while at < len(part):
        counts, symbols, code, own = part[at + 1 : at + 17], at + 17, 0, {}
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                own[length, code] = part[symbols]
                symbols, code = symbols + 1, code + 1
            code <<= 1
        tables.codes[part[at] >> 4, part[at] & 15] = own
        at = symbols


def quantisers(part: bytes, tables: Tables) -> None:
    at = 0
    while at < len(part):
        wide = part[at] >> 4
        tables.quantisers[part[at] & 15] = np.array(struct.unpack_from(">64H" if wide else ">64B", part, at + 1), float)
        at += 129 if wide else 65


def block(bits: Bits, of: Component, tables: Tables, before: int) -> tuple[int, np.ndarray]:
    """The DC coefficient, unscaled, and the samples of the next block."""
    scale, out = tables.quantisers[of.quantiser], np.zeros((8, 8))
    dc = before + bits.signed(bits.symbol(tables.codes[0, of.dc]))
    out[0, 0] = dc * scale[0]
    k = 1
    while k < 64:
        run, size = divmod(bits.symbol(tables.codes[1, of.ac]), 16)
        if not size and run < 15:
            break
        k += run
        if k > 63:
            raise ValueError("a block has too many coefficients")
        out[ZIGZAG[k]] = bits.signed(size) * scale[k]
        k += 1
    return dc, COSINES @ out @ COSINES.T + 128


def scan(data: bytes, parts: list[Component], height: int, width: int, tables: Tables) -> list[np.ndarray]:
    """The samples of each component, whole blocks, from the data of a scan."""
    across, down = max(p.across for p in parts), max(p.down for p in parts)
    alone = len(parts) == 1
    n_down, n_across = (-(-height // (8 * (1 if alone else down))), -(-width // (8 * (1 if alone else across))))
    size = lambda p: (1, 1) if alone else (p.down, p.across)
    planes = [np.zeros((8 * n_down * size(p)[0], 8 * n_across * size(p)[1])) for p in parts]
    pieces, begin, at = [], 0, 0
    while 0 <= (at := data.find(b"\xff", at)) < len(data) - 1:
        if 0xD0 <= data[at + 1] <= 0xD7:
            pieces.append(data[begin:at])
            begin = at + 2
        at += 2
    pieces.append(data[begin:])
    units = n_down * n_across
    each = tables.restart or units
    if len(pieces) != -(-units // each):
        raise ValueError("restart markers don't match their interval")
    for k, piece in enumerate(pieces):
        bits, before = Bits(piece), [0] * len(parts)
        for unit in range(k * each, min((k + 1) * each, units)):
            row, col = divmod(unit, n_across)
            for i, p in enumerate(parts):
                for a in range(size(p)[0]):
                    for b in range(size(p)[1]):
                        before[i], samples = block(bits, p, tables, before[i])
                        y, x = 8 * (row * size(p)[0] + a), 8 * (col * size(p)[1] + b)
                        planes[i][y : y + 8, x : x + 8] = samples
    return planes


def decoded(jpeg: bytes) -> list[np.ndarray]:
    """The samples, 0 to 255, of each component of a baseline JPEG, at the component's own resolution, whole blocks."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    tables, parts, shape, at = Tables(), [], (0, 0), 2
    while at + 4 <= len(jpeg):
        if jpeg[at] != 0xFF:
            raise ValueError("a marker is missing")
        if jpeg[at + 1] == 0xFF:  # filling
            at += 1
            continue
        kind, length = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        part = jpeg[at + 4 : at + 2 + length]
        if kind == 0xDB:
            quantisers(part, tables)
        elif kind == 0xC4:
            huffman(part, tables)
        elif kind == 0xDD:
            tables.restart = struct.unpack(">H", part)[0]
        elif kind in (0xC0, 0xC1):
            depth, *shape = struct.unpack_from(">BHH", part)
            if depth != 8:
                raise ValueError("only samples of 8 bits are decoded")
            parts = [Component(n, s >> 4, s & 15, q) for n, s, q in (part[6 + 3 * k : 9 + 3 * k] for k in range(part[5]))]
        elif 0xC2 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise ValueError("only baseline JPEG is decoded")
        elif kind == 0xDA:
            if part[0] != len(parts):
                raise ValueError("only a single scan of all components is decoded")
            by = {p.name: p for p in parts}
            for k in range(part[0]):
                by[part[1 + 2 * k]].dc, by[part[1 + 2 * k]].ac = part[2 + 2 * k] >> 4, part[2 + 2 * k] & 15
            if any(p.quantiser not in tables.quantisers or (0, p.dc) not in tables.codes or (1, p.ac) not in tables.codes for p in parts):
                raise ValueError("a quantiser or Huffman code isn't defined")
            end = jpeg.rfind(b"\xff\xd9")
            parts = [by[part[1 + 2 * k]] for k in range(part[0])]
            planes = scan(jpeg[at + 2 + length : end if end > at else len(jpeg)], parts, *shape, tables)
            return [np.clip(np.rint(x), 0, 255).astype(np.uint8) for x in planes]
        at += 2 + length
    raise ValueError("no scan")


def block_means(jpeg: bytes) -> np.ndarray:
    """The mean sample of each block of 8 by 8 of the first component."""
    plane = decoded(jpeg)[0].astype(float)
    return np.rint(plane.reshape(plane.shape[0] // 8, 8, -1, 8).mean(axis=(1, 3))).astype(np.uint8)
