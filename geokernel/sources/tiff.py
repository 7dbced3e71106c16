"""Directories of TIFF files, and what is built on them: grids in tiles and position fixes of photos.

Only the public file layout is dealt with here: entries of a directory, tiles or strips, deflate,
the tags of north-up grids, and the block of position tags in photos. Bytes come in, arrays and
tags come out; which bytes are read, and where, is up to the callers."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Bytes and letters of the field types of a directory entry.
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 7: (1, "B"), 8: (2, "h"), 9: (4, "i"), 10: (8, "ii"), 11: (4, "f"), 12: (8, "d")}
#: Tags of images, of north-up grids, and of position blocks.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, EXTRA, FORMAT = 284, 317, 322, 323, 324, 325, 338, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA, GPS_BLOCK = 33550, 33922, 34735, 42113, 34853
LAT_REF, LAT, LON_REF, LON, ALT_REF, ALT = 1, 2, 3, 4, 5, 6
NONE, DEFLATE, OLD_DEFLATE = 1, 8, 32946
#: Sample formats, and the key of a projected system in the key directory.
KINDS = {(8, 1): "u1", (16, 1): "u2", (32, 1): "u4", (8, 2): "i1", (16, 2): "i2", (32, 2): "i4", (32, 3): "f4", (64, 3): "f8"}
PROJECTED, MODEL, RASTER = 3072, 1024, 1025

Read = Callable[[int, int], bytes]


def directory(read: Read, at: int | None = None) -> tuple[str, dict[int, tuple]]:
    """Byte order ("<" or ">") and the entries of the directory at an offset, by default the first.

    read(offset, size) gives bytes of the file. Entries of unknown types, or whose values lie
    beyond the file's end, are left out."""
    head = read(0, 8)
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(head[:4])
    if order is None:
        raise ValueError("not a TIFF file with 32-bit offsets")
    if at is None:
        (at,) = struct.unpack(f"{order}I", head[4:8])
    (count,) = struct.unpack(f"{order}H", read(at, 2))
    raw, out = read(at + 2, 12 * count), {}
    for k in range(len(raw) // 12):
        tag, kind, n = struct.unpack(f"{order}HHI", raw[12 * k : 12 * k + 8])
        if kind not in TYPES:
            continue
        size, letters = TYPES[kind]
        data = raw[12 * k + 8 : 12 * k + 12]
        if n * size > 4:
            data = read(struct.unpack(f"{order}I", data)[0], n * size)
        data = data[: n * size]
        if len(data) == n * size:
            out[tag] = (data,) if letters == "s" else struct.unpack(order + letters * n if len(letters) > 1 else f"{order}{n}{letters}", data)
    return order, out


@dataclass(frozen=True)
class Grid:
    """A north-up grid: its size, the kind of its values, where its tiles are. x0, y1: the outer
    corner of the first cell."""

    order: str
    width: int
    height: int
    bands: int
    kind: str
    compression: int
    predictor: int
    tile_width: int
    tile_height: int
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    x0: float = 0.0
    y1: float = 0.0
    gsd: float = 1.0
    nodata: float | None = None
    epsg: int | None = None

    @property
    def across(self) -> int:
        return -(-self.width // self.tile_width)

    def box(self, tile: int) -> tuple[int, int, int, int]:
        """Rows and columns r0, r1, c0, c1 that a tile covers, ends excluded."""
        i, j = divmod(tile, self.across)
        return i * self.tile_height, min((i + 1) * self.tile_height, self.height), j * self.tile_width, min((j + 1) * self.tile_width, self.width)

    def values(self, tile: int, data: bytes) -> np.ndarray:
        """(rows, columns, bands) of a tile's bytes; what tiles hold beyond the grid is cut off."""
        raw = data if self.compression == NONE else zlib.decompress(data)
        r0, r1, c0, c1 = self.box(tile)
        cells = np.frombuffer(raw, self.order + self.kind)
        cells = cells[: len(cells) // (self.tile_width * self.bands) * self.tile_width * self.bands].reshape(-1, self.tile_width, self.bands)
        if self.predictor == 2:
            cells = np.cumsum(cells, axis=1, dtype=cells.dtype)
        return cells[: r1 - r0, : c1 - c0]


def grid(read: Read) -> Grid:
    order, e = directory(read)
    one = lambda tag, default: e[tag][0] if tag in e else default
    bits, form = set(e.get(BITS, (1,))), set(e.get(FORMAT, (1,)))
    kind = KINDS.get((bits.pop(), form.pop())) if len(bits) == 1 and len(form) == 1 else None
    compression, predictor, bands = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(SAMPLES, 1)
    if kind is None or compression not in (NONE, DEFLATE, OLD_DEFLATE) or one(PLANAR, 1) != 1 or predictor not in (1, 2):
        raise ValueError(f"unknown layout of cells: kind {kind}, compression {compression}, predictor {predictor}")
    tiled = TILES in e
    width, height = e[WIDTH][0], e[HEIGHT][0]
    across, down = (e[TILE_WIDTH][0], e[TILE_HEIGHT][0]) if tiled else (width, min(one(STRIP_ROWS, height), height))
    x0, y1, gsd = 0.0, 0.0, 1.0
    if PIXEL_SCALE in e and TIE_POINT in e:
        (sx, sy), (i, j, _, x, y) = e[PIXEL_SCALE][:2], e[TIE_POINT][:5]
        if abs(sx - sy) > 1e-9 * abs(sx):
            raise ValueError("cells are not square")
        x0, y1, gsd = x - i * sx, y + j * sy, sx
    keys = e.get(GEO_KEYS, ())
    epsg = next((keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k] == PROJECTED and keys[k + 1] == 0), None)
    nodata = e[NODATA][0].split(b"\0")[0].strip() if NODATA in e else b""
    return Grid(order, width, height, bands, kind, compression, predictor, across, down, e[TILES if tiled else STRIPS], e[TILE_BYTES if tiled else STRIP_BYTES], x0, y1, gsd, float(nodata) if nodata else None, epsg)


def encoded(cells: np.ndarray, x0: float, y1: float, gsd: float, nodata: float | None = None, epsg: int | None = None, tile: int = 256) -> bytes:
    """A tiled, deflated file of (rows, columns, bands); four bands of bytes are colours and alpha."""
    height, width, bands = cells.shape
    kind = cells.dtype.newbyteorder("<")
    bits, form = next(k for k, v in KINDS.items() if v == kind.str[1:])
    down, across = -(-height // tile), -(-width // tile)
    padded = np.zeros((down * tile, across * tile, bands), kind)
    padded[:height, :width] = cells
    tiles = [zlib.compress(np.ascontiguousarray(padded[i * tile : (i + 1) * tile, j * tile : (j + 1) * tile]).tobytes(), 6) for i in range(down) for j in range(across)]
    colour = bands >= 3 and bits == 8
    entries: dict[int, tuple[int, tuple | bytes]] = {
        WIDTH: (4, (width,)), HEIGHT: (4, (height,)), BITS: (3, (bits,) * bands), COMPRESSION: (3, (DEFLATE,)), PHOTOMETRIC: (3, (2 if colour else 1,)), SAMPLES: (3, (bands,)), PLANAR: (3, (1,)),
        TILE_WIDTH: (3, (tile,)), TILE_HEIGHT: (3, (tile,)), TILES: (4, (0,) * len(tiles)), TILE_BYTES: (4, tuple(map(len, tiles))), FORMAT: (3, (form,) * bands),
        PIXEL_SCALE: (12, (gsd, gsd, 0.0)), TIE_POINT: (12, (0.0, 0.0, 0.0, x0, y1, 0.0)),
    }
    if colour and bands == 4:
        entries[EXTRA] = (3, (2,))
    if nodata is not None:
        entries[NODATA] = (2, b"%r\0" % nodata if nodata != int(nodata) else b"%d\0" % int(nodata))
    if epsg is not None:
        entries[GEO_KEYS] = (3, (1, 1, 0, 3, MODEL, 0, 1, 1, RASTER, 0, 1, 1, PROJECTED, 0, 1, epsg))

    def packed(kind: int, values: tuple | bytes) -> bytes:
        return values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{TYPES[kind][1]}", *values)

    # Values follow the directory, tiles follow the values.
    at = 8 + 2 + 12 * len(entries) + 4
    places, rest = {}, at
    for tag in sorted(entries):
        if (size := len(packed(*entries[tag]))) > 4:
            places[tag], rest = rest, rest + size + size % 2
    starts = tuple(rest + sum(map(len, tiles[:k])) for k in range(len(tiles)))
    entries[TILES] = (4, starts)
    head, body = struct.pack("<2sHIH", b"II", 42, 8, len(entries)), b""
    for tag in sorted(entries):
        kind_, values = entries[tag]
        data = packed(kind_, values)
        count = len(data) // TYPES[kind_][0]
        head += struct.pack("<HHI", tag, kind_, count) + (struct.pack("<I", places[tag]) if tag in places else data.ljust(4, b"\0"))
        if tag in places:
            body += data + b"\0" * (len(data) % 2)
    return head + struct.pack("<I", 0) + body + b"".join(tiles)


def position_tags(head: bytes) -> dict[str, object]:
    """The position tags of a photo's first bytes (a JPEG file with an Exif segment, or a TIFF file):
    lat and lon as three numbers, alt, and their references; those that are missing or cannot be
    read are None."""
    out: dict[str, object] = dict.fromkeys(("lat", "lat_ref", "lon", "lon_ref", "alt", "alt_ref"))
    block = head
    if head[:2] == b"\xff\xd8":
        block, at = b"", 2
        while at + 4 <= len(head) and head[at] == 0xFF and head[at + 1] not in (0xD9, 0xDA):
            size = int.from_bytes(head[at + 2 : at + 4], "big")
            if head[at + 1] == 0xE1 and head[at + 4 : at + 10] == b"Exif\0\0":
                block = head[at + 10 : at + 2 + size]
                break
            at += 2 + size
    try:
        read = lambda at, size: block[at : at + size]
        _, entries = directory(read)
        _, gps = directory(read, entries[GPS_BLOCK][0])
    except (ValueError, KeyError, struct.error):
        return out

    def numbers(tag: int, n: int) -> list[float] | None:
        v = gps.get(tag, ())
        if len(v) != 2 * n or not all(v[1::2]):
            return None
        return [a / b for a, b in zip(v[0::2], v[1::2], strict=True)]

    text = lambda tag: gps[tag][0].split(b"\0")[0].decode("ascii", "replace").strip() or None if tag in gps and isinstance(gps[tag][0], bytes) else None
    altitude = numbers(ALT, 1)
    out |= {"lat": numbers(LAT, 3), "lon": numbers(LON, 3), "lat_ref": text(LAT_REF), "lon_ref": text(LON_REF), "alt": altitude[0] if altitude else None}
    if gps.get(ALT_REF) and isinstance(gps[ALT_REF][0], int):
        out["alt_ref"] = gps[ALT_REF][0]
    return out
