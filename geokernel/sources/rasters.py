"""Grids as tables: a data source over tiled grid files, a writer of mosaics, position fixes of photos.

A mosaic is a folder of files r<row>_c<column>.tif, each a block of the whole grid that starts at
that row and column. A scan is planned from names and headers alone: blocks and tiles outside the
window are never opened, and every task reads the byte ranges of its own tiles."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from geokernel.functions import scalar as S
from geokernel.sources import tiff

#: Cells that a task reads, on average; rows and columns of a mosaic's block.
CELLS_PER_TASK, BLOCK_CELLS = 4_000_000, 2048
#: Bytes of a photo that may hold its position: a segment has 64 KB at most.
HEAD_BYTES = 1 << 18
_NAME = re.compile(r"r(\d+)_c(\d+)\.tif$")


def _store(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


def _reader(file) -> tiff.Read:
    def read(at: int, size: int) -> bytes:
        file.seek(at)
        return file.read(size)

    return read


class _Tiles(InputPartition):
    def __init__(self, path: str, row: int, column: int, tiles: list[int]):
        self.path, self.row, self.column, self.tiles = path, row, column, tiles


class _Scan(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.bands = options["path"], int(options.get("bands", 1))
        self.window = tuple(int(options.get(k, d)) for k, d in (("r0", 0), ("r1", 2**62), ("c0", 0), ("c1", 2**62)))

    def _meets(self, r0: int, r1: int, c0: int, c1: int) -> bool:
        w = self.window
        return r0 < w[1] and r1 > w[0] and c0 < w[3] and c1 > w[2]

    def partitions(self) -> list[_Tiles]:
        from pyarrow import fs

        store, base = _store(self.path)
        info = store.get_file_info(base)
        files = [base] if info.type == fs.FileType.File else sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".tif"))
        out = []
        for path in files:
            named = _NAME.search(path)
            row, column = map(int, named.groups()) if named else (0, 0)
            if row >= self.window[1] or column >= self.window[3]:
                continue  # by its name alone
            with store.open_input_file(path) as f:
                g = tiff.grid(_reader(f))
            wanted = [k for k in range(len(g.offsets)) if self._meets(*(a + b for a, b in zip(g.box(k), (row, row, column, column), strict=True)))]
            step = max(1, CELLS_PER_TASK // (g.tile_width * g.tile_height))
            out += [_Tiles(path, row, column, wanted[k : k + step]) for k in range(0, len(wanted), step)]
        return out

    def read(self, partition: _Tiles) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        names = ["v"] if self.bands == 1 else [f"b{k + 1}" for k in range(self.bands)]
        with store.open_input_file(partition.path) as f:
            g = tiff.grid(_reader(f))
            if g.bands < self.bands:
                raise ValueError(f"{partition.path} has {g.bands} bands")
            for k in partition.tiles:
                r0, r1, c0, c1 = g.box(k)
                f.seek(g.offsets[k])
                cells = g.values(k, f.read(g.sizes[k]))[:, :, : self.bands].astype(float)
                r, c = np.repeat(np.arange(r0, r1), c1 - c0) + partition.row, np.tile(np.arange(c0, c1), r1 - r0) + partition.column
                flat = cells.reshape(-1, self.bands)
                w = self.window
                kept = (r >= w[0]) & (r < w[1]) & (c >= w[2]) & (c < w[3]) & ~np.isnan(flat).any(axis=1)
                if g.nodata is not None:
                    kept &= ~(flat == g.nodata).all(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(r[kept]), pa.array(c[kept]), *[pa.array(np.ascontiguousarray(flat[kept, b])) for b in range(self.bands)]], ["r", "c", *names])


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class _Files(DataSourceWriter):
    """Rows (name, content) as files: tasks write into a folder of this attempt, and what tasks
    that ended have written is moved to its place once all have."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.attempt = options["path"].rstrip("/"), overwrite, f"_attempt-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> _Written:
        store, base = _store(self.path)
        task, names = uuid.uuid4().hex, []
        store.create_dir(f"{base}/{self.attempt}/{task}", recursive=True)
        for row in rows:
            with store.open_output_stream(f"{base}/{self.attempt}/{task}/{row['name']}") as f:
                f.write(row["content"])
            names.append(f"{task}/{row['name']}")
        return _Written(names)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        store, base = _store(self.path)
        names = [n for m in messages if m for n in m.names]
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(base)):
                if f.path.endswith(".tif"):
                    store.delete_file(f.path)
        for name in names:
            store.move(f"{base}/{self.attempt}/{name}", f"{base}/{name.split('/')[-1]}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        store, base = _store(self.path)
        if store.get_file_info(f"{base}/{self.attempt}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{self.attempt}")


class GridFiles(DataSource):
    """format("grid"): reads cells (r, c, v), or (r, c, b1 .. bn) with the option bands, of a file or
    mosaic; options r0, r1, c0, c1 (ends excluded) make a window. Writes rows (name, content)."""

    @classmethod
    def name(cls) -> str:
        return "grid"

    def schema(self) -> str:
        bands = int(self.options.get("bands", 1))
        return "r bigint, c bigint, " + ("v double" if bands == 1 else ", ".join(f"b{k + 1} double" for k in range(bands)))

    def reader(self, schema) -> DataSourceReader:
        return _Scan(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Files(self.options, overwrite)


def read_grid(spark: SparkSession, path: str, bands: int = 1, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """The cells with data of a grid file or mosaic, inside a window (r0, r1, c0, c1) if one is
    given. Cells that are nodata in all bands, or not a number in any, are left out."""
    spark.dataSource.register(GridFiles)
    scan = spark.read.format("grid").option("bands", bands)
    for k, v in zip(("r0", "r1", "c0", "c1"), window or (), strict=False):
        scan = scan.option(k, v)
    return scan.load(path)


def grid_header(path: str) -> tiff.Grid:
    """Size, place, nodata and reference system of one grid file, from its header."""
    store, base = _store(path)
    with store.open_input_file(base) as f:
        return tiff.grid(_reader(f))


def write_grid(cells: DataFrame, path: str, x0: float, y1: float, gsd: float, rows: int, cols: int, bands: tuple[str, ...] = ("v",), kind: str = "f4", nodata: float | None = -9999.0, epsg: int | None = None, block: int = BLOCK_CELLS) -> None:
    """Writes cells (r, c, bands) of a grid of rows x cols as a mosaic; cells that are missing, or
    whose bands are null, become nodata (0 without one). Blocks without any cell are not written.

    Blocks are made by tasks; a block is as much as one of them holds."""
    spark, n = cells.sparkSession, len(bands)
    spark.dataSource.register(GridFiles)
    inside = cells.filter(F.col("r").between(0, rows - 1) & F.col("c").between(0, cols - 1))
    keyed = inside.select(F.floor(F.col("r") / block).alias("i"), F.floor(F.col("c") / block).alias("j"), "r", "c", *[F.col(b).cast("double").alias(f"b{k}") for k, b in enumerate(bands)])

    def encode(key: tuple, part: pa.Table) -> pa.Table:
        i, j = (k.as_py() for k in key)
        h, w = min(block, rows - i * block), min(block, cols - j * block)
        values = np.full((h, w, n), 0.0 if nodata is None else nodata)
        r, c = part["r"].to_numpy() - i * block, part["c"].to_numpy() - j * block
        for k in range(n):
            given = part[f"b{k}"].to_numpy()
            values[r, c, k] = np.where(np.isnan(given), values[0, 0, k] if nodata is None else nodata, given)
        whole = np.rint(values) if kind[0] in "ui" else values
        content = tiff.encoded(whole.astype(kind), x0 + j * block * gsd, y1 - i * block * gsd, gsd, nodata, epsg)
        return pa.table({"name": [f"r{i * block}_c{j * block}.tif"], "content": pa.array([content], pa.binary())})

    keyed.groupBy("i", "j").applyInArrow(encode, "name string, content binary").write.format("grid").mode("overwrite").save(path)


def position_fixes(spark: SparkSession, path: str, pattern: str = "*", whole: bool = False) -> DataFrame:
    """(name, lat, lon, alt) of the photos below a path: nulls where a photo has no position, and
    altitude 0 where a position has none. Empty files are not listed.

    Files are listed by Spark, and tasks read the first bytes of each; with whole, Spark reads
    the files, for stores that only it can open."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    files = files.select("path", F.substring("content", 1, HEAD_BYTES).alias("head")) if whole else files.select("path").repartition(2 * spark.sparkContext.defaultParallelism)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                if whole:
                    head = bytes(row.head)
                else:
                    store, base = _store(row.path)
                    with store.open_input_file(base) as f:
                        head = f.read(HEAD_BYTES)
                found.append({"path": row.path} | tiff.position_tags(head))
            yield pd.DataFrame(found, columns=["path", "lat", "lat_ref", "lon", "lon_ref", "alt", "alt_ref"])

    tags = files.mapInPandas(parse, "path string, lat array<double>, lat_ref string, lon array<double>, lon_ref string, alt double, alt_ref int")
    degrees = lambda n: S.dms_to_degrees(*[F.col(n)[k] for k in range(3)], F.col(f"{n}_ref"))
    both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    altitude = S.signed_altitude(F.coalesce("alt", F.lit(0.0)), F.col("alt_ref"))
    return tags.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.when(both, degrees("lat")).alias("lat"), F.when(both, degrees("lon")).alias("lon"), F.when(both, altitude).alias("alt"))
