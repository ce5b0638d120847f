"""Headerless big-endian rasters as a Spark data source: blocks of lines are partitions, cells are rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Cell types by name: numpy type and values per cell.
TYPES = {"double": (">f8", 1), "float": (">f4", 1), "fcomplex": (">f4", 2), "scomplex": (">i2", 2), "int": (">i4", 1), "short": (">i2", 1), "uchar": ("u1", 1)}


def cell_bytes(kind: str) -> int:
    dtype, values = TYPES[kind.lower()]
    return np.dtype(dtype).itemsize * values


def infer_lines(size: int, width: int, kind: str) -> int:
    """Lines of a raster from its file size; an error unless they are whole."""
    lines, rest = divmod(size, width * cell_bytes(kind))
    if rest or not lines:
        raise ValueError(f"{size} bytes are not whole lines of {width} {kind} cells")
    return lines


def coherence_kind(size: int, width: int, lines: int) -> str:
    """float or uchar (of which 255 is one), whichever the file size tells."""
    for kind in ("float", "uchar"):
        if size == width * lines * cell_bytes(kind):
            return kind
    raise ValueError(f"{size} bytes are neither float nor byte cells of {width} x {lines}")


def layout(parameters: dict[str, str], size: int) -> tuple[int, int, str]:
    """(width, lines, type) of a raster from the names and texts of its parameter file, checked against the file's size."""
    find = lambda *names: next((parameters[n].split()[0] for n in names if parameters.get(n, "").split()), None)
    width, lines, kind = find("range_samples", "interferogram_width", "width"), find("azimuth_lines", "interferogram_azimuth_lines", "nlines"), find("image_format", "data_format")
    if width is None or lines is None or kind is None:
        raise ValueError("a parameter file must give width, lines and format")
    kind = {"real*4": "float", "real*8": "double", "integer*2": "short"}.get(kind.lower(), kind.lower())
    if kind not in TYPES:
        raise ValueError(f"{kind} is no cell type")
    if infer_lines(size, int(width), kind) != int(lines):
        raise ValueError(f"{size} bytes are not {width} x {lines} {kind} cells")
    return int(width), int(lines), kind


def coherence(raster: DataFrame, kind: str) -> DataFrame:
    """A raster of coherence from 0 to 1: bytes are 255ths."""
    return raster.withColumn("value", F.col("value") / 255) if kind == "uchar" else raster


class _Lines(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.width, self.kind = options["path"], int(options["width"]), options.get("type", "float").lower()
        self.block = int(options.get("block_lines", 256))
        self.first, self.last, self.x0, self.x1 = (int(options.get(k, d)) for k, d in (("first_line", 0), ("last_line", -1), ("first_col", 0), ("last_col", self.width)))

    def partitions(self):
        import os

        lines = infer_lines(os.path.getsize(self.path), self.width, self.kind)
        last = lines if self.last < 0 else min(lines, self.last)
        return [_Lines(k, min(last, k + self.block)) for k in range(self.first, last, self.block)]

    def read(self, part):
        import pyarrow as pa

        dtype, values = TYPES[self.kind]
        with open(self.path, "rb") as file:
            file.seek(part.first * self.width * cell_bytes(self.kind))
            raw = np.frombuffer(file.read((part.last - part.first) * self.width * cell_bytes(self.kind)), dtype)
        cells = raw.astype(np.float64).reshape(-1, self.width, values)[:, self.x0 : self.x1]
        row, col = np.meshgrid(np.arange(part.first, part.last), np.arange(self.x0, self.x1), indexing="ij")
        im = cells[..., 1].ravel() if values == 2 else np.zeros(row.size)
        yield pa.RecordBatch.from_arrays([pa.array(row.ravel().astype(np.int64)), pa.array(col.ravel().astype(np.int64)), pa.array(cells[..., 0].ravel()), pa.array(im)], names=["row", "col", "value", "im"])


class RasterSource(DataSource):
    """Options: path, width, type, block_lines, and a window (first_line, last_line, first_col, last_col)."""

    @classmethod
    def name(cls):
        return "raster"

    def schema(self):
        return "row long, col long, value double, im double"

    def reader(self, schema):
        return _Reader(self.options)


def read_raster(spark, path: str, width: int, kind: str = "float", **window) -> DataFrame:
    spark.dataSource.register(RasterSource)
    return spark.read.format("raster").options(path=path, width=width, type=kind, **window).load()


def sample_raster(raster: DataFrame, points: DataFrame) -> DataFrame:
    """Points with the raster's value at their row and col."""
    return points.join(raster.select("row", "col", "value"), ["row", "col"])
