"""Shapefiles as a Spark source: ``spark.read.format("shapefile").load(folder_or_pattern)``.

A large file is read by many tasks: the index gives each record's place in the ``.shp`` and
``.dbf`` records have a fixed length, so a task reads the byte ranges of its own records only.
Files are opened through Arrow's filesystems, which also reach shared storage.

Options: ``path`` (a folder, a file or a pattern) or ``files`` (paths, one per line),
``encoding`` (default latin1), ``recordsPerPartition``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

POINT_TYPE = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
GEOM_TYPE = ArrayType(ArrayType(ArrayType(POINT_TYPE)))
ARROW_GEOM = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))

HEADER_BYTES = 100
POLYGON_TYPES = (5, 15, 25)


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def read_bytes(path: str, offset: int, length: int) -> bytes:
    system, inner = open_path(path)
    with system.open_input_file(inner) as f:
        return f.read_at(length, offset)


def sibling(path: str, extension: str) -> str:
    """The ``.shx`` or ``.dbf`` beside a ``.shp``, in the same letter case."""
    stem, old = path.rsplit(".", 1)
    return f"{stem}.{extension.upper() if old.isupper() else extension}"


def matching_files(pattern: str) -> list[str]:
    """Shapefiles of a folder, or those whose path matches a pattern."""
    system, inner = open_path(pattern)
    prefix = pattern[: len(pattern) - len(inner)] if "://" in pattern else ""
    wild = next((i for i, c in enumerate(inner) if c in "*?["), None)
    if wild is None:
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [prefix + inner]
        base, pattern, recursive = inner.rstrip("/"), inner.rstrip("/") + "/*", False
    else:
        base = inner[:wild].rsplit("/", 1)[0]
        pattern, recursive = inner, "/" in inner[wild:]
    found = system.get_file_info(fs.FileSelector(base, recursive=recursive))
    paths = [i.path for i in found if i.type == fs.FileType.File and i.path.lower().endswith(".shp")]
    return sorted(prefix + p for p in paths if fnmatch.fnmatchcase(p, pattern))


@dataclass
class Field:
    name: str
    kind: str
    width: int
    decimals: int
    offset: int

    def spark_type(self) -> DataType:
        if self.kind == "N":
            return DecimalType(min(max(self.width, 1), 38), self.decimals)
        return {"L": BooleanType(), "D": DateType(), "F": DoubleType()}.get(self.kind, StringType())

    def arrow_type(self) -> pa.DataType:
        if self.kind == "N":
            return pa.decimal128(min(max(self.width, 1), 38), self.decimals)
        return {"L": pa.bool_(), "D": pa.date32(), "F": pa.float64()}.get(self.kind, pa.string())

    def value(self, text: str):
        """An attribute out of its text; blank is NULL."""
        if self.kind == "L":
            return {"T": True, "Y": True, "F": False, "N": False}.get(text.strip().upper()[:1])
        if self.kind == "C":
            return text.rstrip(" \0") or None
        text = text.strip(" \0")
        if not text or text.startswith("*"):
            return None
        if self.kind == "D":
            return None if text == "00000000" else dt.date(int(text[:4]), int(text[4:6]), int(text[6:8]))
        if self.kind == "N":
            return decimal.Decimal(text).quantize(decimal.Decimal(1).scaleb(-self.decimals))
        return float(text) if self.kind == "F" else text


@dataclass
class Table:
    """Layout of a ``.dbf``."""

    records: int
    start: int
    width: int
    fields: list[Field]


def table_layout(path: str) -> Table:
    head = read_bytes(path, 0, 32)
    records, start, width = (int.from_bytes(head[a:b], "little") for a, b in ((4, 8), (8, 10), (10, 12)))
    described = read_bytes(path, 32, start - 32)
    fields, offset = [], 1
    for at in range(0, len(described) - 31, 32):
        d = described[at : at + 32]
        if d[0] == 0x0D:
            break
        name = d[:11].split(b"\0")[0].decode("latin1").lower()
        fields.append(Field(name, chr(d[11]), d[16], d[17], offset))
        offset += d[16]
    return Table(records, start, width, fields)


def merged_type(name: str, one: DataType, two: DataType) -> DataType:
    """The type that holds a column's values of two files; numbers get the most digits on either side of the point."""
    if one == two:
        return one
    if isinstance(one, DecimalType) and isinstance(two, DecimalType):
        scale = max(one.scale, two.scale)
        whole = max(one.precision - one.scale, two.precision - two.scale)
        return DecimalType(min(whole + scale, 38), scale)
    raise ValueError(f"column {name} is {one.simpleString()} in one file and {two.simpleString()} in another")


def _inside(point: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    spans = (a[:, 1] > point[1]) != (b[:, 1] > point[1])
    a, b = a[spans], b[spans]
    x = a[:, 0] + (point[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return bool(np.count_nonzero(x > point[0]) % 2)


def _signed_area(ring: np.ndarray) -> float:
    local = ring - ring[0]
    return float(np.sum(local[:-1, 0] * local[1:, 1] - local[1:, 0] * local[:-1, 1]) / 2)


def decode_polygon(content: bytes) -> list[list[np.ndarray]] | None:
    """A record's shape as polygons, lists of rings: clockwise rings are shells, the others their holes."""
    kind = int.from_bytes(content[:4], "little")
    if kind == 0:
        return None
    if kind not in POLYGON_TYPES:
        raise ValueError(f"shape type {kind} is not a polygon")
    n_parts, n_points = (int.from_bytes(content[a : a + 4], "little") for a in (36, 40))
    starts = np.frombuffer(content, "<i4", n_parts, 44)
    points = np.frombuffer(content, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    if n_parts == 1:  # a shell, whichever way it runs
        return [[points]]
    rings = np.split(points, starts[1:])
    areas = [_signed_area(r) if len(r) else 0.0 for r in rings]
    shells = [i for i, a in enumerate(areas) if a <= 0] or list(range(len(rings)))
    polygons = {i: [rings[i]] for i in shells}
    for i, ring in enumerate(rings):
        if i in polygons:
            continue
        around = [s for s in shells if _inside(ring[0], rings[s])] or shells[:1]
        polygons[min(around, key=lambda s: abs(areas[s]))].append(ring)
    return list(polygons.values())


def _lists(items: list[list], values: pa.Array, mask: pa.Array | None = None) -> pa.ListArray:
    """A list for each item, as long as it, of the values one after the other."""
    ends = np.cumsum([0, *map(len, items)], dtype="i4")
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)


def arrow_polygons(shapes: list[list[list[np.ndarray]] | None]) -> pa.Array:
    """Decoded shapes as a column of ``ARROW_GEOM``."""
    polygons = [polygon for shape in shapes for polygon in shape or []]
    rings = [ring for polygon in polygons for ring in polygon]
    points = np.concatenate([np.empty((0, 2)), *rings])
    pairs = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], names=["x", "y"])
    absent = pa.array([shape is None for shape in shapes], pa.bool_())
    return _lists([shape or [] for shape in shapes], _lists(polygons, _lists(rings, pairs)), absent)


@dataclass
class RecordRange(InputPartition):
    path: str
    first: int
    count: int


class ShapefileReader(DataSourceReader):
    def __init__(self, files: list[str], schema: StructType, options: dict):
        self.files = files
        self.names = schema.names
        self.types = {f.name: to_arrow_type(f.dataType) for f in schema.fields if f.name not in ("geom", "path")}
        self.encoding = options.get("encoding", "latin1")
        self.per_partition = int(options.get("recordsperpartition", 250_000))

    def partitions(self) -> list[RecordRange]:
        ranges = []
        for path in self.files:
            records = table_layout(sibling(path, "dbf")).records
            for first in range(0, records, self.per_partition):
                ranges.append(RecordRange(path, first, min(self.per_partition, records - first)))
        return ranges or [RecordRange("", 0, 0)]  # Spark asks for one at least

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        layout = table_layout(sibling(partition.path, "dbf"))
        step = 10_000
        for first in range(partition.first, partition.first + partition.count, step):
            count = min(step, partition.first + partition.count - first)
            yield self.batch(partition.path, layout, first, count)

    def batch(self, path: str, layout: Table, first: int, count: int) -> pa.RecordBatch:
        index = np.frombuffer(read_bytes(sibling(path, "shx"), HEADER_BYTES + 8 * first, 8 * count), ">i4")
        offsets, lengths = 2 * index[0::2].astype("i8"), 2 * index[1::2].astype("i8")
        base = int(offsets.min())
        shapes = read_bytes(path, base, int((offsets + lengths).max()) + 8 - base)
        table = read_bytes(sibling(path, "dbf"), layout.start + layout.width * first, layout.width * count)
        # Records marked deleted are passed over.
        kept = [i for i in range(count) if table[i * layout.width] != ord("*")]
        columns = {}
        for field in layout.fields:
            places = (i * layout.width + field.offset for i in kept)
            texts = (table[at : at + field.width].decode(self.encoding) for at in places)
            if field.name in self.types:
                values = pa.array([field.value(t) for t in texts], field.arrow_type())
                columns[field.name] = values.cast(self.types[field.name])
        starts = [int(offsets[i]) - base + 8 for i in kept]
        bodies = (shapes[s : s + int(lengths[i])] for s, i in zip(starts, kept))
        columns["geom"] = arrow_polygons([decode_polygon(b) for b in bodies])
        columns["path"] = pa.array([path] * len(kept), pa.string())
        for name, kind in self.types.items():
            columns.setdefault(name, pa.nulls(len(kept), kind))
        return pa.RecordBatch.from_arrays([columns[n] for n in self.names], names=self.names)


class ShapefileSource(DataSource):
    """Attributes of all files under their lower-case names, then ``geom`` and the file's ``path``.

    An attribute that a file lacks is NULL for its rows.
    """

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def files(self) -> list[str]:
        if "files" in self.options:
            return self.options["files"].split("\n")
        found = matching_files(self.options["path"])
        if not found:
            raise ValueError(f"no shapefiles at {self.options['path']}")
        return found

    def schema(self) -> StructType:
        types: dict[str, DataType] = {}
        for path in self.files():
            for f in table_layout(sibling(path, "dbf")).fields:
                types[f.name] = merged_type(f.name, types.get(f.name, f.spark_type()), f.spark_type())
        attributes = [StructField(name, kind) for name, kind in types.items()]
        return StructType([*attributes, StructField("geom", GEOM_TYPE), StructField("path", StringType())])

    def reader(self, schema: StructType) -> ShapefileReader:
        return ShapefileReader(self.files(), schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShapefileSource)
