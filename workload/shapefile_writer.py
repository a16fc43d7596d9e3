"""Writes shapefiles as test input: rows of attributes and multipolygons."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa

from stallwise.sources.shapefile import open_path


def dbf_text(value, kind: str, width: int, decimals: int, encoding: str) -> bytes:
    if value is None:
        text = "?" if kind == "L" else ""
    elif kind == "L":
        text = "T" if value else "F"
    elif kind == "D":
        text = value.strftime("%Y%m%d")
    elif kind == "N":
        text = f"{value:.{decimals}f}".rjust(width)
    else:
        text = str(value)
    return text.encode(encoding)[:width].ljust(width)


def shape_bytes(polygons) -> bytes:
    """Rings as given; shells must run clockwise and holes counterclockwise."""
    if polygons is None:
        return struct.pack("<i", 0)
    rings = [[(p["x"], p["y"]) for p in ring] for polygon in polygons for ring in polygon]
    points = [p for ring in rings for p in ring]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    starts, n = [], 0
    for ring in rings:
        starts.append(n)
        n += len(ring)
    return (
        struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), n)
        + struct.pack(f"<{len(rings)}i", *starts)
        + b"".join(struct.pack("<2d", *p) for p in points)
    )


def write_shapefile(stem: str, fields: list[tuple[str, str, int, int]], rows: Iterable[dict], encoding: str = "latin1") -> int:
    """Write ``stem`` .shp, .shx and .dbf; fields are (name, kind, width, decimals). Returns the number of rows.

    Rows are taken once, one after the other; what is held is their encoded form.
    """
    shapes, index, records, at, number = bytearray(), bytearray(), bytearray(), 50, 0
    for number, row in enumerate(rows, 1):
        body = shape_bytes(row["geom"])
        shapes += struct.pack(">2i", number, len(body) // 2) + body
        index += struct.pack(">2i", at, len(body) // 2)
        at += 4 + len(body) // 2
        records += b" " + b"".join(dbf_text(row[n], k, w, d, encoding) for n, k, w, d in fields)

    def header(body: bytearray) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50 + len(body) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)

    described = b"".join(
        name.upper().encode().ljust(11, b"\0") + kind.encode() + bytes(4) + bytes([width, decimals]) + bytes(14)
        for name, kind, width, decimals in fields
    )
    width = 1 + sum(f[2] for f in fields)
    table = struct.pack("<4BI2H20x", 3, 115, 2, 2, number, 33 + len(described), width) + described + b"\r"
    for extension, *content in (("shp", header(shapes), shapes), ("shx", header(index), index), ("dbf", table, records, b"\x1a")):
        system, path = open_path(f"{stem}.{extension}")
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(path) as out:
            for part in content:
                out.write(part)
    return number


def partition_writer(folder: str, fields: list[tuple[str, str, int, int]]):
    """For ``mapInArrow``: each task writes its rows to one shapefile and returns the count."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows, count = (row for batch in batches for row in batch.to_pylist()), 0
        for first in rows:
            # One name per partition, so a task run again replaces its file.
            number = TaskContext.get().partitionId()
            district = "".join("abcdefghij"[int(c)] for c in str(number))
            count = write_shapefile(f"{folder}/Deel-{district}_parkeerhaven_RD_20150202", fields, itertools.chain([first], rows))
        yield pa.RecordBatch.from_pydict({"n": [count]})

    return write
