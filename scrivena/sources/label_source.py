"""Label files and event logs as data sources: spark.read.format("detection_labels").load(path), and so on.

Files are cut into byte ranges, one a partition, so that one huge label file is read by many tasks; a line belongs to the
range that it begins in. Filters on the columns that a line shows before its payload is parsed (file, offset, path, name)
are pushed into the reader: those on the file drop partitions, the others drop lines before any JSON is read. What cannot
be pushed is left to Spark. A line is placed by its byte offset, which orders the lines of a file as line numbers would,
without counting the ones in other ranges.

Options: path (a file or folder, in any store that Arrow opens), rangeBytes, strict ("true": a line without a separator
raises; otherwise it is skipped). Hidden files and those that begin with an underscore are left out.

Formats: detection_labels (path, tab, JSON polygons), recognition_labels (path, space, text), json_events (JSON objects;
the columns are those of .schema()). A payload that isn't JSON is null.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from scrivena.sources.shared import prepare

RANGE, BATCH = 64 << 20, 2000
_POLYGONS = "array<struct<transcription: string, points: array<array<double>>, difficult: boolean>>"
_TESTS: dict[type, Callable] = {
    ds.EqualTo: lambda v, x: v == x,
    ds.EqualNullSafe: lambda v, x: v == x,
    ds.In: lambda v, x: v in x,
    ds.GreaterThan: lambda v, x: v > x,
    ds.GreaterThanOrEqual: lambda v, x: v >= x,
    ds.LessThan: lambda v, x: v < x,
    ds.LessThanOrEqual: lambda v, x: v <= x,
    ds.StringStartsWith: lambda v, x: v.startswith(x),
    ds.StringEndsWith: lambda v, x: v.endswith(x),
    ds.StringContains: lambda v, x: x in v,
    ds.IsNotNull: lambda v, _: True,
}


def _store(path: str) -> tuple:
    """The Arrow file system of a path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class Range(ds.InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _lines(path: str, start: int, end: int, piece: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in [start, end)."""
    fs, name = _store(path)
    with fs.open_input_file(name) as f:
        # The byte before the range tells whether a line begins with it.
        at = max(0, start - 1)
        f.seek(at)
        skip, rest = start > 0, b""
        while at < end or rest or skip:
            more = f.read(piece)
            lines = (rest + more).split(b"\n")
            rest = lines.pop() if more else b""
            for line in lines:
                if skip:
                    skip = False
                elif at >= end:
                    return
                else:
                    yield at, line.removesuffix(b"\r")
                at += len(line) + 1
            if not more:
                return
            if at >= end and not skip:
                return


class LineReader(ds.DataSourceReader):
    """Rows of one format; `shown` gives the columns before the payload, `batch` makes the columns of many rows."""

    def __init__(self, schema: StructType, options: dict, cut: bytes | None, names: tuple[str, ...], payload: Callable):
        self.kinds, self.options, self.cut, self.names, self.payload = schema, options, cut, names, payload
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in self.names and getattr(f, "value", "") is not None:
                self.tests.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def _passes(self, row: dict) -> bool:
        return all(_TESTS[kind](row[c], x) for c, kind, x in self.tests if c in row)

    def partitions(self) -> list[Range]:
        from pyarrow.fs import FileSelector, FileType

        path, step = self.options["path"], int(self.options.get("rangebytes") or self.options.get("rangeBytes") or RANGE)
        fs, name = _store(path)
        info = fs.get_file_info(name)
        if info.type == FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.type == FileType.File else fs.get_file_info(FileSelector(name, recursive=True))
        files = [(path[: len(path) - len(name)] + i.path, i.size) for i in found if i.type == FileType.File and i.base_name[0] not in "._"]
        out = [Range(p, a, min(a + step, n)) for p, n in sorted(files) if self._passes({"file": p}) for a in range(0, n, step)]
        return out or [Range("", 0, 0)]

    def _rows(self, part: Range) -> Iterator[dict]:
        strict = str(self.options.get("strict", "")).lower() == "true"
        for offset, line in _lines(part.path, part.start, part.end) if part.path else ():
            if not line.strip():
                continue
            row = {"file": part.path, "offset": offset}
            if self.cut:
                head, cut, tail = line.partition(self.cut)
                if not cut:
                    if strict:
                        raise ValueError(f"{part.path}: no separator in the line at byte {offset}")
                    continue
                path = head.decode("utf-8", "replace")
                row |= {self.names[2]: path, "name": posixpath.basename(path)}
            else:
                tail = line
            if self._passes(row):
                yield row | {"": tail.decode("utf-8", "replace")}

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, held = to_arrow_schema(self.kinds), []

        def batch() -> pa.RecordBatch:
            cols = self.payload(held)
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name] if f.name in cols else [r.get(f.name) for r in held], f.type) for f in kinds], schema=kinds)

        for row in self._rows(partition):
            held.append(row)
            if len(held) == BATCH:
                yield batch()
                held = []
        yield batch()


def _parsed(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return None


def _polygon(p: dict) -> dict | None:
    if not isinstance(p, dict):
        return None
    text = p.get("transcription")
    return {"transcription": text if text is None or isinstance(text, str) else json.dumps(text), "points": p.get("points"), "difficult": p.get("difficult")}


def _polygons(rows: list[dict]) -> dict[str, list]:
    found = (_parsed(r[""]) for r in rows)
    return {"polygons": [[_polygon(p) for p in v] if isinstance(v, list) else None for v in found]}


class DetectionLabels(ds.DataSource):
    """file, offset, image_path, name, polygons."""

    @classmethod
    def name(cls) -> str:
        return "detection_labels"

    def schema(self) -> str:
        return f"file string, offset long, image_path string, name string, polygons {_POLYGONS}"

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return LineReader(schema, dict(self.options), b"\t", ("file", "offset", "image_path", "name"), _polygons)


class RecognitionLabels(ds.DataSource):
    """file, offset, crop_path, name, text."""

    @classmethod
    def name(cls) -> str:
        return "recognition_labels"

    def schema(self) -> str:
        return "file string, offset long, crop_path string, name string, text string"

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return LineReader(schema, dict(self.options), b" ", ("file", "offset", "crop_path", "name"), lambda rows: {"text": [r[""] for r in rows]})


class JsonEvents(ds.DataSource):
    """The columns of .schema(), and file and offset where the schema names them. Fields that an event lacks are null."""

    @classmethod
    def name(cls) -> str:
        return "json_events"

    def schema(self) -> str:
        return "file string, offset long, event string"

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        names = [f.name for f in schema.fields if f.name not in ("file", "offset")]

        def fields(rows: list[dict]) -> dict[str, list]:
            found = [v if isinstance(v, dict) else {} for v in (_parsed(r[""]) for r in rows)]
            return {n: [v.get(n) for v in found] for n in names}

        return LineReader(schema, dict(self.options), None, ("file", "offset"), fields)


def register(spark: SparkSession) -> SparkSession:
    """Makes the formats known to a session, and lets it push filters into them."""
    prepare(spark)
    for source in (DetectionLabels, RecognitionLabels, JsonEvents):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark
