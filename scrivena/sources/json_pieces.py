"""JSON files that hold one large object each, cut into records of a few kB, so that neither a file nor its value is held whole.

A record has the object's short fields, which are strings, and a stretch of one of its long ones (arrays of strings, or
objects of objects of strings), the other long ones being empty. Values are cut out as text and left for Spark to parse; a
number or the like that stands for a string becomes its text, as in Spark's reader. What isn't one plain JSON object (a list
of objects, a field that comes twice, a long field of another kind, a text that is no JSON) goes to Spark as it is.
"""

from __future__ import annotations

import codecs
import io
import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame

READ, ITEMS, BATCH = 1 << 20, 1000, 1 << 20
_STRING = r'"(?:[^"\\\x00-\x1f]++|\\.)*+"'
_WS = r"[ \t\r\n]*+"
#: As many items as a record has, each with the comma after it: strings of an array, objects of strings of an object. Other
#: items, and those that what is held ends in, are taken one by one.
_RUNS = {
    "]": re.compile(rf"(?:{_WS}{_STRING}{_WS},){{1,{ITEMS}}}+"),
    "}": re.compile(rf"(?:{_WS}{_STRING}{_WS}:{_WS}\{{(?:{_WS}{_STRING}{_WS}:{_WS}(?:{_STRING}|null){_WS},?+)*+{_WS}\}}{_WS},){{1,{ITEMS}}}+"),
}
_SPACE, _CLOSE, _decode = re.compile(_WS), {"[": "]", "{": "}"}, json.JSONDecoder().raw_decode


class _Text:
    """A file's text, of which READ characters and the value that is being read are held."""

    def __init__(self, file):
        start = file.read(READ)
        encoding = json.detect_encoding(start)
        self.file, self.at, self.ended = file, 0, False
        self.decoder = codecs.getincrementaldecoder(encoding)()
        self.held = self.decoder.decode(start)

    def more(self) -> None:
        if self.ended:
            raise ValueError("the text ends early")
        # Twice as much each time, so that a long value is looked at a few times only.
        raw = self.file.read(max(READ, len(self.held) - self.at))
        self.held, self.at, self.ended = self.held[self.at :] + self.decoder.decode(raw, not raw), 0, not raw

    def ahead(self) -> str:
        """The character that comes next, left where it is."""
        while (i := _SPACE.match(self.held, self.at).end()) == len(self.held):
            self.more()
        self.at = i
        return self.held[i]

    def one_of(self, allowed: str) -> str:
        c = self.ahead()
        if c not in allowed:
            raise ValueError(f"{c} instead of one of {allowed}")
        self.at += 1
        return c

    def value(self) -> str:
        """The text of the value that comes next."""
        self.ahead()
        while True:
            try:
                end = _decode(self.held, self.at)[1]
            except ValueError:
                if self.ended:
                    raise
            else:
                if end < len(self.held) or self.ended:  # a number may go on
                    text, self.at = self.held[self.at : end], end
                    return text
            self.more()

    def items(self, close: str) -> Iterator[str]:
        """Texts of ITEMS items at most, of the array or object that has just been opened."""
        if self.ahead() == close:
            self.at += 1
            return
        while True:
            if run := _RUNS[close].match(self.held, self.at):
                self.at = run.end()
                yield run.group()[:-1]
                continue
            yield f"{self.value()}{self.one_of(':')}{_strings(self.value())}" if close == "}" else _string(self.value())
            if self.one_of("," + close) == close:
                return


def _string(value: str) -> str:
    return value if value[0] == '"' or value == "null" else json.dumps(value)


def _strings(value: str) -> str:
    """An object's text with strings for values."""
    if value == "null":
        return value
    text, found = _Text(io.BytesIO(value.encode())), []
    text.one_of("{")
    while text.ahead() != "}":
        found.append(f"{text.value()}{text.one_of(':')}{_string(text.value())}")
        if text.ahead() == ",":
            text.one_of(",")
    return "{" + ",".join(found) + "}"


def _fields(file, short: tuple[str, ...], long: dict[str, str]) -> Iterator[tuple[str, int, str]]:
    """name, place of the first item, text: the short fields, and the long ones in stretches (the last one is empty)."""
    text, seen = _Text(file), set()
    text.one_of("{")
    if text.ahead() == "}":
        return
    while True:
        name = json.loads(text.value())
        text.one_of(":")
        if not isinstance(name, str):
            raise ValueError("a name that isn't a string")
        if name in seen:
            raise ValueError(f"{name} comes twice")
        if name in short or name in long:
            seen.add(name)
        if name not in long or text.ahead() == "n":
            value = text.value()
            if name in short:
                yield name, 0, _string(value)
        else:
            opened, place = text.one_of(long[name]), 0
            for items in text.items(_CLOSE[opened]):
                items = f"{opened}{items}{_CLOSE[opened]}"
                found = json.loads(items)
                yield name, place, items
                place += len(found) if opened == "[" else ITEMS  # names of an object may come twice
            yield name, place, opened + _CLOSE[opened]
        if text.one_of(",}") == "}":
            return


def records(path: str, short: tuple[str, ...], long: dict[str, str]) -> Iterator[tuple[int, str]]:
    """place, text of the records of a file. It is read twice: short fields may come last, and so may an error."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(quote(path, safe=":/")) if ":/" in path else (fs.LocalFileSystem(), path)
    head = {}
    try:
        with store.open_input_stream(name) as f:
            for field, _, value in _fields(f, short, long):
                head[field] = value if field in short else long[field] + _CLOSE[long[field]]
    except UnicodeDecodeError:
        return
    except (ValueError, RecursionError):
        with store.open_input_stream(name) as f:
            raw = f.read()
        yield 0, raw.decode(json.detect_encoding(raw), "replace")
        return
    with store.open_input_stream(name) as f:
        for field, place, value in _fields(f, short, long):
            if field in long:
                yield place, "{" + ",".join(f"{json.dumps(k)}:{v}" for k, v in (head | {field: value}).items()) + "}"


def cut(files: DataFrame, short: tuple[str, ...], long: dict[str, str]) -> DataFrame:
    """file, place, text: the records of files (file long, path), which lie in any store that Arrow opens. `long` gives the
    bracket that opens each long field."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, (pa.int64(), pa.int64(), pa.string()))], names=["file", "place", "text"])

        held, size = ([], [], []), 0
        for b in batches:
            for file, path in zip(b.column("file").to_pylist(), b.column("path").to_pylist()):
                for place, text in records(path, short, long):
                    for column, v in zip(held, (file, place, text)):
                        column.append(v)
                    size += len(text)
                    if size >= BATCH:
                        yield batch()
                        held, size = ([], [], []), 0
        yield batch()

    return files.select("file", "path").mapInArrow(read, "file long, place long, text string")
