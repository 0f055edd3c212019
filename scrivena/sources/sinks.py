"""What the engine writes: label lines, logs, splits and reports. A driver writes only single small files."""

from __future__ import annotations

import json

import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivena.operators.training import conform


def detection_line(path: Column, polygons: Column) -> Column:
    return F.concat(path, F.lit("\t"), F.to_json(polygons))


def recognition_line(path: Column, text: Column) -> Column:
    return F.concat_ws(" ", path, text)


def flag(value: Column) -> Column:
    return F.when(value, "Y").otherwise("N")


def write_lines(rows: DataFrame, column: str, path: str, mode: str = "append") -> None:
    rows.select(F.col(column).alias("value")).write.mode(mode).text(path)


def append_log(rows: DataFrame, header: list[str], path: str) -> None:
    """Rows under a fixed header, as CSV; missing columns are empty, others dropped."""
    conform(rows, header).write.mode("append").option("header", True).csv(path)


def append_events(rows: DataFrame, path: str) -> None:
    """JSON lines without null fields."""
    rows.write.mode("append").option("ignoreNullFields", True).json(path)


def write_files(rows: DataFrame, folder: str) -> int:
    """A file for each row of (name, content binary), below a folder of any store that Arrow opens; how many there are.
    A task that runs again writes the same files again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        for b in batches:
            for name, content in zip(b.column("name").to_pylist(), b.column("content").to_pylist()):
                path = posixpath.join(root, name)
                store.create_dir(posixpath.dirname(path), recursive=True)
                with store.open_output_stream(path) as f:
                    f.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    return rows.select("name", "content").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_parts(rows: DataFrame, folder: str, end: str, sep: str = ",") -> int:
    """A file for each name of rows (name, opening, piece), below a folder of any store that Arrow opens; how many there are.
    A name's rows lie in one partition and in order. Its file has its pieces with `sep` between them, each run of equal
    openings after that opening, and `end`; it is written as its rows come, never held whole. A task that runs again writes
    the same files again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import compute, fs

        store, root = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
        n, f, last = 0, None, (None, None)
        for b in batches:
            names, openings, pieces = (b.column(c) for c in ("name", "opening", "piece"))
            ends = sorted({e for c in (names, openings) for e in compute.run_end_encode(c).run_ends.to_pylist()})
            runs = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pieces)
            for i, text in zip([0, *ends], compute.binary_join(runs, pa.scalar(sep, pieces.type)).to_pylist()):
                name, opening = names[i].as_py(), openings[i].as_py()
                if name != last[0]:
                    if f:
                        f.write(end.encode())
                        f.close()
                    path = posixpath.join(root, name)
                    store.create_dir(posixpath.dirname(path), recursive=True)
                    n, f = n + 1, store.open_output_stream(path, buffer_size=1 << 20)
                f.write((sep if (name, opening) == last else opening).encode())
                f.write(text.encode())
                last = name, opening
        if f:
            f.write(end.encode())
            f.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return rows.select("name", "opening", "piece").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def quality_rows(checks: DataFrame) -> DataFrame:
    """filename, passed, reasons, contains_personal_info -> the columns of the quality log."""
    return checks.select("filename", flag(F.col("passed")).alias("passed"), F.array_join("reasons", "|").alias("reject_reasons"), flag(F.col("contains_personal_info")).alias("contains_personal_info"))


def write_split(images: DataFrame, path: str) -> None:
    """A folder for each split; an existing one is frozen."""
    images.write.mode("errorifexists").partitionBy("split").parquet(path)


def write_table(rows: DataFrame, path: str, files: int | None = None) -> None:
    (rows.coalesce(files) if files else rows).write.mode("overwrite").option("header", True).csv(path)


def write_json(spark, payload: dict, path: str) -> None:
    """One JSON text, by Spark's writer, so that any store serves."""
    spark.createDataFrame([(json.dumps(payload, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def report(title: str, figures: dict, tables: dict[str, list[dict]] | None = None) -> str:
    """A Markdown report of a few figures and short tables."""
    out = [f"# {title}", ""]
    out += [f"- {k}: {v:.4f}" if isinstance(v, float) else f"- {k}: {v}" for k, v in figures.items()]
    for name, rows in (tables or {}).items():
        out += ["", f"## {name}", ""]
        if rows:
            out += ["| " + " | ".join(rows[0]) + " |", "|" + "---|" * len(rows[0])]
            out += ["| " + " | ".join(str(v) for v in r.values()) + " |" for r in rows]
    return "\n".join(out) + "\n"


#: Rows of a report's table at most.
REPORTED = 1000


def _short(table: DataFrame) -> list[dict]:
    rows = table.limit(REPORTED + 1).collect()
    if len(rows) > REPORTED:
        raise ValueError(f"a report's table has {REPORTED} rows at most; write longer ones as tables")
    return [r.asDict(recursive=True) for r in rows]


def evaluation_report(summary: DataFrame, title: str, **tables: DataFrame) -> str:
    """A report of a one-row summary and of short tables (top-k, fixed groups); longer ones are refused."""
    return report(title, summary.first().asDict(), {k: _short(v) for k, v in tables.items()})


def deploy_manifest(gates: DataFrame, version: str, approved_by: str, checkpoints: dict[str, str]) -> dict:
    return {"version": version, "approved_by": approved_by, "checkpoints": checkpoints, "gates": _short(gates.orderBy("gate"))}
