"""Readers for landed CSV, JSON and XLSX files (A1-A3, Q24).

All text is read as strings (no schema inference on the hot path); ``source_file``
keeps the per-file grain through the plan.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow.functions.normalize import null_words

CORRUPT = "_corrupt_record"


_EXTRA = "__extra_cells"


def unique_names(names: list[str]) -> list[str]:
    """Repeated column names get ``.1``, ``.2`` ...; nameless ones ``Unnamed: <place>``."""
    out: list[str] = []
    for i, name in enumerate(names):
        name = name if name else f"Unnamed: {i}"
        k, unique = 0, name
        while unique in out:
            k += 1
            unique = f"{name}.{k}"
        out.append(unique)
    return out


def csv_header(first_record: str | None) -> list[str]:
    """Column names of a CSV header record (quotes, commas in quotes, byte-order mark)."""
    if not first_record:
        return []
    return unique_names([c.strip() for c in next(csv.reader(io.StringIO(first_record.lstrip("\ufeff"))), [])])


def read_csv_group(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """A1 / Q24: CSV files sharing one header, all columns as text.

    Quoted cells may hold commas, doubled quotes and line breaks; a byte-order mark is
    skipped. Missing-value words are null, short rows are filled with nulls, and a row
    with more cells than the header is malformed (``_corrupt_record`` is set).
    """
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*columns, _EXTRA]])
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("multiLine", True).option("escape", '"').option("emptyValue", "").option("enforceSchema", True).csv(paths))
    df = df.withColumn("source_file", F.col("_metadata.file_path"))
    df = df.withColumn(CORRUPT, F.when(F.col(_EXTRA).isNotNull(), F.lit("more cells than the header")))
    # Where a quoted cell breaks its line otherwise than the file, the reader leaves a row's \r on its last cell.
    df = df.withColumns({c: F.rtrim(F.col(f"`{c}`"), F.lit("\r")) for c in columns})
    return null_words(df, columns).drop(_EXTRA)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """A2: nested structs become dotted top-level columns; arrays are kept as they are."""
    def walk(schema: T.StructType, prefix: list[str]):
        for f in schema.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, path)
            else:
                yield path
    cols = []
    for path in walk(df.schema, []):
        ref = F.col(".".join(f"`{p}`" for p in path))
        cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def read_json(spark: SparkSession, paths: list[str], multiline: bool = True) -> DataFrame:
    """A2: JSON arrays of objects (``multiline``) or JSON Lines; scalars read as text.

    The schema is inferred from every record, so nested objects and unexpected keys are
    seen (Q11).
    """
    df = (spark.read.option("multiLine", multiline).option("primitivesAsString", True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(paths))
    df = df.withColumn("source_file", F.col("_metadata.file_path"))
    flat = flatten(df)
    return flat


def json_columns(spark: SparkSession, paths: list[str], columns: list[str], multiline: bool = True) -> DataFrame:
    """source_file and the columns (of ``columns``, dotted for nested objects) whose key occurs in that file.

    A key counts as there even if all its values are null, which a shared schema cannot
    tell from an absent one; the records are read as variants for that.
    """
    raw = spark.read.option("multiLine", multiline).option("singleVariantColumn", "v").json(paths)
    raw = raw.select(F.col("_metadata.file_path").alias("source_file"), "v")
    one = F.expr("CASE WHEN startswith(schema_of_variant(v), 'ARRAY') THEN CAST(v AS ARRAY<VARIANT>) ELSE array(v) END")
    objects = raw.select("source_file", F.explode(one).alias("o")).where(F.expr("startswith(schema_of_variant(o), 'OBJECT')"))
    keys = F.explode(F.map_keys(F.col("o").cast("map<string,variant>")))
    tops = objects.select("source_file", keys.alias("k")).groupBy("source_file").agg(F.collect_set("k").alias("keys"))
    named = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(c.split(".")[0]).alias("top")) for c in columns])
    there = F.filter(named, lambda n: F.array_contains("keys", n["c"]) | F.array_contains("keys", n["top"]))
    return tops.select("source_file", F.transform(there, lambda n: n["c"]).alias("columns"))


# --- XLSX (first sheet) --------------------------------------------------------------

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PACK = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")
# Built-in number formats that show a date or a time (fixed by the file format).
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
# Rows of a workbook handed on at a time.
_CHUNK_ROWS = 5000


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet(z: zipfile.ZipFile) -> str:
    """The part of the workbook's first sheet, in the order of its tabs."""
    sheet = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_MAIN}sheets/{_MAIN}sheet")
    links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(_PACK)}
    target = links[sheet.get(_LINK)]
    return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")


def _text(node) -> str:
    """Text of a string item: its runs, without phonetic hints."""
    return "".join(t.text or "" for part in [node, *node.findall(f"{_MAIN}r")] for t in part.findall(f"{_MAIN}t"))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}

    def is_date(fmt: int) -> bool:
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", own.get(fmt, "")).lower()
        return fmt in _DATE_FORMATS or bool(re.search(r"[ymdhs]", code)) and "general" not in code

    return {i for i, x in enumerate(root.findall(f"{_MAIN}cellXfs/{_MAIN}xf")) if is_date(int(x.get("numFmtId", 0)))}


def _serial_date(value: str, epoch_1904: bool) -> str:
    """ISO text of a serial day number (the 1900 system counts a 29 February 1900)."""
    days = float(value)
    start = dt.datetime(1904, 1, 1) if epoch_1904 else dt.datetime(1899, 12, 30) if days >= 60 else dt.datetime(1899, 12, 31)
    at = start + dt.timedelta(seconds=round(days * 86400))
    return at.strftime("%Y-%m-%d %H:%M:%S") if at.time() != dt.time() else at.strftime("%Y-%m-%d")


def xlsx_rows(data: bytes):
    """Cell text of the first sheet, row by row (strings, numbers, dates as ISO text)."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")]
    dates = _date_styles(z)
    props = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_MAIN}workbookPr")
    epoch_1904 = props is not None and props.get("date1904") in ("1", "true")
    with z.open(_first_sheet(z)) as part:
        for _, r in ET.iterparse(part):
            if r.tag != f"{_MAIN}row":
                continue
            cells: dict[int, str | None] = {}
            for c in r.findall(f"{_MAIN}c"):
                ref = _CELL_REF.match(c.get("r", ""))
                idx = _col_index(ref.group(1)) if ref else len(cells)
                kind, v = c.get("t"), c.find(f"{_MAIN}v")
                if kind == "s" and v is not None:
                    val = shared[int(v.text)]
                elif kind == "inlineStr":
                    val = _text(c.find(f"{_MAIN}is"))
                elif v is not None and kind in (None, "n") and v.text and int(c.get("s", 0)) in dates:
                    val = _serial_date(v.text, epoch_1904)
                else:
                    val = v.text if v is not None else None
                cells[idx] = val
            yield [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]
            r.clear()


XLSX_SCHEMA = "source_file string, row_id long, cells map<string,string>"


def _decode_xlsx(batches):
    """Rows of each workbook in chunks; row 0 carries the header alone."""
    names = ["source_file", "row_id", "cells"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            out = []
            try:
                header = None
                for i, row in enumerate(xlsx_rows(bytes(content))):
                    if header is None:
                        header = unique_names([(h or "").strip() for h in row])
                        out.append((path, 0, dict.fromkeys(header)))
                        continue
                    cells = {h: (row[j] if j < len(row) else None) for j, h in enumerate(header)}
                    if len(row) > len(header) and any(row[len(header):]):
                        cells[CORRUPT] = "more cells than the header"
                    out.append((path, i, cells))
                    if len(out) >= _CHUNK_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            except Exception as e:  # noqa: BLE001 - one unreadable workbook must not fail the job
                out.append((path, 1, {CORRUPT: f"unreadable workbook: {type(e).__name__}: {e}"}))
            yield pd.DataFrame(out, columns=names)


def workbook_cells(raw: DataFrame) -> DataFrame:
    """source_file, row_id (0: the header row), cells of any (path, content) frame of workbooks."""
    # One workbook per Arrow batch would need a session setting; a workbook's rows go on in chunks instead.
    return raw.select("path", "content").mapInPandas(_decode_xlsx, XLSX_SCHEMA)


def workbook_columns(cells: DataFrame) -> DataFrame:
    """source_file and the column names of its header row."""
    head = cells.where("row_id = 0").select("source_file", F.map_keys("cells").alias("columns"))
    return head


def decode_workbooks(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A3: first sheet of each workbook; ``columns`` fixes the output columns, otherwise
    they are the union of all headers."""
    cells = workbook_cells(raw)
    if columns is None:
        columns = union_columns(workbook_columns(cells))
    return workbook_rows(cells, columns).drop(CORRUPT)


def union_columns(per_file: DataFrame) -> list[str]:
    """Distinct names over all files' columns."""
    return sorted(r[0] for r in per_file.select(F.explode("columns")).distinct().collect())


def workbook_rows(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Data rows as columns of text; missing-value words are null."""
    data = cells.where("row_id > 0")
    df = data.select(*[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns], "source_file",
                     F.try_element_at("cells", F.lit(CORRUPT)).alias(CORRUPT), "row_id")
    return null_words(df, columns).drop("row_id")


def read_xlsx(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """A3: Spark has no XLSX source; workbooks are zip files, decoded with the standard
    library, one at a time in a task. Files are bounded by the ingestion gate."""
    return decode_workbooks(spark.read.format("binaryFile").load(paths), columns)
