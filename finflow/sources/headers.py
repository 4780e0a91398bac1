"""Header records of landed CSV files, as a Python data source.

A partition is a run of file paths; its task opens each file, reads a few kilobytes and goes on only
while the header's quotes stay open, so a file's body is never read to learn its columns.
"""

from __future__ import annotations

import json
import re
import sys
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "csv_header_records"
FIRST_READ = 4096
FILES_A_TASK = 64
#: Schemes that a task opens by itself, and their names there.
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}

_MARK = re.compile(rb'["\n\r]')


def scheme(path: str) -> str:
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/", path)
    return m[1].lower() if m else ""


def opened(path: str):
    """A readable binary stream of a landed file, local or in an object store."""
    own = SCHEMES[scheme(path)]
    if own == "file":
        return open(re.sub(r"^file:/+", "/", path), "rb")
    from pyarrow.fs import FileSystem
    fs, place = FileSystem.from_uri(own + ":" + quote(path.partition(":")[2], safe="/:@"))
    return fs.open_input_stream(place)


def first_record(stream, step: int = FIRST_READ) -> tuple[str | None, int]:
    """(the first record, bytes read): up to the first line end outside quotes, or the end of the file.
    A record whose quotes never close is None."""
    data, at, quoted = b"", 0, False
    while more := stream.read(step):
        data += more
        for m in _MARK.finditer(data, at):
            if m[0] == b'"':
                quoted = not quoted
            elif not quoted:
                return data[:m.start()].decode("utf-8", "replace"), len(data)
        at, step = len(data), 4 * step
    return (None if quoted else data.decode("utf-8", "replace")), len(data)


class HeaderReader(DataSourceReader):
    def __init__(self, paths: list[str], together: int):
        self.paths, self.together = paths, together

    def partitions(self):
        return [InputPartition(self.paths[k:k + self.together]) for k in range(0, len(self.paths), self.together)]

    def read(self, partition):
        for path in partition.value if partition else []:
            with opened(path) as f:
                yield path, *first_record(f)


class HeaderSource(DataSource):
    """``paths``: JSON list of files; ``filesPerTask``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "path string, first_line string, bytes_read long"

    def reader(self, schema):
        return HeaderReader(json.loads(self.options["paths"]), int(self.options.get("filesPerTask", FILES_A_TASK)))


# The source travels with its code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def header_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, first_line, bytes_read of files whose scheme is in ``SCHEMES``."""
    if not paths:
        return spark.createDataFrame([], "path string, first_line string, bytes_read long")
    spark.dataSource.register(HeaderSource)
    return spark.read.format(FORMAT).option("paths", json.dumps(paths)).load()
