"""File manifest and file-level operators (A5-A8, A10, Q25, header table for A1/Q9/Q11).

Everything here is one distributed job over the landing folder; the ``content`` column
of the ``binaryFile`` source is only read when checksums are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow import schemas
from finflow.functions import normalize as N
from finflow.sources import headers as H

def manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, length, modificationTime of every file under ``root`` (recursive); the
    ``content`` column is never requested, so no file body is read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return df.select("path", "length", "modificationTime")


def _extension_glob(extensions: list[str]) -> str:
    """Case-insensitive glob for a set of extensions, e.g. ``{*.[cC][sS][vV],...}``."""
    return "{" + ",".join("*." + "".join(f"[{c.lower()}{c.upper()}]" for c in e) for e in extensions) + "}"


def checksums(spark: SparkSession, root: str, extensions: list[str] | None = None,
              max_bytes: int = schemas.MAX_FILE_BYTES) -> DataFrame:
    """path and md5 of the files that pass the gate's extension and size tests. Both tests
    reach the source (``pathGlobFilter`` and a pushed ``length`` filter), so other files
    are never read and no row exceeds the size bound."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", _extension_glob(extensions or schemas.GATE_EXTENSIONS)).load(root)
          .filter(F.col("length") <= max_bytes))
    return df.select("path", F.md5("content").alias("md5"))


def csv_headers(spark: SparkSession, files: DataFrame | str) -> DataFrame:
    """path and header record of the CSV files among ``files`` (a frame with a ``path`` column: this
    run's new files; or a root folder: all below it).

    One small read per file, in tasks that open the files themselves (``headers``). Where only
    Spark's readers know a path's scheme, those very files are read as lines instead.
    """
    listed = manifest(spark, files) if isinstance(files, str) else files
    # A row per new file, as the run's read plan holds as well.
    paths = [r.path for r in listed.filter(extension("path") == "csv").select("path").toLocalIterator()]
    own = [p for p in paths if H.scheme(p) in H.SCHEMES]
    out = H.header_records(spark, own).select("path", "first_line")
    other = [p for p in paths if H.scheme(p) not in H.SCHEMES]
    return out.unionByName(header_lines(spark, other)) if other else out


def header_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Header records by Spark's line reader; quotes left open at a line's end go on over the next lines."""
    names = spark.createDataFrame([(p,) for p in paths], "path string")
    lines = (spark.read.text(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value",
                     F.monotonically_increasing_id().alias("i")).filter(F.col("at") == 0))
    first = lines.groupBy("path").agg(F.min_by("value", "i").alias("first_line"), F.min("i").alias("first_i"))
    quotes = lambda c: F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))
    whole = first.filter(quotes("first_line") % 2 == 0).select("path", "first_line")
    # Rare: lines up to and with the next one that closes the quotes.
    open_ = first.filter(quotes("first_line") % 2 == 1)
    more = lines.join(open_, "path")
    close = more.filter((F.col("i") > F.col("first_i")) & (quotes("value") % 2 == 1)).groupBy("path").agg(F.min("i").alias("last_i"))
    joined = (more.join(close, "path").filter(F.col("i") <= F.col("last_i")).groupBy("path")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda x: x["value"]), "\n").alias("first_line")))
    return names.join(whole.unionByName(joined), "path", "left").select("path", "first_line")


def extension(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_extract(p, r"\.([^./]+)$", 1))


def file_type(path) -> Column:
    """CSV / JSON / Excel / Parquet / Avro / Unknown from the extension (any case)."""
    m = F.create_map(*[F.lit(x) for kv in schemas.FILE_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(m, extension(path)), F.lit("Unknown"))


def gate(files: DataFrame, max_bytes: int = schemas.MAX_FILE_BYTES) -> DataFrame:
    """A5: (is_valid, reason) per file: size limit then extension set."""
    ext = extension("path")
    reason = (F.when(F.col("length") > max_bytes,
                     F.format_string("File too large: %d bytes (max %d)", F.col("length"), F.lit(max_bytes)))
               .when(~ext.isin(schemas.GATE_EXTENSIONS),
                     F.concat(F.lit("Unsupported file type: ."), ext))
               .otherwise(F.lit("OK")))
    return files.withColumn("reason", reason).withColumn("is_valid", F.col("reason") == "OK")


def basename(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -1)


def staged_name(path) -> Column:
    """Flat name in the staging tier."""
    return F.concat(F.lit("ingested/"), basename(path))


def archive_name(path, at) -> Column:
    """``archive/YYYY/MM/DD/<basename>`` for the archive tier."""
    a = F.col(at) if isinstance(at, str) else at
    return F.concat(F.lit("archive/"), F.date_format(a, "yyyy/MM/dd"), F.lit("/"), basename(path))


def name_collisions(files: DataFrame, name_col: str = "staged_name") -> DataFrame:
    """A8 / decision 17: files whose target name another source file maps to as well, one
    row each, with the number of files of that name."""
    groups = files.groupBy(name_col).agg(F.count(F.lit(1)).alias("n_files")).filter(F.col("n_files") > 1)
    return files.select(name_col, "path").join(groups, name_col)


def discover(files: DataFrame, run_keys: DataFrame | None = None) -> DataFrame:
    """Loadable files (csv / json / xlsx, any case); optionally only this run's keys
    (a semi join on the base name, so a run list is never collected)."""
    out = files.filter(extension("path").isin(schemas.ETL_EXTENSIONS))
    if run_keys is not None:
        keys = run_keys.select(basename(F.col(run_keys.columns[0])).alias("__k"))
        out = out.join(keys, basename("path") == F.col("__k"), "left_semi")
    return out.withColumn("file_type", file_type("path")).withColumn("dataset", N.infer_dataset("path"))


def raw_summary(files: DataFrame, root: str) -> DataFrame:
    """A10: per top-level folder: file count, first two names, and how many more.

    Plain aggregates (the two smallest names are kept while merging), so a folder with
    most of the files needs no task of its own.
    """
    r = root.rstrip("/").split("://")[-1].replace("'", "''")
    rel = F.expr(f"substring(path, instr(path, '{r}') + {len(r) + 1})")
    with_dom = files.select(F.when(rel.contains("/"), F.get(F.split(rel, "/"), 0))
                             .otherwise(F.lit("(root)")).alias("domain"), rel.alias("key"))
    first = with_dom.groupBy("domain").agg(F.count(F.lit(1)).alias("n_files"), F.min("key").alias("k1"))
    second = (with_dom.join(first.select("domain", "k1"), "domain").filter(F.col("key") > F.col("k1"))
              .groupBy("domain").agg(F.min("key").alias("k2")))
    return first.join(second, "domain", "left").select(
        "domain", "n_files", F.array_compact(F.array("k1", "k2")).alias("first_two"),
        F.greatest(F.col("n_files") - 2, F.lit(0)).alias("n_more"))


def duplicate_contents(files_with_md5: DataFrame) -> DataFrame:
    """Q25: files whose content occurs more than once, one row each, with the group's size."""
    groups = files_with_md5.groupBy("md5").agg(F.count(F.lit(1)).alias("n_files")).filter(F.col("n_files") > 1)
    return files_with_md5.select("md5", "path").join(groups, "md5")
