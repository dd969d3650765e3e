"""Reading case tables, law-name lists, documents and file listings."""

import itertools
import os
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.functions.arrays import exploded
from lawloom.functions.text import file_stem, lines_of


def read_case_table(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """A case source by suffix; every cell is text, casts come later.

    Without `columns` the names come from the header line. A missing path is Spark's own error. Cells may hold line
    breaks; a file is then read by one task. `multi_line=False` lets Spark split large files whose cells hold none.
    """
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix != "csv":
        raise ValueError(f"unknown file format: {suffix!r}")
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("encoding", "UTF-8")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_with_rejects(spark: SparkSession, path: str, columns: list[str], header: bool = True, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files: rows with as many cells as there are columns, and (file, line, reason) of all others.

    Nothing is bent to fit: a line of too few or too many cells is in the rejects as it stands.
    """
    fields = [T.StructField(c, T.StringType()) for c in [*columns, "_line"]]
    reader = spark.read.schema(T.StructType(fields)).option("header", header).option("multiLine", multi_line).option("escape", '"')
    read = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(path)
    read = read.select(*columns, "_line", F.col("_metadata.file_path").alias("file"))
    reason = F.when(F.col(f"`{columns[-1]}`").isNull(), "too few cells").otherwise("too many cells")
    rejects = read.withColumn("reason", reason).where(F.col("_line").isNotNull())
    return read.where(F.col("_line").isNull()).select(*columns), rejects.select("file", F.col("_line").alias("line"), "reason")


def list_files(spark: SparkSession, folder: str, glob: str, recursive: bool = False) -> DataFrame:
    """(path, length, modificationTime, law_name); file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    return files.select("path", "length", "modificationTime", file_stem(F.col("path")).alias("law_name"))


def metadata_path() -> Column:
    """Path of the file that a row was read from, as it is named on disk; Spark gives it in URI encoding."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


PDF_GLOB, DOCX_GLOB, DOC_GLOB = "*.[pP][dD][fF]", "*.docx", "*.doc"


#: Tasks for each core that files are dealt out to, bytes of text handed on at a time, and paths.
FILE_TASKS, TEXT_BATCH, PATH_BATCH = 8, 4 << 20, 10_000


def read_law_texts(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """(law_name, text): one text file per law, the name from the file name; empty files have no row.

    Laws may be millions of files. Those of a folder that tasks can open are listed and read by tasks, so that the driver holds none of
    their names. In other stores (and for compressed files, or a pattern of more than * and ?) Spark's own reader lists them, in the driver.
    """
    local = _local_folder(spark, folder, glob)
    if local is None:
        files = spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
        return files.select(file_stem(metadata_path()).alias("law_name"), F.col("value").alias("text"))
    parts = FILE_TASKS * spark.sparkContext.defaultParallelism
    top = spark.range(0, 1, 1, 1).select(F.encode(F.lit(local), "UTF-8").alias("path"), F.lit(1).alias("levels"))
    entries = top.mapInArrow(_listed(glob), "path binary, levels int").repartition(parts)
    paths = entries.mapInArrow(_listed(glob), "path binary, levels int").select("path").repartition(parts)
    files = paths.mapInArrow(_read_whole(), "path binary, value binary")
    return files.select(file_stem(F.col("path").cast("string")).alias("law_name"), F.col("value").cast("string").alias("text"))


def _local_folder(spark: SparkSession, folder: str, glob: str) -> str | None:
    """The folder's plain path, if tasks can list it and read its files as Spark's reader does."""
    suffix = glob.rsplit(".", 1)[-1] if "." in glob else ""
    if not suffix.isalnum() or set(glob) & set("[]{}\\") or set(folder) & set("[]{}*?\\"):
        return None
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    if hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hadoop.fs.Path(f"a.{suffix}")) is not None:
        return None
    path = hadoop.fs.Path(folder)
    system = path.getFileSystem(conf)
    if system.getScheme() != "file" or not system.exists(path) or not system.getFileStatus(path).isDirectory():
        return None
    return system.makeQualified(path).toUri().getPath()


def _listed(glob: str):
    """Of paths and levels: files of 0 levels as they are; the files below folders of -1 levels, and what lies one level below those of 1.

    Names are bytes, as they are on disk. Names that Spark's readers take as hidden are passed over.
    """
    wanted = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob), re.DOTALL)

    def hidden(name, is_file):
        marked = name.startswith(".") or name.startswith("_") and "=" not in name
        kept = not is_file and name.startswith(("_common_metadata", "_metadata"))
        return (marked or name.endswith("._COPYING_")) and not kept

    def below(path, levels):
        if levels == 0:
            yield path, 0
            return
        folders = [path]
        while folders:
            with os.scandir(folders.pop()) as entries:
                for entry in entries:
                    name, is_file = entry.name.decode("utf-8", "surrogateescape"), not entry.is_dir()
                    if hidden(name, is_file):
                        continue
                    if is_file and wanted.fullmatch(name):
                        yield entry.path, 0
                    elif not is_file and levels == 1:
                        yield entry.path, -1
                    elif not is_file:
                        folders.append(entry.path)

    def listed(batches):
        found = (f for b in batches for path, levels in zip(b["path"].to_pylist(), b["levels"].to_pylist()) for f in below(path, levels))
        while some := list(itertools.islice(found, PATH_BATCH)):
            paths, levels = zip(*some)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(levels, pa.int32())], ["path", "levels"])

    return listed


def _read_whole():
    """Of paths: (path, value), bytes of the files that are not empty. A function made here is sent to tasks as it is, without this module."""

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], ["path", "value"])

    def read(batches):
        rows, size = [], 0
        for path in (p for b in batches for p in b["path"].to_pylist()):
            with open(path, "rb") as file:
                value = file.read()
            if value:
                rows.append((path, value))
                size += len(path) + len(value)
            if size >= TEXT_BATCH:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)

    return read


def page_lines(pages: DataFrame, keys: list[str], page: str = "page_no", text: str = "text") -> DataFrame:
    """(keys, page, line_no, line): trimmed non-blank lines of page texts; a NULL page has none."""
    return exploded(pages, [*keys, page], lines_of(F.col(text)), "line_no", "line")
