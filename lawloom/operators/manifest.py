"""What was collected, what is missing, what failed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions.text import file_name, file_stem, strip

FORMATS = {"pdf": r"\.pdf\z", "docx": r"\.doc[^./]*\z"}


def law_names(df: DataFrame, column: str, pos: str | None = None) -> DataFrame:
    """Trimmed, non-blank names of one column, with their place `pos` where it is named; an error when the column or all names are absent."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; the table has {df.columns}")
    kept = [F.col(pos).alias("pos")] if pos else []
    names = df.select(strip(F.col(column).cast("string")).alias("law_name"), *kept).where(
        F.col("law_name").isNotNull() & (F.col("law_name") != "")
    )
    if names.isEmpty():
        raise ValueError("no law names")
    return names


def check_format(file_format: str) -> str:
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}; one of {sorted(FORMATS)}")
    return file_format


def finished(files: DataFrame, path: str = "path") -> DataFrame:
    """Files that are not unfinished downloads."""
    return files.where(~F.endswith(path, F.lit(".crdownload")))


def stems(files: DataFrame, file_format: str, path: str = "path") -> DataFrame:
    kept = files.where(F.col(path).rlike(FORMATS[check_format(file_format)]))
    return kept.select(file_stem(F.col(path)).alias("stem")).distinct()


def missing_names(names: DataFrame, files: DataFrame, file_format: str = "pdf", name: str = "law_name", path: str = "path") -> DataFrame:
    """Names whose file name is not among the collected files."""
    have = stems(files, file_format, path)
    return names.join(have, file_name(names[name]) == have["stem"], "left_anti")


def new_files(after: DataFrame, before: DataFrame, path: str = "path") -> DataFrame:
    """Finished files of the later listing that the earlier one lacks."""
    return finished(after, path).join(finished(before, path).select(path).distinct(), path, "left_anti")


def newest_file(files: DataFrame, path: str = "path", modified: str = "modificationTime") -> DataFrame:
    """Path of the file modified last; the greater path among equals."""
    return files.agg(F.max(F.struct(modified, path)).alias("_f")).select(F.col(f"_f.{path}").alias(path))


def have_missing_counts(names: DataFrame, files: DataFrame, file_format: str = "pdf", name: str = "law_name", path: str = "path") -> DataFrame:
    """(n_total, n_have, n_missing) of names."""
    have = stems(files, file_format, path).withColumn("_have", F.lit(True))
    joined = names.join(have, file_name(names[name]) == have["stem"], "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("_have").isNotNull()).alias("n_have"),
        F.count_if(F.col("_have").isNull()).alias("n_missing"),
    )


def outcomes(df: DataFrame, key: Column, error: Column) -> DataFrame:
    """(key, status, error): failed where there is an error."""
    return df.select(key.alias("key"), F.when(error.isNull(), "ok").otherwise("failed").alias("status"), error.alias("error"))


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )


def retry_plan(names: DataFrame, before: DataFrame, after: DataFrame, file_format: str = "pdf", name: str = "law_name", path: str = "path") -> DataFrame:
    """Outcome of every name missing at first: ok when the later listing has it."""
    missing = missing_names(names, before, file_format, name, path)
    have = stems(after, file_format, path).withColumn("_have", F.lit(True))
    joined = missing.join(have, file_name(missing[name]) == have["stem"], "left")
    return outcomes(joined, F.col(name), F.when(F.col("_have").isNull(), "file not found"))
