"""A result that several outputs need, worked out once and kept in the folder that all executors share."""

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only a local session may leave it unset, which then gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and (spark.sparkContext.master + "[").startswith("local["):
        named = tempfile.mkdtemp(prefix="lawloom-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


#: With this setting Spark removes a query's shuffle files when it ends, not when the driver next happens to collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _cleaned_up(spark: SparkSession):
    """Queries that run inside need their shuffle files no more when they end, since their rows are in files."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before) if before is not None else spark.conf.unset(CLEAN_UP)


def stored(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """(the rows of df read back from files, values of the aggregate `measures`); df is worked out once, and the measures in the same pass."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    seen = Observation(name)
    watched = df.observe(seen, *[c.alias(m) for m, c in measures.items()]) if measures else df
    with _cleaned_up(df.sparkSession):
        watched.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if measures else {}
