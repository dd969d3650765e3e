"""Law texts cut as their files arrive: waiting for new files, as a stream.

Segmentation works inside a row and keeps no state between rows, so the batch operator serves a
stream unchanged; the checkpoint of the stream remembers which files were taken.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions.text import file_stem
from lawloom.operators import segment
from lawloom.sources.readers import metadata_path


def arriving_texts(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """(law_name, text) of finished files; unfinished downloads are passed over."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).schema("value string")
    texts = reader.text(folder, wholetext=True, pathGlobFilter="*.txt")
    path = metadata_path()
    return texts.where(~F.endswith(path, F.lit(".crdownload"))).select(file_stem(path).alias("law_name"), F.col("value").alias("text"))


def arriving_rows(spark: SparkSession, folder: str, rules: segment.Rules = segment.PAGE_RULES) -> DataFrame:
    return segment.segment(arriving_texts(spark, folder), rules=rules)
