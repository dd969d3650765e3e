"""Small tables with the awkward rows that every operator must stand: NULLs, empty and long texts, ties, repeats, clashing names."""

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "the river house stands near old green hill where people walk every morning and evening with their dogs under tall trees".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(100)) if rng.random() < 0.3 else "") for _ in range(n))


def awkward(spark: SparkSession, more: list[tuple] = ()) -> DataFrame:
    """doc_id, text, lang, source and columns whose names the operators use themselves."""
    rows = [
        (1, prose(1, 40), "en", "a.example.com"), (2, None, "en", "a.example.com"), (3, "", None, None), (4, prose(1, 40), "en", "b.example.com"),
        (5, prose(5, 6000), "en", "b.example.com"), (6, "x", None, "b.example.com"), (None, prose(7, 30), "en", None), (8, "   \n\t ", "en", "c"),
        (9, prose(9, 25), "de", "c"), (9, prose(9, 25), "de", "c"), (10, "\x00 ünï \U0001f600   text", "en", "c"), *more,
    ]
    clash = [(*r, i, "k", [1.5], True) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        clash, "doc_id long, text string, lang string, source string, row_id long, key string, logs array<double>, kept boolean"
    )


def no_rows(docs: DataFrame) -> DataFrame:
    return docs.where("false")


def rows_of(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    return {r[key]: r for r in rows_of(df)}
