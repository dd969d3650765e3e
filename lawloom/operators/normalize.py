"""Five case sources to one ten-column table, and their union."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.operators.order import row_index


def optional(df: DataFrame, name: str, default: str = "") -> Column:
    """The column if the table has it, else a literal; NULL cells stay NULL."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default)


def first_present(df: DataFrame, names: list[str], default: str = "") -> Column:
    """The first column that the table has; cells are not merged."""
    return next((F.col(f"`{n}`") for n in names if n in df.columns), F.lit(default))


def composite(df: DataFrame, first: str, second: str, compat: bool = False) -> Column:
    """'first / second'; one part when only its column is there.

    NULL parts are skipped; with `compat` they read 'nan', as a text cast of a missing cell does.
    """
    if first in df.columns and second in df.columns:
        a, b = F.col(f"`{first}`"), F.col(f"`{second}`")
        if compat:
            return F.concat(F.coalesce(a, F.lit("nan")), F.lit(" / "), F.coalesce(b, F.lit("nan")))
        return F.concat_ws(" / ", a, b)
    return optional(df, first)


def strict_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Selects and renames; a missing column is an error."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{k}`").alias(v) for k, v in mapping.items()])


def project_if_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Selects a column list only when the table has all of it."""
    return df.select(*[F.col(f"`{c}`") for c in columns]) if set(columns) <= set(df.columns) else df


def conform(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Common columns in order; absent ones are ''.

    The index is a whole number; `1.0` reads as 1. What is no whole number becomes NULL here and is listed by
    `odd_indexes`.
    """
    columns = [optional(df, c).alias(c) for c in C.COMMON_COLUMNS if c != "index"]
    given = F.trim(optional(df, "index").cast("string"))
    index = F.regexp_extract(given, r"^([+-]?[0-9]{1,18})(?:\.0*)?$", 1).try_cast("bigint").alias("index")
    return df.select(index, *columns, *extra)


def odd_indexes(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(*extra, index_text, reason): index cells that `conform` cannot read as a whole number, so that none is lost silently."""
    given = F.trim(optional(df, "index").cast("string"))
    odd = given.isNotNull() & (given != "") & ~given.rlike(r"^[+-]?[0-9]{1,18}(?:\.0*)?$")
    return df.where(odd).select(*extra, given.alias("index_text"), F.lit("index is not a whole number").alias("reason"))


def _numbered(df: DataFrame, pos: str, column: str | None = None) -> tuple[DataFrame, Column]:
    """The table and its index column: an existing one, else 1..n by `pos`."""
    if column and column in df.columns:
        return df, F.col(f"`{column}`")
    return row_index(df, pos, "_index"), F.col("_index")


def _mapped(df: DataFrame, pos: str, index: Column, kind: str, **columns: Column) -> DataFrame:
    named = {"sandbox_type": F.lit(kind)} | columns
    return conform(df.select(index.alias("index"), *[c.alias(n) for n, c in named.items()], F.col(pos).alias("ord")), ("ord",))


def normalize_ict(df: DataFrame, pos: str = "pos") -> DataFrame:
    return conform(strict_rename(df, C.ICT_COLUMNS | {pos: "ord"}).withColumn("sandbox_type", F.lit("ICT")), ("ord",))


def normalize_regzone(df: DataFrame, pos: str = "pos", compat: bool = False) -> DataFrame:
    df, index = _numbered(df, pos)
    return _mapped(
        df, pos, index, "REG_ZONE",
        category=composite(df, "대제목", "중제목", compat),
        title=optional(df, "소제목"),
        main_content=optional(df, "현황"),
        regulatory_issue=optional(df, "규제내용"),
        regulatory_relief=optional(df, "허용"),
    )


def normalize_fin(df: DataFrame, pos: str = "pos") -> DataFrame:
    df, index = _numbered(df, pos)
    return _mapped(
        df, pos, index, "FIN",
        category=optional(df, "지정 제도"),
        title=optional(df, "서비스명"),
        main_content=optional(df, "서비스 주요 내용"),
        regulatory_issue=first_present(df, ["규제내용", "본문 일부"]),
        regulatory_relief=optional(df, "규제 특례 내용"),
        conditions=optional(df, "주요 부가 조건 내용"),
    )


def normalize_ind_law(df: DataFrame, pos: str = "pos") -> DataFrame:
    df, index = _numbered(df, pos, "순번")
    return _mapped(
        df, pos, index, "IND_LAW",
        category=optional(df, "국조실분류"),
        title=optional(df, "사업명"),
        main_content=optional(df, "규제내용"),
        regulatory_issue=optional(df, "규제내용"),
    )


def normalize_ind_case(df: DataFrame, pos: str = "pos") -> DataFrame:
    df, index = _numbered(df, pos, "번호")
    return _mapped(
        df, pos, index, "IND_CASE",
        category=first_present(df, ["구분(Category)", "구분"]),
        title=optional(df, "제목"),
        main_content=optional(df, "주요내용"),
        regulatory_issue=optional(df, "규제내용"),
        regulatory_relief=optional(df, "규제개정현황(유사)"),
        expected_effect=optional(df, "기대효과"),
        achievements=optional(df, "주요성과"),
    )


NORMALIZERS = {
    "ICT": normalize_ict,
    "REG_ZONE": normalize_regzone,
    "FIN": normalize_fin,
    "IND_LAW": normalize_ind_law,
    "IND_CASE": normalize_ind_case,
}


def master_union(sources: dict[str, DataFrame], pos: str = "pos") -> DataFrame:
    """All sources in fixed order; src_no and ord give the order of rows."""
    parts = [
        normalize(sources[kind], pos).withColumn("src_no", F.lit(n))
        for n, (kind, normalize) in enumerate(NORMALIZERS.items(), 1)
        if kind in sources
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


#: Where a source's index cells come from its own column; the others are numbered.
INDEX_COLUMNS = {"ICT": "번호", "IND_LAW": "순번", "IND_CASE": "번호"}


def master_odd_indexes(sources: dict[str, DataFrame], pos: str = "pos") -> DataFrame:
    """(sandbox_type, ord, index_text, reason): the index cells that are NULL in master_union though the source holds a text."""
    union = None
    for kind in (k for k in NORMALIZERS if k in sources):
        given = optional(sources[kind], INDEX_COLUMNS.get(kind, "")).cast("string").alias("index")
        cells = sources[kind].select(F.lit(kind).alias("sandbox_type"), F.col(pos).alias("ord"), given)
        odd = odd_indexes(cells, ("sandbox_type", "ord"))
        union = odd if union is None else union.unionByName(odd)
    return union
