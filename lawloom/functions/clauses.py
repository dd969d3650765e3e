"""Clause marks ①-⑳: splitting, naming and rejoining."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.functions.arrays import bind
from lawloom.functions.text import blank_to_null, collapse, strip


def split_clause_start(line: Column) -> tuple[Column, Column]:
    """(mark or NULL, rest) of one line."""
    has_mark = line.rlike(f"^[{C.CLAUSE_MARKS}]")
    mark = F.when(has_mark, F.substring(line, 1, 1))
    rest = F.when(has_mark, strip(F.substring(line, 2, 2147483647))).otherwise(line)
    return mark, rest


def clause_array(text: Column, keep_lead: bool = False) -> Column:
    """array<struct<mark,text>>; text before the first mark is dropped unless `keep_lead`."""
    pattern = f"([{C.CLAUSE_MARKS}])([^{C.CLAUSE_MARKS}]*)"
    no_mark = F.lit(None).cast("string").alias("mark")

    def split(t):
        pairs = F.zip_with(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(1)),
            F.regexp_extract_all(t, F.lit(pattern), F.lit(2)),
            lambda m, x: F.struct(m.alias("mark"), F.trim(x).alias("text")),
        )
        if keep_lead:
            lead = F.trim(F.regexp_extract(t, f"^([^{C.CLAUSE_MARKS}]*)", 1))
            pairs = F.concat(F.array(F.struct(no_mark, lead.alias("text"))), pairs)
        whole = F.array(F.struct(no_mark, t.alias("text")))
        unsplit = F.contains(t, F.lit(C.OMITTED)) | ~t.rlike(f"[{C.CLAUSE_MARKS}]")
        found = bind(F.filter(pairs, lambda p: p.text != ""), lambda f: F.when(F.size(f) > 0, f).otherwise(whole))
        return F.when(unsplit, whole).otherwise(found)

    return bind(collapse(text), split)


def clause_label(mark: Column) -> Column:
    """'①' -> '1항'; NULL or '' -> ''; anything else unchanged."""
    return (
        F.when(F.coalesce(mark, F.lit("")) == "", F.lit(""))
        .when(mark.rlike(f"^[{C.CLAUSE_MARKS}]$"), F.concat((F.ascii(mark) - 9311).cast("string"), F.lit("항")))
        .otherwise(mark)
    )


def full_text(clauses: Column) -> Column:
    return collapse(F.array_join(F.transform(clauses, lambda x: blank_to_null(x.text)), " "))
