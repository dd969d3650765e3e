"""Whole flows: DataFrames in, DataFrames out; writing is a separate step."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom import constants as C
from lawloom.operators import cases, dedup, fields, lawhtml, listing, lookup, manifest, normalize, segment, tables
from lawloom.operators.order import file_row_index, first_rows
from lawloom.sources.readers import read_case_table
from lawloom.sources.staging import stored
from lawloom.sources.writers import in_file_order, write_csv, write_if_any, write_json_lines, write_per_law, write_quoted_csv


def read_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Case sources by kind, with `pos` as their place in the file."""
    return {kind: file_row_index(read_case_table(spark, path), "pos") for kind, path in paths.items()}


def master_table(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    return normalize.master_union(read_sources(spark, paths))


def save_master(spark: SparkSession, paths: dict[str, str], folder: str, each: bool = False) -> None:
    """The master table in its order, and beside it the index cells that it holds as NULL for being no whole number, if any.

    With `each`, every normalised source has its own table too. The sources are mapped once, however many tables are written.
    """
    sources = read_sources(spark, paths)
    master, _ = stored(normalize.master_union(sources), "master")
    write_csv(in_file_order(master, "src_no", "ord").select(*C.COMMON_COLUMNS), f"{folder}/master")
    for n, kind in enumerate(normalize.NORMALIZERS, 1):
        if each and kind in sources:
            own = in_file_order(master.where(F.col("src_no") == n), "ord").select(*C.COMMON_COLUMNS)
            write_csv(own, f"{folder}/normalized_{kind.lower()}")
    write_if_any(normalize.master_odd_indexes(sources), f"{folder}/master_odd_indexes")


def law_corpus(documents: DataFrame, rules: segment.Rules = segment.PAGE_RULES) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of (law_name, text): documents without text are listed, not cut."""
    return segment.segment(documents, rules=rules), segment.rejects(documents)


def save_laws(rows: DataFrame, folder: str, merge: bool = True) -> None:
    """One folder per law, and all laws together when wanted, by law and reading order (`ord`). The rows are worked out once."""
    kept, _ = stored(rows, "law-rows")
    columns = [c for c in rows.columns if c != "ord"]
    dealt = kept.withColumn("_ord", F.col("ord")).drop("ord")
    write_per_law(dealt, f"{folder}/laws", order=("_ord",), columns=columns)
    if merge:
        write_csv(in_file_order(kept, "law_name", "ord").select(*columns), f"{folder}/all_laws")


def law_html_corpus(names: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, outcomes) of requested law names and (law_name, html) pages."""
    asked = names.select("law_name").distinct()
    joined = asked.join(pages.select("law_name", "html"), "law_name", "left")
    results = manifest.outcomes(joined, F.col("law_name"), F.when(F.col("html").isNull(), "no page"))
    return lawhtml.law_html_rows(joined.where(F.col("html").isNotNull())), results


def selected_cases(
    index: DataFrame, pages: DataFrame, ids=None, clean: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(main, meta, unmatched, rejects) of an index, its detail pages (url, html) and selected ids.

    An id without a page gives blank fields, and its key goes to the rejects too.
    """
    chosen = lookup.selected_ids(index, ids)
    rows = lookup.lookup(index, chosen, ["form_code", "page_no", "pos"])
    found = fields.with_fields(lookup.with_detail_page(rows, pages))
    main, meta = fields.case_tables(found, clean, keys=("page_no", "pos"))
    failed = manifest.outcomes(found, F.col("bdSeq"), F.when(F.col("html").isNull(), "no detail page"))
    return main, meta, lookup.unmatched(index, chosen), failed.where(F.col("status") == "failed")


def save_cases(main: DataFrame, meta: DataFrame, folder: str, run_id: str, save_meta: bool = True) -> None:
    """CSV and JSON lines of the main table, and of the provenance table when wanted; empty ones are not written."""
    write_if_any(main, f"{folder}/selected_{run_id}_csv")
    write_if_any(main, f"{folder}/selected_{run_id}_jsonl", write_json_lines)
    write_if_any(meta, f"{folder}/selected_meta_{run_id}_csv", wanted=save_meta)
    write_if_any(meta, f"{folder}/selected_meta_{run_id}_jsonl", write_json_lines, wanted=save_meta)


def save_selected(
    index: DataFrame, pages: DataFrame, folder: str, run_id: str, ids: list | DataFrame | None = None, clean: bool = True, save_meta: bool = True
) -> dict:
    """selected_cases, written: CSV and JSON lines of main and provenance tables and the rejects, those that have rows. The counts of rows and rejects.

    A given list of ids is kept in its order, all other selections in that of the index. Each page is parsed once: the fields are stored with
    their counts, and all outputs are written from there.
    """
    listed = isinstance(ids, (list, tuple))
    chosen = lookup.ordered_ids(index.sparkSession, list(ids)) if listed else lookup.selected_ids(index, ids)
    rows = lookup.lookup(index, chosen, ["form_code", "page_no", "pos"])
    order = ("selected_pos",) if listed else ("form_code", "page_no", "pos")
    rows = lookup.in_order(rows, chosen) if listed else rows
    found = fields.with_fields(lookup.with_detail_page(rows, pages)).withColumn("no_page", F.col("html").isNull()).drop("html")
    kept, seen = stored(found, "selected-cases", n_rows=F.count(F.lit(1)), n_failed=F.count_if(F.col("no_page")))
    places = {f"_order{n}": F.col(c) for n, c in enumerate(order)}
    main, meta = fields.case_tables(kept.withColumns(places), clean, keys=tuple(places))
    for table, name, wanted in ((main, "selected", True), (meta, "selected_meta", save_meta)):
        if wanted and seen.get("n_rows"):
            ordered = in_file_order(table, *places).drop(*places)
            write_csv(ordered, f"{folder}/{name}_{run_id}_csv")
            write_json_lines(ordered, f"{folder}/{name}_{run_id}_jsonl")
    if seen.get("n_failed"):
        write_csv(manifest.outcomes(kept.where("no_page"), F.col("bdSeq"), F.lit("no detail page")), f"{folder}/selected_rejects_{run_id}")
    return seen


def save_special_laws(pages: DataFrame, folder: str, run_id: str, pos: str = "pos") -> None:
    """The three-column table of the special-law list, cleaned, in the order of `pos`; pages: (pos, title, pre)."""
    rows = in_file_order(cases.special_law_list(pages, keys=(pos,)), pos)
    write_csv(rows.select(*C.SPECIAL_LAW_COLUMNS), f"{folder}/special_laws_{run_id}")


def financial_cases(list_pages: DataFrame, pages: DataFrame, max_pages: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw, clean, rejects) of list pages (page_no, html) and detail pages (url, html).

    A link without a page gives no row; it goes to the rejects.
    """
    bounded = list_pages.where(F.col("page_no") <= max_pages) if max_pages else list_pages
    links = bounded.select("page_no", F.posexplode_outer(tables.page_links(tables.prepare(F.col("html")))).alias("pos", "url"))
    joined = lookup.with_detail_page(links.where(F.col("url").isNotNull()), pages, url="url")
    found = tables.with_financial_fields(joined.where(F.col("html").isNotNull())).select("page_no", "pos", *C.FIN_FIELDS)
    failed = manifest.outcomes(joined.where(F.col("html").isNull()), F.col("url"), F.lit("no detail page"))
    return found, tables.clean_frame(found), failed


def zone_cases(blocks: DataFrame, drop_repeats: bool = True) -> DataFrame:
    """Free-zone case rows, the first of equal rows kept. `page_id` and `pos` are whole numbers."""
    rows = cases.case_rows(blocks).withColumn("ord", F.struct("page_id", "pos")).select(*C.ZONE_COLUMNS, "ord")
    return dedup.keep_first(rows, C.ZONE_COLUMNS, "ord") if drop_repeats else rows


def collection_state(names: DataFrame, files: DataFrame, file_format: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(missing names, counts) of law names (law_name, pos) against a file listing."""
    wanted = first_rows(names, limit, "pos")
    kept = manifest.finished(files)
    return manifest.missing_names(wanted, kept, file_format), manifest.have_missing_counts(wanted, kept, file_format)


def index_table(pages: DataFrame, **filters) -> DataFrame:
    return normalize.project_if_complete(listing.index_rows(pages, **filters), C.INDEX_COLUMNS + ["page_no", "pos"])


def reclean(spark: SparkSession, path: str, out: str) -> None:
    """Cleans the cells of an existing table and writes it quoted."""
    write_quoted_csv(tables.clean_frame(read_case_table(spark, path)), out)
