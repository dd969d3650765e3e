"""One query per operator family, over whole given tables or texts derived from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from lawloom import constants as C
from lawloom.functions.arrays import bind, exploded
from lawloom.functions import clauses, markup, text as X
from lawloom.sources import readers, writers
from lawloom.operators import cases, dedup, fields, lawhtml, listing, lookup, manifest, normalize, order, paged, segment, tables


def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    return I.decorated(spark, sf).select("doc_id", X.collapse(F.col("text")).alias("text"))


def text_strip_special(spark, sf):
    return I.decorated(spark, sf).select("doc_id", X.letters_spaced(F.col("text")).alias("text"))


def text_strip_delete(spark, sf):
    return I.decorated(spark, sf).select("doc_id", X.letters_only(F.col("text")).alias("text"))


def text_sanitize(spark, sf):
    return tables.clean_frame(I.decorated(spark, sf))


def text_normkey(spark, sf):
    return I.decorated(spark, sf).select("doc_id", X.compare_key(F.col("text")).alias("text"))


def text_law_tags(spark, sf):
    return I.decorated(spark, sf).select("doc_id", X.drop_law_tags(F.col("text")).alias("text"))


def text_keep_law(spark, sf):
    return I.bulleted_law_texts(spark, sf).select("doc_id", X.keep_law_lines(F.col("text")).alias("text"))


def _by_row(spark, sf, variants, function):
    """Sentence rows in several written forms, and what the function makes of them."""
    l, i = F.col("l"), F.col("i")
    value = F.lit(variants[-1])
    for k, v in reversed(list(enumerate(variants[:-1]))):
        value = F.when(i % len(variants) == k, F.lit(v)).otherwise(value)
    return I.sentence_rows(spark, sf).select("doc_id", "i", function(F.replace(value, F.lit("@"), l)).alias("value"))


NULL_FORMS = ["", " - ", "없음", "해당없음. .", "해당 없음", "미해당", "없음 @", "@"]
INDEX_FORMS = ["1 @", "09. @", "100) @", "194~195. @", "12-13 @", "제135조 @", "@"]
ROUND_FORMS = ["10차 - @", "10차@", "①차 - @", " 3 차) @", "차 @", "@"]
TRIAL_FORMS = ["실증특례 @", "(실증 특례) - @", "① [실증특례] @", "실증특례", "@ 실증특례", "@"]


def null_tokens(spark, sf):
    return _by_row(spark, sf, NULL_FORMS, X.null_word_to_blank)


def leading_index(spark, sf):
    return _by_row(spark, sf, INDEX_FORMS, X.drop_leading_index)


def major_title(spark, sf):
    return _by_row(spark, sf, ROUND_FORMS, X.round_title)


def mid_title(spark, sf):
    return _by_row(spark, sf, TRIAL_FORMS, X.trial_title)


def first_sentence(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", X.first_sentence(F.col("text")).alias("sentence"))


def filename_clean(spark, sf):
    raw = F.concat(F.lit(" <"), F.col("text"), F.lit('>:"/\\|?* '))
    return I.table(spark, sf, "documents").select("doc_id", X.file_name(raw).alias("file_name"))


def docname_short(spark, sf):
    raw = F.concat(F.lit("법 (가) 나("), F.col("text"), F.lit(")"))
    return I.table(spark, sf, "documents").select("doc_id", X.short_document_name(raw).alias("name"))


def url_build(spark, sf):
    return I.table(spark, sf, "documents").select(
        "doc_id",
        X.search_url("https://x.example/?q=", F.col("text")).alias("search_url"),
        X.law_detail_url(F.col("text")).alias("detail_url"),
    )


def url_join(spark, sf):
    item = F.when(F.col("p_size") % 5 != 0, F.col("p_partkey").cast("string"))
    return I.table(spark, sf, "part").select("p_partkey", X.list_detail_url(item).alias("url"))


def date_norm(spark, sf):
    date = F.col("o_orderdate")
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format(date, "yyyyMMdd")).otherwise(F.date_format(date, " yyyy.MM "))
    return I.table(spark, sf, "orders").select("o_orderkey", X.iso_date(raw).alias("date"))


def separators(spark, sf):
    l = F.concat(F.lit(" :- 기대 효과 · "), F.col("l"), F.lit(" —: 기대 효과 •"))
    return I.sentence_rows(spark, sf).select(
        "doc_id", "i", X.strip_separators(X.remove_once(l, F.lit("기대 효과"))).alias("value")
    )


def noise_lines(spark, sf):
    return _by_row(spark, sf, ["조회수 @", " ", "@"], lambda c: F.when(X.is_noise(c), "noise").otherwise("text"))


def law_lines(spark, sf):
    kept = segment.law_lines(F.col("text"), F.col("law_name"))
    return exploded(I.law_texts(spark, sf), ["doc_id"], kept, "line_no", "line")


def law_segment(spark, sf):
    return segment.segment(I.law_texts(spark, sf), keys=("doc_id",))


def law_segment_loose(spark, sf):
    return segment.segment(I.law_texts(spark, sf), rules=segment.PARAGRAPH_RULES, keys=("doc_id",))


def law_segment_pages(spark, sf):
    return paged.segment_pages(I.law_pages(spark, sf), pages_per_block=8).select(*C.LAW_ROW_COLUMNS)


def law_segment_paragraphs(spark, sf):
    lines = exploded(I.law_texts(spark, sf), ["law_name"], F.split("text", "\n"), "page_no", "text")
    return paged.segment_pages(lines, rules=segment.PARAGRAPH_RULES, pages_per_block=64, whole_rows=True).select(*C.LAW_ROW_COLUMNS)


def article_title(spark, sf):
    number, title, body = segment.heading_parts(F.col("line"))
    return law_lines(spark, sf).select(
        "doc_id", "line_no", number.alias("article_number"), title.alias("article_title"), body.alias("body")
    )


def law_outcomes(spark, sf):
    docs = I.table(spark, sf, "documents").join(I.table(spark, sf, "labels"), "doc_id", "left")
    text = F.when(F.col("quality") == 0, F.lit("  ")).when(F.col("quality").isNull(), F.lit(None)).otherwise(F.col("text"))
    return segment.rejects(docs.select(F.col("doc_id").cast("string").alias("law_name"), text.alias("text")))


def clause_split(spark, sf):
    return (
        exploded(I.clause_texts(spark, sf), ["doc_id"], clauses.clause_array(F.col("text")), "pos", "c")
        .select("doc_id", "pos", F.col("c.mark").alias("mark"), F.col("c.text").alias("text"))
    )


def clause_marks(spark, sf):
    rows = clause_split(spark, sf).select("doc_id", "pos", clauses.clause_label(F.col("mark")).alias("label"))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def article_fulltext(spark, sf):
    return I.clause_texts(spark, sf).select("doc_id", clauses.full_text(clauses.clause_array(F.col("text"))).alias("text"))


def law_html_rows(spark, sf):
    rows = lawhtml.law_html_rows(I.law_pages_html(spark, sf), keys=("doc_id",))
    return rows.where(F.col("section") == C.MAIN_SECTION)


def law_supplement_rows(spark, sf):
    rows = lawhtml.law_html_rows(I.law_pages_html(spark, sf), keys=("doc_id",))
    return rows.where(F.col("section") == C.SUPPLEMENT_SECTION)


def html_blocks(spark, sf):
    tokens = exploded(I.table(spark, sf, "pages"), ["page_id"], markup.tag_tokens(F.col("html")), "pos", "t")
    return tokens.select("page_id", "pos", "t.*")


def html_text(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", markup.flow_text(markup.prepare(F.col("html"))).alias("text"))


def html_links(spark, sf):
    links = F.transform(markup.pieces(F.col("html"), "li"), lambda li: tables.row_link(li, token="/"))
    return exploded(I.table(spark, sf, "pages"), ["page_id"], F.array_distinct(links), "pos", "url")


def detail_links(spark, sf):
    return exploded(I.financial_list_pages(spark, sf), ["doc_id"], tables.page_links(markup.prepare(F.col("html"))), "pos", "url")


def html_list_rows(spark, sf):
    return listing.index_rows(I.list_pages(spark, sf))


def list_signature(spark, sf):
    texts = F.transform(markup.pieces(F.col("html"), "li"), lambda li: markup.plain_text(markup.inside(li, "li")))
    return I.table(spark, sf, "pages").select("page_id", X.signature(texts).alias("signature"))


def kv_last_wins(spark, sf):
    return lookup.last_per_key(I.table(spark, sf, "events"), ["user_id", "event_type"], "event_id", ["props"])


def kv_table(spark, sf):
    table = tables.section_table(markup.prepare(F.col("html")))
    return (
        exploded(I.financial_pages(spark, sf), ["doc_id"], tables.label_rows(table), "pos", "p")
        .select("doc_id", "pos", "p.*")
    )


def _root():
    return bind(markup.prepare(F.col("html")), lambda page: F.coalesce(fields.content_cell(page), page))


def kv_pairs(spark, sf):
    return (
        exploded(I.detail_pages(spark, sf), ["doc_id"], fields.label_pairs(_root()), "pos", "p")
        .select("doc_id", "pos", "p.*")
    )


def strong_sections(spark, sf):
    return (
        exploded(I.detail_pages(spark, sf), ["doc_id"], fields.strong_sections(_root(), F.col("서비스명")), "pos", "s")
        .select("doc_id", "pos", "s.*")
    )


def header_map(spark, sf):
    return strong_sections(spark, sf).select("doc_id", "pos", fields.header_field(F.col("header")).alias("field"))


def best_container(spark, sf):
    return I.detail_pages(spark, sf).select("doc_id", markup.flow_text(_root()).alias("text"))


def best_container_loose(spark, sf):
    return I.loose_detail_pages(spark, sf).select("doc_id", markup.flow_text(_root()).alias("text"))


def best_table(spark, sf):
    pages = I.financial_pages(spark, sf).select("doc_id", markup.prepare(F.col("html")).alias("page"))
    by_score, by_header = tables.section_table(F.col("page"), anchor=None), tables.list_table(F.col("page"))
    best = pages.select("doc_id", by_score.alias("by_score"), by_header.alias("by_header"))
    section_text, list_text = (markup.flow_text(markup.inside(F.col(c), "table")) for c in ("by_score", "by_header"))
    texts = best.withColumn("section_text", section_text)
    same = F.col("by_header").eqNullSafe(F.col("by_score"))
    return texts.select("doc_id", "section_text", F.when(same, F.col("section_text")).otherwise(list_text).alias("list_text"))


def financial_fields(spark, sf):
    return tables.with_financial_fields(I.financial_pages(spark, sf)).select("doc_id", *C.FIN_FIELDS)


def field_fallback(spark, sf):
    found = fields.with_fields(I.detail_pages(spark, sf))
    return found.select("doc_id", *C.FIELDS, *["src_" + f for f in C.FIELDS])


def provenance_cols(spark, sf):
    found = fields.with_filled_list(fields.with_fields(I.detail_pages(spark, sf)))
    return found.select("doc_id", "extracted_columns", *[X.letters_spaced(F.col(f)).alias(f) for f in C.FIELDS])


def subtitle(spark, sf):
    return I.case_blocks(spark, sf).where(F.col("tag") == "div").select(
        "page_id", "pos", cases.subtitle(F.col("html")).alias("subtitle")
    )


def stat_allow(spark, sf):
    blocks = I.case_blocks(spark, sf).where(F.col("tag") == "div")
    return cases.with_status_and_allowance(blocks).select("page_id", "pos", "현황", "허용")


def stat_allow_flat(spark, sf):
    return cases.with_status_and_allowance(I.flat_cases(spark, sf)).select("doc_id", "현황", "허용")


def case_rows(spark, sf):
    return cases.case_rows(I.case_blocks(spark, sf))


def two_headings(spark, sf):
    return cases.with_two_sections(I.preformatted(spark, sf)).select("doc_id", "관계법령_raw", "규제특례사항_raw")


def special_law(spark, sf):
    return cases.special_law_list(I.preformatted(spark, sf), keys=("doc_id",))


def _sources(spark, sf):
    customer, supplier, part, nation, docs = (I.table(spark, sf, t) for t in ["customer", "supplier", "part", "nation", "documents"])
    return {
        "ICT": customer.select(
            F.col("c_custkey").alias("번호"), F.col("c_mktsegment").alias("구분"), F.col("c_name").alias("서비스명"),
            F.lit("내용").alias("서비스 내용"), F.lit(None).cast("string").alias("규제"), F.col("c_mktsegment").alias("특례 내용"),
            F.lit("").alias("부가조건"), F.lit("효과").alias("기대효과"), F.col("c_name").alias("개선결과"),
            F.col("c_custkey").alias("pos"),
        ),
        "REG_ZONE": supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("n_name").alias("대제목"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("중제목"),
            F.col("s_name").alias("소제목"), F.col("n_name").alias("현황"), F.lit("허용").alias("허용"), F.col("s_suppkey").alias("pos"),
        ),
        "FIN": part.select(
            F.col("p_brand").alias("지정 제도"), F.col("p_name").alias("서비스명"), F.col("p_type").alias("본문 일부"),
            F.col("p_type").alias("규제 특례 내용"), F.col("p_partkey").alias("pos"),
        ),
        "IND_LAW": nation.select(
            F.col("n_nationkey").alias("순번"), F.col("n_name").alias("사업명"), F.concat(F.lit("규제 "), "n_name").alias("규제내용"),
            F.col("n_nationkey").alias("pos"),
        ),
        "IND_CASE": docs.select(
            F.col("lang").alias("구분"), F.col("source").alias("제목"), F.col("text").alias("주요내용"), F.col("doc_id").alias("pos"),
        ),
    }


def master_union(spark, sf):
    return normalize.master_union(_sources(spark, sf))


def row_index(spark, sf):
    return order.row_index(I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "index")


def row_index_per_key(spark, sf):
    lines = I.table(spark, sf, "events").select("event_type", "event_id")
    return order.row_index(lines, "event_id", "n", keys=("event_type",))


def composite_category(spark, sf):
    src = _sources(spark, sf)["REG_ZONE"]
    return src.select(
        "pos",
        normalize.composite(src, "대제목", "중제목").alias("category"),
        normalize.composite(src, "대제목", "중제목", compat=True).alias("compat_category"),
        normalize.composite(src, "대제목", "없는 열").alias("first_only"),
        normalize.composite(src, "없는 열", "중제목").alias("neither"),
    )


def first_present(spark, sf):
    src = _sources(spark, sf)["FIN"]
    return src.select(
        "pos",
        normalize.first_present(src, ["규제내용", "본문 일부"]).alias("issue"),
        normalize.first_present(src, ["없는 열"]).alias("none"),
        normalize.optional(src, "서비스명").alias("title"),
    )


def strict_rename(spark, sf):
    return normalize.normalize_ict(_sources(spark, sf)["ICT"])


def index_filter(spark, sf):
    date = F.when(F.col("o_orderstatus") == "P", "미정").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = I.table(spark, sf, "orders").join(I.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select("o_orderkey", "c_name", "c_mktsegment", date.alias("date"))
    return rows.where(listing.matches_keyword(F.col("c_name"), F.col("c_mktsegment"), "Auto")).where(
        listing.in_date_range(F.col("date"), "1996-03-01", "1998-08-15")
    )


def index_counts(spark, sf):
    item = F.when(F.col("value") > 5, F.col("user_id").cast("string"))
    return listing.ids_per_form(I.table(spark, sf, "events").select(F.col("event_type").alias("form_code"), item.alias("bdSeq")))


def _index(spark, sf):
    return I.table(spark, sf, "events").select(F.col("user_id").alias("bdSeq"), "event_id", "event_type", "props")


def select_lookup(spark, sf):
    index = _index(spark, sf)
    ids = lookup.selected_ids(index, I.table(spark, sf, "supplier").select("s_suppkey"))
    return lookup.lookup(index, ids, ["event_id"])


def unmatched_ids(spark, sf):
    """Some ids are moved out of the index, so that there are unmatched ones."""
    index, key = _index(spark, sf), F.col("s_suppkey")
    ids = I.table(spark, sf, "supplier").select(F.when(key % 7 == 0, key + 10**9).otherwise(key).alias("s_suppkey"))
    return lookup.unmatched(index, lookup.selected_ids(index, ids))


def selected_in_order(spark, sf):
    index = _index(spark, sf)
    ids = I.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("bdSeq"), (-F.col("s_suppkey")).alias("pos"))
    return lookup.in_order(lookup.lookup(index, ids, ["event_id"]), ids)


def distinct_ids(spark, sf):
    return lookup.selected_ids(I.table(spark, sf, "lineitem"), None, "l_suppkey")


def detail_join(spark, sf):
    pages = I.table(spark, sf, "pages")
    urls = pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("detail_url"))
    rows = I.table(spark, sf, "documents").select("doc_id").join(urls, "doc_id", "left")
    joined = lookup.with_detail_page(rows, pages, page_order=("page_id",))
    return joined.select("doc_id", "detail_url", F.length("html").alias("n_html"), F.when(F.col("html").isNull(), "empty").otherwise("page").alias("src"))


def _names_and_files(spark, sf):
    names = I.table(spark, sf, "documents").select("doc_id", F.concat(F.lit(" 법:령"), F.col("doc_id").cast("string"), F.lit("?")).alias("law_name"))
    ext = F.when(F.col("toxic") == 1, ".crdownload").when(F.col("quality") == 1, ".pdf").otherwise(".docx")
    stem = F.concat(F.lit("/d/법령"), F.col("doc_id").cast("string"), ext)
    return names, I.table(spark, sf, "labels").select(stem.alias("path"))


def missing_files(spark, sf):
    names, files = _names_and_files(spark, sf)
    return manifest.missing_names(names, manifest.finished(files))


def have_missing(spark, sf):
    names, files = _names_and_files(spark, sf)
    return manifest.have_missing_counts(names, files, "docx")


def new_files(spark, sf):
    names, files = _names_and_files(spark, sf)
    after = names.select(F.concat(F.lit("/d/"), X.file_name(F.col("law_name")), F.lit(".pdf")).alias("path"))
    return manifest.new_files(after, files)


def latest_file(spark, sf):
    events = I.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("path"), F.col("ts").alias("modificationTime"))
    return manifest.newest_file(events)


def retry_outcomes(spark, sf):
    names, files = _names_and_files(spark, sf)
    later = files.select(F.replace("path", F.lit(".crdownload"), F.lit(".pdf")).alias("path"))
    return manifest.retry_plan(names, files, later)


def ingest_summary(spark, sf):
    return manifest.outcome_counts(retry_outcomes(spark, sf))


def page_stop(spark, sf):
    turns = I.table(spark, sf, "conversations")
    items = F.when(F.length("text") % 5 == 0, 0).otherwise(F.length("text"))
    return listing.pages_before_stop(turns.select("conv_id", "turn", items.alias("n_items")), "conv_id", "turn", "n_items", max_pages=6)


def dedup_keep_first(spark, sf):
    rows = I.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return dedup.keep_first(rows, ["text", "lang", "n_chars"], "doc_id")


def distinct_in_order(spark, sf):
    return dedup.distinct_in_order(I.table(spark, sf, "documents").select("doc_id", "text"), "text", "doc_id")


def csv_roundtrip(spark, sf):
    """Whole texts, line breaks and quotes included, through CSV files and back."""
    path = I.scratch(spark, "csv")
    rows = I.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    writers.write_csv(rows, path, bom=False)
    return readers.read_case_table(spark, f"{path}/*.csv", ["doc_id", "text", "lang", "source"])


def jsonl_roundtrip(spark, sf):
    path = I.scratch(spark, "jsonl")
    rows = I.table(spark, sf, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    writers.write_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


def master_written_in_order(spark, sf):
    """The master table through CSV files and back; pos is a row's place in the files."""
    path = I.scratch(spark, "master")
    master = writers.in_file_order(normalize.master_union(_sources(spark, sf)), "src_no", "ord").select(*C.COMMON_COLUMNS)
    writers.write_csv(master, path)
    return order.file_row_index(readers.read_case_table(spark, f"{path}/*.csv", C.COMMON_COLUMNS), "pos")


def law_files_roundtrip(spark, sf):
    """One text file per law, named by the law, and back."""
    return readers.read_law_texts(spark, I.law_folder(spark, sf))


def csv_rejects(spark, sf):
    """Lines of too few and too many cells are set aside as they stand."""
    path = I.scratch(spark, "lines")
    I.uneven_lines(spark, sf).write.text(path)
    rows, rejects = readers.read_with_rejects(spark, path, ["doc_id", "lang", "source"], header=False, multi_line=False)
    return rows.unionByName(rejects.select("line", "reason"), allowMissingColumns=True)


def page_stop_repeated(spark, sf):
    turns = I.table(spark, sf, "conversations")
    items = F.when(F.length("text") % 17 == 0, 0).otherwise(F.length("text"))
    shown = turns.select("conv_id", "turn", items.alias("n_items"), F.substring("text", 1, 1).alias("shown"))
    return listing.pages_before_stop(shown, "conv_id", "turn", "n_items", max_pages=6, signature="shown")


def law_unnumbered_pages(spark, sf):
    """law_segment_pages with the last page of each law left without its number."""
    pages = I.law_pages(spark, sf)
    last = pages.groupBy("law_name").agg(F.max("page_no").alias("last"))
    number = F.when(F.col("page_no") < F.col("last"), F.col("page_no"))
    return paged.segment_pages(pages.join(last, "law_name").withColumn("page_no", number), pages_per_block=8).select(*C.LAW_ROW_COLUMNS)


def first_n(spark, sf):
    return order.first_rows(I.table(spark, sf, "customer").select("c_custkey", "c_name"), 25, "c_custkey")


QUERIES = {
    name: value
    for name, value in list(globals().items())
    if callable(value) and getattr(value, "__module__", "") == __name__ and not name.startswith("_")
}
