"""One query per operator over its whole table, with production parameters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm import chat, decontaminate, exact_dedup, jaccard_join, language, lm_score, main_text, mixing, pii, prefix_trie, resample, secret_scan, url_filter
from lawloom.llm.url_filter import Globs, Rule


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Sources are numbered; each five of them make a domain. A declared mapping, with a domain for all others.
DOMAINS = {"web": range(0, 5), "books": range(5, 10), "code": range(10, 15)}
OTHER_DOMAIN = "forum"
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2, "forum": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.625, 2, 17


def domain_of(source="source"):
    number = F.try_to_number(F.regexp_extract(F.col(source), r"^src([0-9]{1,9})$", 1), F.lit("999999999"))
    out = F.lit(OTHER_DOMAIN)
    for name, numbers in DOMAINS.items():
        out = F.when(number.isin(list(numbers)), name).otherwise(out)
    return out


def mix_options() -> dict:
    return {"domain": domain_of(), "total": MIX_SHARE, "weights": MIX_WEIGHTS, "default_weight": 1, "max_epochs": MIX_EPOCHS, "seed": MIX_SEED}


def op1_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"), **mix_options()).drop("text_key", "copies")


def op2_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    scores = lm_score.score_texts(table(spark, sf, "documents"), held_out)
    return scores.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})  # sums of doubles, in no fixed order


def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.near_copies(table(spark, sf, "documents")).drop("text_key")


def op4_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.scan_pii(table(spark, sf, "documents"))


URL_RULES = [
    Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"),
]
URL_GLOBS = Globs(block=("*casino*", "*free-bets*", "*cheap-pills*", "*.ads-*", "*/ads/*", "*?popup=*"))


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf, "pages"), URL_RULES, URL_GLOBS)


def chat_records(turns: DataFrame) -> DataFrame:
    """(conv_id, record): the conversations as records of four layouts, by the roles that speak in them.

    Rows go by turn, a NULL turn before all others; rows of one turn by role, then text, and repeated rows stay. Rows without a conv_id
    are one conversation of their own. NULL roles and texts are empty; an empty table gives no records; other columns are not read.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    is_prompt = roles == F.array(F.lit("user"), F.lit("assistant"))
    is_instruction = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    renamed = (F.get(roles, 0) == "system") & ~F.arrays_overlap(roles, F.array(F.lit("human"), F.lit("gpt")))
    text = lambda i: F.get(F.col("t"), i)["text"]
    other_name = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    rest = ~is_prompt & ~is_instruction
    return whole.select("conv_id", F.struct(
        F.when(rest & ~renamed, F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))).alias("messages"),
        F.when(rest & renamed, F.transform("t", lambda t: F.struct(other_name(t["role"]).alias("from"), t["text"].alias("value")))).alias("conversations"),
        F.when(is_prompt, text(0)).alias("prompt"), F.when(is_prompt, text(1)).alias("completion"),
        F.when(is_instruction, text(0)).alias("system"), F.when(is_instruction, text(1)).alias("instruction"),
        F.when(is_instruction, text(2)).alias("output"),
    ).alias("record"))


def op6_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    formatted = chat.format_chats(chat_records(turns.unionByName(probe)), "conv_id", "record")
    back = formatted.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout",
    )


LANGUAGES = ["en", "de", "fr", "es"]


def language_options() -> dict:
    """Documents name their language and their source, which stands for the host; the texts to learn from are labelled by the former."""
    return {"languages": LANGUAGES, "declared": F.col("lang"), "host": F.col("source"), "per_language": 1000, "min_posterior": 0.5}


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"), **language_options()).drop("text_key", "declared", "host")


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf, "documents")).drop("text_key")


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf, "documents"))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    sample = resample.importance_sample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return sample.select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf, "conversations")).drop("name", "parent")


def op13_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_lm_score, op3_jaccard_join, op4_pii, op5_url_filter, op6_chat_format, op7_language_id, op8_exact_dedup, op9_secret_scan,
    op10_decontamination, op11_importance_resampling, op12_prefix_trie, op13_html_extraction,
)}
