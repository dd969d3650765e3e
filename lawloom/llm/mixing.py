"""Mixing sources to target weights: budgets down a tree of domains, languages and sources, then token prefixes of seeded epochs."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import stored, text_of, word_count

LEVELS = ["domain", "lang", "source"]
#: Bits of a document's place in an epoch, and of each of the two histograms over them.
_PLACE_BITS, _CELL_BITS = 60, 10


def _weight(weights: dict[str, int], default: int, node: Column) -> Column:
    out = F.lit(default)
    for name, value in weights.items():
        out = F.when(node == name, value).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parents: list[str], node: str) -> DataFrame:
    """Adds `budget`: each parent's `parent_budget` over its children, by weight, but no child above its capacity.

    What a full child leaves goes to its siblings by weight. Children are ordered by capacity per weight; those that
    fill up form a beginning of that order. All in whole tokens; shares are rounded down, so a parent may lose less than a
    token per child. A parent's budget never exceeds its children's capacity, so a shortage leaves a family only when
    all of it is full, and is then shared among the parent's siblings.
    """
    family = Window.partitionBy(*parents)
    order = family.orderBy((F.col("capacity") / F.col("weight")).asc(), F.col(node).asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("_filled", F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("_open", F.sum("weight").over(after))
    full = F.col("_filled") * F.col("weight") + F.col("capacity") * F.col("_open") <= F.col("parent_budget") * F.col("weight")
    nodes = nodes.withColumn("_full", full)
    taken = F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(family), F.lit(0))
    rest = F.coalesce(F.sum(F.when(~F.col("_full"), F.col("weight"))).over(family), F.lit(1))
    nodes = nodes.withColumn("_taken", taken).withColumn("_rest", rest)
    share = F.expr("((parent_budget - _taken) * weight) div _rest")
    return nodes.withColumn("budget", F.when(F.col("_full"), F.col("capacity")).otherwise(share)).drop("_filled", "_open", "_full", "_taken", "_rest")


def leaf_budgets(leaves: DataFrame, total: int | float, weights: dict[str, dict[str, int]], default_weight: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens): one row per leaf.

    total: tokens, or with a float the share of all tokens. weights: level -> node -> whole number; nodes not named get
    default_weight, a weight of 0 leaves a node out. A leaf can give its tokens max_epochs times.
    """
    for level in LEVELS:
        leaves = leaves.withColumn(f"{level}_weight", _weight(weights.get(level, {}), default_weight, F.col(level)))
    open_ = " and ".join(f"{level}_weight > 0" for level in LEVELS)
    leaves = leaves.withColumn("capacity", F.when(F.expr(open_), F.col("tokens") * max_epochs).otherwise(0))
    wanted = F.sum("tokens").over(Window.partitionBy()) * F.lit(total) if isinstance(total, float) else F.lit(total)
    leaves = leaves.withColumn("total", F.least(F.floor(wanted), F.sum("capacity").over(Window.partitionBy())).cast("long"))
    budget = None
    for depth, level in enumerate(LEVELS, 1):
        names = LEVELS[:depth]
        family = leaves.where("capacity > 0").groupBy(*names).agg(
            F.sum("capacity").alias("capacity"), F.first(f"{level}_weight").alias("weight"), F.first("total").alias("total")
        )
        if budget is None:
            family = family.withColumn("parent_budget", F.col("total"))
        else:
            family = family.join(budget.withColumnRenamed("budget", "parent_budget"), names[:-1])
        budget = share_out(family, names[:-1], level).select(*names, "budget")
    return leaves.select(*LEVELS, "tokens").join(budget, LEVELS, "left").withColumn("budget", F.coalesce("budget", F.lit(0)).cast("long"))


def _cut(rows: DataFrame, keys: list[str], cell: str, budget: str) -> DataFrame:
    """(keys, cut_cell, left): the cell of each group in which the running token sum reaches the budget, and what is left there."""
    cells = rows.groupBy(*keys, budget, cell).agg(F.sum("n_tokens").alias("held"))
    before = F.sum("held").over(Window.partitionBy(*keys).orderBy(cell)) - F.col("held")
    cells = cells.withColumn("before", before).where((F.col("before") < F.col(budget)) & (F.col("before") + F.col("held") >= F.col(budget)))
    return cells.select(*keys, F.col(cell).alias("cut_cell"), (F.col(budget) - F.col("before")).alias("left"))


def mix(
    docs: DataFrame, domain: Column, total: int | float, weights: dict[str, dict[str, int]], default_weight: int = 1,
    max_epochs: int = 2, seed: int = 1, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """(doc_id, epoch, domain, lang, source, n_tokens, take_tokens, leaf_budget, text_key, copies): the documents to read, once for each epoch.

    Tokens are words between blanks. Each leaf reads its documents in a seeded order, a new one for each epoch, up to its
    budget; of the last document only the first take_tokens tokens count, so each leaf gives exactly its budget.
    Documents without tokens (NULL or empty texts) are never read; NULL domains, languages and sources are nodes named by the
    empty string; rows equal in all that is read are one document, with their number in `copies`; an empty table gives no rows; other columns are not read.

    The order is the place of md5(seed:epoch:doc_id) in 60 bits. Where a leaf's last epoch ends is found with two
    histograms of fixed size over the upper bits, so only the documents of one cell in 2^20 of a leaf meet in a window.
    """
    rows = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(LEVELS, (domain, F.col(lang_column), F.col(source_column)))),
            word_count(text_of(text_column)).alias("n_tokens"), F.xxhash64(text_of(text_column)).alias("text_key"),
        ).where("n_tokens > 0").groupBy("doc_id", *LEVELS, "n_tokens", "text_key").agg(F.count(F.lit(1)).alias("copies")),
        "counted",
    )
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = stored(leaf_budgets(leaves, total, weights, default_weight, max_epochs), "budgets")
    given = budgets.withColumn("whole_epochs", F.expr("budget div tokens")).withColumn("partial", F.expr("budget % tokens"))
    given = given.select(*LEVELS, "whole_epochs", "partial", F.col("budget").alias("leaf_budget")).where("leaf_budget > 0")
    rows = rows.join(given, LEVELS)
    whole = rows.where("whole_epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole_epochs") - 1)))
    whole = whole.withColumn("take_tokens", F.col("n_tokens"))
    name = F.concat_ws(":", F.lit(str(seed)), F.col("whole_epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    part = rows.where("partial > 0").withColumn("place", F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long"))
    part = part.withColumn("coarse", F.shiftright("place", _PLACE_BITS - _CELL_BITS))
    part = part.withColumn("fine", F.shiftright("place", _PLACE_BITS - 2 * _CELL_BITS))
    coarse = _cut(part, LEVELS, "coarse", "partial").withColumnsRenamed({"cut_cell": "coarse_cut", "left": "coarse_left"})
    part = part.join(coarse, LEVELS).where("coarse <= coarse_cut")
    fine = _cut(part.where("coarse = coarse_cut"), LEVELS, "fine", "coarse_left").withColumnsRenamed({"cut_cell": "fine_cut", "left": "fine_left"})
    part = part.join(fine, LEVELS).where("fine <= fine_cut")
    order = Window.partitionBy(*LEVELS).orderBy("place", "doc_id", "text_key")
    edge = part.where("fine = fine_cut").withColumn("_before", F.sum("n_tokens").over(order) - F.col("n_tokens"))
    edge = edge.where("_before < fine_left").withColumn("take_tokens", F.least(F.col("n_tokens"), F.col("fine_left") - F.col("_before")))
    inner = part.where("fine < fine_cut").withColumn("take_tokens", F.col("n_tokens"))
    columns = ["doc_id", "epoch", *LEVELS, "n_tokens", "take_tokens", "leaf_budget", "text_key", "copies"]
    out = whole.select(*columns)
    for more in (inner, edge):
        out = out.unionByName(more.withColumn("epoch", F.col("whole_epochs")).select(*columns))
    return out


def mixed_documents(docs: DataFrame, domain: Column, total: int | float, weights: dict[str, dict[str, int]], **options) -> DataFrame:
    """The documents that the mix reads, once for each epoch: docs' columns and then `epoch` and `take_tokens`.

    Where docs has columns of these names already, the new ones get a trailing underscore. Rows equal in id, text, language
    and source are one document.
    """
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    picks = stored(mix(docs, domain, total, weights, **options), "picks")
    taken = {c.lower() for c in docs.columns}
    names = {c: next(c + "_" * i for i in range(len(taken) + 1) if (c + "_" * i) not in taken) for c in ("epoch", "take_tokens")}
    chosen = picks.select(
        F.col("doc_id").alias("__pick_id"), F.col("text_key").alias("__pick_key"),
        *(F.col(n).alias(f"__pick_{n}") for n in LEVELS), *(F.col(c).alias(names[c]) for c in names),
    )
    labels = [F.coalesce(c.cast("string"), F.lit("")) for c in (
        domain, docs[options.get("lang_column", "lang")], docs[options.get("source_column", "source")],
    )]
    if not picks.where("copies > 1").isEmpty():
        keys = {f"__same{i}": c for i, c in enumerate([docs[id_column], F.xxhash64(text_of(text_column)), *labels])}
        docs = docs.withColumns(keys).dropDuplicates(list(keys)).drop(*keys)
        labels = [F.coalesce(c.cast("string"), F.lit("")) for c in (
            domain, F.col(options.get("lang_column", "lang")), F.col(options.get("source_column", "source")),
        )]
    same = F.col(id_column).eqNullSafe(F.col("__pick_id")) & (F.xxhash64(text_of(text_column)) == F.col("__pick_key"))
    for n, label in zip(LEVELS, labels):
        same = same & (label == F.col(f"__pick_{n}"))
    return docs.join(chosen, same).select(*docs.columns, *names.values())
