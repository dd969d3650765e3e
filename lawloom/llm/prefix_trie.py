"""Prefix trie of conversations, by the Van Emde Boas recursion: cut at half depth, name the cut prefixes, recurse into both halves, graft.

Cutting every sequence at half of the depth gives one upper trie and, under each cut prefix, a lower forest. A cut prefix is named by a
hash of its own root's name and its turns, so equal prefixes have equal names wherever they are, and both halves of all tries
are cut again at the same time. After log2(depth) cuts each piece is one turn: a node. Totals go the other way round: blocks of 1, 2, 4,
... levels are joined in pairs, where each cut node hands its lower forest's totals to its ancestors in the upper trie.
"""

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions.arrays import bind
from lawloom.llm.common import stored

ROOT = hashlib.sha256(b"root").digest()
_CHUNK = 8192  # ids that travel as one row


def _name(forest: Column, turns: Column) -> Column:
    """256-bit name of the prefix that goes on from a named prefix with some turns; turns have names of one length."""
    return F.unhex(F.sha2(F.aggregate(turns, forest, lambda a, t: F.concat(a, t["name"])), 256))


def sequences(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as names and code points; texts stay where they are."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    name = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    rows = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), name.alias("name"), F.length(said).cast("long").alias("n_chars")).alias("t")
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["n_chars"].alias("n_chars"))).alias("turns"))


def rebuilt(whole: DataFrame, group: int, heads: int) -> DataFrame:
    """(conv_id, turns): the first h turns of the conversation that leads the group of c, then c's own turns after its first h."""
    c = F.col("conv_id")
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(heads)).cast("int")
    leads = whole.where(c % group == 0).select(c.alias("lead"), F.slice("turns", 1, heads).alias("head"))
    own = whole.withColumn("lead_of", c - c % group)
    joined = own.join(leads, F.col("lead_of") == F.col("lead"), "left")
    head = F.coalesce("head", F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(F.slice(head, F.lit(1), h), F.slice("turns", h + 1, F.size("turns") + 1)).alias("turns"))


def _cut_at(half: int):
    """The upper and the lower piece of a piece; the lower one may have no turns."""

    def cut(p):
        upper = F.slice(p["turns"], 1, half)
        both = lambda c: F.array(
            F.struct(p["forest"].alias("forest"), c.alias("end"), upper.alias("turns")),
            F.struct(c.alias("forest"), p["end"].alias("end"), F.slice(p["turns"], F.lit(half + 1), F.size(p["turns"])).alias("turns")),
        )
        return bind(F.when(F.size(p["turns"]) >= half, _name(p["forest"], upper)), both)

    return cut


def named_paths(whole: DataFrame, levels: int) -> DataFrame:
    """(conv_id, names, n_chars): the name of each prefix of a conversation, and the code points of its last turn, by depth.

    A piece is (forest, end, turns): the name of the prefix it goes on from, that of its last prefix if it has as many turns as a piece can
    have, and its turns. Each cut makes of it an upper piece, which ends at the cut prefix, and a lower one, which begins there.
    """
    full = 1 << levels
    root = F.lit(ROOT)
    pieces = F.array(F.struct(
        root.alias("forest"), F.when(F.size("turns") == full, _name(root, F.col("turns"))).alias("end"), F.col("turns").alias("turns"),
    ))
    out = whole.select("conv_id", F.transform("turns", lambda t: t["n_chars"]).alias("n_chars"), F.when(F.size("turns") > 0, pieces).otherwise(F.slice(pieces, 1, 0)).alias("pieces"))
    for level in range(levels - 1, -1, -1):
        pieces = F.filter(F.flatten(F.transform("pieces", _cut_at(1 << level))), lambda p: F.size(p["turns"]) > 0)
        out = out.withColumn("pieces", pieces)
    return out.select("conv_id", F.transform("pieces", lambda p: p["end"]).alias("names"), "n_chars")


def _block(depth: Column) -> Column:
    """Levels of the largest block of levels that ends at this depth."""
    return depth.bitwiseAND(-depth)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """(name, parent, depth, conv_id, n_convs, n_chars, path): one row per distinct prefix but the empty one.

    path: names of the node and its ancestors in the block of levels that ends with it, least depth first.
    """
    at = paths.select("conv_id", "names", F.posexplode(F.arrays_zip("names", "n_chars")).alias("before", "turn"))
    depth = F.col("before") + 1
    rows = at.select(
        "conv_id", depth.alias("depth"), F.col("turn.names").alias("name"), F.col("turn.n_chars").alias("n_chars"),
        F.when(depth == 1, F.lit(ROOT)).otherwise(F.get("names", F.col("before") - 1)).alias("parent"),
        F.slice("names", depth - _block(depth) + 1, _block(depth)).alias("path"),
    )
    # all but conv_id is the same for all members of a node
    return rows.groupBy("name").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.first("n_chars").alias("n_chars"), F.first("path").alias("path"),
    )


def grafted(nodes: DataFrame, own: DataFrame, levels: int, totals: list[str]) -> DataFrame:
    """(name, totals): sums over each node's subtree. own: (name, parent, depth, totals), what a node brings itself.

    First every level is a block. In each round neighbouring blocks become one: the totals of the lower block's top nodes are added up by
    the cut node above them, which hands them to itself and its ancestors in the upper block.
    """
    add = [F.sum(t).alias(t) for t in totals]
    for level in range(levels):
        half = 1 << level
        tops = own.where((F.col("depth") - 1) % (2 * half) == half)
        below = tops.groupBy(F.col("parent").alias("cut")).agg(*add)
        cuts = nodes.where(F.col("depth") % (2 * half) == half).select(F.col("name").alias("cut"), "path")
        handed = cuts.join(below, "cut").select(F.explode("path").alias("name"), *totals)
        none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("parent", "depth")]
        both = own.unionByName(handed.select("name", *none, *totals))
        own = stored(both.groupBy("name").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), *add), "subtree-totals")
    return own


def end_digests(paths: DataFrame) -> DataFrame:
    """(name, ends_sha256): hash of the ids of the conversations that end at a node, ascending, comma-joined.

    Ids are sorted in ranges of (node, id), so a node with very many ends is shared out; ranges give packed rows of up to 8,192
    ids, which one task per node only has to read on and hash: it holds one of them at a time.
    """
    ends = stored(paths.select(F.coalesce(F.try_element_at("names", F.lit(-1)), F.lit(ROOT)).alias("name"), "conv_id"), "ends")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, ids = None, []
        for batch in batches:
            out = []
            for n, i in zip(batch["name"], batch["conv_id"]):
                if ids and (n != name or len(ids) == _CHUNK):
                    out.append((name, ids[0], ",".join(map(str, ids))))
                    ids = []
                name = n
                ids.append(i)
            yield pd.DataFrame(out, columns=["name", "first_id", "ids"])
        if ids:
            yield pd.DataFrame([(name, ids[0], ",".join(map(str, ids)))], columns=["name", "first_id", "ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch["name"], batch["ids"]):
                if n == name:
                    state.update(b",")
                else:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = n, hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=["name", "ends_sha256"])
        if state:
            yield pd.DataFrame([(name, state.hexdigest())], columns=["name", "ends_sha256"])

    packed = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInPandas(pack, "name binary, first_id long, ids string")
    return packed.repartition("name").sortWithinPartitions("name", "first_id").mapInPandas(digest, "name binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", group: int = 100, heads: int = 6,
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, name, parent): one row per node.

    Conversation c is rebuilt from the first h turns of conversation c - c % group (all if fewer, none if it is absent) and its own
    after the first h, where h = crc32(decimal c) % heads. A node is a distinct sequence of first turns by role and text; its members are the
    conversations that begin with it, conv_id is the smallest. The root has no turns and all conversations. Turns go
    by number, NULL first, rows of one number by a hash of role and text, so repeated rows are turns of their own. NULL roles and texts
    are empty; rows without a conversation's id belong to none and are left out. Without conversations there is no root and no row. Other
    columns are not read. Nodes are told apart by 256-bit hashes.

    A conversation's turns meet in one row, as names of 32 bytes; whatever else is gathered by node is summed up before the shuffle.
    """
    whole = stored(sequences(conversations, conversation, turn, role, text), "sequences")
    whole = stored(rebuilt(whole, group, heads), "rebuilt")
    sizes = whole.agg(F.max(F.size("turns")).alias("longest"), F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n")).first()
    levels = math.ceil(math.log2(max(sizes["longest"] or 1, 1)))
    paths = stored(named_paths(whole, levels), "paths")
    nodes = stored(trie_nodes(paths), "nodes")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    own = nodes.join(children, "name", "left").select(
        "name", "parent", "depth", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    totals = grafted(nodes, stored(own, "own-totals"), levels, ["n_leaves", "saved_tokens"])
    top = totals.where("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    root = top.where(F.lit(sizes["n"] > 0)).select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), F.lit(sizes["least"]).cast("long").alias("conv_id"),
        F.lit(sizes["n"]).alias("n_convs"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    )
    all_nodes = nodes.join(totals.select("name", "n_leaves", "saved_tokens"), "name").select(*root.columns).unionByName(root)
    all_nodes = all_nodes.join(children, "name", "left").join(end_digests(paths), "name", "left")
    # children of the root get its id as a constant, those of other nodes by a join that Spark may split where a node has very many
    above = nodes.select(F.col("name").alias("above"), F.col("conv_id").alias("above_id"))
    on = (F.col("parent") == F.col("above")) & (F.col("depth") > 1)
    return all_nodes.join(above, on, "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.when(F.col("depth") == 1, sizes["least"]).otherwise(F.col("above_id")).cast("long").alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "name", "parent",
    )
