"""Near copies by Jaccard similarity of word shingles: a chosen-path join.

Every set of shingles grows seeded random paths: at each step a path goes on with the set's own tokens that a hash of path and token
picks, 1 / (similarity * size) of them on average. Two sets at the wanted similarity then share one step in the mean, so
they meet at the end of a common path; sets that share little soon part. A bucket is all sets with one path. Small
buckets are compared at once, large ones are split by the next step of their paths; whole runs are repeated until the wanted recall.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import WordHashes, keep_decided, key_filter, may_hold, mixed, shingle_hashes, stored, text_of

_SKETCH = 64  # bytes, one per permutation
_C = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the least similarity has met with probability `recall`, if all its buckets are split to the last.

    At each step the number of shared picks has mean 1 at least, so a pair still meets after k steps with p(k) = 1 - exp(-p(k - 1)).
    """
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def shingle_set(text: str, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words between ASCII blanks, A-Z lower-cased; fewer words are one run."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(hashes.of(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


def _odd(seed: int, n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _C + np.uint64(seed)) | np.uint64(1)


def paths(tokens: np.ndarray, similarity: float, runs: int, depth: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per step the keys of the paths that end there and the keys of the paths that they continue."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (similarity * len(tokens)))))
    parents, out = _odd(seed, runs), []
    for _ in range(depth):
        picked = tokens[None, :] * (mixed(parents) | np.uint64(1))[:, None] <= limit
        at, token = np.nonzero(picked)
        keys = mixed(parents[at] * _C + tokens[token])
        out.append((keys, parents[at]))
        parents = keys
    return out


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b): root is the smallest node joined to it. Alternating large and small stars."""
    edges = stored(edges.select("a", "b").where("a != b"), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a != b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _pack_pairs(rows: np.ndarray, cross: bool, key: int, similarity: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of a bucket that may be similar and have no earlier bucket in common. rows: packed members, see near_copies."""
    members, at = [], 0
    while at < len(rows):
        n_terms = int(rows[at + 3])
        members.append((rows[at : at + 4], rows[at + 4 : at + 4 + _SKETCH // 8], rows[at + 4 + _SKETCH // 8 : at + 4 + _SKETCH // 8 + n_terms]))
        at += 4 + _SKETCH // 8 + n_terms
    heads = np.array([m[0] for m in members])
    sketches = np.array([m[1] for m in members]).view(np.uint8)
    m = len(members)
    # equal bytes estimate the similarity with a deviation of sqrt(s (1 - s) / 64); 4.5 of them below is still a candidate
    least = (similarity - 4.5 * math.sqrt(similarity * (1 - similarity) / _SKETCH)) * _SKETCH
    if m <= 32:
        same = (sketches[:, None] == sketches[None]).sum(2)
    else:
        same = np.zeros((m, m), np.int16)
        for c in range(_SKETCH):
            same += sketches[:, None, c] == sketches[None, :, c]
    sizes = heads[:, 1]
    may = (same >= least) & (np.minimum(sizes[:, None], sizes[None, :]) >= similarity * np.maximum(sizes[:, None], sizes[None, :]) - 1e-9)
    may &= np.triu(np.ones((m, m), bool), 1)
    if cross:
        may &= heads[:, 2][:, None] != heads[:, 2][None, :]
    if not may.any():
        return None
    earlier = [t[t < key] for _, _, t in members]
    names, number = np.unique(np.concatenate(earlier), return_inverse=True)
    if len(names):
        holds = np.zeros((m, len(names)), np.float32)
        holds[np.repeat(np.arange(m), [len(e) for e in earlier]), number] = 1
        may &= holds @ holds.T == 0
    a, b = np.nonzero(may)
    used, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    return (heads[used, 0], number.astype(np.int32)) if len(used) else None


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of tokens that each pair of sets has in common."""
    if len(a) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    names, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    both = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, len(names), 8192):
        here = (number >= first) & (number < first + 8192)
        holds = np.zeros((len(sets), 8192), np.float32)
        holds[owner[here], number[here] - first] = 1
        both += holds @ holds.T
    return both[a, b].astype(np.int64)


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, similarity: float = 0.8, recall: float = 0.999,
    depth: int = 3, bucket: int = 256, seed: int = 11, shard_bytes: int = 32_000_000, filter_bits: int = 2**23,
) -> DataFrame:
    """(doc_id, class_id, n_links, class_size, kept, text_key): one row per row of docs.

    Rows are linked when their sets of word shingles have at least the given Jaccard similarity, checked exactly; copies
    are linked too. n_links counts a row's links, classes are what links join, class_id is the least id in the class and
    the row that is kept (one of them, if rows repeat). NULL and empty texts have no shingles: each is a class of its own.
    NULL ids are larger than all others. An empty table gives no rows; other columns are not read.

    Equal sets are one node, by a 64-bit hash. Buckets over `bucket` sets are split up to `depth` steps; what is larger then is
    compared in blocks of that size, so no bucket is cut off or gathered whole. A pair counts in the first of its common
    buckets only and never becomes a row: a bucket gives one row of packed pairs, a check one row per member.
    """
    runs = runs_for(recall, depth)
    kind = docs.schema[id_column].dataType.simpleString()

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, odd = WordHashes(), _odd(seed + 1, _SKETCH)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.iloc[begin : begin + 256]
                out = []
                for row_id, doc_id, text_key, text in zip(part["row_id"], part["doc_id"], part["text_key"], part["text"]):
                    tokens = shingle_set(text, shingle, hashes)
                    if not len(tokens):
                        out.append((row_id, doc_id, text_key, None, 0, None, *[None] * (2 * depth)))
                        continue
                    sketch = np.array([(tokens * a).min() for a in odd])
                    sketch = (mixed(sketch) & np.uint64(255)).astype(np.uint8).view(np.int64)
                    name = np.uint64(xxhash.xxh64_intdigest(tokens.tobytes()))
                    steps = [_signed(k) for step in paths(tokens, similarity, runs, depth, seed) for k in step]
                    out.append((row_id, doc_id, text_key, int(name.view(np.int64)), len(tokens), sketch, *steps))
                columns = ["row_id", "doc_id", "text_key", "node", "size", "sketch", *(f"{c}{d}" for d in range(depth) for c in ("key", "parent"))]
                frame = pd.DataFrame(out, columns=columns)
                yield frame.astype({"node": "Int64"})

    steps = ", ".join(f"key{d} array<long>, parent{d} array<long>" for d in range(depth))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    signed = stored(
        rows.withColumn("text_key", F.xxhash64("text")).mapInPandas(
            sign, f"row_id long, doc_id {kind}, text_key long, node long, size long, sketch array<long>, {steps}"
        ),
        "signed",
    )
    known = signed.where(F.col("node").isNotNull())
    nodes = known.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.max("size").alias("size"), F.min("row_id").alias("row_id")
    )

    def continued(d: int, bits: np.ndarray) -> DataFrame:
        """(key, node): step d of the paths that have ended in a large bucket. Some more may pass the filter; that only finds pairs again."""
        shared_bits = docs.sparkSession.sparkContext.broadcast(bits)

        def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                batch = batch.drop_duplicates("node")  # copies go the same ways
                at = np.repeat(np.arange(len(batch)), batch["keys"].map(len))
                keys, parents = (np.concatenate([np.empty(0, np.int64), *batch[c]]) for c in ("keys", "parents"))
                on = may_hold(parents.view(np.uint64), shared_bits.value)
                yield pd.DataFrame({"key": keys[on], "node": batch["node"].to_numpy()[at[on]]})

        return known.select("node", F.col(f"key{d}").alias("keys"), F.col(f"parent{d}").alias("parents")).mapInPandas(go_on, "key long, node long")

    # buckets, step by step
    ends, large = [], None
    for d in range(depth):
        if large is None:
            level = known.select("node", F.explode("key0").alias("key"))
        else:
            level = stored(continued(d, key_filter(large.select("key"), filter_bits)), "continued")
        shared = level.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("key")
        members = stored(level.join(shared.hint("merge"), "key").distinct(), "members")
        counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        last = d == depth - 1
        done = counts if last else counts.where(F.col("n") <= bucket)
        ends.append(members.join(done, "key"))
        large = stored(counts.where(F.col("n") > bucket), "large-buckets") if not last else None
        if large is not None and large.isEmpty():
            break
    ended = ends[0]
    for more in ends[1:]:
        ended = ended.unionByName(more)
    ended = stored(ended, "buckets")

    # pairs within buckets; a bucket over the limit is dealt into blocks, and each pair of blocks is a task
    terms = ended.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("terms"))
    sketches = known.join(nodes.select("row_id"), "row_id", "left_semi").select("node", "sketch")
    about = terms.join(nodes, "node").join(sketches, "node")
    rows_in = ended.join(about, "node").withColumn("blocks", F.ceil(F.col("n") / bucket).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows_in = rows_in.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    packed = F.concat(
        F.array(F.col("node"), F.col("size"), F.col("own").cast("long"), F.size("terms").cast("long")), F.col("sketch"), F.col("terms")
    )
    tasks = rows_in.groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.flatten(F.collect_list(packed)).alias("packed")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, i, j, packed in zip(batch["key"], batch["i"], batch["j"], batch["packed"]):
                found = _pack_pairs(np.asarray(packed, np.int64), i != j, key, similarity)
                if found:
                    out.append((key, i, j, *found))
            yield pd.DataFrame(out, columns=["key", "i", "j", "nodes", "pairs"])

    candidates = stored(
        tasks.mapInPandas(compare, "key long, i int, j int, nodes array<long>, pairs array<int>").withColumn("task", F.xxhash64("key", "i", "j")), "candidates"
    )

    # exact check, with the sets of the nodes in question
    asked = stored(candidates.select("key", "i", "j", F.explode("nodes").alias("node")).join(nodes.select("node", "copies", "size"), "node"), "asked")
    shards = max(1, math.ceil(8 * (asked.agg(F.sum("size")).first()[0] or 0) / shard_bytes))
    wanted = known.join(nodes.select("row_id"), "row_id", "left_semi").select("node", F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_key"))
    wanted = wanted.join(asked.select("node").distinct(), "node", "left_semi")
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text")).withColumn("text_key", F.xxhash64("text"))
    texts = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key")))

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.iloc[begin : begin + 256]
                yield pd.DataFrame({"node": part["node"], "tokens": [shingle_set(t, shingle, hashes).tobytes() for t in part["text"]]})

    sets = texts.select("node", "text").mapInPandas(sets_of, "node long, tokens binary").dropDuplicates(["node"])
    shard = F.pmod(F.xxhash64("key", "i", "j"), F.lit(shards)).alias("shard")
    given = asked.join(sets, "node").select(shard, "key", "i", "j", "node", "copies", "tokens")

    def check(tasks_: pd.DataFrame, given_: pd.DataFrame) -> pd.DataFrame:
        held = {k: (c, np.frombuffer(t, np.uint64)) for k, c, t in zip(given_["node"], given_["copies"], given_["tokens"])}
        out = []
        for members, pairs in zip(tasks_["nodes"], tasks_["pairs"]):
            a, b = np.asarray(pairs).reshape(2, -1)
            sets_ = [held[n][1] for n in members]
            sizes = np.array([len(s) for s in sets_], np.int64)
            both = _shared(sets_, a, b)
            linked = both >= similarity * (sizes[a] + sizes[b] - both) - 1e-9
            a, b = a[linked], b[linked]
            copies = np.array([held[n][0] for n in members], np.int64)
            links = np.bincount(a, copies[b], len(members)) + np.bincount(b, copies[a], len(members))
            root = list(range(len(members)))

            def top(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x, y in zip(a.tolist(), b.tolist()):
                root[top(x)] = top(y)
            out += [(members[x], int(links[x]), members[top(x)]) for x in np.flatnonzero(links).tolist()]
        return pd.DataFrame(out, columns=["node", "links", "root"])

    checked = candidates.select(shard, "nodes", "pairs").groupBy("shard").cogroup(given.groupBy("shard"))
    checked = stored(checked.applyInPandas(check, "node long, links long, root long"), "links")
    roots = _components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies", "least_id",
    )
    classes = nodes.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"))
    nodes = stored(nodes.join(classes, "root").select("node", "n_links", "class_id", "class_size"), "classes")
    found = known.select("row_id", "doc_id", "text_key", "node").join(nodes, "node")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("node", "class_id").agg(F.min("row_id").alias("first_row"))
    # an id may stand for several rows of the class; the first row is kept
    kept = kept.groupBy("class_id").agg(F.min("first_row").alias("first_row"))
    found = found.join(kept.withColumnRenamed("class_id", "of_class"), F.col("class_id").eqNullSafe(F.col("of_class")), "left")
    found = found.select("doc_id", "class_id", "n_links", "class_size", (F.col("row_id") == F.col("first_row")).alias("kept"), "text_key")
    alone = signed.where(F.col("node").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"), "text_key",
    )
    return found.unionByName(alone)


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class of near copies, with its own columns; see near_copies for what stays."""
    names = {k: options[k] for k in ("id_column", "text_column") if k in options}
    return keep_decided(docs, near_copies(docs, **options), **names)
