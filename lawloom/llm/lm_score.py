"""Language-model scores: smoothed n-grams as a weighted backoff automaton, with its arcs spread over the cluster.

The model holds every n-gram of the training texts, so it grows with them and fits neither the driver nor one task. Texts are packed
into blocks; each block asks the shards that own its n-grams for their counts, builds the part of the automaton that it
can reach, and walks its texts through it. Packed arrays travel, not rows per n-gram.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import WordHashes, mixed, stored, text_of

#: No word is a single blank or two, so their hashes are free for the ends of a text.
_START, _END = (np.uint64(WordHashes()[mark]) for mark in (b"  ", b" "))
_PIECE = 512  # tokens that a text is walked at a time; has no influence on results


def _pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: the upper bytes of small numbers take almost no room."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


class Grams:
    """The n-grams of a block of texts: distinct ones by order, and which of them ends at each place.

    keys[k], train[k]: 64-bit key and count in the training texts of each distinct (k+1)-gram. at[k]: for each place the
    number of the (k+1)-gram that ends there, or -1. history[k], suffix[k]: numbers, one order below, of a gram without
    its last and without its first token.
    """

    def __init__(self, vocabulary: np.ndarray, ids: np.ndarray, lengths: np.ndarray, held: np.ndarray, order: int):
        self.lengths, self.begins = lengths, np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
        place = np.arange(len(ids), dtype=np.int64) - np.repeat(self.begins, lengths)
        learn = np.repeat(~held, lengths)
        self.keys, self.at, self.history, self.suffix = [vocabulary], [ids.astype(np.int64)], [None], [None]
        self.train = [np.bincount(ids[learn], minlength=len(vocabulary))]
        for k in range(1, order):
            there = np.flatnonzero(place >= k)
            code = self.at[k - 1][there - 1] * len(vocabulary) + ids[there]
            _, first, number = np.unique(code, return_index=True, return_inverse=True)
            first = there[first]
            at = np.full(len(ids), -1, np.int64)
            at[there] = number
            self.history.append(self.at[k - 1][first - 1])
            self.suffix.append(self.at[k - 1][first])
            self.keys.append(mixed(self.keys[k - 1][self.history[k]] * np.uint64(0x9E3779B97F4A7C15) + vocabulary[ids[first]] + np.uint64(k)))
            self.at.append(at)
            self.train.append(np.bincount(number[learn[there]], minlength=len(first)))


def _blocks(rows: DataFrame, kind: str, order: int, block_tokens: int) -> DataFrame:
    """(block, doc_ids, lengths, held, vocabulary, ids, grams): the texts as numbers of their block's vocabulary, frequent words first."""

    def pack(texts: list[np.ndarray], doc_ids: list, held: list[bool], block: int) -> dict:
        tokens = np.concatenate(texts)
        words, ids, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        order_ = np.argsort(-counts, kind="stable")
        rank = np.empty_like(order_)
        rank[order_] = np.arange(len(order_))
        lengths = [len(t) for t in texts]
        return {
            "block": block, "doc_ids": doc_ids, "lengths": lengths, "held": held, "vocabulary": words[order_].tobytes(),
            "ids": _pack(rank[ids].astype(np.uint32)), "grams": len(tokens) * order,
        }

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        part, done = TaskContext.get().partitionId(), 0
        texts, doc_ids, held, size = [], [], [], 0
        for batch in batches:
            for doc_id, out, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                own = hashes.of(text.encode("utf-8", "surrogatepass").lower().split())
                texts.append(np.concatenate([[_START], own, [_END]]).astype(np.uint64))
                doc_ids.append(doc_id), held.append(bool(out))
                size += len(own) + 2
                if size >= block_tokens:
                    yield pd.DataFrame([pack(texts, doc_ids, held, (part << 32) + done)])
                    texts, doc_ids, held, size, done = [], [], [], 0, done + 1
        if texts:
            yield pd.DataFrame([pack(texts, doc_ids, held, (part << 32) + done)])

    return rows.mapInPandas(
        encode, f"block long, doc_ids array<{kind}>, lengths array<int>, held array<boolean>, vocabulary binary, ids binary, grams long"
    )


def _grams_of(row, order: int) -> Grams:
    return Grams(
        np.frombuffer(row.vocabulary, np.uint64), _unpack(row.ids, np.uint32).astype(np.int64), np.array(row.lengths, np.int64),
        np.array(row.held, bool), order,
    )


def _shards(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each shard that has keys, the places of its keys, by key. The cost is that of the keys, however many shards there are."""
    order = np.argsort(keys)
    owner = (keys[order] % np.uint64(n)).astype(np.int64)
    by_shard = np.argsort(owner, kind="stable")
    shards, starts = np.unique(owner[by_shard], return_index=True)
    for shard, places in zip(shards.tolist(), np.split(order[by_shard], starts[1:])):
        yield shard, places


def _walk(grams: Grams, counts: list[np.ndarray], total: int, types: int, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each token under the automaton, and under its root alone.

    A state is a history; the longer its known history, the higher its level, and the root has level 0. An arc leads from a
    history along a seen token; the failure arc leads to the history without its first token and carries the weight
    left for unseen tokens. The root has an arc for every token.
    """
    order = len(counts)
    arcs = [(counts[0] + 0.1) / (total + 0.1 * (types + 1))]
    for k in range(1, order):
        room = counts[k - 1][grams.history[k]] + strength
        arcs.append((counts[k] + strength * arcs[k - 1][grams.suffix[k]]) / room)
    arcs = [np.log10(a) for a in arcs]
    failure = [np.log10(strength / (c + strength)) for c in counts[:-1]]
    base, score = arcs[0][grams.at[0]], np.zeros(len(grams.at[0]))
    # pieces of texts, side by side; each begins order - 1 tokens early to come into its state, and the first after the start mark
    pieces = [np.arange(b + 1, b + n, _PIECE) for b, n in zip(grams.begins, grams.lengths)]
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    first = np.concatenate(pieces)
    begin = np.maximum(first - (order - 1), grams.begins[owner])
    end = np.minimum(first + _PIECE, (grams.begins + grams.lengths)[owner])
    by_length = np.argsort(begin - end, kind="stable")
    first, begin, end = first[by_length], begin[by_length], end[by_length]
    level = np.zeros(len(first), np.int64)
    for t in range(int((end - begin).max(initial=0))):
        live = int(np.searchsorted(begin - end, -t))
        at = begin[:live] + t
        gained = np.zeros(live)
        now, new = level[:live], np.zeros(live, np.int64)
        waiting = np.ones(live, bool)
        for k in range(order - 1, 0, -1):
            here = np.flatnonzero(waiting & (now == k))
            if len(here):
                number = grams.at[k][at[here]]
                found = (number >= 0) & (counts[k][number] > 0)
                hit, miss = here[found], here[~found]
                gained[hit] += arcs[k][number[found]]
                new[hit] = min(k + 1, order - 1)
                waiting[hit] = False
                gained[miss] += failure[k - 1][grams.at[k - 1][at[miss] - 1]]
                now = now.copy()
                now[miss] = k - 1
        left = np.flatnonzero(waiting)
        number = grams.at[0][at[left]]
        gained[left] += arcs[0][number]
        new[left] = np.where(counts[0][number] > 0, min(1, order - 1), 0)
        level[:live] = new
        own = at >= first[:live]
        score[at[own]] = gained[own]
    return score, base


def score_texts(
    docs: DataFrame, held_out, id_column: str = "doc_id", text_column: str = "text", order: int = 2, strength: float = 4.0,
    block_tokens: int = 250_000, shard_grams: int = 2_000_000,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per row of docs; scores are log10 of the text.

    held_out: a boolean Column; rows where it is false are learnt from, all are scored. Tokens are the words between ASCII blanks,
    A-Z lower-cased, and one end per text; NULL texts are empty and have the end only. An n-gram's probability is its count
    and `strength` times that of its suffix, over its history's count and `strength`; the root gives (c + 0.1) / (N + 0.1 (V + 1)).
    Repeated rows count and are scored each; an empty table gives no rows; other columns are not read; a NULL held_out counts as true.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), text_of(text_column).alias("text"))
    blocks = stored(_blocks(rows, kind, order, block_tokens), "blocks")
    n_shards = max(1, math.ceil((blocks.agg(F.sum("grams")).first()[0] or 0) / shard_grams))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                grams = _grams_of(row, order)
                for k in range(order):
                    out = []
                    for shard, places in _shards(grams.keys[k], n_shards):
                        keys = grams.keys[k][places]
                        steps = np.diff(keys, prepend=np.uint64(0))
                        out.append((k, shard, row.block, _pack(steps), _pack(grams.train[k][places].astype(np.uint32))))
                    yield pd.DataFrame(out, columns=["level", "shard", "block", "keys", "counts"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        """Total counts of a shard's keys, sent back to each block in the order in which it asked."""
        keys = [np.cumsum(_unpack(k, np.uint64)) for k in group["keys"]]
        ends = np.cumsum([len(k) for k in keys])
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        asked = np.concatenate([_unpack(c, np.uint32) for c in group["counts"]])
        totals = np.bincount(number, weights=asked, minlength=len(distinct)).astype(np.int64)
        replies = [_pack(totals[n].astype(np.uint64)) for n in np.split(number, ends[:-1])]
        words = (distinct != _START) & (int(group["level"].iloc[0]) == 0)
        first = np.arange(len(group)) == 0
        return pd.DataFrame({
            "level": group["level"], "shard": group["shard"], "block": group["block"], "counts": replies,
            "tokens": np.where(first, totals[words].sum(), 0), "types": np.where(first, (totals[words] > 0).sum(), 0),
        })

    asked = blocks.mapInPandas(ask, "level int, shard int, block long, keys binary, counts binary")
    replies = stored(
        asked.groupBy("level", "shard").applyInPandas(answer, "level int, shard int, block long, counts binary, tokens long, types long"), "replies"
    )
    sums = replies.agg(F.sum("tokens"), F.sum("types")).first()
    total, types = sums[0] or 0, sums[1] or 0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                grams = _grams_of(row, order)
                counts = [np.zeros(len(k), np.int64) for k in grams.keys]
                told = {(r["level"], r["shard"]): r["counts"] for r in row.replies}
                for k in range(order):
                    for shard, places in _shards(grams.keys[k], n_shards):
                        counts[k][places] = _unpack(told[k, shard], np.uint64)
                scores, base = _walk(grams, counts, total, types, strength)
                is_token = np.ones(len(base), np.int64)
                is_token[grams.begins] = 0
                known = is_token * (counts[0][grams.at[0]] > 0)
                yield pd.DataFrame({
                    "doc_id": row.doc_ids, "held_out": row.held, "n_tokens": np.add.reduceat(is_token, grams.begins),
                    "n_known": np.add.reduceat(known, grams.begins), "train_tokens": total,
                    "base_score": np.add.reduceat(base * is_token, grams.begins), "score": np.add.reduceat(scores, grams.begins),
                })

    gathered = replies.groupBy("block").agg(F.collect_list(F.struct("level", "shard", "counts")).alias("replies"))
    return blocks.join(gathered.hint("merge"), "block").select("doc_ids", "lengths", "held", "vocabulary", "ids", "replies").mapInPandas(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
