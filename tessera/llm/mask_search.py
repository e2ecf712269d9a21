"""Ranked lexical search by presence-mask grouping.

1. Texts are cut into terms; one narrow row a document keeps its length and its counts of
   the items' terms (looked up by hash, then compared byte by byte).
2. Document frequencies and totals are aggregated over all documents.
3. A task takes its documents in chunks.  For each term of the items the chunk has a bitmap
   of the documents that hold it; an item's bitmaps, side by side, give every document the
   mask of the terms that it matches.  Documents of one mask form a group, whose best
   possible score is the sum of the weights of its terms times their largest factor in the
   chunk.  Groups are scored exactly in descending order of that bound, until no bound left
   reaches the item's last place so far.
4. The tasks' best documents are ranked once more.

Items come in blocks of bounded size, each against all documents, so neither their number
nor that of their terms is limited; documents are never joined with items.

Defined results: a null or empty text has no term and is no document of the statistics; a null
or term-less item has no rows; repeated rows of items count once, of documents each; a null
``doc_id`` stands behind all others of its score; empty tables give an empty result.  Other
columns of the inputs are left out.  Ids are integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, prefix_code, raw_bytes, slices, span_code, word_spans

#: Bytes between terms: all of ASCII but digits and letters.
GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

#: Items of a block and their bytes; bytes of text at once; documents and postings of a chunk.
ITEMS, ITEM_BYTES, SLICE = 4096, 1 << 22, 1 << 20
DOCS, POSTINGS = 1 << 15, 1 << 21
#: Terms of one mask word; documents scored in the first round of an item.
WORD, FIRST = 62, 64
#: Smoothing of a document's length, in percent of its share by length.
FLAT, SHARE = 75, 25
NO_ID = np.iinfo(np.int64).max


def terms_of(buf: np.ndarray, off: np.ndarray):
    """(lower-cased bytes, start, end, row) of the terms of each text."""
    start, end, row = word_spans(buf, off, GAP)
    return LOWER[buf], start, end, row


# ----------------------------------------------------------------- vocabulary

@dataclass
class Vocabulary:
    """Terms in the order of their hash; ``chunks`` holds their bytes as words of eight."""

    code: np.ndarray
    size: np.ndarray
    chunks: np.ndarray
    twins: int

    @classmethod
    def of(cls, terms: list[bytes]) -> tuple["Vocabulary", list[bytes]]:
        buf = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        code = span_code(prefix_code(buf), end - size, end) if len(terms) else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        code = code[order]
        wide = max(1, -(-int(size.max()) // 8)) if len(terms) else 1
        chunks = np.zeros((len(terms), wide), "<u8")
        for i, k in enumerate(order.tolist()):
            chunks[i] = np.frombuffer(terms[k].ljust(8 * wide, b"\0"), "<u8")
        _, same = np.unique(code, return_counts=True)
        return cls(code, size[order], chunks, int(same.max()) if len(same) else 0), [terms[k] for k in order.tolist()]

    def find(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The term at each span, or -1."""
        out = np.full(len(start), -1, np.int64)
        if not len(start) or not len(self.code):
            return out
        code = span_code(prefix_code(buf), start, end)
        low = np.searchsorted(self.code, code)
        padded = np.concatenate([buf, np.zeros(8, np.uint8)])
        words = np.ndarray((len(buf) + 1,), "<u8", buffer=padded, strides=(1,))
        for step in range(self.twins):
            at = np.minimum(low + step, len(self.code) - 1)
            hit = np.flatnonzero((self.code[at] == code) & (self.size[at] == end - start))
            for j in range(self.chunks.shape[1]):
                left = self.size[at[hit]] - 8 * j
                long = np.flatnonzero(left > 0)
                if not len(long):
                    break
                cut = (np.maximum(8 - left[long], 0) * 8).astype(np.uint64)
                read = words[start[hit[long]] + 8 * j] << cut >> cut
                good = np.ones(len(hit), bool)
                good[long] = read == self.chunks[at[hit[long]], j]
                hit = hit[good]
            out[hit] = at[hit]
        return out


def _count_rows(vocabulary: Vocabulary):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = max(len(vocabulary.code), 1)
        for b in slices(batches, "text", SLICE):
            buf, off = raw_bytes(b.column("text"))
            low, start, end, row = terms_of(buf, off)
            n = np.bincount(row, minlength=b.num_rows).astype(np.int64)
            term = vocabulary.find(low, start, end)
            known = term >= 0
            pair, tf = np.unique(row[known] * wide + term[known], return_counts=True)
            lists = np.concatenate([[0], np.cumsum(np.bincount(pair // wide, minlength=b.num_rows))]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(lists), pa.array((pair % wide).astype(np.int32)))
            counts = pa.ListArray.from_arrays(pa.array(lists), pa.array(tf.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n), ids, counts], names=["id", "n", "terms", "tfs"])
    return work


# -------------------------------------------------------------- masks and scores

@dataclass
class Item:
    number: int
    terms: np.ndarray
    weights: np.ndarray


class Chunk:
    """Documents with their postings by term."""

    def __init__(self, ids, n, lists, terms, tfs, total: int, length: int):
        doc = np.repeat(np.arange(len(ids)), lists)
        m = FLAT + (SHARE * n * total) // length
        order = np.argsort(terms, kind="stable")
        self.ids, self.size = ids, len(ids)
        self.doc = doc[order]
        tf = tfs[order].astype(np.int64)
        self.factor = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.doc])
        self.term, first = np.unique(terms[order], return_index=True)
        self.ends = np.append(first, len(order))
        self.best = np.maximum.reduceat(self.factor, first) if len(first) else np.zeros(0, np.int64)

    def postings(self, i: int) -> slice:
        return slice(self.ends[i], self.ends[i + 1])


def mask_groups(chunk: Chunk, slots: np.ndarray, bounds: np.ndarray):
    """Documents grouped by the mask of the terms at ``slots`` that they hold: (documents, group ends, bounds).

    Groups stand in descending order of their bound; documents without any of the terms are left out.
    """
    words = [np.zeros(chunk.size, np.int64) for _ in range(-(-len(slots) // WORD))]
    for j, s in enumerate(slots):
        words[j // WORD][chunk.doc[chunk.postings(s)]] |= np.int64(1) << np.int64(j % WORD)
    some = words[0] != 0
    for w in words[1:]:
        some |= w != 0
    docs = np.flatnonzero(some)
    _, label = np.unique(words[0][docs], return_inverse=True)
    for w in words[1:]:
        _, more = np.unique(w[docs], return_inverse=True)
        _, label = np.unique(label * (int(more.max()) + 1 if len(more) else 1) + more, return_inverse=True)
    order = np.argsort(label, kind="stable")
    docs, label = docs[order], label[order]
    head = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]])) if len(docs) else np.zeros(0, np.int64)
    bound = np.zeros(len(head), np.int64)
    for j, b in enumerate(bounds):
        bound += ((words[j // WORD][docs[head]] >> np.int64(j % WORD)) & 1) * b
    size = np.diff(np.append(head, len(docs)))
    by = np.argsort(-bound, kind="stable")
    pick = np.repeat(head[by] - (np.cumsum(size[by]) - size[by]), size[by]) + np.arange(len(docs))
    return docs[pick], np.cumsum(size[by]), bound[by]


def scores_of(chunk: Chunk, slots: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Exact scores of ``docs`` (ascending)."""
    out = np.zeros(len(docs), np.int64)
    for s, w in zip(slots, weights):
        p = chunk.postings(s)
        held = chunk.doc[p]
        at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
        out += np.where(held[at] == docs, chunk.factor[p][at], 0) * w
    return out


def rank_chunk(chunk: Chunk, item: Item, held: tuple[np.ndarray, np.ndarray], k: int):
    """``held`` (scores, ids in rank order, ``k`` at most) with the better documents of the chunk."""
    at = np.searchsorted(chunk.term, item.terms)
    at = np.minimum(at, len(chunk.term) - 1)
    there = np.flatnonzero((chunk.term[at] == item.terms) & (item.weights > 0))
    slots, weights = at[there], item.weights[there]
    if not len(slots):
        return held
    bounds = weights * chunk.best[slots]
    if len(held[0]) == k and bounds.sum() < held[0][-1]:
        return held
    docs, ends, bound = mask_groups(chunk, slots, bounds)
    done, room = 0, FIRST
    while done < len(ends):
        if len(held[0]) == k:
            if bound[done] < held[0][-1]:
                break
            last = int(np.searchsorted(-bound, -held[0][-1], side="right"))  # groups that may still reach a place
        else:
            last = len(ends)
        begin = int(ends[done - 1]) if done else 0
        upto = min(max(int(np.searchsorted(ends, begin + room, side="right")), done + 1), last)
        some = np.sort(docs[begin: ends[upto - 1]])
        score = scores_of(chunk, slots, weights, some)
        score_all = np.concatenate([held[0], score])
        ids_all = np.concatenate([held[1], chunk.ids[some]])
        best = np.lexsort((ids_all, -score_all))[:k]
        best = best[score_all[best] > 0]
        held = score_all[best], ids_all[best]
        done, room = upto, room * 4
    return held


def _rank_rows(items: list[Item], total: int, length: int, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(items)
        for chunk in _chunks(batches, total, length):
            best = [rank_chunk(chunk, item, held, k) for item, held in zip(items, best)]
        n = [len(s) for s, _ in best]
        if sum(n):
            ids = np.concatenate([i for _, i in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([i.number for i in items], n).astype(np.int32)), pa.array(ids, mask=ids == NO_ID),
                 pa.array(np.concatenate([s for s, _ in best]))], names=["item", "id", "score"])
    return work


def _chunks(batches: Iterator[pa.RecordBatch], total: int, length: int) -> Iterator[Chunk]:
    held: list[tuple] = []

    def chunk():
        return Chunk(*[np.concatenate(x) for x in zip(*held)], total, length)

    docs = postings = 0
    for b in batches:
        at = 0
        lists = b.column("terms").value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(lists)
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            upto = int(np.searchsorted(ends, before + POSTINGS - postings, side="right"))
            upto = min(max(upto, at + 1 if not docs else at), at + DOCS - docs, b.num_rows)
            if upto > at:
                s = b.slice(at, upto - at)
                held.append((s.column("id").fill_null(NO_ID).to_numpy(), s.column("n").to_numpy(), lists[at:upto],
                             s.column("terms").flatten().to_numpy(), s.column("tfs").flatten().to_numpy()))
                docs, postings = docs + upto - at, postings + int(ends[upto - 1]) - before
            at = upto
            if at < b.num_rows or docs >= DOCS or postings >= POSTINGS:
                yield chunk()
                held, docs, postings = [], 0, 0
    if held:
        yield chunk()


# ------------------------------------------------------------------ on DataFrames

def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their terms, streamed in blocks of bounded size."""
    block, size = [], 0
    for row in items.toLocalIterator():
        data = (row["text"] or "").encode()
        low, start, end, _ = terms_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        low = low.tobytes()
        if not len(start):
            continue
        block.append((row["id"], [low[s:e] for s, e in zip(start.tolist(), end.tolist())]))
        size += len(data)
        if len(block) >= ITEMS or size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, text_col: str = "text", id_col: str = "doc_id",
                   item_text_col: str = "text", item_id_col: str = "item_id") -> DataFrame:
    """(item id, rank, document id, score) of the ``k`` best documents of each item, scores above 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_id_col}`").alias("id"), F.col(f"`{item_text_col}`").alias("text")).distinct()
    id_type = asked.schema["id"].dataType
    out = spark.createDataFrame([], f"{id_col} long, score long").select(
        F.lit(None).cast(id_type).alias(item_id_col), F.lit(0).alias("rank"), id_col, "score")
    for block in item_blocks(asked):
        vocabulary, terms = Vocabulary.of(sorted({t for _, ts in block for t in ts}))
        number = {t: i for i, t in enumerate(terms)}
        counted = scratch.put(src.mapInArrow(_count_rows(vocabulary), "id long, n long, terms array<int>, tfs array<int>")
                              .where("n > 0"))
        total, length = counted.agg(F.count("*"), F.sum("n")).first()
        if not total:
            break
        # one row for each term of the block
        df = dict(map(tuple, counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect()))
        weight = [math.floor(1000 * math.log((2 * total + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(terms))]
        asks = []
        for i, (_, ts) in enumerate(block):
            n = Counter(number[t] for t in ts)
            ids = np.array(sorted(n), np.int64)
            asks.append(Item(i, ids, np.array([n[t] * weight[t] for t in ids.tolist()], np.int64)))
        found = counted.where(F.size("terms") > 0).mapInArrow(
            _rank_rows(asks, total, length, k), "item int, id long, score long")
        best = [F.col("score").desc(), F.col("id").asc_nulls_last()]
        # the best of some tasks' rows first, so that no task ranks those of all
        part = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
        part = part.withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).where(f"r <= {k}")
        ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(f"rank <= {k}")
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)],
                                      f"number int, name {id_type.simpleString()}")
        result = scratch.put(ranked.join(names, F.col("item") == F.col("number")).select(
            F.col("name").alias(item_id_col), "rank", F.col("id").alias(id_col), "score"))
        scratch.drop(counted)
        out = out.unionByName(result)
    return out
