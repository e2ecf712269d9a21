"""SentencePiece encoding and decoding with the N best segmentations.

A text is the piece lattice of its characters (blank written as U+2581, one in front):
an edge is a vocabulary piece with its score, or a character of no piece of its own,
spelt in byte pieces at ``lowest score - 10``.  The N best paths come from a forward
Viterbi pass, whose scores are exact heuristics for a backward A-star search: what is
left to the front of a partial path costs exactly its forward score, so paths leave the
agenda in order of their total score.

The lattice has waists: no edge crosses two neighbouring characters that stand side by
side in no piece.  Between waists lie chunks (mostly words), searched once each and
cached; the N best of the text are the cheapest combinations of chunk alternatives.  A
chunk whose second path loses more than that of N - 1 other chunks cannot take part, so
the search opens only those (the loss follows from forward and backward scores).

The best path is ``ids`` (int32, little-endian, packed); the others are edits to it.

Defined results: null counts as empty; an empty text has no pieces, score 0 and no other
path; a literal U+2581 decodes to a blank (``round_trip`` false), every other text
decodes to itself; among equal scores the order is that of the search, the same at each
run; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, StringType,
                               StructField, StructType)

from tessera.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
SPACE = "▁"
#: Bytes of text a task works on at once; chunks remembered between slices of a worker.
SLICE, REMEMBER = 1 << 18, 300_000

EDIT = StructType([StructField("at", IntegerType()), StructField("old", IntegerType()), StructField("ids", BinaryType())])
RESULT = [StructField("n_pieces", IntegerType()), StructField("score", DoubleType()), StructField("ids", BinaryType()),
          StructField("others", ArrayType(StructType([StructField("score", DoubleType()),
                                                      StructField("edits", ArrayType(EDIT))]))),
          StructField("round_trip", BooleanType())]


STEP = np.uint64(0x9E3779B97F4A7C15)
#: Longest chunk that is learned side by side with others.
SIDE = 64


def _code(w: str) -> int:
    h = 0
    for c in w:
        h = ((h ^ (ord(c) + 1)) * int(STEP) + (h >> 29)) & 0xFFFFFFFFFFFFFFFF
    return h


class Pieces:
    """The vocabulary of a model: pieces with scores, byte pieces, and which characters may neighbour."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.table: dict[str, tuple[int, float] | None] = {}
        self.byte_id = [0] * 256
        self.raw: list[bytes] = [b""] * n
        lowest = 0.0
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.table[piece] = (i, sp.get_score(i))
                self.raw[i] = piece.replace(SPACE, " ").encode()
                lowest = min(lowest, sp.get_score(i))
        self.fallback = lowest - 10
        words = list(self.table)
        for w in words:  # prefixes of pieces, to end a scan early
            for k in range(1, len(w)):
                self.table.setdefault(w[:k])
        # characters side by side in some piece
        chars = sorted({c for w in words if len(w) > 1 for c in w})
        self.kind = np.zeros(0x110000, np.uint16)
        for k, c in enumerate(chars, 1):
            self.kind[ord(c)] = k
        self.touch = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for w in words:
            for a, b in zip(w, w[1:]):
                self.touch[self.kind[ord(a)], self.kind[ord(b)]] = True
        # the same table by hash: sorted keys, found by their top bits
        keys = np.array([_code(w) for w in self.table], np.uint64)
        order = np.argsort(keys)
        got = [v or (-1, 0.0) for v in self.table.values()]
        self.keys = keys[order]
        self.key_id = np.array([v[0] for v in got], np.int64)[order]
        self.key_score = np.array([v[1] for v in got])[order]
        self.bucket = np.searchsorted(self.keys >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64))
        self.probes = int(np.diff(self.bucket).max())
        self.length = np.array([len(r) for r in self.raw], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.clear()

    def clear(self) -> None:
        """Forget the chunks: index by chunk, and per chunk best score, loss of the second, pieces, ids."""
        self.known: dict[str, int] = {}
        self.names: list[str] = []
        self.score: list[float] = []
        self.loss: list[float] = []
        self.n: list[int] = []
        self.best: list[bytes] = []
        self.ranked: dict[int, list[tuple[float, bytes]]] = {}

    def edges(self, chunk: str) -> list[list[tuple[int, int, float]]]:
        """Edges into each position: (start, id, score); id -1 stands for a character in byte pieces."""
        n, table = len(chunk), self.table
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
        missing = (-1, self.fallback)
        for i in range(n):
            got = table.get(chunk[i])
            into[i + 1].append((i, *(got or missing)))
            if got is None and chunk[i] not in table:
                continue
            for j in range(i + 2, n + 1):
                part = chunk[i:j]
                got = table.get(part)
                if got is not None:
                    into[j].append((i, *got))
                elif part not in table:
                    break
        return into

    @staticmethod
    def forward(into: list) -> list[float]:
        alpha = [0.0]
        for edges in into[1:]:
            top = None
            for i, _, s in edges:
                v = alpha[i] + s
                if top is None or v > top:
                    top = v
            alpha.append(top)
        return alpha

    def spell(self, chunk: str, path: list[tuple[int, int]]) -> bytes:
        """Packed ids of a path [(start, id)]."""
        ids = []
        for i, k in path:
            if k >= 0:
                ids.append(k)
            else:
                ids += [self.byte_id[b] for b in chunk[i].encode("utf-8", "replace")]
        return struct.pack(f"<{len(ids)}i", *ids)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash in the sorted table, -1 if it has none."""
        top = (h >> np.uint64(48)).astype(np.int64)
        at, end = self.bucket[top], self.bucket[top + 1]
        out = np.full(len(h), -1)
        for k in range(self.probes):
            hit = (at + k < end) & (self.keys[np.minimum(at + k, len(self.keys) - 1)] == h)
            out[hit] = (at + k)[hit]
        return out

    def learn_all(self, chunks: list[str]) -> None:
        """``learn`` for many chunks side by side: all their lattices advance one position a step."""
        size = np.array([len(c) for c in chunks], np.int64)
        cps = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        owner = np.repeat(np.arange(len(chunks)), size)
        rel = np.arange(len(cps)) - np.repeat(np.cumsum(size) - size, size)
        left = size[owner] - rel
        # edges: pieces that start at each position, by growing length
        at, h = np.arange(len(cps)), np.zeros(len(cps), np.uint64)
        parts, plain, length = [], np.ones(len(chunks), bool), 1
        while len(at):
            h = (h ^ (cps[at + length - 1] + np.uint64(1))) * STEP + (h >> np.uint64(29))
            row = self.find(h)
            piece = (row >= 0) & (self.key_id[row] >= 0)
            if length == 1:
                plain[owner[at[~piece]]] = False  # a character in byte pieces: learned alone
            parts.append((at[piece], np.full(int(piece.sum()), length), row[piece]))
            on = (row >= 0) & (left[at] > length)
            at, h, length = at[on], h[on], length + 1
        start, length, row = (np.concatenate(x) for x in zip(*parts))
        keep = plain[owner[start]]
        start, length, row = start[keep], length[keep], row[keep]
        score, own = self.key_score[row], owner[start]
        begin, end = start + own, start + own + length  # nodes: one more than characters in each chunk
        n_nodes, idx = len(cps) + len(chunks), np.arange(len(start))
        first = np.cumsum(size) - size + np.arange(len(chunks))
        alpha, beta = np.full(n_nodes, -np.inf), np.full(n_nodes, -np.inf)
        alpha[first], beta[first + size] = 0.0, 0.0
        back = np.zeros(n_nodes, np.int64)
        ends = rel[start] + length
        for e in _steps(ends, end, idx):  # forward
            v = alpha[begin[e]] + score[e]
            node = end[e]
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            best = np.maximum.reduceat(v, head)
            alpha[node[head]] = best
            win = np.flatnonzero(v == np.repeat(best, np.diff(np.append(head, len(v)))))
            win = win[np.concatenate([[True], node[win[1:]] != node[win[:-1]]])]
            back[node[win]] = e[win]
        for e in _steps(SIDE - rel[start], begin, idx):  # backward
            v = score[e] + beta[end[e]]
            node = begin[e]
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            beta[node[head]] = np.maximum.reduceat(v, head)
        # best paths, from their ends, and the best of the edges off them
        on = np.zeros(len(start), bool)
        walk, node, steps = np.flatnonzero(plain), (first + size)[plain], []
        while len(walk):
            e = back[node]
            on[e] = True
            steps.append((walk, self.key_id[row[e]]))
            node = begin[e]
            more = node > first[walk]
            walk, node = walk[more], node[more]
        second = np.full(len(chunks), -np.inf)
        np.maximum.at(second, own[~on], (alpha[begin] + score + beta[end])[~on])
        total = alpha[first + size]
        who = np.concatenate([w for w, _ in steps]) if steps else np.zeros(0, np.int64)
        ids = np.concatenate([k for _, k in steps]) if steps else who
        # later steps stand further to the front
        ids = ids[np.lexsort((-np.repeat(np.arange(len(steps)), [len(w) for w, _ in steps]), who))]
        n = np.bincount(who, minlength=len(chunks))
        packed, cut = ids.astype("<i4").tobytes(), (4 * np.concatenate([[0], np.cumsum(n)])).tolist()
        for k in np.flatnonzero(plain).tolist():
            self.known[chunks[k]] = len(self.names)
            self.names.append(chunks[k])
            self.best.append(packed[cut[k]:cut[k + 1]])
        self.score += total[plain].tolist()
        self.loss += (total[plain] - second[plain]).tolist()
        self.n += n[plain].tolist()
        for k in np.flatnonzero(~plain).tolist():
            self.learn(chunks[k])

    def learn(self, chunk: str) -> None:
        """Best path of a chunk and what its second path loses, from forward and backward scores."""
        n, get, low = len(chunk), self.table.get, float("-inf")
        alpha, back = [0.0] + [low] * n, [None] * (n + 1)
        edges: list[tuple[int, int, float]] = []
        for i in range(n):
            here = alpha[i]
            got = get(chunk[i], 0)
            k, s = got or (-1, self.fallback)
            edges.append((i, i + 1, s))
            if here + s > alpha[i + 1]:
                alpha[i + 1], back[i + 1] = here + s, (i, k)
            if got == 0:
                continue
            for j in range(i + 2, n + 1):
                got = get(chunk[i:j], 0)
                if got:
                    k, s = got
                    edges.append((i, j, s))
                    if here + s > alpha[j]:
                        alpha[j], back[j] = here + s, (i, k)
                elif got == 0:
                    break
        path, on, p = [], set(), n
        while p:
            path.append(back[p])
            on.add((back[p][0], p))
            p = back[p][0]
        # an edge off the best path: what the best path through it loses
        beta = [low] * n + [0.0]
        total = most = alpha[n]
        second = low
        for i, j, s in reversed(edges):
            v = s + beta[j]
            if v > beta[i]:
                beta[i] = v
            v += alpha[i]
            if v > second and (v < most or (i, j) not in on):
                second = v
        ids = self.spell(chunk, path[::-1])
        self.known[chunk] = len(self.names)
        self.names.append(chunk)
        self.score.append(total)
        self.loss.append(total - second)
        self.n.append(len(ids) // 4)
        self.best.append(ids)

    def search(self, chunk: str, n_best: int) -> list[tuple[float, bytes]]:
        """The ``n_best`` best (score, packed ids) of a chunk by backward A-star."""
        into = self.edges(chunk)
        alpha = self.forward(into)
        out: list[tuple[float, bytes]] = []
        count = 0
        # (-(forward score + score so far), position, age, score so far, path to the end)
        agenda = [(-alpha[-1], len(chunk), 0, 0.0, None)]
        while agenda and len(out) < n_best:
            cost, p, _, done, path = heapq.heappop(agenda)
            if p == 0:
                steps = []
                while path is not None:
                    steps.append(path[0])
                    path = path[1]
                out.append((-cost, self.spell(chunk, steps)))
                continue
            for i, k, s in into[p]:
                count += 1
                heapq.heappush(agenda, (-(alpha[i] + done + s), i, count, done + s, ((i, k), path)))
        return out

    def alternatives(self, which: int, n_best: int) -> list[tuple[float, bytes]]:
        """Paths of a remembered chunk as (loss, ids), the best first (and first in the list)."""
        got = self.ranked.get(which)
        if got is None or (len(got) < n_best and len(got) > 0 and got[-1][0] != float("inf")):
            found = self.search(self.names[which], n_best)
            rest = [x for x in found if x[1] != self.best[which]]
            got = [(0.0, self.best[which])] + [(self.score[which] - s, b) for s, b in rest][:n_best - 1]
            self.ranked[which] = got
        return got

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of a path, without the blank in front."""
        length = self.length[ids]
        total = int(length.sum())
        at = np.repeat(self.start[ids] - (np.cumsum(length) - length), length) + np.arange(total)
        return self.flat[at].tobytes()[1:]


def _steps(level: np.ndarray, node: np.ndarray, idx: np.ndarray) -> Iterator[np.ndarray]:
    """Edge numbers level by level, each level sorted by node and edge start (ascending)."""
    if not len(idx):
        return
    # edges come by growing length; reversed numbers put the longest, so the earliest start, first
    back = len(idx) - 1 - idx
    packed = np.sort((level << 52) | (node << 26) | back)
    e = len(idx) - 1 - (packed & ((1 << 26) - 1))
    cut = np.flatnonzero(np.diff(packed >> 52)) + 1
    yield from np.split(e, cut)


def combine(paths: list[list[tuple[float, bytes]]], n_best: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n_best`` cheapest choices of one alternative for each chunk, in order of loss."""
    start = (0,) * len(paths)
    agenda, out = [(0.0, start, 0)], []
    while agenda and len(out) < n_best:
        loss, choice, last = heapq.heappop(agenda)
        out.append((loss, choice))
        for p in range(last, len(paths)):
            k = choice[p] + 1
            if k < len(paths[p]):
                heapq.heappush(agenda, (loss - paths[p][choice[p]][0] + paths[p][k][0],
                                        choice[:p] + (k,) + choice[p + 1:], p))
    return out


def cut_chunks(v: Pieces, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Chunks of all texts, and the number of chunks of each."""
    whole = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
    s = "".join(whole)
    if not s:
        return [], np.zeros(len(texts), np.int64)
    kind = v.kind[np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")]
    cut = np.concatenate([[True], ~v.touch[kind[:-1], kind[1:]]])
    size = np.array([len(w) for w in whole], np.int64)
    begin = np.cumsum(size) - size
    cut[begin[size > 0]] = True
    at = np.flatnonzero(cut)
    n = np.searchsorted(at, begin + size) - np.searchsorted(at, begin)
    ends = np.append(at[1:], len(s)).tolist()
    return [s[a:b] for a, b in zip(at.tolist(), ends)], n


def encode_texts(v: Pieces, texts: list[str], n_best: int) -> list[tuple]:
    """(n_pieces, score, ids, others, round_trip) of each text."""
    chunks, counts = cut_chunks(v, texts)
    fresh = set(chunks).difference(v.known)
    if len(v.known) + len(fresh) > REMEMBER:
        v.clear()
        fresh = set(chunks)
    fresh = sorted(fresh)
    side = [c for c in fresh if len(c) <= SIDE]
    for at in range(0, len(side), 1 << 13):
        v.learn_all(side[at: at + (1 << 13)])
    for c in fresh:
        if len(c) > SIDE:
            v.learn(c)
    which = np.fromiter(map(v.known.__getitem__, chunks), np.int64, len(chunks))
    score, loss, n = np.array(v.score), np.array(v.loss), np.array(v.n, np.int64)
    out = []
    at = 0
    for text, many in zip(texts, counts.tolist()):
        w = which[at: at + many]
        at += many
        if not many:
            out.append((0, 0.0, b"", [], True))
            continue
        ids = b"".join(map(v.best.__getitem__, w.tolist()))
        total = float(score[w].sum())
        # chunks that may differ from the best path: the least losses, then the first
        d = loss[w]
        if many > n_best - 1 > 0:
            near = np.flatnonzero(d <= np.partition(d, n_best - 2)[n_best - 2])
        else:
            near = np.arange(many)
        near = near[np.argsort(d[near], kind="stable")][: n_best - 1]
        near = np.sort(near[np.isfinite(d[near])])
        others = []
        if len(near):
            first = np.concatenate([[0], np.cumsum(n[w])])
            paths = [v.alternatives(int(w[p]), n_best) for p in near]
            for miss, choice in combine(paths, n_best)[1:]:
                edits = [{"at": int(first[p]), "old": int(n[w[p]]), "ids": paths[j][k][1]}
                         for j, (p, k) in enumerate(zip(near, choice)) if k]
                others.append({"score": total - miss, "edits": edits})
        back = v.decode(np.frombuffer(ids, "<i4"))
        out.append((len(ids) // 4, total, ids, others, back == text.encode("utf-8", "replace")))
    return out


def splice(ids: bytes, edits: list) -> bytes:
    """Packed ids of another path: the best path with its edits applied."""
    for e in sorted(edits, key=lambda e: -e["at"]):
        ids = ids[: 4 * e["at"]] + bytes(e["ids"]) + ids[4 * (e["at"] + e["old"]):]
    return ids


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary, once for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def sp_encode(df: DataFrame, text_col: str = "text", model: str = MODEL, n_best: int = N_BEST,
              carry: bool = True) -> DataFrame:
    """The input with ``n_pieces, score, ids, others, round_trip``; ``carry=False`` drops the text."""
    new = {f.name for f in RESULT}
    src = df.select(*[f"`{c}`" for c in df.columns if c not in new])
    keep = [c for c in src.columns if carry or c != text_col]
    schema = StructType([*[src.schema[c] for c in keep], *RESULT])
    types = [pa.int32(), pa.float64(), pa.binary(),
             pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct(
                 [("at", pa.int32()), ("old", pa.int32()), ("ids", pa.binary())])))])), pa.bool_()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pieces(model)
        for b in slices(batches, text_col, SLICE):
            rows = encode_texts(v, [t or "" for t in b.column(text_col).to_pylist()], n_best)
            cols = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *cols],
                                             names=[*keep, *[f.name for f in RESULT]])

    return src.mapInArrow(work, schema)


def sp_decode(df: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """The input with ``decoded``: the text of packed ids (null ids: null)."""
    src = df.select(*[f"`{c}`" for c in df.columns if c != "decoded"])
    names = src.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pieces(model)
        for b in slices(batches, ids_col, SLICE):
            texts = [None if i is None else v.decode(np.frombuffer(i, "<i4")).decode("utf-8", "replace")
                     for i in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return src.mapInArrow(work, StructType([*src.schema.fields, StructField("decoded", StringType())]))
