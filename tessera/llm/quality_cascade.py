"""Quality rules as a short-circuit cascade.

Every text gets its base counts (words, characters, symbols, repeated lines, words in
repeated three-word windows).  Texts that pass the base test run through ``RULES``: a
rule sees only the texts that no rule before it rejected.  The order is chosen first:
on a bounded sample (``SAMPLE`` rows by hash of the id) each rule is run alone, its cost
per byte and its share of rejections are measured, and the rules are sorted by
rejections per cost.  The verdict is the conjunction of all rules, so it is the same in
any order; only the work differs.

Defined results: a null or empty text has no words and fails the base test; texts alike
get results alike; an empty table gives an empty result (rules keep their given order);
other columns pass through (those named like the results are replaced).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tessera.llm.common import (IS_SPACE, U64, counts_by_row, mix, prefix_code, raw_bytes, slices, span_code,
                                windows, word_spans)

SAMPLE, SLICE = 512, 1 << 19
LEAST_WORDS, REPEAT_PERCENT = 50, 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_UPPER = np.zeros(256, bool)
IS_UPPER[65:91] = True
IS_LETTER = IS_UPPER.copy()
IS_LETTER[97:123] = True
HAS_LETTER = IS_LETTER.copy()
HAS_LETTER[128:] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[list(b"!?.,;:")] = True
BEGINS_CHAR = np.ones(256, bool)
BEGINS_CHAR[128:192] = False


class Texts:
    """Some texts as bytes, with what the rules need of them (computed when asked for)."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self.n = buf, off, len(off) - 1
        self._words = self._lines = None

    def take(self, rows: np.ndarray) -> Texts:
        size = self.off[rows + 1] - self.off[rows]
        off = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.off[rows] - off[:-1], size) + np.arange(off[-1])
        return Texts(self.buf[at], off)

    def words(self):
        if self._words is None:
            self._words = word_spans(self.buf, self.off)
        return self._words

    def lines(self):
        """Start, end and row of each line with a word."""
        if self._lines is None:
            brk = np.flatnonzero(self.buf == 0x0A)
            start = np.unique(np.concatenate([self.off[:-1], brk + 1]))
            start = start[start < len(self.buf)]
            row = np.searchsorted(self.off, start, side="right") - 1
            next_break = np.append(brk, len(self.buf))[np.searchsorted(brk, start)]
            end = np.minimum(next_break, self.off[row + 1])
            inked = np.concatenate([[0], np.cumsum(~IS_SPACE[self.buf])])
            ok = inked[end] > inked[start]
            self._lines = start[ok], end[ok], row[ok]
        return self._lines

    def per_row(self, flag: np.ndarray) -> np.ndarray:
        """Number of flagged bytes of each text."""
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[self.off[1:]] - total[self.off[:-1]]


def repeats(code: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    if len(code) < 2:
        return np.zeros(len(code), bool)
    s = np.sort(code)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(code), bool)
    at = np.minimum(np.searchsorted(twice, code), len(twice) - 1)
    return twice[at] == code


def base_counts(t: Texts) -> dict[str, np.ndarray]:
    start, end, row = t.words()
    sums = prefix_code(t.buf)
    ls, le, lrow = t.lines()
    line = mix(span_code(sums, ls, le) + mix(lrow.astype(U64)))
    distinct = np.unique(line, return_index=True)[1]
    h, at = windows(span_code(sums, start, end), row, 3)
    again = at[repeats(mix(h + mix(row[at].astype(U64))))]
    covered = np.zeros(len(row) + 2, bool)
    for k in range(3):
        covered[again + k] = True
    return {
        "n_words": counts_by_row(row, t.n),
        "word_chars": t.per_row(BEGINS_CHAR[t.buf] & ~IS_SPACE[t.buf]),
        "n_symbols": t.per_row(IS_SYMBOL[t.buf]),
        "n_dup_lines": counts_by_row(lrow, t.n) - counts_by_row(lrow[distinct], t.n),
        "n_repeat_words": counts_by_row(row[covered[:len(row)]], t.n),
    }


def base_failed(b: dict[str, np.ndarray]) -> np.ndarray:
    return (b["n_words"] < LEAST_WORDS) | (100 * b["n_repeat_words"] > REPEAT_PERCENT * b["n_words"])


# -------------------------------------------------------------------- the rules

def _symbols(t: Texts, b: dict) -> np.ndarray:
    return 10 * b["n_symbols"] > b["n_words"]


def _word_length(t: Texts, b: dict) -> np.ndarray:
    return (b["word_chars"] < 3 * b["n_words"]) | (b["word_chars"] > 10 * b["n_words"])


def _same_lines(t: Texts, b: dict) -> np.ndarray:
    return 2 * b["n_dup_lines"] > counts_by_row(t.lines()[2], t.n)


def _letters(t: Texts, b: dict) -> np.ndarray:
    start, end, row = t.words()
    seen = np.concatenate([[0], np.cumsum(HAS_LETTER[t.buf])])
    return 10 * counts_by_row(row[seen[end] > seen[start]], t.n) < 8 * b["n_words"]


def _capitals(t: Texts, b: dict) -> np.ndarray:
    return 2 * t.per_row(IS_UPPER[t.buf]) > t.per_row(IS_LETTER[t.buf])


def _stops(t: Texts, b: dict) -> np.ndarray:
    start, end, row = t.words()
    two = (end - start >= 2) & IS_STOP[t.buf[end - 1]] & IS_STOP[t.buf[np.maximum(end - 2, 0)]]
    return 10 * counts_by_row(row[two], t.n) > 3 * b["n_words"]


def _bullets(t: Texts, b: dict) -> np.ndarray:
    start, _, row = t.lines()
    ws, _, _ = t.words()
    first = ws[np.searchsorted(ws, start)] if len(start) else start
    dot = (t.buf[first] == 0x2D) | (t.buf[first] == 0x2A)
    for k, v in enumerate((0xE2, 0x80, 0xA2)):
        hit = t.buf[np.minimum(first + k, len(t.buf) - 1)] == v if len(first) else first.astype(bool)
        full = hit if k == 0 else full & hit
    return 10 * counts_by_row(row[dot | full], t.n) > 9 * counts_by_row(row, t.n)


def _ellipses(t: Texts, b: dict) -> np.ndarray:
    start, _, row = t.lines()
    _, we, _ = t.words()
    # the last word of a line is the one before the first word of the next
    upto = np.searchsorted(we, t.lines()[1], side="right") - 1
    last = we[upto] if len(start) else start
    at = lambda k: t.buf[np.maximum(last - k, 0)]
    room = last - start >= 3
    dots = room & (((at(1) == 0x2E) & (at(2) == 0x2E) & (at(3) == 0x2E))
                   | ((at(3) == 0xE2) & (at(2) == 0x80) & (at(1) == 0xA6)))
    return 10 * counts_by_row(row[dots], t.n) > 3 * counts_by_row(row, t.n)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts, dict[str, np.ndarray]], np.ndarray]


RULES = (
    Rule("symbols", _symbols),  # a symbol for ten words or more
    Rule("word_length", _word_length),  # mean word length outside 3 to 10
    Rule("same_lines", _same_lines),  # over half of the lines repeat one before
    Rule("letters", _letters),  # under 80 % of the words have a letter
    Rule("capitals", _capitals),  # over half of the ASCII letters are capitals
    Rule("stops", _stops),  # over 30 % of the words end in two stops
    Rule("bullets", _bullets),  # over 90 % of the lines begin with a bullet
    Rule("ellipses", _ellipses),  # over 30 % of the lines end in an ellipsis
)


def cascade(t: Texts, b: dict[str, np.ndarray], rules: tuple[Rule, ...]) -> np.ndarray:
    """Texts that pass the base test and every rule; each rule sees the survivors only."""
    ids = np.flatnonzero(~base_failed(b))
    if len(ids) < t.n:
        t, b = t.take(ids), {k: v[ids] for k, v in b.items()}
    for r in rules:
        if not len(ids):
            break
        stay = np.flatnonzero(~r.rejects(t, b))
        if len(stay) < len(ids):
            ids, t, b = ids[stay], t.take(stay), {k: v[stay] for k, v in b.items()}
    return ids


def order_rules(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE,
                rules: tuple[Rule, ...] = RULES) -> list[tuple[Rule, float, float]]:
    """Rules by rejections per cost on a sample: (rule, seconds a byte, share rejected)."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            t = Texts(*raw_bytes(b.column("text")))
            counts = base_counts(t)
            alive = np.flatnonzero(~base_failed(counts))
            if not len(alive):
                continue
            t, counts = t.take(alive), {k: v[alive] for k, v in counts.items()}
            cost, gone = [], []
            for r in rules:
                fresh = Texts(t.buf, t.off)
                began = time.perf_counter()
                gone.append(int(r.rejects(fresh, counts).sum()))
                cost.append(time.perf_counter() - began)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(rules)), pa.int32()), pa.array(cost), pa.array(gone, pa.int64()),
                 pa.array([len(alive)] * len(rules), pa.int64()), pa.array([len(t.buf)] * len(rules), pa.int64())],
                names=["rule", "cost", "gone", "rows", "bytes"])

    # a cut that some 2 * sample + 100 rows pass keeps the rest in its tasks
    share = min(1.0, (2.0 * sample + 100) / max(df.count(), 1))
    few = (df.select(F.col(f"`{text_col}`").alias("text"),
                     (F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 40)) / float(1 << 40)).alias("h"))
           .where(F.col("h") <= share).orderBy("h").limit(sample).select("text"))
    got = (few.mapInArrow(measure, "rule int, cost double, gone long, rows long, bytes long").groupBy("rule")
           .agg(F.sum("cost").alias("cost"), F.sum("gone").alias("gone"), F.sum("rows").alias("rows"),
                F.sum("bytes").alias("bytes")).collect())  # one row per rule
    stats = {r.rule: (r.cost / max(r.bytes, 1), r.gone / max(r.rows, 1)) for r in got}
    out = [(r, *stats.get(i, (1.0, 0.0))) for i, r in enumerate(rules)]
    return sorted(out, key=lambda x: -(x[2] + 1e-9) / (x[1] + 1e-15))


def quality_cascade(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE,
                    rules: tuple[Rule, ...] = RULES, carry: bool = True) -> DataFrame:
    """The input with the base counts, ``base_failed`` and ``kept``; ``carry=False`` drops the text."""
    ranked = tuple(r for r, _, _ in order_rules(df, text_col, id_col, sample, rules))
    new = [*BASE, "base_failed", "kept"]
    src = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new])
    keep = [c for c in src.columns if carry or c != text_col]
    schema = StructType([*[src.schema[c] for c in keep], *[StructField(c, LongType()) for c in BASE],
                         StructField("base_failed", BooleanType()), StructField("kept", BooleanType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, SLICE):
            t = Texts(*raw_bytes(b.column(text_col)))
            counts = base_counts(t)
            kept = np.zeros(t.n, bool)
            kept[cascade(t, counts, ranked)] = True
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], *[pa.array(counts[c].astype(np.int64)) for c in BASE],
                 pa.array(base_failed(counts)), pa.array(kept)], names=[*keep, *new])

    return src.mapInArrow(work, schema)
