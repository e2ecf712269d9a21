"""Exact dedup, similarity join and repeated substrings against brute force."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import tessera.llm.radix_dedup as R
from tessera.llm import suffix_dedup as S
from tessera.llm.bayes_join import bayes_join, least_matches
from tessera.llm.common import Scratch, components, documents
from tessera.llm.radix_dedup import radix_dedup

LONG = " ".join(f"word{i % 97} sea{i}" for i in range(400))

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_radix_odd_rows(odd):
    rows = [r.asDict() for r in radix_dedup(odd, first_width=4, growth=2).collect()]
    assert len(rows) == odd.count()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append(r)
    for g in groups.values():
        assert {r["group_size"] for r in g} == {len(g)} and sum(r["kept"] for r in g) == 1
        best = min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        assert {r["keep_id"] for r in g} == {best["doc_id"]}


def test_radix_hot_group_and_columns(spark, clash):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 400))
                                   .otherwise(F.concat(F.lit("copy " * 100), "id")).alias("text"))
    out = radix_dedup(hot, first_width=8, growth=4).groupBy("group_size").agg(F.sum(F.col("kept").cast("int"))).collect()
    assert sorted(map(tuple, out)) == [(1, 2000), (1000, 1)]
    assert set(clash.columns) == set(radix_dedup(clash).columns)


def test_radix_hot_groups_in_cells(odd, spark, monkeypatch):
    """Small cells: groups of each level and the classes at the end are dealt; the result stays."""
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 40))
                                    .otherwise(F.concat(F.lit("copy " * 20), F.col("id") % 400)).alias("text"))
    rows = rows.unionByName(rows.where("doc_id < 500").withColumn("doc_id", F.lit(None).cast("long")))
    rows = rows.unionByName(odd.select("doc_id", "text"))
    want = sorted(map(str, radix_dedup(rows, first_width=8, growth=4).collect()))
    monkeypatch.setattr(R, "CELL", 3)
    groups = Scratch(spark, "cells").put(spark.createDataFrame([(0, 1000), (1, 40), (2, 2)], "g long, n long"))
    left, right = R.dealt(spark.range(0, 1042, 1, 4).selectExpr("id", "if(id < 1000, 0L, if(id < 1040, 1L, 2L)) AS g"), groups, ["g"], "n")
    assert {r.g: r["count"] for r in right.groupBy("g").count().collect()} == {0: 334, 1: 14, 2: 1}
    met = left.join(right, ["g", "cell"])
    assert met.count() == 1042 and met.groupBy("g", "cell").count().agg(F.max("count")).first()[0] < 30
    assert sorted(map(str, radix_dedup(rows, first_width=8, growth=4).collect())) == want


def test_radix_empty(no_docs):
    assert radix_dedup(no_docs).collect() == []


def shingles(text):
    w = WORD.findall(text or "")
    k = min(5, len(w))
    return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()


def brute_links(docs):
    sets = {i: shingles(t) for i, t in docs}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    both = collections.Counter((a, b) for ids in where.values() for n, a in enumerate(ids) for b in ids[n + 1:])
    links, root = collections.Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in both.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in sets}


def test_join_brute_force(spark, sf):
    docs = documents(spark, sf)
    want = brute_links([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.links, r.class_id) for r in bayes_join(docs).collect()}
    assert got == want and any(n for n, _ in got.values())


def test_join_near_group_in_cells(spark, monkeypatch):
    """A group larger than bucket and verification cells loses no link."""
    from tessera.llm import bayes_join as J
    words = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(150):
        w = list(words)
        w[i % 120] = f"x{i}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(f"q{i}_{j}" for j in range(60))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(J, "BUCKET", 60)
    monkeypatch.setattr(J, "CELL", 64)
    got = {r.doc_id: (r.links, r.class_id) for r in bayes_join(df).collect()}
    assert got == brute_links(docs)


def test_join_odd_rows(odd, no_docs):
    rows = bayes_join(odd).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [r.links for r in by[1] + by[2] + by[3]] == [0, 0, 0] and all(r.kept for r in by[1] + by[2] + by[3])
    assert [r.links for r in by[5]] == [3, 3] and sum(r.kept for r in by[5]) == 1
    assert by[6][0].class_id == 5 and not by[6][0].kept
    assert by[9][0].class_id == 4 and by[4][0].kept
    assert bayes_join(no_docs).collect() == []


def test_pruning_keeps_pairs_at_the_threshold():
    from math import comb
    for n, m in zip(range(16, 97, 16), least_matches()):
        lost = sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m))
        assert 0 < m < n and lost < 1e-5


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(200, 100), (300, 200), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df, Scratch(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100}


def brute_cut(docs):
    count = collections.Counter(b[i:i + 200] for _, b in docs for i in range(len(b) - 199))
    out = []
    for d, b in docs:
        keep = bytearray(b"\1" * len(b))
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                keep[i:i + 200] = bytes(200)
        rest = bytes(x for x, k in zip(b, keep) if k)
        spans = len([x for x in bytes(keep).split(b"\1") if x])
        out.append((d, len(b), len(b) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def cut(df):
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[c] for c in cols) for r in S.suffix_dedup(df, carry=False).collect()), key=repr)


def test_substrings_brute_force(spark, sf):
    docs = documents(spark, sf)
    assert cut(docs) == brute_cut([(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()])


def test_substrings_split_keys(spark, monkeypatch):
    """A passage in many texts, in periodic and random surroundings, with keys split over blocks."""
    import random
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(420))
    docs = [(i, "".join(rnd.choice("ijkl ") for _ in range(rnd.randint(0, 260))) + passage
             + "".join(rnd.choice("mnop ") for _ in range(rnd.randint(0, 260)))) for i in range(60)]
    docs += [(100, "ab" * 300), (101, "é" * 150), (102, "xyz" * 66), (103, "xyz" * 67), (104, passage[:199])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_cut([(d, t.encode()) for d, t in docs])
    monkeypatch.setattr(S, "HOT", 4000)
    assert cut(df) == want


def test_substrings_periodic_runs_of_megabytes(spark):
    """Runs longer than a block, and several of one key, next to bytes that stay."""
    docs = [(1, "head" + "-" * 3_000_000 + "tail"), (2, "start" + "a phrase, " * 250_000 + "stop"),
            (3, "only" + "xyz" * 67), (4, "begin" + "-" * 1_500_000 + "end"), (5, None)]
    got = {r.doc_id: r for r in S.suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {d: (r.n_removed, r.n_spans, bytes(r.kept)) for d, r in got.items()} == {
        1: (3_000_000, 1, b"headtail"), 2: (2_500_000, 1, b"startstop"), 3: (0, 0, b"only" + b"xyz" * 67),
        4: (1_500_000, 1, b"beginend"), 5: (0, 0, b"")}


def test_repeated_rows_lend_their_text_once(spark, monkeypatch):
    rows = [(1, LONG)] * 40 + [(None, LONG + " and")] * 40 + [(2, LONG + " end"), (3, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}
    mapped, put = type(df).mapInArrow, Scratch.put

    def spy(self, func, *args, **more):
        if func.__name__ == "_extract_rows":
            seen["suffix"] = self.count()
        return mapped(self, func, *args, **more)

    def spy_put(self, frame):
        out = put(self, frame)
        if {"rid", "text"} <= set(out.columns):
            seen["join"] = out.count()
        return out

    monkeypatch.setattr(type(df), "mapInArrow", spy)
    monkeypatch.setattr(Scratch, "put", spy_put)
    got = S.suffix_dedup(df, carry=False).collect()
    assert len(got) == 82 and seen["suffix"] <= 3
    assert all(r.n_removed >= len(LONG) - 1 for r in got if r.doc_id != 3)
    got = bayes_join(df).collect()
    assert len(got) == 82 and seen["join"] == 3
    assert {r.links for r in got} == {80, 0} and sum(r.kept for r in got) == 2


def test_long_segments_are_cut():
    """Each window in one part, all parts of the key, none over the limit."""
    buf = np.frombuffer(b"ab" * 10_000, np.uint8)
    row, lo, hi, key, weight = S.segments(S.prefix_code(buf), np.array([0, len(buf)]))
    order = np.argsort(lo)
    assert len(set(key)) == 1 and (hi - lo).max() < S.PART and len(lo) > 1
    assert lo[order][0] == 0 and hi[order][-1] == len(buf) - S.WIN and (lo[order][1:] == hi[order][:-1] + 1).all()


def test_large_cells_are_cut(monkeypatch):
    """A cell over a block is cut if its key is split, and no segment is lost or given twice."""
    monkeypatch.setattr(S, "BLOCK", 1000)
    cells = [1] * 9 + [2] * 2 + [3] * 5 + [3] * 1
    t = pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int64()), "sid": pa.array([*range(16), 15], pa.int64()),
                                    "nb": pa.array([2] * 9 + [1] * 2 + [2] * 6, pa.int32()),
                                    "data": pa.array([b"x" * 300] * 17, pa.binary())})
    got = list(S._pieces(S._once(iter([t]))))
    assert sorted(x for p in got for x in p.column("sid").to_pylist()) == list(range(16))
    assert max(p.num_rows for p in got) == 3


def test_substrings_odd_rows(odd, no_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    assert cut(odd) == brute_cut(rows)
    assert cut(no_docs) == []
    full = {r.doc_id: r for r in S.suffix_dedup(odd).collect()}
    assert bytes(full[7].kept) == b"one" and bytes(full[4].kept) == b"" and bytes(full[9].kept) == b" end"
