"""Merkle manifest against trees built in plain Python."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm.merkle_manifest import FIELDS, merkle_manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    texts = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return digest(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def levels_of(hashes, fan):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def siblings(levels, i, fan):
    out = []
    for level in levels[:-1]:
        b = i // fan * fan
        out.append((level[b:i], level[i + 1:b + fan]))
        i //= fan
    return out


def brute(rows, seen, fan):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {g: levels_of([leaf_of(r) for r in groups[g]], fan) for g in names}
    top = levels_of([trees[g][-1][0] for g in names], fan)
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            steps = siblings(trees[g], i, fan) + siblings(top, k, fan)
            fold = leaf_of(seen(r))
            for left, right in steps:
                fold = digest(*left, fold, *right)
            proof = digest(*[h for left, right in steps for h in left + right])
            out.append((r["doc_id"], trees[g][0][i], trees[g][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=repr)


COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n,fan", [(1, 8), (8, 8), (9, 8), (65, 8), (30, 2), (82, 3)])
def test_tree_sizes(spark, n, fan):
    rows = [{"doc_id": i * 7 % 101, "source": "s", "lang": "en", "n_chars": i, "text": f"Text {i}"} for i in range(n)]
    df = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    out = merkle_manifest(df, fan=fan)
    assert got(out) == brute(rows, lambda r: r, fan)
    assert out.where("not verified").count() == 0


def test_groups_and_altered_fields(spark):
    rows = [{"doc_id": i, "source": None if i % 5 == 0 else f"s{i % 3}", "lang": [None, "", "de", "é", "z", "en"][i * i % 6],
             "n_chars": None if i % 4 == 0 else i, "text": None if i % 11 == 0 else f"Ünï CODE {i}"} for i in range(90)]
    df = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string")
    altered = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    out = merkle_manifest(df, seen={"text": altered}, fan=4)

    def seen(r):
        return {**r, "text": r["text"] + "!"} if r["doc_id"] % 2 == 0 and r["text"] is not None else r

    assert got(out) == brute(rows, seen, 4)
    assert {r.doc_id for r in out.where("verified").collect()} == {
        r["doc_id"] for r in rows if r["doc_id"] % 2 or r["text"] is None}


def test_odd_rows(odd, clash, no_docs):
    rows = [r.asDict() for r in odd.collect()]
    assert got(merkle_manifest(odd)) == brute(rows, lambda r: r, 8)
    assert got(merkle_manifest(clash.withColumn("rank", F.lit(1)).withColumn("tree", F.lit("x")))) == brute(
        rows, lambda r: r, 8)
    assert merkle_manifest(no_docs).collect() == []


def test_path_is_log_sized(spark):
    """Siblings of every level, at most seven a level; the intervals of a level share no leaf."""
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"),
                                 F.col("id").alias("n_chars"), F.col("id").cast("string").alias("text"))
    rows = merkle_manifest(df).collect()
    assert sorted(r["rank"] for r in rows) == list(range(600))
    assert {len(r["path"]) for r in rows} == {4}
    assert max(len(s["left"] + s["right"]) for r in rows for s in r["path"]) == 7 * 64
