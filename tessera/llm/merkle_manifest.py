"""Merkle manifest of a dataset: nested-interval labels.

Rows are leaves of one tree per group (language), in the order of their ids; the groups'
roots, in the order of the groups, are the leaves of one more tree.  A node is labelled by
the interval ``[lo, hi)`` of leaf ranks that it covers; a level's nodes cover ``FAN``
nodes of the level below, the last one what is left.

Going up, a level is one grouping of the level below by ``lo div FAN^level`` (at most
``FAN`` rows a group).  Going down, every node finds its parent by a containment join: the
parent begins where the node's level bucket does, and its interval contains the node's.  The siblings
are the parent's interval less the node's own: children that end before ``lo``, and children
that begin at ``hi`` or later.  A parent hands on the siblings that it has found itself, so a
leaf's proof comes from one join, whatever the height.  Ranks come from equi-depth ranges
(``number_sampled``).  Only built-in expressions are used, and nothing is collected but the
size of the largest tree.

Hash: lowercase hex SHA-256 of the concatenated inputs, digests as hex text.  A leaf hashes
its fields, each ``-`` if null, else UTF-8 byte count, ``:``, value.

Defined results: a null group is a tree of its own and stands first; a null id stands before
all others of its group; rows alike in group and id are ordered by their leaf, and rows alike in
all fields are leaves each; a group of one row has its leaf as root, and one group's root is the
root; a leaf without siblings has the hash of no input as proof; an empty table gives an empty
result.  Columns of the input that are not fields are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch
from tessera.operators.sequence import number_sampled

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(values: list[Column]) -> Column:
    """Hash of a row's fields."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def bucket(lo: Column, level: int, fan: int) -> Column:
    """Where the node of ``level`` begins that covers leaf ``lo``."""
    return lo - F.pmod(lo, F.lit(fan ** level).cast("long"))


def grow(leaves: DataFrame, most: int, fan: int, scratch: Scratch) -> list[DataFrame]:
    """Levels of all trees from (tree, n, lo, hi, hash): level 0 are the leaves; inner nodes hold their children."""
    levels = [leaves]
    while fan ** (len(levels) - 1) < most:
        k = len(levels)
        kid = F.struct("lo", "hi", "hash")
        level = (levels[-1].where(F.col("n") > fan ** (k - 1))
                 .groupBy("tree", "n", bucket(F.col("lo"), k, fan).alias("at"))
                 .agg(F.array_sort(F.collect_list(kid)).alias("kids"))
                 .select("tree", "n", F.col("kids")[0]["lo"].alias("lo"),
                         F.element_at("kids", -1)["hi"].alias("hi"),
                         F.sha2(F.array_join("kids.hash", "").cast("binary"), 256).alias("hash"), "kids"))
        levels.append(scratch.put(level))
    return levels


def tree_roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash) of the node of each tree that covers all its leaves."""
    out = None
    for level in levels:
        top = level.where((F.col("lo") == 0) & (F.col("hi") == F.col("n"))).select("tree", "hash")
        out = top if out is None else out.unionByName(top)
    return out


def proofs(levels: list[DataFrame], roots: DataFrame, fan: int) -> DataFrame:
    """The leaves with ``path`` (siblings left and right, level by level up) and what ``roots`` say of their tree.

    ``roots`` is (tree, path, subroot, root): the path from the tree's root on.
    """
    given = roots.select(F.col("tree").alias("of"), "path", "subroot", "root")
    above = None
    for k in range(len(levels) - 1, -1, -1):
        nodes = levels[k]
        whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
        here = nodes.where(whole).join(given, F.col("tree") == F.col("of")).drop("of")
        if above is not None:
            parents = above.select(F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                                   F.col("kids").alias("p_kids"), F.col("path").alias("p_path"), "subroot", "root")
            inside = ((F.col("tree") == F.col("p_tree")) & (bucket(F.col("lo"), k + 1, fan) == F.col("p_lo"))
                      & (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi")))
            lo, hi = F.col("lo"), F.col("hi")
            left = F.array_join(F.transform(F.filter("p_kids", lambda c: c["hi"] <= lo), lambda c: c["hash"]), "")
            right = F.array_join(F.transform(F.filter("p_kids", lambda c: c["lo"] >= hi), lambda c: c["hash"]), "")
            step = F.struct(left.alias("left"), right.alias("right"))
            # a merge join at every size for the two lowest levels, which grow with the input
            lower = parents.hint("merge") if k < 2 else parents
            nested = nodes.where(~whole).join(lower, inside).select(
                *nodes.columns, F.concat(F.array(step), F.col("p_path")).alias("path"), "subroot", "root")
            here = here.unionByName(nested)
        above = here
    return above


def merkle_manifest(df: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
                    seen: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """(id, group, rank, leaf, subroot, root, path, proof_sha256, folded_root, verified) of every row.

    ``path`` holds the siblings to the left and to the right at each level from the leaf up.
    ``seen`` replaces fields by what a reader found in their place: the leaf of those values is
    folded with the stored siblings, and the row is verified if that gives the root.
    """
    scratch = Scratch(df.sparkSession, "merkle")
    cols = {f: F.col(f"`{f}`") for f in fields}
    leaf = digest(list(cols.values()))
    found = digest([(seen or {}).get(f, c) for f, c in cols.items()]) if seen else leaf
    group = F.col(f"`{group_col}`").cast("string")
    # a text key that keeps the order of the groups, null first
    tree = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group))
    rows = scratch.put(df.select(F.col(f"`{id_col}`").alias("id"), group.alias("group"), tree.alias("tree"),
                                 leaf.alias("hash"), found.alias("found")))
    ranked = number_sampled(rows, ["id", "hash"], ["tree"], name="rank", total="n")
    leaves = scratch.put(ranked.select("id", "group", "tree", "n", (F.col("rank") - 1).alias("lo"),
                                       F.col("rank").alias("hi"), "hash", "found"))
    scratch.drop(rows)
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = grow(leaves, most, fan, scratch)
    # the trees' roots are the leaves of the upper tree
    subroots = scratch.put(tree_roots(levels))
    upper = scratch.put(number_sampled(subroots, ["tree"], name="rank", total="n").select(
        F.lit("").alias("tree"), "n", (F.col("rank") - 1).alias("lo"), F.col("rank").alias("hi"), "hash",
        F.col("tree").alias("name")))
    trees = upper.agg(F.max("n")).first()[0] or 0
    upper_levels = grow(upper, trees, fan, scratch)
    top = tree_roots(upper_levels).select("tree", F.array().cast(PATH).alias("path"), F.col("hash").alias("subroot"),
                                          F.col("hash").alias("root"))
    roots = scratch.put(proofs(upper_levels, top, fan).select(
        F.col("name").alias("tree"), "path", F.col("hash").alias("subroot"), "root"))
    out = proofs(levels, roots, fan)
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
    folded = F.aggregate("path", F.col("found"), lambda acc, s: F.sha2(
        F.concat(s["left"], acc, s["right"]).cast("binary"), 256))
    return out.select(
        F.col("id").alias(id_col), F.col("group").alias(group_col), F.col("lo").alias("rank"), F.col("hash").alias("leaf"),
        "subroot", "root", "path", proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
            "verified", F.col("folded_root") == F.col("root"))
