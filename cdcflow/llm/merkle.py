"""Merkle manifest of a dataset: cogrouped subtree exchange.

Every row is a leaf, the hash of its fields.  Per source the leaves, ascending by
id, are the ground of a tree of arity three, and the subroots of the sources are
the ground of one more tree, whose top is the root of the dataset.

1. Leaves get their place in their source (ranges, not a window over a source).
2. 3 ** ``levels`` (2187) consecutive places of a source are a superblock; sources
   smaller than that share bundles.  Each superblock is reduced in a group of its
   own to one node, the nodes are places of the next tier, and so on until every
   source has one node.  A tier has 2187 times fewer rows than the one below.
3. Going down, the nodes of a tier and the outer nodes that their superblock
   needs (its siblings up to the root, a short list) are cogrouped by superblock
   in ``applyInPandas``: the group builds its local levels once more, joins local
   and outer siblings to proofs, and folds the received leaves up to the root.

No task holds more than one superblock, whatever share of the rows a source has.

Nulls: a null field is ``-`` in its leaf; null ids come first in their source and
are never tampered with; the null source is a source, and the first.  Empty
texts have a leaf like any.  Rows that repeat are leaves of their own; rows of
one source and id are ordered by leaf, so the root does not depend on how the
table is stored.  An empty table gives an empty result.  Columns other than the
five hashed ones are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.order import numbered
from cdcflow.llm.store import stage

ARITY = 3
LEVELS = 7  # of a superblock
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """The leaf hash (32 bytes) of a row's fields."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def levels_of(nodes: list[str], exactly: int | None) -> list[list[str]]:
    """All levels above and with ``nodes``: ``exactly`` so many steps, or until one node is left."""
    out = [nodes]
    while len(out[-1]) > 1 if exactly is None else len(out) <= exactly:
        row = out[-1]
        out.append([digest("".join(row[k : k + ARITY])) for k in range(0, len(row), ARITY)])
    return out


def sides(row: list[str], k: int) -> tuple[str, str]:
    """The siblings of node ``k`` in its run, left and right."""
    a = k - k % ARITY
    return "".join(row[a:k]), "".join(row[k + 1 : a + ARITY])


def _units(nodes: pd.DataFrame, levels: int):
    """``(source, superblock, its rows in order, its levels)`` of the rows of a group."""
    block = ARITY**levels
    nodes = nodes.assign(_none=nodes["source"].isna(), _source=nodes["source"].fillna(""), unit=nodes["pos"] // block)
    nodes = nodes.sort_values(["_none", "_source", "pos"], kind="stable")
    for (none, name, unit), rows in nodes.groupby(["_none", "_source", "unit"], sort=False):
        built = levels_of([h.hex() for h in rows["h"]], levels if rows["total"].iloc[0] > block else None)
        yield None if none else name, int(unit), rows, built


def _reduce(nodes: pd.DataFrame, levels: int) -> pd.DataFrame:
    block = ARITY**levels
    out = [(source, unit, -(-int(rows["total"].iloc[0]) // block), int(rows["total"].iloc[0]) <= block, bytes.fromhex(built[-1][0]))
           for source, unit, rows, built in _units(nodes, levels)]
    return pd.DataFrame(out, columns=["source", "pos", "total", "top", "h"])


NODE = "source string, pos long, total long, top boolean, h binary"
#: siblings left and right of a node's way up, level by level, as raw digests
WAY = "source string, unit long, lefts array<binary>, rights array<binary>, subroot binary, root binary"


def _ways(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int, visit):
    """Call ``visit(rows, built, way)`` for every superblock of a group with the outer way of that superblock."""
    ways = {(None if pd.isna(o.source) else o.source, int(o.unit)): o for o in outer.itertuples()}
    for source, unit, rows, built in _units(nodes, levels):
        visit(source, rows, built, ways[source, unit])


def _down(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    """The way up of every node of the group, for the superblock below it."""
    out = []

    def visit(source, rows, built, way):
        for k, pos in enumerate(rows["pos"]):
            at, lefts, rights = k, [], []
            for row in built[:-1]:
                left, right = sides(row, at)
                lefts.append(bytes.fromhex(left))
                rights.append(bytes.fromhex(right))
                at //= ARITY
            subroot = way.subroot if way.subroot is not None else bytes.fromhex(built[-1][0])
            out.append((source, int(pos), lefts + list(way.lefts), rights + list(way.rights), subroot, way.root))

    _ways(nodes, outer, levels, visit)
    return pd.DataFrame(out, columns=["source", "unit", "lefts", "rights", "subroot", "root"])


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _finish(proofs: bool):
    """Proofs of the leaves of a group, and the roots that the received leaves fold to."""

    def each(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
        out = []

        def visit(source, rows, built, way):
            above = [(left.hex(), right.hex()) for left, right in zip(way.lefts, way.rights)]
            tail = "".join(left + right for left, right in above)
            # per level: the sides of every node, and the siblings from there up as one text
            beside = [[sides(row, k) for k in range(len(row))] for row in built[:-1]]
            joined = [tail] * len(built[-1])
            for level in reversed(beside):
                joined = [left + right + joined[k // ARITY] for k, (left, right) in enumerate(level)]
            subroot, root = way.subroot.hex(), way.root.hex()
            for k, (doc, h, got) in enumerate(zip(rows["doc_id"], rows["h"], rows["received"])):
                node, at, way_up = (h if got is None else got).hex(), k, []
                for level in beside:
                    way_up.append(level[at])
                    at //= ARITY
                way_up += above
                for left, right in way_up:
                    node = digest(left + node + right)
                row = (None if pd.isna(doc) else int(doc), h.hex(), subroot, root, digest(joined[k]), node, node == root)
                out.append((*row, [{"left": x, "right": y} for x, y in way_up]) if proofs else row)

        _ways(nodes, outer, levels, visit)
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + (["proof"] if proofs else [])
        made = pd.DataFrame(out, columns=names)
        made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    return each


def _blocks(bundles: int, block: int, unit: Column) -> Column:
    """The group that a superblock is worked in; superblocks of small sources share ``bundles`` groups."""
    alone = F.xxhash64("source", F.coalesce("source", F.lit("")), F.isnull("source"), unit, F.lit(1))
    return F.when(F.col("total") > block, alone).otherwise(F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.isnull("source")), F.lit(bundles)))


def _tiers(ground: DataFrame, levels: int, name: str) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """The tiers of superblocks over ``ground`` (each with its number of bundles), and every source's top node with its tier."""
    block = ARITY**levels
    tiers, tops, nodes = [], [], ground
    while True:
        seen = nodes.agg(F.max("total"), F.sum((F.col("total") <= block).cast("long"))).first()
        bundles = max(1, -(-(seen[1] or 0) // block))
        unit = F.floor(F.col("pos") / block)
        up = stage(nodes.select("source", "pos", "total", "h", _blocks(bundles, block, unit).alias("block")).groupBy("block").applyInPandas(lambda x: _reduce(x, levels), NODE), f"{name}-{len(tiers)}")
        tops.append(up.where("top").select("source", "h", F.lit(len(tiers)).alias("tier")))
        tiers.append((nodes, bundles))
        if (seen[0] or 0) <= block:
            break
        nodes = up.where("NOT top").select("source", "pos", "total", "h")
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return tiers, top


def _descend(tiers: list[tuple[DataFrame, int]], ways: DataFrame, levels: int, name: str, last, schema: str) -> DataFrame:
    """Cogroup every tier, from the top down, with the outer ways of its superblocks; ``last`` finishes the ground.

    ``ways`` has the way of every source's top; a superblock that holds a whole
    source takes it, any other the way of its node in the tier above.
    """
    block, below = ARITY**levels, None
    for k in range(len(tiers) - 1, -1, -1):
        nodes, bundles = tiers[k]
        outer = ways.where(F.col("tier") == k).drop("tier").withColumn("total", F.lit(1).cast("long"))
        if below is not None:
            outer = outer.unionByName(below.withColumn("total", F.lit(block + 1).cast("long")))
        unit = F.floor(F.col("pos") / block)
        a = nodes.withColumn("block", _blocks(bundles, block, unit))
        b = outer.withColumn("block", _blocks(bundles, block, F.col("unit")))
        pair = a.groupBy("block").cogroup(b.groupBy("block"))
        if k == 0:
            return pair.applyInPandas(lambda key, x, y: last(x, y, levels), schema)
        below = stage(pair.applyInPandas(lambda key, x, y: _down(x, y, levels), WAY), f"{name}-ways-{k}")
    raise AssertionError("no tiers")


def manifest(docs: DataFrame, received: Column | None = None, proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of ``docs``.

    ``received`` is the text as it arrived (default: the text itself); its leaf is
    folded with the manifest's siblings and verified against the root.  With
    ``proofs`` a column ``proof`` lists the siblings, left and right, of every level.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                    F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"),
                    (F.lit(None).cast("string") if received is None else received.cast("string")).alias("got"))
    fields = [F.col(c) for c in FIELDS]
    changed = F.lit(None).cast("binary") if received is None else F.when(~F.col("got").eqNullSafe(F.col("text")), leaf([*fields[:-1], F.col("got")]))
    leaves = stage(d.select("doc_id", "source", leaf(fields).alias("h"), changed.alias("received")), "leaves")
    ground = stage(numbered(leaves, ["source"], [F.col("doc_id"), F.col("h")], "leaves"), "ground")
    tiers, tops = _tiers(ground, levels, "subtrees")
    # the subroots are the ground of one more tree, of a single nameless source
    tops = stage(tops, "subroots")
    order = numbered(tops.select(F.lit(None).cast("string").alias("all"), "source", "h", "tier"), ["all"], [F.col("source")], "subroots")
    names = stage(order.select(F.col("source").alias("name"), F.col("all").alias("source"), "pos", "total", "h", "tier"), "subroot-ground")
    upper, root = _tiers(names.select("source", "pos", "total", "h"), levels, "root")
    start = root.select("source", F.lit(0).cast("long").alias("unit"), F.array().cast("array<binary>").alias("lefts"), F.array().cast("array<binary>").alias("rights"),
                        F.lit(None).cast("binary").alias("subroot"), F.col("h").alias("root"), "tier")
    ways = _descend(upper, start, levels, "root", _down, WAY)
    named = names.join(ways.select("unit", "lefts", "rights", "root"), F.col("pos") == F.col("unit")).drop("source", "unit")
    ways = stage(named.select(F.col("name").alias("source"), F.lit(0).cast("long").alias("unit"), "lefts", "rights", F.col("h").alias("subroot"), "root", "tier"), "source-ways")
    schema = RESULT + (", proof array<struct<left: string, right: string>>" if proofs else "")
    return _descend(tiers, ways, levels, "leaves", _finish(proofs), schema)
