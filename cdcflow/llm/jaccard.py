"""N-gram Jaccard self-join with count-vector R-trees.

Every text is a set of five-word shingles (64-bit hashes); texts with the same
set are one class.  A class is also a point: its shingles hashed into groups (a
power of two, about a quarter of its size) and counted; halves of a point add up
to a coarser one, so points of different sizes compare.  Two sets overlap by at most the sum of the coordinate
minima of their points, and a box of an R-tree by at most the sum of minima with
the box's upper corner, so whole boxes are ruled out by the threshold.

1. ``points``: size, class key and group counts of each text; heavy shingles
   (a bounded list) for a rare-first order.
2. ``routes``: a linked pair shares ``MEET`` of each side's leading shingles (the
   first ``n - ceil(3n/4) + MEET`` in that order), so leading shingles are dealt by
   hash and meet.  A small meeting gives its pairs of fitting sizes; those of
   ``MEET`` meetings, all others share too little, are kept if bound and sizes allow.
   A middling one is an R-tree over its points that gives the components
   of such pairs; a large one gives a star.  Never all pairs.
3. Components of those candidate links are the parts to index.  A part is cut
   into tiles of at most ``TILE`` classes; each tile (with a few shared hubs of
   the part) is one R-tree, its surviving pairs verified on the whole sets.
   Then its classes are cut into tiles by the components found so far, and
   tiles that aren't of one component are joined pairwise.
4. Verified links give the final components.

Exact but for 64-bit shingle hash collisions.  Null or blank texts have no
shingles and stand alone.  Repeated rows are members of one class.  Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.graph import components
from cdcflow.llm.store import carried, housed, stage
from cdcflow.llm.words import Words, chunks, mix

FEWEST, MOST = 64, 1 << 16  # coordinates of a point
TILE = 96            # classes in one R-tree
LEAF = 8             # points in an R-tree leaf
HUBS = 8             # classes of a part that every tile sees
HEAVY = 1 << 17      # most frequent shingles that are moved behind all others
SMALL = 16           # a meeting up to this size gives its pairs
MEET = 3             # leading shingles that linked classes share (their sets differ, so they share three at least)
STEPS = 15           # of the logarithm of a size, that travels with a class
APART = 5            # steps that sizes of linked classes can be apart, at most (STEPS * log(4 / 3), rounded up)
MIDDLE = 256         # one up to this size is an R-tree, a larger one a star
FLUSH = 1 << 20      # routed shingles a task holds


def needed(n, num: int = 75, den: int = 100):
    """Least overlap of a set of ``n`` with any linked partner."""
    return (num * n + den - 1) // den


def linked(inter, a, b, num: int = 75, den: int = 100):
    """``den * intersection >= num * union``."""
    return den * inter >= num * (a + b - inter)


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingles)`` of every text of a batch."""
    for a, b, data, offsets in chunks(column):
        sh, first = Words(data, offsets).shingles()
        for d in range(b - a):
            s = np.sort(sh[first[d] : first[d + 1]])
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
            yield a + d, s


def group_counts(s: np.ndarray) -> np.ndarray:
    """The point of a set: its shingles per group."""
    groups = min(MOST, max(FEWEST, 1 << (len(s) // 4).bit_length()))
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def pack_counts(c: np.ndarray) -> bytes:
    """Bytes of a point, led by the size of its numbers."""
    top = c.max()
    kind = 1 if top < 256 else 2 if top < 65536 else 4
    return bytes([kind]) + c.astype(f"<u{kind}").tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def folded(c: np.ndarray, groups: int) -> np.ndarray:
    """A point with fewer groups."""
    return c if len(c) == groups else c.reshape(-1, groups).sum(0)


def count_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Most shingles that sets with these points can share."""
    groups = min(len(a), len(b))
    return int(np.minimum(folded(a, groups), folded(b, groups)).sum())


def class_key(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


POINT_SCHEMA = "doc_id long, n long, key long, counts binary, token long, uses long"


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("counts", pa.binary()),
                        ("token", pa.int64()), ("uses", pa.int64())])
    for batch in batches:
        ids = batch.column(0).to_pylist()
        n, keys, counts, seen, held = [], [], [], [], 0
        tokens, uses = [], []

        def heavy(docs):
            t, c = np.unique(np.concatenate(seen), return_counts=True)
            keep = c >= max(4, docs // 512)
            tokens.append(t[keep])
            uses.append(c[keep])

        for _, s in _sets(batch.column(1)):
            n.append(len(s))
            keys.append(class_key(s) if len(s) else None)
            counts.append(pack_counts(group_counts(s)) if len(s) else None)
            seen.append(s)
            held += len(s)
            if held >= FLUSH:
                heavy(len(seen))
                seen, held = [], 0
        if held:
            heavy(len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(counts, pa.binary()),
                                          pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64())], schema=schema)
        if tokens:
            t, c = np.concatenate(tokens), np.concatenate(uses)
            void = pa.nulls(len(t), pa.int64())
            yield pa.RecordBatch.from_arrays([void, void, void, pa.nulls(len(t), pa.binary()), pa.array(t.view(np.int64)), pa.array(c)], schema=schema)


def size_step(n: int) -> int:
    return min(255, int(STEPS * math.log(n)))


def _leading(s: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first ``n - ceil(3n/4) + MEET`` shingles: light ones by hash, then heavy ones by use."""
    p = len(s) - needed(len(s)) + MEET
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
        hot = heavy[at] == s
        light = s[~hot]
        if len(light) < p:
            tail = s[hot][np.argsort(rank[at[hot]], kind="stable")]
            return np.concatenate([light, tail])[:p]
        return light[:p]
    return s[:p]


def _router(heavy: np.ndarray, rank: np.ndarray, buckets: int):
    shift = np.uint64(64 - (buckets - 1).bit_length())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        tok, own, step, held = [], [], [], 0

        def flush():
            t = np.concatenate(tok)
            o = np.repeat(np.array(own, np.int64), [len(x) for x in tok])
            z = np.repeat(np.array(step, np.uint8), [len(x) for x in tok])
            at = np.argsort(t, kind="stable")
            t, o, z = t[at], o[at], z[at]
            to = (mix(t) >> shift).astype(np.int64)
            at = np.argsort(to, kind="stable")
            t, o, z, to = t[at], o[at], z[at], to[at]
            cut = np.flatnonzero(np.diff(to)) + 1
            edges = [0, *cut.tolist(), len(to)]
            return pa.RecordBatch.from_arrays([
                pa.array(to[edges[:-1]], pa.int64()),
                pa.array([t[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary()),
                pa.array([o[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary()),
                pa.array([z[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary())], names=["bucket", "tokens", "keys", "steps"])

        for batch in batches:
            for _, s in _sets(batch.column(0)):
                if not len(s) or (key := class_key(s)) in known:
                    continue
                if len(known) < FLUSH:
                    known.add(key)
                lead = _leading(s, heavy, rank)
                tok.append(lead)
                own.append(key)
                step.append(size_step(len(s)))
                held += len(lead)
                if held >= FLUSH:
                    yield flush()
                    tok, own, step, held = [], [], [], 0
        if held:
            yield flush()

    return route


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate links of the shingles of one partition: pairs of small meetings with the number of
    those that hold both (``uses``), stars of large ones."""
    toks, owns, steps = [], [], []
    for batch in batches:
        for t, o, z in zip(batch.column(1), batch.column(2), batch.column(3)):
            toks.append(np.frombuffer(t.as_buffer(), np.uint64).copy())
            owns.append(np.frombuffer(o.as_buffer(), np.int64).copy())
            steps.append(np.frombuffer(z.as_buffer(), np.uint8).copy())
    if not toks:
        return
    t, o, z = np.concatenate(toks), np.concatenate(owns), np.concatenate(steps)
    del toks, owns, steps
    at = np.argsort(t, kind="stable")
    t, o, z = t[at], o[at], z[at]
    same = np.zeros(len(t), bool)
    same[1:] = t[1:] == t[:-1]
    keep = same.copy()
    keep[:-1] |= same[1:]
    t, o, z = t[keep], o[keep], z[keep]
    at = np.lexsort((o, t))
    t, o, z = t[at], o[at], z[at].astype(np.int16)
    if not len(t):
        return
    fresh = np.concatenate([[True], (t[1:] != t[:-1]) | (o[1:] != o[:-1])])
    t, o, z = t[fresh], o[fresh], z[fresh]
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    size = np.diff(np.concatenate([first, [len(t)]]))
    # meetings of the same members are one
    sums = np.add.reduceat(mix(o.view(np.uint64)), first)
    _, once, uses = np.unique(np.stack([sums, size.astype(np.uint64)], 1), axis=0, return_index=True, return_counts=True)
    kept = np.zeros(len(first), np.int64)
    kept[once] = uses
    every = np.repeat(size, size)
    keep = np.repeat(kept > 0, size)
    pivot = np.repeat(o[first], size)
    x = np.stack([pivot, o], 1)[keep & (every > MIDDLE) & (pivot != o)]
    made = [(np.unique(x, axis=0), STAR, None)] if len(x) else []
    pairs, times = [np.empty((0, 2), np.int64)], [np.empty(0, np.int64)]
    for m in range(2, SMALL + 1):
        f = np.flatnonzero((size == m) & (kept > 0))
        if len(f):
            block = first[f][:, None] + np.arange(m)
            i, j = np.triu_indices(m, 1)
            i, j = block[:, i].ravel(), block[:, j].ravel()
            fits = np.abs(z[i] - z[j]) <= APART
            pairs.append(np.stack([o[i[fits]], o[j[fits]]], 1))
            times.append(np.repeat(kept[f], m * (m - 1) // 2)[fits])
    x, uses = np.concatenate(pairs), np.concatenate(times)
    if len(x):
        at = np.lexsort((x[:, 1], x[:, 0]))
        x, uses = x[at], uses[at]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(x, axis=0) != 0).any(1)]))
        made.append((x[new], PAIR, np.add.reduceat(uses, new)))
    middle = keep & (every > SMALL) & (every <= MIDDLE)
    if middle.any():
        made.append((np.stack([t.view(np.int64), o], 1)[middle], MEMBER, None))
    for x, kind, uses in made:
        for k in range(0, len(x), 1 << 16):
            part = x[k : k + (1 << 16)]
            n = np.ones(len(part), np.int64) if uses is None else uses[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1]), pa.array(np.full(len(part), kind, np.int32)), pa.array(n.astype(np.int32))],
                                             names=["a", "b", "kind", "uses"])


PAIR, STAR, MEMBER = 0, 1, 2  # two classes, two classes, a meeting and a class


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that the sum of coordinate minima and the sizes leave."""
    for batch in batches:
        n1, n2, c1, c2 = (batch.column(c).to_pylist() for c in ("n1", "n2", "c1", "c2"))
        fits = [a * 75 <= b * 100 and b * 75 <= a * 100 and linked(count_bound(unpack_counts(x), unpack_counts(y)), a, b)
                for a, b, x, y in zip(n1, n2, c1, c2)]
        yield batch.filter(pa.array(fits, pa.bool_())).select(["a", "b"])


def _meeting_forest(table: pa.Table) -> pa.Table:
    """What the pairs of one meeting that the bound leaves connect, as stars."""
    keys = table.column("key").to_pylist()
    tree = RTree([unpack_counts(c) for c in table.column("counts").to_pylist()], np.array(table.column("n").to_pylist(), np.int64))
    links = tree.forest(lambda q, r: True)
    return pa.table({"a": pa.array([keys[x] for x, _ in links], pa.int64()), "b": pa.array([keys[y] for _, y in links], pa.int64())})


class RTree:
    """Packed R-tree over group-count points: sorted by size then leading
    coordinates, ``LEAF`` points a leaf, upper corners as boxes.  Boxes are over
    the coarsest members' groups; pairs are compared by their own."""

    def __init__(self, full: list[np.ndarray], n: np.ndarray):
        groups = min(map(len, full))
        points = np.stack([folded(c, groups) for c in full])
        self.full, self.points, self.n = full, points, n
        self.order = np.lexsort((*points.T[:4], n))
        sorted_pts, sorted_n = points[self.order], n[self.order]
        cut = np.arange(0, len(n), LEAF)
        self.levels = []
        hi, lo_n, hi_n = np.maximum.reduceat(sorted_pts, cut), np.minimum.reduceat(sorted_n, cut), np.maximum.reduceat(sorted_n, cut)
        self.levels.append((hi, lo_n, hi_n))
        while len(hi) > LEAF:
            cut = np.arange(0, len(hi), LEAF)
            hi, lo_n, hi_n = np.maximum.reduceat(hi, cut), np.minimum.reduceat(lo_n, cut), np.maximum.reduceat(hi_n, cut)
            self.levels.append((hi, lo_n, hi_n))

    def near(self, q: int) -> np.ndarray:
        """Members whose bound allows a link with member ``q``."""
        point, n = self.points[q], self.n[q]
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, lo_n, hi_n = (x[nodes] for x in self.levels[depth])
            upper = np.minimum(np.minimum(hi, point).sum(1), hi_n)
            # the least partner size that can hold such an overlap gives the weakest demand
            keep = linked(upper, n, np.maximum(lo_n, upper)) & (lo_n * 75 <= n * 100) & (n * 75 <= hi_n * 100)
            nodes = nodes[keep]
            limit = len(self.order) if depth == 0 else len(self.levels[depth - 1][0])
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            nodes = nodes[nodes < limit]
        rows = self.order[nodes]
        inter = np.minimum(self.points[rows], point).sum(1)
        return rows[linked(inter, n, self.n[rows]) & (rows != q)]

    def forest(self, verify, labels: list[int] | None = None) -> list[tuple[int, int]]:
        """The pairs that the bound leaves and ``verify`` confirms, as a star over each component they
        make; members of one label count as joined, and pairs already joined are not looked at again."""
        up = list(range(len(self.n)))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        first: dict[int, int] = {}
        for i, label in enumerate(labels or []):
            up[root(i)] = root(first.setdefault(label, i))
        joined = set()
        for q in range(len(up)):
            for r in self.near(q).tolist():
                if r > q and (x := root(q)) != (y := root(r)) and linked(count_bound(self.full[q], self.full[r]), self.n[q], self.n[r]) and verify(q, r):
                    up[x] = y
                    joined.add(q)
        touched, hub, star = {root(q) for q in joined}, {}, []
        for i in range(len(up)):
            if (x := root(i)) in touched and hub.setdefault(x, i) != i:
                star.append((hub[x], i))
        return star


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def tile_links(keys: list[int], sets: list[np.ndarray], labels: list[int] | None = None) -> list[tuple[int, int]]:
    """The verified links among ``keys``, as stars."""
    tree = RTree([group_counts(s) for s in sets], np.array([len(s) for s in sets], np.int64))
    same = lambda q, r: linked(overlap(sets[q], sets[r]), len(sets[q]), len(sets[r]))
    return [(keys[q], keys[r]) for q, r in tree.forest(same, labels)]


def _link_table(table: pa.Table) -> pa.Table:
    """Links of one tile; rows are ``key, text`` and maybe ``label``.  Rows whose text has
    another class key (an id may have several texts) and repeated rows drop out."""
    asked = table.column("key").to_pylist()
    known = table.column("label").to_pylist() if "label" in table.column_names else None
    keys, sets, labels, seen = [], [], [], set()
    at = 0
    for text in table.column("text").chunks:
        for i, s in _sets(text):
            if (key := asked[at + i]) not in seen and class_key(s) == key:
                seen.add(key)
                keys.append(key)
                sets.append(s)
                labels.append(known[at + i] if known else None)
        at += len(text)
    links = tile_links(keys, sets, labels if known else None) if len(keys) > 1 else []
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs``."""
    return _classified(docs, id_col, text_col).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _classified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, n, component, label`` per row: its class, and the least id and a class of its component."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    raw = stage(d.mapInArrow(_points, POINT_SCHEMA), "points")
    points = raw.where("token IS NULL").select("doc_id", "n", "key", "counts")
    top = (raw.where("token IS NOT NULL").groupBy("token").agg(F.sum("uses").alias("uses"))
           .orderBy(F.desc("uses"), "token").limit(HEAVY).collect())  # at most HEAVY rows of 16 bytes
    heavy = np.array([r["token"] for r in top], np.int64).view(np.uint64)
    at = np.argsort(heavy)
    heavy, rank = heavy[at], np.array([r["uses"] for r in top], np.int64)[at]

    buckets = 64
    while buckets < 4 * int(spark.conf.get("spark.sql.shuffle.partitions")):
        buckets *= 2
    routed = d.select("text").mapInArrow(_router(heavy, rank, buckets), "bucket long, tokens binary, keys binary, steps binary")
    met = stage(routed.repartition("bucket").mapInArrow(_meet, "a long, b long, kind int, uses int"), "meetings")

    classes = stage(points.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("counts").alias("counts")), "classes")
    left = classes.select(F.col("key").alias("a"), F.col("n").alias("n1"), F.col("counts").alias("c1"))
    right = classes.select(F.col("key").alias("b"), F.col("n").alias("n2"), F.col("counts").alias("c2"))
    # few pairs that share a shingle by chance share more: their points aren't asked for
    pairs = met.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("uses").alias("uses")).where(F.col("uses") >= MEET)
    pairs = pairs.join(left, "a").join(right, "b").select("a", "b", "n1", "c1", "n2", "c2").mapInArrow(_bound, "a long, b long")
    seated = met.where(F.col("kind") == MEMBER).select(F.col("a").alias("meeting"), F.col("b").alias("key")).join(classes, "key")
    forests = seated.select("meeting", "key", "n", "counts").groupBy("meeting").applyInArrow(_meeting_forest, "a long, b long")
    stars = met.where(F.col("kind") == STAR).select("a", "b")
    edges = stage(pairs.union(forests).union(stars).distinct(), "candidates")
    parts = components(edges).select(F.col("v").alias("key"), F.col("label").alias("part"))

    # tiles: a part's classes dealt by hash into ceil(size / TILE) groups
    sizes = parts.groupBy("part").agg(F.count("*").alias("m")).withColumn("tiles", F.ceil(F.col("m") / TILE))
    placed = stage(parts.join(sizes, "part").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")))
                   .join(classes.select("key", "doc"), "key"), "parts")
    hubs = (placed.where("tiles > 1").groupBy("part", "tiles")
            .agg(F.slice(F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("m") / (4 * HUBS)))) == 0, F.col("key")))), 1, HUBS).alias("hub")))
    hub_rows = (hubs.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
                .select("part", "tile", F.explode("hub").alias("key")))
    homes, d = housed(d, placed.select("key", "doc"), _homes, "doc_id long, key long")
    seats = placed.select("part", "tile", "key").unionByName(hub_rows).distinct().join(homes, "key")
    tiled = d.join(seats, "doc_id").select("part", "tile", "key", "text")
    found = stage(tiled.groupBy("part", "tile").applyInArrow(_link_table, "a long, b long"), "found")

    links = found
    many = placed.where("tiles > 1")
    if not many.isEmpty():
        joined = components(found).select(F.col("v").alias("key"), "label")
        lab = many.join(joined, "key", "left").select("part", "key", F.coalesce("label", "key").alias("label"))
        # new tiles: a component of many classes has its own, so that few tiles are of several components
        large = lab.groupBy("part", "label").agg(F.count("*").alias("m")).withColumn("own", F.when(F.col("m") >= TILE, F.col("label")))
        groups = large.groupBy("part", "own").agg(F.ceil(F.sum("m") / TILE).alias("tiles"))
        large = large.alias("l").join(groups.alias("g"), (F.col("l.part") == F.col("g.part")) & F.col("l.own").eqNullSafe(F.col("g.own")))
        lab = lab.join(large.select("l.part", "l.label", "l.own", "g.tiles"), ["part", "label"])
        tile = F.struct(F.col("own").isNull().alias("mixed"), F.coalesce("own", F.lit(0).cast("long")).alias("own"), F.pmod(F.xxhash64("key"), F.col("tiles")).alias("at"))
        lab = stage(lab.select("part", tile.alias("tile"), "key", "label"), "tiles")
        spans = lab.groupBy("part", "tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        pairs = (spans.alias("x").join(spans.alias("y"), (F.col("x.part") == F.col("y.part")) & (F.col("x.tile") <= F.col("y.tile"))
                                       & ~((F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi")) & (F.col("x.lo") == F.col("y.lo"))))
                 .select(F.col("x.part").alias("part"), F.col("x.tile").alias("t1"), F.col("y.tile").alias("t2")))
        pairs = stage(pairs, "tile-pairs")
        ends = pairs.select("part", "t1", "t2", F.explode(F.array_distinct(F.array("t1", "t2"))).alias("tile"))
        both = (ends.join(lab, ["part", "tile"]).join(homes, "key").join(d, "doc_id")
                .select("part", "t1", "t2", "key", "text", "label"))
        more = both.groupBy("part", "t1", "t2").applyInArrow(_link_table, "a long, b long")
        known = joined.select(F.col("label").alias("a"), F.col("key").alias("b"))
        links = stage(known.unionByName(more), "links")

    final = components(links).select(F.col("v").alias("key"), "label")
    placed2 = classes.select("key", "doc").join(final, "key")
    least = placed2.groupBy("label").agg(F.min("doc").alias("component"))
    names = stage(placed2.join(least, "label").select("key", "component", "label"), "names")
    firsts = classes.select("key", "doc").join(names, "key", "left").select("key", F.coalesce("component", "doc").alias("component"), F.coalesce("label", "key").alias("label"))
    firsts = stage(firsts, "firsts")
    return points.join(firsts, "key", "left").select("doc_id", "key", "n", "component", "label")


def _keyed(column: pa.Array) -> pa.Array:
    return pa.array([class_key(s) if len(s) else None for _, s in _sets(column)], pa.int64())


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _keyed(batch.column(1))], names=["doc_id", "key"])


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component, the one with the least id, with all columns.

    An id with different texts is a row in each of their components.  Rows that
    repeat id and words stay once; rows without an id stay all.
    """
    found = stage(_classified(docs, id_col, text_col).where("doc_id IS NOT NULL"), "components")
    first = found.where("key IS NOT NULL").groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("f")).select("f.*")
    blank = found.where("key IS NULL").select("doc_id", F.lit(0).cast("long").alias("key")).distinct()
    keep = first.unionByName(blank).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    rows = carried(docs.where(F.col(id_col).isNotNull()), lambda batch: [batch.column(0), _keyed(batch.column(1))], "__id long, __key long",
                   F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("row", "__id", F.coalesce("__key", F.lit(0).cast("long")).alias("__key"))
    named = rows.join(keep, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"]).select("row.*")
    return named.unionByName(docs.where(F.col(id_col).isNull()))
