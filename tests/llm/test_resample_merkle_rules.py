"""Importance resampling, Merkle manifest and rule ensemble against plain versions and on awkward tables."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from llm_cases import CLASH, LOWER, corpus, frame
from pyspark.sql import functions as F

from cdcflow.llm import merkle, order, queries, resample, rulefit

RUN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- resampling ---------------------------------------------------------------

def plain_features(text):
    w = RUN.findall((text or "").translate(LOWER))
    return len(w), [crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain_resample(rows, target, share=5):
    feats = [(i, *plain_features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in feats for b in f), Counter(b for x in target for b in plain_features(x)[1])
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in s}
    out = []
    for i, n, f in feats:
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    may = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(may[: share * len(may) // 100]):
        r[4] = k + 1
    return sorted((r[:5] for r in out), key=str)


def ranked(df):
    return sorted(([r.doc_id, r.n_features, r.weight, r.score, r["rank"]] for r in df.collect()), key=str)


ODD = [None, "", " \n\t", "One-two_THREE's", "é" * 70 + " tail " + "x" * 5000 + " end", "a  b,,c", "ÀB àb", "😀 smile 😀", "word " * 40, "0123456789 " * 30, "Straße STRASSE ẞ"]


@pytest.mark.parametrize("words", [1 << 15, 30, 0])
def test_resampling_equals_brute_force_whatever_the_dictionary(spark, words):
    rows = corpus() + [(600 + k, t) for k, t in enumerate(ODD)] + [(None, "null id " * 30), (0, "word " * 40)]
    target = ["w1 w2 w3 w4 " * 30, "word word passage", None, ODD[4]]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = ranked(resample.resample(frame(spark, rows, clash=True), bench, share=30, words=words))
    assert got == plain_resample(rows, target, 30) and sum(r[4] is not None for r in got) > 5


def test_resampling_of_empty_tables(spark):
    none, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(none, bench).count() == 0
    rows = [(k, "word " * (20 + k)) for k in range(40)]
    assert ranked(resample.resample(frame(spark, rows), bench)) == plain_resample(rows, [])


def test_crcs_of_appended_bytes():
    rng = random.Random(1)
    for n in [0, 1, 2, 5, 63, 64, 65, 1000, 70000]:
        a, b = rng.randbytes(rng.randrange(50)), rng.randbytes(n)
        got = int(resample.extend(np.array([crc32(a)], np.uint32), np.array([n]))[0]) ^ crc32(b)
        assert got == crc32(a + b), n


def test_the_dictionary_is_bounded_and_holds_the_frequent_words(spark):
    docs = frame(spark, [(k, "often often sometimes " + " ".join(f"once{k}x{j}" for j in range(30))) for k in range(60)])
    none = spark.createDataFrame([], "text string")
    for most in (0, 1, 2, 500):
        words = resample.dictionary(docs, none, most)
        assert len(words) <= most and set(words) == set([b"often", b"sometimes"][:most])


# --- places in an order ---------------------------------------------------------

def test_places_in_a_hot_group_with_ties_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(order, "ROWS", 50)  # many ranges
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'g' || id % 5 END AS g", "id % 40 AS o", "id AS row")
    got = order.numbered(df, ["g"], [F.col("o")]).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.pos, r.o, r.total))
    assert len(got) == 1000
    for rows in by.values():
        rows.sort()
        assert [p for p, _, _ in rows] == list(range(len(rows))) and [o for _, o, _ in rows] == sorted(o for _, o, _ in rows) and {t for _, _, t in rows} == {len(rows)}


# --- manifest ---------------------------------------------------------------------

def H(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(r):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))


def plain_tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        trees[s] = plain_tree([x[2] for x in by[s]])
    top = plain_tree([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for k, (_, _, h, r) in enumerate(by[s]):
            way = []
            for tree, at in ((trees[s], k), (top, j)):
                for row in tree[:-1]:
                    a = at - at % 3
                    way.append(("".join(row[a:at]), "".join(row[at + 1 : a + 3])))
                    at //= 3
            node = h
            if r[0] is not None and r[1] is not None and crc32(str(r[0]).encode()) % 2 == 0:
                node = plain_leaf((r[0], r[1].replace("\n", ""), *r[2:]))
            for x, y in way:
                node = H(x + node + y)
            out.append((r[0], h, trees[s][-1][0], top[-1][0], H("".join(x + y for x, y in way)), node, node == top[-1][0]))
    return sorted(out, key=str)


def tampered():
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def manifest_rows():
    rng = random.Random(5)
    rows = []
    for k in range(200):
        source = "hot" if k % 3 else rng.choice([None, "", "é", "z", "src1", f"lone{k}"])
        text = rng.choice([None, "", "a\nb", f"text {k}", "é\n" * k, "x" * 20000])
        rows.append((rng.choice([k, k, None, 5]), text, rng.choice([None, "en", ""]), source, rng.choice([None, k])))
    return rows + rows[:5]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_brute_force_for_any_superblock(spark, levels):
    rows = manifest_rows()
    df = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("z").alias(c) for c in CLASH + ["pos", "total", "h", "block"]])
    got = sorted((tuple(r) for r in merkle.manifest(df, tampered(), levels=levels).collect()), key=str)
    assert got == plain_manifest(rows) and {r[-1] for r in got} == {True, False}


def test_proofs_fold_to_the_root_and_order_of_storage_does_not_matter(spark):
    rows = manifest_rows()
    a = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(7), proofs=True).collect()
    for r in a:
        node = r.leaf
        for step in r.proof:
            node = H(step.left + node + step.right)
        assert node == r.root == r.folded_root and r.verified and H("".join(s.left + s.right for s in r.proof)) == r.proof_sha256
    random.Random(2).shuffle(rows)
    assert {r.root for r in merkle.manifest(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()} == {a[0].root}


@pytest.mark.parametrize("n", [0, 1])
def test_manifest_of_no_row_and_of_one(spark, n):
    rows = [(7, "only", None, None, 4)][:n]
    got = [tuple(r) for r in merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()]
    assert got == [(7, (h := plain_leaf(rows[0])), h, h, H(""), h, True)] if n else got == []


# --- rule ensemble ------------------------------------------------------------------

def labelled(spark, n=400):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(30, 120))]
        if bad:
            words = [w + rng.choice(["###", "!!", "|"]) for w in words] if k % 8 else words[:6] * 12
        rows.append((k, " ".join(words)))
        labels.append((k, 0 if bad else 1))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, label int")


def test_rules_learn_held_out_labels_and_the_column_equals_the_model(spark):
    docs, labels = labelled(spark)
    model = rulefit.fit(docs, labels.where("doc_id % 5 <> 0"))
    assert 0 < len(model.rules) <= 60
    got = rulefit.score(docs, model, F.col("doc_id")).join(labels, "doc_id").toPandas()
    held = got[got.doc_id % 5 == 0]
    assert ((held.score >= 0.5) == (held.label == 1)).mean() >= 0.95
    assert np.allclose(got.score, model.score(got[rulefit.STATS].to_numpy()), atol=1e-12)


def test_paths_of_a_tree_are_its_nodes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    from cdcflow.llm.trees import _bin, boost

    m = boost(x, y, 3, 3)
    binned = _bin(x, m.edges)
    for t in m.trees:
        rules = rulefit.paths(t, m.edges)
        assert len(rules) == len(t.value) - 1
        at, reach = np.zeros(len(x), int), [np.zeros(len(x), bool) for _ in t.value]
        for _ in range(4):
            for i in range(len(t.value)):
                reach[i] |= at == i
            inner = t.left[at] > 0
            at = np.where(inner, t.left[at] + (binned[np.arange(len(x)), t.feature[at]] > t.split[at]), at)
        assert sorted(r.holds(x).tobytes() for r in rules) == sorted(r.tobytes() for r in reach[1:])


def test_lasso_drops_what_does_not_help():
    rng = np.random.default_rng(3)
    z = rng.normal(size=(2000, 30))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * z[:, 3] + 1.5 * z[:, 7]))).astype(float)
    w, _ = rulefit.lasso(z, y, 0.05, (np.zeros(30), 0.0))
    assert set(np.flatnonzero(w)) == {3, 7} and w[3] > 0 > w[7]
    assert not np.any(rulefit.lasso(z, y, 10.0, (np.zeros(30), 0.0))[0])


@pytest.mark.parametrize("labels,want", [([], 0.5), ([(1, 1), (2, 1)], 0.75), ([(1, None), (None, 1)], 0.5)])
def test_few_labels_give_the_smoothed_share(spark, labels, want):
    model = rulefit.fit(frame(spark, corpus()), spark.createDataFrame(labels, "doc_id long, label int"))
    assert model.rules == [] and model.score(np.zeros((1, len(rulefit.STATS))))[0] == pytest.approx(want)


def test_scores_of_awkward_texts(spark):
    docs, labels = labelled(spark)
    model = rulefit.fit(docs, labels)
    rows = corpus() + [(600 + k, t) for k, t in enumerate(ODD)] + [(None, "x"), (None, None)]
    out = rulefit.score(frame(spark, rows, clash=True), model, F.col("doc_id")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    same = {r.score for r in out if r.doc_id in (401, 400)}
    assert len(same) == 1  # null counts as empty
    assert rulefit.score(spark.createDataFrame([], DOCS), model, F.col("doc_id")).count() == 0


def test_labels_of_the_held_out_third_teach_nothing(spark, scratch):
    docs, labels = labelled(spark, 300)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1

    def scores(name, quality):
        docs.write.parquet(f"{scratch}/{name}/documents.parquet")
        labels.select("doc_id", quality.cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{scratch}/{name}/labels.parquet")
        return sorted(map(tuple, queries.op13_rule_ensemble(spark, f"{scratch}/{name}").collect()))

    assert scores("true", F.col("label")) == scores("false", F.when(held, 1 - F.col("label")).otherwise(F.col("label")))
