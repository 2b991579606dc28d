"""Operators 2, 3, 4 and 10 and the pipeline: search, packing, mixing, chat."""

import hashlib
import importlib
import math
import random
import sys
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from llm_cases import corpus, frame, jaccard_components
from pyspark.sql import functions as F
from test_filters import plain_signals, plain_spans
from tools.compare import rows_of

from cdcflow.llm import chat, mixing, packing, pii, topk
from cdcflow.llm.queries import MIX_WEIGHTS, ORACLE, QUERIES

TOKENIZER = "byte_bpe_50k.json"


# --- 2: exact top-k ---------------------------------------------------------
def plain_top(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, u in {(i, tuple(v)) for i, v in ok if i % 3 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(u, v)), i) for i, v in ok if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("dims,scale", [(6, 1.0), (3, 1e6)])
def test_top_k_equals_brute_force(spark, dims, scale, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 64)
    monkeypatch.setattr(topk, "CHUNK", 16)
    rng = random.Random(dims)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * scale for _ in range(dims)]) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(40)]  # ties
    rows += [(500, None), (501, [None] * dims), (502, [float("nan")] * dims), (503, [float("inf")] + [0.0] * (dims - 1)), (504, [0.0] * dims), (505, [1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, rank string")
    got = topk.top_k(df, F.col("vec_id") % 3 == 0, k=4).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == plain_top(rows, 4) and len(got) == len(plain_top(rows, 4))


def test_top_k_small_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (3, [2.0, 1.0]), (1, None)], "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 3 == 0).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == {(0, 1, 3), (3, 1, 0)}
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(df, F.lit(False)).count() == 0


def test_blocks_are_skipped():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(8, 16)) * 3
    x = np.floor(256 * (centre[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 16)) * 0.1))
    blocks = topk.Blocks(np.arange(2000), x)
    best, scored = blocks.best(-1, x[0], 5)
    s = (x @ x[0]).astype(int)
    assert [b[0] for b in best] == sorted(s.tolist(), reverse=True)[:5]
    assert scored < len(blocks.cuts) // 2


# --- 3: packing -------------------------------------------------------------
def test_packed_lengths_fit_and_are_few():
    rng = np.random.default_rng(3)
    for n, low, high in ((0, 1, 9), (1, 5, 6), (3000, 1, 1024), (500, 300, 700), (400, 1024, 1025)):
        lengths = rng.integers(low, high, n)
        bins, offsets = packing.pack_lengths(lengths, 1024)
        assert len(bins) == n
        by = defaultdict(list)
        for k, o, x in zip(bins, offsets, lengths):
            by[k].append((o, x))
        for held in by.values():
            at = 0
            for o, x in sorted(held):
                assert o == at
                at += x
            assert at <= 1024
        if n == 3000:
            assert len(by) <= 1.01 * lengths.sum() / 1024 + 1


def test_best_two_fit_closes_gaps():
    # greedy gives 6 + 3 (gap 1); replacing 3 by 2 + 2 fills the bin
    bins, _ = packing.pack_lengths(np.array([6, 3, 2, 2]), 10)
    assert bins[0] == bins[2] == bins[3] != bins[1]


@pytest.mark.parametrize("clash", [False, True])
def test_pieces_equal_the_tokenizer(spark, clash):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    tok.encode_special_tokens = True
    rows = corpus() + [(900, "<|endoftext|> don't\n\n x\t y \x1c z  "), (901, " lead"), (902, "trail \n")]
    out = packing.pack(frame(spark, rows, clash), with_ids=True)
    got = out.collect()
    by, places = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for i, t in {(i, t) for i, t in rows}:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(by[i], key=lambda r: r.piece)
        if i == 7:  # the id comes twice
            assert sum(r.length for r in pieces) == 2 * len(ids)
            continue
        assert sum(r.length for r in pieces) == len(ids)
        at = 0
        for k, r in enumerate(pieces):
            part = ids[at : at + r.length]
            assert (r.piece, r.start, r.ids_crc32, bytes(r.ids)) == (k, at, zlib.crc32(part.tobytes()), part.tobytes())
            assert r.length <= 1024 and (k == 0 or r.length == 1024)
            at += r.length
    for held in places.values():
        at = 0
        for o, n in sorted(held):
            assert o == at
            at += n
        assert at <= 1024
    assert len(places) <= math.ceil(sum(r.length for r in got) / 1024) + 4
    whole = packing.sequences(out).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in got)
    assert packing.pack(frame(spark, [])).count() == 0


def test_encoder_equals_the_tokenizer_on_random_text():
    enc = packing.encoder(TOKENIZER)
    rng = random.Random(2)
    bits = ["a", "B", "é", "ß", "1", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!", " ", "²", "Ⅷ", "日本", "😀", "<|endoftext|>", "_", "the", "\x1c", " ", "\r", "\x85"]
    for _ in range(4000):
        s = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert np.frombuffer(enc.ids(s), "<u4").tolist() == enc.tok.encode(s, add_special_tokens=False).ids, s


# --- 4: mixing --------------------------------------------------------------
def labelled_corpus(spark):
    rng = random.Random(6)
    rows, kinds = [], []
    for i in range(900):
        kind = "bad" if i % 3 == 0 else "fine"
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 60))] + (["scum", "vile"] if kind == "bad" else ["kind", "calm"])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        kinds.append((i, kind))
    return frame(spark, rows), spark.createDataFrame(kinds, "doc_id long, domain string")


def test_rates_reach_the_target_totals(spark):
    docs, kinds = labelled_corpus(spark)
    out = mixing.mix(docs, kinds.where("doc_id % 2 = 0"), mixing.by_weight({"fine": 0.9, "bad": 0.1})).collect()
    words = sum(r.n_tokens for r in out)
    for k, name in enumerate(out[0].domains):
        total = sum(r.rate * r.n_tokens * r.posterior[k] for r in out)
        assert abs(total / words - {"fine": 0.9, "bad": 0.1}[name]) < 0.01
    truth = dict((i, "bad" if i % 3 == 0 else "fine") for i in range(900))
    held = [r for r in out if r.doc_id % 2]
    assert sum(r.domains[int(np.argmax(r.posterior))] == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 and abs(r.copies - r.rate) < 1 for r in out)


def test_mixing_equals_a_plain_descent(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.4, 0.4, 0.4], 500)
    n = rng.integers(0, 300, 500)
    post = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, posterior array<double>")
    plan, reached = mixing.solve(post, 3, lambda t: t * np.array([1.3, 0.7, 0.2]), top=1.5)
    r = plan.rate(p)
    assert np.allclose((r * n) @ p, reached) and r.min() >= 0 and r.max() <= 1.5
    # no feasible rates in a plain projected descent come closer
    want, start = (n @ p) * np.array([1.3, 0.7, 0.2]), n @ p
    q = np.ones(500)
    for _ in range(4000):
        q = np.clip(q - 0.3 * (p @ (((q * n) @ p - want) / start)), 0, 1.5)
    miss = lambda v: float(((((v * n) @ p - want) ** 2) / start).sum() / n.sum())
    assert miss(r) <= miss(q) + 1e-3


@pytest.mark.parametrize("clash", [False, True])
def test_mixing_on_odd_tables(spark, clash):
    rows = corpus()
    docs = frame(spark, rows, clash)
    kinds = spark.createDataFrame([(i, "a" if i < 12 else "b") for i in range(24)] + [(None, "a"), (3, None), (400, "a")], "doc_id long, domain string")
    goal = mixing.by_weight({"a": 0.5, "b": 0.5})
    assert mixing.mix(docs, kinds, goal).count() == len(rows)
    out = mixing.mixed(docs, kinds, goal)
    rates = {r.doc_id: r.copies for r in mixing.mix(docs, kinds, goal).collect()}
    assert out.columns == docs.columns
    counts = defaultdict(int)
    for r in out.collect():
        counts[r.doc_id] += 1
    assert all(counts[i] == rates[i] * (2 if i == 7 else 1) for i in rates)
    same = mixing.mix(docs, kinds.limit(0), goal).collect()
    assert len(same) == len(rows) and {r.copies for r in same} == {1}
    assert mixing.mixed(docs.limit(0), kinds, goal).count() == 0


# --- 10: chat ---------------------------------------------------------------
def test_every_path_of_a_tree_is_found_and_ranked(spark):
    rng = random.Random(9)
    nodes = []
    for tree in ("t1", "t2", "t3"):
        size = {"t1": 60, "t2": 1, "t3": 200}[tree]
        for i in range(size):
            parent = None if i == 0 else (i - 1 if tree == "t3" else rng.randrange(i))
            nodes.append((tree, i, parent, rng.randrange(100) / 4))
    nodes += [("cycle", 1, 2, 0.0), ("cycle", 2, 1, 0.0), ("cycle", 3, 2, 0.0), ("orphan", 5, 99, 1.0)]
    got = chat.paths(spark.createDataFrame(nodes, "tree string, node long, parent long, score double")).collect()
    kids, up, score = defaultdict(list), {}, {}
    for t, i, p, s in nodes:
        up[t, i], score[t, i] = p, s
        kids[t, p].append(i)
    want = {}
    for t, i, _, _ in nodes:
        if t not in ("cycle", "orphan") and not kids[t, i]:
            path, at = [], i
            while at is not None:
                path.append(at)
                at = up[t, at]
            want[t, i] = (path[::-1], sum(score[t, x] for x in path))
    want["orphan", 5] = ([5], 1.0)
    found = defaultdict(list)
    for r in got:
        found[r.tree, r.leaf].append(r)
    assert set(found) == set(want)
    for key, rows in found.items():
        rows.sort(key=lambda r: r.depth)
        assert [r.node for r in rows] == want[key][0] and rows[0].score == pytest.approx(want[key][1])
    for t in ("t1", "t3"):
        order = sorted((-want[k][1], k[1]) for k in want if k[0] == t)
        assert [x for _, x in order] == [leaf for _, leaf in sorted({(r.rank, r.leaf) for r in got if r.tree == t})]


def test_formatting_reads_back(spark):
    texts = ["</s>[INST] ok [/INST]", "\\1 \\\\0 <s>", "", None, "[/INST]</s>", "é😀\n", "\\", "<", "[" * 3]
    data = [("a", i, i - 1 if i else None, ["user", "assistant", None, "as[sis<tant"][i % 4], t, 1.0, "x") for i, t in enumerate(texts)]
    data += [("a", 0, None, "user", texts[0], 1.0, "x"), (None, 1, None, "user", "lost", 1.0, "x")]
    df = spark.createDataFrame(data, "tree string, node long, parent long, role string, text string, score double, leaf string")
    out = chat.conversations(df)
    row = out.withColumn("turns", chat.turns(F.col("formatted"))).withColumn("learnt", chat.learnt(F.col("formatted"), F.col("loss"))).collect()
    assert len(row) == 1 and row[0].n_turns == len(texts)
    assert [(t.role, t.text) for t in row[0].turns] == [(d[3] or "", d[4] or "") for d in data[: len(texts)]]
    assert row[0].learnt == "".join(d[4] or "" for d in data[: len(texts)] if d[3] == "assistant")
    assert row[0].formatted.count("</s>") == len(texts)
    assert chat.conversations(df.limit(0)).count() == 0


def test_only_the_best_branch_is_formatted(spark):
    data = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "good", 0.9), ("t", 4, 2, "user", "more", 0.2)]
    df = spark.createDataFrame(data, "tree string, node long, parent long, role string, text string, score double")
    assert [r.formatted for r in chat.conversations(df).collect()] == ["<s>user[/INST]q</s><s>assistant[/INST]good</s>"]
    assert chat.conversations(df, best=None).count() == 2


def test_chat_uses_no_python(spark):
    plan = QUERIES["op10_chat_formatting"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- queries and pipeline ---------------------------------------------------
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, res.fetchall())


def test_chat_digests(spark):
    got = {r.conv_id: r for r in QUERIES["op10_chat_formatting"](spark, SF_SMALL).collect()}
    talk = defaultdict(list)
    for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect():
        talk[r.conv_id].append((r.turn, r.role, r.text or ""))
    talk[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(talk)
    for i, turns in talk.items():
        said = "".join(f"{r}\n{t}\n" for _, r, t in sorted(turns))
        learnt = "".join(t for _, r, t in sorted(turns) if r == "assistant")
        assert (got[i].n_turns, got[i].turns_sha256, got[i].loss_chars, got[i].loss_sha256) == (len(turns), sha(said), len(learnt), sha(learnt))


def test_mix_query_reaches_its_weights(spark):
    out = QUERIES["op4_mix_to_target_weights"](spark, SF_SMALL).collect()
    words = sum(r.n_tokens for r in out)
    assert len(out) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for d, share in MIX_WEIGHTS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in out) / words - share) < 0.02


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "pack_sequences"]
    steps = dict(cp.STAGES)
    given = {r.doc_id: r for r in docs.collect()}
    kept = steps["quality_rules"](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    for i, r in given.items():
        n, _, _, _, rep = plain_signals(r.text)
        if n < 10 or 100 * rep > 20 * n:
            assert i not in left
    good = {r.doc_id for r in cp.domains(spark, SF_SMALL).where("domain = 'good'").collect()}
    fine = {i for i in good if (s := plain_signals(given[i].text))[0] >= 10 and 100 * s[4] <= 20 * s[0]}
    assert len(fine - left) <= 0.02 * len(fine)
    rows = [(i, given[i].text) for i in left]
    one = steps["near_duplicates"](spark, kept, SF_SMALL)
    firsts = {c for _, c in jaccard_components(rows).values()}
    assert sorted(r.doc_id for r in one.collect()) == sorted(firsts)
    clean = steps["personal_data"](spark, one, SF_SMALL)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        if not pii.base_matches(given[r.doc_id].text):
            assert r.text == given[r.doc_id].text
    mixed = steps["mix_sources"](spark, clean, SF_SMALL)
    assert mixed.columns == docs.columns
    after = [r.doc_id for r in mixed.collect()]
    assert len(after) == len(set(after)) and len((good & firsts) - set(after)) <= 0.02 * len(good & firsts)
    packed = steps["pack_sequences"](spark, mixed, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_pipeline_takes_empty_documents(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, step in cp.STAGES:
        docs = step(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_entry_lives_without_the_operators(monkeypatch):
    import __spark_entry__ as entry

    assert {"pipeline", *QUERIES} <= set(entry.queries())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        bare = importlib.reload(entry)
        assert bare.queries() and not {"pipeline", *QUERIES} & set(bare.queries())
        assert not set(ORACLE) & set(bare.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
