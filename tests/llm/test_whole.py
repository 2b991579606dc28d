"""Results that must not depend on how much there is: no caps, first places or samples."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import frame
from pyspark.sql import functions as F

import corpus_pipeline
from cdcflow.llm import jaccard, langid, mixing, secret_scan, store, substring
from cdcflow.llm.words import Words, text_buffers


def test_every_edited_stretch_of_a_long_pair_is_verified():
    rng = np.random.default_rng(3)
    a, b = [], []
    for _ in range(150):  # an edited copy, then unlike text with a token in six shared
        p, j = rng.integers(0, 2**63, 70, dtype=np.uint64), rng.integers(0, 2**63, 45, dtype=np.uint64)
        q, k = p.copy(), rng.integers(0, 2**63, 45, dtype=np.uint64)
        q[33:38], k[::6] = rng.integers(0, 2**63, 5, dtype=np.uint64), j[::6]
        a += [p, j]
        b += [q, k]
    got = substring.shared_stretches(np.concatenate(a), np.concatenate(b))
    cover = {i for x, y, *_ in got for i in range(x, y + 1)}
    assert all({115 * k, 115 * k + 69} <= cover for k in range(150)) and all(s[4] >= 75 for s in got)


def test_every_place_of_a_repeated_passage_is_reported():
    p = np.random.default_rng(4).integers(0, 2**63, 60, dtype=np.uint64)
    for a, b in ((p, np.tile(p, 3)), (np.tile(p, 3), p), (np.tile(p, 2), np.tile(p, 3))):
        got = substring.shared_stretches(a, b)
        for n, (x, y) in ((len(a), (0, 1)), (len(b), (2, 3))):
            assert {i for s in got for i in range(s[x], s[y] + 1)} == set(range(n))


def test_the_spans_of_a_hot_text_are_cut_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(substring, "ASKED", 16)
    texts = [" ".join(f"w{i}x{k}" for k in range(300)) for i in range(3)]
    sh = [Words(*text_buffers(pa.array([t]))).shingles()[0] for t in texts]
    keys = [substring._class(s) for s in sh]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    homes = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, doc_id long")
    rows = [(p, keys[0], p % 200, p % 200 + 60, 0) for p in range(400)] + [(p, keys[1 + p % 2], p % 7, p % 7 + 50, 1) for p in range(20)]
    cut = substring._cut_spans

    def counted(batches):
        for batch in batches:
            assert max((len(x) for x in batch.column(2)), default=0) < 4 * 16
            yield batch

    monkeypatch.setattr(substring, "_cut_spans", lambda batches: cut(counted(batches)))
    ends = spark.createDataFrame(rows, "pair long, key long, x long, y long, side long")
    got = substring.cut_spans(ends, homes, d).collect()
    want = {(p, side, k, x, sh[keys.index(k)][x : y + 1].tobytes()) for p, k, x, y, side in rows}
    assert len(got) == len(rows) and {(r.pair, r.side, r.key, r.x, bytes(r.tokens)) for r in got} == want


def frequent_lines(seed=9, docs=60):
    """Documents of lines that are frequent, in orders that mostly one pair shares."""
    rng = random.Random(seed)
    lines = [" ".join(f"l{i}w{k}" for k in range(24)) for i in range(30)]
    rows = [(i, " ".join(" ".join([lines[j], f"u{i}x{n}"]) for n, j in enumerate(rng.sample(range(30), 12)))) for i in range(docs)]
    for k in range(20):
        shared = " ".join(lines[j] for j in rng.sample(range(30), 3))
        rows += [(1000 + 10 * k + e, f"a{k}{e} " * 3 + shared + f" z{k}{e}" * 3) for e in range(2)]
    return rows


def test_exact_passages_of_frequent_lines_equal_brute_force(spark):
    rows = frequent_lines()
    seen = {}
    for i, t in rows:
        w = t.split()
        for x in range(len(w) - 49):
            seen.setdefault(tuple(w[x : x + 50]), set()).add((i, x))
    need = {(i, p) for at in seen.values() if len({i for i, _ in at}) > 1 for i, x in at for p in range(x, x + 50)}
    got = {(r.doc_id, p) for r in substring.repeated_passages(frame(spark, rows)).collect() for p in range(r.start_word, r.end_word)}
    assert len({i for i, _ in need}) >= 40 and need <= got


def test_every_place_of_a_star_meets_another_text():
    key = np.array([1, 1, 1, 2, 3, 3, 5, 5, 7])
    first, size = np.array([0, 6, 8]), np.array([6, 2, 1])
    x, y = substring.star(key, first, size)
    assert sorted(zip(x.tolist(), y.tolist())) == [(0, 3), (0, 4), (0, 5), (3, 1), (3, 2)]


def test_the_dictionary_counts_the_words_of_all_documents(spark):
    from collections import Counter

    rows = [(i, f"common thing{'a' * (i % 7)} " + ("seltenwort " * 400 if i == 2777 else "")) for i in range(3000)]
    count = Counter(w for _, t in rows for w in t.split() if 3 <= len(w) <= 12)
    want = {w for w, _ in sorted(count.items(), key=lambda e: (-e[1], e[0]))[:4]}
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert secret_scan.dictionary(d, most=4) == want
    assert "seltenwort" in secret_scan.dictionary(d)


def test_long_spans_are_read_whole():
    value = "k9$" * 300
    assert secret_scan.candidates(f'password = "{value}" end') == [(12, 12 + len(value))]
    run, key = "Zq7x" * 100, "AKIA" + "Q7" * 8
    one, two = (secret_scan.features(run + tail, 0, len(run) + 20, "", frozenset()) for tail in (key, "0" * 20))
    assert one[1:] != two[1:]
    text = run + "-" + key
    ((span, parts),) = secret_scan.joined(text)
    assert span == (0, len(text)) and (len(run) + 1, len(text)) in parts

    class Model:
        def score(self, x):
            return (x[:, 0] == len(key)).astype(float)

    assert secret_scan.Scanner(Model(), frozenset()).score(text, "", secret_scan.joined(text)) == [1.0]


def test_rare_secrets_of_a_large_table_are_all_learnt_from(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "SAMPLE_FINDINGS", 200)
    monkeypatch.setattr(secret_scan, "SAMPLE_DOCS", 50, raising=False)
    rng = random.Random(5)
    rows = [(i, f"on 2024-01-{i % 28 + 1:02d}T{i % 24:02d}:00:00 we met") for i in range(4000)]
    for i in range(0, 4000, 400):
        rows[i] = (i, "use AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(16)) + " now")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scanner = secret_scan.fit(docs)
    assert scanner is not None
    again = secret_scan.fit(docs.orderBy(F.desc("doc_id")).repartition(3))
    for one in (scanner, again):
        got = {(r.doc_id, r.score) for r in secret_scan.scan(docs, one).where("secret").collect()}
        assert {i for i, _ in got} == set(range(0, 4000, 400))
    assert all((a.value == b.value).all() for a, b in zip(scanner.model.trees, again.model.trees))


def test_languages_with_few_labels_are_learnt(spark):
    rows = [(i, f"the cat number {i} sat on the mat again", None if i % 50 else "en") for i in range(4000)]
    rows += [(9000 + i, f"der hund {i} schlief unter einem grossen baum", "de") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True), sample=40)
    assert model.langs == ["de", "en"]
    held = langid.document_counts(docs.where("lang IS NOT NULL").select("text"))
    assert np.allclose(model.idf, np.log(86 / (1 + held)) + 0.05, atol=1e-5)


def test_domains_with_few_labels_are_learnt_and_lost_ones_told(spark):
    rng = random.Random(6)
    rows = [(i, " ".join([f"w{rng.randrange(400)}" for _ in range(40)] + (["scum", "vile"] if i % 400 == 0 else ["kind", "calm"]))) for i in range(3200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = docs.select("doc_id", F.when(F.col("doc_id") % 400 == 0, "bad").otherwise("fine").alias("domain"))
    model = mixing.fit(docs, kinds, sample=200)
    assert model.domains == ["bad", "fine"]
    with pytest.raises(ValueError, match="odd"):
        mixing.by_weight({"fine": 0.5, "odd": 0.5})(model.domains, [1.0, 2.0])


def test_an_id_with_two_texts_keeps_a_row_of_each_component(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [(1, one), (1, two), (1, two), (2, one + " x"), (3, three), (3, one), (4, two), (5, ""), (5, three + " y")]
    got = jaccard.representatives(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, one), (1, two), (3, three), (5, "")])


def test_small_fractions_keep_their_share_in_expectation(spark):
    n = 200_000
    for rate in (0.0005, 0.005, 0.009, 0.5, 0.995, 1.005, 2.0, 0.0):
        got = spark.range(n).select(mixing.copies(F.lit(rate), F.col("id")).alias("c")).agg(F.sum("c")).first()[0]
        part = rate % 1
        assert abs(got - rate * n) <= 4 * (n * part * (1 - part)) ** 0.5, rate


def test_a_domain_at_a_small_rate_is_thinned_not_lost(spark, caplog):
    rng = random.Random(6)
    rows = [(k, " ".join(f"{'x' if k % 2 else 'w'}{rng.randrange(60)}" for _ in range(20))) for k in range(6000)]
    docs = frame(spark, rows)
    kinds = spark.createDataFrame([(k, "odd" if k % 2 else "even") for k in range(0, 6000, 3)], "doc_id long, domain string")
    goal = lambda names, totals: [t * (0.01 if n == "odd" else 1.0) for n, t in zip(names, totals)]
    with caplog.at_level("INFO", logger="cdcflow.mixing"):
        out = mixing.mix(docs, kinds, goal, top=1.0).collect()
    odd = [r for r in out if r.doc_id % 2]
    rate = sum(r.rate for r in odd)
    assert max(r.rate for r in odd) < 0.1 and 0 < sum(r.copies for r in odd) and abs(sum(r.copies for r in odd) - rate) <= 4 * rate**0.5
    assert "of" in caplog.text and "odd:" in caplog.text


def test_links_through_rows_without_an_id(spark):
    """1 - N - 2: the text in the middle has no id, and is the only link."""
    words = [f"w{k}" for k in range(60)]
    first, middle, last = words[:], words[:], words[:]
    middle[3] = "m"
    last[3], last[55] = "m", "z"
    rows = [(1, " ".join(first)), (None, " ".join(middle)), (2, " ".join(last)), (None, "nothing " * 9), (None, None)]
    sets = [{tuple(t[i : i + 5]) for i in range(56)} for t in (first, middle, last)]
    alike = lambda a, b: len(a & b) / len(a | b)
    assert alike(sets[0], sets[1]) >= 0.75 and alike(sets[1], sets[2]) >= 0.75 and alike(sets[0], sets[2]) < 0.75
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 56, 1), (None, 56, 1), (2, 56, 1), (None, 1, None), (None, 0, None)], key=str)


def test_passages_of_rows_without_an_id(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(70))
    text = lambda: " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))
    rows = [(None, f"{text()} {passage} {text()}"), (None, f"{text()} {passage}"), (5, f"{passage} {text()}"), (None, text()), (None, None)]
    got = [(r.doc_id, r.start_word, r.end_word, r.group_id) for r in substring.repeated_passages(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 40, 110, 5), (None, 40, 110, 5), (5, 0, 70, 5)], key=str)


def test_texts_that_repeat_themselves_are_alike_as_a_whole():
    rng = np.random.default_rng(5)
    p = rng.integers(0, 2**63, 60, dtype=np.uint64)
    noise = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    a, b = np.concatenate([noise(30), np.tile(p, 50), noise(20)]), np.concatenate([np.tile(p, 47), noise(40)])
    got = substring.shared_stretches(a, b)
    cover = [{i for s in got for i in range(s[x], s[y] + 1)} for x, y in ((0, 1), (2, 3))]
    assert cover == [set(range(30, 3030)), set(range(2820))] and len(got) <= 2
    q = p.copy()
    q[::2] = noise(30)  # half of the tokens differ: not alike, whole or in parts
    assert substring.shared_stretches(np.tile(p, 50), np.tile(q, 50)) == []


def test_edited_passages_of_frequent_lines_are_found(spark):
    """Three lines that many documents hold, side by side in two of them only, with one word changed."""
    rng = random.Random(1)
    lines = [" ".join(f"l{i}w{k}" for k in range(24)) for i in range(30)]
    rows = [(i, " ".join(" ".join([lines[j], f"u{i}x{n}"]) for n, j in enumerate(rng.sample(range(30), 12)))) for i in range(120)]
    for k in range(40):
        whole = " ".join(lines[j] for j in rng.sample(range(30), 3)).split()
        edited = whole[:]
        edited[rng.randrange(5, 67)] = f"edit{k}"
        for side, p in enumerate((whole, edited)):
            rows.append((1000 + 10 * k + side, " ".join([f"a{k}{side}x{n}" for n in range(30)] + p + [f"b{k}{side}x{n}" for n in range(30)])))
    cover = {}
    for r in substring.repeated_passages(frame(spark, rows)).collect():
        cover.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    found = sum(all(1000 + 10 * k + side in cover for side in (0, 1)) for k in range(40))
    assert found >= 36  # every pair is alike: recall of at least 0.9
    assert all(min(at) >= 30 and max(at) < 102 for i, at in cover.items() if i >= 1000)  # and nothing but the passages


def test_twins_equal_all_pairs_of_overlapping_windows():
    rng = np.random.default_rng(2)
    c = rng.integers(0, 400, 300)
    l, r = c - rng.integers(0, 60, 300), c + rng.integers(0, 60, 300)
    k, sig = rng.integers(0, 4, 300), rng.integers(0, 2**63, 300, dtype=np.uint64)
    got = sorted((int(w["sig"] & np.uint64(15)), int(w["c"]), int(w["d"]), int(w["l"]), int(w["r"])) for w in substring.twins(k, np.maximum(l, 0), c, r, sig, 20)[0])
    want = []
    for x in range(300):
        for y in range(300):
            if k[y] == (k[x] + 1) % 4 and l[x] <= c[y] <= r[x] and max(l[y], 0) <= c[x] <= r[y] and c[y] >= max(l[x], 0):
                a, b = max(l[x], l[y], 0), min(r[x], r[y])
                if b - a + 1 >= 20:
                    want.append((int(k[x]), int(c[x]), int(c[y]), int(a), int(b)))
    assert got == sorted(want) and len(got) > 50


def test_twins_of_hash_functions_that_are_no_neighbours():
    rng = np.random.default_rng(4)
    c = rng.integers(0, 400, 300)
    l, r = np.maximum(c - rng.integers(0, 60, 300), 0), c + rng.integers(0, 60, 300)
    k, sig = rng.integers(0, 4, 300), rng.integers(0, 2**63, 300, dtype=np.uint64)
    w, x, y = substring.twins(k, l, c, r, sig, 20, step=2)
    want = [(i, j) for i in range(300) for j in range(300)
            if (k[i], k[j]) in ((0, 2), (1, 3)) and l[i] <= c[j] <= r[i] and l[j] <= c[i] <= r[j] and min(r[i], r[j]) - max(l[i], l[j]) >= 19]
    assert sorted(zip(x.tolist(), y.tolist())) == want and len(want) > 50
    assert len({int(s) & 15 for s in w["sig"]} | {int(s) & 15 for s in substring.twins(k, l, c, r, sig, 20)[0]["sig"]}) == 6


def test_twins_are_made_in_bounded_memory():
    """A text that repeats itself: every window reaches to its end, so the windows to compare grow with the square."""
    import tracemalloc

    n = 3000
    k, c = np.repeat(np.arange(4), n), np.tile(np.arange(n) * 8, 4) + np.repeat(np.arange(4), n)
    l, r, sig = np.maximum(c - 7, 0), np.full(4 * n, 8 * n), np.arange(4 * n, dtype=np.uint64)
    tracemalloc.start()
    try:
        w = substring.twins(k, l, c, r, sig)[0]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(w) > 3 * n and most < 64 << 20


@pytest.mark.parametrize("few,many", [(0, 1), (0, 2), (3, 1)])
def test_a_small_and_a_large_meeting_make_a_candidate(few, many):
    """Two texts agree under one hash function alone, and under another together with seven others."""
    rows = [(1000 << 4 | many, key, 40 + key, 10, 110) for key in range(1, 10)] + [(2000 << 4 | few, key, 50 + key, 10, 110) for key in (5, 6)]
    rows += [(3000 << 4 | few, 7, 60, 10, 110)]  # and one that meets none
    batch = lambda w: [pa.RecordBatch.from_arrays([pa.array([0]), pa.array([w], pa.binary())], names=["bucket", "windows"])]
    met = [r for b in substring._meet(batch(np.array(rows, substring._WINDOW).tobytes())) for r in b.to_pylist()]
    pairs, windows = [r for r in met if r["b"] is not None], {}
    for r in met:
        if r["b"] is None:
            windows.setdefault(r["a"], []).append({"l": r["la"], "c": r["ca"], "r": r["ra"], "kind": r["cb"], "k": r["k"], "sig": r["lb"]})
    fields = pa.struct([(n, pa.int64()) for n in ("l", "c", "r", "kind", "k", "sig")])
    given = pa.RecordBatch.from_arrays([pa.array(list(windows)), pa.array(list(windows.values()), pa.list_(fields))], names=["key", "windows"])
    dealt = list(substring._deal_twins(64)([given]))
    pairs += [r for b in substring._meet_twins(iter(dealt)) for r in b.to_pylist()]
    mine = np.array([list(r.values())[2:] for r in pairs if {r["a"], r["b"]} == {5, 6}])
    assert {few, many} == set(mine[:, 0].tolist()) and len(substring.candidates(mine)) == 1


def test_pairs_of_windows_are_packed_small_and_whole():
    """A pair of windows takes few bytes on its way to the interval join, and comes out as it went in."""
    rng = np.random.default_rng(6)
    n = 20000
    a, b = np.sort(rng.integers(-(2**63), 2**63 - 1, (2, 200)), 0)[:, rng.integers(0, 200, n)]
    ca, shift = rng.integers(50, 3000, n), a % 1000  # passages of two texts mostly lie side by side
    la, ra = ca - rng.integers(0, 50, n), ca + rng.integers(0, 50, n)
    cols = [a, b, rng.integers(0, 5, n), la, ca, ra, la + shift, ca + shift, ra + shift + rng.integers(0, 2, n) * -9]
    names = ["a", "b", "k", "la", "ca", "ra", "lb", "cb", "rb"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)
    out = list(substring._pack(64, iter)([batch.slice(0, 7000), batch.slice(7000)]))
    w = substring.unpacked(out, substring._PAIR)
    m = np.stack([w[x].astype(np.int64) for x in names], 1)
    m[:, 4:6] += m[:, 3:4]
    m[:, 6:] += m[:, 3:6]
    assert sorted(map(tuple, m.tolist())) == sorted(zip(*(c.tolist() for c in cols)))
    assert sum(len(x) for part in out for x in part.column(3).to_pylist()) < 12 * n
    where = {}
    for part in out:
        for bucket, rows in zip(part.column(1).to_pylist(), range(part.num_rows)):
            for r in substring.unpacked([part.slice(rows, 1)], substring._PAIR):
                where.setdefault((int(r["a"]), int(r["b"])), set()).add(bucket)
    assert all(len(x) == 1 for x in where.values())  # all of two texts in one bucket


@pytest.mark.parametrize("far", [0, 1 << 20])
def test_candidates_are_the_same_from_either_text(far):
    """Spans of the first text that come again and again in the other one, whose windows are nearer each other there."""
    rng = np.random.default_rng(8)
    rows = []
    for at in range(0, 2000, 200):
        for k in range(4):
            for c in at + rng.integers(60, 100, 3):
                for shift in (at, 0, 300):
                    a, b = far + int(c), int(c) - at + shift
                    rows.append((k, a - 60, a, a + 60, max(0, b - 60), b, b + 60))
    m = np.array(rows)
    one, other = substring.candidates(m), substring.candidates(m[:, [0, 4, 5, 6, 1, 2, 3]])
    assert len(one) > 5 and sorted(one) == sorted((x, y, u, v) for u, v, x, y in other)


def test_only_texts_with_open_grams_are_asked_for():
    """Of two texts one has places that windows of large meetings cover under three hash functions."""
    wide = [(k, l, 60, 130, kind) for k, l, kind in ((0, 0, 1), (1, 10, 2), (2, 20, 2))]
    rows = [(7, i, *w) for i, w in enumerate(wide)] + [(8, i, *w) for i, w in enumerate(wide[:2])] + [(9, 0, 0, 0, 60, 130, 0)]
    key, sig, k, l, c, r, kind = (pa.array(x, pa.int64()) for x in zip(*rows))
    given = pa.RecordBatch.from_arrays([key, pa.nulls(len(rows), pa.int64()), k, l, c, r, sig, kind, pa.nulls(len(rows), pa.int64())], names=list("abcdefghi"))
    packed = list(substring._pack(64, iter)([given]))
    texts = [x for b in substring._by_text(packed) for x in b.to_pylist()]
    assert {x["key"]: len(x["windows"]) for x in texts} == {7: 3, 8: 2}
    assert {(w["k"], w["l"], w["c"], w["r"], w["kind"], w["sig"]) for w in texts[0]["windows"]} <= {(w[2], w[3], w[4], w[5], w[6], w[1]) for w in rows}
    spans = [x for b in substring._open_grams(packed) for x in b.to_pylist()]
    first, last = max(20, 60 - substring.SPAN + 1), min(60, 130 - substring.SPAN + 1)
    assert spans == [{"key": 7, "spans": [{"x": first, "y": last + 1, "pivot": True}]}]


def test_texts_travel_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    before = spark.conf.get(store.BATCH_CONF)
    try:
        texts = store.ship(spark).range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10000).alias("text"))
        got = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.set(store.BATCH_CONF, before)
    assert sum(got) >= 4000 * 10000 and max(got) <= store.BATCH_BYTES + (1 << 20)


def test_personal_data_stage_fits_on_all_texts(spark):
    # more than 20,000 candidates come before those of the other class
    rows = [(i, f"part 999.{i}.300.4 lot 999.{i}.301.4") for i in range(30000)] + [(30000 + i, f"please call +1 (212) {100 + i % 900}-{1000 + i} today") for i in range(3000)]
    rows += [(40000, "please call (212) 555-0187 today")]
    out = corpus_pipeline.personal_data(spark, frame(spark, rows), "")
    assert out.where("doc_id = 40000").first().text == "please call [PHONE] today"


def test_classes_that_share_too_little_are_no_pair():
    """Linked classes share three leading shingles or more, and are of like sizes; points of others are never asked for."""
    rows = {1: (100, [7, 8, 9, 50]), 2: (120, [7, 8, 9]), 3: (110, [50]), 4: (300, [7, 8, 9]), 5: (100, [60, 61, 62])}
    parts = [[np.array(t, np.uint64).tobytes() for _, t in rows.values()], [np.full(len(t), k, np.int64).tobytes() for k, (_, t) in rows.items()],
             [np.full(len(t), jaccard.size_step(n), np.uint8).tobytes() for n, t in rows.values()]]
    batch = pa.RecordBatch.from_arrays([pa.array([0] * len(rows)), *(pa.array(x, pa.binary()) for x in parts)], names=["bucket", "tokens", "keys", "steps"])
    met = [tuple(r.values()) for b in jaccard._meet(iter([batch])) for r in b.to_pylist()]
    assert sorted(met) == [(1, 2, jaccard.PAIR, 3), (1, 3, jaccard.PAIR, 1)]
    for a, b in ((3, 4), (75, 100), (1000, 1333), (1 << 20, (1 << 20) * 4 // 3)):
        assert abs(jaccard.size_step(a) - jaccard.size_step(b)) <= jaccard.APART


def test_shuffles_of_a_written_table_are_gone_when_it_is_written(spark):
    import glob
    import time

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in manager.localDirs() for f in glob.glob(f"{d}/*/shuffle_*")}
    before, conf = files(), spark.conf.get(store.CLEANUP_CONF)
    rows = store.stage(spark.range(20000).selectExpr("id % 977 AS k").repartition(5, "k").groupBy("k").count(), "test-shuffles")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert rows.count() == 977 and spark.conf.get(store.CLEANUP_CONF) == conf
