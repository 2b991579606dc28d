"""Operators 5, 6, 8 and 9: secrets, personal data, quality rules, languages."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_CHECK, SF_SMALL
from llm_cases import WORD, corpus, frame
from pyspark.sql import functions as F

from cdcflow.llm import langid, pii, quality, secret_scan
from cdcflow.llm.queries import QUERIES
from cdcflow.llm.trees import boost, forest


def plain_signals(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


LINES = [(500, "a b\na b\n\n a b\na b\n##|"), (501, "\n\n"), (502, "the cat sat on the mat. " * 4), (503, "x y z w v x y z w v"), (504, "ü*\r\nü*\r\n")]


@pytest.mark.parametrize("clash", [False, True])
def test_quality_signals_equal_brute_force(spark, clash):
    rows = corpus() + LINES
    docs = frame(spark, rows, clash)
    labels = spark.createDataFrame([(i, 1) for i, _ in rows[:20]] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.judge(docs, labels).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        n, *rest = want = plain_signals(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 10 or 100 * rest[3] > 20 * n)
        assert not (r.kept and r.base_failed)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert quality.judge(docs.limit(0), labels).count() == 0 and quality.judge(docs, labels.limit(0)).count() == len(rows)


def test_cutoffs_hold_the_binomial_bound(spark):
    # the bound: P(X <= k) at the limit rate
    assert quality.binomial_cdf(0, 100, 0.02) == pytest.approx(0.98**100)
    assert quality.binomial_cdf(100, 100, 0.02) == pytest.approx(1)
    assert not quality.allowed(0, 50, 0.02, 0.01) and quality.allowed(0, 300, 0.02, 0.01) and not quality.allowed(20, 300, 0.02, 0.01)
    rng = random.Random(1)
    good = [(i, " ".join(f"w{rng.randrange(999)}" for _ in range(40))) for i in range(1500)]
    bad = [(5000 + i, " ".join(f"w{rng.randrange(999)}***" for _ in range(40))) for i in range(200)]
    docs = frame(spark, good + bad).withColumn("lang", F.lit("en"))
    labels = docs.select("doc_id", (F.col("doc_id") < 5000).cast("int").alias("quality"))
    out = quality.judge(docs, labels).collect()
    assert all(r.kept for r in out if r.doc_id < 5000)
    assert not any(r.kept for r in out if r.doc_id >= 5000)
    assert all("symbols_per_word" in r.failed_rules for r in out if r.doc_id >= 5000)


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and pii.luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15)]
    return sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m.group()))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    bits = ["a", "b.c", "@", "x@y.z", ".", "1", "12", "255", "256", "1.2.3.4", "+", "+1 (", ")", "-", " ", "4111 1111 1111 1111", "79927398713", "_", "%", "é", "@q.r.s", "555-123-4567", "\n", "007", "0000255"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        assert pii.find(text, None)[0] == plain_spans(text), text


def test_luhn_and_redaction():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    text = "mail a@b.co or +1 202 555 0143 now"
    base, spans = pii.find(text, None)
    assert pii.redact(text, spans) == "mail [EMAIL] or [PHONE] now"
    assert pii.redact("none", []) == "none"
    assert pii.redact("abcdef", [(0, 0, 3), (2, 1, 5)]) == "[EMAIL]f"  # overlapping spans become one


PRIVATE = [(600, "call +1 (202) 555-0143 or a.b@c.org"), (601, "at 10.0.0.1 and 10.0.0.999"), (602, "4111-1111-1111-1111"), (603, "1" * 40000), (604, "1.2." * 9000), (605, "a" * 40000 + "@"), (606, "+" + "1 " * 20000)]


@pytest.mark.parametrize("clash", [False, True])
def test_pii_scan_on_odd_tables(spark, clash):
    rows = corpus() + PRIVATE
    docs = frame(spark, rows, clash)
    got = pii.scan(docs, pii.fit(docs)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        want = plain_spans(text[r.doc_id] or "") if r.doc_id not in (603, 604, 605, 606) else None
        if want is not None:
            assert r.base_sha256 == hashlib.sha256(pii.span_text(want).encode()).hexdigest()
            assert set(filter(None, pii.span_text(want).split(","))) <= set(r.spans.split(","))
    clean = pii.redacted(docs, None)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    by = {r.doc_id: r.text for r in clean.collect()}
    assert by[600] == "call [PHONE] or [EMAIL]" and by[400] is None and by[0] == text[0]
    assert pii.scan(docs.limit(0), None).count() == 0 and pii.redacted(docs.limit(0), None).count() == 0


def test_pii_boosting_adds_spans_and_holds_its_precision(spark):
    rng = random.Random(8)
    number = lambda: f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    rows = [(i, f"please call +1 {number()} today") if i % 2 else (i, f"order {rng.randrange(10**6)} 999.{i}.300.4 part {rng.randrange(10**9, 10**11)}") for i in range(600)]
    rows += [(1000, "please call (212) 555-0187 today")]
    docs = frame(spark, rows)
    fitted = pii.fit(docs)
    assert fitted is not None
    found = {r.doc_id: r.spans for r in pii.scan(docs, fitted).collect()}
    assert "phone:12:26" in found[1000]
    score = np.array([0.9, 0.8, 0.2, 0.1] * 50)
    assert pii.threshold(score, np.array([1, 1, 0, 0] * 50)) == pytest.approx(0.8)
    assert pii.threshold(score, np.zeros(200)) is None
    assert pii.threshold(np.array([0.9, 0.8, 0.2]), np.array([50, 50, 0]), n=np.array([50, 50, 100])) == pytest.approx(0.8)


def test_pii_fits_on_the_candidates_of_all_texts(spark):
    # more than 20,000 of the first come before the others
    rows = [(i, f"part 999.{i}.300.4 lot 999.{i}.301.4") for i in range(30000)] + [(30000 + i, f"please call +1 (212) {100 + i % 900}-{1000 + i} today") for i in range(3000)]
    rows += [(40000, "please call (212) 555-0187 today")]
    docs = frame(spark, rows)
    fitted = pii.fit(docs)
    assert fitted is not None
    assert "phone:12:26" in {r.doc_id: r.spans for r in pii.scan(docs, fitted).where("doc_id = 40000").collect()}[40000]
    by_tasks = pii.fit(docs, local=0)  # sums of the tasks, not of the driver
    assert by_tasks[1] == fitted[1] and all((a.value == b.value).all() and (a.feature == b.feature).all() for a, b in zip(fitted[0].trees, by_tasks[0].trees))


def test_pii_candidates_near_base_matches():
    text = "call +1 (202) 555-0143 or 999.1.2.3 (212) 555-0187 4111 1111 1111 1111"
    base = [(a, b, good) for _, a, b, good in pii.base_matches(text)]
    want = list(base)
    for _, a, b in pii.proposals(text):
        if near := [good for c, d, good in base if c < b and a < d]:
            want.append((a, b, any(near)))
    assert sorted(pii.labelled(text)) == sorted(want) and len(want) > len(base)


def test_language_accuracy_on_held_out_rows(spark):
    rows = QUERIES["op9_language_id"](spark, SF_CHECK).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("clash", [False, True])
def test_language_of_odd_rows(spark, clash):
    rows = corpus() + [(700, "123 456 !!!"), (701, "日本語"), (702, "É")]
    docs = frame(spark, rows, clash)
    model = langid.fit(docs, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in langid.identify(docs, model, F.col("doc_id")).collect()}
    text = dict(rows)
    for i, r in got.items():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[i] or "")), i
    assert langid.identify(docs.limit(0), model, F.col("doc_id")).count() == 0
    nothing = langid.fit(docs.limit(0), F.lit(True))
    assert nothing is None and {r.lang_pred for r in langid.identify(docs, nothing, F.col("doc_id")).collect()} == {"und"}


def test_secrets_found_and_false_positives_removed(spark):
    rows = QUERIES["op5_secret_scan"](spark, SF_CHECK).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    rule = re.compile(r'AKIA[A-Z0-9]{16}|(?<=token = ")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}')
    truth = {(i, m.start(), m.end()) for i, t in docs.items() for m in rule.finditer(t or "")}
    got = {(r.doc_id, r.start, r.end) for r in rows if r.secret}
    assert truth and truth <= got
    assert len(got - truth) <= 0.2 * len(truth) + 2 and len(got) < len(rows)


@pytest.mark.parametrize("clash", [False, True])
def test_secret_scan_on_odd_tables(spark, clash):
    rows = corpus() + [(800, 'token = "0641917ea4e9feb9cda83477b57ac2654884f485"'), (801, "AKIA" + "A" * 16), (802, "id 2024-01-01T00:00:00 ok"), (803, "1" * 60000), (804, "=" * 60000)]
    docs = frame(spark, rows, clash)
    scanner = secret_scan.fit(docs)
    got = secret_scan.scan(docs, scanner).collect()
    assert {800, 801} <= {r.doc_id for r in got if r.secret}
    assert secret_scan.scan(docs.limit(0), scanner).count() == 0 and secret_scan.fit(docs.limit(0)) is None
    everything = secret_scan.scan(docs, None).collect()
    assert all(r.secret and r.score is None for r in everything) and len(everything) == len(got)
    rng = random.Random(3)
    more = frame(spark, [(i, f"key = {rng.getrandbits(128):032x} end" if i % 2 else f"on 2024-01-{i % 28 + 1:02d}T00:00:00 we") for i in range(60)], clash)
    spans = [(r.doc_id, r.start, r.end, r.doc_id % 2 == 1) for r in secret_scan.scan(more, None).collect()]
    labelled = spark.createDataFrame(spans + [(None, 1, 2, True), (1, 0, 10**6, True), (2, 0, 2, None)], "doc_id long, start long, end long, secret boolean")
    own = secret_scan.fit(more, labelled)
    assert own is not None
    assert {r.doc_id for r in secret_scan.scan(more, own).collect() if r.secret} == set(range(1, 60, 2))


def test_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    for model in (boost(x[:1500], y[:1500]), forest(x[:1500], y[:1500])):
        p = model.score(x[1500:])
        assert ((p > 0.5) == (y[1500:] > 0)).mean() > 0.95 and p.min() >= 0 and p.max() <= 1
        assert len(model.score(np.zeros((0, 4)))) == 0


def test_filters_on_the_smallest_tables(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op6_pii", "op8_quality_rules", "op9_language_id"):
        assert Counter(r.doc_id for r in QUERIES[name](spark, SF_SMALL).collect()).total() == n
