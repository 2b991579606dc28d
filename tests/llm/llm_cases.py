"""Small tables that every operator has to take, and plain versions to compare with."""

import random
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# columns whose names operators use inside
CLASH = ["key", "n", "row", "stratum", "label", "part", "tile", "rate", "copies", "pair", "score", "shard", "clean", "n_words", "v", "path"]


def prose(rng, n, vocabulary=800):
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("," if rng.random() < 0.1 else "") for _ in range(n))


def corpus(seed=3):
    """``(doc_id, text)``: copies, near copies, shared passages, short, blank, null and long texts."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(60, 220)) for _ in range(24)]
    rows = list(enumerate(texts))
    for base in (0, 1, 2):
        words = texts[base].split(" ")
        for k in range(6):
            w = words[:]
            for _ in range(1 + k * 2):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((100 + base * 10 + k, " ".join(w)))
    for k in range(30):  # a large group of copies, in either case
        rows.append((200 + k, texts[3] if k % 2 else texts[3].upper()))
    passage = prose(rng, 70, 10**6)
    for k in range(12):
        rows.append((300 + k, prose(rng, 80) + " " + passage + " " + prose(rng, 40)))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one two"), (404, "One two"), (405, "one two three four five"), (406, "é " * 3000), (407, prose(rng, 20000)),
             (408, "x" * 50000), (7, texts[7]), (409, "😀 " * 7)]
    return rows


def frame(spark, rows, clash=False, lang="en"):
    data = [(i, t, lang if (i or 0) % 2 else None, f"src{(i or 0) % 3}", len(t) if t else None) for i, t in rows]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(None if k % 2 else "z").cast("string").alias(c) for k, c in enumerate(CLASH)])
    return df


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_components(rows):
    """``doc_id -> (set size, component)`` by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = defaultdict(int)
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}
