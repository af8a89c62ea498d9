"""Periodic runs against the word-by-word recurrence over all earlier occurrences."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from supplycast.llm.frames import table
from supplycast.llm.periodic_runs import periodic_runs, runs_of_words
from supplycast.llm.queries import QUERIES, looped

WORD = re.compile(r"[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, runs string, collapsed int, start long"


def brute_runs(words):
    """Each word raises the match lengths of all lags to its earlier occurrences."""
    active, seen, found = {}, {}, set()
    for i, word in enumerate([*words, None]):
        earlier = seen.get(word, ()) if i < len(words) else ()
        now = {i - j: active.get(i - j, 0) + 1 for j in earlier}
        ended = {}
        for lag, matches in active.items():
            if lag not in now and matches + lag >= max(6, 4 * lag):
                ended[i - matches - lag] = min(lag, ended.get(i - matches - lag, lag))
        found |= {(start, i - start, lag) for start, lag in ended.items()}
        active = now
        seen.setdefault(word, []).append(i)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_row(doc, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc is not None and n and (h := zlib.crc32(str(doc).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        digest(collapse(words, runs)),
    )


def test_random_words_match_the_recurrence():
    rng = np.random.default_rng(5)
    for _ in range(600):
        docs = []
        for _ in range(rng.integers(1, 4)):
            blocks = [
                np.tile(rng.integers(0, rng.integers(1, 4), rng.integers(1, 9)), rng.integers(1, 7))
                for _ in range(rng.integers(0, 5))
            ]
            docs.append([int(x) for b in blocks for x in b])
        bounds = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        words = np.array([x for d in docs for x in d], dtype=np.uint64)
        got = list(zip(*(x.tolist() for x in runs_of_words(words, bounds)), strict=True))
        want = [
            (s + int(b), n, q) for d, b in zip(docs, bounds, strict=False) for s, n, q in brute_runs(d)
        ]
        assert got == sorted(want, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("block", [1, 2, 3, 5, 16, 17, 50, 333])
def test_each_period_at_the_limit(block):
    """Four copies are a run, one word fewer is none; words around it change nothing."""
    inner = [f"w{i}" for i in range(block)] * 6
    for n, expected in ((max(6, 4 * block), 1), (max(6, 4 * block) - 1, 0)):
        words = ["left", *inner[:n], "right"]
        values = np.unique(words, return_inverse=True)[1].astype(np.uint64)
        starts, lengths, periods = runs_of_words(values, np.array([0, len(words)]))
        assert [len(starts), *lengths, *periods] == [expected, *[n, block][: 2 * expected]]


AWKWARD = [
    (1, "a a a a a a", "x", 1, 1),
    (1, "a a a a a a", "x", 1, 1),
    (2, None, None, None, None),
    (3, "", "x", 1, 1),
    (4, " \t\r\n\x0b\x0c ", "x", 1, 1),
    (None, "b c " * 9 + "b", "x", 1, 1),
    (5, "é è " * 7, "x", 1, 1),
    (6, "a " * 30_000 + "end", "x", 1, 1),
    (7, " ".join(f"u{i}" for i in range(20_000)), "x", 1, 1),
    (8, "x" * 300_000 + " y y y y y y y", "x", 1, 1),
    *((i, " ".join(f"k{j % 7}" for j in range(i)), "x", 1, 1) for i in range(20, 80)),
]


def test_awkward_rows(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS)
    rows = docs.withColumn("r", periodic_runs()).select("text", "r.*").collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        words = WORD.findall(row[0] or "")
        if len(words) > 20_000:
            runs = [(0, 30_000, 1)]
        else:
            runs = brute_runs(words)
        assert [tuple(r) for r in row.runs] == runs
        assert row.collapsed == collapse(words, runs)
    assert spark.createDataFrame([], DOCS).select(periodic_runs()).collect() == []


def test_looped_text_is_the_stated_one(spark):
    rows = [(i, f"{i} a b  c\td e f g h i j k" if i % 3 else None) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, "a a"), (30, "")], "doc_id long, text string")
    for doc, text, made in docs.select("doc_id", "text", looped().alias("made")).collect():
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc).encode())
        if doc is None or h % 10 or not words:
            assert made == text
        else:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert made.split(" ") == [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark, small):
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, small).collect())
    docs = table(spark, small, "documents").select("doc_id", "text").collect()
    assert got == sorted(brute_row(d, t) for d, t in docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert found.select(F.count("*")).first()[0] == 0
    assert found.columns[:3] == ["doc_id", "n_runs", "start"]
