"""Ranked search against scores computed for all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("larder.llm")

from larder.llm import search  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def all_scores(docs, items, top):
    """(item_id, rank, doc_id, score) by scoring every document."""
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c, c.total()) for doc_id, c in counted if c]
    n_docs, total = len(counted), sum(c[2] for c in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, tf, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in set(terms(text)) if t in tf
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return out


def compared(spark, docs, items, top=10, **options):
    docs_df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, number string, _part int, score int").repartition(3)
    items_df = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = search.rank_documents(docs_df, items_df, top, **options)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(all_scores(docs, items, top), key=key)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)] + ["Été", "日本", "x-y", "A1"]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(n)]
    return docs, words, rng


def test_small_chunks_and_blocks_equal_all_scores(spark, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_DOCUMENTS", 40)
    monkeypatch.setattr(search, "AT_ONCE", 3)
    monkeypatch.setattr(search, "PROBES", 2)
    docs, words, rng = corpus(1, 400)
    items = [(100 + i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(12)]
    compared(spark, docs, items, block_bytes=300)


def test_nulls_ties_copies_and_long_texts(spark):
    docs, words, rng = corpus(2, 200)
    docs += [(1000 + i, "same words w1 w2 w3") for i in range(300)] + [(5, "w1 w2"), (5, "w1 w2"), (None, "w1 rare"), (None, None), (2000, None), (2001, ""), (2002, "--- !")]
    docs.append((2003, "w1 rare " * 60_000))
    items = [(1, "w1 W2 w3 same"), (1, "rare"), (2, None), (3, ""), (None, "w5 w5 w5"), (4, "never-seen"), (5, "w1 " * 40_000 + "rare")]
    compared(spark, docs, items)
    compared(spark, docs, items, top=3)


def test_empty_tables(spark):
    compared(spark, [], [(1, "a b")])
    compared(spark, [(1, "a b")], [])
    compared(spark, [(1, None)], [(1, None)])


def test_range_maximum_table():
    rng = np.random.default_rng(4)
    counts = [1, 37, 5, 64]
    row = {"ids": np.arange(64), "sizes": np.full(64, 9), "terms": np.arange(4), "counts": np.array(counts),
           "places": np.concatenate([np.sort(rng.permutation(64)[:c]) for c in counts]), "occurrences": rng.integers(1, 9, sum(counts))}
    lists = search.Postings(row, search.Statistics(64, 600, np.array([3, 50, 7, 11])))
    for start, end in lists.list_of:
        for a in range(start, end):
            for b in range(a + 1, end + 1):
                at = lists.largest(np.array([a]), np.array([b]))[0]
                assert a <= at < b and lists.impact[at] == lists.impact[a:b].max()


def test_most_intervals_stay_closed():
    """A document that holds a whole item is found by opening a small part of the others."""
    docs, words, rng = corpus(6, 3000)
    rare = [f"r{i}" for i in range(20)]
    docs = [(i, f"{text} {rare[i % 20]} {rare[i % 7]}") for i, text in docs] + [(9000 + i, " ".join(rare)) for i in range(10)]
    items = search.Items.of([1], [" ".join(rare) + " w1 w2 w3"])
    tokens = [Counter(terms(t)) for _, t in docs]
    of = search.Statistics(len(docs), sum(c.total() for c in tokens), np.full(len(items.hashes), 500))
    number = {t: i for t, i in zip(rare + ["w1", "w2", "w3"], [int(search.Items.numbers(items, w.hash, (w.end - w.start).astype(np.uint64))[0]) for x in [*rare, "w1", "w2", "w3"] for w in search.term_reader().slices(search.pa.array([x]))], strict=True)}
    pairs = sorted((number[t], i, c[t]) for i, c in enumerate(tokens) for t in c if t in number)
    used, counts = np.unique([p[0] for p in pairs], return_counts=True)
    row = {"ids": np.array([d[0] for d in docs]), "sizes": np.array([c.total() for c in tokens]), "terms": used, "counts": counts,
           "places": np.array([p[1] for p in pairs]), "occurrences": np.array([p[2] for p in pairs])}
    best = search.Best(10, (1, -search.NO_ID))
    opened = search.search(search.Postings(row, of), items.terms[0], best)
    assert sorted(-i for _, i in best.found) == list(range(9000, 9010))
    assert opened < len(docs) / 4
