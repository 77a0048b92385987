"""Decontamination against all windows, on ordinary and on templated items."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from larder.llm import contamination
from larder.llm.text import Reader


def bag(words: list[str]) -> Counter:
    n = contamination.SHINGLE
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else Counter([tuple(words)])


def brute_force(texts: dict[int, str | None], items: dict[int, str | None], least: float) -> dict:
    """The first best window of each text and item, of all windows."""
    bags = {i: (len(t.split()), bag(t.split())) for i, t in items.items() if t and t.split()}
    held = Counter(s for _, b in bags.values() for s in b)
    weight = lambda s: round(contamination.WEIGHT * (1 + math.log(len(bags) / held.get(s, 1))))
    found = {}
    for d, text in texts.items():
        words = (text or "").split()
        for i, (n, of_item) in bags.items():
            for at in range(max(1, len(words) - n + 1)) if words else ():
                if n < contamination.SHINGLE and len(words) < n:
                    continue
                own = bag(words[at : at + n])
                shared = sum(weight(s) * c for s, c in (own & of_item).items())
                value = shared / sum(weight(s) * c for s, c in (own | of_item).items())
                if value >= least and value > found.get((d, i), (0, 0))[0]:
                    found[d, i] = (value, at)
    return found


def edited(words: list[str], at: int) -> list[str]:
    return [*words[:at], "edited", *words[at + 1 :]]


def test_matches_equal_all_windows(spark):
    rng = np.random.default_rng(4)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 300, n)]
    template = draw(30)
    items = {i: " ".join(draw(int(rng.integers(12, 60)))) for i in range(30)}
    items |= {30 + i: " ".join([*template, *draw(4)]) for i in range(10)}
    items |= {40: "la " * 20 + "end", 41: "a b c", 42: " ", 43: None}
    texts = {}
    for i in range(40):
        words = items[i].split()
        texts[i] = " ".join([*draw(40), *edited(words, len(words) - 1 - int(rng.integers(4))), *draw(20)])
    texts |= {40: "x " * 30 + "la " * 20 + "end", 41: "la " * 19, 42: " ".join(draw(9)) + " a b c", 43: None, 44: "", 45: items[31] + " y" * 5000 + " " + items[31]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"]) for r in contamination.contaminated(docs, benchmark).collect()}
    expected = brute_force(texts, items, contamination.LEAST)
    assert len(expected) > 20 and found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


@pytest.mark.parametrize("size", [300, 1000, 5000])
def test_recall_on_items_of_one_template(size):
    """Items differ in their last word only; so does a window from all of them, at a similarity of about 0.82."""
    rare = 1 + math.log(size)
    template = [f"t{k}" for k in range(round(9.2 * rare) + 4)]
    items = contamination.Items.of_texts(list(range(size)), [" ".join([*template, f"rare{i}"]) for i in range(size)])
    for query in range(10):
        words = next(iter(Reader().slices(contamination.pa.array([" ".join([*template, f"other{query}"])]))))
        hashes, _ = contamination.shingles(words, contamination.SHINGLE)
        assert 0.8 <= items.similarity(query, hashes) <= 0.84
        found = contamination.window_matches(words, items, contamination.LEAST)
        assert len(found) >= 0.99 * size


def test_items_in_several_blocks_weigh_the_same(spark, monkeypatch):
    rng = np.random.default_rng(8)
    items = [(i, " ".join([*(f"t{k}" for k in range(12)), *(f"w{x}" for x in rng.integers(0, 90, 40))])) for i in range(40)]
    docs = spark.createDataFrame([(i, "before " + " ".join(edited(t.split(), 51))) for i, t in items], "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(map(tuple, contamination.contaminated(docs, benchmark).collect()))
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 4096)
    assert whole and sorted(map(tuple, contamination.contaminated(docs, benchmark).collect())) == whole
