"""Operators on small tables of hard cases: nulls, empty and long texts, ties, repeated rows, extra columns."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from larder.llm import contamination, lm, mixing, near_dup, quality, rules, secrets, sharding, toxicity
from larder.llm.components import components
from larder.llm.lines import fuzzy_lines
from larder.llm.text import Reader, shingles
from larder.llm.training import train_fold

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id int, word string, bucket string"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


BASE = prose(1, 200)
NEAR = BASE.replace(BASE.split()[100], "changed", 1)
CASES = [
    (0, BASE, "en", "a"),
    (1, BASE, "en", "a"),
    (2, BASE.upper(), "en", "b"),
    (3, NEAR, None, None),
    (4, None, "en", "a"),
    (5, "", "en", "a"),
    (6, " \t\n", "xx", "b"),
    (7, "single", "en", "b"),
    (8, "single", None, "b"),
    (9, prose(2, 30000), "en", "b"),
    (10, "é" * 50 + " password=abcdef12 " + "0123456789abcdef01234567", "en", "b"),
    (None, BASE, "en", "a"),
    (11, prose(3, 80), "en", "a"),
    (11, prose(3, 80), "en", "a"),
    (12, prose(4, 90) + "\n" + prose(5, 20), "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, la, so, len(t or ""), 1, "x", "y") for i, t, la, so in CASES]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_words_are_ascii_blank_runs():
    texts = ["A b\x0bC", None, "", "x\x85y 　z", "a b c"]
    found = [[w.word(i) for i in range(w.first[r], w.first[r + 1])] for w in Reader().slices(pa.array(texts)) for r in range(5)]
    assert found == [["a", "b", "c"], [], [], ["x\x85y", "　z"], ["a", "b", "c"]]


def test_words_do_not_depend_on_slices():
    texts = [prose(i, 50) for i in range(20)]
    whole = next(Reader().slices(pa.array(texts)))
    cut = np.concatenate([w.hash for w in Reader().slices(pa.array(texts), 100)])
    assert (whole.hash == cut).all() and len(set(whole.hash.tolist())) == len(set(" ".join(texts).split()))


def test_short_texts_are_one_shingle():
    words = next(Reader().slices(pa.array(["a b", "a b", "b a", "", "a b c"])))
    hashes, first = shingles(words, 3)
    assert np.diff(first).tolist() == [1, 1, 1, 0, 1]
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == 3


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(7000, 7000), (None, 3)]
    found = dict(components(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 7000: 7000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_components(rows, size, percent=80):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        grams = frozenset(tuple(words[j : j + size]) for j in range(len(words) - size + 1)) if len(words) >= size else None
        sets[i] = grams if grams is not None else frozenset([tuple(words)] if words else [])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sets if sets[i]]
    for x in ids:
        for y in ids:
            n = len(sets[x] & sets[y])
            if x < y and 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, docs, size):
    rows = [(i, t) for i, t, _, _ in CASES if i is not None]
    rng = np.random.default_rng(9)
    for k in range(60):  # a large group of near copies, some of them apart from most others
        words = BASE.split()
        for at in rng.choice(200, rng.integers(1, 14), replace=False):
            words[at] = f"edit{k}x{at}"
        rows.append((1000 + k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(frame, shingle_words=size).collect()}
    assert found == brute_components(rows, size)


def test_near_duplicates_hard_rows(docs, none):
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(CASES)
    unnamed = [r for r in rows if r["doc_id"] is None]
    assert [(r["component_id"], r["kept"]) for r in unnamed] == [(None, True)]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)
    assert near_dup.near_duplicates(none).count() == 0


def test_circulant_signature_estimates_similarity():
    table = near_dup.permutation_table(512)
    rng = np.random.default_rng(0)
    pool = rng.choice(near_dup.UNIVERSE, 300, replace=False)
    a, b = pool[:250], pool[50:]
    same = (near_dup.signature(a, table) == near_dup.signature(b, table)).mean()
    assert abs(same - 200 / 300) < 0.1


def test_secrets_equal_brute_force_and_ledger_skips_seen(spark, docs, none, tmp_path):
    versions = docs.selectExpr("doc_id AS path", "text")
    found = secrets.scan_secrets(versions, str(tmp_path / "ledger")).collect()
    texts = collections.Counter((i, t) for i, t, _, _ in CASES)
    assert len(found) == len(CASES)
    for row in found:
        counts = secrets.brute_force(dict(texts.keys()).get(row["path"]))[:3]
        kinds = collections.Counter(f["kind"] for f in row["found"])
        assert tuple(kinds[k] for k in ("assign", "access", "hex")) == counts
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.update(versions).count() == 0
    newer = (*secrets.RULES[:-1], secrets.Rule("hub_token", 2, rb"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, b"gh"))
    assert {r["rule"] for r in ledger.update(versions, newer).collect()} == {"hub_token@2"}
    more = versions.union(spark.createDataFrame([(99, "token: zzzzzzz")], "path bigint, text string"))
    assert {r["blob"] for r in ledger.update(more, newer).collect()} == {r["blob"] for r in ledger.report(more).filter("path = 99").collect()}
    assert secrets.scan_secrets(none.selectExpr("doc_id AS path", "text"), str(tmp_path / "other")).count() == 0


def test_secret_places_are_code_points():
    text = "é" * 7 + 'Api_Key" : "abc.def" AKIA' + "A" * 16 + " KEY token=short"
    hits = secrets.find(text.encode(), secrets.BASE_RULES, [re.compile(r.pattern) for r in secrets.BASE_RULES])
    assert {(k, text[s:e]) for k, _, s, e in hits} == {("assign", 'Api_Key" : "abc.def'), ("access", "AKIA" + "A" * 16)}


def labels_for(spark, texts_labels):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts_labels)], "doc_id bigint, text string")
    marks = [(i, y, y) for i, (_, y) in enumerate(texts_labels)] + [(None, 1, 1), (5, None, None), (10**9, 1, 0)]
    return docs, spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def held_out_accuracy(scored, texts_labels, parts, fold):
    rows = [(r["score"] >= 0.3, texts_labels[r["doc_id"]][1]) for r in scored.collect()]
    kept = [zlib.crc32(str(i).encode()) % parts == fold for i in range(len(rows))]
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    return np.mean([(p == bool(y)) for (p, y), k in zip(rows, kept) if k])


def test_quality_ranks_held_out_texts(spark, docs, none):
    data = [(prose(i, 60) if i % 3 else " ".join(w.upper() + "###" for w in prose(i, 60).split()), int(i % 3 > 0)) for i in range(300)]
    frame, marks = labels_for(spark, data)
    model = quality.learn(frame, marks, train_fold(5, 0))
    assert held_out_accuracy(quality.score_quality(frame, model), data, 5, 0) > 0.95
    hard = quality.score_quality(docs, model)
    assert hard.count() == len(CASES) and hard.filter("score IS NULL").count() == 0
    assert quality.score_quality(none, model).count() == 0
    nothing = quality.learn(frame, marks.limit(0), train_fold(5, 0))
    assert quality.score_quality(frame, nothing).filter("score >= 0.3").count() == len(data)


def test_quality_learns_from_every_training_row(spark):
    """More rows of each label than the old bound of 6000: the cut is the strength below which lie exactly the bad rows."""
    rng = np.random.default_rng(7)
    data = [(prose(i, int(rng.integers(3, 40))) if i % 2 else " ".join(w.upper() + "#" * int(rng.integers(0, 4)) for w in prose(i, int(rng.integers(3, 40))).split()), i % 2)
            for i in range(16000)]
    frame, marks = labels_for(spark, data)
    model = quality.learn(frame, marks, train_fold(5, 0))
    train = [(t, y) for i, (t, y) in enumerate(data) if zlib.crc32(str(i).encode()) % 5 != 0]
    batch = pa.RecordBatch.from_arrays([pa.array([y for _, y in train], pa.int32()), pa.array([t for t, _ in train])], names=["label", "text"])
    x = np.array([r for b in quality._extract(iter([batch])) for r in b.column(1).to_pylist()], float)
    strengths = np.sort(model.strengths(x))
    bad = sum(1 for _, y in train if y == 0)
    assert model.cut == pytest.approx(strengths[bad - 1], abs=1e-9)


def test_toxicity_ranks_held_out_texts(spark, docs, none):
    bad = ["vile", "wretch", "oaf", "vilest"]
    rng = np.random.default_rng(4)
    data = []
    for i in range(400):
        words = prose(i, 60).split()
        if i % 5 == 0:
            for at in rng.choice(60, 4, replace=False):
                words[at] = bad[rng.integers(4)]
        data.append((" ".join(words), int(i % 5 == 0)))
    frame, marks = labels_for(spark, data)
    scorer = toxicity.learn(frame, marks, train_fold(4, 2))
    assert held_out_accuracy(toxicity.score_toxicity(frame, scorer), data, 4, 2) > 0.95
    hard = toxicity.score_toxicity(docs, scorer)
    assert hard.count() == len(CASES) and hard.filter("score IS NULL OR isnan(score)").count() == 0
    assert toxicity.score_toxicity(none, scorer).count() == 0
    nothing = toxicity.learn(frame, marks.limit(0), train_fold(4, 2))
    assert toxicity.score_toxicity(frame, nothing).filter("score IS NULL OR isnan(score)").count() == 0


def test_toxicity_learns_from_every_training_row(spark):
    """More rows of each label than the old bound of 6000: the weights are the fit on every held training row."""
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from larder.llm.training import logistic

    bad = ["vile", "wretch", "oaf", "vilest"]
    rng = np.random.default_rng(9)
    data = []
    for i in range(17000):
        words = prose(i, int(rng.integers(5, 30))).split()
        if i % 2 and rng.random() < 0.9:
            words[int(rng.integers(len(words)))] = bad[int(rng.integers(4))]
        data.append((" ".join(words), i % 2))
    frame, marks = labels_for(spark, data)
    scorer = toxicity.learn(frame, marks, train_fold(4, 2))
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("part")), F.lit(toxicity.CALIBRATION_PARTS))
    held = {r[0] for r in frame.filter(train_fold(4, 2)).filter(part == 0).select("doc_id").collect()}
    rows = [(data[i][1], data[i][0]) for i in sorted(held)]
    batch = pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int32()), pa.array([t for _, t in rows])], names=["label", "text"])
    x = np.array([r for b in toxicity._extract(SimpleNamespace(value=scorer.model))(iter([batch])) for r in b.column(1).to_pylist()], float)
    y = np.array([y for y, _ in rows], float)
    train = [y for i, (_, y) in enumerate(data) if zlib.crc32(str(i).encode()) % 4 != 2]
    # of the extra marks only that of id 10**9, label 0, counts, if its id is in the training fold
    counts = {0: train.count(0) + int(zlib.crc32(str(10**9).encode()) % 4 != 2), 1: train.count(1)}
    share = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    expected = logistic(x, y, share * len(y) / share.sum(), ridge=0.1)
    assert min(counts.values()) > 6000
    assert scorer.weights == pytest.approx(expected, rel=1e-6, abs=1e-6)


def test_language_model_counts_and_normalises(docs, none):
    learn = (docs["doc_id"] % 2 == 0)
    rows = lm.score_texts(docs, learn).collect()
    counts = collections.Counter()
    for i, text, _, _ in CASES:
        if i is not None and i % 2 == 0:
            counts.update([*(text or "").encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    expected = collections.Counter()
    for i, text, _, _ in CASES:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        expected[i, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 5)] += 1
    found = collections.Counter(
        (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows
    )
    assert found == expected and all(r["score"] < 0 for r in rows)
    assert lm.score_texts(none, learn).count() == 0
    untaught = lm.score_texts(docs, docs["doc_id"] < -1).collect()
    assert len(untaught) == len(CASES) and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in untaught)


def test_language_model_probabilities_sum_to_one():
    model = lm.LogBilinear(6, np.full(8, 1 / 8))
    one, two, token = np.full(8, 3), np.full(8, 2), np.arange(8)
    assert abs((10 ** model.log10_probabilities(token, one, two)).sum() - 1) < 1e-5


def test_noise_contrastive_training_learns_a_cycle():
    words = ["a", "b", "c", "d"] * 500
    slices = [next(Reader().slices(pa.array([" ".join(words)])))]
    hashes = np.unique(slices[0].hash)
    counts = lm.Counts(2001, 5, 1, hashes, np.full(4, 500), np.arange(4), 4, 0)
    model = lm.LogBilinear(4, counts.unigram())
    trainer = lm.Trainer(model, 0)
    for _ in range(300):
        trainer.texts(slices[0], counts)
    token, one, two, _, _ = lm.tokens(slices[0], counts)
    assert 10 ** model.log10_probabilities(token, one, two)[2:-1].mean() > 0.9


def test_rules_equal_brute_force(docs, none):
    rows = rules.quality_rules(docs).collect()
    expected = collections.Counter()
    for i, text, _, _ in CASES:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        seen, places = collections.Counter(zip(words, words[1:], words[2:])), set()
        for at, window in enumerate(zip(words, words[1:], words[2:])):
            if seen[window] > 1:
                places |= {at, at + 1, at + 2}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, repeated = len(words), len(places)
        failed = n < 50 or 100 * repeated > 50 * n
        symbols = sum(c in "#*$%&|<>" for c in text)
        expected[i, n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collections.Counter(tuple(r[c] for c in names) for r in rows) == expected
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert rules.quality_rules(none).count() == 0


def test_divergent_text_is_rejected_and_usual_text_kept(spark):
    rows = [(i, prose(i, 80), "en") for i in range(40)] + [(99, " ".join("%%%&&&" for _ in range(10)) + prose(3, 60).upper(), "en")]
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not kept.pop(99) and all(kept.values())


def test_shards_are_permutations_that_grow_in_place(docs, none, spark):
    rows = sharding.shard_records(docs, shards=3, bucket_bytes=500).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in rows) == collections.Counter((i, t) for i, t, _, _ in CASES)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(docs.columns) < set(rows[0].asDict())
    assert sharding.shard_records(none).count() == 0
    ids = spark.range(2000)
    grown = ids.select(sharding.shard_of(ids["id"], 8).alias("a"), sharding.shard_of(ids["id"], 9).alias("b")).collect()
    assert all(r["b"] in (r["a"], 8) for r in grown) and 100 < sum(r["b"] == 8 for r in grown) < 400
    again = sharding.shard_records(docs, shards=3, bucket_bytes=500).collect()
    place = lambda found: sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in found)
    assert place(again) == place(rows)


def test_benchmark_passages_are_found_and_others_not(spark, docs, none):
    items = [(1, prose(50, 40)), (2, "two words"), (3, None), (4, ""), (5, prose(51, 25)), (1, prose(50, 40))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [
        (100, prose(60, 300) + " " + items[0][1].upper() + "\n" + prose(61, 300)),
        (101, "start Two\tWords end"),
        (102, prose(62, 100) + " " + " ".join(items[4][1].split()[:12]) + " " + prose(63, 100)),
        (103, items[4][1]),
        (None, items[4][1]),
    ]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = contamination.contaminated(frame, benchmark).collect()
    assert collections.Counter((r["doc_id"], r["item_id"]) for r in found) == {(100, 1): 2, (101, 2): 1, (103, 5): 1, (None, 5): 1}
    assert all(r["similarity"] == 1 and r["hamming"] == 0 for r in found)
    assert {r["first_word"] for r in found if r["doc_id"] == 100} == {300}
    assert contamination.contaminated(docs, benchmark).count() == 0
    assert contamination.contaminated(none, benchmark).count() == 0
    assert contamination.contaminated(frame, benchmark.limit(0)).count() == 0


def test_every_fingerprint_within_the_radius_is_a_candidate():
    items = contamination.Items.of_texts(list(range(200)), [prose(i, 40) for i in range(200)])
    rng = np.random.default_rng(2)
    for item in range(0, 200, 10):
        flips = rng.choice(64, contamination.RADIUS, replace=False)
        other = items.prints[item] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        _, found = items.candidates(40, np.array([other]))
        assert item in found


def test_mixing_repeats_by_poisson_counts(spark, docs, none):
    rows = mixing.mix_sources(docs).collect()
    ids = {(i, t) for i, t, _, _ in CASES}
    assert {(r["doc_id"], r["text"]) for r in rows} <= ids and set(rows[0].asDict()) == {*docs.columns, "copy"}
    assert mixing.mix_sources(none).count() == 0
    many = spark.range(20000).selectExpr("id AS doc_id", "IF(id % 10 = 0, 'rare', 'usual') AS source")
    mixed = mixing.mix_sources(many, {"rare": 0.5, "usual": 0.5}).groupBy("source").count().collect()
    assert all(abs(r["count"] - 10000) < 500 for r in mixed)
    lots = mixing.mix_sources(many.filter("doc_id < 50"), {"rare": 1.0}, size=20.0).groupBy("doc_id").count().collect()
    assert len(lots) == 5 and abs(sum(r["count"] for r in lots) - 1000) < 150


def test_poisson_inversion_is_exact(spark):
    for mean in (0.3, 1.0, 7.5, 16.0):
        us = [k / 50 for k in range(50)]
        frame = spark.createDataFrame([(u,) for u in us], "u double")
        from pyspark.sql import functions as F

        found = [r["k"] for r in frame.select(mixing.poisson(F.col("u"), F.lit(mean)).alias("k")).collect()]
        expected = []
        for u in us:
            k, p = 0, math.exp(-mean)
            below = p
            while u >= below:
                k += 1
                p *= mean / k
                below += p
            expected.append(k)
        assert found == expected


def test_fuzzy_lines_keep_one_of_each_group(spark, docs, none):
    line, other = prose(70, 30), prose(71, 30)
    near = line.replace("w", "v", 1)
    rows = [
        (1, f"{line}\n\n{other}"), (2, f"  {line}\t\nown words here"), (3, near), (4, "x\nx\n \nx"), (5, None), (6, ""),
        (None, line), (7, prose(72, 40) + "\n" + "p" * 5000),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in fuzzy_lines(frame).collect()}
    assert found[1] == (rows[0][1], 2, 0)
    assert found[2] == ("own words here", 2, 1)
    assert found[3] == ("", 1, 1)
    assert found[4] == ("x\n ", 3, 2)
    assert found[5] == (None, 0, 0) and found[6] == ("", 0, 0) and found[None] == (line, 1, 0)
    assert found[7][2] == 0
    assert fuzzy_lines(docs).count() == len(CASES) and fuzzy_lines(none).count() == 0


def test_texts_of_another_language_and_without_common_words_are_rejected(spark):
    def text(seed: int, common: str) -> str:
        rng = np.random.default_rng(seed)
        return " ".join(rng.choice(common.split()) if rng.random() < 0.3 else rng.choice(WORDS) for _ in range(150))

    en, de = "the of and to in that is was for it", "der die und das von den zu mit sich des"
    rows = [(i, text(i, en), "en") for i in range(60)] + [(100 + i, text(i, de), "de") for i in range(30)]
    rows += [(i, prose(i, 100), "xx") for i in range(200, 230)] + [(900, text(900, de), "en"), (901, prose(901, 150), "en")]
    found = rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == {900, 901}
    assert all(r["word_distance"] is None for r in found if 200 <= r["doc_id"] < 230)


def test_texts_of_one_id_share_its_component(spark):
    a, b = prose(90, 40), prose(91, 40)
    for other in (5, 8):  # an id that is the least of one class, or of none
        rows = [(3, a), (other, a), (other, b), (7, b), (9, prose(92, 40))]
        found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in found) == {
            (3, 3, True): 1, (other, 3, False): 2, (7, 3, False): 1, (9, 9, True): 1,
        }


def test_documents_shorter_than_an_item_are_found(spark):
    words = prose(80, 55).split()
    rows = [(k, " ".join(words[:-k] if k % 2 else words[k:])) for k in (1, 2, 3, 4, 5, 20)] + [(99, " ".join(words[:4]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    found = {r["doc_id"]: (r["n_words"], r["first_word"], r["similarity"]) for r in contamination.contaminated(frame, benchmark).collect()}
    assert found == {k: (55 - k, 0, (51 - k) / 51) for k in (1, 2, 3, 4, 5)}


def test_toxicity_learn_stores_no_copy_of_texts(spark, monkeypatch):
    """Texts are read where they lie: nothing that learn writes to the shared folder holds a text (F op2 disk)."""
    written = []
    real = toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df: (written.append(df.columns), real(df))[1])
    data = [(prose(i, 12) + (" vile" if i % 2 else ""), i % 2) for i in range(400)]
    frame, marks = labels_for(spark, data)
    scorer = toxicity.learn(frame, marks, train_fold(4, 2))
    assert written and all("text" not in columns for columns in written)
    assert held_out_accuracy(toxicity.score_toxicity(frame, scorer), data, 4, 2) > 0.9


def test_toxicity_counts_every_pair_and_word_by_itself(spark):
    """No two pairs share a slot and no two words a count: each keeps its own (F2)."""
    rng = np.random.default_rng(4)
    texts = [(i % 2, [int(x) for x in rng.integers(0, 300_000, 12)]) for i in range(3000)]
    rows = [(y, " ".join(f"w{x}" for x in words)) for y, words in texts for _ in range(2)]  # each pair has something left
    rows += [(1, "w7 w8"), (0, "w9 w8")]
    batch = pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows]), pa.array([t for _, t in rows])], names=["label", "text"])
    found = collections.defaultdict(lambda: [0, 0])
    for y, text in rows:
        split = text.split()
        for pair in set(zip([None, *split], split)):
            found[pair][y] += 1
    counted = spark.createDataFrame(pa.Table.from_batches(list(toxicity._count(iter([batch])))))
    model = toxicity.fit_counts(counted)
    known = {pair: n for pair, n in found.items() if max(n) > 1}
    assert len(model.joint) == len(known) and len(model.pairs[0]) == len(known) + 1
    sums = [sum(max(n[k] - 1, 0) for n in known.values()) for k in (0, 1)]
    assert model.pairs.sum(axis=1).tolist() == sums
    several = collections.defaultdict(lambda: [0, 0])
    for (_, word), n in found.items():
        for k in (0, 1):
            several[word][k] += n[k]
    assert len(model.keys) == sum(max(n) > 1 for n in several.values()) + 1
    # One text's ratios by the formulas of the model, from the counts of every pair, word and beginning.
    text = rows[0][1] + " w8 unseen"
    totals = [sum(n[k] for n in several.values()) for k in (0, 1)]
    begun = collections.defaultdict(lambda: [0, 0])
    for y, other in rows:
        for opening in {w[:4] for w in other.split()}:
            begun[opening][y] += 1
    contexts = collections.Counter(word for _, word in found)
    general_sum = sum(sum(n) + 0.5 for n in begun.values()) + 0.5
    shared_sum = sum(contexts.values()) + 0.5 * (len(contexts) + 1)
    expected, before = [], None
    for word in text.split():
        p, general = [], (sum(begun.get(word[:4], [0, 0])) + 0.5) / general_sum
        shared = (contexts[word] + 0.5) / shared_sum
        for k in (0, 1):
            begun_total = sum(n[k] for n in begun.values())
            freed_begun = 1 - sum(max(n[k] - 1, 0) for n in begun.values()) / begun_total
            start = max(begun.get(word[:4], [0, 0])[k] - 1, 0) / begun_total + freed_begun * general
            freed = 1 - sum(max(n[k] - 1, 0) for n in several.values()) / totals[k]
            single = max(several.get(word, [0, 0])[k] - 1, 0) / totals[k] + freed * start * shared / max(general, shared)
            following = [n[k] for pair, n in found.items() if pair[0] == before]
            kept, after = sum(max(n - 1, 0) for n in following), max(sum(following), 1)
            own = max(found.get((before, word), [0, 0])[k] - 1, 0) / after
            p.append(own + (1 - kept / after) * single)
        expected.append(math.log(p[1]) - math.log(p[0]))
        before = word
    ratios = model.log_ratios(next(Reader().slices(pa.array([text]))))
    assert ratios == pytest.approx(expected, rel=1e-3, abs=1e-3)


def test_language_model_vocabulary_grows_with_the_corpus(spark):
    """Every word of so many occurrences has vectors of its own, and its probability depends on its context (F3)."""
    n = 1300
    words = [f"w{i}" for i in range(n)]  # all equally frequent; each always follows the same one
    text = " ".join(words)
    rows = [(i, text) for i in range(2 * lm.FREQUENT)] + [(10**6, " ".join(f"rare{i}" for i in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table, counts = lm.count_words(docs.select("text"))
    assert counts.vocabulary == n and counts.rest == 40 and table.count() == n + 40 and len(counts.hashes) == n + 40
    model = lm.train(docs.select(docs["doc_id"].alias("id"), "text"), counts)
    assert model.entries == n + 3
    size = counts.vocabulary + 2
    outputs = np.arange(size)
    for one, two in ((size, size), (3, 700), (n, 5), (1200, 1199)):
        logs = model.log10_probabilities(outputs, np.full(size, one), np.full(size, two))
        assert (10**logs).sum() == pytest.approx(1, abs=1e-4)
    trainer = lm.Trainer(model, 0)
    slices = list(Reader().slices(pa.array([text])))
    for _ in range(150):
        trainer.texts(slices[0], counts)
    token, one, two, _, _ = lm.tokens(slices[0], counts)
    right = model.log10_probabilities(token, one, two)[2:-1].mean()
    wrong = model.log10_probabilities(np.roll(token[:-1], 600), one[:-1], two[:-1])[2:].mean()
    assert right > wrong + 2 and right > -math.log10(n) + 1


def test_language_model_averages_rows_by_how_often_they_were_met():
    rows = [(0, [0, 512], [1, 2], 1), (1, [1], [1], 4), (1, [1, 257], [2, 1], 7), (3, [3], [3], 5)]
    values = [
        (b, np.array(e, np.uint32).tobytes(), np.array(w, np.float32).tobytes(), np.full((len(e), lm.WIDTH + 1), v, np.float16).tobytes())
        for b, e, w, v in rows
    ]
    batches = [pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["bucket", "entries", "weights", "changes"]) for row in values]
    found = {}
    for batch in lm._averaged(iter(batches)):
        for entries, mean in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found |= zip(np.frombuffer(entries, np.uint32).tolist(), np.frombuffer(mean, np.float32).reshape(-1, lm.WIDTH + 1)[:, 0].tolist())
    assert lm.BUCKETS == 256 and found == {0: 1, 512: 1, 1: 6, 257: 7, 3: 5}


def test_links_connect_what_all_pairs_of_a_bucket_connect(spark):
    """Groups around a leader with members near and far from it: the size bounds of deltas leave out no pair (F1)."""
    from pyspark.sql import functions as F

    from larder.llm.links import links

    rng, sets = np.random.default_rng(12), []
    for size in (12, 40, 90):
        base = set(range(size))
        for _ in range(6):
            far = (base - set(rng.choice(size, int(rng.integers(0, size // 2 + 1)), replace=False).tolist())) | set(rng.integers(1000, 9000, int(rng.integers(0, size))).tolist())
            for _ in range(4):
                near = set(far)
                for _ in range(int(rng.integers(0, size // 6 + 2))):
                    near.discard(rng.choice(sorted(near)).item()) if rng.random() < 0.5 else near.add(int(rng.integers(10_000, 99_000)))
                sets.append(sorted(near))
    frame = spark.createDataFrame(list(enumerate(sets)), "_id bigint, _set array<bigint>")
    buckets = spark.createDataFrame([(7, i) for i in range(len(sets))], "bucket bigint, id bigint")
    of = lambda ids: frame.join(ids.toDF("_i"), frame["_id"] == F.col("_i"), "left_semi")
    found = components(links(buckets, of, 80)).collect()
    group = list(range(len(sets)))
    for a, x in enumerate(sets):
        for b in range(a):
            shared = len(set(x) & set(sets[b]))
            if 100 * shared >= 80 * (len(x) + len(sets[b]) - shared):
                one, other = group[a], group[b]
                group = [min(one, other) if g in (one, other) else g for g in group]
    linked = {i: g for i, g in enumerate(group) if group.count(g) > 1}
    assert len(set(linked.values())) > 5 and {r["vertex"]: r["component"] for r in found} == linked
