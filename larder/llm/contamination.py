"""Benchmark passages in documents, by SimHash of item-sized windows.

A window of a document has as many words as a benchmark item; a shorter document is one window. Windows and items are bags of five-word
shingles, weighted by how few items share a shingle. The SimHash of a bag has in each bit the sign of a
vote of its shingles, each with the square root of its weight in the bag: then the squared norms are the weights of the bags, and bags of
Jaccard similarity s are at an angle whose cosine is at least 2s / (1 + s). At 0.8 a bit differs with
a probability of 0.15, and more than ``RADIUS`` of 64 bits do in one pair of 100,000.

Fingerprints are cut into blocks; if two differ in at most ``RADIUS`` bits, then by the pigeonhole principle they differ in some
block in at most ``RADIUS // BLOCKS`` bits, so looking up every block value within that distance finds all
items within the radius. Candidates are then verified by the exact weighted Jaccard similarity of their bags.

Windows need a fingerprint only where shingles of items weigh enough to reach the least similarity.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.sent import Sent
from larder.llm.stages import stored
from larder.llm.text import Reader, Words, mix, shingles

SHINGLE = 5
LEAST = 0.8
BITS, BLOCKS, RADIUS = 64, 4, 23
WEIGHT = 1000
#: Bytes of one block of items as sent to tasks; cells of one comparison of queries with items; places of one sum of votes.
BLOCK_BYTES = 64 << 20
CELLS = 1 << 22
PLACES = 1 << 14


def _votes(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    bits = np.unpackbits(mix(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int64) * 2 - 1


def _fingerprints(votes: np.ndarray) -> np.ndarray:
    """64-bit fingerprints from summed votes."""
    return np.packbits(votes > 0, axis=1).view(np.uint64).ravel()


def _share(weights: np.ndarray, counts: np.ndarray | int = 1) -> np.ndarray:
    """Votes of shingles; whole numbers, so that equal bags have equal votes whatever the order of their sums."""
    return np.rint(WEIGHT * np.sqrt(weights * counts)).astype(np.int64)


def _block(prints: np.ndarray, b: int) -> np.ndarray:
    width = BITS // BLOCKS
    return (prints >> np.uint64(b * width)) & np.uint64((1 << width) - 1)


def _inside(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


class Items:
    """Benchmark items of one block: bags, fingerprints by length, and the block index of each length.

    ``bags`` are (id, words, shingles, counts); ``common`` are the shingles that several of all ``total`` items of
    the benchmark have, with the numbers of items. All others weigh as much as one that a single item has.
    """

    def __init__(self, bags: list[tuple], common: np.ndarray, held: np.ndarray, total: int, shingle: int = SHINGLE):
        self.shingle = shingle
        self.ids, self.lengths = [b[0] for b in bags], [int(b[1]) for b in bags]
        self.common, self.total = common, max(total, 1)
        self.common_weights = self._weight(held)
        self.rare = int(self._weight(np.ones(1))[0])
        own = [np.array(b[2], np.int64).view(np.uint64) for b in bags]
        counts = [np.array(b[3], np.int64) for b in bags]
        self.bags = [dict(zip(x.tolist(), n.tolist())) for x, n in zip(own, counts)]
        self.by_length: dict[int, list[int]] = {}
        for i, n in enumerate(self.lengths):
            self.by_length.setdefault(n, []).append(i)
        self.prints = np.array([self.print_of(x, n) for x, n in zip(own, counts)], np.uint64)
        self.own = {n: np.unique(np.concatenate([own[i] for i in m])) for n, m in self.by_length.items()}
        self.known = np.unique(np.concatenate(own)) if own else np.empty(0, np.uint64)
        self.index = {n: self._block_index(np.array(members)) for n, members in self.by_length.items()}

    @classmethod
    def of_texts(cls, ids: list, texts: list[str | None], shingle: int = SHINGLE) -> Items:
        """One block of a whole benchmark."""
        bags = [(ids[r], *bag) for r, bag in _bags_of(pa.array(texts, pa.string()), shingle)]
        seen = Counter(s for b in bags for s in b[2].tolist())
        common = np.sort(np.array([s for s, n in seen.items() if n > 1], np.int64).view(np.uint64))
        return cls(bags, common, np.array([seen[s] for s in common.view(np.int64).tolist()], np.int64), len(bags), shingle)

    def _weight(self, held: np.ndarray) -> np.ndarray:
        return np.rint(WEIGHT * (1 + np.log(self.total / held))).astype(np.int64)

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(hashes), self.rare, np.int64)
        at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
        return np.where(self.common[at] == hashes, self.common_weights[at], self.rare)

    def print_of(self, values: np.ndarray, counts: np.ndarray) -> np.uint64:
        """Fingerprint of a bag."""
        votes = np.zeros((1, BITS), np.int64)
        for at in range(0, len(values), PLACES):
            some = values[at : at + PLACES]
            votes[0] += _share(self.weights(some), counts[at : at + PLACES]) @ _votes(some)
        return _fingerprints(votes)[0]

    def window_prints(self, own: np.ndarray, starts: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, fingerprints) of windows of ``span`` shingles, in stretches of bounded length."""
        order = np.argsort(own, kind="stable")
        again = np.full(len(own), len(own) + span)
        same = own[order[1:]] == own[order[:-1]]
        again[order[:-1][same]] = order[1:][same]
        # Where the next equal shingle from here on begins; inside the window, its votes don't add up.
        repeated = np.minimum.accumulate(again[::-1])[::-1][starts] < starts + span
        for at in starts[repeated]:
            yield np.array([at]), np.array([self.print_of(*np.unique(own[at : at + span], return_counts=True))])
        single = starts[~repeated]
        while len(single):
            apart = np.flatnonzero(np.diff(single) > span)
            to = min(int(apart[0]) + 1 if len(apart) else len(single), int(np.searchsorted(single, single[0] + PLACES)))
            some, single = single[:to], single[to:]
            lo, hi = some[0], some[-1] + span
            part = own[lo:hi]
            sums = np.zeros((hi - lo + 1, BITS), np.int64)
            np.cumsum(_votes(part) * _share(self.weights(part))[:, None], axis=0, out=sums[1:])
            yield some, _fingerprints(sums[some + span - lo] - sums[some - lo])

    def _block_index(self, members: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The items of one length, and of each block its distinct values and which of them each item has."""
        return members, [np.unique(_block(self.prints[members], b), return_inverse=True) for b in range(BLOCKS)]

    def candidates(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, item): items of this length within the radius of each fingerprint.

        Distinct block values are compared with each query's: they are no more than the values near a query.
        """
        members, blocks = self.index[length]
        found = []
        step = max(1, CELLS // len(members))
        for at in range(0, len(prints), step):
            some = prints[at : at + step]
            near = np.zeros((len(some), len(members)), bool)
            for b, (values, of_item) in enumerate(blocks):
                close = np.bitwise_count(_block(some, b)[:, None] ^ values[None, :]) <= RADIUS // BLOCKS
                near |= close[:, of_item]
            query, place = np.nonzero(near)
            inside = np.bitwise_count(some[query] ^ self.prints[members[place]]) <= RADIUS
            found.append((query[inside] + at, members[place[inside]]))
        return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of two bags."""
        bag, (values, counts) = self.bags[item], np.unique(window, return_counts=True)
        own = dict(zip(values.tolist(), counts.tolist()))
        every = np.array(list(bag.keys() | own.keys()), np.uint64)
        pairs = [(bag.get(s, 0), own.get(s, 0)) for s in every.tolist()]
        weight = self.weights(every)
        least, most = np.array([min(p) for p in pairs]) @ weight, np.array([max(p) for p in pairs]) @ weight
        return float(least / most) if most else 0.0


def window_matches(words: Words, items: Items, least: float) -> list[tuple[int, int, int, int, float]]:
    """(row, item, first word, hamming distance, similarity): the best window of each item in each text."""
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    by_size: dict[int, list[int]] = {}
    for n in items.by_length:
        by_size.setdefault(min(n, items.shingle), []).append(n)
    for size, lengths in by_size.items():
        # Items shorter than a shingle are one shingle of all their words, and so are their windows.
        short = size < items.shingle
        if short:
            tokens, firsts = _short_windows(words, size, items.shingle)
        else:
            tokens, firsts = shingles(words, size)
            long_enough = words.counts >= size
        known = _inside(tokens, items.known)
        if not known.any():
            continue
        for r in np.unique(np.searchsorted(firsts, np.flatnonzero(known), "right") - 1):
            if not short and not long_enough[r]:
                continue
            own = tokens[firsts[r] : firsts[r + 1]]
            weight, places = items.weights(own), np.flatnonzero(known[firsts[r] : firsts[r + 1]])
            for n in lengths:
                span = n - size + 1
                held = places[_inside(own[places], items.own[n])]
                if not len(held):
                    continue
                span = min(span, len(own))  # a text shorter than the items is one window
                # Shingles that no item of this length has count against a window: similarity is at most held / all.
                total, ours = np.zeros(len(own) + 1, np.int64), np.zeros(len(own) + 1, np.int64)
                np.cumsum(weight, out=total[1:])
                ours[held + 1] = weight[held]
                np.cumsum(ours, out=ours)
                mine, all_of = ours[span:] - ours[:-span], total[span:] - total[:-span]
                starts = np.flatnonzero((mine > 0) & (mine >= least * all_of))
                for some, prints in items.window_prints(own, starts, span) if len(starts) else ():
                    for q, item in zip(*items.candidates(n, prints)):
                        value, start = items.similarity(int(item), own[some[q] : some[q] + span]), int(some[q])
                        before = best.get((r, int(item)), (0.0, 0))
                        if value >= least and (value, -start) > (before[0], -before[1]):
                            distance = int(np.bitwise_count(items.prints[item] ^ prints[q]))
                            best[r, int(item)] = (value, start, distance)
    return [(int(r), i, start, distance, value) for (r, i), (value, start, distance) in sorted(best.items())]


def _short_windows(words: Words, size: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``size`` words hashed as a whole text of ``size`` words is with ``shingle``-word shingles."""
    counts = words.counts
    windows = np.maximum(counts - size + 1, 0)
    first = np.concatenate([[0], np.cumsum(windows)])
    source = np.repeat(words.first[:-1] - first[:-1], windows) + np.arange(first[-1])
    with np.errstate(over="ignore"):
        value = np.full(len(source), np.uint64(shingle - size) * np.uint64(0xA0761D6478BD642F), np.uint64)
        for j in range(size):
            value = mix(value + words.hash[source + j] + np.uint64(7))
    return value, first


def _finder(sent, least: float):
    def find(batches):
        items, reader = sent.value, Reader()
        for batch in batches:
            rows = []
            for words in reader.slices(batch.column(1)):
                at = words.rows.start
                for r, i, start, d, v in window_matches(words, items, least):
                    rows.append((at + r, i, start, d, v, min(items.lengths[i], int(words.counts[r]))))
            take = pa.array([r[0] for r in rows], pa.int64())
            columns = [
                batch.column(0).take(take),
                pa.array([items.ids[r[1]] for r in rows], pa.int64()),
                *[pa.array([r[k] for r in rows], pa.int64()) for k in (2,)],
                pa.array([r[5] for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows], pa.float64()),
            ]
            names = ["doc_id", "item_id", "first_word", "n_words", "hamming", "similarity"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return find


def _bags_of(texts: pa.Array, shingle: int) -> Iterator[tuple[int, tuple]]:
    """(row, (words, shingles, counts)) of each text with a word."""
    reader, at = Reader(), 0
    for words in reader.slices(texts):
        hashes, first = shingles(words, shingle)
        for r in np.flatnonzero(words.counts):
            values, n = np.unique(hashes[first[r] : first[r + 1]], return_counts=True)
            yield at + int(r), (int(words.counts[r]), values.view(np.int64), n)
        at += len(words.counts)


def _bags(batches):
    for batch in batches:
        found = list(_bags_of(batch.column(1), SHINGLE))
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = [pa.array([bag[k] for _, bag in found], kind) for k, kind in enumerate(kinds)]
        ids = batch.column(0).take(pa.array([r for r, _ in found], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, *columns], names=["i", "words", "shingles", "counts"])


def _item_blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[Items]:
    """Items in blocks of bounded bytes; weights are those of the whole benchmark, whatever block an item is in."""
    rows = benchmark.select(F.col(item_column).cast("long").alias("i"), F.col(text_column).alias("t")).filter("t IS NOT NULL")
    bags = stored(rows.mapInArrow(_bags, "i bigint, words bigint, shingles array<bigint>, counts array<bigint>"))
    seen = bags.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("held")).filter("held > 1")
    several = seen.toArrow().sort_by("s")
    common, held = several["s"].to_numpy().view(np.uint64), several["held"].to_numpy()
    order, total = np.argsort(common), bags.count()
    block, size = [], 0
    for row in bags.toLocalIterator():
        block.append(tuple(row))
        size += 16 * len(row["shingles"]) + 64
        if size >= BLOCK_BYTES:
            yield Items(block, common[order], held[order], total)
            block, size = [], 0
    if block:
        yield Items(block, common[order], held[order], total)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least: float = LEAST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, hamming, similarity): for each document row and item, its best window.

    Items go to all tasks in blocks of ``BLOCK_BYTES``, each of which reads the documents once, so that a benchmark of any size is
    searched for in whole; with each block go the shingles that several items of the whole benchmark have, whose number grows with
    the benchmark, not with the documents. Items that are null, empty or without words match nothing; an item of fewer than five words is
    one shingle. Null and empty texts have no window; windows never reach beyond a text, and a text
    of fewer words than an item is its window for it, with ``n_words`` its own. Of equally
    similar windows the first is returned. Repeated rows and items are matched each; rows with null ids
    appear with a null id; other columns are not looked at. An empty table of either kind gives an empty
    one.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, first_word bigint, n_words bigint, hamming bigint, similarity double"
    found = spark.createDataFrame([], schema)
    for items in _item_blocks(benchmark, item_column, item_text_column):
        sent = Sent(spark, items)
        found = found.union(chosen.mapInArrow(_finder(sent, least), schema))
    return found.withColumnRenamed("doc_id", id_column)
