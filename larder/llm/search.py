"""Ranked lexical search: the best documents of a large corpus for each of many items.

Documents are indexed in chunks of bounded size, each with its posting lists of the items' terms in order of document,
and looked through by best-first search. A posting's impact is what it adds to a document's score. A range-maximum
sparse table over each list (of two overlapping power-of-two windows the larger maximum) gives the largest impact of a
term within any interval of documents, and the sum of these over an item's terms bounds every score in the interval.
Intervals are opened in order of their bounds, each at the document of its largest impact, which is scored exactly and
splits the rest into two intervals with bounds of their own; the search ends when no bound reaches the worst document
kept. Several of the best intervals are opened at once, as numpy does that as fast as one.

The chunks are searched twice. The first pass opens some intervals only; the best scores it meets anywhere give each
item a floor, which lets the second, whole pass leave most intervals unopened.

Scores are 64-bit integers, so no order of work can change them. Of equal scores the smallest ids are kept.

Defined results: a null or empty text has no term; it counts neither as a document nor as an item's match, and an item
without terms has no rows; rows with one id are documents of their own; a missing id comes after all others; items with
one id are ranked each on its own; empty tables give no rows; other columns are not read. Terms are known by 64-bit
hashes together with their length: of 1e11 different words one meets one of 1e5 item terms with a probability under 1e-3.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.sent import Sent
from larder.llm.stages import stored
from larder.llm.text import Reader

#: Bounds of a chunk of the index, of the item texts that are searched for at once, and of intervals opened at once.
CHUNK_DOCUMENTS, CHUNK_POSTINGS = 16384, 1 << 20
BLOCK_BYTES = 4 << 20
AT_ONCE = 64
#: Rounds of the first pass.
PROBES = 4
#: Sorts after every id.
NO_ID = np.iinfo(np.int64).max


def term_reader() -> Reader:
    """Terms are runs of letters A-Z (lower-cased), digits and everything beyond ASCII."""
    reader = Reader()
    values = np.arange(256)
    word = (values >= 0x80) | ((values >= 0x30) & (values <= 0x39)) | ((values >= 0x61) & (values <= 0x7A))
    reader.space = ~word
    return reader


@dataclass
class Items:
    """Items of one block: their ids, their terms as numbers, and the sorted hashes and lengths of all terms."""

    ids: list
    terms: list[np.ndarray]
    hashes: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(ids: Sequence, texts: Sequence[str | None]) -> Items:
        found = []
        for words in term_reader().slices(pa.array(texts, pa.string())):
            lengths = words.end - words.start
            for r in range(len(words.first) - 1):
                own = slice(words.first[r], words.first[r + 1])
                found.append(np.stack([words.hash[own], lengths[own].astype(np.uint64)], 1))
        known = np.unique(np.concatenate(found) if found else np.empty((0, 2), np.uint64), axis=0)
        number = {(int(h), int(n)): i for i, (h, n) in enumerate(known)}
        terms = [np.unique(np.array([number[int(h), int(n)] for h, n in f], np.int64)) for f in found]
        return Items(list(ids), terms, known[:, 0].copy(), known[:, 1].copy())

    def numbers(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each term, -1 for what is none of the items'."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.lengths[at] == lengths), at, -1)


# --- index ---------------------------------------------------------------------------------------------------------

INDEX = (
    "n_documents long, n_terms long, ids array<long>, sizes array<int>, terms array<int>, counts array<int>,"
    " places array<int>, occurrences array<int>"
)
ARROW_INDEX = pa.schema([
    ("n_documents", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
    ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())),
    ("occurrences", pa.list_(pa.int32())),
])


def _chunk(ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray, terms: np.ndarray, times: np.ndarray, seen: tuple[int, int]):
    """One row of the index: documents in order of id, their postings in order of term and document."""
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    by = np.lexsort([place[rows], terms])
    used, counts = np.unique(terms[by], return_counts=True)
    columns = [ids[order], sizes[order], used, counts, place[rows][by], times[by]]
    lists = [pa.array([c.astype(t.type.value_type.to_pandas_dtype())], t.type) for c, t in zip(columns, [*ARROW_INDEX][2:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([seen[0]]), pa.array([seen[1]]), *lists], schema=ARROW_INDEX)


def index(docs: DataFrame, sent: Sent) -> DataFrame:
    """Chunks of the index of ``docs`` (doc_id, text) over the items' terms; counts are over all terms."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, reader = sent.value, term_reader()
        held, documents, postings, seen = [], 0, 0, [0, 0]
        for batch in batches:
            doc_ids = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for words in reader.slices(batch.column("text")):
                counts, row = words.counts, words.row
                number = items.numbers(words.hash, (words.end - words.start).astype(np.uint64))
                hit = number >= 0
                pairs, times = np.unique(row[hit] * max(len(items.hashes), 1) + number[hit], return_counts=True)
                rows, terms = np.divmod(pairs, max(len(items.hashes), 1))
                seen[0] += int(np.count_nonzero(counts))
                seen[1] += int(counts.sum())
                used, rows = np.unique(rows, return_inverse=True)  # documents without any item's term need no place
                held.append((doc_ids[words.rows][used], counts[used], rows + documents, terms, times))
                documents, postings = documents + len(used), postings + len(rows)
                if documents >= CHUNK_DOCUMENTS or postings >= CHUNK_POSTINGS:
                    yield _chunk(*map(np.concatenate, zip(*held, strict=True)), tuple(seen))
                    held, documents, postings, seen = [], 0, 0, [0, 0]
        if held:
            yield _chunk(*map(np.concatenate, zip(*held, strict=True)), tuple(seen))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(build, INDEX)


@dataclass
class Statistics:
    """N, L, and the weight of each term."""

    documents: int
    terms: int
    weights: np.ndarray


def statistics(chunks: DataFrame, n_terms: int) -> Statistics:
    """Over all chunks; what comes to the driver is one number for each term of the block."""
    sums = chunks.agg(F.sum("n_documents"), F.sum("n_terms")).first()
    documents, terms = sums[0] or 0, sums[1] or 0
    per_term = chunks.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df"))
    weights = np.zeros(n_terms, np.int64)
    for term, df in per_term.toLocalIterator():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    return Statistics(documents, terms, weights)


def impacts(weight: np.ndarray, times: np.ndarray, size: np.ndarray, of: Statistics) -> np.ndarray:
    """What each posting adds to the score of its document, in whole numbers."""
    if 90 * int(size.max(initial=0)) * of.documents >= 1 << 63:
        size = size.astype(object)
    m = (100 - 90 + (90 * size * of.documents) // max(of.terms, 1)).astype(np.int64)
    times = times.astype(np.int64)
    return weight * ((1_000_000_000 * times) // (1000 * times + 8 * m))


# --- search in a chunk ---------------------------------------------------------------------------------------------


class Postings:
    """The posting lists of a chunk with their impacts and range-maximum tables."""

    def __init__(self, row: dict[str, np.ndarray], of: Statistics):
        self.ids = row["ids"]
        counts = row["counts"].astype(np.int64)
        term = np.repeat(row["terms"].astype(np.int64), counts)
        self.place = row["places"].astype(np.int64)
        self.impact = impacts(of.weights[term], row["occurrences"], row["sizes"].astype(np.int64)[self.place], of)
        self.key = term * max(len(self.ids), 1) + self.place
        ends = np.cumsum(counts)
        self.list_of = np.full((len(of.weights), 2), -1, np.int64)
        self.list_of[row["terms"]] = np.stack([ends - counts, ends], 1)
        # Level k holds for each place the place of the maximum of the 2**k postings from there on.
        longest = int(counts.max(initial=1))
        levels = [np.arange(len(term), dtype=np.int32)]
        while 2 << len(levels) - 1 <= longest:
            half, last = 1 << len(levels) - 1, levels[-1]
            level = last.copy()
            right = last[half:]
            better = self.impact[right] > self.impact[last[: len(right)]]
            level[: len(right)][better] = right[better]
            levels.append(level)
        self.best = np.stack(levels)
        self.log = np.frexp(np.arange(longest + 1))[1] - 1

    def largest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the largest impact of each range of postings is."""
        k = self.log[end - start]
        left, right = self.best[k, start], self.best[k, end - (1 << k)]
        return np.where(self.impact[right] > self.impact[left], right, left)


@dataclass
class Best:
    """The best documents of one item so far, and the pair that a document must not come after."""

    size: int
    floor: tuple[int, int]
    found: list[tuple[int, int]] = field(default_factory=list)

    def offer(self, score: int, doc_id: int) -> None:
        entry = (score, -doc_id)
        if entry >= self.floor:
            if len(self.found) < self.size:
                heapq.heappush(self.found, entry)
            else:
                heapq.heappushpop(self.found, entry)
            if len(self.found) == self.size:
                self.floor = max(self.floor, self.found[0])


def search(lists: Postings, terms: np.ndarray, best: Best, rounds: int | None = None) -> int:
    """Offers ``best`` all documents of the chunk that may belong to it, or what ``rounds`` rounds meet. Returns the intervals opened."""
    ranges = lists.list_of[terms]
    ranges = ranges[ranges[:, 0] >= 0]
    if not len(ranges):
        return 0
    start, end = ranges[:, 0], ranges[:, 1]
    top = lists.largest(start, end)
    # (minus bound, first place, starts, ends, places of the largest impacts)
    queue = [(-int(lists.impact[top].sum()), 0, start, end, top)]
    opened = 0
    width = max(len(lists.ids), 1)
    while queue and rounds != 0:
        rounds = None if rounds is None else rounds - 1
        taken = []
        while queue and len(taken) < AT_ONCE:
            if (-queue[0][0], -int(lists.ids[queue[0][1]])) < best.floor:
                if -queue[0][0] < best.floor[0]:
                    queue = []
                else:
                    heapq.heappop(queue)
                continue
            taken.append(heapq.heappop(queue))
        if not taken:
            break
        opened += len(taken)
        sizes = np.array([len(t[2]) for t in taken])
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        owner = np.repeat(np.arange(len(taken)), sizes)
        start, end, top = (np.concatenate([t[k] for t in taken]) for k in (2, 3, 4))
        gain = lists.impact[top]
        first = np.flatnonzero(gain == np.maximum.reduceat(gain, offsets)[owner])
        split = lists.place[top[first[np.searchsorted(first, offsets)]]]
        # The term's keys are those of its list: take the list's term part from any of its own keys.
        target = lists.key[start] - lists.place[start] + split[owner]
        at = np.searchsorted(lists.key, target)
        inside = np.minimum(at, len(lists.key) - 1)
        present = (at < end) & (lists.key[inside] == target)
        scores = np.add.reduceat(np.where(present, lists.impact[inside], 0), offsets)
        for score, doc_id in zip(scores.tolist(), lists.ids[split].tolist(), strict=True):
            best.offer(score, doc_id)
        lows = np.array([t[1] for t in taken])
        for a, b, low in ((start, at, lows), (at + present, end, split + 1)):
            some = a < b
            a, b, mine = a[some], b[some], owner[some]
            if not len(a):
                continue
            peak = lists.largest(a, b)
            cuts = np.searchsorted(mine, np.arange(len(taken) + 1))
            bounds = np.concatenate([[0], np.cumsum(lists.impact[peak])])
            bounds = bounds[cuts[1:]] - bounds[cuts[:-1]]
            for e in np.flatnonzero(bounds >= max(best.floor[0], 1)).tolist():
                own = slice(cuts[e], cuts[e + 1])
                heapq.heappush(queue, (-int(bounds[e]), int(low[e]), a[own], b[own], peak[own]))
    return opened


# --- search in all chunks ------------------------------------------------------------------------------------------

FOUND = "number int, doc_id long, score long"
ARROW_FOUND = pa.schema([("number", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
LISTS = [f.name for f in [*ARROW_INDEX][2:]]


def _search_chunks(chunks: DataFrame, sent: Sent, of: Sent, top: int, floors: Sent | None, rounds: int | None) -> DataFrame:
    """(number, doc_id, score): each task's best documents for each item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        floor = floors.value if floors else {}
        kept = [Best(top, floor.get(q, (1, -NO_ID))) for q in range(len(items.ids))]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].values.to_numpy(zero_copy_only=False) for name in LISTS}
                lists = Postings(row, of.value)
                for terms, best in zip(items.terms, kept, strict=True):
                    search(lists, terms, best, rounds)
        found = [(q, -minus_id, score) for q, best in enumerate(kept) for score, minus_id in best.found]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), ARROW_FOUND, strict=True)], schema=ARROW_FOUND)

    return chunks.select(*LISTS).mapInArrow(run, FOUND)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` of each item with their rank; parts of an item's candidates are cut first."""
    order = [F.desc("score"), "doc_id"]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    first = F.row_number().over(Window.partitionBy("number", "_part").orderBy(*order))
    cut = found.withColumn("_part", part).withColumn("_first", first).filter(F.col("_first") <= top)
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    return cut.drop("_part", "_first").withColumn("rank", rank).filter(F.col("rank") <= top)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items, in blocks of bounded bytes; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    for row in items.select("item_id", F.col("text").cast("string")).toLocalIterator():
        more = len((row[1] or "").encode())
        if ids and size + more > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += more + 64
    if ids:
        yield ids, texts


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item of ``items`` (item_id, text) its best documents.

    The documents are read once for each block of items, a block's index and its few results being written to the
    shared folder. What goes to all tasks is one block and a few numbers for each of its items and terms.
    """
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType
    results = []
    for ids, texts in _blocks(items, block_bytes):
        block = Items.of(ids, texts)
        sent = Sent(spark, block)
        chunks = stored(index(docs, sent))
        of = Sent(spark, statistics(chunks, len(block.hashes)))
        probed = _ranked(_search_chunks(chunks, sent, of, top, None, PROBES), top).filter(F.col("rank") == top)
        floors = Sent(spark, {r.number: (r.score, -r.doc_id) for r in probed.toLocalIterator()})
        found = _ranked(_search_chunks(chunks, sent, of, top, floors, None), top)
        numbers = spark.createDataFrame(list(enumerate(ids)), f"number int, item_id {id_type.simpleString()}")
        known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
        results.append(found.join(F.broadcast(numbers), "number").select("item_id", "rank", known, "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results)
