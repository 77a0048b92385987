"""Near-duplicate documents by circulant MinHash.

Shingles of a document get positions in a fixed universe by one random placement (the first
permutation: a hash). One permutation table of the universe, shifted circularly by 0, 1, 2, ...,
then gives every coordinate of the signature: coordinate k of a shingle at position p is
``table[(p + k) mod universe]``, so that all its coordinates are one contiguous stretch of the table.
Bands of six coordinates, fifty of them, name buckets: a pair with similarity 0.8 shares no bucket
with probability under 3e-7. Everything that shares a bucket is a candidate; links are decided on full sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import components
from larder.llm.links import links
from larder.llm.stages import stored
from larder.llm.text import Reader, shingles

UNIVERSE = 1 << 21
BANDS, BAND_ROWS = 50, 6
BLOCK = 2048


def permutation_table(coordinates: int, universe: int = UNIVERSE, seed: int = 7) -> np.ndarray:
    """The permutation, continued circularly, viewed as rows: row p has the coordinates of position p."""
    table = np.random.default_rng(seed).permutation(universe).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[: coordinates - 1]]), coordinates)


def signature(positions: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Least value of every coordinate over the positions of a set."""
    least = np.full(table.shape[1], np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(positions), BLOCK):
        np.minimum(least, table[positions[at : at + BLOCK]].min(axis=0), out=least)
    return least


def _sketches(size: int, bands: int, rows: int):
    schema = pa.schema([("_key", pa.binary()), ("_n", pa.int64()), ("_bands", pa.list_(pa.int64()))])

    def sketch(batches):
        reader, table = Reader(), permutation_table(bands * rows)
        with np.errstate(over="ignore"):
            weights = np.random.default_rng(11).integers(1, 2**62, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            keys, counts, found = [], [], []
            for words in reader.slices(batch.column(1)):
                hashes, first = shingles(words, size)
                for r in range(len(first) - 1):
                    own = np.unique(hashes[first[r] : first[r + 1]])
                    counts.append(len(own))
                    if not len(own):
                        keys.append(None)
                        found.append(None)
                        continue
                    keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    with np.errstate(over="ignore"):
                        values = signature((own % np.uint64(UNIVERSE)).astype(np.int64), table).astype(np.uint64)
                        found.append((values.reshape(bands, rows) * weights).sum(axis=1).view(np.int64))
            arrays = [pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["_id", *schema.names])

    return sketch


def _shingle_sets(size: int):
    def sets(batches):
        reader = Reader()
        for batch in batches:
            out = []
            for words in reader.slices(batch.column(1)):
                hashes, first = shingles(words, size)
                out += [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["_id", "_set"])

    return sets


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Documents are linked when the Jaccard similarity of their distinct word shingles is ``percent``
    or more; ``component_id`` is the least id that can be reached, and ``kept`` marks its owner.

    Copies with equal sets are one class and meet in one representative, the least id, before any
    comparison. No bucket or candidate is dropped.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing. Rows
    with a null id are linked with nothing and kept. Rows that repeat an id are one document: each
    row is returned, its texts share the id's component. Other columns are not looked at. An empty
    table gives an empty one.
    """
    source = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    id_type = source.schema["_id"].dataType.simpleString()
    sketches = stored(
        source.mapInArrow(
            _sketches(shingle_words, bands, band_rows), f"_id {id_type}, _key binary, _n bigint, _bands array<bigint>"
        )
    )
    known = sketches.filter("_key IS NOT NULL AND _id IS NOT NULL")
    classes = stored(known.groupBy("_key").agg(F.min("_id").alias("_rep")))

    # Buckets of representatives: (bucket, id, size), each band of a class once.
    reps = known.select("_id", F.col("_key").alias("_k"), "_bands").join(
        classes, (F.col("_k") == F.col("_key")) & (F.col("_id") == F.col("_rep"))
    )
    # A bucket is a band number and its value, held in one number mixed from both.
    rows = reps.select("_id", F.posexplode("_bands").alias("_band", "_value"))
    buckets = rows.select(F.xxhash64("_value", "_band").alias("bucket"), F.col("_id").alias("id"))

    def sets(ids: DataFrame) -> DataFrame:
        texts = source.join(ids, F.col("_id") == F.col("id"), "left_semi")
        return texts.mapInArrow(_shingle_sets(shingle_words), f"_id {id_type}, _set array<bigint>")

    # Rows of one id are one document: through it, the classes of its texts are linked.
    again = known.groupBy("_id").agg(F.min(F.xxhash64("_key")).alias("lo"), F.max(F.xxhash64("_key")).alias("hi"))
    again = stored(again.filter("lo <> hi").select(F.col("_id").alias("_again")))
    own = known.select("_id", F.col("_key").alias("_k")).join(again, F.col("_id") == F.col("_again"), "left_semi")
    own = own.join(classes, F.col("_k") == F.col("_key")).filter("_id <> _rep").select("_id", "_rep").distinct()

    linked = components(links(buckets, sets, percent).union(own)).toDF("_vertex", "_component")

    placed = classes.join(linked, F.col("_rep") == F.col("_vertex"), "left")
    placed = stored(placed.select(F.col("_key").alias("_ck"), F.coalesce("_component", "_rep").alias("_component")))
    result = sketches.drop("_bands").join(placed, F.col("_key") == F.col("_ck"), "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_id"))
    result = result.select(F.col("_id").alias(id_column), F.col("_n").alias("n_shingles"), component.alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))
