"""Repair of conversation structure by aligning turns to an alternating grammar.

A repaired conversation has the role initials ``(s?(ua)+)?``. Each length that string can have is one target;
turns are aligned to it by Wagner-Fischer dynamic programming over four edits: keep a turn (0, and 5 where its
text breaks off), give it another role (1, and 5 likewise), delete it (2), insert an empty turn (5). Blank and
repeated turns can only be deleted. A target is the end of the longer ones, so one table, filled from the end of
the conversation, holds the costs of all lengths; its cells are kept inside Ukkonen's band, the places that a way
no dearer than the incumbent (the cost of a cheap repair found first) can pass. Every length that attains the
least cost is traced back from its corner, taking the ASCII-least edit that stays on a cheapest way, and the
ASCII-least of these audits is the result.

Texts are not needed for that: per turn the role's initial, two marks and a 128-bit digest suffice. A task reads
conversations from sorted partitions, one turn after the other; texts stream past the finished audit in a second
pass and are never gathered. A conversation of n turns needs O(n) memory for its signs, and for its table the rows
of about sqrt(n) places inside the band.

Defined results: null fields of a turn are read as one space, a null id is a conversation of its own; turns come by
number, missing numbers first, then by role and hashes of the text, so repeated and tied rows have one order; a role that is
empty or does not start with s, u or a can be deleted or given another role only; an empty table gives no rows. Other
columns are not carried, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# What each edit costs, what an undeleted broken-off turn adds, and white space.
DELETE, INSERT, REROLE, BROKEN_OFF = 2, 5, 1, 5
WHITE = " \t\n\x0b\f\r"
ROLES = {"u": "user", "a": "assistant"}

FAR = 1 << 40
OUT_ROWS = 4096

#: A turn's signs: its role's initial, whether it must go, whether its text breaks off.
Sign = tuple[str, bool, bool]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with nulls of role and text as one space."""
    space = F.lit(" ")
    return conversations.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])


def damaged(conversations: DataFrame, share: int = 20) -> DataFrame:
    """``turns_of`` with faults planted by a hash of ``conv_id:turn``; dropped turns stay as rows with ``gone``.

    Of ``share`` remainders, 0 drops a turn, 1 empties its text, 2 removes the marks ``. ! ?``, 3 repeats it, 4
    makes its role user.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns_of(conversations).withColumn("_fault", (F.crc32(key.cast("binary")) % share).cast("int"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("_fault") == 0).alias("gone"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _sorted_by_conversation(turns: DataFrame, *order: Column | str) -> DataFrame:
    """One conversation after the other; Spark's sort spills, so no conversation need fit in memory."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *order)


# --- alignment -----------------------------------------------------------------------------------------------------


def _cheap_repair(signs: list[Sign]) -> int:
    """The cost of some repair: one pass that keeps what fits and deletes the rest."""
    cost, kept = 0, ""
    for initial, must_go, broken in signs:
        fits = initial in {"": "su", "s": "u", "u": "a", "a": "u"}[kept[-1:]]
        if must_go or broken or not fits or not initial:
            cost += DELETE
        else:
            kept += initial
    pairs = len(kept.removeprefix("s")) // 2
    whole = 2 * pairs + (kept[:1] == "s") if pairs else 0
    return cost + DELETE * (len(kept) - whole)


class Table:
    """Costs of aligning the turns from each place on with the last ``length`` letters of the grammar string.

    Row i, column j: turns i.. against the last j letters of ``...uaua``; ``start`` holds, for each even j, the
    costs where the letter s precedes these. Columns outside the band of a row are far. Every ``step``-th row is
    kept, and the rows between two of them are computed again when the trace comes to them.
    """

    def __init__(self, signs: list[Sign], bound: int):
        self.signs, self.bound, n = signs, bound, len(signs)
        # Ukkonen: within the bound at most ``more`` letters can be inserted and ``fewer`` turns deleted.
        self.more, self.fewer = bound // INSERT, bound // DELETE
        self.width = n + self.more + 1
        self.letters = np.arange(self.width) % 2  # of the j-th letter from the end: 1 is a, 0 is u
        self.step = max(1, isqrt(n))
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.block: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        row, start = np.full(self.width, FAR), np.full(self.width, FAR)
        row[self._band(n)] = np.arange(self.more + 1) * INSERT
        self.kept[n] = row, start
        for i in range(n - 1, -1, -1):
            row, start = self._row(i, row, start)
            if i % self.step == 0:
                self.kept[i] = row, start

    def _band(self, i: int) -> slice:
        rest = len(self.signs) - i
        return slice(max(0, rest - self.fewer), rest + self.more + 1)

    def _inserted(self, row: np.ndarray) -> np.ndarray:
        """Part of a row with insertions: what is cheapest so far to the left, and 5 for each further letter."""
        by = np.arange(len(row)) * INSERT
        row = np.minimum.accumulate(row - by) + by
        return np.where(row > self.bound, FAR, row)

    def _row(self, i: int, below: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        initial, must_go, broken = self.signs[i]
        band = self._band(i)
        row, opened = np.full(self.width, FAR), start + DELETE
        part = below[band] + DELETE
        if not must_go:
            extra = BROKEN_OFF * broken
            own = {"u": 0, "a": 1}.get(initial, -1)
            first = max(1, band.start)
            kept = below[first - 1 : band.stop - 1] + np.where(self.letters[first : band.stop] == own, 0, REROLE) + extra
            part[first - band.start :] = np.minimum(part[first - band.start :], kept)
            if initial == "s":
                opened[2::2] = np.minimum(opened[2::2], below[2::2] + extra)
        row[band] = self._inserted(part)
        return row, np.where(opened > self.bound, FAR, opened)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            top = min(len(self.signs), (i // self.step + 1) * self.step)
            self.block = {}
            row, start = self.kept[top]
            for k in range(top - 1, i - i % self.step, -1):
                row, start = self._row(k, row, start)
                self.block[k] = row, start
        return self.block[i]

    def corners(self) -> tuple[int, list[tuple[int, bool]]]:
        """The least cost, and the targets (letters, with s before them) that attain it."""
        row, start = self.row(0)
        least = int(min(row[::2].min(), start[2::2].min(initial=FAR)))
        found = [(int(j), False) for j in np.flatnonzero(row == least) if j % 2 == 0]
        return least, found + [(int(j), True) for j in np.flatnonzero(start == least) if j % 2 == 0 and j > 0]

    def trace(self, targets: list[tuple[int, bool]]) -> list[str]:
        """The ASCII-least cheapest audit for each target; all are traced together, so that each row is read once."""
        row, start = self.row(0)
        audits: list[list[str]] = [[] for _ in targets]
        at = list(targets)
        for i, (initial, _, broken) in enumerate(self.signs):
            below, start_below = self.row(i + 1)
            extra = BROKEN_OFF * broken
            for t, audit in enumerate(audits):
                j, opening = at[t]
                if opening:
                    if start_below[j] + DELETE == start[j]:
                        audit.append("D")
                    else:  # the letter s is a kept turn
                        audit.append("K")
                        at[t] = j, False
                    continue
                while below[j] + DELETE != row[j] and j and row[j - 1] + INSERT == row[j]:
                    audit.append("I")
                    j -= 1
                if below[j] + DELETE == row[j]:
                    audit.append("D")
                else:
                    keeps = initial == "ua"[j % 2] and below[j - 1] + extra == row[j]
                    audit.append("K" if keeps else "R")
                    j -= 1
                at[t] = j, False
            row, start = below, start_below
        return ["".join(audit) + "I" * j for audit, (j, _) in zip(audits, at, strict=True)]


def align(signs: list[Sign]) -> tuple[int, str]:
    """The least cost of a repair and the ASCII-least audit that has it."""
    table = Table(signs, _cheap_repair(signs))
    least, targets = table.corners()
    return least, min(table.trace(targets))


def repaired(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired turns, in order, while the turns stream past.

    The audit fixes its target: an even number of turns is ``uaua...``, an odd one has s before that.
    """
    rest = len(audit) - audit.count("D")
    turns = iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)
        if edit == "D":
            continue
        wanted = ROLES["a" if rest % 2 else "u"]
        yield edit, role if edit == "K" else wanted, text
        rest -= 1


# --- Spark ---------------------------------------------------------------------------------------------------------


def _conversations(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(id, its rows) of sorted rows, one conversation after the other; rows left unread are skipped."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)

    source = rows()
    waiting = next(source, None)

    def own(key) -> Iterator[tuple]:
        nonlocal waiting
        while waiting is not None and waiting[0] == key:
            row, waiting = waiting, None
            # The next row is fetched before this one is given out, so that the reader may stop anywhere.
            waiting = next(source, None)
            yield row

    while waiting is not None:
        key = waiting[0]
        mine = own(key)
        yield key, mine
        for _ in mine:
            pass


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _arrow(schema: StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


#: Figures of an audit, in the order in which they travel.
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, figures, audit) of every conversation, figures being ``FIGURES``; ``turns`` as from ``damaged``.

    Only signs of the turns are shuffled, once.
    """
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    signs = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "gone",
        F.substring("role", 1, 1).alias("initial"),
        F.unhex(F.md5(F.concat(F.sha2("role", 256), "text"))).alias("digest"),
        (F.trim(F.col("text"), F.lit(WHITE)) == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("broken"),
        "role",
        F.xxhash64("text").alias("_text"),
    )
    # Turns with one number and role are ordered by their texts, which the repair pass does by the same hash.
    ordered = _sorted_by_conversation(signs, F.asc_nulls_first("turn"), "role", "_text", "digest").drop("role", "_text")
    id_type = turns.schema["conv_id"].dataType
    schema = StructType([
        StructField("conv_id", id_type), StructField("figures", ArrayType(LongType())), StructField("audit", StringType()),
    ])
    arrow = _arrow(schema)
    names = ["conv_id", "turn", "gone", "initial", "digest", "blank", "broken"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=1 << 16)(lambda signs: align(list(signs)))

        def audited() -> Iterator[tuple]:
            for key, rows in _conversations(batches, names):
                found, seen, last = [], set(), ""
                blank = repeated = broken_off = illegal = numbers = 0
                low = high = before = None
                for _, turn, gone, initial, digest, is_blank, broken in rows:
                    if gone:
                        continue
                    if turn is not None:
                        numbers += turn != before
                        low, high, before = turn if low is None else low, turn, turn
                    illegal += bool(found) and last + initial not in ("su", "ua", "au")
                    again = not is_blank and digest in seen
                    seen.add(digest)
                    cut = broken and not is_blank and not again
                    blank, repeated, broken_off = blank + is_blank, repeated + again, broken_off + cut
                    found.append((initial, is_blank or again, cut))
                    last = initial
                # Long conversations hardly repeat; only short ones are worth remembering.
                cost, audit = known(tuple(found)) if len(found) <= 64 else align(found)
                gaps = 0 if low is None else high - low + 1 - numbers
                yield key, [gaps, blank, repeated, broken_off, illegal, cost], audit

        yield from _batches(audited(), arrow)

    return ordered.mapInArrow(run, schema)


def _with_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns that are left, sorted by conversation, each conversation headed by its audit."""
    heads = audits.select("conv_id", F.lit(0).alias("part"), "figures", "audit")
    rows = turns.filter(~F.col("gone")).select(
        "conv_id", F.lit(1).alias("part"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.xxhash64("text").alias("_text"), F.unhex(F.md5(F.concat(F.sha2("role", 256), "text"))).alias("digest"),
    )
    both = heads.unionByName(rows, allowMissingColumns=True)
    return _sorted_by_conversation(both, "part", F.asc_nulls_first("turn"), "role", "_text", "digest").drop("_text", "digest")


READ = ["conv_id", "figures", "audit", "role", "text"]


def repair_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the repaired conversations; place counts from 0."""
    schema = StructType([
        StructField("conv_id", turns.schema["conv_id"].dataType), StructField("place", LongType()),
        StructField("edit", StringType()), StructField("role", StringType()), StructField("text", StringType()),
    ])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for key, rows in _conversations(batches, READ):
                audit = next(rows)[2]
                for place, turn in enumerate(repaired(audit, (r[3:] for r in rows))):
                    yield key, place, *turn

        yield from _batches(out(), arrow)

    return _with_audits(turns, audits).mapInArrow(run, schema)


def repair_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with ``repaired_sha256`` of the repaired ``role:text`` lines, hashed while they stream past."""
    schema = StructType([*audits.select("conv_id", "figures", "audit").schema.fields, StructField("repaired_sha256", StringType())])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for key, rows in _conversations(batches, READ):
                _, figures, audit, _, _ = next(rows)
                content = hashlib.sha256()
                for place, (_, role, text) in enumerate(repaired(audit, (r[3:] for r in rows))):
                    content.update(f"{chr(10) * bool(place)}{role}:{text}".encode())
                yield key, figures, audit, content.hexdigest()

        yield from _batches(out(), arrow)

    return _with_audits(turns, audits).mapInArrow(run, schema)


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: its figures, its audit, and the digest of its repair."""
    audits = audit_conversations(turns)
    found = repair_digests(turns, audits)
    figures = [F.col("figures")[i].alias(n) for i, n in enumerate(FIGURES)]
    return found.select("conv_id", *figures, "audit", "repaired_sha256")
