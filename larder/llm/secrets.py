"""Incremental secret scans over content-addressed texts.

Every historical version of a file is known by the digest of its content, its blob. A ledger in the
shared folder remembers which (blob, rule version) pairs were scanned and what was found; a scan reads
only blobs that some rule version has not seen, and joins findings back to every path that holds the blob.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.stages import stored

# Kinds in their listed order, patterns over bytes, and the least length of the checked group.
ASSIGN = rb"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN += rb"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``version`` changes whenever the rule does; ``hint`` must be in every match."""

    kind: str
    version: int
    pattern: bytes
    group: int
    least: int
    hint: bytes = b""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule("assign", 1, ASSIGN, 2, 6),
    Rule("access", 1, rb"AKIA[A-Z0-9]+", 0, 20, b"AKIA"),
    Rule("hex", 1, rb"[0-9a-f]+", 0, 24),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", 1, rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, b"PRIVATE KEY-----"),
    Rule("web_token", 1, rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 30, b"eyJ"),
    Rule("hub_token", 1, rb"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, b"gh"),
)
FINDING = "struct<kind:string,rank:int,start:bigint,end:bigint>"


def find(text: bytes, rules: tuple[Rule, ...], compiled: list[re.Pattern]) -> list[tuple[str, int, int, int]]:
    """(kind, rank, start, end) of all matches in UTF-8 text, in code points, end exclusive."""
    hits = []
    for rank, (rule, pattern) in enumerate(zip(rules, compiled)):
        if rule.hint and rule.hint not in text:
            continue
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                hits.append((rule.kind, rank, m.start(), m.end()))
    if not hits or text.isascii():
        return hits
    points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    at = lambda i: int(points[i - 1]) if i else 0
    return [(kind, rank, at(start), at(end)) for kind, rank, start, end in hits]


def _long_runs(pattern: bytes, least: int) -> bytes:
    """``x+`` that must be ``least`` long, as ``x{least,}``: shorter runs are passed over faster."""
    return pattern[:-1] + b"{%d,}" % least


def _compile(rule: Rule) -> re.Pattern:
    simple = re.fullmatch(rb"\[[^\]]+\]\+", rule.pattern) and rule.group == 0
    return re.compile(_long_runs(rule.pattern, rule.least) if simple else rule.pattern)


def _scanner(rules: tuple[Rule, ...], first_rank: dict[str, int]):
    def scan(batches):
        compiled = [_compile(r) for r in rules]
        for batch in batches:
            out = []
            for text in batch.column(1):
                found = find((text.as_py() or "").encode(), rules, compiled)
                out.append([{"kind": k, "rank": first_rank[k], "start": s, "end": e} for k, _, s, e in found])
            kind = pa.struct([("kind", pa.string()), ("rank", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(kind))], names=["blob", "found"])

    return scan


class Ledger:
    """Two tables below one folder: ``scans`` (blob, rule) and ``findings`` (blob, rule, kind, rank, start, end).

    Each scan appends its findings before its scans, so that a scan that dies midway is repeated and
    findings are read distinct.
    """

    SCANS = "blob string, rule string"
    FINDINGS = "blob string, rule string, kind string, rank int, start bigint, end bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        there = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        return self.spark.read.schema(schema).parquet(folder) if there else self.spark.createDataFrame([], schema)

    def scans(self) -> DataFrame:
        return self._table("scans", self.SCANS)

    def findings(self) -> DataFrame:
        return self._table("findings", self.FINDINGS).distinct()

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what is unseen; returns the (blob, rule) pairs that were scanned. ``versions``: (path, text)."""
        blobs = versions.select(blob_of(F.col("text")).alias("blob"), "path", F.coalesce("text", F.lit("")).alias("text"))
        owners = blobs.groupBy("blob").agg(F.min("path").alias("owner"))
        names = F.array(*[F.lit(r.name) for r in rules])
        seen = self.scans().groupBy("blob").agg(F.collect_set("rule").alias("seen")).withColumnRenamed("blob", "_blob")
        unseen = owners.join(seen, F.col("blob") == F.col("_blob"), "left").select(
            "blob", "owner", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules")
        )
        unseen = stored(unseen.filter(F.size("rules") > 0))
        # A path may hold several versions, so its text is found by path and blob; copies of one path count once.
        todo = blobs.join(
            unseen.select(F.col("blob").alias("_blob"), "owner", "rules"),
            (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("owner")),
        )
        ranks = {r.kind: i for i, r in enumerate(rules)}
        for rule_set in unseen.select("rules").distinct().collect():  # at most one row per set of rules
            own = tuple(r for r in rules if r.name in rule_set["rules"])
            rule_of = F.create_map(*[F.lit(x) for r in own for x in (r.kind, r.name)])
            part = todo.filter(F.col("rules") == F.array(*[F.lit(x) for x in rule_set["rules"]])).select("blob", "text")
            found = part.mapInArrow(_scanner(own, ranks), f"blob string, found array<{FINDING}>")
            rows = found.select("blob", F.explode("found").alias("f"))
            rows = rows.select("blob", rule_of[F.col("f.kind")].alias("rule"), "f.kind", "f.rank", "f.start", "f.end")
            rows.write.mode("append").parquet(f"{self.path}/findings")
        scanned = unseen.select("blob", F.explode("rules").alias("rule"))
        scanned.write.mode("append").parquet(f"{self.path}/scans")
        return scanned

    def report(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(path, found) of every row of ``versions``: findings under the given rules, by start, then rule order."""
        names = [r.name for r in rules]
        current = self.findings().filter(F.col("rule").isin(names))
        order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
        listed = current.groupBy(F.col("blob").alias("_blob")).agg(
            F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("rank"), "end", "kind"))).alias("found")
        )
        listed = stored(listed)
        paths = versions.select("path", blob_of(F.col("text")).alias("blob"))
        none = F.array().cast(listed.schema["found"].dataType)
        return paths.join(listed, F.col("blob") == F.col("_blob"), "left").select(
            "path", "blob", F.coalesce("found", none).alias("found")
        )


def blob_of(text: Column) -> Column:
    """Address of a text: SHA-256 of its UTF-8 bytes; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_secrets(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, found) of every row of ``versions`` (path, text), through the ledger at ``ledger_path``.

    ``found`` is an array of (start, rank, end, kind). Null and empty texts share the empty blob and have no
    findings; a null path is a path like others; repeated rows are reported once each; a blob that many
    paths share is scanned once. Other columns are not looked at. An empty table gives an empty one.
    """
    versions = versions.select("path", "text")
    ledger = Ledger(versions.sparkSession, ledger_path)
    ledger.update(versions, rules)
    return ledger.report(versions, rules)


def digest(spans: Column) -> Column:
    return F.sha2(spans.cast("binary"), 256)


def joined_spans(found: Column) -> Column:
    parts = F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")))
    return F.array_join(parts, ",")


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """Counts and digest of the base rules on one text, for tests."""
    text, hits = text or "", []
    patterns = [r.pattern.decode() for r in BASE_RULES]
    for rank, (rule, pattern) in enumerate(zip(BASE_RULES, patterns)):
        hits += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text) if len(m[rule.group]) >= rule.least]
    hits.sort()
    line = ",".join(f"{BASE_RULES[k].kind}:{s}:{e}" for s, k, e in hits)
    counts = [sum(h[1] == k for h in hits) for k in range(3)]
    return (*counts, hashlib.sha256(line.encode()).hexdigest())
