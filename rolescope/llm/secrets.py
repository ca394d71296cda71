"""Secret scans over a ledger of content-addressed versions."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.llm.base import materialize
from rolescope.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those with a short ``group`` are dropped.

    ``hints`` are lower-case strings of which a matching text holds one (in either case).
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()


# The base rules, in the order in which kinds are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                   r"([A-Za-z0-9+/_.=-]+)", 6, 2, re.ASCII | re.IGNORECASE,
         ("password", "passwd", "secret", "token", "api_key", "apikey")),
    Rule("access", r"AKIA[A-Z0-9]+", 20, hints=("akia",)),
    # maximal runs of 24 or more are exactly the runs that are not dropped
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hints=("eyj",)),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36}",
         hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
)
RULES = {"base-1": BASE, "extra-1": EXTRA}
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def find(text: str, rules: tuple[Rule, ...], compiled: dict[str, re.Pattern]) -> list[tuple]:
    """``(kind, start, end)`` by code point, end exclusive, by start and then by rule order."""
    low = text.encode().lower()
    found = []
    for order, rule in enumerate(rules):
        if rule.hints and not any(h.encode() in low for h in rule.hints):
            continue
        for m in compiled[rule.kind].finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def scan_ledger(docs: DataFrame, ledger: str | None = None,
                rules: dict[str, tuple[Rule, ...]] | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``id, blob, findings`` for every row (path); ``findings`` maps rule versions to spans.

    Each text is addressed by the SHA-256 of its bytes. ``ledger`` is a folder of rows (blob,
    version, spans), one for each pair scanned so far, with an empty array if nothing was found.
    Only pairs that the ledger lacks are scanned, each blob once however many paths hold it; the
    new rows are appended in one commit, so a failed run leaves no half-scanned pair behind.
    Findings are then joined back to all paths. Without ``ledger`` a fresh one is started in the
    shared scratch folder.

    NULL text is the empty blob, NULL and repeated ids are paths like any other, an empty table
    gives no rows, other columns are ignored. Copies fold on the map side before texts move.
    """
    spark = docs.sparkSession
    rules = rules or RULES
    path = ledger or scratch_path(spark, "blob-ledger")
    schema = f"blob string, version string, spans {SPAN}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("blob"),
                        text.alias("text"))
    try:
        known = spark.read.schema(schema).parquet(path)
        known.limit(1).count()
    except AnalysisException:
        known = None
    texts = blobs.select("blob", "text")
    versions = F.array(*map(F.lit, sorted(rules)))
    if known is None:
        todo = texts.dropDuplicates(["blob"]).withColumn("versions", versions)
    else:
        done = known.where(F.col("version").isin(*rules)).groupBy("blob").agg(
            F.collect_set("version").alias("done"))  # at most one entry a rule version
        unseen = (blobs.select("blob").distinct().join(done, "blob", "left")
                  .withColumn("versions", F.array_except(
                      versions, F.coalesce("done", F.array().cast("array<string>"))))
                  .where(F.size("versions") > 0).select("blob", "versions"))
        unseen = materialize(unseen, "unseen-blobs")
        todo = (texts.join(unseen.select("blob"), "blob", "left_semi").dropDuplicates(["blob"])
                .join(unseen, "blob"))

    def scan(batches):
        compiled = {r.kind: re.compile(r.pattern, r.flags) for v in rules.values() for r in v}
        for batch in batches:
            out = [(blob, version, [dict(zip(("kind", "start", "end"), x))
                                    for x in find(body, rules[version], compiled)])
                   for blob, body, wanted in zip(*(c.to_pylist() for c in batch.columns))
                   for version in wanted]
            names = ("blob", "version", "spans")
            kinds = (pa.string(), pa.string(), pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    todo.select("blob", "text", "versions").mapInArrow(scan, schema).write.mode("append") \
        .parquet(path)
    found = (spark.read.schema(schema).parquet(path).where(F.col("version").isin(*rules))
             .groupBy("blob").agg(F.map_from_entries(F.collect_set(F.struct("version", "spans")))
                                  .alias("findings")))  # one entry a rule version
    return blobs.select("id", "blob").join(found, "blob").select(
        F.col("id").alias(id_col), "blob", "findings")


def span_text(spans, kinds: tuple[str, ...]):
    """``kind:start:end`` by start and then by order of ``kinds``, comma-joined."""
    order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
