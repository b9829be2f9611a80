"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the digest of its content. The ledger (two
Parquet tables in a shared folder) knows which blob was scanned by which rule version and
what was found. A scan reads the text of one path per blob, and only of blobs with a rule
version not yet in the ledger, runs those rules, appends to the ledger, and joins the
findings back to all paths. DataFrame functions only: matches come from the regular
expression functions, their places from running sums over the pieces between them.

Findings are written before the entry that says they are complete; a scan that dies in
between is repeated, and equal findings are read once.

Defined results: null text is the empty text; rows with equal text (or equal rows) share
a blob, and each row gets its findings; a null path is a path; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from respengine.llm.common import stored
from respengine.llm.exact_dedup import BROADCAST_ROWS, MAX_HOT, located, sha256
from respengine.operators.joins import hot_threshold, lookup_join


@dataclass(frozen=True)
class Rule:
    """``pattern``: found leftmost, without overlap. ``group`` of a match needs at least
    ``least`` characters, else the match is dropped (its characters stay used up)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


# Fixed patterns. Runs of the last two base kinds are maximal, so asking for their least
# length inside the pattern finds the same spans as dropping short matches.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    # Only where a run of its characters begins, and without giving any back: a text made
    # of beginnings is read once, not once for each of them.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", version=2,
         base=False),
)

# A row and a finding of the joined table, in bytes, generously.
DIGEST_BYTES, FINDING_BYTES = 128, 96

SCANNED = "digest string, rule string"
FINDINGS = "digest string, rule string, start long, end long"


def _ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path).distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _matches(rule: Rule, text: Column) -> Column:
    """``(rule, i, gap, length, good)`` of all matches: ``gap`` is the length of the text
    between the match before and this one."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern)

    def entry(pair: Column, i: Column) -> Column:
        good = F.lit(True) if not rule.least else F.length(
            F.regexp_extract(pair["found"], rule.pattern, rule.group)) >= rule.least
        return F.struct(F.lit(rule.key).alias("rule"), i.alias("i"), F.length(pair["gap"]).alias("gap"),
                        F.length(pair["found"]).alias("length"), good.alias("good"))

    pairs = F.arrays_zip(found.alias("found"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    return F.transform(pairs, entry)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of ``blobs`` (digest, text, todo: keys of the rules to run)."""
    none = F.array().cast("array<struct<rule:string,i:int,gap:int,length:int,good:boolean>>")
    hits = [F.when(F.array_contains("todo", r.key) & F.col("text").rlike(r.pattern),
                   _matches(r, F.col("text"))).otherwise(none) for r in rules]
    each = blobs.select("digest", F.explode_outer(F.concat(*hits)).alias("m")) \
        .select("digest", "m.*").where("rule is not null")
    # (An inner explode would evaluate the expressions twice, once to filter.)
    before = Window.partitionBy("digest", "rule").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    return each.withColumn("end", end).where("good").select(
        "digest", "rule", (F.col("end") - F.col("length")).cast("long").alias("start"),
        F.col("end").cast("long").alias("end"))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, *,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, findings`` for every row of ``versions``.

    ``findings`` is an array of (start, place of the kind in ``rules``, kind, end, base)
    in order, null where there are none.
    """
    spark = versions.sparkSession
    content = located(versions, id_col, text_col)
    rows = stored(content.select("doc_id", "file", "pos", sha256(F.col("text")).alias("digest")),
                  "secret_scan/rows")
    sizes = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("file", "pos")).alias("at"))
    total = sizes.agg(F.sum("n")).first()[0]

    keys = F.array(*[F.lit(r.key) for r in rules])
    wanted = sizes.select("digest", "at", F.explode(keys).alias("rule"))
    unseen = wanted.join(_ledger(spark, f"{ledger}/scanned", SCANNED), ["digest", "rule"], "left_anti") \
        .groupBy("digest").agg(F.first("at").alias("at"), F.collect_set("rule").alias("todo"))
    todo = stored(unseen.select("digest", "at.file", "at.pos", "todo"), "secret_scan/todo")
    blobs = content.select("file", "pos", "text").join(todo, ["file", "pos"]).select("digest", "text", "todo")
    scan_blobs(blobs, rules).write.mode("append").parquet(f"{ledger}/findings")
    todo.select("digest", F.explode("todo").alias("rule")).write.mode("append").parquet(f"{ledger}/scanned")

    place = F.create_map(*[x for i, r in enumerate(rules) for x in (
        F.lit(r.key), F.struct(F.lit(i).alias("place"), F.lit(r.kind).alias("kind"), F.lit(r.base).alias("base")))])
    rule = place[F.col("rule")]
    # The ledger may be far larger than this scan: only findings of its own blobs are grouped,
    # and their rows and bytes decide how they are joined.
    found = _ledger(spark, f"{ledger}/findings", FINDINGS).where(F.col("rule").isin(*[r.key for r in rules])) \
        .join(sizes.select("digest"), "digest", "left_semi")
    per_blob = found.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct(
        "start", rule["place"].alias("place"), rule["kind"].alias("kind"), "end",
        rule["base"].alias("base")))).alias("findings"))
    per_blob = stored(per_blob, "secret_scan/found")
    blobs_found, spans = per_blob.agg(F.count("*"), F.sum(F.size("findings"))).first()
    hot = sizes.where(F.col("n") >= hot_threshold(total or 0, MAX_HOT)).select("digest")
    return lookup_join(rows.select("doc_id", "digest"), per_blob, ["digest"], table_rows=blobs_found,
                       table_bytes=blobs_found * DIGEST_BYTES + (spans or 0) * FINDING_BYTES,
                       hot_keys=hot, max_broadcast_rows=BROADCAST_ROWS)


def listed(findings: Column) -> Column:
    """``kind:start:end`` of the findings, joined by commas."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
