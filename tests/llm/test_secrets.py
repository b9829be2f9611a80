"""Secret scans against the patterns of Python's re, and the ledger."""
import re

from pyspark.sql import functions as F

from respengine.llm.queries import op4_secret_scan
from respengine.llm.secret_scan import RULES, listed, scan


def brute(text):
    spans = []
    for place, r in enumerate(RULES):
        for m in re.finditer(r.pattern.replace("(?i:", "(?ai:"), text or ""):
            if len(m.group(r.group)) >= r.least:
                spans.append((m.start(), place, f"{r.kind}:{m.start()}:{m.end()}"))
    return ",".join(s[2] for s in sorted(spans))


CASES = ["", None, "token = abcdefghijkl", "secret: token: abcdefghijklmnopq", "PassWd==abcdefghijk é",
         "日 AKIA" + "A1" * 7 + " AKIAAKIA" + "B" * 20, "x" * 50000 + " api_key='0123456789abcdef0'", "deadbeef" * 4,
         "token=short token=longenoughvalue1", "eyJabcdefgh.abcdefgh.abcdefgh", "-----BEGIN RSA PRIVATE KEY-----"]


def test_cases_and_second_scan(spark, documents, tmp_path):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(50, CASES[2]), (50, CASES[2]), (None, CASES[2])]
    df, ledger = documents(rows), str(tmp_path / "ledger")
    want = sorted((str(i), brute(t)) for i, t in rows)
    for _ in range(2):  # the second scan finds every blob in the ledger
        got = scan(df, ledger).select("doc_id", F.coalesce(listed(F.col("findings")), F.lit("")).alias("s")).collect()
        assert sorted((str(r.doc_id), r.s) for r in got) == want
        assert spark.read.parquet(f"{ledger}/scanned").count() == len(RULES) * (len(CASES) - 1)
    assert scan(documents([]), ledger).count() == 0


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.spans for r in op4_secret_scan(spark, "/root/testdata/sf0.01").collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs}


def test_large_ledger_and_one_row(spark, documents, tmp_path):
    """A later scan of one row neither broadcasts nor groups the ledger of all scans."""
    ledger = str(tmp_path / "ledger")
    blobs = spark.range(20_000).selectExpr("sha2(cast(id as string), 256) as digest")
    rules = spark.createDataFrame([(r.key,) for r in RULES], "rule string")
    blobs.crossJoin(rules).write.parquet(f"{ledger}/scanned")
    blobs.selectExpr("digest", "'hex/1' as rule", "explode(sequence(1L, 5L)) as start", "9L as end") \
        .write.parquet(f"{ledger}/findings")
    text = "token = abcdefghijkl"
    found = scan(documents([(1, text)]), ledger)
    assert [r.doc_id for r in found.collect()] == [1]
    assert found.select(listed(F.col("findings")).alias("s")).first().s == brute(text)
    # The joined table holds this scan's findings alone.
    read = found.inputFiles()
    assert any("secret_scan/found" in f for f in read) and not any(ledger in f for f in read)
    assert spark.read.parquet(f"{ledger}/findings").count() == 100_001


def test_no_pattern_is_quadratic(spark, documents, tmp_path):
    import time
    texts = ["eyJ" * 350_000, "eyJabcdefgh." * 90_000, "token" * 200_000, "-----BEGIN " * 100_000, "ghp_" * 250_000,
             "AKIA" * 250_000 + "!", "token" + " " * 1_000_000]
    began = time.monotonic()
    found = scan(documents(list(enumerate(texts))), str(tmp_path / "ledger")).collect()
    assert len(found) == len(texts) and time.monotonic() - began < 60
