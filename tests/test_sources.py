import os
import tempfile

from pyspark.sql import functions as F

from respengine.operators.split import hash_split
from respengine.sources.rows import with_content_ids
from respengine.sources.tables import ctr_events, doc_quality, lineitem_returns
from respengine.sources.text import (parse_lines, read_labelled_lines, read_lines,
                                     sample_observations)

from conftest import SF001


def _feats(row):
    return [(f["feature_id"], f["category"]) for f in row["feats"]]


def test_click_lines_fixture(spark):
    # FIXTURES 5: awkward labelled lines.
    lines = spark.createDataFrame(
        [(1, "1\t5\t\tab"), (2, "0\t5\tx\t\t"), (3, "2\t7"), (4, ""), (5, "  \t ")],
        "row_id long, line string")
    got = {r["row_id"]: r for r in parse_lines(lines).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["label"] == 1.0 and _feats(got[1]) == [(0, "5"), (1, ""), (2, "ab")]
    assert got[2]["label"] == 0.0 and _feats(got[2]) == [(0, "5"), (1, "x")]
    assert got[3]["label"] == 1.0 and _feats(got[3]) == [(0, "7")]
    pos = {r["row_id"]: r for r in parse_lines(lines, blank="positive").collect()}
    assert pos[4]["label"] == 1.0 and pos[4]["feats"] == []
    assert pos[5]["label"] == 1.0 and pos[5]["feats"] == []


def test_separator_is_literal(spark):
    lines = spark.createDataFrame([(1, "0|a.b|c")], "row_id long, line string")
    row = parse_lines(lines, sep="|").first()
    assert _feats(row) == [(0, "a.b"), (1, "c")]


def test_read_labelled_lines_file(spark):
    folder = tempfile.mkdtemp(prefix="respengine-text-")
    path = os.path.join(folder, "clicks.txt")
    with open(path, "w") as fh:
        fh.write("1\ta\tb\n0\tc\t\t\n\n1\td\r\n")
    rows = sorted(read_labelled_lines(spark, path).collect(), key=_feats)
    assert [r["label"] for r in rows] == [1.0, 0.0, 1.0]
    assert [_feats(r) for r in rows] == [[(0, "a"), (1, "b")], [(0, "c")], [(0, "d")]]
    assert len({r["row_id"] for r in rows}) == 3
    # blank line inside the file + the empty line after the final newline
    with_blank = read_labelled_lines(spark, path, blank="positive", num_partitions=2)
    assert with_blank.count() == 5
    blanks = with_blank.where("size(feats) = 0").collect()
    assert len(blanks) == 2 and all(r["label"] == 1.0 for r in blanks)
    no_final = os.path.join(folder, "no_final_newline.txt")
    with open(no_final, "w") as fh:
        fh.write("0\ta\n1\tb")
    assert read_labelled_lines(spark, no_final, blank="positive").count() == 2


def test_blank_positive_needs_plain_files(spark):
    import gzip

    import pytest
    folder = tempfile.mkdtemp(prefix="respengine-gz-")
    with gzip.open(os.path.join(folder, "a.txt.gz"), "wt") as fh:
        fh.write("1\ta\n\n")
    assert read_labelled_lines(spark, folder).count() == 1
    with pytest.raises(Exception, match="uncompressed"):
        read_labelled_lines(spark, folder, blank="positive").count()


def test_content_ids_do_not_follow_the_packing(spark):
    folder = tempfile.mkdtemp(prefix="respengine-packing-")
    for f in range(5):
        with open(os.path.join(folder, f"{f}.txt"), "w") as fh:
            fh.write("".join(f"{i % 2}\tv{i % 97}\n" for i in range(f, 400)) + "1\thot\n" * 300)
    seen = []
    for packed in ("64m", "700b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", packed)
        try:
            lines = read_lines(spark, folder)
            n = lines.count()
            seen.append(sorted(map(tuple, hash_split(lines, "row_id").collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1]
    assert n == len({r[0] for r in seen[0]}) == len(seen[0])


def test_many_copies_are_dealt_in_runs(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 'hot', cast(id as string)) as line")
    small = sorted(map(tuple, with_content_ids(df, F.col("line"), copies_per_run=7).collect()))
    assert small == sorted(map(tuple, with_content_ids(df, F.col("line")).collect()))
    assert len({r[0] for r in small}) == 1000 and sum(r[1] == "hot" for r in small) == 900


def test_sample(spark):
    rows = sorted(sample_observations(spark).collect(), key=lambda r: r["row_id"])
    assert [len(r["feats"]) for r in rows] == [2, 3, 3]


def test_table_views(spark):
    ce = ctr_events(spark, SF001)
    assert ce.count() == 1000
    assert ce.select("row_id").distinct().count() == 1000
    row = ce.first()
    assert [f["feature_id"] for f in row["feats"]] == [0, 1, 2, 3, 4]
    dq = doc_quality(spark, SF001)
    assert dq.count() > 0
    li = lineitem_returns(spark, SF001)
    assert li.count() == li.select("row_id").distinct().count()


def test_comma_separator_keeps_trailing_empties(spark):
    # strip() removes whitespace only: with ',' as the separator trailing empty
    # fields survive, while with tabs they are stripped away.
    lines = spark.createDataFrame([(1, "1,a,,b,, "), (2, "1\ta\t\tb\t\t ")],
                                  "row_id long, line string")
    comma = parse_lines(lines.where("row_id = 1"), sep=",").first()
    tab = parse_lines(lines.where("row_id = 2"), sep="\t").first()
    assert _feats(comma) == [(0, "a"), (1, ""), (2, "b"), (3, ""), (4, "")]
    assert _feats(tab) == [(0, "a"), (1, ""), (2, "b")]


def test_offsets_are_those_of_the_file(spark):
    from respengine.sources.text import with_offsets
    folder = tempfile.mkdtemp(prefix="respengine-offsets-")
    want = set()
    for f, end in (("a", "\n"), ("b", ""), ("c", "\n")):
        lines = [f"é{i}" * (i % 7) for i in range(500)] + ["last"]
        body, at = "\n".join(lines) + end, 0
        with open(os.path.join(folder, f"{f}.txt"), "w", newline="") as fh:
            fh.write(body)
        for line in lines:
            want.add((f"{f}.txt", at, line))
            at += len(line.encode()) + 1
    open(os.path.join(folder, "empty.txt"), "w").close()
    ids = []
    for packed in ("64m", "300b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", packed)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
        try:
            rows = with_offsets(spark, folder).collect()
            ids.append(sorted(map(tuple, read_lines(spark, folder).collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert {(r.file.rsplit("/", 1)[1], r.offset, r.line) for r in rows} == want and len(rows) == len(want)
    assert ids[0] == ids[1] and len({r[0] for r in ids[0]}) == len(want)
    plan = read_lines(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.split("BroadcastExchange")[0]
