import os
import tempfile

from respengine.__main__ import main
from respengine.sources.tables import ctr_events
from respengine.sources.text import lines_from_observations

from conftest import SF001


def test_reference_flow_cli_on_text(spark):
    src = os.path.join(tempfile.mkdtemp(prefix="respengine-cli-src-"), "lines")
    lines_from_observations(ctr_events(spark, SF001)).select("line").write.text(src)
    out = tempfile.mkdtemp(prefix="respengine-cli-out-")
    main(["--text", src, "--out", out, "--ohe-iterations", "3", "--grid-iterations", "3"])
    names = set(os.listdir(out))
    assert {"split_sizes", "categories_per_feature", "ohe_dictionary", "ohe_smallest_weights",
            "feature_count_histogram", "roc_validation", "hash_grid", "hash_grid_surface",
            "metric_report"} <= names
    report = spark.read.parquet(os.path.join(out, "metric_report"))
    metrics = {(r["split"], r["features"], r["model"], r["metric"]) for r in report.collect()}
    assert ("test", "hashed", "logreg", "log_loss") in metrics
    assert ("train", "hashed", "none", "avg_nnz") in metrics
    sizes = dict(spark.read.parquet(os.path.join(out, "split_sizes")).collect())
    assert sizes["total"] == 1000
    assert spark.read.parquet(os.path.join(out, "hash_grid")).count() == 4


def test_cli_comma_separator_and_blank_positives(spark):
    src = tempfile.mkdtemp(prefix="respengine-cli-csv-")
    with open(os.path.join(src, "clicks.csv"), "w") as fh:
        for i in range(60):
            fh.write(f"{i % 2},{i % 3},{i % 5},x{i % 4}\n")
        fh.write("\n")  # an interior blank line
        fh.write("1,0,0,x0\n")
    out = tempfile.mkdtemp(prefix="respengine-cli-csv-out-")
    main(["--text", src, "--sep", ",", "--blank", "positive", "--out", out,
          "--ohe-iterations", "2", "--grid-iterations", "2"])
    sizes = dict(spark.read.parquet(os.path.join(out, "split_sizes")).collect())
    # 61 data lines + the interior blank line + the line after the final newline
    assert sizes["total"] == 63
    cats = dict(spark.read.parquet(os.path.join(out, "categories_per_feature")).collect())
    assert set(cats) == {0, 1, 2}
