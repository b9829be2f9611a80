"""The reference notebook's whole flow as one call: every table it prints or
plots, computed with the library's operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.encode import categories_per_feature, lookup
from ..operators.evaluate import baseline_log_loss, evaluate_many, metric_report, roc_curve
from ..operators.hashing import DEFAULT_BUCKETS
from ..operators.model import LogisticModel, model_summary, predict, smallest_weights
from ..operators.profile import count_histogram, sparsity
from ..operators.search import pivot_grid
from ..operators.split import split_sizes
from .workflow import (GRID_ITERATIONS, GRID_REGS, GRID_STEPS, OHE_FIT, Splits, run_hashed,
                       run_ohe)


def hashed_entries(grid: DataFrame, best: LogisticModel | None, rate: float, validation: DataFrame,
                   test: DataFrame) -> list[tuple]:
    """Report entries of the hashed grid: a line for every cell, in grid order, then the
    training fraction and the best cell on validation and test (one row a cell is collected)."""
    cells = grid.orderBy("grid_pos").collect()
    out = [("validation", "hashed", f"step={r['step_size']!r}, reg={r['reg_param']!r}", "log_loss", float(r["log_loss"]))
           for r in cells]
    if best is not None:
        base = baseline_log_loss(rate, validation).first()["log_loss"]
        out.append(("validation", "hashed", "baseline", "log_loss", float(base)))
        out += [("validation", "hashed", "logreg", "log_loss", float(r["log_loss"])) for r in cells if r["is_best"]]
        model_ll, base = evaluate_many([best], test, baseline_rate=rate)
        out += [("test", "hashed", "baseline", "log_loss", base), ("test", "hashed", "logreg", "log_loss", model_ll)]
    return out


def reference_flow(splits: Splits, ohe_iterations: int = OHE_FIT["iterations"],
                   num_buckets: int = DEFAULT_BUCKETS, grid_steps=GRID_STEPS,
                   grid_regs=GRID_REGS, grid_iterations: int = GRID_ITERATIONS
                   ) -> dict[str, DataFrame]:
    """Split sizes, categories per feature, dictionary, one-hot model, histogram,
    ROC, hashed grid and surface, sparsity and the final test report."""
    spark = splits.train.sparkSession
    tagged = (splits.train.select(F.lit("train").alias("split"))
              .unionByName(splits.validation.select(F.lit("validation").alias("split")))
              .unionByName(splits.test.select(F.lit("test").alias("split"))))
    out: dict[str, DataFrame] = {
        "split_sizes": split_sizes(tagged),
        "categories_per_feature": categories_per_feature(splits.train),
    }
    ohe = run_ohe(splits, iterations=ohe_iterations)
    out["ohe_dictionary"] = ohe.dictionary.df
    out["ohe_lookup_empty_first_feature"] = lookup(ohe.dictionary, 0, "")
    out["ohe_model"] = model_summary(ohe.model, spark)
    out["ohe_smallest_weights"] = smallest_weights(ohe.model, spark, 5)
    out["feature_count_histogram"] = count_histogram(ohe.train)
    out["roc_validation"] = roc_curve(predict(ohe.model, ohe.validation))

    hashed = run_hashed(splits, num_buckets, grid_steps, grid_regs, grid_iterations)
    out["hash_grid"] = hashed.grid
    out["hash_grid_surface"] = pivot_grid(hashed.grid)

    entries = [("train", "ohe", "baseline", "base_rate", ohe.base_rate)]
    for name, enc in (("train", ohe.train), ("validation", ohe.validation)):
        model_ll, base = evaluate_many([ohe.model], enc, baseline_rate=ohe.base_rate)
        entries.append((name, "ohe", "baseline", "log_loss", base))
        entries.append((name, "ohe", "logreg", "log_loss", model_ll))
    for feats, enc, d in (("ohe", ohe.train, ohe.dictionary.size),
                          ("hashed", hashed.train, num_buckets)):
        sp = sparsity(enc, d).first()
        entries.append(("train", feats, "none", "avg_nnz", float(sp["avg_nnz"])))
        entries.append(("train", feats, "none", "density", float(sp["density"])))
    entries += hashed_entries(hashed.grid, hashed.best, ohe.base_rate, hashed.validation, hashed.test)
    out["metric_report"] = metric_report(spark, entries)
    return out
