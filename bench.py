"""Headline benchmark: the reference notebook's workload, step by step, on the
driver's tables at ``$BENCH_SF_DIR`` (default sf0.1) with ``local[$BENCH_CPUS]``.

Prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402

from respengine.operators.encode import build_dictionary, one_hot_encode  # noqa: E402
from respengine.operators.evaluate import base_rate_value, evaluate_many, roc_curve  # noqa: E402
from respengine.operators.hashing import DEFAULT_BUCKETS, hash_features  # noqa: E402
from respengine.operators.model import fit_logistic_gd, predict  # noqa: E402
from respengine.operators.profile import count_histogram  # noqa: E402
from respengine.operators.search import grid_search  # noqa: E402
from respengine.operators.split import hash_split, split_sizes  # noqa: E402
from respengine.plans.workflow import (GRID_ITERATIONS, GRID_REGS, GRID_STEPS,  # noqa: E402
                                        OHE_FIT, split_observations)
from respengine.session import ensure_checkpoint_dir, local_session  # noqa: E402
from respengine.sources.tables import ctr_events, lineitem_returns  # noqa: E402
from respengine.sources.text import (lines_from_observations, parse_lines,  # noqa: E402
                                     read_labelled_lines)

MEM = StorageLevel.MEMORY_AND_DISK


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="respengine-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # Warm the JVM and Python workers on a tiny input (not timed).
    warm_dir = "/root/testdata/sf0.001"
    warm = split_observations(ctr_events(spark, warm_dir if os.path.isdir(warm_dir) else sf_dir))
    wd = build_dictionary(warm.train)
    fit_logistic_gd(one_hot_encode(warm.train, wd), wd.size, iterations=2)

    obs = ctr_events(spark, sf_dir)
    # 1. text lines -> parse -> split sizes
    timed("parse_split", lambda: split_sizes(
        hash_split(parse_lines(lines_from_observations(obs)))).collect())
    # 1b. the same lines as a text file (written untimed), read back and split
    text_path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-text/{uuid.uuid4().hex}"
    lines_from_observations(obs).select("line").write.text(text_path)
    timed("text_read", lambda: split_sizes(
        hash_split(read_labelled_lines(spark, text_path))).collect())
    splits = split_observations(obs)
    # 2. dictionary on train
    d = timed("ohe_dictionary", lambda: build_dictionary(splits.train))
    # 3. encode train (strict) and validation (lenient), persisted
    tr = one_hot_encode(splits.train, d, unseen="error").persist(MEM)
    va = one_hot_encode(splits.validation, d, unseen="skip").persist(MEM)
    timed("ohe_encode", lambda: (tr.count(), va.count()))
    # 4. feature-frequency histogram
    timed("count_histogram", lambda: count_histogram(tr).collect())
    # 5. 50-iteration fit
    model = timed("ohe_fit_50", lambda: fit_logistic_gd(tr, d.size, **OHE_FIT))
    # 6. baseline and model log loss on train and validation
    rate = base_rate_value(tr)
    ohe_eval = timed("ohe_evaluate", lambda: tuple(zip(*[
        evaluate_many([model], f, baseline_rate=rate)[::-1] for f in (tr, va)])))
    # 7. ROC on validation
    timed("roc_curve", lambda: roc_curve(predict(model, va)).collect())
    # 8. hashed features for all splits
    hashed = [hash_features(f, DEFAULT_BUCKETS).persist(MEM)
              for f in (splits.train, splits.validation, splits.test)]
    timed("hash_encode", lambda: [h.count() for h in hashed])
    # 9. grid search, reference settings (up to 500 iterations, early stop)
    grid, best = timed("hash_grid", lambda: grid_search(hashed[0], hashed[1], DEFAULT_BUCKETS,
                                                        GRID_STEPS, GRID_REGS, GRID_ITERATIONS))
    # 10. best model and baseline on test
    final = timed("final_report",
                  lambda: evaluate_many([best], hashed[2], baseline_rate=rate)[::-1])
    # 11. wider labelled set: dictionary, encoding and 50-iteration fit on lineitem
    def lineitem():
        ls = split_observations(lineitem_returns(spark, sf_dir))
        ld = build_dictionary(ls.train)
        enc = one_hot_encode(ls.train, ld).persist(MEM)
        mdl = fit_logistic_gd(enc, ld.size, **OHE_FIT)
        ll = evaluate_many([mdl], one_hot_encode(ls.validation, ld))[0]
        enc.unpersist()
        return ll
    li_ll = timed("lineitem_ohe", lineitem)

    for f in [tr, va, *hashed]:
        f.unpersist()
    total = round(sum(times.values()), 3)
    grid_rows = grid.collect()
    quality = {
        "ohe_dictionary_size": d.size,
        "ohe_train_log_loss": {"baseline": ohe_eval[0][0], "logreg": ohe_eval[1][0]},
        "ohe_validation_log_loss": {"baseline": ohe_eval[0][1], "logreg": ohe_eval[1][1]},
        "hash_grid_validation_log_loss": {f"step={r['step_size']:g},reg={r['reg_param']:.0e}":
                                          r["log_loss"] for r in grid_rows},
        "hash_grid_iterations": [r["iterations"] for r in grid_rows],
        "hash_test_log_loss": {"baseline": final[0], "logreg": final[1]},
        "lineitem_validation_log_loss": li_ll,
    }
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "rows": {"events": obs.count()}, "quality": quality}))
    spark.stop()


if __name__ == "__main__":
    main()
