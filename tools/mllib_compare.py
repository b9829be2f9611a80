"""Same-machine comparison with Spark MLlib's ``LogisticRegressionWithSGD``
(the public solver the reference calls) on the driver's tables.

Both sides fit the same encoded rows with the same settings; the script
reports wall time and the largest weight difference. MLlib gets its input the
way an RDD program would: a cached RDD of ``LabeledPoint`` built from the
encoded frame.

    python tools/mllib_compare.py [sf_dir]   -> one JSON line
"""

from __future__ import annotations

import json
import os
import sys
import time
import warnings

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    warnings.simplefilter("ignore")
    import numpy as np
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint

    from respengine.operators.encode import build_dictionary, one_hot_encode
    from respengine.operators.hashing import DEFAULT_BUCKETS, hash_features
    from respengine.operators.model import fit_logistic_gd, fit_logistic_many
    from respengine.plans.workflow import GRID_ITERATIONS, GRID_REGS, GRID_STEPS, OHE_FIT
    from respengine.plans.workflow import split_observations
    from respengine.session import local_session
    from respengine.sources.tables import ctr_events

    sf = sys.argv[1] if len(sys.argv) > 1 else os.environ.get("BENCH_SF_DIR",
                                                              "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    splits = split_observations(ctr_events(spark, sf))

    def labeled(df, d):
        rdd = df.select("label", "indices", "values").rdd.map(
            lambda r: LabeledPoint(r[0], SparseVector(d, r[1], r[2])))
        rdd.cache().count()
        return rdd

    out = {"sf_dir": sf}
    d_ohe = build_dictionary(splits.train)
    ohe = one_hot_encode(splits.train, d_ohe).cache()
    ohe.count()
    t0 = time.perf_counter()
    ours = fit_logistic_gd(ohe, d_ohe.size, **OHE_FIT)
    t_ours = time.perf_counter() - t0
    rdd = labeled(ohe, d_ohe.size)
    t0 = time.perf_counter()
    ml = LogisticRegressionWithSGD.train(rdd, iterations=OHE_FIT["iterations"],
                                         step=OHE_FIT["step_size"], regParam=OHE_FIT["reg_param"],
                                         regType="l2", intercept=True)
    t_ml = time.perf_counter() - t0
    out["ohe_fit_50"] = {"ours_sec": round(t_ours, 2), "mllib_sec": round(t_ml, 2),
                         "max_weight_diff": float(np.max(np.abs(np.array(ml.weights)
                                                                - ours.weights)))}

    n = DEFAULT_BUCKETS
    hashed = hash_features(splits.train, n).cache()
    hashed.count()
    configs = [(s, r) for s in GRID_STEPS for r in GRID_REGS]
    t0 = time.perf_counter()
    models = fit_logistic_many(hashed, n, configs, GRID_ITERATIONS)
    t_ours = time.perf_counter() - t0
    rdd = labeled(hashed, n)
    t_ml, diffs = 0.0, []
    for m, (s, r) in zip(models, configs):
        t0 = time.perf_counter()
        ml = LogisticRegressionWithSGD.train(rdd, iterations=GRID_ITERATIONS, step=float(s),
                                             regParam=r, regType="l2", intercept=True)
        t_ml += time.perf_counter() - t0
        diffs.append(float(np.max(np.abs(np.array(ml.weights) - m.weights))))
    out["hash_grid_4x500"] = {"ours_sec": round(t_ours, 2), "mllib_sec": round(t_ml, 2),
                              "iterations": [m.iterations for m in models],
                              "max_weight_diff": max(diffs)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
