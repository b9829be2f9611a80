"""End-to-end workflows: the one-hot model, the hashed grid search and the
final report. Each step is a lazy DataFrame plan except the fits (one Spark
job per iteration) and the small scalars they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.encode import Dictionary, build_dictionary, one_hot_encode
from ..operators.evaluate import base_rate_value, evaluate_many, metric_report
from ..operators.hashing import DEFAULT_BUCKETS, hash_features
from ..operators.model import LogisticModel, fit_logistic_gd
from ..operators.profile import sparsity
from ..operators.search import grid_search
from ..operators.split import hash_split, split_frames
from ..lifetime import own_frame
from ..session import materialize

# The reference's settings.
SPLIT_WEIGHTS = (0.8, 0.1, 0.1)
SPLIT_SEED = 42
OHE_FIT = {"iterations": 50, "step_size": 10.0, "reg_param": 1e-6}
GRID_STEPS = [1, 10]
GRID_REGS = [1e-6, 1e-3]
GRID_ITERATIONS = 500


@dataclass
class Splits:
    train: DataFrame
    validation: DataFrame
    test: DataFrame


def split_observations(obs: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED,
                       storage: str | None = "table") -> Splits:
    """Hash split of an observation frame into train / validation / test.

    The source is read once: the split tag is computed in one pass and the
    tagged observations are kept, instead of scanning the whole source again
    for every split and every later pass (an md5 filter cannot be pushed into
    the scan). ``storage='table'`` (default) writes them once to the
    checkpoint folder partitioned by split, so each split reads only its own
    folder and nothing is recomputed from the source after an executor loss;
    ``storage='cache'`` persists them instead (memory, then local disk), which
    is cheaper for small inputs but makes every split a filter over all rows;
    ``None`` keeps three independent filters of the source.
    """
    names = ("train", "validation", "test")
    if storage is None:
        tr, va, te = split_frames(obs, "row_id", weights, seed, names)
        return Splits(tr, va, te)
    if storage not in ("cache", "table"):
        raise ValueError("storage must be 'cache', 'table' or None")
    tagged = hash_split(obs, "row_id", weights, seed, names, col="split")
    if storage == "cache":
        tagged = own_frame(tagged.persist(StorageLevel.MEMORY_AND_DISK))
    else:
        tagged = materialize(tagged, partition_by="split")
    parts = [tagged.where(F.col("split") == F.lit(n)).drop("split") for n in names]
    return Splits(*parts)


def featurize_ohe(obs: DataFrame, dictionary: Dictionary, unseen: str = "skip") -> DataFrame:
    """Parsed observations -> labelled one-hot rows ``(row_id, label, indices, values)``."""
    return one_hot_encode(obs, dictionary, unseen=unseen)


def featurize_hash(obs: DataFrame, num_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Parsed observations -> labelled hashed rows; needs no dictionary and no shuffle."""
    return hash_features(obs, num_buckets)


@dataclass
class OheResult:
    dictionary: Dictionary
    train: DataFrame
    validation: DataFrame
    model: LogisticModel
    base_rate: float


def run_ohe(splits: Splits, iterations: int = OHE_FIT["iterations"],
                 step_size: float = OHE_FIT["step_size"],
                 reg_param: float = OHE_FIT["reg_param"]) -> OheResult:
    """Dictionary on train, strict encoding of train, lenient of validation, one fit."""
    dictionary = build_dictionary(splits.train)
    train = own_frame(one_hot_encode(splits.train, dictionary, unseen="error").persist(
        StorageLevel.MEMORY_AND_DISK))
    validation = own_frame(one_hot_encode(splits.validation, dictionary, unseen="skip").persist(
        StorageLevel.MEMORY_AND_DISK))
    model = fit_logistic_gd(train, dictionary.size, iterations, step_size, reg_param)
    rate = base_rate_value(train)
    return OheResult(dictionary, train, validation, model, rate)


def ohe_report(res: OheResult) -> DataFrame:
    """Baseline and model log loss on train and validation, plus base rate and sparsity."""
    spark = res.train.sparkSession
    entries = [("train", "ohe", "baseline", "base_rate", res.base_rate)]
    for name, enc in (("train", res.train), ("validation", res.validation)):
        model_ll, base = evaluate_many([res.model], enc, baseline_rate=res.base_rate)
        entries.append((name, "ohe", "baseline", "log_loss", float(base)))
        entries.append((name, "ohe", "logreg", "log_loss", float(model_ll)))
    sp = sparsity(res.train, res.dictionary.size).first()
    entries.append(("train", "ohe", "none", "avg_nnz", float(sp["avg_nnz"])))
    entries.append(("train", "ohe", "none", "density", float(sp["density"])))
    return metric_report(spark, entries)


@dataclass
class HashResult:
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    grid: DataFrame
    best: LogisticModel | None
    num_buckets: int


def run_hashed(splits: Splits, num_buckets: int = DEFAULT_BUCKETS, steps=GRID_STEPS,
                    regs=GRID_REGS, iterations: int = GRID_ITERATIONS) -> HashResult:
    """Hash all three splits, then grid-search on train against validation."""
    frames = [own_frame(hash_features(f, num_buckets).persist(StorageLevel.MEMORY_AND_DISK))
              for f in (splits.train, splits.validation, splits.test)]
    grid, best = grid_search(frames[0], frames[1], num_buckets, steps, regs, iterations)
    return HashResult(frames[0], frames[1], frames[2], grid, best, num_buckets)


def final_report(best: LogisticModel, rate: float, test: DataFrame,
                 features: str = "hashed") -> DataFrame:
    """Best model and train-fraction baseline on the test split."""
    spark = test.sparkSession
    model_ll, base = evaluate_many([best], test, baseline_rate=rate)
    return metric_report(spark, [("test", features, "baseline", "log_loss", base),
                                 ("test", features, "logreg", "log_loss", model_ll)])


def release(*frames: DataFrame) -> None:
    """Drop the cached copies of frames a workflow persisted."""
    for f in frames:
        f.unpersist()


__all__ = ["Splits", "split_observations", "featurize_ohe", "featurize_hash", "run_ohe",
           "ohe_report", "run_hashed", "final_report", "OheResult", "HashResult"]
