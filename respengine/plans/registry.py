"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group, each reading the driver's tables in full.

Doubles are rounded to 6 places (and -0.0 folded to 0.0) on output so that a
row-by-row comparison with the SQL oracle is insensitive to summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import from_vector, with_vector
from ..functions.columns import dense_dot, log_loss, sparse_dot, sparse_from_dense
from ..operators.encode import (build_dictionary, categories_per_feature, distinct_features,
                                encoded_long, lookup, one_hot_encode, to_long,
                                with_feature_counts)
from ..operators.evaluate import (base_rate, base_rate_value, baseline_by_split, evaluate_many,
                                  metric_report, range_bounds, roc_curve)
from ..operators.hashing import DEFAULT_BUCKETS, hash_features, md5_buckets_long
from ..operators.joins import hot_threshold, lookup_join
from ..operators.model import predict, smallest_weights
from ..operators.model_ranges import fit_logistic_ranged, predict_ranged
from ..operators.profile import count_histogram, feature_counts, sparsity
from ..operators.search import grid_search, pivot_grid
from ..lifetime import own_frame, own_table
from ..operators.split import hash_split, random_split, split_sizes
from ..sources.tables import (ctr_event_features, ctr_events, doc_quality, lineitem_returns,
                              read_table)
from ..session import ensure_checkpoint_dir
from ..sources.text import (lines_from_observations, parse_lines, read_labelled_lines,
                            with_offsets)
from .report import hashed_entries
from .workflow import (GRID_ITERATIONS, GRID_REGS, GRID_STEPS, OHE_FIT, SPLIT_SEED, SPLIT_WEIGHTS,
                        final_report, run_ohe, ohe_report, split_observations)

COLLISION_BUCKETS = 16


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; ``+ 0.0`` folds -0.0 into 0.0."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _splits(spark, sf, storage="table"):
    return split_observations(ctr_events(spark, sf), storage=storage)


def _ohe(spark, sf):
    return run_ohe(_splits(spark, sf), **OHE_FIT)


def _fitted_weights(spark, res):
    weights = res.model.weights_df(spark)
    return rounded(weights.withColumn("iterations", F.lit(res.model.iterations).cast("int")))


# --- sources and parsing -------------------------------------------------------

def q_parse_long(spark: SparkSession, sf: str) -> DataFrame:
    """Events as tab-separated lines, stripped, split, labelled, numbered; long form."""
    lines = lines_from_observations(ctr_events(spark, sf))
    return to_long(parse_lines(lines, sep="\t", blank="drop"))


def q_text_file_long(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as tab-separated text to the checkpoint folder, then read back.

    The text reader numbers lines itself, so the result is the multiset of
    ``(label, feature_id, category)``.
    """
    path = own_table(f"{ensure_checkpoint_dir(spark).rstrip('/')}/text/{uuid.uuid4().hex}")
    lines_from_observations(ctr_events(spark, sf)).select("line").write.text(path)
    return to_long(read_labelled_lines(spark, path)).select("label", "feature_id", "category")


def awkward_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with blanks, interior empties and trailing separators, built from events."""
    ev = read_table(spark, sf, "events")
    f = ctr_event_features()
    label = F.when(F.col("event_type") == "click", F.lit("1")).otherwise(F.lit("0"))
    line = F.when(F.col("event_type") == "signup", F.lit(" \t ")).otherwise(
        F.concat_ws("\t", label, f[0], f[4], f[1], F.lit(""), F.lit(" ")))
    return ev.select(F.col("event_id").alias("row_id"), line.alias("line"))


def q_blank_and_ragged_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Blank lines kept as positives without features; trailing empties stripped, interior kept."""
    parsed = parse_lines(awkward_lines(spark, sf), sep="\t", blank="positive")
    return parsed.select(
        "row_id", "label", F.size("feats").cast("int").alias("n_features"),
        F.concat_ws("|", F.transform("feats", lambda f: f["category"])).alias("categories"))


# --- splitting -------------------------------------------------------------------

def q_split_sizes(spark, sf):
    """Hash split 80/10/10 (seed 42) and rows per split plus total."""
    return split_sizes(hash_split(ctr_events(spark, sf), "row_id", SPLIT_WEIGHTS, SPLIT_SEED))


def q_text_split_sizes(spark, sf):
    """Hash split of the events as text lines, whose ids come from their content."""
    path = own_table(f"{ensure_checkpoint_dir(spark).rstrip('/')}/text/{uuid.uuid4().hex}")
    lines_from_observations(ctr_events(spark, sf)).select("line").write.text(path)
    lines = read_labelled_lines(spark, path, ids="content")
    return split_sizes(hash_split(lines, "row_id", SPLIT_WEIGHTS, SPLIT_SEED))


def q_text_offsets(spark, sf):
    """Lines of a text file by byte offset: as many offsets as lines, and no byte left out."""
    path = own_table(f"{ensure_checkpoint_dir(spark).rstrip('/')}/text/{uuid.uuid4().hex}")
    lines_from_observations(ctr_events(spark, sf)).select("line").write.text(path)
    lines = with_offsets(spark, path)
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("places"),
        F.max(F.col("offset") + F.octet_length("line") + 1).alias("bytes"))
    return per_file.agg(F.sum("n").alias("n_lines"), F.sum("places").alias("n_offsets"), F.sum("bytes").alias("n_bytes"))


def q_lineitem_split_sizes(spark, sf):
    """Hash split of the wide set, which has no key of its own."""
    return split_sizes(hash_split(lineitem_returns(spark, sf), "row_id", SPLIT_WEIGHTS, SPLIT_SEED))


def q_random_split_native(spark, sf):
    """Spark's randomSplit with the same weights and seed (partition-dependent, rows only)."""
    parts = random_split(ctr_events(spark, sf), SPLIT_WEIGHTS, SPLIT_SEED)
    tagged = [p.select("row_id", F.lit(n).alias("split"))
              for p, n in zip(parts, ("train", "validation", "test"))]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def q_random_split_check(spark, sf):
    """Parts of randomSplit hold every row once, and shares near 0.8, 0.1 and 0.1.

    Shares are within six standard deviations of a draw per row.
    """
    counts = q_random_split_native(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"))
    weight = F.when(F.col("split") == "train", 0.8).otherwise(0.1)
    all_rows = ctr_events(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))
    off = F.abs(F.col("n") - weight * F.col("n_rows")) <= 6 * F.sqrt(weight * (1 - weight) * F.col("n_rows"))
    return counts.join(F.broadcast(all_rows)).groupBy("n_rows").agg(
        F.sum("n").alias("n_split"), F.sum("ids").alias("n_ids"), F.bool_and(off).alias("shares_hold"))


# --- dictionary and encoding ----------------------------------------------------------

def q_distinct_features(spark, sf):
    """A1: distinct (feature_id, category) pairs of the training split."""
    return distinct_features(_splits(spark, sf, storage=None).train)


def q_categories_per_feature(spark, sf):
    """A2, O1: distinct categories per feature id, ordered."""
    return categories_per_feature(_splits(spark, sf, storage=None).train)


def q_ohe_dictionary(spark, sf):
    """Dictionary ids in (feature_id, category) order, with training counts."""
    return build_dictionary(_splits(spark, sf).train).df


def q_ohe_dictionary_size(spark, sf):
    """A4: number of one-hot features."""
    d = build_dictionary(_splits(spark, sf).train)
    return d.df.agg(F.count(F.lit(1)).cast("bigint").alias("n_features"))


def q_ohe_lookup(spark, sf):
    """Id of one (feature_id, category) pair."""
    return lookup(build_dictionary(_splits(spark, sf).train), 4, "")


def q_ohe_encode_train(spark, sf):
    """Strict encoding of the training split, long form."""
    s = _splits(spark, sf)
    return encoded_long(one_hot_encode(s.train, build_dictionary(s.train), unseen="error"))


def q_ohe_encode_validation(spark, sf):
    """Lenient encoding of the validation split with the training dictionary."""
    s = _splits(spark, sf)
    return encoded_long(one_hot_encode(s.validation, build_dictionary(s.train), unseen="skip"))


def q_ohe_encode_validation_shuffled(spark, sf):
    """Same result through the large-dictionary plan: explode, salted shuffle join, regroup."""
    s = _splits(spark, sf)
    enc = one_hot_encode(s.validation, build_dictionary(s.train), unseen="skip",
                         max_broadcast_rows=0)
    return encoded_long(enc)


def q_ohe_empty_rows(spark, sf):
    """Every validation/test row is kept, with its number of known features."""
    s = _splits(spark, sf)
    d = build_dictionary(s.train)
    enc = one_hot_encode(s.validation.unionByName(s.test), d, unseen="skip")
    return with_feature_counts(enc).select("row_id", "label", F.col("nnz").cast("int"))


def q_lineitem_categories_per_feature(spark, sf):
    """A2 on the wide lineitem set (8 positions, up to tens of thousands of categories)."""
    return categories_per_feature(lineitem_returns(spark, sf))


def q_doc_quality_dictionary(spark, sf):
    """A3 on the second labelled set (documents with quality labels)."""
    s = split_observations(doc_quality(spark, sf))
    return build_dictionary(s.train).df


def q_doc_quality_fit(spark, sf):
    """M1 on the second labelled set: weights after up to 50 iterations, quality label."""
    return _fitted_weights(spark, run_ohe(split_observations(doc_quality(spark, sf)), **OHE_FIT))


def q_doc_quality_encode_test(spark, sf):
    """J2 on the second labelled set: known features per test row."""
    s = split_observations(doc_quality(spark, sf))
    enc = one_hot_encode(s.test, build_dictionary(s.train), unseen="skip")
    return with_feature_counts(enc).select("row_id", "label", F.col("nnz").cast("int"))


def q_sparse_vectors(spark, sf):
    """validation rows as MLlib sparse vectors and back, entry by entry."""
    s = _splits(spark, sf)
    d = build_dictionary(s.train)
    vectors = with_vector(one_hot_encode(s.validation, d, unseen="skip"), d.size)
    fields = vectors.select("row_id", "label", from_vector("features").alias("v"))
    return fields.select("row_id", "label", F.col("v.size").alias("size"), F.inline(
        F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("value"))))


# --- profiles ---------------------------------------------------------------------

def _ohe_train(spark, sf):
    s = _splits(spark, sf)
    d = build_dictionary(s.train)
    return one_hot_encode(s.train, d, unseen="error"), d


def q_feature_counts(spark, sf):
    """Rows holding each one-hot index."""
    return feature_counts(_ohe_train(spark, sf)[0])


def q_count_histogram(spark, sf):
    """Indices per power-of-two count bucket and their logs."""
    return rounded(count_histogram(_ohe_train(spark, sf)[0]))


def q_sparsity(spark, sf):
    """A10: mean stored entries per row and density, one-hot and hashed."""
    s = _splits(spark, sf)
    d = build_dictionary(s.train)
    ohe = sparsity(one_hot_encode(s.train, d), d.size).select(F.lit("ohe").alias("features"), "*")
    hashed = sparsity(hash_features(s.train, DEFAULT_BUCKETS), DEFAULT_BUCKETS).select(
        F.lit("hashed").alias("features"), "*")
    return rounded(ohe.unionByName(hashed), 9)


# --- hashing ------------------------------------------------------------------------

def q_md5_buckets(spark, sf):
    """feature strings and their md5 buckets for 4, 100 and 2^15 buckets."""
    return md5_buckets_long(ctr_events(spark, sf))


def q_hash_features(spark, sf):
    """F16, M7: hashed features (2^15 buckets), long form."""
    return encoded_long(hash_features(ctr_events(spark, sf), DEFAULT_BUCKETS))


def q_hash_collisions(spark, sf):
    """Hashed features with 16 buckets, where collisions add up."""
    return encoded_long(hash_features(ctr_events(spark, sf), COLLISION_BUCKETS))


def q_lineitem_hash_nnz(spark, sf):
    """F16 on the wide lineitem set: rows by stored entries and summed counts."""
    h = hash_features(lineitem_returns(spark, sf), 1024)
    return (h.select(F.size("indices").alias("nnz"),
                     F.aggregate("values", F.lit(0.0), lambda a, v: a + v).alias("total"))
            .groupBy("nnz", "total").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


# --- scalar functions -------------------------------------------------------------------

def q_dot_products(spark, sf):
    """dense and sparse dot products over consecutive embeddings."""
    e = read_table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next_emb"))
    j = e.join(nxt, "vec_id")
    idx, val = sparse_from_dense(F.col("embedding"), 0.0)
    out = j.select("vec_id", dense_dot("embedding", "next_emb").alias("dense_dot"),
                   sparse_dot(idx, val, F.col("next_emb")).alias("sparse_dot"),
                   F.size(idx).cast("int").alias("nnz"))
    return rounded(out)


def q_log_loss_scalar(spark, sf):
    """Log loss of each event against its (user, hour) click fraction (0 and 1 occur).

    The fractions are a partial + final aggregate joined back through the
    skew-safe lookup join, so a user holding a third of all events is never
    one task's group.
    """
    ev = read_table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"), "user_id", F.hour("ts").alias("hour"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("label"))
    groups = own_frame(ev.groupBy("user_id", "hour")
                       .agg(F.avg(F.col("label").cast("double")).alias("p"), F.count(F.lit(1)).alias("n"))
                       .persist())
    stats = groups.agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("t")).first()
    hot = groups.where(F.col("n") >= F.lit(hot_threshold(stats["t"] or 0))).select(
        "user_id", "hour", "p")
    with_p = lookup_join(ev, groups.select("user_id", "hour", "p"), ["user_id", "hour"],
                         table_rows=int(stats["g"]), table_bytes=24 * int(stats["g"]), hot_keys=hot)
    return rounded(with_p.select("row_id", "p", F.col("label").cast("int"),
                                 log_loss(F.col("p"), F.col("label")).alias("log_loss")))


# --- baselines, fit, scoring -------------------------------------------------------------

def q_base_rate(spark, sf):
    """Click fraction of the training split."""
    return rounded(base_rate(_splits(spark, sf, storage=None).train))


def q_baseline_log_loss(spark, sf):
    """Training fraction as the prediction, log loss per split."""
    tagged = hash_split(ctr_events(spark, sf), "row_id", SPLIT_WEIGHTS, SPLIT_SEED)
    return rounded(baseline_by_split(tagged))


def q_ohe_fit(spark, sf):
    """M1: weights and intercept (idx -1) after up to 50 gradient-descent iterations."""
    return _fitted_weights(spark, _ohe(spark, sf))


def _ranged(spark, sf):
    s = _splits(spark, sf)
    d = build_dictionary(s.train)
    train = one_hot_encode(s.train, d, unseen="error")
    # Small ranges and blocks, so that every iteration moves weights between them.
    return s, d, fit_logistic_ranged(train, d.size, **OHE_FIT, width=128, block_rows=4096)


def q_ohe_fit_ranged(spark, sf):
    """M1 with weights cut by index range, which no machine holds whole."""
    _, _, model = _ranged(spark, sf)
    bias = spark.createDataFrame([(-1, model.intercept)], "idx int, weight double")
    return rounded(model.weights_df().unionAll(bias).withColumn("iterations", F.lit(model.iterations).cast("int")))


def q_predict_scores_ranged(spark, sf):
    """Scores from weights cut by index range, looked up by blocks of rows."""
    s, d, model = _ranged(spark, sf)
    return rounded(predict_ranged(model, one_hot_encode(s.validation, d, unseen="skip")))


def q_smallest_weights(spark, sf):
    """O3: the five smallest weights of the fitted model."""
    res = _ohe(spark, sf)
    return rounded(smallest_weights(res.model, spark, k=5, tie_digits=6))


def q_predict_scores(spark, sf):
    """Clamped-sigmoid scores of the validation rows."""
    res = _ohe(spark, sf)
    return rounded(predict(res.model, res.validation))


def q_predict_scores_shuffled(spark, sf):
    """Same scores through the large-model plan (shuffled weight join, hot indices salted)."""
    res = _ohe(spark, sf)
    return rounded(predict(res.model, res.validation, max_broadcast_rows=0))


def q_evaluate_log_loss(spark, sf):
    """Model log loss on train, validation and test."""
    s = _splits(spark, sf)
    res = run_ohe(s, **OHE_FIT)
    test = one_hot_encode(s.test, res.dictionary, unseen="skip")
    rows = [(n, evaluate_many([res.model], f)[0])
            for n, f in (("train", res.train), ("validation", res.validation), ("test", test))]
    return rounded(spark.createDataFrame(rows, "split string, log_loss double"))


def q_roc_curve(spark, sf):
    """ROC running sums over validation scores."""
    res = _ohe(spark, sf)
    # The score is already the 9-digit tie key; rounding it again to 6 places
    # would round twice, so the whole table keeps 9 digits.
    return rounded(roc_curve(predict(res.model, res.validation), round_digits=9), 9)


def q_roc_curve_ranged(spark, sf):
    """Same curve from eight score ranges, the plan of large inputs."""
    res = _ohe(spark, sf)
    return rounded(roc_curve(predict(res.model, res.validation), round_digits=9, num_ranges=8), 9)


def q_roc_ranges(spark, sf):
    """Ranges of the amounts of line items by exact counts: whole, and none above twice the mean."""
    amounts = read_table(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("double").alias("score")) \
        .where("score is not null").distinct()
    bounds = range_bounds(amounts, "score", 50)
    at = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("score")))
    sizes = amounts.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("n_points"), (F.max("n") <= 2 * F.avg("n")).alias("even"))


def q_roc_curve_binned(spark, sf):
    """W2 with num_bins=20: the curve at score bins of width 1/20."""
    res = _ohe(spark, sf)
    return rounded(roc_curve(predict(res.model, res.validation), num_bins=20), 9)


def q_metric_report(spark, sf):
    """One-hot report (base rate, baseline and model log loss, sparsity) with text."""
    return rounded(ohe_report(_ohe(spark, sf)))


# --- hashed grid -------------------------------------------------------------------------

def _grid(spark, sf):
    s = _splits(spark, sf)
    tr = hash_features(s.train, DEFAULT_BUCKETS)
    va = hash_features(s.validation, DEFAULT_BUCKETS)
    grid, best = grid_search(tr, va, DEFAULT_BUCKETS, GRID_STEPS, GRID_REGS, GRID_ITERATIONS)
    return s, grid, best


def q_grid_search(spark, sf):
    """M2, M3: 2 x 2 grid on hashed features, validation log loss, best cell."""
    return rounded(_grid(spark, sf)[1])


def q_grid_pivot(spark, sf):
    """M4: the grid as a step-by-regulariser surface."""
    return rounded(pivot_grid(_grid(spark, sf)[1], GRID_REGS))


def q_final_report(spark, sf):
    """Best grid model and baseline on the test split."""
    s, _, best = _grid(spark, sf)
    rate = base_rate_value(s.train)
    return rounded(final_report(best, rate, hash_features(s.test, DEFAULT_BUCKETS)))


def q_hashed_report(spark, sf):
    """The grid's lines, the best cell beside the baseline on validation and test."""
    s, grid, best = _grid(spark, sf)
    rate = base_rate_value(s.train)
    frames = [hash_features(f, DEFAULT_BUCKETS) for f in (s.validation, s.test)]
    return rounded(metric_report(spark, hashed_entries(grid, best, rate, *frames)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_long": q_parse_long,
    "text_file_long": q_text_file_long,
    "blank_and_ragged_lines": q_blank_and_ragged_lines,
    "split_sizes": q_split_sizes,
    "distinct_features": q_distinct_features,
    "categories_per_feature": q_categories_per_feature,
    "ohe_dictionary": q_ohe_dictionary,
    "ohe_dictionary_size": q_ohe_dictionary_size,
    "ohe_lookup": q_ohe_lookup,
    "ohe_encode_train": q_ohe_encode_train,
    "ohe_encode_validation": q_ohe_encode_validation,
    "ohe_encode_validation_shuffled": q_ohe_encode_validation_shuffled,
    "ohe_empty_rows": q_ohe_empty_rows,
    "lineitem_categories_per_feature": q_lineitem_categories_per_feature,
    "doc_quality_dictionary": q_doc_quality_dictionary,
    "doc_quality_encode_test": q_doc_quality_encode_test,
    "doc_quality_fit": q_doc_quality_fit,
    "feature_counts": q_feature_counts,
    "count_histogram": q_count_histogram,
    "md5_buckets": q_md5_buckets,
    "hash_features": q_hash_features,
    "hash_collisions": q_hash_collisions,
    "lineitem_hash_nnz": q_lineitem_hash_nnz,
    "sparsity": q_sparsity,
    "dot_products": q_dot_products,
    "log_loss_scalar": q_log_loss_scalar,
    "base_rate": q_base_rate,
    "baseline_log_loss": q_baseline_log_loss,
    "ohe_fit": q_ohe_fit,
    "smallest_weights": q_smallest_weights,
    "predict_scores": q_predict_scores,
    "predict_scores_shuffled": q_predict_scores_shuffled,
    "evaluate_log_loss": q_evaluate_log_loss,
    "roc_curve": q_roc_curve,
    "roc_curve_ranged": q_roc_curve_ranged,
    "roc_curve_binned": q_roc_curve_binned,
    "grid_search": q_grid_search,
    "grid_pivot": q_grid_pivot,
    "metric_report": q_metric_report,
    "final_report": q_final_report,
    "text_split_sizes": q_text_split_sizes,
    "text_offsets": q_text_offsets,
    "sparse_vectors": q_sparse_vectors,
    "ohe_fit_ranged": q_ohe_fit_ranged,
    "predict_scores_ranged": q_predict_scores_ranged,
    "roc_ranges": q_roc_ranges,
    "hashed_report": q_hashed_report,
    "lineitem_split_sizes": q_lineitem_split_sizes,
    "random_split_native": q_random_split_native,
    "random_split_check": q_random_split_check,
}
