"""respengine: Spark-native yes/no response modelling on categorical data.

Sources turn labelled text or any table into observation frames; operators
split, number, encode, hash, profile, fit, score and evaluate them with
DataFrame plans; ``plans`` wires them into the end-to-end workflows.
"""

from .functions.columns import (clamped_sigmoid, dense_dot, feature_string, log_loss,
                                md5_bucket, parse_features, parse_label, pow2_bucket,
                                sparse_dot, sparse_vector, strip_line)
from .operators.encode import (Dictionary, build_dictionary, categories_per_feature,
                               distinct_features, encoded_long, lookup, one_hot_encode, to_long)
from .operators.evaluate import (base_rate, base_rate_value, baseline_log_loss,
                                 evaluate_log_loss, evaluate_many, metric_report, roc_curve)
from .operators.hashing import hash_features
from .operators.model import (LogisticModel, fit_logistic_gd, fit_logistic_many, predict,
                              predict_many, smallest_weights)
from .operators.profile import count_histogram, feature_counts, sparsity
from .operators.search import grid_search, pivot_grid
from .operators.split import hash_split, random_split, split_frames, split_sizes
from .plans.workflow import (featurize_hash, featurize_ohe, final_report, run_hashed,
                              run_ohe, ohe_report, split_observations)
from .sources.tables import ctr_events, doc_quality, lineitem_returns, table_observations
from .sources.text import (parse_lines, read_labelled_lines, read_lines,
                           sample_observations)
