"""canopy: entropy-based categorical decision trees as Spark DataFrame plans.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects (or
``Column`` expressions) on the caller's session.  Nothing here sets the
master, and no data passes through the driver except a handful of scalars
per tree level (the loop condition) and three quartile cut points.
"""

from canopy.functions.columns import (
    entropy,
    flag_to_boolean,
    hash_bucket,
    ratio_above,
    rating_bucket,
    squared_error,
    text_length,
)
from canopy.operators.contingency import (
    attr_value_counts,
    attr_value_counts_join,
    cells,
    class_counts,
    distinct_values,
    domain_violations,
    leaf_labels,
    node_counts,
    node_split,
    path_filter,
)
from canopy.operators.discretize import bin_quartiles, quartile_cuts, quartile_cuts_approx
from canopy.operators.evaluate import class_report, mean_squared_error, prediction_truth_join
from canopy.operators.forest import grow_forest, predict_forest
from canopy.operators.impurity import best_attribute, info_gain
from canopy.operators.predict import predict
from canopy.operators.prepare import fill_missing, prepare_reviews, row_index
from canopy.operators.quantiles import exact_quantiles
from canopy.operators.sampling import random_split, split_train_test
from canopy.operators.tree import grow_tree, tree_rules
from canopy.plans.end_to_end import binned_sides, evaluate, score_cells, score_forest, train_forest, train_tree
from canopy.sources.reviews import REVIEW_COLUMNS, read_review_lines, read_reviews
from canopy.sources.trees import load_tree, save_tree

__all__ = [
    "REVIEW_COLUMNS",
    "attr_value_counts",
    "attr_value_counts_join",
    "best_attribute",
    "binned_sides",
    "bin_quartiles",
    "cells",
    "class_counts",
    "class_report",
    "distinct_values",
    "domain_violations",
    "entropy",
    "evaluate",
    "exact_quantiles",
    "fill_missing",
    "flag_to_boolean",
    "grow_forest",
    "grow_tree",
    "hash_bucket",
    "info_gain",
    "leaf_labels",
    "load_tree",
    "mean_squared_error",
    "node_counts",
    "node_split",
    "path_filter",
    "predict",
    "predict_forest",
    "prediction_truth_join",
    "prepare_reviews",
    "quartile_cuts",
    "quartile_cuts_approx",
    "random_split",
    "ratio_above",
    "rating_bucket",
    "read_review_lines",
    "read_reviews",
    "row_index",
    "save_tree",
    "score_cells",
    "score_forest",
    "split_train_test",
    "squared_error",
    "text_length",
    "train_forest",
    "train_tree",
    "tree_rules",
]
