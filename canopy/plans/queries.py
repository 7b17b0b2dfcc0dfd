"""Registered queries: one per operator of the inventory, each over the
whole provided tables (``queries()`` in ``__spark_entry__``).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the DuckDB text of the same key in ``plans.oracle``.
Doubles that come out of floating-point formulas (entropy, gain, error)
are rounded to 9 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.columns import (
    entropy,
    flag_to_boolean,
    rating_bucket,
    ratio_above,
    squared_error,
)
from canopy.operators._lineage import durable
from canopy.operators.contingency import (
    attr_value_counts,
    attr_value_counts_join,
    class_counts,
    distinct_values,
    domain_violations,
    leaf_labels,
    long_counts,
    node_split,
    path_filter,
)
from canopy.operators.continuous import best_cuts, grow_mixed_tree, predict_mixed
from canopy.operators.discretize import quartile_cuts, quartile_cuts_approx
from canopy.operators.evaluate import class_report, mean_squared_error, prediction_truth_join
from canopy.operators.forest import predict_forest
from canopy.operators.impurity import best_attribute, info_gain
from canopy.operators.predict import predict
from canopy.operators.prepare import ATTRIBUTES, LABEL, row_index
from canopy.operators.prune import prune
from canopy.operators.sampling import split_train_test, with_side
from canopy.operators.tree import TREE_COLUMNS, grow_tree, tree_rules
from canopy.plans.fixtures import fixture_d, fixture_l, vowel_count
from canopy.plans.end_to_end import binned_sides, evaluate, score_forest, train_forest, train_tree
from canopy.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 9

# Parameters of individual queries.
PATH_L = (("marketplace", "ASIA"), ("vine", "F"))
DOMAINS_L = {
    "marketplace": ("AFRICA", "AMERICA", "ASIA", "EUROPE"),
    "verified_purchase": ("F", "O"),
    "vine": ("F", "O"),
    "product_category": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "review_body": ("(0,Q1]", "(Q1,Q2]", "(Q2,Q3]", "Q3"),
}
DOMAINS_D = {
    "marketplace": ("de", "en", "fr"),
    "verified_purchase": ("0", "1"),
    "vine": ("0",),
}
UNSEEN_LANG = "es"
CATEGORIES = ("marketplace", "verified_purchase", "vine", "product_category")
NUMBERS = ("body_len", "l_linenumber")
MIXED_DEPTH, MIXED_ROWS = 3, 20


def _r(c, name: str):
    return F.round(c, ROUND).alias(name)


# --- scans, projections, derived columns -------------------------------------------------


def q_scan_project(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    labels = read_table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("lang").alias("marketplace"),
        F.col("quality").cast("string").alias("verified_purchase"),
        F.col("toxic").cast("string").alias("vine"),
        F.col("source").alias("product_category"),
        vowel_count(F.col("text")).cast("bigint").alias("helpful_votes"),
        F.col("n_chars").alias("total_votes"),
    )


def q_row_count(spark: SparkSession, d: str) -> DataFrame:
    return fixture_l(spark, d).agg(F.count(F.lit(1)).alias("n_rows"))


def q_ratio_target(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.try_divide("l_tax", "l_discount").alias("ratio"),
        ratio_above("l_tax", "l_discount", 0.5).alias(LABEL),
    )


def q_flag_to_boolean(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", flag_to_boolean("l_linestatus", "F").alias("verified_flag"))


def q_fill_missing(spark: SparkSession, d: str) -> DataFrame:
    return fixture_d(spark, d).select("doc_id", "marketplace", "verified_purchase", "vine", "product_category")


def q_rating_bucket(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rating_bucket(F.col("l_linenumber").cast("string")).alias("star_rating"))


def q_text_length(spark: SparkSession, d: str) -> DataFrame:
    return fixture_d(spark, d).select("doc_id", F.col("body_len").alias("review_body"))


def q_row_index(spark: SparkSession, d: str) -> DataFrame:
    return row_index(read_table(spark, d, "documents").select("doc_id"), "doc_id")


# --- split and discretisation ------------------------------------------------------------


def q_split_train_test(spark: SparkSession, d: str) -> DataFrame:
    # both sides in one pass: the side is a column, not two filters over the same joins
    return with_side(fixture_l(spark, d), "key").groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(LABEL)).alias("n_pos"),
        F.count_if(~F.col(LABEL)).alias("n_neg"),
    )


def q_quartile_cuts(spark: SparkSession, d: str) -> DataFrame:
    sided, _ = durable(with_side(fixture_l(spark, d), "key").select("side", "body_len"))
    return quartile_cuts(sided, "body_len", by=["side"])


def q_quartile_cuts_approx(spark: SparkSession, d: str) -> DataFrame:
    # the joined (side, value) pairs are stored once; sketches and checks read them
    sided, _ = durable(with_side(fixture_l(spark, d), "key").select("side", "body_len"))
    parts = []
    for name in ("train", "test"):
        df = sided.where(F.col("side") == name)
        q1, q2, q3 = quartile_cuts_approx(df, "body_len", 0.3)
        v = F.col("body_len")
        n = F.count(F.lit(1))
        lo, hi = F.floor(n * 0.2), F.ceil(n * 0.8)
        parts.append(
            df.agg(
                F.lit(name).alias("side"),
                F.lit(q1).alias("q1"),
                F.lit(q3).alias("q3"),
                ((F.count_if(v < F.lit(q2)) + 1 <= hi) & (F.count_if(v <= F.lit(q2)) >= lo)).alias("q2_within_bound"),
            )
        )
    return parts[0].unionByName(parts[1])


def _train_l(spark, d):
    """Training rows before binning: for operators that don't look at the bin."""
    return split_train_test(fixture_l(spark, d), "key")[0]


def _sides_l(spark, d):
    return binned_sides(fixture_l(spark, d))


def _sides_d(spark, d):
    return binned_sides(fixture_d(spark, d))


def q_discretize_train(spark: SparkSession, d: str) -> DataFrame:
    return _sides_l(spark, d).train.select("l_orderkey", "l_linenumber", "body_len", "review_body")


def q_discretize_test(spark: SparkSession, d: str) -> DataFrame:
    return _sides_l(spark, d).test.select("l_orderkey", "l_linenumber", "body_len", "review_body")


# --- counting ----------------------------------------------------------------------------


def q_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return class_counts(_train_l(spark, d))


def q_path_filter(spark: SparkSession, d: str) -> DataFrame:
    return path_filter(_train_l(spark, d), PATH_L).select("l_orderkey", "l_linenumber", LABEL)


def q_distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return distinct_values(split_train_test(fixture_d(spark, d), "key")[0], "product_category")


def q_attr_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return attr_value_counts(None, ATTRIBUTES, cells_df=_sides_l(spark, d).train_cells)


def q_attr_value_counts_join(spark: SparkSession, d: str) -> DataFrame:
    return attr_value_counts_join(None, ATTRIBUTES, cells_df=_sides_l(spark, d).train_cells)


def q_domain_check(spark: SparkSession, d: str) -> DataFrame:
    return domain_violations(_sides_l(spark, d).train, DOMAINS_L)


def q_domain_check_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Raw columns with nulls: unlabelled documents are outside every domain."""
    return domain_violations(q_scan_project(spark, d), DOMAINS_D)


def q_cells(spark: SparkSession, d: str) -> DataFrame:
    return _sides_l(spark, d).train_cells


def q_entropy(spark: SparkSession, d: str) -> DataFrame:
    counts = long_counts(_sides_l(spark, d).train_cells, ATTRIBUTES)
    return counts.select("attr", "value", _r(entropy("pos", "neg"), "entropy"))


def _root_gains(spark, d):
    return info_gain(long_counts(_sides_d(spark, d).train_cells, ATTRIBUTES))


def q_info_gain(spark: SparkSession, d: str) -> DataFrame:
    return _root_gains(spark, d).select("attr", _r(F.col("info_gain"), "info_gain"))


def q_best_attribute(spark: SparkSession, d: str) -> DataFrame:
    return best_attribute(_root_gains(spark, d), ATTRIBUTES).select("attr", _r(F.col("info_gain"), "info_gain"))


def _root_split(spark, d):
    """Cells of the D training side and the root's split attribute (one name)."""
    c = _sides_d(spark, d).train_cells
    root = best_attribute(info_gain(long_counts(c, ATTRIBUTES)), ATTRIBUTES).first()["attr"]
    return c, root


def q_node_split(spark: SparkSession, d: str) -> DataFrame:
    c, root = _root_split(spark, d)
    return node_split(c, root)


def _level1_gains(spark, d):
    c, root = _root_split(spark, d)
    rest = [a for a in ATTRIBUTES if a != root]
    counts = long_counts(c.withColumnRenamed(root, "parent_value"), rest, ids=["parent_value"])
    return info_gain(counts, ["parent_value"]), rest


def q_node_info_gain(spark: SparkSession, d: str) -> DataFrame:
    gains, _ = _level1_gains(spark, d)
    return gains.select("parent_value", "attr", _r(F.col("info_gain"), "info_gain"))


def q_node_best_attribute(spark: SparkSession, d: str) -> DataFrame:
    gains, rest = _level1_gains(spark, d)
    best = best_attribute(gains, rest, ["parent_value"])
    return best.select("parent_value", "attr", _r(F.col("info_gain"), "info_gain"))


def q_leaf_labels(spark: SparkSession, d: str) -> DataFrame:
    c, root = _root_split(spark, d)
    return leaf_labels(c, by=root)


def q_node_split_deep(spark: SparkSession, d: str) -> DataFrame:
    """Children of an inner node two tests below the root."""
    return node_split(_sides_l(spark, d).train_cells, "product_category", PATH_L)


def q_leaf_labels_path(spark: SparkSession, d: str) -> DataFrame:
    return leaf_labels(_sides_l(spark, d).train_cells, PATH_L)


# --- tree, prediction, evaluation ---------------------------------------------------------


def _tree_out(tree: DataFrame) -> DataFrame:
    cols = [c if c != "gain" else _r(F.col("gain"), "gain") for c in TREE_COLUMNS]
    return tree.select(*cols)


def q_id3_tree(spark: SparkSession, d: str) -> DataFrame:
    return _tree_out(train_tree(_sides_d(spark, d)))


def q_id3_tree_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return _tree_out(train_tree(_sides_l(spark, d)))


def q_tree_rules(spark: SparkSession, d: str) -> DataFrame:
    return tree_rules(train_tree(_sides_d(spark, d)))


def _predicted_d(spark, d):
    s = _sides_d(spark, d)
    return predict(s.test, train_tree(s))


def q_predict(spark: SparkSession, d: str) -> DataFrame:
    return _predicted_d(spark, d).select("doc_id", "prediction", "matched_depth", "reached_leaf")


def q_predict_unseen(spark: SparkSession, d: str) -> DataFrame:
    s = _sides_d(spark, d)
    tree = grow_tree(s.train.where(F.col("marketplace") != F.lit(UNSEEN_LANG)))
    return predict(s.test, tree).select("doc_id", "prediction", "matched_depth", "reached_leaf")


def q_squared_error(spark: SparkSession, d: str) -> DataFrame:
    p = _predicted_d(spark, d)
    return p.select("doc_id", squared_error(LABEL, "prediction").alias("squared_error"))


def q_mean_squared_error(spark: SparkSession, d: str) -> DataFrame:
    m = mean_squared_error(_predicted_d(spark, d))
    return m.select(_r(F.col("mse"), "mse"), "n_rows")


def q_class_report(spark: SparkSession, d: str) -> DataFrame:
    report = class_report(_predicted_d(spark, d))
    return report.select("class", "n_rows", "n_predicted", "hits", *[_r(F.col(c), c) for c in ("precision", "recall", "f1")])


def q_mean_squared_error_lineitem(spark: SparkSession, d: str) -> DataFrame:
    # scored on the test side's cells: same figure, no second pass over the rows
    s = _sides_l(spark, d)
    return evaluate(s, train_tree(s)).select(_r(F.col("mse"), "mse"), "n_rows")


def q_prediction_truth_join(spark: SparkSession, d: str) -> DataFrame:
    s = _sides_d(spark, d)
    predicted = predict(s.test.drop(LABEL), train_tree(s))
    return prediction_truth_join(s.test, predicted, "doc_id")


# --- numeric columns cut where they separate best, pruning --------------------------------


def q_continuous_cuts(spark: SparkSession, d: str) -> DataFrame:
    """The best cut of each numeric column in each marketplace, of all its distinct values."""
    rows = _train_l(spark, d).groupBy("marketplace", *NUMBERS)
    counted = rows.agg(F.count_if(F.col(LABEL)).alias("pos"), F.count_if(~F.col(LABEL)).alias("neg"))
    cuts = best_cuts(counted, NUMBERS, ["marketplace"])
    return cuts.withColumn("gain", F.round("gain", ROUND))


def _mixed_tree(spark, d):
    return grow_mixed_tree(_train_l(spark, d), CATEGORIES, NUMBERS, max_depth=MIXED_DEPTH, min_rows=MIXED_ROWS)


def q_continuous_tree(spark: SparkSession, d: str) -> DataFrame:
    return _mixed_tree(spark, d).withColumn("gain", F.round("gain", ROUND))


def q_continuous_predict(spark: SparkSession, d: str) -> DataFrame:
    test = split_train_test(fixture_l(spark, d), "key")[1]
    predicted = predict_mixed(test, _mixed_tree(spark, d), CATEGORIES, NUMBERS)
    return predicted.select("l_orderkey", "l_linenumber", LABEL, "prediction", "matched_depth")


def _pruned(sides):
    """The tree of the training side, pruned on the test side's cells."""
    pruned = prune(train_tree(sides), sides.test_cells)
    return pruned.withColumn("gain", F.round("gain", ROUND))


def q_pruned_tree(spark: SparkSession, d: str) -> DataFrame:
    return _pruned(_sides_d(spark, d))


def q_pruned_tree_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return _pruned(_sides_l(spark, d))


# --- bagged trees --------------------------------------------------------------------------


def _forest_out(forest: DataFrame) -> DataFrame:
    return forest.withColumn("gain", F.round("gain", ROUND))


def q_forest_trees(spark: SparkSession, d: str) -> DataFrame:
    """All trees of the forest, grown in one loop."""
    return _forest_out(train_forest(_sides_d(spark, d)))


def q_forest_trees_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return _forest_out(train_forest(_sides_l(spark, d)))


def q_forest_predict(spark: SparkSession, d: str) -> DataFrame:
    s = _sides_d(spark, d)
    return predict_forest(s.test, train_forest(s)).select("doc_id", "prediction", "votes", "n_votes")


def q_forest_error_lineitem(spark: SparkSession, d: str) -> DataFrame:
    s = _sides_l(spark, d)
    return score_forest(s.test_cells, train_forest(s)).select(_r(F.col("mse"), "mse"), "n_rows")


QUERIES: dict[str, Query] = {
    "scan_project": q_scan_project,
    "row_count": q_row_count,
    "ratio_target": q_ratio_target,
    "flag_to_boolean": q_flag_to_boolean,
    "fill_missing": q_fill_missing,
    "rating_bucket": q_rating_bucket,
    "text_length": q_text_length,
    "row_index": q_row_index,
    "split_train_test": q_split_train_test,
    "quartile_cuts": q_quartile_cuts,
    "quartile_cuts_approx": q_quartile_cuts_approx,
    "discretize_train": q_discretize_train,
    "discretize_test": q_discretize_test,
    "class_counts": q_class_counts,
    "path_filter": q_path_filter,
    "distinct_values": q_distinct_values,
    "attr_value_counts": q_attr_value_counts,
    "attr_value_counts_join": q_attr_value_counts_join,
    "domain_check": q_domain_check,
    "domain_check_nulls": q_domain_check_nulls,
    "cells": q_cells,
    "entropy": q_entropy,
    "info_gain": q_info_gain,
    "best_attribute": q_best_attribute,
    "node_split": q_node_split,
    "node_info_gain": q_node_info_gain,
    "node_best_attribute": q_node_best_attribute,
    "leaf_labels": q_leaf_labels,
    "node_split_deep": q_node_split_deep,
    "leaf_labels_path": q_leaf_labels_path,
    "id3_tree": q_id3_tree,
    "id3_tree_lineitem": q_id3_tree_lineitem,
    "tree_rules": q_tree_rules,
    "predict": q_predict,
    "predict_unseen": q_predict_unseen,
    "squared_error": q_squared_error,
    "mean_squared_error": q_mean_squared_error,
    "class_report": q_class_report,
    "mean_squared_error_lineitem": q_mean_squared_error_lineitem,
    "prediction_truth_join": q_prediction_truth_join,
    "continuous_cuts": q_continuous_cuts,
    "continuous_tree": q_continuous_tree,
    "continuous_predict": q_continuous_predict,
    "pruned_tree": q_pruned_tree,
    "pruned_tree_lineitem": q_pruned_tree_lineitem,
    "forest_trees": q_forest_trees,
    "forest_trees_lineitem": q_forest_trees_lineitem,
    "forest_predict": q_forest_predict,
    "forest_error_lineitem": q_forest_error_lineitem,
}

