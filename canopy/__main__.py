"""Command line: train on review TSV files, score the held-out side, store the tree.

    python -m canopy REVIEWS [REVIEWS ...] [--tree-out DIR] [--threshold 0.5] [--show 20]

or through ``spark-submit``; the master and every other setting come from
the launcher, never from here.  The key of the 70/30 split is
``review_id``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from canopy.operators.predict import predict
from canopy.operators.prepare import THRESHOLD, prepare_reviews
from canopy.operators.tree import tree_rules
from canopy.plans.end_to_end import binned_sides, evaluate, train_tree
from canopy.sources.reviews import PIPELINE_COLUMNS, read_reviews
from canopy.sources.trees import save_tree


def run(spark: SparkSession, paths: list[str], tree_out: str | None = None, threshold: float = THRESHOLD, show: int = 20):
    raw = read_reviews(spark, paths, columns=("review_id", *PIPELINE_COLUMNS))
    prepared = prepare_reviews(raw, threshold=threshold, keep=("review_id",)).withColumnRenamed("review_id", "key")
    sides = binned_sides(prepared, key="key")
    tree = train_tree(sides)
    score = evaluate(sides, tree).first()
    if tree_out:
        save_tree(tree, tree_out)
    if show:
        tree_rules(tree).orderBy(F.desc(F.col("pos") + F.col("neg"))).show(show, truncate=False)
        predict(sides.test, tree).select("key", "prediction", "is_vote_helpful").show(show)
    return tree, score


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m canopy", description=__doc__.split("\n\n")[0])
    ap.add_argument("paths", nargs="+", help="review TSV files, folders or globs (.gz allowed)")
    ap.add_argument("--tree-out", help="folder to store the node table (Parquet)")
    ap.add_argument("--threshold", type=float, default=THRESHOLD)
    ap.add_argument("--show", type=int, default=20, help="rows of rules and predictions to print (0: none)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("canopy").getOrCreate()
    _, score = run(spark, args.paths, args.tree_out, args.threshold, args.show)
    print(f"test rows: {score['n_rows']}  mean squared error: {score['mse']}")


if __name__ == "__main__":
    main()
