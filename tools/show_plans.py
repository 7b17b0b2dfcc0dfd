"""Print the physical plans of the hot paths (fine cells, one tree level, prediction).

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from canopy.operators.predict import predict  # noqa: E402
from canopy.operators.sampling import with_side  # noqa: E402
from canopy.plans.fixtures import fixture_l  # noqa: E402
from canopy.plans.end_to_end import binned_sides, score_cells, train_tree  # noqa: E402
from canopy.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    fx = fixture_l(spark, sf_dir)
    attrs = ["marketplace", "verified_purchase", "vine", "product_category"]
    fine = (
        with_side(fx, "key")
        .groupBy("side", *attrs, "body_len")
        .agg(F.count_if("is_vote_helpful").alias("pos"), F.count_if(~F.col("is_vote_helpful")).alias("neg"))
    )
    print("### fine cells: the one pass over the rows")
    fine.explain("formatted")
    s = binned_sides(fx)
    tree = train_tree(s)
    print("### predict over rows (broadcast node table, no shuffle)")
    predict(s.test, tree).explain()
    print("### scoring on test cells")
    score_cells(s.test_cells, tree).explain()


if __name__ == "__main__":
    main()
