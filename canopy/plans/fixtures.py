"""Review-shaped frames built from the provided tables.

Two stand-ins for the review data:

* **L** (``lineitem`` ⋈ ``orders`` ⋈ ``customer`` ⋈ ``nation`` ⋈ ``region``):
  large, with zero denominators; the key is *not* unique, so it is only
  used for splitting, never for joins.
* **D** (``documents`` ⟕ ``labels``): real text, nulls to fill, ties and
  unseen values; ``doc_id`` is unique.

Both produce: ``key, marketplace, verified_purchase, vine, product_category,
star_rating, body_len, is_vote_helpful`` (plus a few source columns), the
prepared frame of the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.columns import ratio_above, rating_bucket, text_length
from canopy.operators.prepare import LABEL, fill_missing
from canopy.sources.tables import read_table

# The stand-in thresholds of the two fixtures.
L_THRESHOLD = 0.5
D_THRESHOLD = 0.3


def fixture_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders")
    cu = read_table(spark, sf_dir, "customer")
    na = read_table(spark, sf_dir, "nation")
    rg = read_table(spark, sf_dir, "region")
    # the smaller tables first: the lines, by far the most rows, are shuffled once at most
    placed = cu.join(na, cu.c_nationkey == na.n_nationkey).join(rg, na.n_regionkey == rg.r_regionkey)
    ordered = od.join(placed, od.o_custkey == cu.c_custkey)
    joined = li.join(ordered, li.l_orderkey == od.o_orderkey)
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        "l_orderkey",
        "l_linenumber",
        F.col("r_name").alias("marketplace"),
        F.col("l_linestatus").alias("verified_purchase"),
        F.col("o_orderstatus").alias("vine"),
        F.col("c_mktsegment").alias("product_category"),
        rating_bucket(F.col("l_linenumber").cast("string")).alias("star_rating"),
        F.col("l_extendedprice").cast("double").alias("body_len"),
        ratio_above("l_tax", "l_discount", L_THRESHOLD).alias(LABEL),
    )


def vowel_count(text):
    return F.length(F.regexp_replace(text, "[^aeiou]", ""))


def fixture_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    raw = joined.select(
        F.col("doc_id").cast("string").alias("key"),
        "doc_id",
        F.col("lang").alias("marketplace"),
        F.col("quality").cast("string").alias("verified_purchase"),
        F.col("toxic").cast("string").alias("vine"),
        F.col("source").alias("product_category"),
        F.lit("bad").alias("star_rating"),
        text_length("text").alias("body_len"),
        ratio_above(vowel_count(F.col("text")), "n_chars", D_THRESHOLD).alias(LABEL),
    )
    return fill_missing(raw, ["marketplace", "verified_purchase", "vine", "product_category"])
