"""Storing and loading a trained node table (Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TREE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.StringType(), False),
        T.StructField("parent_id", T.StringType(), True),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("edge_attr", T.StringType(), True),
        T.StructField("edge_value", T.StringType(), True),
        T.StructField("rule", T.StringType(), False),
        T.StructField("split_attr", T.StringType(), True),
        T.StructField("gain", T.DoubleType(), True),
        T.StructField("pos", T.LongType(), False),
        T.StructField("neg", T.LongType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("label", T.BooleanType(), False),
    ]
)


def save_tree(tree: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the node table, one folder per depth (``depth=…``)."""
    tree.write.mode(mode).partitionBy("depth").parquet(path)


def load_tree(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in TREE_SCHEMA.fields])
