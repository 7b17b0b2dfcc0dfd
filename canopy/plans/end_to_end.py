"""The end-to-end pipeline over a prepared frame.

0. **Narrow table** -- the side, the attributes, the label and the raw value of
   every row are stored once, so that what lies before them (joins, text lengths)
   is computed once however often they are read.
1. **Cuts** -- exact quartiles of the raw value per side (``quantiles``): each
   pass is one aggregation over two columns of the narrow table.
2. **Cells** -- one pass over it with the cuts as literals: class counts per ``(side,
   attributes, bin)``.  The raw value is binned before the grouping, so the
   map-side combine leaves at most one row per combination and task, however
   many rows there are.  Stored; the training cells feed the tree, the test
   cells score it.
3. **Score** -- the tree is applied to the test *cells* and errors are
   counted with the cells' weights: the mean squared error of all test rows
   without another pass over them.

Cuts and cells are computed when first asked for.  Row-level frames
(``Sides.train`` / ``Sides.test``) are plain projections of the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.operators._lineage import durable
from canopy.operators.contingency import cells
from canopy.operators.discretize import bin_quartiles, quartile_bin, quartile_cuts
from canopy.operators.forest import N_TREES, grow_forest, predict_forest
from canopy.operators.predict import predict
from canopy.operators.prepare import ATTRIBUTES, FILL_TOKEN, LABEL
from canopy.operators.sampling import split_train_test, with_side
from canopy.operators.tree import grow_tree

BINNED = "review_body"
VALUE = "body_len"
KEY = "_key"
NO_CUTS = (None, None, None)


class Sides:
    """The two sides of a prepared frame, binned, as rows and as cells (``attrs..., pos, neg``)."""

    def __init__(self, prepared: DataFrame, key: str, cuts: str, attrs: Sequence[str], label: str, token: str):
        self._prepared, self.key, self._cuts = prepared, key, cuts
        self._attrs, self.label, self.token = list(attrs), label, token
        self._keyed = False
        self._train_rows, self._test_rows = split_train_test(prepared, key)

    @cached_property
    def _narrow(self) -> DataFrame:
        own = [a for a in self._attrs if a != BINNED]
        keys = [F.col(self.key).cast("string").alias(KEY)] if self._keyed else []
        return durable(with_side(self._prepared, self.key).select("side", *own, self.label, VALUE, *keys))[0]

    @cached_property
    def _per_side(self) -> dict[str, tuple]:
        found = quartile_cuts(self._narrow, VALUE, by=["side"])
        return {r["side"]: (r["q1"], r["q2"], r["q3"]) for r in found.collect()}  # at most two rows

    @property
    def train_cuts(self) -> tuple:
        return self._per_side.get("train", NO_CUTS)

    @property
    def test_cuts(self) -> tuple:
        return self._per_side.get("test", NO_CUTS) if self._cuts == "per_side" else self.train_cuts

    @property
    def train(self) -> DataFrame:
        """Training rows, binned with the training cuts."""
        return bin_quartiles(self._train_rows, self.train_cuts, VALUE, BINNED)

    @property
    def test(self) -> DataFrame:
        """Test rows, binned with the test cuts (or the training cuts)."""
        return bin_quartiles(self._test_rows, self.test_cuts, VALUE, BINNED)

    @property
    def train_draws(self) -> DataFrame:
        """``_key, attrs..., label`` of the training rows: from the narrow table, which then holds the
        keys, unless it has been stored without."""
        if "_narrow" not in self.__dict__:
            self._keyed = True
        if not self._keyed:
            return self.train.select(F.col(self.key).cast("string").alias(KEY), *self._attrs, self.label)
        training = self._narrow.where(F.col("side") == F.lit("train"))
        return bin_quartiles(training, self.train_cuts, VALUE, BINNED).select(KEY, *self._attrs, self.label)

    @cached_property
    def _cells(self) -> DataFrame:
        own, other = (quartile_bin(F.col(VALUE), c) for c in (self.train_cuts, self.test_cuts))
        binned = self._narrow.withColumn(BINNED, F.when(F.col("side") == "train", own).otherwise(other))
        return durable(cells(binned, ["side", *self._attrs], self.label, self.token))[0]

    def _cells_of(self, side: str) -> DataFrame:
        return self._cells.where(F.col("side") == F.lit(side)).select(*self._attrs, "pos", "neg")

    @property
    def train_cells(self) -> DataFrame:
        return self._cells_of("train")

    @property
    def test_cells(self) -> DataFrame:
        return self._cells_of("test")


def binned_sides(
    prepared: DataFrame,
    key: str = "key",
    cuts: str = "per_side",
    attrs=ATTRIBUTES,
    label: str = LABEL,
    token: str = FILL_TOKEN,
) -> Sides:
    """Split on ``key``; bin ``body_len`` into ``review_body``.

    ``cuts='per_side'`` bins each side with its own quartiles (the original
    behaviour); ``cuts='train'`` bins the test side with the training cuts.
    """
    return Sides(prepared, key, cuts, attrs, label, token)


def train_tree(sides: Sides, attrs=ATTRIBUTES, **kw) -> DataFrame:
    return grow_tree(None, attrs, cells=sides.train_cells, **kw)


def score_cells(test_cells: DataFrame, tree: DataFrame, attrs=ATTRIBUTES) -> DataFrame:
    """Mean squared error (= error rate) of ``tree`` over the rows the cells
    stand for: a cell predicted ``true`` contributes its ``neg`` count as
    errors, one predicted ``false`` its ``pos`` count.  One row: ``mse, n_rows``."""
    return _error_rate(predict(test_cells, tree, attrs))


def _error_rate(p: DataFrame) -> DataFrame:
    errors = F.sum(F.when(F.col("prediction") == "true", F.col("neg")).otherwise(F.col("pos")))
    n = F.sum(F.col("pos") + F.col("neg"))
    return p.agg(F.try_divide(errors.cast("double"), n.cast("double")).alias("mse"), n.cast("bigint").alias("n_rows"))


def train_forest(sides: Sides, n_trees: int = N_TREES, attrs=ATTRIBUTES, **kw) -> DataFrame:
    """Bagged trees of the training side: one more pass over its rows as stored, for their weights."""
    return grow_forest(sides.train_draws, KEY, n_trees, attrs, sides.label, token=sides.token, **kw)


def score_forest(test_cells: DataFrame, forest: DataFrame, attrs=ATTRIBUTES) -> DataFrame:
    """``score_cells`` for the forest's majority vote."""
    return _error_rate(predict_forest(test_cells, forest, attrs))


def evaluate(sides: Sides, tree: DataFrame, attrs=ATTRIBUTES) -> DataFrame:
    return score_cells(sides.test_cells, tree, attrs)
