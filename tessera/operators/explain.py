"""Keywords behind a prediction (ML9): what each term adds to a linear model's margin.

A linear text model gives every term a weight for each class, so a prediction is a sum over the
text's terms. The weights are a table (class columns, term, weight), as large as the vocabulary times the
classes; the join with the texts' terms is on a term, a hot key for frequent ones, so the weights
are read from a written table, which the adaptive join can broadcast or pair with the splits
of a skewed partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def contributions(said: DataFrame, weights: DataFrame, classes: list[str]) -> DataFrame:
    """``said`` (id and class columns, term, tf) with ``contribution`` = tf x weight of the term in
    the row's class; ``weights`` has the class columns, term and weight. A term without a weight adds 0."""
    table = materialize(weights.select(*classes, "term", "weight"), "term-weights")
    return (said.join(table, [*classes, "term"], "left")
            .withColumn("contribution", F.col("tf") * F.coalesce("weight", F.lit(0.0))).drop("weight"))


def top_contributions(each: DataFrame, id_col: str, k: int) -> DataFrame:
    """The ``k`` terms of a text that add most, ties to the smaller term, with their ``rank`` from 1;
    terms that add nothing or speak against the class are left out."""
    order = Window.partitionBy(id_col).orderBy(F.desc("contribution"), "term")
    return (each.filter(F.col("contribution") > 0).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k))
