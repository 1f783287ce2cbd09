"""Connected components of links by label spreading with shortcuts."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECT_ROUNDS = 3


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for each linked id the smallest id it can reach.

    In each round an id takes the smallest label among its neighbours' and its
    own; after a few rounds, which small groups need only, also the label of that
    label, so long chains shorten by half. Rounds go on until none changes; their state is checkpointed. Links to hot ids meet
    the labels in plain equi-joins and partial minima, which Spark can split.
    """
    both = (links.select(F.col(a).alias("id"), F.col(b).alias("other"))
            .unionByName(links.select(F.col(b).alias("id"), F.col(a).alias("other")))
            .where("id <> other").distinct().checkpoint())
    labels = (both.groupBy("id").agg(F.min("other").alias("low"))
              .select("id", F.least("id", "low").alias("component")).checkpoint())
    for turn in count():
        near = (both.join(labels.withColumnRenamed("id", "other"), "other")
                .groupBy("id").agg(F.min("component").alias("near")))
        spread = labels.join(near, "id").select(
            "id", F.col("component").alias("old"),
            F.least("component", "near").alias("component"))
        if turn >= DIRECT_ROUNDS:
            jump = spread.select(F.col("id").alias("component"), F.col("component").alias("jump"))
            spread = spread.join(jump, "component", "left").select(
                "id", "old", F.coalesce("jump", "component").alias("component"))
        spread = spread.checkpoint()
        labels = spread.drop("old")
        if not spread.where("old <> component").head(1):
            return labels
