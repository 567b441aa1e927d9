"""Keeping a document index current by re-reading only what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def index_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(relative_path, change) for paths that are new, changed or removed since ``previous``.

    Both sides hold relative_path and modified; one exchange on the path finds all three.
    """
    old = previous.select("relative_path", F.col("modified").alias("old_modified"), F.lit(True).alias("was"))
    new = current.select("relative_path", "modified", F.lit(True).alias("now"))
    change = (
        F.when(F.col("was").isNull(), "new")
        .when(F.col("now").isNull(), "removed")
        .when(~F.col("modified").eqNullSafe(F.col("old_modified")), "changed")
    )
    return (
        new.join(old, "relative_path", "full_outer")
        .select("relative_path", change.alias("change"))
        .filter("change is not null")
    )


def refresh_terms(previous_terms: DataFrame, changes: DataFrame, changed_terms: DataFrame) -> DataFrame:
    """Index rows after a refresh: untouched documents kept, new and changed ones re-indexed.

    ``changed_terms`` is the term index of the documents that ``changes`` lists as new or changed.
    """
    kept = previous_terms.join(changes.select("relative_path"), "relative_path", "left_anti")
    return kept.unionByName(changed_terms)
