"""A stable split into training and test rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.columns import hash_fraction_key
from patronage.operators.ranking import running_totals
from patronage.session import stage


def exact_split(df: DataFrame, identity: str, share: float, label: str | None = None) -> DataFrame:
    """``df`` with a column ``is_test``: exactly the nearest whole number to ``share`` of
    the rows (a half goes up), within each label where one is given.

    Rows are shuffled by a hash of ``identity``, which must be a number and unique; which
    rows are taken does not depend on how the table is partitioned. Labels are few (each
    is ranked by itself); a null label is a label. Without rows there is nothing to split.
    """
    key = hash_fraction_key(identity)
    keyed = stage(df.select(F.col(identity), *([label] if label else []), key.alias("_order")), "split")
    # One row per label.
    labels = [r[label] for r in keyed.select(label).distinct().collect()] if label else [None]
    ranked = None
    for name in labels:
        own = keyed.where(F.col(label).eqNullSafe(F.lit(name))) if label else keyed
        placed = running_totals(own, "_order", tie=identity, rank="_rank", count="_rows").select(
            identity, (F.col("_rank") <= F.floor(F.col("_rows") * share + 0.5)).alias("is_test")
        )
        ranked = placed if ranked is None else ranked.unionByName(placed)
    if ranked is None:
        return df.withColumn("is_test", F.lit(False))
    return df.join(ranked, identity)
