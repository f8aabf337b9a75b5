"""Row filters on costly flags."""

from pyspark.sql import Column, DataFrame, functions as F


def keep_where(df: DataFrame, flag: Column) -> DataFrame:
    """Rows whose flag is true, evaluated where it stands.

    A plain filter on a computed flag is pushed below the projection that computes it, and the whole
    parse behind the flag then runs twice per row. A one-element generator stops that; it is the outer
    one, since Catalyst infers a filter for the inner one.
    """
    return df.withColumn("_flag", F.explode_outer(F.array(flag))).filter("_flag").drop("_flag")
