"""Keeping costly columns from being computed again."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns fixed at this point of the plan.

    A filter on a derived column is pushed towards the scan by writing the
    column's whole expression into the filter. For columns that build on each
    other this repeats the work many times over. Passing them through ``inline``
    of one struct keeps such filters above this step.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))
