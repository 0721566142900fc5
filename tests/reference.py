"""Plain forms that the tests compare the scalable ones with."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators.keys import total_order


def surrogate_key_window(df, order_by, name, tie_break="all", key_type="int"):
    """``row_number()`` over an unpartitioned window: all rows in one partition."""
    w = Window.orderBy(*total_order(df, order_by, tie_break))
    return df.withColumn(name, F.row_number().over(w).cast(key_type))
