"""Column expressions (no UDFs): parsing, code maps, units, reasons."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluated_once(value: Column) -> Column:
    """``value`` unchanged, but kept from being inlined into filters below it.

    A filter on a derived column (``error IS NULL``, ``reason IS NULL``) is
    normally pushed below the projection that computes it, with the column's
    whole expression substituted in. For a deep expression (a parsed line, a
    validated row) that evaluates it twice per row and, since every reference
    is substituted, can grow the generated code past the JVM method limit.
    ``spark_partition_id()`` is non-deterministic to the optimizer, so a
    predicate on this column stays above its projection and reads the
    computed value.
    """
    return F.when(F.spark_partition_id() >= 0, value)
