"""Plain column types for comparing results between engines.

Sums and ratios are exact decimals inside the plans; only here, at the edge, do
decimals become doubles and dates, arrays and intervals become text or numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def plain(df: DataFrame) -> DataFrame:
    picked = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DayTimeIntervalType):
            column = (column.cast("interval second").cast("decimal(20,6)") * 1000000).cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        picked.append(column.alias(field.name))
    return df.select(*picked)
