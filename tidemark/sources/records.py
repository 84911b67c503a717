"""Unvalidated text records derived from the daily rates, with every kind of defect.

Each daily row becomes one record; its price in cents modulo 13 picks the defect, so all
rows are kept and the defect classes spread over all entities and dates:

 0 blank code            5 date as yyyy/MM/dd       10 rate 'NaN'
 1 empty name            6 nominal 'x'              11 type NULL, nominal '10'
 2 rate 'n/a'            7 nominal '0'              12 clean
 3 negative rate         8 type 'Weekly', date yyyy-M-d
 4 rate x 100 (overflows DECIMAL(12,6) from 10,000 up)
 9 code padded with blanks, type 'MONTHLY', nominal NULL
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dirty_records(daily: DataFrame) -> DataFrame:
    k = (F.col("exchange_rate") * F.lit(100)).cast("bigint") % F.lit(13)
    rate_txt = F.col("exchange_rate").cast("string")
    iso = F.col("rate_date").cast("string")
    return daily.select(k.alias("k"), "currency_code", "currency_name", "exchange_rate", "rate_date").select(
        F.when(F.col("k") == 0, F.lit("   "))
         .when(F.col("k") == 9, F.concat(F.lit("  "), F.col("currency_code"), F.lit(" ")))
         .otherwise(F.col("currency_code")).alias("currency_code"),
        F.when(F.col("k") == 1, F.lit("")).otherwise(F.col("currency_name")).alias("currency_name"),
        F.when(F.col("k") == 2, F.lit("n/a"))
         .when(F.col("k") == 3, F.concat(F.lit("-"), rate_txt))
         .when(F.col("k") == 4, (F.col("exchange_rate") * F.lit(100)).cast("string"))
         .when(F.col("k") == 10, F.lit("NaN"))
         .otherwise(rate_txt).alias("exchange_rate"),
        F.when(F.col("k") == 5, F.date_format("rate_date", "yyyy/MM/dd"))
         .when(F.col("k") == 8, F.date_format("rate_date", "yyyy-M-d"))
         .otherwise(iso).alias("rate_date"),
        F.when(F.col("k") == 8, F.lit("Weekly"))
         .when(F.col("k") == 9, F.lit("MONTHLY"))
         .when(F.col("k") == 11, F.lit(None).cast("string"))
         .otherwise(F.lit("daily")).alias("rate_type"),
        F.when(F.col("k") == 6, F.lit("x"))
         .when(F.col("k") == 7, F.lit("0"))
         .when(F.col("k") == 9, F.lit(None).cast("string"))
         .when(F.col("k") == 11, F.lit("10"))
         .otherwise(F.lit("1")).alias("nominal"),
    )
