"""Bronze -> silver_measurements: derive the date, pseudonymise the IP,
normalise missing region names and drop unusable rows (P4-P9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import GEO_NAMES


def clean_measurements(df: DataFrame) -> DataFrame:
    """One narrow projection + filter; no shuffle.

    * ``measurement_date`` = date of ``measurement_time`` (session zone for
      instants, the wall clock for ``timestamp_ntz``);
    * ``user_id`` = SHA-256 of ``client_ip`` (NULL IP -> NULL user), and
      ``client_ip`` is dropped;
    * ``'NaN'`` or NULL municipality / regional unit / periphery -> ``'N/A'``;
    * rows without a time, or with a downstream speed that is not ``>= 0``
      (NULL or negative), are dropped.  Both predicates reach the Parquet scan
      as pushed filters.
    """
    names = {c: F.when((F.col(c) == "NaN") | F.col(c).isNull(), F.lit("N/A"))
             .otherwise(F.col(c)) for c in GEO_NAMES}
    return (df
            .filter(F.col("measurement_time").isNotNull()
                    & (F.col("measured_downstream_mbps") >= 0))
            .withColumns({"measurement_date": F.to_date("measurement_time"),
                          "user_id": F.sha2(F.col("client_ip"), 256),
                          **names})
            .drop("client_ip"))
