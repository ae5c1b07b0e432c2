"""Session SQL functions for the expressions users write by hand."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFINITIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE
       RETURN 12742.0D * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2)
         + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION season_of(ts TIMESTAMP) RETURNS STRING
       RETURN CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) IN (3, 4, 5) THEN 'spring'
         WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION polynomial(coeffs ARRAY<DOUBLE>, x DOUBLE) RETURNS DOUBLE
       RETURN aggregate(reverse(coeffs), 0D, (acc, c) -> acc * x + c)""",
)


def register_functions(spark: SparkSession) -> None:
    for sql in DEFINITIONS:
        spark.sql(sql)
