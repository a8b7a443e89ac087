"""Reading from the serving copy (key A7).

The reference pulls (id, price) from the serving database into a Python
dict of floats. Here the prices stay a distributed DataFrame and stay
DECIMAL. A JDBC URL is read in parallel, split on the id column; any other
source is read as parquet (a synced copy in the shared folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_serving_prices(spark: SparkSession, source: str, table: str = "products", id_col: str = "id",
                        price_col: str = "price", num_partitions: int = 16, bounds: tuple[int, int] | None = None,
                        properties: dict | None = None) -> DataFrame:
    """(id, price DECIMAL(18,2)) from the serving copy.

    JDBC: ``numPartitions`` range reads on ``id_col`` between ``bounds``
    (when bounds are not given they are read with one small MIN/MAX query).
    """
    if source.startswith("jdbc:"):
        props = dict(properties or {})
        if bounds is None:
            b = (spark.read.jdbc(source, f"(SELECT MIN({id_col}) AS lo, MAX({id_col}) AS hi FROM {table}) b",
                                 properties=props).collect()[0])
            bounds = (int(b["lo"] or 0), int(b["hi"] or 0))
        df = spark.read.jdbc(source, table, column=id_col, lowerBound=bounds[0], upperBound=bounds[1] + 1,
                             numPartitions=num_partitions, properties=props)
    else:
        df = spark.read.parquet(source)
    return df.select(F.col(id_col).alias("id"), F.col(price_col).cast("decimal(18,2)").alias("price"))
