"""Order layout by year: what an index on the order date gives, as folders and file statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.functions.columns import year_range
from sitewise.schema import SCHEMAS

def layout_by_year(orders: DataFrame, path: str, partitions: int | None = None) -> None:
    """Rewrite orders in one folder per year, clustered by client.

    Ranged by (year, client, order): every file covers a narrow client range of its
    year, and neither a large year nor a large client is left to one task.
    """
    keys = ["order_year", "id_client", "id_commande"]
    dated = orders.withColumn("order_year", F.year("date_commande"))
    ranged = dated.repartitionByRange(*([partitions] if partitions else []), *keys)
    (
        ranged.sortWithinPartitions("order_year", "id_client", "date_commande")
        .write.mode("overwrite")
        .partitionBy("order_year")
        .parquet(path)
    )


def read_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Orders of one year: the folder prunes files, the date range prunes row groups."""
    schema = T.StructType([*SCHEMAS["commandes"].fields, T.StructField("order_year", T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    return stored.where(F.col("order_year") == year).where(year_range(F.col("date_commande"), year)).drop("order_year")
