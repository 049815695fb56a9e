"""What a catalog browser asks: the list page and the page of one dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.text import dataset_path, humanise, s3_uri, safe_table_name
from geoloom.operators import catalog as K
from geoloom.operators import joins as J
from geoloom.operators import layout as L


def catalog_page(index: DataFrame, kind: str = "all", term: str = "", n: int = 500) -> DataFrame:
    """First datasets that match, with display name and the number of further matches."""
    found = K.search_catalog(index, kind, term)
    page = L.capped_list(found.select("id", "kind"), ["id"], n)
    return page.withColumn("label", humanise(F.col("id")))


def dataset_pages(requested: DataFrame, index: DataFrame, base: str) -> DataFrame:
    """Type, CRS, addresses and names of each requested dataset; unknown ids get the defaults.

    ``index`` has id, type, crs, parquet and meta.
    """
    found = J.lookup_dataset(requested, index)
    url = dataset_path(base, F.col("parquet"))
    return found.select(
        "id",
        humanise(F.col("id")).alias("label"),
        "type",
        F.concat(F.lit("EPSG:"), "crs").alias("crs"),
        url.alias("parquet_url"),
        dataset_path(base, F.col("meta")).alias("metadata_url"),
        s3_uri(url).alias("s3_uri"),
        safe_table_name(F.col("id")).alias("table_name"),
    )
