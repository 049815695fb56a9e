"""Attributes of feature layers that share a table: which attributes each layer has, and of which type.

The properties of a feature stay one JSON text until the types of its layer are known. Types are inferred over all
features of a layer with mergeable aggregates, so a layer of any size is one row a task and attribute in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How the engine names the JSON values that count as whole and as other numbers.
_WHOLE, _NUMBER = "BIGINT", "^(DECIMAL|DOUBLE|FLOAT)"


def attribute_types(features: DataFrame, dataset: str = "dataset", properties: str = "properties") -> DataFrame:
    """(dataset, attribute, position, type, given): the attributes of every dataset.

    ``position`` is the first place at which the attribute stands in a feature, ``given`` how many features have a
    value. A type is the narrowest of boolean, long, double and string that holds all values; a mixture, nested values
    and an attribute without any value are text. A text that is no JSON object has no attributes.
    """
    values = F.from_json(properties, "map<string,variant>")
    entries = features.select(F.col(dataset).alias("dataset"), F.posexplode(F.map_entries(values)).alias("position", "_e"))
    kind = F.schema_of_variant("_e.value")
    rows = entries.select("dataset", F.col("_e.key").alias("attribute"), "position", F.when(kind != "VOID", kind).alias("_kind"))
    every = lambda c: F.coalesce(F.min(c.cast("int")), F.lit(0)) == 1
    kinds = rows.groupBy("dataset", "attribute").agg(
        F.min("position").alias("position"),
        F.count("_kind").alias("given"),
        every(F.col("_kind") == "BOOLEAN").alias("_flag"),
        every(F.col("_kind") == _WHOLE).alias("_whole"),
        every((F.col("_kind") == _WHOLE) | F.col("_kind").rlike(_NUMBER)).alias("_number"),
    )
    name = F.when(F.col("_flag"), "boolean").when(F.col("_whole"), "long").when(F.col("_number"), "double").otherwise("string")
    return kinds.select("dataset", "attribute", "position", name.alias("type"), "given")


def signatures(types: DataFrame) -> DataFrame:
    """(dataset, signature, attributes): datasets of equal attributes, in their order, have the same signature.

    Attributes at the same first place are ordered by name. The signature is the beginning of a hash, fit for a folder
    name, and does not change between runs.
    """
    entry = F.struct("position", "attribute", "type")
    listed = types.groupBy("dataset").agg(F.sort_array(F.collect_list(entry)).alias("_a"))
    plain = F.transform("_a", lambda a: F.struct(a.attribute.alias("attribute"), a.type.alias("type")))
    named = listed.select("dataset", plain.alias("attributes"))
    return named.withColumn("signature", F.substring(F.sha2(F.to_json("attributes"), 256), 1, 16)).select("dataset", "signature", "attributes")
