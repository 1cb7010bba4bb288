"""Answers remembered by the hash of their question."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cache_key(model: Column, prompt: Column) -> Column:
    return F.sha2(F.concat_ws("\n", model, prompt), 256)


def answered(requests: DataFrame, cache: DataFrame, answer: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Requests (model, prompt) with response and hit, and the rows to append to the cache (key, response).

    ``answer`` takes the distinct questions that the cache lacks (key, model,
    prompt) and returns key, response; equal questions are asked once.
    """
    asked = requests.withColumn("key", cache_key(F.col("model"), F.col("prompt")))
    known = cache.groupBy("key").agg(F.min("response").alias("_known"))
    missing = asked.select("key", "model", "prompt").dropDuplicates(["key"]).join(known, "key", "left_anti")
    new = answer(missing)
    j = asked.join(known, "key", "left").join(new.withColumnRenamed("response", "_new"), "key", "left")
    out = j.withColumns({"response": F.coalesce("_known", "_new"), "hit": F.col("_known").isNotNull()}).drop("_known", "_new")
    return out, new
