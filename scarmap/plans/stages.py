"""Stages of a job: tables written once, from which later steps and a rerun go on."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scarmap.cluster import checkpoint_folder
from scarmap.sources.readers import exists


class Stages:
    """Tables in ``folder``, which driver and executors share; without one, in a new folder beside the checkpoints.

    A folder belongs to one input: a rerun with the same folder takes what is finished there as it is.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{checkpoint_folder(spark)}/stages-{uuid.uuid4().hex}"

    def _note(self, name: str) -> str:
        return f"{self.folder}/_manifest/{name}"

    def finished(self, name: str) -> dict | None:
        """What the manifest says of a stage (rows, schema); None if it has not been written whole."""
        if not exists(self.spark, f"{self._note(name)}/_SUCCESS"):
            return None
        return json.loads(self.spark.read.text(self._note(name)).first().value)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage. ``build`` is called, and its rows are computed, only where the manifest lacks it.

        The manifest is written after the table, so what an ended run has left half written is written anew.
        """
        path = f"{self.folder}/{name}"
        said = self.finished(name)
        if said is None:
            counted, made = Observation(), build()
            made.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            said = {"rows": counted.get["rows"], "schema": made.schema.jsonValue()}
            self.spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.mode("overwrite").text(self._note(name))
        return self.spark.read.schema(StructType.fromJson(said["schema"])).parquet(path)
