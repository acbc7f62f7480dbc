"""Where a query keeps tables of its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from odskein.sinks.manifests import new_name


def scratch_folder(spark: SparkSession, what: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names, which all executors share.

    Only a session in local mode without that setting gets a temporary folder; on a cluster it
    would be one machine's.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="odskein-"))
        named = spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/{new_name(what)}"
