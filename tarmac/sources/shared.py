"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset it lies under the warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/tarmac-{uuid.uuid4().hex}"
