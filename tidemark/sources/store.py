"""Tables that a plan reads more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """The same rows from a compressed table in the folder that the session names (spark.checkpoint.dir), so that what follows reads them, and of them only the columns it needs, without the plan behind them. A local session without one gets a temporary folder; on a cluster that is an error."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        at = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not at and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="spark-"))
    path = f"{sc._jsc.sc().getCheckpointDir().get()}/settled-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
