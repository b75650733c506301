"""Session helpers for tests and benchmarks.

Library functions never create sessions themselves; they use the session of
the DataFrames they are given.  ``local_session`` is for tests / bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package is designed around.  On a cluster these
# belong in the cluster's defaults; ``local_session`` applies them for tests.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    used as is.  Only when it is unset (local tests) a fresh scratch folder
    is created and registered.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers (once per application).

    Python UDF / ``mapInPandas`` kernels live in this package; executors
    receive it as a zip through ``SparkContext.addPyFile`` -- the same
    mechanism as ``--py-files`` -- so jobs work whatever the working
    directory or cluster layout.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
