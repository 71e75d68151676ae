"""Session helpers: shipping the package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch: an executor holds some for every running task, on both sides.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def attach(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers (the same as ``--py-files``).

    Workers get one BLAS thread unless told otherwise: tasks already fill the cores. Arrow
    batches have ``BATCH_BYTES`` unless the session sets another number.
    """
    context = spark.sparkContext
    # Raw matrices read only the rows that bounds on row_id ask for.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    context.environment.setdefault("OMP_NUM_THREADS", "1")
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="vectrove-")) / "vectrove.zip"
        with zipfile.ZipFile(archive, "w") as bundle:
            for source in sorted(root.rglob("*.py")):
                bundle.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
