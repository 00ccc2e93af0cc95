"""What a session needs before the operators run on its executors."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def package() -> bytes:
    """This package's modules as a zip file."""
    root, out = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each application; Spark serves the file from the driver."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        folder = Path(tempfile.mkdtemp(prefix="transquill-code-"))
        (folder / "transquill_package.zip").write_bytes(package())
        spark.sparkContext.addPyFile(str(folder / "transquill_package.zip"))
        _shipped.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package sent first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
