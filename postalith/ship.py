"""Send this package to the executors, whose Python does not see the driver's path."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: workers that start afterwards can import the package."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="postalith-code-")
    atexit.register(shutil.rmtree, folder, True)
    target = Path(folder) / "postalith.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
