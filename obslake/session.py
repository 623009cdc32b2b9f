"""Session and shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_local_base: dict[str, str] = {}


def build_session(cores: int | str = "*", app_name: str = "obslake", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str = "run") -> str:
    """A new, not yet existing folder below the shared folder of the cluster.

    The shared folder is what ``spark.checkpoint.dir`` names. Only a local
    session may do without it; a machine-local folder would be out of reach
    for the executors of a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        app = spark.sparkContext.applicationId
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="obslake-")
        base = _local_base[app]
    return f"{base.rstrip('/')}/obslake-{purpose}-{uuid.uuid4().hex}"


def session_with(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """Another session of the application, with the settings of this one but for some."""
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **conf}.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python tasks, wherever the cluster runs them."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="obslake-")) / "obslake-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
