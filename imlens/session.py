"""Session helpers.

The library never creates or stops a session inside an operator: every function takes the
caller's ``SparkSession`` or ``DataFrame``. ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "imlens") -> SparkSession:
    """A local session with AQE on, UI off and Arrow enabled (tests and bench only)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local_default=True)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, allow_local_default: bool | None = None) -> str:
    """Return the session's checkpoint folder, registering ``spark.checkpoint.dir`` if needed.

    On a cluster the folder must be shared storage named by ``spark.checkpoint.dir``; it is read
    from the session and never invented. Only a local master (tests, the bench) falls back to a
    fresh scratch folder when the setting is absent.
    """
    sc = spark.sparkContext
    if allow_local_default is None:
        allow_local_default = sc.master.startswith("local")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not allow_local_default:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3) "
                "so lineage can be cut without machine-local storage"
            )
        conf_dir = tempfile.mkdtemp(prefix="imlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder, deleted when the Python process ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        atexit.register(_clean_at_exit, spark)
    _SCRATCH.setdefault(app, []).append(path)
    return path


def written(df, name: str):
    """``df`` written to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df) -> None:
    """Delete the files of a ``written`` table that nothing lazy reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files that only finished steps have used."""
    gc.collect()
    spark._jvm.System.gc()


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this session so far; frames that read them are unusable afterwards."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def _clean_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None and spark.sparkContext.applicationId in _SCRATCH:
        clean_scratch(spark)


def ship_package(spark: SparkSession, shared: bool | None = None) -> None:
    """Make ``imlens`` importable in executor Python workers (what ``--py-files`` does).

    Pandas UDFs of this package reference its functions by module; a cluster where the package
    is not installed on the nodes gets a zip of it through ``addPyFile`` once per session. On a
    cluster (``shared``, the default for non-local masters) the zip is built in memory and written
    to the shared ``spark.checkpoint.dir`` through the Hadoop FileSystem API, never to a
    machine-local folder; a local master uses a scratch file.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_imlens_shipped", False):
        return
    if shared is None:
        shared = not sc.master.startswith("local")
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    data = buf.getvalue()
    if shared:
        target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/imlens-pyfiles-{uuid.uuid4().hex}/imlens.zip"
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        stream = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
    else:
        target = os.path.join(tempfile.mkdtemp(prefix="imlens-pyfiles-"), "imlens.zip")
        with open(target, "wb") as fh:
            fh.write(data)
    sc.addPyFile(target)
    sc._imlens_shipped = True


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Set runtime SQL confs for the duration of a job and restore the previous values."""
    previous = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            if v is not None:
                spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
