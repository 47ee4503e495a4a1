"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}  # scratch paths by application


def build_session(app_name: str = "custlens", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Master, memory and shuffle partitions are left to spark-submit; ``conf`` overrides anything
    (``**{"spark.master": "local[8]"}``).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: the cluster's ``spark.checkpoint.dir``.

    With a local master (one machine, as in tests) a temporary folder is made and set where nothing is configured.
    On a cluster a missing setting is an error: a folder on the driver's own disk would be read back empty.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors (master is {master})")
    folder = tempfile.mkdtemp(prefix="custlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no earlier run has used. ``clean_up`` deletes it."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    application = spark.sparkContext.applicationId
    if application not in _made:
        _made[application] = []
        atexit.register(clean_up, spark)
    _made[application].append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def clean_up(spark: SparkSession) -> None:
    """Delete what ``scratch_path`` has handed out. Call it when no result of the job is needed any more.

    It also runs when Python ends, as long as the session is still there.
    """
    if spark.sparkContext._jsc is None:
        return
    for path in _made.pop(spark.sparkContext.applicationId, []):
        files, place = _file_system(spark, path)
        files.delete(place, True)


def stage(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    For results that several branches of a query read: they are computed once, later plans are short and
    know the real size, and a lost executor costs no recomputation of what came before. The commit marker is
    looked for afterwards, so that a folder the driver cannot see is an error and never an empty table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.options(**options).parquet(path)
    files, place = _file_system(spark, f"{path}/_SUCCESS")
    if not files.exists(place):
        raise OSError(f"{path} holds no finished table: spark.checkpoint.dir is not shared, or commit markers are switched off")
    return spark.read.schema(df.schema).parquet(path)


def spread_rows(df: DataFrame, most: int, rows: int | None = None) -> DataFrame:
    """``df`` in tasks of about ``most`` rows, always the same ones in the same order; up to ``most`` rows stay as they are.

    For a staged table that is scanned many times. Narrow rows take so little room that the size of the files alone
    would leave millions of them to one task. ``rows`` spares counting them.
    """
    tasks = -(-(df.count() if rows is None else rows) // most)
    return df.repartition(tasks).sortWithinPartitions(*df.columns) if tasks > 1 else df
