"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: settings that do not depend on the size of the cluster
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # generated methods of wide projections exceed the size the JIT compiles by default
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}

#: what to add on a cluster: larger scan splits (a 512 MB CSV split becomes one
#: Parquet file of useful size without a shuffle) and enough shuffle partitions
#: for AQE to coalesce from
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

#: files of a partitioned write that a task keeps open; with rows of more partitions it sorts the rest
OPEN_FILES = 32

#: bytes of the largest method that the JVM compiles by default; code of a stage with a larger one would be interpreted, for every row
COMPILED_BYTES = 8000

_own_dirs: dict[str, str] = {}


def local_session(cpus: str | int = "*", app: str = "tarmac", memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine, with a shared folder of its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=BASE_CONF)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", memory)
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tarmac-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(app: str, checkpoint_dir: str, **conf: str) -> SparkSession:
    """A session of the cluster that ``spark-submit`` names, with the settings for one; ``conf`` overrides them."""
    settings = {**BASE_CONF, **CLUSTER_CONF, "spark.checkpoint.dir": checkpoint_dir, **conf}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session, where every task runs on this machine, may fall back
    to a temporary folder; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tarmac-")
    return _own_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def session_beside(spark: SparkSession, **settings: str) -> SparkSession:
    """A session with the settings of ``spark`` and some of its own, which disturb nobody."""
    beside = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if beside.conf.get(key, None) != value and beside.conf.isModifiable(key):
            beside.conf.set(key, value)
    return beside


def writing_session(spark: SparkSession) -> SparkSession:
    """A session whose tasks keep the files of up to ``OPEN_FILES`` partitions open, where Spark would sort all rows by partition first.

    Stages whose code the JVM would not compile as one run as code in pieces, whatever options the JVM was started with.
    """
    return session_beside(spark, **{"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES), "spark.sql.codegen.hugeMethodLimit": str(COMPILED_BYTES)})


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows starts from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
