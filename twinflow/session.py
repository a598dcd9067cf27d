"""Session helpers: a tuned local session and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# own folders of local applications without a preset one
_LOCAL: dict[str, str] = {}


def local_session(cores: str = "*", name: str = "twinflow", **conf) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # the JVM does not compile methods over 8000 bytes of byte code; the
        # checks make such methods, so let Spark cut them into operators
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A private temporary
    folder is only used where there is one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    # static settings can't be changed, so the folder is kept here
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    For inputs that a job reads several times: documents are parsed and
    checked once, later reads are columnar and pruned, and a lost executor
    only costs a re-read.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
