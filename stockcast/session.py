"""Session helpers: a local session for tests/bench, UTC dates, shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Dates are taken in the session zone (the reference takes the machine zone);
# every query pins it to UTC so that day offsets do not depend on the host.
SESSION_ZONE = "UTC"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stockcast") -> SparkSession:
    """A local-mode session configured the way tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_ZONE)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STOCKCAST_DRIVER_MEMORY", "16g"))
        # the Python state server of transformWithState talks over a socket
        # file instead of a loopback TCP port
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)


def plain_unions(spark: SparkSession) -> None:
    """Unions forget how their inputs are partitioned, as they did before Spark 4.1.

    With 4.1.2's default, a union of two unions of equally partitioned tables (such as
    the two differences of two order tables) gave wrong rows: groups were
    taken for co-located that were not (``tests/test_state.py``)."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a fresh folder is made on a local
    master (tests) only; on a cluster that is an error, as a machine-local
    folder would be invisible to the other machines.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="stockcast-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once an application, so that Python
    tasks can import it wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        home = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="stockcast-py-"), "stockcast.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(home):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("stockcast", os.path.relpath(path, home)))
        sc.addPyFile(archive)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a frame used by several branches of one plan.

    Spark does not reuse an exchange whose branches were pruned to different
    columns, so a shared intermediate would be recomputed per branch (scans
    and joins included). A reliable ``checkpoint`` writes it once to the
    shared checkpoint folder; it also survives the loss of an executor.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
