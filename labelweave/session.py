"""Session helpers: building a session for tests / benches and finding the
shared checkpoint folder the cluster names."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "labelweave",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage and we only read it.
    Only a local master (tests) may leave it unset; it then gets a scratch
    folder of this machine.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="lw-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder for derived files.
    The application's scratch root is deleted when its driver ends."""
    import uuid
    sc = spark.sparkContext
    root = os.path.join(ensure_checkpoint_dir(spark), "lw-scratch", sc.applicationId)
    if root not in _SCRATCH_ROOTS:
        p = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _SCRATCH_ROOTS.add(root)
    return os.path.join(root, f"{tag}-{uuid.uuid4().hex[:12]}")


_SCRATCH_ROOTS: set = set()


def rename_parts(spark: SparkSession, src_dir: str, dest_dir: str, prefix: str, ext: str) -> list[str]:
    """Give the part files Spark wrote in ``src_dir`` stable names
    ``<prefix><n><ext>`` in ``dest_dir`` (metadata-only renames)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(src_dir)
    fs = src.getFileSystem(conf)
    dest = jvm.org.apache.hadoop.fs.Path(dest_dir)
    fs.mkdirs(dest)
    names = sorted(st.getPath().getName() for st in fs.listStatus(src) if st.getPath().getName().startswith("part-"))
    out = []
    for i, n in enumerate(names):
        target = jvm.org.apache.hadoop.fs.Path(dest, f"{prefix}{i + 1}{ext}")
        fs.rename(jvm.org.apache.hadoop.fs.Path(src, n), target)
        out.append(target.toString())
    return out


def stamp_in_name_order(spark: SparkSession, folder: str, start_ms: int = 1_000_000_000_000) -> int:
    """Give the part files of ``folder`` strictly increasing modification
    times in name order, so a file stream source reads them in that order
    (metadata only; used to replay time-ordered data as a stream)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")),
                   key=lambda x: x.getName())
    for i, part in enumerate(parts):
        fs.setTimes(part, start_ms + i * 1000, -1)
    return len(parts)


def cut_lineage(df):
    """Materialise ``df`` once as a Parquet table in the shared checkpoint
    folder and read it back, so every later branch scans that table instead
    of re-deriving it (one computation; survives executor loss)."""
    spark = df.sparkSession
    path = scratch_dir(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``labelweave`` importable in Python workers (pandas UDFs,
    ``applyInPandas``, ``mapInPandas`` and stateful functions refer to it):
    zip the package once per application and register it with
    ``addPyFile``, the same mechanism as ``spark-submit --py-files``."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="lw-pyfiles-"), "labelweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
