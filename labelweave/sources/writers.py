"""A9..A13 sinks and the table-state store.

TSV output mirrors Python's csv writer (tab separator, ``"`` quoting with
doubled quotes, header row, no whitespace trimming).  The store keeps
``overrides`` / ``runs`` / ``models`` append-only, and ``scores`` and
``final_collection`` as change logs (see ``SnapshotStore``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelweave import config as C


def _tsv_writer(df: DataFrame, mode: str):
    return (df.write.mode(mode).option("sep", "\t").option("header", True).option("quote", '"')
            .option("escape", '"').option("escapeQuotes", True).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False))


def write_classified_tsv(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write the 20-column rows (see ``catalog.output_row``) with a
    header, replacing what was there."""
    w = _tsv_writer(rows.select(*C.OUTPUT_HEADER, *([partition_by] if partition_by else [])), "overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def append_classified_tsv(rows: DataFrame, path: str) -> None:
    """A10: create if absent, then append (never truncates)."""
    _tsv_writer(rows.select(*C.OUTPUT_HEADER), "append").csv(path)


def to_response(df: DataFrame, status=None) -> DataFrame:
    """One response message per record: JSON of bibcode, scix_id,
    status, collections."""
    st = status if status is not None else (F.col("status") if "status" in df.columns else F.lit("success"))
    coll = F.col("collections") if "collections" in df.columns else F.col("collection")
    return df.select(F.to_json(F.struct(F.col("bibcode"), F.col("scix_id"), st.alias("status"),
                                        coll.alias("collections"))).alias("value"))


def forward(df: DataFrame, path: str) -> None:
    """A11 sink: response messages appended as JSON text lines."""
    to_response(df).write.mode("append").text(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Persist a metrics summary (one JSON object per run)."""
    df.write.mode("overwrite").json(path)


class SnapshotStore:
    """Persisted table state under one root folder (on shared storage).

    ``overrides`` / ``runs`` / ``models`` are append-only.  ``scores`` and
    ``final_collection`` are change logs: each batch writes only the rows it
    inserted or changed (partition ``batch=<id>``, overwritten when the batch
    is replayed) and the current table is the newest version per id.

    A log lives in ``<name>/v<k>``; ``compact`` writes the next version beside
    it and makes it current by creating one marker file, so a crash leaves the
    old version in force.

    A batch that changes several tables and files becomes visible as one:
    ``commit`` creates its marker after the last of its writes, and readers of
    ``committed`` batches see the batches up to it.  One stream with one
    checkpoint writes a store, so its batches are committed in order."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _path(self, *name: str) -> str:
        return os.path.join(self.root, *name)

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _scan(self, path: str) -> DataFrame | None:
        """The table at ``path``; None where nothing was written yet (a batch
        without rows leaves a folder without files)."""
        fs, p = self._fs(path)
        if not fs.exists(p) or all(
                st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p)):
            return None
        return self.spark.read.parquet(path)

    def append(self, name: str, df: DataFrame, batch_id: int | None = None) -> None:
        """Append rows; with ``batch_id`` the batch's rows land in their own
        partition, replaced on replay (dynamic partition overwrite)."""
        self._append(self._path(name), df, batch_id)

    def _append(self, path: str, df: DataFrame, batch_id: int | None) -> None:
        if batch_id is None:
            df.write.mode("append").parquet(path)
            return
        (df.withColumn("batch", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))

    def read(self, name: str, schema=None, before_batch: int | None = None) -> DataFrame:
        """Rows of an append-only table (empty frame of ``schema`` if absent);
        ``before_batch`` hides the rows of that batch and later ones."""
        df = self._scan(self._path(name))
        if df is None:
            return self.spark.createDataFrame([], schema)
        if before_batch is not None and "batch" in df.columns:
            df = df.filter(F.col("batch") < F.lit(int(before_batch)))
        return df.drop("batch") if "batch" in df.columns else df

    def _version(self, name: str) -> int:
        k = 0
        while self._exists(self._path(name, f"v{k + 1}.current")):
            k += 1
        return k

    def _log_path(self, name: str) -> str:
        return self._path(name, f"v{self._version(name)}")

    def log(self, name: str, before_batch: int | None = None) -> DataFrame | None:
        df = self._scan(self._log_path(name))
        if df is None:
            return None
        return df if before_batch is None else df.filter(F.col("batch") < F.lit(int(before_batch)))

    def current(self, name: str, schema, before_batch: int | None = None, records: DataFrame | None = None) -> DataFrame:
        """Current rows of a log table (newest version per id).  With
        ``records`` only rows sharing a scix_id or bibcode with them are read
        (prefetch)."""
        from labelweave.operators.latest import latest_per_key
        log = self.log(name, before_batch)
        if log is None:
            return self.spark.createDataFrame([], schema)
        if records is not None:
            s_ids = records.select("scix_id").filter(F.col("scix_id").isNotNull() & (F.col("scix_id") != ""))
            b_ids = records.select("bibcode").filter(F.col("bibcode").isNotNull() & (F.col("bibcode") != ""))
            log = log.join(s_ids, "scix_id", "left_semi").unionByName(log.join(b_ids, "bibcode", "left_semi"))
        return latest_per_key(log, "id", ["batch"]).drop("batch")

    def _commits(self) -> dict[int, str]:
        """The markers kept (the last two), with the digest each one holds."""
        fs, p = self._fs(self._path("commits"))
        if not fs.exists(p):
            return {}
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return {int(n.split("-")[0]): n.split("-", 1)[1] for n in names if n[:1].isdigit()}

    def committed(self) -> int:
        """The last committed batch (-1: none)."""
        return max(self._commits(), default=-1)

    def commit(self, batch_id: int, digest: str = "") -> None:
        """Show the batch to the readers of committed batches: one empty file,
        named by the batch and its ``digest``, created after all its writes.
        The marker before it stays, for a batch that is written again."""
        fs, p = self._fs(self._path("commits", f"{batch_id}-{digest}"))
        fs.create(p, True).close()
        for n, d in self._commits().items():
            if n < batch_id - 1 or (n == batch_id and d != digest):
                fs.delete(self._fs(self._path("commits", f"{n}-{d}"))[1], False)

    def begin(self, batch_id: int, digest: str = "") -> bool:
        """Whether the batch is to be written: not if it is committed with the
        same input.  With other input (a claim that has run out since) it is
        hidden and written anew.  A batch before the last one is an error: it
        comes from another checkpoint, whose batches need their own store."""
        done = self._commits()
        if batch_id < max(done, default=-1):
            raise ValueError(f"batch {batch_id} is older than the last one committed to {self.root}")
        if batch_id in done and done[batch_id] != digest:
            fs, p = self._fs(self._path("commits", f"{batch_id}-{done.pop(batch_id)}"))
            fs.delete(p, False)
        return batch_id not in done

    def read_committed(self, name: str, schema) -> DataFrame:
        """Rows of an append-only table from committed batches."""
        return self.read(name, schema, self.committed() + 1)

    def current_committed(self, name: str, schema, records: DataFrame | None = None) -> DataFrame:
        """``current`` as of the last committed batch."""
        return self.current(name, schema, self.committed() + 1, records)

    def committed_files(self, reader, root: str) -> DataFrame:
        """Rows of ``root/batch=<id>`` of committed batches; ``reader(path)``
        opens the files, the batch column selects folders before any is read."""
        return reader(root).filter(F.col("batch") <= F.lit(self.committed()))

    def write_changes(self, name: str, changes: DataFrame, batch_id: int) -> None:
        self._append(self._log_path(name), changes, batch_id)

    def compact(self, name: str) -> None:
        """Fold all batches but the last into one partition; the last keeps
        its own, so that it can still be replayed."""
        from labelweave.operators.latest import latest_per_key
        log = self.log(name)
        if log is None:
            return
        last = log.agg(F.max("batch")).first()[0]
        before = log.filter(F.col("batch") < F.lit(last))
        fold_to = before.agg(F.max("batch")).first()[0]
        if fold_to is None:
            return
        k = self._version(name)
        new = self._path(name, f"v{k + 1}")
        fs, p = self._fs(new)
        fs.delete(p, True)  # left by a compaction that did not end
        folded = latest_per_key(before, "id", ["batch"]).withColumn("batch", F.lit(int(fold_to)).cast("long"))
        folded.unionByName(log.filter(F.col("batch") == F.lit(last))).write.partitionBy("batch").parquet(new)
        self._fs(new)[0].create(self._fs(self._path(name, f"v{k + 1}.current"))[1], False).close()
        old_fs, old = self._fs(self._path(name, f"v{k}"))
        old_fs.delete(old, True)
