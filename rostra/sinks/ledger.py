"""A ledger of loads, so that a load can be repeated or replaced and two writers cannot both win (K5, K7).

Rows are written into a folder of their own, which no reader sees. An entry in the ledger, one small file whose
name is its number, makes them visible: it can be made only once, so of two writers who saw the
same ledger one has to look again. Readers take the folders that the entries name. An entry for a period
that replaces it hides what the ledger held for that period before; rows that were appended without a
ledger stay visible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from . import normalise_columns
from .merged import fingerprint

LEDGER, LOADS = "_ledger", "_loads"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def entries(spark: SparkSession, path: str) -> list[dict]:
    """All entries in order; one file per load."""
    jvm, fs, folder = _folder(spark, f"{path.rstrip('/')}/{LEDGER}")
    if not fs.exists(folder):
        return []
    files = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")), key=lambda p: p.getName())
    found = []
    for file in files:
        stream = fs.open(file)
        try:
            found.append(json.loads(jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()))
        finally:
            stream.close()
    return found


def commit(spark: SparkSession, path: str, number: int, entry: dict) -> bool:
    """Make entry ``number``; False if another writer made it first."""
    jvm, fs, folder = _folder(spark, f"{path.rstrip('/')}/{LEDGER}")
    fs.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(folder, f"{number:08d}.json")
    out = fs.create(draft)
    out.write(bytearray((json.dumps(entry) + "\n").encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            # A rename would replace the file on a local disk; a link does not.
            files, paths = jvm.java.nio.file.Files, jvm.java.nio.file.Paths
            local = lambda p: paths.get(jvm.java.net.URI(f"file://{p.toUri().getPath().replace(' ', '%20')}"))
            files.createLink(local(final), local(draft))
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                final.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
            ).rename(draft, final, none)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True


def _visible(held: list[dict]) -> list[str]:
    """Folders that count: for each period those from its last replacement on."""
    shown: dict[str | None, list[str]] = {}
    for entry in held:
        if entry["replaces"]:
            shown[entry["period"]] = []
        shown.setdefault(entry["period"], []).append(entry["folder"])
    return [f for folders in shown.values() for f in folders]


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Committed rows, and those that were appended without a ledger."""
    root = path.rstrip("/")
    folders = [f"{root}/{LOADS}/{f}" for f in _visible(entries(spark, path))]
    plain = spark.read.schema(schema).parquet(root)
    return plain.unionByName(spark.read.schema(schema).parquet(*folders)) if folders else plain


def _write(df: DataFrame, path: str) -> str:
    name = uuid.uuid4().hex
    df.write.parquet(f"{path.rstrip('/')}/{LOADS}/{name}")
    return name


def load_period(df: DataFrame, root: str, name: str, period: object, replace: bool = True) -> bool:
    """K5: load a period of a raw table. The same rows again are skipped; other rows replace the period's.

    Without ``replace`` they are added, and only the same rows are skipped.
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{name}"
    rows = normalise_columns(df)
    print_, period, folder = fingerprint(rows), str(period), None
    while True:
        held = entries(spark, path)
        own = [e for e in held if e["period"] == period]
        if own and (own[-1]["fingerprint"] == print_ if replace else print_ in {e["fingerprint"] for e in own}):
            return False
        folder = folder or _write(rows.withColumn("LOAD_AT", F.current_timestamp()), path)
        entry = {"period": period, "fingerprint": print_, "folder": folder, "replaces": replace}
        if commit(spark, path, len(held), entry):
            return True


def insert_absent(
    candidates: DataFrame, path: str, key: str, stamp: str = "generated_at", before_commit: Callable[[], None] | None = None
) -> int:
    """K7 with several writers: add rows whose key the table lacks, one per key; returns how many.

    A writer that finds another's entry in its place drops the keys that are there by now and tries again.
    ``before_commit`` is called between writing and committing.
    """
    spark = candidates.sparkSession
    _, fs, folder = _folder(spark, path)
    fs.mkdirs(folder)
    only = StructType([candidates.schema[key]])
    now = F.current_timestamp()
    given = F.coalesce(F.col(stamp), now) if stamp in candidates.columns else now
    rows = candidates.where(F.col(key).isNotNull()).dropDuplicates([key]).withColumn(stamp, given)
    while True:
        held = entries(spark, path)
        there = read(spark, path, only).select(key)
        name = _write(rows.join(there, key, "left_anti").select(*rows.columns), path)
        added = spark.read.schema(rows.schema).parquet(f"{path.rstrip('/')}/{LOADS}/{name}").count()
        if before_commit:
            before_commit()
        entry = {"period": None, "fingerprint": name, "folder": name, "replaces": False}
        if not added or commit(spark, path, len(held), entry):
            return added
