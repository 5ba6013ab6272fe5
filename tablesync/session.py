"""Session helpers: shared working folder, file system access, size checks."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T


_local: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """New folder name under the cluster's shared checkpoint folder; a temporary one on a local master where none is set (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _local.get("root")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local["root"] = tempfile.mkdtemp(prefix="tablesync-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a DataFrame in bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows themselves, counted by one aggregate: text and nested values by length, other values 8 bytes."""
    fixed, lengths = 16, []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            lengths.append(F.octet_length(col))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            lengths.append(F.octet_length(F.to_json(F.struct(col))))
        fixed += 8
    size = sum((F.coalesce(x, F.lit(0)) for x in lengths), F.lit(fixed))
    return int(df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0])


def is_small(df: DataFrame, max_bytes: int) -> bool | None:
    """Whether a table is proven to be small. None: its plan estimate is above the bound, so it was not measured.

    An estimate below the bound is no proof (files are compressed, aggregates and explodes are guessed).
    """
    return None if plan_bytes(df) > max_bytes else measured_bytes(df) <= max_bytes


def observed(observation: Observation, recount: DataFrame) -> dict:
    """Metrics of an observation. Adaptive execution drops the observing node when no row passes; then count again."""
    try:
        found = observation.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):  # that is how a metric without a row shows
            raise
        found = {}
    return {c: found[c] for c in recount.columns} if all(c in found for c in recount.columns) else recount.first().asDict()


class Files:
    """Few file operations through Hadoop's FileContext, so any file system Spark knows works."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(conf)
        self._fc = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        p = self._path(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def move(self, path: str, to: str) -> None:
        """Rename a file or folder inside the file system."""
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"{path} cannot be moved to {to}")

    def copy(self, path: str, to: str) -> None:
        """Copy a file or folder inside the file system."""
        conf = self._fs.getConf()
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._path(path), self._fs, self._path(to), False, conf)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, path: str, text: str) -> bool:
        """Write beside the target, then rename without overwrite. False when the target already exists."""
        tmp = self._path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(tmp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        try:
            none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = self._jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
            options[0] = none
            self._fc.rename(tmp, self._path(path), options)
            return True
        except Exception as e:
            self._fs.delete(tmp, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
