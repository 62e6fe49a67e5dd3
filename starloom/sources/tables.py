"""Versioned Parquet layer tables.

Parquet has no transactional overwrite, and overwriting a folder that the
same plan reads fails.  Each write therefore goes to a new version folder
``<root>/<table>/v<NNNNNN>``; readers take the highest complete version
(one with ``_SUCCESS``) and the complete batches appended to it, each in a
folder of its own (``v<NNNNNN>-<batch>``).  A failed write leaves a folder without
``_SUCCESS``: no reader sees it and no later write uses its number.  An append
that is tried again under its batch name replaces what a failed try left, and
does nothing once the batch is complete.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import LAYERS
from starloom.session import CODEC

_VERSION = re.compile(r"^v(\d{6,})(?:-(.+))?$")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- file system helpers (Hadoop FS through the session) --------------
    def _fs_path(self, p: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, path

    def _folders(self, name: str) -> list[tuple[int, str | None, bool]]:
        """(version, batch or None, complete) of every folder."""
        fs, path = self._fs_path(f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            m = _VERSION.match(st.getPath().getName())
            if m:
                done = fs.exists(self._fs_path(f"{st.getPath().toString()}/_SUCCESS")[1])
                out.append((int(m.group(1)), m.group(2), done))
        return sorted(out, key=lambda x: (x[0], x[1] or ""))

    def _versions(self, name: str) -> list[int]:
        return [v for v, batch, done in self._folders(name) if batch is None and done]

    def _next_version(self, name: str) -> int:
        return max((v for v, _, _ in self._folders(name)), default=0) + 1

    def _version_path(self, name: str, v: int, batch: str | None = None) -> str:
        return f"{self.root}/{name}/v{v:06d}" + (f"-{batch}" if batch else "")

    def current_path(self, name: str) -> str | None:
        vs = self._versions(name)
        return self._version_path(name, vs[-1]) if vs else None

    def current_paths(self, name: str) -> list[str]:
        """The current version and its complete batches."""
        vs = self._versions(name)
        return [self._version_path(name, v, batch) for v, batch, done in self._folders(name)
                if done and vs and v == vs[-1]]

    # -- S4 -----------------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        paths = self.current_paths(name)
        if not paths:
            raise FileNotFoundError(f"table {name!r} has no complete version under {self.root}")
        return self.spark.read.parquet(*paths)

    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    # -- S5 / S6 ------------------------------------------------------------
    def write(self, df: DataFrame, name: str, schema: T.StructType | None = None,
              partition_by: list[str] | None = None) -> DataFrame:
        """Replace ``name`` with ``df`` (new version).  With ``schema``,
        the rows must carry exactly those columns; they are cast and ordered
        to it (truncate + reload keeping the declared schema)."""
        if schema is not None:
            df = conform(df, schema)
        path = self._version_path(name, self._next_version(name))
        writer = df.write.mode("errorifexists").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.parquet(path)

    def append(self, df: DataFrame, name: str, batch: str | None = None) -> DataFrame:
        """S3: add a batch to the current version (creating the first one).
        With a ``batch`` name the call may be repeated: a complete batch of
        that name stays as it is."""
        vs = self._versions(name)
        if not vs:
            empty = self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
            self.write(empty, name)
            vs = self._versions(name)
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.=-]+", batch):
            raise ValueError(f"batch name {batch!r}: letters, digits, '.', '_', '=' and '-' only")
        if (vs[-1], batch, True) not in self._folders(name):
            df.write.mode("overwrite").option("compression", CODEC).parquet(self._version_path(name, vs[-1], batch))
        return self.read(name)

    def batches(self, name: str) -> list[str]:
        """Names of the current version's complete batches."""
        vs = self._versions(name)
        return [b for v, b, done in self._folders(name) if b and done and vs and v == vs[-1]]

    def read_batch(self, name: str, batch: str) -> DataFrame:
        """The rows of one appended batch."""
        return self.spark.read.parquet(self._version_path(name, self._versions(name)[-1], batch))

    def expire(self, name: str, keep: int = 2) -> list[str]:
        """Delete all but the ``keep`` newest complete versions (with their
        batches) and what failed writes left below the current one."""
        vs, gone = self._versions(name), []
        old = set(vs[:-keep] if keep else vs)
        for v, batch, done in self._folders(name):
            if v in old or (vs and not done and v < vs[-1]):
                fs, path = self._fs_path(self._version_path(name, v, batch))
                fs.delete(path, True)
                gone.append(path.toString())
        return gone

    # -- S7 -----------------------------------------------------------------
    def copy(self, source: str, target: str, schema: T.StructType | None = None) -> DataFrame:
        return self.write(self.read(source), target, schema)

    # -- S9 / S10 -------------------------------------------------------------
    def init_layers(self) -> dict[str, DataFrame]:
        """Create every layer table empty with its declared schema."""
        out = {}
        for tables in LAYERS.values():
            for name, schema in tables.items():
                empty = self.spark.range(0).select(*[
                    F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
                out[name] = self.write(empty, name)
        return out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check column names against ``schema`` and cast to its types/order."""
    have = {c.lower(): c for c in df.columns}
    want = [f.name for f in schema.fields]
    missing = [w for w in want if w.lower() not in have]
    extra = [c for c in df.columns if c.lower() not in {w.lower() for w in want}]
    if missing or extra:
        raise ValueError(f"schema mismatch: missing={missing} extra={extra}")
    return df.select(*[F.col(have[f.name.lower()]).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
