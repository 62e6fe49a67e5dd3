"""Tables that grow batch by batch and are partitioned by a column's values.

Layout: ``<root>/<table>/batch=<name>/<column>=<value>/part-*``.  A batch is
complete once its folder has ``_SUCCESS``; readers see complete batches only,
and a batch that is written again under its name replaces what a failed try
left (a complete one stays as it is).  ``batch`` and the partition column come
back as columns, so a filter on either prunes folders before any file is
opened, and a join on them prunes at run time.

``replace`` swaps single partitions (dynamic overwrite): folders that get no
rows are not touched.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import CODEC

_BATCH = re.compile(r"[A-Za-z0-9][\w.-]*")


class PartitionedTable:
    """``schema`` holds the columns of the files; ``by`` is the partition
    column (``None``: batches only), an integer that may be NULL."""

    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType, by: str | None = None):
        self.spark, self.name, self.by = spark, name, by
        self.path = f"{root.rstrip('/')}/{name}"
        self.schema = schema
        parts = [T.StructField("batch", T.StringType())] + ([T.StructField(by, T.IntegerType())] if by else [])
        self.full = T.StructType([*schema.fields, *parts])

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def batches(self) -> list[str]:
        """Names of the complete batches."""
        fs, path = self._fs(self.path)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return sorted(n.removeprefix("batch=") for n in names
                      if n.startswith("batch=") and fs.exists(self._fs(f"{self.path}/{n}/_SUCCESS")[1]))

    def read(self, batches: list[str] | None = None) -> DataFrame:
        """Rows of the complete batches (or of those named)."""
        have = self.batches()
        paths = [f"{self.path}/batch={b}" for b in (have if batches is None else [b for b in batches if b in have])]
        if not paths:
            return self._empty()
        return self.spark.read.schema(self.full).option("basePath", self.path).parquet(*paths)

    def leaves(self, batches: list[str]) -> list[tuple[str, int]]:
        """(batch, partition value) of the folders of complete batches; NULL is
        left out.  Folder names only, no file is opened."""
        have, out = set(self.batches()), []
        for batch in batches:
            if batch not in have:
                continue
            fs, path = self._fs(f"{self.path}/batch={batch}")
            for s in fs.listStatus(path):
                m = re.fullmatch(rf"{self.by}=(-?\d+)", s.getPath().getName())
                if m:
                    out.append((batch, int(m[1])))
        return out

    def read_leaves(self, leaves: list[tuple[str, int]]) -> DataFrame:
        """Rows of those folders."""
        if not leaves:
            return self._empty()
        paths = [f"{self.path}/batch={b}/{self.by}={v}" for b, v in leaves]
        return self.spark.read.schema(self.full).option("basePath", self.path).parquet(*paths)

    def _empty(self) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.full.fields])

    def append(self, df: DataFrame, batch: str, again: bool = False) -> bool:
        """Write ``df`` (the columns of ``schema`` and the partition column) as
        ``batch``; false if that batch is complete already, unless it is to be
        written ``again``."""
        if not _BATCH.fullmatch(batch):
            raise ValueError(f"batch name {batch!r}: letters, digits, '.', '_' and '-' only")
        if batch in self.batches() and not again:
            return False
        self._write(df.select(*self._columns()), f"{self.path}/batch={batch}", [self.by] if self.by else [], "overwrite")
        return True

    def replace(self, df: DataFrame) -> None:
        """Overwrite the (batch, partition) folders that ``df`` (with both
        columns) has rows for, and no others.  ``df`` may be made from this
        table only if it was staged before."""
        self._write(df.select("batch", *self._columns()), self.path, ["batch"] + ([self.by] if self.by else []), "dynamic")

    def _columns(self) -> list:
        fields = [*self.schema.fields] + ([self.full[self.by]] if self.by else [])
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]

    def _write(self, df: DataFrame, path: str, by: list[str], mode: str) -> None:
        writer = df.write.mode("overwrite").option("compression", CODEC).option("partitionOverwriteMode", "dynamic" if mode == "dynamic" else "static")
        (writer.partitionBy(*by) if by else writer).parquet(path)
        if mode == "dynamic":  # the job's mark belongs to no batch
            fs, mark = self._fs(f"{path}/_SUCCESS")
            fs.delete(mark, False)

    def files(self) -> list[str]:
        """Paths of the data files, below the table's folder."""
        fs, path = self._fs(self.path)
        out = []
        if fs.exists(path):
            it = fs.listFiles(path, True)
            while it.hasNext():
                name = it.next().getPath().toString()
                if "/part-" in name:
                    out.append(name[name.index(f"/{self.name}/") + len(self.name) + 2:])
        return sorted(out)
