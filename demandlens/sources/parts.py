"""Tables of parts that are replaced one by one, by day or by bucket of a key.

Every write goes to a folder of its own, ``<base>/data/version=<n>/<by>=<part>``; a small manifest,
``<base>/manifest/v=<n>``, says which version each part has. A reader takes the newest manifest that has
committed, so it sees a table before or after a write, never in between, and the files of a part that no write
touches stay as they are. The manifest also keeps the number of the last batch, so that a batch which runs again after
a failure is not applied twice. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from demandlens.sources.tables import _glob

#: The folder name of a null part.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = "part string, version long, batch long, schema string"


def bucket(key: str | Column, buckets: int) -> Column:
    """The bucket of a key, from 0; a null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Parts:
    """A table with one folder per value of the column ``by`` (a date or a whole number)."""

    spark: SparkSession
    base: str
    by: str

    def _manifests(self) -> list[int]:
        return sorted(int(m.getParent().getName()[2:]) for m in _glob(self.spark, f"{self.base}/manifest/v=*/_SUCCESS"))

    def _manifest(self, number: int | None = None) -> list:
        """(part, version, batch, schema): one row per part and one with a null part; that many rows come to the driver."""
        numbers = self._manifests()
        if not numbers:
            return []
        return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest/v={number or numbers[-1]}").collect()

    def exists(self) -> bool:
        return bool(self._manifests())

    def batch(self) -> int:
        """Number of the last batch applied, -1 if none."""
        return max((row["batch"] for row in self._manifest()), default=-1)

    def parts(self) -> list[str]:
        return sorted(row["part"] for row in self._manifest() if row["part"] is not None)

    def read(self, parts: list | None = None) -> DataFrame:
        """The table, or some of its parts; parts that it does not have are empty."""
        rows = self._manifest()
        if not rows:
            raise ValueError(f"no table at {self.base}")
        schema = StructType.fromJson(json.loads(rows[0]["schema"]))
        wanted = None if parts is None else {self.name(p) for p in parts}
        paths = [
            f"{self.base}/data/version={r['version']}/{self.by}={r['part']}"
            for r in rows if r["part"] is not None and (wanted is None or r["part"] in wanted)
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.base}/data").parquet(*paths).select(*schema.names)

    def replace(self, df: DataFrame, touched: list | None = None, batch: int = 0) -> DataFrame:
        """Replace the ``touched`` parts, or all, by the rows of ``df``; a touched part without rows goes.

        ``df`` has no rows of other parts. Returns the table.
        """
        before = self._manifest()
        version = max([*self._manifests(), 0]) + 1
        kept = [] if touched is None else [r for r in before if r["part"] is not None and r["part"] not in {self.name(p) for p in touched}]
        fields = [StructField(f.name, f.dataType) for f in df.schema.fields]
        path = f"{self.base}/data/version={version}"
        df.hint("rebalance", self.by).write.mode("overwrite").partitionBy(self.by).parquet(path)
        made = [p.getName()[len(self.by) + 1:] for p in _glob(self.spark, f"{path}/{self.by}=*")]
        schema = json.dumps(StructType(fields).jsonValue())
        rows = [(r["part"], r["version"], batch, schema) for r in kept] + [(p, version, batch, schema) for p in made] + [(None, version, batch, schema)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/v={version}")
        return self.read()

    def drop_unused(self, keep: int = 2) -> int:
        """Delete the parts that none of the last ``keep`` manifests names; returns how many went."""
        numbers = self._manifests()
        used = {(r["version"], r["part"]) for n in numbers[-keep:] for r in self._manifest(n)}
        gone = 0
        for folder in _glob(self.spark, f"{self.base}/data/version=*/{self.by}=*"):
            version, part = int(folder.getParent().getName()[8:]), folder.getName()[len(self.by) + 1:]
            if (version, part) not in used and numbers and version <= numbers[-1]:
                self._delete(folder)
                gone += 1
        for number in numbers[:-keep]:
            self._delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest/v={number}"))
        return gone

    def _delete(self, path) -> None:
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @staticmethod
    def name(part) -> str:
        return NULL_PART if part is None else str(part)


def values(df: DataFrame, column: str) -> list:
    """Distinct values of a column that names parts: as many as there are days or buckets."""
    return [r[0] for r in df.select(column).distinct().collect()]


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``keys``; rows with a null key stay."""
    return df.join(keys.select(key).distinct(), key, "left_anti")
