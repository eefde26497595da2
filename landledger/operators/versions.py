"""Published sets of tables: immutable versions under one pointer, and a crosswalk that is only ever appended to.

::

    root/versions/<name>/<table>/   rows of one publication, never written again
    root/log/<number>               one entry per publication: its folder and tables; the highest number is current
    root/crosswalk/<number>/        the rows minted by one batch; all batches together are the crosswalk

A publication writes all its tables to a new folder, then claims the next log number by renaming a finished entry, which fails if
the number exists. Readers see the old set or the new one, each whole. A run that dies before its claim leaves a folder that
nothing names; ``recover`` removes it. Ids are appended before any table that uses them is published, so the next run finds them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.operators import keys as K
from landledger.session import materialize, passing, write


class Conflict(RuntimeError):
    """Somebody else published, or minted, in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    tables: dict[str, dict]


class Store:
    """A place for published tables, on any file system that renames without overwriting."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        home, conf = hadoop.fs.Path(self.root), spark._jsc.hadoopConfiguration()
        self._files = home.getFileSystem(conf)
        self._context = hadoop.fs.FileContext.getFileContext(home.toUri(), conf)

    # --- files: control data only, the rows go through Spark -----------------------------------------------------------------

    def _names(self, folder: str) -> dict[str, int]:
        """Entries of a folder with their time of change in milliseconds."""
        path = self._path(f"{self.root}/{folder}")
        if not self._files.exists(path):
            return {}
        return {status.getPath().getName(): status.getModificationTime() for status in self._files.listStatus(path)}

    def _numbers(self, folder: str) -> list[int]:
        return sorted(int(name) for name in self._names(folder) if name.isdigit())

    def _claim(self, made: str, folder: str, number: int) -> None:
        """Give what was made under a name of its own the next number of ``folder``; ``Conflict`` if that is taken."""
        wanted = self._path(f"{self.root}/{folder}/{number:020d}")
        if self._files.exists(wanted):
            self._drop(made)
            raise Conflict(f"{folder} {number} exists")
        try:
            options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            self._context.rename(self._path(f"{self.root}/{made}"), wanted, options)
        except Exception as error:
            if self._files.exists(wanted):
                self._drop(made)
                raise Conflict(f"{folder} {number} exists") from error
            raise

    def _drop(self, name: str) -> None:
        self._files.delete(self._path(f"{self.root}/{name}"), True)

    # --- the crosswalk --------------------------------------------------------------------------------------------------------

    def crosswalk(self) -> DataFrame:
        """All rows of all batches; empty before the first."""
        batches = [f"{self.root}/crosswalk/{number:020d}" for number in self._numbers("crosswalk")]
        if not batches:
            return K.empty_crosswalk(self.spark)
        return self.spark.read.schema(K.CROSSWALK).parquet(*batches)

    def append(self, crosswalk: DataFrame) -> int:
        """Add the rows whose reference is not in the log yet, and return how many those are.

        A reference that the log knows under another number, or a number that it has given away, is a ``Conflict``: the caller
        minted from an older crosswalk and must mint again. Known references with their own number are passed over.
        """
        with passing():
            return self._appended(crosswalk)

    def _appended(self, crosswalk: DataFrame) -> int:
        batches = self._numbers("crosswalk")
        known = materialize(self.crosswalk().select(F.col("region").alias("_region"), F.col("native_ref").alias("_ref"), F.col("seq").alias("_seq")), "crosswalk-log")
        on = (F.col("region") == F.col("_region")) & (F.col("native_ref") == F.col("_ref"))
        joined = materialize(crosswalk.select("region", "native_ref", "seq").join(known, on, "left"), "crosswalk-batch")
        new = joined.where("_ref is null").select("region", "native_ref", "seq")
        moved = joined.where("_seq <> seq").select("region", "native_ref", "seq")
        given = known.select(F.col("_region").alias("region"), F.col("_ref").alias("native_ref"), F.col("_seq").alias("seq"))
        broken = moved.head(1) or K.crosswalk_violations(given.unionByName(new)).head(1)
        if broken:
            raise Conflict(f"the log has given away other numbers: {broken}")
        n = new.count()
        if n:
            made = f"crosswalk/_{uuid.uuid4().hex}"
            write(new, f"{self.root}/{made}")
            self._claim(made, "crosswalk", (batches[-1] if batches else 0) + 1)
        return n

    def mint(self, refs: DataFrame) -> DataFrame:
        """The crosswalk with all of ``refs`` (region, native_ref) in it, new ones numbered and appended first.

        Minting again from the log is all that a lost race or a run that died needs.
        """
        while True:
            known = materialize(self.crosswalk(), "crosswalk")
            new = materialize(K.mint(known, refs), "minted")
            try:
                self.append(new)
                return known.unionByName(new)
            except Conflict:
                continue

    # --- tables ---------------------------------------------------------------------------------------------------------------

    def _version(self, number: int) -> Version:
        lines = self.spark.read.text(f"{self.root}/log/{number:020d}", wholetext=True).collect()
        entry = json.loads(lines[0]["value"])
        return Version(number, entry["folder"], entry["tables"])

    def current(self) -> Version | None:
        """The last publication; None before the first."""
        numbers = self._numbers("log")
        return self._version(numbers[-1]) if numbers else None

    def _enter(self, folder: str, tables: dict[str, dict], after: int) -> int:
        made = f"log/_{uuid.uuid4().hex}"
        self._files.mkdirs(self._path(f"{self.root}/log"))
        out = self._files.create(self._path(f"{self.root}/{made}"), False)
        out.write(bytearray(json.dumps({"folder": folder, "tables": tables}, sort_keys=True).encode()))
        out.close()
        self._claim(made, "log", after + 1)
        return after + 1

    def publish(self, tables: Mapping[str, DataFrame], keep: bool = False) -> int:
        """Write all tables and make them current together; returns the version's number.

        The tables may be made from the current ones: those do not change meanwhile. With ``keep``, tables of the current version
        that are not given stay in the new one, where they are. If another run publishes between start and end, this one is a
        ``Conflict`` and nothing changes. A failure of any kind leaves the current version as it is.
        """
        before = self.current()
        folder = uuid.uuid4().hex
        entries = dict(before.tables) if keep and before else {}
        for name, rows in tables.items():
            path = f"versions/{folder}/{name}"
            write(rows, f"{self.root}/{path}")
            written = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{path}")
            entries[name] = {"path": path, "rows": written.count(), "schema": rows.schema.json()}
        return self._enter(folder, entries, before.number if before else 0)

    def roll_back(self, number: int) -> int:
        """Make an older version current again, under a number of its own."""
        old, now = self._version(number), self.current()
        return self._enter(old.folder, old.tables, now.number)

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """A table of the current version, or of that ``number``. A frame stays with its version when another is published."""
        version = self._version(number) if number is not None else self.current()
        if version is None or table not in version.tables:
            raise KeyError(f"{table} is not published in {self.root}")
        entry = version.tables[table]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{self.root}/{entry['path']}")

    def register(self, database: str) -> list[str]:
        """Views of the current version's tables in a database, for SQL. Run it again after a publication."""
        version = self.current()
        names = sorted(version.tables) if version else []
        for name in names:
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.`{name}` AS SELECT * FROM parquet.`{self.root}/{version.tables[name]['path']}`")
        return names

    def versions(self) -> DataFrame:
        """(version, table, rows, path) of all publications."""
        rows = [(n, name, entry["rows"], entry["path"]) for n in self._numbers("log") for name, entry in sorted(self._version(n).tables.items())]
        return self.spark.createDataFrame(rows, "version bigint, table string, rows bigint, path string")

    def recover(self, older_than: float = 86_400.0) -> list[str]:
        """Remove what runs that died have left: folders that no entry names and unfinished batches and entries, if they have not
        changed for that many seconds, so that a run at work is spared. Returns their names."""
        named = {entry["path"].split("/")[1] for n in self._numbers("log") for entry in self._version(n).tables.values()}
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        left = []
        for folder in ("versions", "log", "crosswalk"):
            for name, changed in self._names(folder).items():
                loose = name not in named if folder == "versions" else name.startswith("_")
                if loose and now - changed >= 1000 * older_than:
                    self._drop(f"{folder}/{name}")
                    left.append(f"{folder}/{name}")
        return sorted(left)
