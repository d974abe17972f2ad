"""Tables in published versions, of which a load rewrites the buckets it touches.

A version is a list that names for every bucket the load that wrote it. Loads go to
directories of their own and are never changed; a version exists once its list does, and
the list appears by a rename, which is the last thing a load does. So a load that breaks
off leaves files nobody reads, readers keep the version before it, and buckets that a load
does not touch stay the files they were. Rows are dealt out by a hash of the key, so all
rows of a key are in one bucket and a change of a few keys rewrites a few buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.sources.sinks import gathered


class VersionConflict(RuntimeError):
    """Another load published a version in the meantime."""


@dataclass(frozen=True)
class Version:
    """A published version: its place in the order, its name, and the load of each bucket."""

    number: int
    name: str
    loads: dict[int, str]

    def text(self) -> str:
        return json.dumps({"name": self.name, "loads": {str(b): load for b, load in sorted(self.loads.items())}})


EMPTY = Version(0, "", {})


@dataclass(frozen=True)
class VersionedTable:
    """A table below `root`; the number of buckets belongs to the table and is at most `MOST_BUCKETS`."""

    MOST_BUCKETS = 65_536

    root: str
    schema: T.StructType
    key: str
    buckets: int = 64
    by: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self):
        if not 0 < self.buckets <= self.MOST_BUCKETS:
            raise ValueError(f"buckets must be between 1 and {self.MOST_BUCKETS}")

    def bucket(self, column: str | None = None) -> Column:
        kind = self.schema[self.key].dataType
        return F.pmod(F.xxhash64(F.col(column or self.key).try_cast(kind)), F.lit(self.buckets)).cast("int")

    # Versions

    def versions(self, spark: SparkSession) -> list[Version]:
        """All published versions, oldest first."""
        return [self._read_list(spark, name) for name in self._lists(spark)]

    def current(self, spark: SparkSession) -> Version:
        """The version published last; an empty one where there is none."""
        found = self._lists(spark)
        return self._read_list(spark, found[-1]) if found else EMPTY

    def named(self, spark: SparkSession, name: str) -> Version:
        """The last version of that name."""
        found = [v for v in self.versions(spark) if v.name == name]
        if not found:
            raise KeyError(f"no version {name} below {self.root}")
        return found[-1]

    def before(self, spark: SparkSession, name: str) -> Version:
        """What a load named `name` starts from: the last version of another name.

        So a load that is repeated replaces what it published before instead of adding to it.
        """
        found = [v for v in self.versions(spark) if v.name != name]
        return found[-1] if found else EMPTY

    # Reading

    def read(
        self, spark: SparkSession, version: Version | None = None, buckets: Iterable[int] | None = None
    ) -> DataFrame:
        """The rows of a version (the current one by default), of some buckets or of all."""
        version = version or self.current(spark)
        wanted = version.loads if buckets is None else set(buckets) & version.loads.keys()
        paths = [f"{self._data}/load={version.loads[b]}/bucket={b}" for b in sorted(wanted)]
        if not paths:
            return spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("load", T.StringType()), T.StructField("bucket", T.IntegerType())])
        rows = spark.read.schema(stored).option("basePath", self._data).parquet(*paths)
        return rows.select(*self.schema.fieldNames())

    def touched(self, keys: DataFrame, column: str | None = None) -> set[int]:
        """The buckets of some keys: at most `buckets` numbers."""
        return {r.bucket for r in keys.select(self.bucket(column).alias("bucket")).distinct().collect()}

    # Writing

    def publish(
        self, rows: DataFrame, name: str, base: Version = EMPTY, replaces: Iterable[int] | None = None
    ) -> Version:
        """Write `rows` as the buckets `replaces` (all by default) of a new version over `base`.

        Buckets outside `replaces` keep the files of `base`; one that no row falls into is
        empty from then on. Raises VersionConflict, and publishes nothing, if another version
        came in between.
        """
        spark = rows.sparkSession
        replaced = set(range(self.buckets)) if replaces is None else set(replaces)
        number = self.current(spark).number + 1
        load = f"{number}-{uuid.uuid4().hex[:12]}"
        written: set[int] = set()
        if replaced:
            bucketed = rows.select(*self.schema.fieldNames()).withColumn("bucket", self.bucket())
            path = f"{self._data}/load={load}"
            gathered(bucketed, ["bucket"]).write.partitionBy("bucket", *self.by).parquet(path)
            written = self._written(spark, path)
        if not written <= replaced:
            raise ValueError(f"rows fall into buckets {sorted(written - replaced)}, which are not replaced")
        kept = {b: own for b, own in base.loads.items() if b not in replaced}
        version = Version(number, name, kept | dict.fromkeys(written, load))
        self._commit(spark, version)
        return version

    def clean(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Remove all but the last `keep` versions and the loads that only they or nobody uses.

        Not to be run next to a load, whose files no version names yet. Returns the loads removed.
        """
        found = self.versions(spark)
        stay = found[max(len(found) - max(keep, 1), 0) :]
        for version in found[: len(found) - len(stay)]:
            path = self._path(spark, "_versions", _file(version.number))
            _system(spark, path).delete(path, False)
        used = {load for v in stay for load in v.loads.values()}
        data = self._path(spark, "data")
        system = _system(spark, data)
        gone = []
        for entry in system.listStatus(data) if system.exists(data) else []:
            load = entry.getPath().getName().removeprefix("load=")
            if load not in used:
                system.delete(entry.getPath(), True)
                gone.append(load)
        return gone

    # Files

    @property
    def _data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    def _path(self, spark: SparkSession, *parts: str):
        return spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root.rstrip("/"), *parts]))

    def _written(self, spark: SparkSession, path: str) -> set[int]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [f.getPath().getName() for f in _system(spark, folder).listStatus(folder)]
        return {int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket=")}

    def _lists(self, spark: SparkSession) -> list[str]:
        folder = self._path(spark, "_versions")
        system = _system(spark, folder)
        if not system.exists(folder):
            return []
        names = sorted(f.getPath().getName() for f in system.listStatus(folder))
        return [name for name in names if name.endswith(".json")]

    def _read_list(self, spark: SparkSession, name: str) -> Version:
        path = self._path(spark, "_versions", name)
        stream = _system(spark, path).open(path)
        try:
            known = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(int(name.removesuffix(".json")), known["name"], {int(b): load for b, load in known["loads"].items()})

    def _commit(self, spark: SparkSession, version: Version) -> None:
        """Let the list of a version appear under its number, if the number is still free."""
        target = self._path(spark, "_versions", _file(version.number))
        system = _system(spark, target)
        draft = self._path(spark, "_versions", f".{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(version.text().encode())
        out.close()
        if system.exists(target) or not system.rename(draft, target):
            system.delete(draft, False)
            raise VersionConflict(f"version {version.number} below {self.root} is taken")


def _file(number: int) -> str:
    return f"{number:012d}.json"


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())
