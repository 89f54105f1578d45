"""Keyed Parquet tables that rewrite only the buckets a change falls into.

Rows lie in a fixed number of buckets of their key.  A manifest names, for every table and
bucket, the one set of files that holds it; a change writes a new set for the buckets it
touches and publishes a new manifest, in which all other buckets keep their sets.  Manifests
are complete before they get their name, and a name is given only if it is still free, so two
writers cannot both take one version: the later one looks again, and repeats its work only if
a bucket of its own has changed.  Readers see one manifest, never half a change.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glosa.operators.skew import KEY_SPACE, portable_key

TRIES = 20


@dataclass
class Table:
    """Columns, the bigint key that names the bucket, folders inside a bucket, and the order of rows."""

    schema: StructType
    key: str
    folders: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


@dataclass
class Manifest:
    """One version: table -> bucket -> name of its set of files; buckets without rows are left out."""

    version: int = 0
    sets: dict[str, dict[str, str]] = field(default_factory=dict)
    tags: dict[str, int] = field(default_factory=dict)


class BucketStore:
    """Tables under one path; ``buckets`` is fixed when the first change is made."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table], buckets: int = 64):
        self.spark, self.path, self.tables, self.buckets = spark, path.rstrip("/"), tables, buckets

    # ------------------------------------------------------------- file system
    def _hadoop(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(conf)

    def _names(self, path: str) -> list[str]:
        place, fs = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def _text(self, path: str) -> str:
        place, fs = self._hadoop(path)
        stream = fs.open(place)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish(self, path: str, text: str) -> bool:
        """Give the text a name if that is still free."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        place, fs = self._hadoop(path)
        draft, _ = self._hadoop(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        how = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        qualified = fs.makeQualified(place)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf).rename(
                fs.makeQualified(draft), qualified, how)
        except Py4JJavaError:
            if not fs.exists(place):
                raise
            fs.delete(draft, False)
            return False
        return True

    # --------------------------------------------------------------- manifests
    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.path}/manifests") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The latest manifest, or the one of a version."""
        if version is None:
            found = self.versions()
            if not found:
                return Manifest()
            version = found[-1]
        held = json.loads(self._text(f"{self.path}/manifests/{version}.json"))
        if held["buckets"] != self.buckets:
            raise ValueError(f"the store has {held['buckets']} buckets, not {self.buckets}")
        return Manifest(version, held["sets"], held["tags"])

    def bucket_of(self, key: Column) -> Column:
        """Bucket of a key; a null key has the bucket 0."""
        hashed = portable_key(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))
        return F.floor(hashed * self.buckets / KEY_SPACE).cast("int")

    def bucket_number(self, key: int) -> int:
        """``bucket_of`` for one key."""
        return (key % (1 << 31) * 2654435761 + 42) % KEY_SPACE * self.buckets // KEY_SPACE

    # ------------------------------------------------------------ read and write
    def read(self, name: str, manifest: Manifest | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows of a table, of all buckets or of some."""
        table, manifest = self.tables[name], manifest or self.manifest()
        sets = manifest.sets.get(name, {})
        wanted = sets if buckets is None else [b for b in map(str, buckets) if b in sets]
        paths = [f"{self.path}/{name}/set={sets[b]}/bucket={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], table.schema)
        reader = self.spark.read.option("basePath", f"{self.path}/{name}").schema(table.schema)
        return reader.parquet(*paths).select(*table.schema.names)

    def touched(self, *keys: DataFrame) -> list[int]:
        """The buckets of some one-column frames of keys; there are no more than ``buckets``."""
        found = set()
        for frame in keys:
            found |= {r.b for r in frame.select(self.bucket_of(F.col(frame.columns[0])).alias("b")).distinct().collect()}
        return sorted(found)

    def update(
        self, touched: list[int], change: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], tags: dict[str, int] | None = None
    ) -> int:
        """Replace the ``touched`` buckets by ``change`` of their rows; returns the new version.

        ``change`` gets and returns the tables' rows in these buckets; tables it leaves out stay as they are.
        """
        written, based_on = None, None
        for _ in range(TRIES):
            base = self.manifest()
            held = {n: {str(b): base.sets.get(n, {}).get(str(b)) for b in touched} for n in self.tables}
            if written is None or held != based_on:
                written, based_on = self._write(touched, change({n: self.read(n, base, touched) for n in self.tables})), held
            sets = {n: dict(base.sets.get(n, {})) for n in self.tables}
            for name, new in written.items():
                for bucket in map(str, touched):
                    sets[name].pop(bucket, None)
                sets[name].update(new)
            version = base.version + 1
            text = json.dumps({"buckets": self.buckets, "sets": sets, "tags": {**base.tags, **(tags or {})}})
            if self._publish(f"{self.path}/manifests/{version}.json", text):
                return version
        raise RuntimeError(f"{self.path} changed {TRIES} times during an update")

    def _write(self, touched: list[int], new: dict[str, DataFrame]) -> dict[str, dict[str, str]]:
        done = {}
        for name, rows in new.items():
            table, made = self.tables[name], uuid.uuid4().hex
            place = f"{self.path}/{name}/set={made}"
            order = ["bucket", *table.folders, *table.order]
            placed = rows.select(*table.schema.names).withColumn("bucket", self.bucket_of(F.col(table.key)))
            placed.filter(F.col("bucket").isin(*touched)).repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(
                "bucket", *table.folders).parquet(place)
            done[name] = {n.removeprefix("bucket="): made for n in self._names(place) if n.startswith("bucket=")}
        return done

    def clear(self) -> None:
        """A version without rows."""
        for _ in range(TRIES):
            text = json.dumps({"buckets": self.buckets, "sets": {}, "tags": {}})
            if self._publish(f"{self.path}/manifests/{self.manifest().version + 1}.json", text):
                return
        raise RuntimeError(f"{self.path} changed {TRIES} times")
