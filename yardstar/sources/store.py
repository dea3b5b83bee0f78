"""Versioned tables: a load writes into its own folder and is published last.

A reader sees the tables of the newest published version only, so a load that
fails half-way leaves the earlier version in place. Publishing creates a
manifest entry whose number must not be there yet: of two loads that started
from one version the file system lets one through. An entry may name layers of
older versions, so a version shares the files it doesn't change.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST_DDL = (
    "version STRING, seq BIGINT, published_at STRING, tables ARRAY<STRING>, base STRING, "
    "layers ARRAY<STRUCT<tabela: STRING, versao: STRING, coluna: STRING, valores: ARRAY<BIGINT>, onde: STRING>>"
)

# Of partitioned tables, the facts. Others keep Spark's default: Spark takes the size of their files for their size in
# memory, and would broadcast dimensions of millions of rows.
COMPRESSION = "zstd"


class Layer(NamedTuple):
    """Partitions of a table that a version takes from the folder of one, its own or an older; all, if none are named."""

    tabela: str
    versao: str
    coluna: str | None = None  # a partition column
    valores: list[int] | None = None
    onde: str | None = None  # a SQL condition on partition columns


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this content; False, and nothing done, if it is there already."""
    if re.match(r"(file:)?/", path):
        local = re.sub(r"^file:/*", "/", path)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        new = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(new, "x") as out:
            out.write(text)
        try:
            os.link(new, local)  # whole, or not at all
        except FileExistsError:
            return False
        finally:
            os.remove(new)
        return True
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    try:
        stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._places: dict[str, tuple[str, list[Layer]]] = {}  # entries never change, so what was read stays true

    # -- versions ---------------------------------------------------------
    def manifest(self) -> DataFrame:
        """One row per published version."""
        try:
            return self.spark.read.schema(MANIFEST_DDL).json(f"{self.root}/manifest")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            return self.spark.createDataFrame([], MANIFEST_DDL)

    def _last(self):
        return self.manifest().orderBy(F.desc("seq"), F.desc("version")).limit(1).first()

    def current(self) -> str | None:
        last = self._last()
        return last["version"] if last else None

    def begin(self) -> str:
        """A fresh version name; nothing reads it until it is published."""
        return f"v-{uuid.uuid4().hex}"

    def publish(
        self,
        version: str,
        tables: Sequence[str],
        based_on: str | None = None,
        base: str | None = None,
        layers: Sequence[Layer] = (),
        aside: bool = False,
    ) -> None:
        """Make a version the newest one, if the one it started from still is.

        Two loads at once would hand out the same keys: the later one stops.
        Tables without layers are read from the folder of ``base``, by default
        the version's own. ``aside`` lets a version be read by its name without
        being the newest: one made from a version that no longer is.
        """
        last = self._last()
        if not aside and (last["version"] if last else None) != based_on:
            raise RuntimeError(f"{version} was based on {based_on}, but another load has been published since")
        entry = {
            "version": version,
            "seq": 0 if aside else (last["seq"] if last else 0) + 1,
            "published_at": datetime.now(timezone.utc).isoformat(),
            "tables": list(tables),
            "base": base or version,
            "layers": [layer._asdict() for layer in layers],
        }
        name = f"aside-{version}" if aside else f"{entry['seq']:012d}"
        if not create_once(self.spark, f"{self.root}/manifest/{name}.json", json.dumps(entry)):
            raise RuntimeError(f"{version} was based on {based_on}, but another load has just been published")

    def place(self, version: str) -> tuple[str, list[Layer]]:
        """The version in whose folder the tables of ``version`` are, and the layers of those that have some."""
        if version not in self._places:
            found = self.manifest().where(F.col("version") == version).first()
            if found is None:
                return version, []  # not published, so all its own
            layers = [Layer(*layer) for layer in found["layers"] or []]
            self._places[version] = (found["base"] or version, layers)
        return self._places[version]

    # -- journals ---------------------------------------------------------
    def entry(self, journal: str) -> dict | None:
        """The newest entry of a journal, with its number ``seq``."""
        try:
            lines = self.spark.read.text(f"{self.root}/journal/{journal}", wholetext=True)
            last = lines.orderBy(F.desc(F.input_file_name())).first()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            return None
        return None if last is None else json.loads(last[0])

    def commit(self, journal: str, entry: Mapping, after: Mapping | None) -> None:
        """Add an entry behind ``after``, the one it was made from; refused if another has come between."""
        seq = (after["seq"] if after else 0) + 1
        text = json.dumps({**entry, "seq": seq})
        if not create_once(self.spark, f"{self.root}/journal/{journal}/{seq:012d}.json", text):
            raise RuntimeError(f"{journal}: entry {seq} was made by another run meanwhile")

    # -- tables -----------------------------------------------------------
    def path(self, table: str, version: str) -> str:
        return f"{self.root}/{version}/{table}"

    def write(
        self,
        df: DataFrame,
        table: str,
        version: str,
        partition_by: Iterable[str] = (),
        replace_partitions: bool = False,
    ) -> DataFrame:
        """Overwrite a table (or only the partitions ``df`` has) and return it read back."""
        writer = df.write.mode("overwrite")
        keys = list(partition_by)
        if keys:
            writer = writer.option("compression", COMPRESSION).partitionBy(*keys)
        if replace_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        path = self.path(table, version)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, table: str, version: str | None = None, schema: StructType | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise LookupError(f"nothing is published under {self.root}")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        base, layers = self.place(version)
        mine = [layer for layer in layers if layer.tabela == table]
        if not mine:
            return reader.parquet(self.path(table, base))
        # Filters on the partition column: files of other partitions aren't read.
        return reduce(DataFrame.unionByName, (self._layer(reader.parquet(self.path(table, x.versao)), x) for x in mine))

    @staticmethod
    def _layer(df: DataFrame, layer: Layer) -> DataFrame:
        if layer.coluna:
            df = df.where(F.col(layer.coluna).isin(list(layer.valores)))
        return df.where(layer.onde) if layer.onde else df
