"""The rental roles of one data folder, loaded once per application.

Line items are joined to their orders once and the warehouse is loaded once,
both into the shared folder; queries read those tables. The dimensions are
loaded before, and without, line items and facts: what needs no more than them
reads ``dimensions`` and ``members``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from yardstar.config import LoadConfig
from yardstar.operators.conform import conform
from yardstar.plans.pipeline import Begun, Warehouse, load_dimensions, load_facts
from yardstar.session import configure, shared_dir
from yardstar.sources.extract import complete_staging, extract_all
from yardstar.sources.rental_roles import RentalRoles
from yardstar.sources.store import COMPRESSION, Store

# Parameters of the sample loads: the data is dated 1995 to 2001.
AS_OF = date(2000, 6, 30)
CONFIG = LoadConfig(
    as_of=AS_OF,
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2005, 12, 31),
    batch_ts=datetime(2000, 6, 30, 6),
    stage=False,
    partition_grain="year",
)

_beds: dict[tuple[str, str], Testbed] = {}


class Testbed:
    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
        self.root = f"{shared_dir(spark)}/yardstar/{spark.sparkContext.applicationId}/{tag}"

    @cached_property
    def rentals(self) -> DataFrame:
        """Line items with order, client and yards, by source."""
        base = RentalRoles(self.spark, self.sf_dir).rental_base()
        path = f"{self.root}/rentals"
        base.write.mode("overwrite").option("compression", COMPRESSION).partitionBy("source").parquet(path)
        return self.spark.read.schema(base.schema).parquet(path)

    @cached_property
    def roles(self) -> RentalRoles:
        return RentalRoles(self.spark, self.sf_dir, self.rentals)

    @cached_property
    def staging(self) -> Mapping[str, DataFrame]:
        return complete_staging(self.spark, extract_all(self.roles.sources(), CONFIG))

    @cached_property
    def conformed(self) -> Mapping[str, DataFrame]:
        return conform(self.staging)

    @cached_property
    def whole_roles(self) -> RentalRoles:
        """Each source with all rows: the rules of one source over the whole tables."""
        return RentalRoles(self.spark, self.sf_dir, self.rentals, whole=True)

    @cached_property
    def whole_staging(self) -> Mapping[str, DataFrame]:
        return extract_all(self.whole_roles.sources(), CONFIG)

    @cached_property
    def whole_conformed(self) -> Mapping[str, DataFrame]:
        return conform(self.whole_staging)

    @cached_property
    def members(self) -> Mapping[str, DataFrame]:
        """Conformed staging for all but rentals, which aren't landed for it: its rental tables join line items themselves."""
        sources = RentalRoles(self.spark, self.sf_dir).sources()
        return conform(complete_staging(self.spark, extract_all(sources, CONFIG)))

    @cached_property
    def _begun(self) -> Begun:
        return load_dimensions(self.members, Store(self.spark, f"{self.root}/dw"), CONFIG)

    @property
    def dimensions(self) -> Warehouse:
        """The warehouse with its dimensions and key maps; its facts may not be there yet."""
        return self._begun.warehouse

    @cached_property
    def warehouse(self) -> Warehouse:
        return load_facts(self.conformed, self._begun)

    def scratch(self, name: str) -> str:
        """A new folder for one query's intermediate table."""
        return f"{self.root}/scratch/{name}-{uuid.uuid4().hex}"


def testbed(spark: SparkSession, sf_dir: str) -> Testbed:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _beds:
        _beds[key] = Testbed(spark, sf_dir.rstrip("/"))
    return _beds[key]
