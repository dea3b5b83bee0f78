"""Fixed values of the data model and the load parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source tags, literal names and codes the results must carry.
SOURCES = ("G1", "G2", "G3", "G4")
G2_COMPANY = "EMPRESA_G2"
CITY_UNKNOWN = "NAO_INFORMADO"
AUTOMATIC = "AUTOMATICA"
MANUAL = "MANUAL"
AUTOMATIC_SPELLINGS = ("AUTOMATICO", "AUTOMÁTICO", "AUTO", "AUTOMATICA", "AUTOMÁTICA")
DONE = "CONCLUIDA"
ACTIVE = "EM_ANDAMENTO"
CANCELLED = "CANCELADA"
CONFIRMED = "CONFIRMADA"
UNKNOWN = "DESCONHECIDO"
OWN = "PROPRIA"
FOREIGN = "EXTERNA"
G1_AVAILABLE = "Disponível"
G2_AVAILABLE = "DISPONIVEL"
G3_RESERVATION_CODES = {0: ACTIVE, 1: CANCELLED, 2: CONFIRMED}
LUXURY_LETTERS = {"A": "BASICO", "B": "INTERMEDIARIO", "C": "LUXO"}
ROW_SUM_OK = "OK ✓"
ROW_SUM_BAD = "ERRO — linha não soma 1"

CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)


@dataclass(frozen=True)
class LoadConfig:
    """Parameters of one load. ``as_of`` None means the current date."""

    as_of: date | None = None
    calendar_start: date = CALENDAR_START
    calendar_end: date = CALENDAR_END
    batch_ts: datetime | None = None
    stage: bool = True
    partition_grain: str = "month"  # facts are partitioned by pickup "month" or "year"

    @property
    def as_of_column(self) -> Column:
        return as_of_column(self.as_of)

    @property
    def batch_column(self) -> Column:
        return batch_column(self.batch_ts)


def as_of_column(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def batch_column(batch_ts: datetime | None) -> Column:
    ts = F.current_timestamp() if batch_ts is None else F.lit(batch_ts.isoformat(sep=" "))
    return ts.cast("timestamp_ntz")
