"""The load: staging, conforming, keys, dimensions, facts, snapshot, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardstar.config import LoadConfig
from yardstar.operators import dims as D
from yardstar.operators import facts
from yardstar.operators.conform import conform
from yardstar.operators.keys import assign_keys
from yardstar.operators.snapshot import snapshot_rows
from yardstar.schemas import STAR_DDL, conform_to, star_schema
from yardstar.sources.extract import complete_staging, extract_all
from yardstar.sources.readers import Source
from yardstar.sources.store import Layer, Store

DIMENSIONS = tuple(D.NATURAL_KEYS)
FACTS = ("fato_locacao", "fato_reserva", "fato_patio_snapshot")
# The fact's own key, its original id and the date that partitions it.
FACT_KEYS = {"fato_locacao": "sk_locacao", "fato_reserva": "sk_reserva", "fato_patio_snapshot": "sk_snapshot"}
FACT_IDS = {"fato_locacao": "id_locacao_orig", "fato_reserva": "id_reserva_orig"}
# Values of the partition column ``carga``.
ACCEPTED, REJECTED = "aceita", "rejeitada"


def stored_schema(table: str) -> T.StructType:
    """A star table as written: its declared columns and the load's own."""
    schema = star_schema(table)
    if table in FACT_IDS:
        schema = schema.add("motivos", T.ArrayType(T.StringType()))
        schema = schema.add("pendente", T.StructType.fromDDL(facts.ROW_DDL[table]))
    if table in FACT_KEYS:
        schema = schema.add(FACT_KEYS[table], T.LongType())
    schema = schema.add("dt_carga", T.TimestampNTZType())
    if table in FACT_IDS:
        schema = schema.add("carga", T.StringType()).add("periodo_retirada", T.DateType())
    return schema


class Warehouse(Mapping):
    """The star tables of one published version, by name."""

    def __init__(self, store: Store, version: str):
        self.store = store
        self.version = version

    @classmethod
    def current(cls, store: Store) -> Warehouse:
        version = store.current()
        if version is None:
            raise LookupError(f"nothing is published under {store.root}")
        return cls(store, version)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in STAR_DDL:
            raise KeyError(table)
        df = self.store.read(table, self.version, stored_schema(table))
        if table in FACT_IDS:
            # A partition filter: reject files are not read.
            df = df.where(F.col("carga") == ACCEPTED).drop("carga", "motivos", "pendente")
        return df

    def __iter__(self):
        return iter(STAR_DDL)

    def __len__(self):
        return len(STAR_DDL)

    def rejects(self, table: str) -> DataFrame:
        """Rows the load left out of a fact, with the reasons."""
        df = self.store.read(table, self.version, stored_schema(table)).where(F.col("carga") == REJECTED)
        return df.select("fonte_grupo", FACT_IDS[table], "motivos")

    def pending(self, table: str) -> DataFrame:
        """The rejected rows as they were before their keys were looked up."""
        df = self.store.read(table, self.version, stored_schema(table))
        return df.where((F.col("carga") == REJECTED) & F.col("pendente").isNotNull()).select("pendente.*")

    def key_map(self, table: str) -> DataFrame:
        return self.store.read(f"chave_{table}", self.version)


def dimension_rows(
    spark: SparkSession, conformed: Mapping[str, DataFrame], cfg: LoadConfig
) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Unkeyed rows of each dimension; vehicles need the finished groups and companies."""
    return {
        "dim_tempo": lambda done: D.date_rows(D.date_bounds(spark, cfg.calendar_start, cfg.calendar_end)),
        "dim_empresa": lambda done: D.company_rows(conformed),
        "dim_patio": lambda done: D.yard_rows(conformed),
        "dim_grupo_veiculo": lambda done: D.group_rows(conformed),
        "dim_cliente": lambda done: D.client_rows(conformed),
        "dim_veiculo": lambda done: D.vehicle_rows(
            conformed, done["dim_grupo_veiculo"], done["dim_empresa"]
        ),
    }


def _load_dimension(
    rows: DataFrame,
    table: str,
    store: Store,
    version: str,
    previous: str | None,
    cfg: LoadConfig,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Write a dimension; members of ``carried`` that ``rows`` doesn't have are kept."""
    keys = D.NATURAL_KEYS[table]
    known = store.read(f"chave_{table}", previous) if previous else None
    key_map = assign_keys(rows, keys, store.path(f"chave_{table}_ordem", version), known)
    key_map = store.write(key_map, f"chave_{table}", version)
    dim = D.keyed(rows, key_map, table)
    if carried is not None:
        kept = carried.join(dim.select(D.SURROGATE[table]), D.SURROGATE[table], "left_anti")
        dim = dim.unionByName(conform_to(kept, star_schema(table)))
        if table == "dim_empresa":
            dim = conform_to(D.number_companies(dim), star_schema(table))
    dim = dim.withColumn("dt_carga", cfg.batch_column)
    return store.write(dim, table, version)


def _store_fact(
    resolved: DataFrame, table: str, store: Store, version: str, cfg: LoadConfig, start: int = 0
) -> DataFrame:
    """Accepted and rejected rows in one pass, in separate partitions; rejected ones keep all that resolving them takes.

    ``rebalance`` sizes the files and splits a period that holds a large share
    of all rows over several tasks.
    """
    before = F.struct(*T.StructType.fromDDL(facts.ROW_DDL[table]).names)
    laid = resolved.withColumns(
        {
            "carga": F.when(F.size("motivos") == 0, ACCEPTED).otherwise(REJECTED),
            "pendente": F.when(F.size("motivos") > 0, before),
            "periodo_retirada": F.trunc("data_retirada", cfg.partition_grain),
        }
    )
    own = (FACT_KEYS[table], "dt_carga")
    declared = T.StructType([f for f in stored_schema(table).fields if f.name not in own])
    laid = conform_to(laid, declared).hint("rebalance", "carga", "periodo_retirada")
    # Unique within the load; nothing refers to a fact's key, so it need not be dense.
    keyed = laid.withColumns({own[0]: F.lit(start) + F.monotonically_increasing_id() + 1, own[1]: cfg.batch_column})
    return store.write(keyed, table, version, ("carga", "periodo_retirada"))


def _number_snapshot(rows: DataFrame, start: int, cfg: LoadConfig) -> DataFrame:
    key = F.lit(start) + F.monotonically_increasing_id() + 1
    return rows.withColumn("sk_snapshot", key).withColumn("dt_carga", cfg.batch_column)


def _together(tasks: Mapping[str, Callable[[], DataFrame]], width: int = 8) -> dict[str, DataFrame]:
    """Submit independent table writes side by side; any failure stops the load."""
    with ThreadPoolExecutor(width) as pool:
        running = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: r.result() for name, r in running.items()}


class Begun(NamedTuple):
    """A load whose dimensions are written; it has no facts yet and nobody else sees it."""

    warehouse: Warehouse
    previous: str | None
    cfg: LoadConfig


def load_dimensions(
    conformed: Mapping[str, DataFrame], store: Store, cfg: LoadConfig, version: str | None = None
) -> Begun:
    """Write the dimensions of a new version with their key maps; ``load_facts`` completes and publishes it."""
    previous, version = store.current(), version or store.begin()
    rows = dimension_rows(store.spark, conformed, cfg)

    def dimension(table: str, done: Mapping[str, DataFrame]) -> DataFrame:
        return _load_dimension(rows[table](done), table, store, version, previous, cfg)

    done = _together({t: (lambda t=t: dimension(t, {})) for t in DIMENSIONS if t != "dim_veiculo"})
    dimension("dim_veiculo", done)
    return Begun(Warehouse(store, version), previous, cfg)


def load_facts(conformed: Mapping[str, DataFrame], begun: Begun) -> Warehouse:
    """Write the facts of a version whose dimensions are there, and publish it."""
    done, previous, cfg = begun
    store, version = done.store, done.version

    def reservations() -> DataFrame:
        resolved = facts.resolve_reservations(facts.reservation_rows(conformed), done)
        return _store_fact(resolved, "fato_reserva", store, version, cfg)

    def rentals() -> DataFrame:
        resolved = facts.resolve_rentals(facts.rental_rows(conformed, done["dim_cliente"]), done)
        return _store_fact(resolved, "fato_locacao", store, version, cfg)

    def snapshot() -> DataFrame:
        numbered = _number_snapshot(snapshot_rows(conformed, done, cfg.as_of_column), 0, cfg)
        return store.write(numbered, "fato_patio_snapshot", version, ("sk_tempo",))

    _together({"fato_locacao": rentals, "fato_reserva": reservations, "fato_patio_snapshot": snapshot})
    store.publish(version, [*DIMENSIONS, *FACTS], previous)
    return done


def load(staging: Mapping[str, DataFrame], store: Store, cfg: LoadConfig | None = None) -> Warehouse:
    """Load a new version from staging frames and publish it."""
    cfg = cfg or LoadConfig()
    version = store.begin()
    staged = complete_staging(store.spark, staging)
    if cfg.stage:
        staged |= _together({t: (lambda t=t: store.write(staged[t], f"staging/{t}", version)) for t in staging})
    conformed = conform(staged)
    return load_facts(conformed, load_dimensions(conformed, store, cfg, version))


def run(sources: Mapping[str, Source], store: Store, cfg: LoadConfig | None = None) -> Warehouse:
    """Extract the given sources, then load."""
    return load(extract_all(sources, cfg), store, cfg)


def _snapshot_layers(warehouse: Warehouse) -> list[Layer]:
    """Where the days of a version's snapshot are."""
    table = "fato_patio_snapshot"
    base, layers = warehouse.store.place(warehouse.version)
    mine = [x for x in layers if x.tabela == table]
    if mine:
        return mine
    days = [r[0] for r in warehouse[table].select("sk_tempo").distinct().collect()]  # partition values: a day each
    return [Layer(table, base, "sk_tempo", days)] if days else []


def _accepted_layers(warehouse: Warehouse, table: str) -> list[Layer]:
    """Where the accepted rows of a version's fact are; its rejects belong to it alone."""
    store = warehouse.store
    base, layers = store.place(warehouse.version)
    only = f"carga = '{ACCEPTED}'"
    out = []
    for x in [x for x in layers if x.tabela == table] or [Layer(table, base)]:
        # The newest layer is the one whose rejects still count; without accepted rows nothing of it is left.
        stored = store.spark.read.schema(stored_schema(table)).parquet(store.path(table, x.versao))
        if x.onde == only or not stored.where(only).isEmpty():
            out.append(x._replace(onde=only))
    return out


def _unsettled(staged: DataFrame, warehouse: Warehouse, table: str, version: str) -> DataFrame:
    """Rows to look up: staged ones that the fact doesn't have, and the rejects whose place none of these takes.

    As in a whole load, staged rows that share a key all count. Rows without an
    id can't be told from each other: equal ones count once.
    """
    schema, store = T.StructType.fromDDL(facts.ROW_DDL[table]), warehouse.store
    keys = ["fonte_grupo", FACT_IDS[table]]
    named = F.col(keys[1]).isNotNull()
    staged = store.write(conform_to(staged, schema), f"lote_{table}", version)
    waiting = conform_to(warehouse.pending(table), schema)
    # The batch is the small side: only its keys are looked for in the fact.
    settled = warehouse[table].select(*keys).join(staged.select(*keys), keys, "left_semi").distinct()
    new = staged.where(named).join(settled, keys, "left_anti")
    kept = waiting.where(named).join(new.select(*keys), keys, "left_anti")
    nameless = staged.unionByName(waiting).where(~named).distinct()
    return new.unionByName(kept).unionByName(nameless)


def increment(staging: Mapping[str, DataFrame], warehouse: Warehouse, cfg: LoadConfig | None = None) -> Warehouse:
    """Add a batch to a loaded warehouse, as a new version, and settle the rejects that it completes.

    The batch's members replace or join those of the dimensions. Its fact rows
    and the rejects of the version before are looked up anew: those that find
    all their keys move into the fact, the others are the new version's
    rejects. A row is known by source and id. A staged row takes the place of
    its rejects; one that the fact has already is left as it is, so a batch that
    comes again changes nothing and changed fact rows need a whole load. Rows without an id stay rejects, with the reason
    ``ID``. A G1 or G3 rental whose reservation comes late must be staged again
    with it, since its client stands in the reservation.

    Accepted rows of earlier versions are shared, not copied. Each increment
    with accepted rows adds a layer to the fact; a whole load makes it one again.
    """
    cfg = cfg or LoadConfig()
    store, previous = warehouse.store, warehouse.version
    spark, version = store.spark, store.begin()
    conformed = conform(complete_staging(spark, staging))
    rows = dimension_rows(spark, conformed, cfg)

    def dimension(table: str, done: Mapping[str, DataFrame]) -> DataFrame:
        return _load_dimension(rows[table](done), table, store, version, previous, cfg, warehouse[table])

    def fact(table: str, staged: DataFrame, resolve: Callable, done: Mapping[str, DataFrame]) -> DataFrame:
        resolved = resolve(_unsettled(staged, warehouse, table, version), done)
        nameless = F.when(F.col(FACT_IDS[table]).isNull(), F.array(F.lit("ID"))).otherwise(F.array().cast("array<string>"))
        resolved = resolved.withColumn("motivos", F.concat("motivos", nameless))
        last = warehouse[table].agg(F.max(FACT_KEYS[table])).first()[0] or 0
        return _store_fact(resolved, table, store, version, cfg, last)

    done = _together({t: (lambda t=t: dimension(t, {})) for t in DIMENSIONS if t != "dim_veiculo"})
    reservations, rentals = facts.reservation_rows(conformed), facts.rental_rows(conformed)
    wave = _together(
        {
            "dim_veiculo": lambda: dimension("dim_veiculo", done),
            "fato_reserva": lambda: fact("fato_reserva", reservations, facts.resolve_reservations, done),
        }
    )
    done = {**done, "dim_veiculo": wave["dim_veiculo"]}
    fact("fato_locacao", rentals, facts.resolve_rentals, done)
    layers = _snapshot_layers(warehouse)
    for table in FACT_IDS:
        layers += [*_accepted_layers(warehouse, table), Layer(table, version)]
    store.publish(version, [*DIMENSIONS, *FACTS], previous, version, layers)
    return Warehouse(store, version)


def daily_snapshot(
    staging: Mapping[str, DataFrame], warehouse: Warehouse, cfg: LoadConfig
) -> DataFrame:
    """Add (or redo) the snapshot of one day, as a version of its own; ``warehouse`` then stands at it.

    The new version shares every file but that day's with the one before, which
    stays as it is for whoever reads it. A snapshot that dies half-way is never
    published; a day outside the calendar publishes nothing. If another load is
    published meanwhile, this one is refused; on a warehouse that was not the
    newest to begin with, the new version is read through ``warehouse`` alone.
    """
    store, previous, table = warehouse.store, warehouse.version, "fato_patio_snapshot"
    aside = store.current() != previous
    conformed = conform(complete_staging(store.spark, staging))
    before = warehouse[table]
    last = before.agg(F.max("sk_snapshot")).first()[0] or 0
    version = store.begin()
    rows = _number_snapshot(snapshot_rows(conformed, warehouse, cfg.as_of_column), last, cfg)
    written = store.write(rows, table, version, ("sk_tempo",))
    days = [r[0] for r in written.select("sk_tempo").distinct().collect()]  # one day, or none
    if not days:
        return written
    base, layers = store.place(previous)
    kept = _snapshot_layers(warehouse)
    kept = [x._replace(valores=[d for d in x.valores if d not in days]) for x in kept]
    others = [x for x in layers if x.tabela != table]
    new = [*others, *(x for x in kept if x.valores), Layer(table, version, "sk_tempo", days)]
    store.publish(version, [*DIMENSIONS, *FACTS], previous, base, new, aside)
    warehouse.version = version
    return written
