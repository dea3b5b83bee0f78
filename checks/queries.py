"""One query per operator, over the rental roles of a data folder.

Keys, dimensions, facts, snapshot and audits run from staging, and look keys up
in the loaded dimensions; reports and the forecast read the facts of the loaded
warehouse. Rules that only one source has
run over all clients, orders and line items (the ``whole`` frames); whatever
spans the sources covers every row once, in the source it belongs to.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstar.functions import columns as X
from yardstar.functions.lookups import lookup
from yardstar.operators import audits as Q
from yardstar.operators import dims as D
from yardstar.operators import facts
from yardstar.operators.availability import fleet_availability as availability
from yardstar.operators.availability import waiting_queue as serve_queue
from yardstar.operators.inventory import yard_inventory as inventory
from yardstar.operators.keys import assign_keys
from yardstar.operators.rules import CATALOG
from yardstar.operators.snapshot import snapshot_rows
from yardstar.plans import chain_classes as K
from yardstar.plans import markov as M
from yardstar.plans import reports as R
from yardstar.plans import source_views as V
from yardstar.plans.pipeline import increment, load
from yardstar.schemas import STAGING_DDL, STAR_DDL, conform_to, star_schema
from yardstar.sources.golden import expand_quantities
from yardstar.sources.incremental import StagingTable, Tracked
from yardstar.sources.store import Store
from yardstar.sources.testbed import AS_OF, CONFIG, Testbed, testbed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(testbed(spark, sf_dir))
    return f


def _tagged(df: DataFrame, tag: str, *cols) -> DataFrame:
    return df.select(F.lit(tag).alias("fonte_grupo"), *cols)


def _union(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first


def _plain(df: DataFrame, table: str) -> DataFrame:
    """The declared columns only, without load time and fact key."""
    return conform_to(df, star_schema(table))


# -- extraction ---------------------------------------------------------------
@query
def staging_row_counts(bed):
    return _union(
        *(bed.staging[t].agg(F.count("*").alias("linhas")).select(F.lit(t).alias("tabela"), "linhas") for t in STAGING_DDL)
    )


@query
def incremental_extract(bed):
    """The orders after two extracts: the first sees the early ones and some that are withdrawn later, the second what has changed."""
    orders = bed.roles.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    early = orders.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    withdrawn = early.where("o_orderkey % 97 = 0").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    tracked = Tracked("orders", ("o_orderkey",), "o_orderdate", "INTERVAL 1 DAY")
    staged = StagingTable(Store(bed.spark, bed.scratch("extract")), tracked, orders.schema)
    staged.extract(early.unionByName(withdrawn))
    staged.extract(orders, find_deleted=True)
    return staged.current()


@query
def subclass_flatten(bed):
    return bed.whole_staging["g2_cliente"].select(
        "id_cliente", "tipo_pessoa", "nome", "cidade_origem", "cpf", "data_nascimento", "cnpj"
    )


@query
def denormalize_yards(bed):
    s = bed.staging
    return _union(
        _tagged(s["g3_patio"], "G3", "id_patio", F.col("nome_patio").alias("nome"), F.col("nome_empresa").alias("empresa"), "cidade", "uf"),
        _tagged(s["g4_patio"], "G4", "id_patio", F.col("cd_patio").alias("nome"), F.col("nome_parceira").alias("empresa"), "cidade", "uf"),
    )


@query
def denormalize_clients(bed):
    s = bed.whole_staging
    return _union(
        _tagged(s["g3_cliente"], "G3", F.col("id_cliente").alias("id"), F.col("nome_completo").alias("nome"), "cpf", "cidade", "uf"),
        _tagged(s["g4_motorista"], "G4", F.col("id_motorista").alias("id"), "nome", "cpf", "cidade", "uf"),
    )


# -- conforming ---------------------------------------------------------------
@query
def conform_transmission(bed):
    c = bed.conformed
    return _union(
        _tagged(c["g1_veiculo"], "G1", "id_veiculo", "mecanizacao"),
        _tagged(c["g2_veiculo"], "G2", "id_veiculo", "mecanizacao"),
        _tagged(c["g3_veiculo"], "G3", "id_veiculo", F.col("mecanizacao_conf").alias("mecanizacao")),
    )


@query
def conform_text(bed):
    c = bed.whole_conformed
    texts = [
        ("g1_patio", "id_patio", "nome_localizacao"),
        ("g1_reserva", "id_reserva", "status_reserva"),
        ("g2_patio", "id_patio", "nome"),
        ("g2_grupo", "id_grupo", "classe_luxo"),
        ("g2_cliente", "id_cliente", "cidade_origem"),
        ("g2_locacao", "id_locacao", "status"),
        ("g3_patio", "id_patio", "cidade"),
        ("g3_patio", "id_patio", "uf"),
        ("g3_cliente", "id_cliente", "cidade"),
        ("g3_cliente", "id_cliente", "uf"),
        ("g4_patio", "id_patio", "cidade"),
        ("g4_patio", "id_patio", "uf"),
        ("g4_motorista", "id_motorista", "cidade"),
        ("g4_motorista", "id_motorista", "uf"),
    ]
    return _union(
        *(
            c[t].select(F.lit(f"{t}.{v}").alias("coluna"), F.col(k).alias("id"), F.col(v).alias("valor"))
            for t, k, v in texts
        )
    )


@query
def infer_status(bed):
    c = bed.whole_conformed
    return _union(
        *(
            _tagged(c[f"{g.lower()}_locacao"], g, "id_locacao", F.col("status_conformado").alias("status"))
            for g in ("G1", "G3", "G4")
        )
    )


@query
def rental_duration(bed):
    c = bed.conformed
    none = F.lit(None).cast("int").alias("duracao_dias_prevista")
    return _union(
        _tagged(c["g1_locacao"], "G1", "id_locacao", "duracao_dias_real", "duracao_dias_prevista"),
        _tagged(c["g2_locacao"], "G2", "id_locacao", "duracao_dias_real", none),
        _tagged(c["g3_locacao"], "G3", "id_locacao", "duracao_dias_real", none),
        _tagged(c["g4_locacao"], "G4", "id_locacao", "duracao_dias_real", none),
    )


@query
def update_from_lookup(bed):
    return bed.whole_conformed["g2_locacao"].select("id_locacao", "reserva_id", "duracao_dias_prevista")


@query
def km_driven(bed):
    return bed.whole_conformed["g2_locacao"].select("id_locacao", "km_saida", "km_chegada", "km_percorridos")


@query
def conform_status_code(bed):
    return bed.whole_conformed["g3_reserva"].select(
        "id_reserva", "estado_reserva", "status_conformado", "duracao_prevista_dias"
    )


@query
def resolve_return_yard(bed):
    return bed.whole_conformed["g3_locacao"].select("id_locacao", "id_patio", "id_patio_entrega")


@query
def resolve_return_date(bed):
    return bed.whole_conformed["g3_locacao"].select("id_locacao", "data_locacao", "data_devolucao")


@query
def slot_to_yard(bed):
    return bed.whole_conformed["g4_locacao"].select(
        "id_locacao", "id_vaga_retirada", "id_patio_retirada", "id_vaga_devolvida", "id_patio_entrega"
    )


@query
def conform_luxury_class(bed):
    return bed.conformed["g4_categoria"].select("id_categoria", "classe_luxo", "classe_luxo_conf")


# -- keys and dimensions ------------------------------------------------------
def _reservation_keys(bed) -> DataFrame:
    return bed.roles.table("orders").select(
        F.concat(F.lit("G"), (1 + F.col("o_custkey") % 4).cast("string")).alias("fonte_grupo"),
        F.col("o_orderkey").alias("id"),
    )


@query
def surrogate_keys(bed):
    return assign_keys(_reservation_keys(bed), ["fonte_grupo", "id"], bed.scratch("keys"))


@query
def surrogate_keys_reload(bed):
    """Sources G3 and G4 were loaded before; G1 and G2 continue after them."""
    keys = _reservation_keys(bed)
    first = assign_keys(keys.where("fonte_grupo IN ('G3', 'G4')"), ["fonte_grupo", "id"], bed.scratch("keys"))
    return assign_keys(keys, ["fonte_grupo", "id"], bed.scratch("keys"), known=first)


@query
def dim_date(bed):
    """The calendar of the years the rentals and orders fall in, and the one after."""
    days = _union(
        bed.roles.table("lineitem").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b")),
        bed.roles.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")),
    ).agg(F.min("a").cast("date").alias("a"), F.max("b").cast("date").alias("b"))
    bounds = days.select(
        F.trunc("a", "year").alias("inicio"),
        F.date_sub(F.add_months(F.trunc("b", "year"), 24), 1).alias("fim"),
    )
    rows = D.date_rows(bounds)
    keys = assign_keys(rows, ["data_completa"], bed.scratch("keys"))
    return D.keyed(rows, keys, "dim_tempo")


def _dimension(bed, table: str, rows: DataFrame) -> DataFrame:
    return D.keyed(rows, bed.dimensions.key_map(table), table)


@query
def dim_company(bed):
    return _dimension(bed, "dim_empresa", D.company_rows(bed.members))


@query
def dim_yard(bed):
    return _dimension(bed, "dim_patio", D.yard_rows(bed.members))


@query
def dim_vehicle_group(bed):
    return _dimension(bed, "dim_grupo_veiculo", D.group_rows(bed.members))


@query
def dim_vehicle(bed):
    w = bed.dimensions
    return _dimension(bed, "dim_veiculo", D.vehicle_rows(bed.members, w["dim_grupo_veiculo"], w["dim_empresa"]))


@query
def dim_client(bed):
    return _dimension(bed, "dim_cliente", D.client_rows(bed.members))


# -- facts --------------------------------------------------------------------
def _rentals(bed) -> DataFrame:
    return facts.resolve_rentals(facts.rental_rows(bed.conformed, bed.dimensions["dim_cliente"]), bed.dimensions)


def _reservations(bed) -> DataFrame:
    return facts.resolve_reservations(facts.reservation_rows(bed.members), bed.dimensions)


@query
def fact_rental(bed):
    return facts.accepted(_rentals(bed), "fato_locacao")


@query
def fact_reservation(bed):
    return facts.accepted(_reservations(bed), "fato_reserva")


@query
def intercompany_flag(bed):
    return facts.rental_rows(bed.conformed).select(
        "fonte_grupo", "id_locacao_orig", "id_patio_retirada", "id_patio_entrega", "locacao_intercompanhia"
    )


@query
def yard_snapshot(bed):
    return snapshot_rows(bed.members, bed.dimensions, F.lit(AS_OF).cast("date"))


@query
def own_or_foreign(bed):
    """Vehicles with a company (a seventh have none) at their home yards."""
    parts = bed.roles.table("part").select(
        "p_partkey",
        (F.col("p_partkey") % 25).alias("patio"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_partkey") % 5).alias("empresa"),
    )
    df = lookup(parts, bed.roles.places, {"patio": "n_nationkey"}, {"r_name": "dono"}, "inner")
    df = lookup(
        df, bed.roles.table("region"), {"empresa": "r_regionkey"}, {"r_name": "nome_empresa"}, spread_nulls_by=["p_partkey"]
    )
    return df.select(
        F.col("p_partkey").alias("id_veiculo"),
        "dono",
        "nome_empresa",
        X.own_or_foreign("dono", "nome_empresa").alias("origem_veiculo"),
    )


@query
def loaded_row_counts(bed):
    """Facts plus rejects are the staged rows."""
    w = bed.warehouse
    parts = [w[t].agg(F.count("*").alias("linhas")).select(F.lit(t).alias("tabela"), "linhas") for t in STAR_DDL if t != "dim_tempo"]
    parts += [
        w.rejects(t).agg(F.count("*").alias("linhas")).select(F.lit(f"{t}:rejeitos").alias("tabela"), "linhas")
        for t in ("fato_locacao", "fato_reserva")
    ]
    return _union(*parts)


@query
def settled_rejects(bed):
    """Rentals after a load that lacks a third of the clients and an increment that brings them."""
    clients = {"g1_cliente": "id_cliente", "g2_cliente": "id_cliente", "g3_cliente": "id_cliente", "g4_motorista": "id_motorista"}
    late = {t: F.col(c) % 3 == 0 for t, c in clients.items()}
    first = {t: df.where(~late[t]) if t in late else df for t, df in bed.staging.items()}
    w = load(first, Store(bed.spark, bed.scratch("late-clients")), CONFIG)
    w = increment({t: bed.staging[t].where(c) for t, c in late.items()}, w, CONFIG)
    rentals = lookup(w["fato_locacao"], w["dim_cliente"], {"sk_cliente": "sk_cliente"}, {"id_cliente_orig": "id_cliente_orig"})
    return rentals.select("fonte_grupo", "id_locacao_orig", "id_cliente_orig", "duracao_dias_real", "valor_total", "status_locacao")


# -- fleet ------------------------------------------------------------------------
@query
def fleet_availability(bed):
    """Free vehicles of each group on each day of the half year from the load's day on."""
    held = facts.reservation_rows(bed.conformed).where(F.col("status_reserva").isin("CONFIRMADA", "EM_ANDAMENTO"))
    held = held.select("fonte_grupo", "id_grupo", F.col("data_retirada").alias("retirada"), F.col("data_devolucao").alias("devolucao"))
    s = bed.staging
    fleet = _union(
        _tagged(s["g1_veiculo"], "G1", "id_grupo"),
        _tagged(s["g2_veiculo"], "G2", F.col("grupo_id").alias("id_grupo")),
        _tagged(s["g3_veiculo"], "G3", "id_grupo"),
    )
    fleet = fleet.groupBy("fonte_grupo", "id_grupo").agg(F.count("*").alias("frota"))
    return availability(held, fleet, F.lit(AS_OF), F.lit(AS_OF + timedelta(days=183)))


@query
def waiting_queue(bed):
    """Waiting reservations of all orders, by group and yard, served with the available vehicles there."""
    s = bed.whole_conformed
    queued = s["g2_reserva"].where("estado = 'EM_FILA_ESPERA'").select(
        "grupo_id",
        F.col("patio_retirada_id").alias("patio_id"),
        "id_reserva",
        F.col("data_reserva").alias("pedido"),
        F.col("data_retirada_prevista").alias("retirada"),
        F.col("data_devolucao_prevista").alias("devolucao"),
    )
    slots = s["g2_veiculo"].where("situacao = 'DISPONIVEL'").groupBy("grupo_id", F.col("patio_origem_id").alias("patio_id"))
    return serve_queue(queued, slots.agg(F.count("*").alias("vagas")), ["grupo_id", "patio_id"], "id_reserva")


@query
def yard_inventory(bed):
    """Vehicles of G3 and G4 in each yard at the end of each quarter."""
    quarters = [date(y, m, 1) - timedelta(days=1) for y in range(1996, 2003) for m in (1, 4, 7, 10)]
    s = bed.staging
    yards = _union(_tagged(s["g3_patio"], "G3", "id_patio"), _tagged(s["g4_patio"], "G4", "id_patio"))
    return inventory(bed.conformed, yards, quarters)


# -- reports ------------------------------------------------------------------
@query
def report_a_yard_control(bed):
    return R.report_a_yard_control(bed.warehouse)


@query
def report_a_latest(bed):
    return R.report_a_latest(bed.warehouse)


@query
def report_b_rental_control(bed):
    return R.report_b_rental_control(bed.warehouse, AS_OF)


@query
def report_b_monthly(bed):
    return R.report_b_monthly(bed.warehouse)


@query
def report_c_reservations(bed):
    return R.report_c_reservations(bed.warehouse)


@query
def report_c_next_week(bed):
    return R.report_c_next_week(bed.warehouse, AS_OF)


@query
def report_d_group_by_city(bed):
    return R.report_d_group_by_city(bed.warehouse)


@query
def report_d_top10(bed):
    return R.report_d_top10(bed.warehouse)


@query
def report_d_group_ranking(bed):
    return R.report_d_group_ranking(bed.warehouse)


@query
def rental_count(bed):
    return R.rental_count(bed.warehouse)


@query
def clients_of_source(bed):
    return _plain(R.clients_of_source(bed.warehouse, "G1"), "dim_cliente")


# -- forecast -----------------------------------------------------------------
def _matrix(bed) -> DataFrame:
    return M.transition_matrix(M.transition_counts(bed.warehouse))


@query
def markov_counts(bed):
    return M.transition_counts(bed.warehouse)


@query
def markov_departures(bed):
    return M.departures(M.transition_counts(bed.warehouse))


@query
def markov_matrix(bed):
    return _matrix(bed)


@query
def markov_pivot(bed):
    return M.pivot_matrix(_matrix(bed), M.yard_names(bed.warehouse))


@query
def markov_row_check(bed):
    return M.row_check(_matrix(bed))


@query
def markov_steady_state(bed):
    return M.steady_state(_matrix(bed), bed.warehouse["dim_patio"])


@query
def markov_converged(bed):
    """The share of vehicles in the long run, and whether it has settled.

    Probabilities are rounded, so a row of many yards doesn't quite add up to one and shares keep drifting a little:
    the tolerance is above that.
    """
    return M.steady_state(_matrix(bed), bed.warehouse["dim_patio"], tol=1e-3, max_steps=50)


@query
def markov_classes(bed):
    """Classes of yards that reach each other, whether vehicles leave them, and their periods."""
    return K.communicating_classes(_matrix(bed))


@query
def markov_long_run(bed):
    """Average share of vehicles per yard in the long run, also where the chain never settles."""
    return K.long_run_shares(_matrix(bed))


# -- views of source G2 -------------------------------------------------------
@query
def src_vehicles_by_yard(bed):
    c = bed.whole_conformed
    return V.vehicles_by_yard(c["g2_veiculo"], c["g2_grupo"], c["g2_patio"])


@query
def src_active_rentals(bed):
    c = bed.whole_conformed
    return V.active_rentals(c["g2_locacao"], c["g2_veiculo"], c["g2_grupo"])


@query
def src_open_reservations(bed):
    c = bed.whole_conformed
    return V.open_reservations(c["g2_reserva"], c["g2_grupo"], c["g2_patio"], c["g2_cliente"])


@query
def src_groups_by_city(bed):
    c = bed.whole_conformed
    return V.groups_by_city(c["g2_locacao"], c["g2_cliente"], c["g2_veiculo"], c["g2_grupo"])


@query
def src_yard_movements(bed):
    c = bed.whole_conformed
    return V.yard_movements(c["g2_locacao"], c["g2_patio"])


# -- audits -------------------------------------------------------------------
@query
def audit_unique(bed):
    return Q.audit_unique(bed.rentals, ["id"], "locacao:unico:id")


@query
def audit_orphans(bed):
    g3, g4 = bed.whole_roles.g3, bed.whole_roles.g4
    return _union(
        Q.audit_orphans(g3["Locacao"], "Id_reserva", g3["Reserva"], "Id_reserva", "G3.Locacao:referencia:Id_reserva"),
        Q.audit_orphans(g4["Locacao"], "IDVagaRetirada", g4["Vaga"], "IDVaga", "G4.Locacao:referencia:IDVagaRetirada"),
        Q.audit_orphans(g4["Veiculo"], "IDCategoria", g4["Categoria"], "IDCategoria", "G4.Veiculo:referencia:IDCategoria"),
    )


@query
def audit_required(bed):
    g1 = bed.whole_roles.g1
    return _union(
        Q.audit_rows(g1["Locacao"], ["ID_Locacao"], Q.required("ID_Reserva", "ID_Patio_Chegada_Realizada"), "G1.Locacao:"),
        Q.audit_rows(g1["Veiculo"], ["ID_Veiculo"], Q.required("Mecanizacao"), "G1.Veiculo:"),
    )


@query
def audit_domain(bed):
    g2, g4 = bed.whole_roles.g2, bed.whole_roles.g4
    return _union(
        Q.audit_rows(g4["Categoria"], ["IDCategoria"], [Q.one_of("ClasseLuxo", "A", "B", "C")], "G4.Categoria:"),
        Q.audit_rows(g2["veiculo"], ["id_veiculo"], [Q.one_of("mecanizacao", "MANUAL", "AUTOMATICA")], "G2.veiculo:"),
        Q.audit_rows(g2["locacao"], ["id_locacao"], [Q.one_of("status", "Em_Andamento ", "cancelada")], "G2.locacao:"),
    )


@query
def audit_range(bed):
    t = bed.roles.table
    money = "decimal(12,2)"
    clients = t("customer").select("c_custkey", F.col("c_acctbal").cast(money).alias("saldo"))
    slots = t("supplier").select("s_suppkey", F.col("s_acctbal").cast(money).alias("saldo"))
    vehicles = t("part").select("p_partkey", "p_size")
    return _union(
        Q.audit_rows(clients, ["c_custkey"], [Q.at_least("saldo", 0)], "cliente:"),
        Q.audit_rows(slots, ["s_suppkey"], [Q.above("saldo", 0)], "vaga:"),
        Q.audit_rows(vehicles, ["p_partkey"], [Q.at_least("p_size", 10), Q.above("p_size", 3)], "veiculo:"),
    )


@query
def audit_order(bed):
    return Q.audit_rows(
        bed.rentals, ["id", "part_id", "slot_id"], [Q.after("back", "due"), Q.not_before("due", "pickup")], "locacao:"
    )


@query
def audit_length(bed):
    rules = CATALOG["G3.Veiculo"].checks
    return Q.audit_rows(bed.roles.g3["Veiculo"], ["Id_veiculo"], rules, "G3.Veiculo:")


@query
def audit_xor(bed):
    rules = [*CATALOG["G3.Documento_cliente"].checks[:2], Q.exactly_one("titular", "CNH", "Habilitacao_estrangeira")]
    return Q.audit_rows(bed.whole_roles.g3["Documento_cliente"], ["Id_documento"], rules, "G3.Documento_cliente:")


@query
def audit_one_active(bed):
    return Q.audit_one_active(
        bed.whole_conformed["g2_locacao"], "veiculo_id", "status", "EM_ANDAMENTO", "G2.locacao:um_ativo:veiculo_id"
    )


@query
def audit_future(bed):
    people = bed.whole_roles.g4["PessoaFisica"]
    return _union(
        Q.audit_rows(people, ["IDFisica"], [Q.past("DtNascimento")], "G4.PessoaFisica:", date(1976, 1, 1)),
        Q.audit_rows(bed.roles.table("orders"), ["o_orderkey"], [Q.not_future("o_orderdate")], "reserva:", AS_OF),
    )


@query
def audit_unresolved(bed):
    return _union(
        *(Q.audit_unresolved(bed.warehouse.rejects(t)).withColumn("fato", F.lit(t)) for t in ("fato_locacao", "fato_reserva"))
    )


@query
def audit_catalog(bed):
    """Violations by rule, of the catalogue's tables that the sources and the warehouse have here.

    Rules that hold and rules that can't be checked have no row: ``audit_all`` with ``absent`` and ``summary`` name those.
    """
    roles = {"G1": bed.roles.g1, "G2": bed.roles.g2, "G3": bed.roles.g3, "G4": bed.roles.g4, "DW": bed.warehouse}
    tables = {f"{source}.{name}": df for source, given in roles.items() for name, df in given.items()}
    found = Q.summary(Q.audit_all(CATALOG, tables, AS_OF))
    return found.where("violacoes > 0").select("regra", "violacoes")


# -- fixture expansion --------------------------------------------------------
@query
def expand_quantities_(bed):
    """Two movements per line item, counted back by origin and destination."""
    arrays = bed.roles.table("lineitem").select(
        F.array(F.col("l_suppkey") % 25, F.col("l_partkey") % 25).alias("origens"),
        F.array(F.col("l_orderkey") % 25, F.col("l_suppkey") % 7).alias("destinos"),
        F.array(F.col("l_linenumber"), (F.col("l_partkey") % 3).cast("int")).alias("quantidades"),
    )
    units = expand_quantities(arrays, "origens", "destinos", "quantidades")
    return units.groupBy("origem", "destino").agg(
        F.count("*").alias("unidades"), F.sum("numero").alias("soma_numeros"), F.max("numero").alias("maior_numero")
    )


QUERIES["expand_quantities"] = QUERIES.pop("expand_quantities_")
