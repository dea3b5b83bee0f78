"""Rental roles of an order schema: the four source systems from TPC-H-like tables.

Customers are clients, orders reservations, line items rentals, parts vehicles,
brands vehicle groups, nations yards, regions companies and suppliers parking
slots. Clients and their orders belong to source ``1 + custkey % 4``; yards,
groups, vehicles and slots exist in all four. Each source gets its own table and
column names, spellings and gaps (walk-ins, unknown slots and groups), so the
whole pipeline runs on it, extraction included. With ``whole`` every source has
all clients, orders and line items, to run one source's rules over everything.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from yardstar.sources.readers import Source, frame_source

RETURN_SLOT = "1000000000000"  # slots of return yards: this plus the nation
UNKNOWN = "2000000000000"  # added to an id so that it matches nothing

# Raw spellings a source uses, as SQL expressions.
STATUS = "CASE o_orderstatus WHEN 'F' THEN '{0}' WHEN 'O' THEN '{1}' ELSE '{2}' END"
G1_TRANSMISSION = (
    "CASE p_size % 5 WHEN 0 THEN 'auto' WHEN 1 THEN ' Automático ' WHEN 2 THEN 'AUTOMATICA' WHEN 3 THEN 'manual' END"
)


def _named(df: DataFrame, **columns: str) -> DataFrame:
    """Select SQL expressions under the given names."""
    return df.selectExpr(*(f"{expr} AS {name}" for name, expr in columns.items()))


def _blank(expr: str) -> str:
    return f"concat('  ', {expr}, ' ')"


class RentalRoles:
    """Source tables by system. ``rentals`` is the line-item base, written once by the caller."""

    def __init__(self, spark: SparkSession, sf_dir: str, rentals: DataFrame | None = None, whole: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.whole = whole
        self._rentals = rentals
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def _belonging(self, df: DataFrame, to: str) -> DataFrame:
        return df if self.whole else df.where(to)

    # -- shared bases -----------------------------------------------------
    @cached_property
    def places(self) -> DataFrame:
        """Nations with their region: yards with their owner."""
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"])

    @cached_property
    def brands(self) -> DataFrame:
        """Vehicle groups: brands with their lowest price and a class."""
        return (
            self.table("part")
            .groupBy("p_brand")
            .agg({"p_retailprice": "min"})
            .selectExpr(
                "p_brand",
                "CAST(`min(p_retailprice)` AS DECIMAL(10,2)) AS rate",
                "CAST(substring_index(p_brand, '#', -1) AS BIGINT) AS id",
            )
            .selectExpr(
                "*",
                "CASE id % 4 WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' ELSE 'X' END AS letter",
                "CASE id % 4 WHEN 1 THEN 'BASICO' WHEN 2 THEN 'INTERMEDIARIO' WHEN 3 THEN 'LUXO' "
                "ELSE 'SEM CLASSE' END AS word",
            )
        )

    @cached_property
    def parts(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey",
            "p_name",
            "p_type",
            "p_size",
            "CAST(substring_index(p_brand, '#', -1) AS BIGINT) AS brand",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
            "concat('P', p_partkey) AS plate",
            "concat(if(p_size = 13, '9BO', '9BW'), lpad(CAST(p_partkey AS STRING), 14, '0')) AS chassis",
            "substring_index(p_name, ' ', 1) AS colour",
        )

    def clients(self, source: int) -> DataFrame:
        return (
            self._belonging(self.table("customer"), f"c_custkey % 4 = {source - 1}")
            .selectExpr(
                "c_custkey",
                "c_name",
                "c_nationkey",
                "CAST(c_custkey AS STRING) AS number",
                "if(c_mktsegment IN ('BUILDING', 'MACHINERY'), 'PJ', 'PF') AS kind",
            )
        )

    def orders(self, source: int) -> DataFrame:
        """Orders of a source with the dates and yards of a reservation."""
        return (
            self._belonging(self.table("orders"), f"o_custkey % 4 = {source - 1}")
            .selectExpr(
                "o_orderkey",
                "o_custkey",
                "o_orderstatus",
                "o_orderdate",
                "CAST(o_totalprice AS DECIMAL(10,2)) AS price",
                "o_orderdate + make_dt_interval(CAST(1 + o_orderkey % 30 AS INT), 9) AS pickup",
                "1 + o_orderkey % 25 AS brand",
                "o_orderkey % 25 AS yard_id",
                "(o_orderkey + o_custkey) % 25 AS return_yard_id",
            )
            .selectExpr(
                "*",
                "pickup + make_dt_interval(CAST(1 + o_custkey % 14 AS INT), CAST(o_orderkey % 10 AS INT)) AS due",
            )
        )

    def rental_base(self) -> DataFrame:
        """Line items with their source, yards and times; open ones have no return."""
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        suppliers = self.table("supplier").select("s_suppkey", "s_nationkey")
        owners = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        # Prices are shuffled as decimals; one that is none is kept as it was, to fail only if its row has an order.
        items = self.table("lineitem").selectExpr(
            "*",
            "CAST(l_quantity AS INT) AS quantity",
            "l_linestatus = 'F' AS done",
            "try_cast(l_extendedprice AS DECIMAL(10,2)) AS money",
            "if(try_cast(l_extendedprice AS DECIMAL(10,2)) IS NULL, l_extendedprice, NULL) AS no_money",
        )
        return (
            items.join(owners, items["l_orderkey"] == owners["o_orderkey"])
            .join(suppliers, items["l_suppkey"] == suppliers["s_suppkey"])
            .selectExpr(
                "l_orderkey * 8 + l_linenumber AS id",
                "l_orderkey AS order_id",
                "o_custkey AS client_id",
                "l_partkey AS part_id",
                "l_suppkey AS slot_id",
                "CAST(s_nationkey AS BIGINT) AS yard_id",
                "CAST(c_nationkey AS BIGINT) AS return_yard_id",
                "quantity",
                "coalesce(money, CAST(no_money AS DECIMAL(10,2))) AS price",
                "done",
                "l_shipdate + make_dt_interval(0, l_linenumber) AS pickup",
                "l_shipdate + make_dt_interval(1 + quantity % 14) AS due",
                "if(done, l_shipdate + make_dt_interval(1 + (quantity + l_linenumber) % 20, "
                "CAST(l_partkey % 24 AS INT)), NULL) AS back",
                "CAST(1 + o_custkey % 4 AS INT) AS source",
            )
        )

    def rentals(self, source: int) -> DataFrame:
        base = self.rental_base() if self._rentals is None else self._rentals
        return self._belonging(base, f"source = {source}")

    # -- the four systems -------------------------------------------------
    @cached_property
    def g1(self) -> dict[str, DataFrame]:
        return {
            "Patio": _named(
                self.places,
                ID_Patio="n_nationkey",
                Nome_Localizacao=_blank("n_name"),
                Capacidade_Vagas="50 + n_nationkey * 3",
                Empresa_Dona="r_name",
            ),
            "Grupo_Veiculo": _named(
                self.brands, ID_Grupo="id", Nome_Categoria="p_brand", Classe_Luxo="word", Valor_Diaria="rate"
            ),
            "Veiculo": _named(
                self.parts,
                ID_Veiculo="p_partkey",
                ID_Grupo="brand",
                Placa="plate",
                Chassi="chassis",
                Marca="p_type",
                Modelo="p_name",
                Cor="colour",
                Ar_Condicionado="p_size % 2 = 1",
                Mecanizacao=G1_TRANSMISSION,
                Status_Disponibilidade="if(p_size % 3 = 0, 'Disponível', 'Alugado')",
            ),
            "Cliente": _named(
                self.clients(1),
                ID_Cliente="c_custkey",
                Tipo_Cliente="concat(kind, ' ')",
                Nome_Razao_Social="c_name",
                CPF_CNPJ="lpad(number, 11, '0')",
                Endereco_Completo="'rua 1'",
            ),
            "Reserva": _named(
                self.orders(1),
                ID_Reserva="o_orderkey",
                ID_Cliente="o_custkey",
                # Reservations of a specific vehicle name no group.
                ID_Grupo="if(o_orderkey % 9 <> 0, brand, NULL)",
                ID_Patio_Retirada="yard_id",
                Data_Hora_Solicitacao="o_orderdate",
                Data_Hora_Retirada_Prevista="pickup",
                Data_Hora_Devolucao_Prevista="due",
                Status_Reserva=_blank(STATUS.format("Confirmada", "Em_Fila_Espera", "Cancelada")),
            ),
            "Locacao": _named(
                self.rentals(1),
                ID_Locacao="id",
                # Walk-ins have no reservation.
                ID_Reserva="if(part_id % 10 <> 0, order_id, NULL)",
                ID_Veiculo="part_id",
                ID_Patio_Saida="yard_id",
                ID_Patio_Chegada_Prevista="return_yard_id",
                ID_Patio_Chegada_Realizada="if(done, return_yard_id, NULL)",
                Data_Hora_Retirada="pickup",
                Data_Hora_Devolucao_Prevista="due",
                Data_Hora_Devolucao_Realizada="back",
                Valor_Inicial="price",
                Valor_Final="if(done, price, NULL)",
            ),
        }

    @cached_property
    def g2(self) -> dict[str, DataFrame]:
        clients, nation = self.clients(2), self.table("nation").select("n_nationkey", "n_name")
        clients = clients.join(nation, clients["c_nationkey"] == nation["n_nationkey"])
        return {
            "patio": _named(
                self.places,
                id_patio="n_nationkey",
                nome=_blank("lower(n_name)"),
                endereco="concat('Rua ', n_name)",
                capacidade_vagas="50 + n_nationkey",
            ),
            "grupo": _named(
                self.brands,
                id_grupo="id",
                codigo="concat('C', id)",
                nome="p_brand",
                classe_luxo=_blank("lower(word)"),
                valor_diaria="rate",
                franquia_km_diaria="CAST(100 + id AS INT)",
            ),
            "veiculo": _named(
                self.parts,
                id_veiculo="p_partkey",
                grupo_id="brand",
                patio_origem_id="p_partkey % 25",
                placa="plate",
                chassi="chassis",
                marca="p_type",
                modelo="p_name",
                cor="colour",
                ano_fabricacao="2000 + p_size % 20",
                mecanizacao="if(p_size % 2 = 0, ' automatica ', 'manual')",
                tem_ar_condicionado="p_size % 2 = 1",
                km_atual="p_size * 1000",
                situacao="if(p_size % 3 = 0, 'DISPONIVEL', 'ALUGADO')",
            ),
            "cliente": _named(
                clients,
                id_cliente="c_custkey",
                tipo_pessoa="kind",
                nome="c_name",
                email="concat('c', number, '@example.com')",
                telefone="number",
                cidade_origem=_blank("lower(n_name)"),
            ),
            "cliente_pf": _named(
                clients.where("kind = 'PF'"),
                cliente_id="c_custkey",
                cpf="lpad(number, 11, '0')",
                data_nascimento="date_add(DATE '1960-01-01', CAST(c_custkey % 10000 AS INT))",
            ),
            "cliente_pj": _named(clients.where("kind = 'PJ'"), cliente_id="c_custkey", cnpj="lpad(number, 14, '0')"),
            "reserva": _named(
                self.orders(2),
                id_reserva="o_orderkey",
                cliente_id="o_custkey",
                grupo_id="brand",
                patio_retirada_id="yard_id",
                patio_devolucao_id="return_yard_id",
                data_reserva="o_orderdate",
                data_retirada_prevista="pickup",
                data_devolucao_prevista="due",
                estado=STATUS.format("CONFIRMADA", "EM_FILA_ESPERA", "CANCELADA"),
            ),
            "locacao": _named(
                self.rentals(2),
                id_locacao="id",
                reserva_id="if(part_id % 10 <> 0, order_id, NULL)",
                cliente_id="client_id",
                veiculo_id="part_id",
                patio_retirada_id="yard_id",
                patio_devolucao_id="return_yard_id",
                data_retirada_real="pickup",
                data_devolucao_real="back",
                km_saida="CAST(part_id % 1000 AS INT)",
                km_chegada="if(done, CAST(part_id % 1000 + quantity * 10 AS INT), NULL)",
                valor_diaria_aplicada="price",
                status="CASE WHEN NOT done THEN 'Em_Andamento ' WHEN part_id % 11 = 0 THEN 'cancelada' "
                "ELSE ' concluida ' END",
            ),
        }

    @cached_property
    def slots(self) -> DataFrame:
        """Suppliers are slots of their nation's yard; each yard has one more for returns."""
        own = self.table("supplier").selectExpr("s_suppkey AS slot_id", "s_nationkey AS yard_id")
        returns = self.table("nation").selectExpr(f"{RETURN_SLOT} + n_nationkey AS slot_id", "n_nationkey AS yard_id")
        return own.unionByName(returns)

    @cached_property
    def g3(self) -> dict[str, DataFrame]:
        rentals, clients = self.rentals(3), self.clients(3)
        return {
            "Endereco": _named(
                self.places,
                Id_endereco="n_nationkey",
                UF="lower(substring(r_name, 1, 2))",
                Cidade=_blank("lower(n_name)"),
            ),
            "Empresa": _named(self.table("region"), Id_empresa="r_regionkey", Nome_empresa="r_name"),
            "Patio": _named(
                self.table("nation"),
                Id_patio="n_nationkey",
                Id_endereco="n_nationkey",
                Id_empresa="n_regionkey",
                Nome_patio="n_name",
            ),
            "Grupo": _named(self.brands, Id_grupo="id", Nome="p_brand", Descricao="word", Diaria_grupo="rate"),
            "Especificacoes_const": _named(
                self.table("part").select("p_size").distinct(),
                Id_spec_const="p_size",
                Ar_condicionado="p_size % 2",
                Direcao_automatica="if(p_size % 5 <> 4, 1 - p_size % 2, NULL)",
            ),
            "Veiculo": _named(
                self.parts,
                Id_veiculo="p_partkey",
                Id_grupo="brand",
                Id_spec_const="p_size",
                Categoria="p_type",
                Marca="p_type",
                Modelo="p_name",
                Ano="CAST(2000 + p_size % 20 AS STRING)",
                Cor="colour",
                Chassi="chassis",
                Placa="plate",
            ),
            "Documento_cliente": _named(
                clients,
                Id_documento="c_custkey",
                # Foreign clients have a passport or licence of their own, some have neither.
                CPF="if(c_custkey % 7 <> 0, lpad(number, 11, '0'), NULL)",
                Passaporte="if(c_custkey % 14 = 0, concat('P', number), NULL)",
                CNH="if(c_custkey % 3 <> 0, lpad(number, 11, '0'), NULL)",
                Habilitacao_estrangeira="if(c_custkey % 6 = 0, concat('H', number), NULL)",
            ),
            "Cliente": _named(
                clients,
                Id_cliente="c_custkey",
                Id_documento="c_custkey",
                Id_endereco="c_nationkey",
                Nome_completo="c_name",
                Nacionalidade="'BRASILEIRA'",
            ),
            "Reserva": _named(
                self.orders(3),
                Id_reserva="o_orderkey",
                Id_cliente="o_custkey",
                Id_grupo="brand",
                Id_patio_origem="yard_id",
                Id_patio_fim="return_yard_id",
                Preco_final="price",
                Data_inicio_combinada="pickup",
                Data_fim_combinada="due",
                Estado_reserva="CAST(o_orderkey % 4 AS INT)",
                Data_reserva="CAST(o_orderdate AS DATE)",
            ),
            "Locacao": _named(
                rentals,
                Id_locacao="id",
                Id_reserva=f"if(part_id % 19 = 0, order_id + {UNKNOWN}, order_id)",
                Id_veiculo="part_id",
                Id_patio="yard_id",
                Data_locacao="pickup",
            ),
            "Devolucao": _named(
                rentals.where("done"),
                # Orders the returns of one rental; rentals that share an id share their returns.
                Id_devolucao="part_id * 100000000 + slot_id",
                Id_locacao="id",
                Id_vaga=f"if(part_id % 13 = 0, slot_id + {UNKNOWN}, {RETURN_SLOT} + return_yard_id)",
                Data_devolucao="back",
            ),
            "Vaga": _named(self.slots, Id_vaga="slot_id", Id_patio="yard_id", Alfanum_vaga="concat('V', slot_id)"),
        }

    @cached_property
    def g4(self) -> dict[str, DataFrame]:
        clients = self.clients(4)
        return {
            "Endereco": _named(
                self.places,
                IDEndereco="n_nationkey",
                UF="lower(substring(r_name, 1, 2))",
                Cidade=_blank("lower(n_name)"),
            ),
            "Parceira": _named(self.table("region"), IDParceira="r_regionkey", Nome="r_name"),
            "Patio": _named(
                self.table("nation"),
                IDPatio="n_nationkey",
                CDPatio="n_name",
                Lotacao="50 + n_nationkey",
                HorarioAbertura="'08:00:00'",
                HorarioFechamento="'20:00:00'",
                IDEndereco="n_nationkey",
                IDParceira="n_regionkey",
            ),
            "Categoria": _named(
                self.brands,
                IDCategoria="id",
                Classificacao="p_brand",
                ClasseLuxo="letter",
                ValorDiariaBase="rate",
                Tracao4x4="id % 2 = 0",
            ),
            "Veiculo": _named(
                self.parts,
                IDVeiculo="p_partkey",
                Placa="plate",
                Chassi="chassis",
                Modelo="p_name",
                Ano="2000 + p_size % 20",
                ArCondicionado="p_size % 2 = 1",
                UltimaKilometragem="p_size * 1000",
                ValorDiaria="price",
                # Some vehicles name a group that does not exist.
                IDCategoria=f"if(p_partkey % 23 = 0, brand + {UNKNOWN}, brand)",
            ),
            "PessoaFisica": _named(
                clients,
                IDFisica="c_custkey",
                CPF="lpad(number, 11, '0')",
                Nome="c_name",
                IDEndereco="c_nationkey",
                DtNascimento="date_add(DATE '1975-01-01', CAST(c_custkey % 10000 AS INT))",
            ),
            "Motorista": _named(
                clients, IDMotorista="c_custkey", CNH="number", CategoriaCNH="'B'", IDFisica="c_custkey"
            ),
            "Vaga": _named(self.slots, IDVaga="slot_id", CodVaga="concat('V', slot_id)", IDPatio="yard_id"),
            "Reserva": _named(
                self.orders(4),
                IDReserva="o_orderkey",
                DtReserva="o_orderdate",
                DtRetiradaPrevista="pickup",
                Status=STATUS.format("Confirmada", "Atendida", "Cancelada"),
            ),
            "Locacao": _named(
                self.rentals(4),
                IDLocacao="id",
                ValorDiaria="price",
                DtRetirada="pickup",
                DtChegada="back",
                IDVagaRetirada=f"if(part_id % 17 = 0, slot_id + {UNKNOWN}, slot_id)",
                IDVagaDevolvida=f"if(done, {RETURN_SLOT} + return_yard_id, NULL)",
                IDVeiculo="part_id",
                IDReserva="order_id",
                IDMotorista="client_id",
            ),
        }

    def sources(self) -> dict[str, Source]:
        return {
            "G1": frame_source(self.g1),
            "G2": frame_source(self.g2),
            "G3": frame_source(self.g3),
            "G4": frame_source(self.g4),
        }
