"""Declared schemas: 27 staging tables and the star schema.

Original ids are BIGINT so that large sources fit; text is STRING and its
widths are checked by the audits instead of aborting the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Staging tables by source, without the trailing dt_extracao.
STAGING_DDL = {
    "g1_patio": "id_patio BIGINT, nome_localizacao STRING, capacidade_vagas INT, empresa_dona STRING",
    "g1_grupo_veiculo": "id_grupo BIGINT, nome_categoria STRING, classe_luxo STRING, valor_diaria DECIMAL(10,2)",
    "g1_veiculo": "id_veiculo BIGINT, id_grupo BIGINT, placa STRING, chassi STRING, marca STRING, modelo STRING, "
    "cor STRING, ar_condicionado BOOLEAN, mecanizacao STRING, status_disponibilidade STRING",
    "g1_cliente": "id_cliente BIGINT, tipo_cliente STRING, nome_razao_social STRING, cpf_cnpj STRING, "
    "endereco_completo STRING",
    "g1_reserva": "id_reserva BIGINT, id_cliente BIGINT, id_grupo BIGINT, id_patio_retirada BIGINT, "
    "data_hora_solicitacao TIMESTAMP_NTZ, data_hora_retirada_prevista TIMESTAMP_NTZ, "
    "data_hora_devolucao_prevista TIMESTAMP_NTZ, status_reserva STRING",
    "g1_locacao": "id_locacao BIGINT, id_reserva BIGINT, id_veiculo BIGINT, id_patio_saida BIGINT, "
    "id_patio_chegada_prevista BIGINT, id_patio_chegada_realizada BIGINT, data_hora_retirada TIMESTAMP_NTZ, "
    "data_hora_devolucao_prevista TIMESTAMP_NTZ, data_hora_devolucao_realizada TIMESTAMP_NTZ, "
    "valor_inicial DECIMAL(10,2), valor_final DECIMAL(10,2)",
    "g2_patio": "id_patio BIGINT, nome STRING, endereco STRING, capacidade_vagas INT",
    "g2_grupo": "id_grupo BIGINT, codigo STRING, nome STRING, classe_luxo STRING, valor_diaria DECIMAL(10,2), "
    "franquia_km_diaria INT",
    "g2_veiculo": "id_veiculo BIGINT, grupo_id BIGINT, patio_origem_id BIGINT, placa STRING, chassi STRING, "
    "marca STRING, modelo STRING, cor STRING, ano_fabricacao INT, mecanizacao STRING, "
    "tem_ar_condicionado BOOLEAN, km_atual INT, situacao STRING",
    "g2_cliente": "id_cliente BIGINT, tipo_pessoa STRING, nome STRING, email STRING, telefone STRING, "
    "cidade_origem STRING, cpf STRING, data_nascimento DATE, cnpj STRING",
    "g2_reserva": "id_reserva BIGINT, cliente_id BIGINT, grupo_id BIGINT, patio_retirada_id BIGINT, "
    "patio_devolucao_id BIGINT, data_reserva TIMESTAMP_NTZ, data_retirada_prevista TIMESTAMP_NTZ, "
    "data_devolucao_prevista TIMESTAMP_NTZ, estado STRING",
    "g2_locacao": "id_locacao BIGINT, reserva_id BIGINT, cliente_id BIGINT, veiculo_id BIGINT, "
    "patio_retirada_id BIGINT, patio_devolucao_id BIGINT, data_retirada_real TIMESTAMP_NTZ, "
    "data_devolucao_real TIMESTAMP_NTZ, km_saida INT, km_chegada INT, valor_diaria_aplicada DECIMAL(10,2), "
    "status STRING",
    "g3_patio": "id_patio BIGINT, nome_patio STRING, id_empresa BIGINT, nome_empresa STRING, cidade STRING, uf STRING",
    "g3_grupo": "id_grupo BIGINT, nome STRING, descricao STRING, diaria_grupo DECIMAL(10,2)",
    "g3_veiculo": "id_veiculo BIGINT, id_grupo BIGINT, categoria STRING, marca STRING, modelo STRING, ano STRING, "
    "cor STRING, chassi STRING, placa STRING, ar_condicionado BOOLEAN, direcao_auto BOOLEAN",
    "g3_cliente": "id_cliente BIGINT, nome_completo STRING, cpf STRING, nacionalidade STRING, cidade STRING, uf STRING",
    "g3_reserva": "id_reserva BIGINT, id_cliente BIGINT, id_grupo BIGINT, id_patio_origem BIGINT, "
    "id_patio_fim BIGINT, data_inicio_combinada TIMESTAMP_NTZ, data_fim_combinada TIMESTAMP_NTZ, "
    "data_reserva DATE, estado_reserva INT, preco_final DECIMAL(10,2)",
    "g3_locacao": "id_locacao BIGINT, id_reserva BIGINT, id_veiculo BIGINT, id_patio BIGINT, "
    "data_locacao TIMESTAMP_NTZ",
    "g3_devolucao": "id_devolucao BIGINT, id_locacao BIGINT, id_vaga BIGINT, data_devolucao TIMESTAMP_NTZ",
    "g3_vaga": "id_vaga BIGINT, cod_vaga STRING, id_patio BIGINT",
    "g4_patio": "id_patio BIGINT, cd_patio STRING, lotacao INT, horario_abertura STRING, horario_fechamento STRING, "
    "cidade STRING, uf STRING, nome_parceira STRING",
    "g4_categoria": "id_categoria BIGINT, classificacao STRING, classe_luxo STRING, "
    "valor_diaria_base DECIMAL(10,2), tracao_4x4 BOOLEAN",
    "g4_veiculo": "id_veiculo BIGINT, placa STRING, chassi STRING, modelo STRING, ano INT, "
    "ar_condicionado BOOLEAN, ultima_km INT, valor_diaria DECIMAL(10,2), id_categoria BIGINT",
    "g4_motorista": "id_motorista BIGINT, cpf STRING, nome STRING, cnh STRING, categoria_cnh STRING, "
    "cidade STRING, uf STRING",
    "g4_reserva": "id_reserva BIGINT, dt_reserva TIMESTAMP_NTZ, dt_retirada_prevista TIMESTAMP_NTZ, status STRING",
    "g4_locacao": "id_locacao BIGINT, valor_diaria DECIMAL(10,2), dt_retirada TIMESTAMP_NTZ, "
    "dt_chegada TIMESTAMP_NTZ, id_vaga_retirada BIGINT, id_vaga_devolvida BIGINT, id_veiculo BIGINT, "
    "id_reserva BIGINT, id_motorista BIGINT",
    "g4_vaga": "id_vaga BIGINT, cod_vaga STRING, id_patio BIGINT",
}

# The star schema (6 dimensions, 3 facts), without dt_carga.
STAR_DDL = {
    "dim_tempo": "sk_tempo BIGINT, data_completa DATE, dia INT, mes INT, trimestre INT, semestre INT, ano INT, "
    "num_semana_ano INT, dia_semana_num INT, dia_semana_nome STRING, nome_mes STRING, eh_fim_semana BOOLEAN",
    "dim_patio": "sk_patio BIGINT, id_patio_orig BIGINT, nome_patio STRING, empresa_dona STRING, cidade STRING, "
    "uf STRING, fonte_grupo STRING",
    "dim_empresa": "sk_empresa BIGINT, id_empresa_orig BIGINT, nome_empresa STRING, cnpj STRING, fonte_grupo STRING",
    "dim_grupo_veiculo": "sk_grupo BIGINT, id_grupo_orig BIGINT, codigo_grupo STRING, nome_grupo STRING, "
    "classe_luxo STRING, valor_diaria DECIMAL(10,2), fonte_grupo STRING",
    "dim_veiculo": "sk_veiculo BIGINT, id_veiculo_orig BIGINT, placa STRING, chassi STRING, marca STRING, "
    "modelo STRING, ano_fabricacao INT, cor STRING, mecanizacao STRING, ar_condicionado BOOLEAN, "
    "sk_grupo BIGINT, sk_empresa_origem BIGINT, fonte_grupo STRING",
    "dim_cliente": "sk_cliente BIGINT, id_cliente_orig BIGINT, nome STRING, tipo_pessoa STRING, cpf_cnpj STRING, "
    "cidade_origem STRING, uf_origem STRING, nacionalidade STRING, fonte_grupo STRING",
    "fato_locacao": "id_locacao_orig BIGINT, sk_tempo_retirada BIGINT, sk_tempo_devolucao BIGINT, "
    "sk_cliente BIGINT, sk_veiculo BIGINT, sk_grupo BIGINT, sk_patio_retirada BIGINT, sk_patio_entrega BIGINT, "
    "sk_empresa_veiculo BIGINT, duracao_dias_prevista INT, duracao_dias_real INT, valor_diaria DECIMAL(10,2), "
    "valor_total DECIMAL(10,2), km_percorridos INT, locacao_intercompanhia BOOLEAN, status_locacao STRING, "
    "fonte_grupo STRING",
    "fato_reserva": "id_reserva_orig BIGINT, sk_tempo_solicitacao BIGINT, sk_tempo_retirada_prev BIGINT, "
    "sk_tempo_devolucao_prev BIGINT, sk_cliente BIGINT, sk_grupo BIGINT, sk_patio_retirada BIGINT, "
    "sk_patio_devolucao BIGINT, duracao_prevista_dias INT, status_reserva STRING, fonte_grupo STRING",
    "fato_patio_snapshot": "sk_tempo BIGINT, sk_patio BIGINT, sk_veiculo BIGINT, sk_grupo BIGINT, "
    "sk_empresa_veiculo BIGINT, origem_veiculo STRING, fonte_grupo STRING",
}


def staging_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAGING_DDL[table])


def star_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAR_DDL[table])


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order with its types; a column not there is NULL."""
    found = [(f.name, f.dataType) for f in df.schema.fields]
    wanted = [(f.name, f.dataType) for f in schema.fields]
    if found == wanted:
        return df
    present = {name.lower() for name, _ in found}
    return df.selectExpr(
        *(
            f"CAST({f'`{name}`' if name.lower() in present else 'NULL'} AS {kind.simpleString()}) AS `{name}`"
            for name, kind in wanted
        )
    )
