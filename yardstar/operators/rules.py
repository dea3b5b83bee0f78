"""What the four source schemas and the star schema demand of their tables.

Names are ``<source>.<table>``. Tables nothing else in the package reads are
listed too: they are audited if a frame for them is given.
"""

from __future__ import annotations

from yardstar import config as C
from yardstar.operators.audits import (
    TableRules,
    above,
    after,
    any_of,
    at_least,
    at_most,
    exactly_one,
    length,
    not_before,
    not_future,
    one_of,
    past,
    without,
)

# Licence categories and the 27 federal units.
LICENCES = ("A", "B", "C", "D", "E", "AB", "AC", "AD", "AE")
UNITS = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)

# Keys, references, required columns and checks per table.
G1 = {
    "G1.Patio": TableRules(
        key=("ID_Patio",),
        required=("Nome_Localizacao", "Capacidade_Vagas", "Empresa_Dona"),
    ),
    "G1.Grupo_Veiculo": TableRules(
        key=("ID_Grupo",),
        required=("Nome_Categoria", "Classe_Luxo", "Valor_Diaria"),
    ),
    "G1.Veiculo": TableRules(
        key=("ID_Veiculo",),
        unique=(("Placa",), ("Chassi",)),
        references={
            "ID_Grupo": ("G1.Grupo_Veiculo", "ID_Grupo"),
        },
        required=("ID_Grupo", "Placa", "Chassi", "Marca", "Modelo", "Cor", "Ar_Condicionado", "Mecanizacao"),
    ),
    "G1.Prontuario_Veiculo": TableRules(
        key=("ID_Prontuario",),
        references={
            "ID_Veiculo": ("G1.Veiculo", "ID_Veiculo"),
        },
        required=("ID_Veiculo", "Data_Registro"),
    ),
    "G1.Foto_Veiculo": TableRules(
        key=("ID_Foto",),
        references={
            "ID_Veiculo": ("G1.Veiculo", "ID_Veiculo"),
        },
        required=("ID_Veiculo", "URL_Foto"),
    ),
    "G1.Cliente": TableRules(
        key=("ID_Cliente",),
        unique=(("CPF_CNPJ",),),
        required=("Tipo_Cliente", "Nome_Razao_Social", "CPF_CNPJ"),
    ),
    "G1.Motorista": TableRules(
        key=("ID_Motorista",),
        unique=(("Numero_CNH",),),
        references={
            "ID_Cliente": ("G1.Cliente", "ID_Cliente"),
        },
        required=("ID_Cliente", "Nome_Condutor", "Numero_CNH", "Categoria_Habilitacao", "Data_Expiracao_CNH"),
    ),
    "G1.Reserva": TableRules(
        key=("ID_Reserva",),
        references={
            "ID_Cliente": ("G1.Cliente", "ID_Cliente"),
            "ID_Grupo": ("G1.Grupo_Veiculo", "ID_Grupo"),
            "ID_Veiculo_Especifico": ("G1.Veiculo", "ID_Veiculo"),
            "ID_Patio_Retirada": ("G1.Patio", "ID_Patio"),
        },
        required=(
            "ID_Cliente",
            "ID_Patio_Retirada",
            "Data_Hora_Solicitacao",
            "Data_Hora_Retirada_Prevista",
            "Data_Hora_Devolucao_Prevista",
        ),
    ),
    "G1.Seguro_Protecao": TableRules(
        key=("ID_Seguro",),
        required=("Descricao", "Valor_Diario"),
    ),
    "G1.Locacao": TableRules(
        key=("ID_Locacao",),
        references={
            "ID_Reserva": ("G1.Reserva", "ID_Reserva"),
            "ID_Motorista": ("G1.Motorista", "ID_Motorista"),
            "ID_Veiculo": ("G1.Veiculo", "ID_Veiculo"),
            "ID_Patio_Saida": ("G1.Patio", "ID_Patio"),
            "ID_Patio_Chegada_Prevista": ("G1.Patio", "ID_Patio"),
            "ID_Patio_Chegada_Realizada": ("G1.Patio", "ID_Patio"),
        },
        required=(
            "ID_Motorista",
            "ID_Veiculo",
            "ID_Patio_Saida",
            "ID_Patio_Chegada_Prevista",
            "Data_Hora_Retirada",
            "Data_Hora_Devolucao_Prevista",
        ),
    ),
    "G1.Locacao_Seguro": TableRules(
        key=("ID_Locacao", "ID_Seguro"),
        references={
            "ID_Locacao": ("G1.Locacao", "ID_Locacao"),
            "ID_Seguro": ("G1.Seguro_Protecao", "ID_Seguro"),
        },
    ),
}

G2 = {
    "G2.patio": TableRules(
        key=("id_patio",),
        required=("nome", "endereco", "capacidade_vagas"),
        checks=(
            at_least("capacidade_vagas", 0),
        ),
    ),
    "G2.vaga": TableRules(
        key=("patio_id", "codigo"),
        references={
            "patio_id": ("G2.patio", "id_patio"),
        },
        required=("ocupada",),
    ),
    "G2.grupo": TableRules(
        key=("id_grupo",),
        unique=(("codigo",),),
        required=("codigo", "nome", "classe_luxo", "valor_diaria", "franquia_km_diaria"),
        checks=(
            at_least("valor_diaria", 0),
            at_least("franquia_km_diaria", 0),
        ),
    ),
    "G2.veiculo": TableRules(
        key=("id_veiculo",),
        unique=(("placa",), ("chassi",), ("renavam",)),
        references={
            "grupo_id": ("G2.grupo", "id_grupo"),
            "patio_origem_id": ("G2.patio", "id_patio"),
        },
        required=(
            "grupo_id",
            "patio_origem_id",
            "placa",
            "chassi",
            "renavam",
            "marca",
            "modelo",
            "cor",
            "ano_fabricacao",
            "mecanizacao",
            "tem_ar_condicionado",
            "km_atual",
            "situacao",
        ),
        checks=(
            one_of("mecanizacao", C.MANUAL, C.AUTOMATIC),
            at_least("km_atual", 0),
            one_of("situacao", C.G2_AVAILABLE, "ALUGADO", "MANUTENCAO", "BAIXADO"),
        ),
    ),
    "G2.cliente": TableRules(
        key=("id_cliente",),
        unique=(("email",),),
        required=("tipo_pessoa", "nome", "email", "cidade_origem", "data_cadastro"),
        checks=(
            one_of("tipo_pessoa", "PF", "PJ"),
        ),
    ),
    "G2.cliente_pf": TableRules(
        key=("cliente_id",),
        unique=(("cpf",), ("cnh_numero",)),
        references={
            "cliente_id": ("G2.cliente", "id_cliente"),
        },
        required=("cpf", "data_nascimento", "cnh_numero", "cnh_categoria", "cnh_validade"),
        checks=(
            one_of("cnh_categoria", *LICENCES),
        ),
    ),
    "G2.cliente_pj": TableRules(
        key=("cliente_id",),
        unique=(("cnpj",),),
        references={
            "cliente_id": ("G2.cliente", "id_cliente"),
        },
        required=("cnpj", "responsavel"),
    ),
    "G2.condutor": TableRules(
        key=("cliente_pj_id", "cpf"),
        unique=(("cnh_numero",),),
        references={
            "cliente_pj_id": ("G2.cliente_pj", "cliente_id"),
        },
        required=("nome", "cnh_numero", "cnh_categoria", "cnh_validade"),
        checks=(
            one_of("cnh_categoria", *LICENCES),
        ),
    ),
    "G2.reserva": TableRules(
        key=("id_reserva",),
        references={
            "cliente_id": ("G2.cliente", "id_cliente"),
            "grupo_id": ("G2.grupo", "id_grupo"),
            "patio_retirada_id": ("G2.patio", "id_patio"),
            "patio_devolucao_id": ("G2.patio", "id_patio"),
        },
        required=(
            "cliente_id",
            "grupo_id",
            "patio_retirada_id",
            "patio_devolucao_id",
            "data_reserva",
            "data_retirada_prevista",
            "data_devolucao_prevista",
            "estado",
        ),
        checks=(
            one_of("estado", C.CONFIRMED, "EM_FILA_ESPERA", C.CANCELLED, "CONCRETIZADA"),
            after("data_devolucao_prevista", "data_retirada_prevista"),
        ),
    ),
    "G2.locacao": TableRules(
        key=("id_locacao",),
        unique=(("numero_contrato",), ("reserva_id",)),
        references={
            "reserva_id": ("G2.reserva", "id_reserva"),
            "cliente_id": ("G2.cliente", "id_cliente"),
            "veiculo_id": ("G2.veiculo", "id_veiculo"),
            "patio_retirada_id": ("G2.patio", "id_patio"),
            "patio_devolucao_id": ("G2.patio", "id_patio"),
        },
        required=(
            "numero_contrato",
            "cliente_id",
            "veiculo_id",
            "patio_retirada_id",
            "patio_devolucao_id",
            "data_retirada_real",
            "km_saida",
            "valor_diaria_aplicada",
            "status",
        ),
        checks=(
            at_least("km_saida", 0),
            not_before("km_chegada", "km_saida"),
            at_least("valor_diaria_aplicada", 0),
            one_of("status", C.ACTIVE, C.DONE, C.CANCELLED),
            after("data_devolucao_real", "data_retirada_real"),
        ),
        one_active=("veiculo_id", "status", C.ACTIVE),
    ),
    "G2.cobranca": TableRules(
        key=("id_cobranca",),
        references={
            "locacao_id": ("G2.locacao", "id_locacao"),
        },
        required=("locacao_id", "data_emissao", "valor_total", "status"),
        checks=(
            at_least("valor_total", 0),
            one_of("status", "PENDENTE", "PAGA", C.CANCELLED),
        ),
    ),
}

G3 = {
    "G3.Endereco": TableRules(
        key=("Id_endereco",),
        required=("UF", "Cidade", "CEP", "Bairro", "Rua_Avenida"),
        checks=(
            length("CEP", 8),
        ),
    ),
    "G3.Dados_cobranca": TableRules(
        key=("Id_dados_cobranca",),
        unique=(("CPF_titular",),),
        required=("Numero_cartao", "Validade", "Nome_titular", "CPF_titular", "CVV"),
        checks=(
            length("Numero_cartao", 13, 19),
            length("CPF_titular", 11),
            length("CVV", 3, 4),
        ),
    ),
    "G3.Documento_cliente": TableRules(
        key=("Id_documento",),
        checks=(
            any_of("identidade", "CPF", "Passaporte"),
            any_of("habilitacao", "CNH", "Habilitacao_estrangeira"),
            length("CPF", 11),
            length("CNH", 11),
        ),
    ),
    "G3.Cliente": TableRules(
        key=("Id_cliente",),
        references={
            "Id_documento": ("G3.Documento_cliente", "Id_documento"),
            "Id_endereco": ("G3.Endereco", "Id_endereco"),
            "Id_dados_cobranca": ("G3.Dados_cobranca", "Id_dados_cobranca"),
        },
        required=(
            "Id_documento",
            "Id_endereco",
            "Nome_completo",
            "Genero",
            "Nacionalidade",
            "Data_nascimento",
            "Telefone",
            "Email",
        ),
    ),
    "G3.Grupo": TableRules(
        key=("Id_grupo",),
        required=("Nome", "Descricao", "Diaria_grupo"),
    ),
    "G3.Especificacoes_const": TableRules(
        key=("Id_spec_const",),
        required=("Ar_condicionado", "Direcao_automatica"),
    ),
    "G3.Especificacoes_var": TableRules(
        key=("Id_spec_var",),
        required=("Gasolina", "Oleo", "Pressao_pneu"),
        checks=(
            at_least("Gasolina", 0),
            at_least("Oleo", 0),
        ),
    ),
    "G3.Veiculo": TableRules(
        key=("Id_veiculo",),
        unique=(("Chassi",), ("Placa",)),
        references={
            "Id_grupo": ("G3.Grupo", "Id_grupo"),
            "Id_spec_var": ("G3.Especificacoes_var", "Id_spec_var"),
            "Id_spec_const": ("G3.Especificacoes_const", "Id_spec_const"),
        },
        required=(
            "Id_grupo",
            "Id_spec_var",
            "Id_spec_const",
            "Categoria",
            "Marca",
            "Modelo",
            "Ano",
            "Versao",
            "Cor",
            "Chassi",
            "Placa",
        ),
        checks=(
            length("Ano", 4),
            length("Placa", 7),
            length("Chassi", 17),
            without("Chassi", "IOQ"),
        ),
    ),
    "G3.Imagem_veiculo": TableRules(
        key=("Id_imagem_veiculo",),
        unique=(("Url_arquivo",),),
        references={
            "Id_veiculo": ("G3.Veiculo", "Id_veiculo"),
        },
        required=("Id_veiculo", "Url_arquivo", "Tipo_imagem", "Data_upload"),
    ),
    "G3.Empresa": TableRules(
        key=("Id_empresa",),
        unique=(("CNPJ",),),
        references={
            "Id_endereco": ("G3.Endereco", "Id_endereco"),
        },
        required=("Id_endereco", "Nome_empresa", "CNPJ"),
        checks=(
            length("CNPJ", 14),
        ),
    ),
    "G3.Patio": TableRules(
        key=("Id_patio",),
        references={
            "Id_endereco": ("G3.Endereco", "Id_endereco"),
            "Id_empresa": ("G3.Empresa", "Id_empresa"),
        },
        required=("Id_endereco", "Id_empresa", "Nome_patio"),
    ),
    "G3.Vaga": TableRules(
        key=("Id_vaga",),
        references={
            "Id_patio": ("G3.Patio", "Id_patio"),
            "Id_veiculo": ("G3.Veiculo", "Id_veiculo"),
        },
        required=("Id_patio", "Alfanum_vaga"),
    ),
    "G3.Seguro": TableRules(
        key=("Id_seguro",),
        required=("Nivel", "Descricao", "Diaria_seguro"),
    ),
    "G3.Pagamento": TableRules(
        key=("Id_pagamento",),
        required=("Nota_fiscal",),
    ),
    "G3.Reserva": TableRules(
        key=("Id_reserva",),
        references={
            "Id_cliente": ("G3.Cliente", "Id_cliente"),
            "Id_grupo": ("G3.Grupo", "Id_grupo"),
            "Id_pagamento": ("G3.Pagamento", "Id_pagamento"),
            "Id_seguro": ("G3.Seguro", "Id_seguro"),
            "Id_patio_origem": ("G3.Patio", "Id_patio"),
            "Id_patio_fim": ("G3.Patio", "Id_patio"),
        },
        required=(
            "Id_cliente",
            "Id_grupo",
            "Id_pagamento",
            "Id_seguro",
            "Id_patio_origem",
            "Id_patio_fim",
            "Preco_final",
            "Data_inicio_combinada",
            "Data_fim_combinada",
            "Estado_reserva",
            "Data_reserva",
        ),
        checks=(
            not_before("Data_fim_combinada", "Data_inicio_combinada"),
        ),
    ),
    "G3.Caucao": TableRules(
        key=("Id_caucao",),
        required=("Estado_caucao",),
    ),
    "G3.Locacao": TableRules(
        key=("Id_locacao",),
        references={
            "Id_reserva": ("G3.Reserva", "Id_reserva"),
            "Id_veiculo": ("G3.Veiculo", "Id_veiculo"),
            "Id_spec_var": ("G3.Especificacoes_var", "Id_spec_var"),
            "Id_patio": ("G3.Patio", "Id_patio"),
            "Id_caucao": ("G3.Caucao", "Id_caucao"),
        },
        required=("Id_reserva", "Id_veiculo", "Id_spec_var", "Id_caucao", "Id_patio", "Data_locacao"),
    ),
    "G3.Custos_devolucao": TableRules(
        key=("Id_custos_devolucao",),
        references={
            "Id_caucao": ("G3.Caucao", "Id_caucao"),
            "Id_pagamento": ("G3.Pagamento", "Id_pagamento"),
        },
        required=("Id_caucao", "Id_pagamento"),
    ),
    "G3.Devolucao": TableRules(
        key=("Id_devolucao",),
        references={
            "Id_spec_var": ("G3.Especificacoes_var", "Id_spec_var"),
            "Id_custos_devolucao": ("G3.Custos_devolucao", "Id_custos_devolucao"),
            "Id_locacao": ("G3.Locacao", "Id_locacao"),
            "Id_vaga": ("G3.Vaga", "Id_vaga"),
        },
        required=("Id_spec_var", "Id_custos_devolucao", "Id_locacao", "Id_vaga", "Data_devolucao"),
    ),
    "G3.Extensao_reserva": TableRules(
        key=("Id_extensao_reserva",),
        references={
            "Id_locacao": ("G3.Locacao", "Id_locacao"),
            "Id_reserva": ("G3.Reserva", "Id_reserva"),
            "Id_pagamento": ("G3.Pagamento", "Id_pagamento"),
        },
        required=("Id_locacao", "Id_reserva", "Id_pagamento", "Qtd_dias", "Valor", "Data_extensao"),
        checks=(
            above("Qtd_dias", 0),
        ),
    ),
    "G3.Imagem_devolucao": TableRules(
        key=("Id_imagem_devolucao",),
        unique=(("Url_arquivo",),),
        references={
            "Id_devolucao": ("G3.Devolucao", "Id_devolucao"),
        },
        required=("Id_devolucao", "Url_arquivo", "Tipo_imagem", "Data_upload"),
    ),
}

G4 = {
    "G4.Endereco": TableRules(
        key=("IDEndereco",),
        required=("CEP", "UF", "Cidade", "Bairro", "Logradouro", "Numero"),
        checks=(
            length("CEP", 8),
            one_of("UF", *UNITS),
        ),
    ),
    "G4.Parceira": TableRules(
        key=("IDParceira",),
        unique=(("CNPJ",),),
        required=("CNPJ", "Nome"),
    ),
    "G4.Patio": TableRules(
        key=("IDPatio",),
        unique=(("CDPatio",),),
        references={
            "IDEndereco": ("G4.Endereco", "IDEndereco"),
            "IDParceira": ("G4.Parceira", "IDParceira"),
        },
        required=("CDPatio", "Lotacao", "HorarioAbertura", "HorarioFechamento", "IDEndereco", "IDParceira"),
        checks=(
            above("Lotacao", 0),
            after("HorarioFechamento", "HorarioAbertura"),
        ),
    ),
    "G4.Vaga": TableRules(
        key=("IDVaga",),
        unique=(("CodVaga",),),
        references={
            "IDPatio": ("G4.Patio", "IDPatio"),
        },
        required=("CodVaga", "Coberta", "IDPatio"),
        checks=(
            at_least("Andar", 0),
        ),
    ),
    "G4.Categoria": TableRules(
        key=("IDCategoria",),
        required=("Classificacao", "ClasseLuxo", "ValorDiariaBase", "Tracao4x4"),
        checks=(
            one_of("ClasseLuxo", *C.LUXURY_LETTERS),
            at_least("ValorDiariaBase", 0),
        ),
    ),
    "G4.Veiculo": TableRules(
        key=("IDVeiculo",),
        unique=(("Placa",), ("Chassi",)),
        references={
            "IDCategoria": ("G4.Categoria", "IDCategoria"),
        },
        required=(
            "Placa",
            "Chassi",
            "Modelo",
            "Ano",
            "Altura",
            "Largura",
            "Portas",
            "UltimaKilometragem",
            "ArCondicionado",
            "CadeiraInfantil",
            "BebeConforto",
            "ValorDiaria",
            "IDCategoria",
        ),
        checks=(
            at_least("Ano", 1900),
            above("Portas", 0),
            at_least("UltimaKilometragem", 0),
            at_least("ValorDiaria", 0),
            above("Altura", 0),
            above("Largura", 0),
        ),
    ),
    "G4.PessoaFisica": TableRules(
        key=("IDFisica",),
        unique=(("CPF",),),
        references={
            "IDEndereco": ("G4.Endereco", "IDEndereco"),
        },
        required=("CPF", "Nome", "DtNascimento", "RG", "Telefone", "IDEndereco"),
        checks=(
            length("CPF", 11),
            past("DtNascimento"),
        ),
    ),
    "G4.Empresa": TableRules(
        key=("IDEmpresa",),
        unique=(("CNPJ",),),
        references={
            "IDEndereco": ("G4.Endereco", "IDEndereco"),
        },
        required=("CNPJ", "RazaoSocial", "DtAbertura", "Telefone", "IDEndereco"),
        checks=(
            length("CNPJ", 14),
        ),
    ),
    "G4.Motorista": TableRules(
        key=("IDMotorista",),
        unique=(("CNH",), ("IDFisica",)),
        references={
            "IDFisica": ("G4.PessoaFisica", "IDFisica"),
        },
        required=("CNH", "CategoriaCNH", "IDFisica"),
        checks=(
            one_of("CategoriaCNH", *LICENCES),
        ),
    ),
    "G4.CentroCusto": TableRules(
        key=("IDCentroCusto",),
        references={
            "IDEmpresa": ("G4.Empresa", "IDEmpresa"),
            "IDFisica": ("G4.PessoaFisica", "IDFisica"),
            "IDResponsavel": ("G4.PessoaFisica", "IDFisica"),
        },
        required=("IDResponsavel",),
        checks=(
            exactly_one("titular", "IDEmpresa", "IDFisica"),
        ),
    ),
    "G4.Movimentacao": TableRules(
        key=("IDMovimentacao",),
        references={
            "IDVeiculo": ("G4.Veiculo", "IDVeiculo"),
            "IDVagaOrigem": ("G4.Vaga", "IDVaga"),
            "IDVagaDestino": ("G4.Vaga", "IDVaga"),
        },
        required=("DtChegada", "DtRetirada", "IDVeiculo", "IDVagaOrigem"),
        checks=(
            not_before("DtChegada", "DtRetirada"),
        ),
    ),
    "G4.Reserva": TableRules(
        key=("IDReserva",),
        references={
            "IDCentroCusto": ("G4.CentroCusto", "IDCentroCusto"),
        },
        required=(
            "QtVeiculosSolicitados",
            "DtReserva",
            "DtRetiradaPrevista",
            "DtLimiteRetirada",
            "Status",
            "IDCentroCusto",
        ),
        checks=(
            at_least("QtVeiculosSolicitados", 1),
            after("DtLimiteRetirada", "DtRetiradaPrevista"),
            one_of("Status", "Confirmada", "Cancelada", "Atendida"),
        ),
    ),
    "G4.Locacao": TableRules(
        key=("IDLocacao",),
        references={
            "IDVagaRetirada": ("G4.Vaga", "IDVaga"),
            "IDVagaDevolvida": ("G4.Vaga", "IDVaga"),
            "IDVeiculo": ("G4.Veiculo", "IDVeiculo"),
            "IDReserva": ("G4.Reserva", "IDReserva"),
            "IDMotorista": ("G4.Motorista", "IDMotorista"),
        },
        required=("ValorDiaria", "DtRetirada", "IDVagaRetirada", "IDVeiculo", "IDReserva", "IDMotorista"),
        checks=(
            above("ValorDiaria", 0),
            not_before("DtChegada", "DtRetirada"),
        ),
    ),
    "G4.Prontuario": TableRules(
        key=("IDProntuario",),
        references={
            "IDEndereco": ("G4.Endereco", "IDEndereco"),
            "IDVeiculo": ("G4.Veiculo", "IDVeiculo"),
        },
        required=("Operacao", "Custo", "IDEndereco", "IDVeiculo"),
        checks=(
            at_least("Custo", 0),
        ),
    ),
    "G4.Avaria": TableRules(
        key=("IDAvaria",),
        references={
            "IDLocacao": ("G4.Locacao", "IDLocacao"),
            "IDVeiculo": ("G4.Veiculo", "IDVeiculo"),
            "IDProntuarioRelacionado": ("G4.Prontuario", "IDProntuario"),
        },
        required=("DtRegistro", "Descricao", "IDLocacao", "IDVeiculo"),
        checks=(
            not_future("DtRegistro"),
        ),
    ),
}

DW = {
    "DW.dim_tempo": TableRules(
        key=("sk_tempo",),
        unique=(("data_completa",),),
        required=(
            "data_completa",
            "dia",
            "mes",
            "trimestre",
            "semestre",
            "ano",
            "num_semana_ano",
            "dia_semana_num",
            "dia_semana_nome",
            "nome_mes",
            "eh_fim_semana",
        ),
    ),
    "DW.dim_patio": TableRules(
        key=("sk_patio",),
        required=("id_patio_orig", "nome_patio", "empresa_dona", "fonte_grupo"),
        checks=(
            at_most("nome_patio", 100),
            at_most("empresa_dona", 100),
            at_most("cidade", 100),
            at_most("uf", 2),
        ),
    ),
    "DW.dim_empresa": TableRules(
        key=("sk_empresa",),
        required=("nome_empresa", "fonte_grupo"),
        checks=(
            at_most("nome_empresa", 150),
        ),
    ),
    "DW.dim_grupo_veiculo": TableRules(
        key=("sk_grupo",),
        required=("id_grupo_orig", "nome_grupo", "fonte_grupo"),
        checks=(
            at_most("nome_grupo", 100),
        ),
    ),
    "DW.dim_veiculo": TableRules(
        key=("sk_veiculo",),
        references={
            "sk_grupo": ("DW.dim_grupo_veiculo", "sk_grupo"),
            "sk_empresa_origem": ("DW.dim_empresa", "sk_empresa"),
        },
        required=("id_veiculo_orig", "sk_grupo", "fonte_grupo"),
        checks=(
            at_most("placa", 10),
            at_most("chassi", 17),
            at_most("marca", 60),
            at_most("modelo", 60),
        ),
    ),
    "DW.dim_cliente": TableRules(
        key=("sk_cliente",),
        required=("id_cliente_orig", "nome", "fonte_grupo"),
        checks=(
            at_most("nome", 200),
            at_most("cpf_cnpj", 14),
            at_most("tipo_pessoa", 2),
            at_most("uf_origem", 2),
        ),
    ),
    "DW.fato_locacao": TableRules(
        key=("sk_locacao",),
        references={
            "sk_tempo_retirada": ("DW.dim_tempo", "sk_tempo"),
            "sk_tempo_devolucao": ("DW.dim_tempo", "sk_tempo"),
            "sk_cliente": ("DW.dim_cliente", "sk_cliente"),
            "sk_veiculo": ("DW.dim_veiculo", "sk_veiculo"),
            "sk_grupo": ("DW.dim_grupo_veiculo", "sk_grupo"),
            "sk_patio_retirada": ("DW.dim_patio", "sk_patio"),
            "sk_patio_entrega": ("DW.dim_patio", "sk_patio"),
            "sk_empresa_veiculo": ("DW.dim_empresa", "sk_empresa"),
        },
        required=(
            "id_locacao_orig",
            "sk_tempo_retirada",
            "sk_cliente",
            "sk_veiculo",
            "sk_grupo",
            "sk_patio_retirada",
            "locacao_intercompanhia",
            "fonte_grupo",
        ),
    ),
    "DW.fato_reserva": TableRules(
        key=("sk_reserva",),
        references={
            "sk_tempo_solicitacao": ("DW.dim_tempo", "sk_tempo"),
            "sk_tempo_retirada_prev": ("DW.dim_tempo", "sk_tempo"),
            "sk_tempo_devolucao_prev": ("DW.dim_tempo", "sk_tempo"),
            "sk_cliente": ("DW.dim_cliente", "sk_cliente"),
            "sk_grupo": ("DW.dim_grupo_veiculo", "sk_grupo"),
            "sk_patio_retirada": ("DW.dim_patio", "sk_patio"),
            "sk_patio_devolucao": ("DW.dim_patio", "sk_patio"),
        },
        required=(
            "id_reserva_orig",
            "sk_tempo_solicitacao",
            "sk_tempo_retirada_prev",
            "sk_tempo_devolucao_prev",
            "sk_cliente",
            "sk_grupo",
            "sk_patio_retirada",
            "fonte_grupo",
        ),
    ),
    "DW.fato_patio_snapshot": TableRules(
        key=("sk_snapshot",),
        references={
            "sk_tempo": ("DW.dim_tempo", "sk_tempo"),
            "sk_patio": ("DW.dim_patio", "sk_patio"),
            "sk_veiculo": ("DW.dim_veiculo", "sk_veiculo"),
            "sk_grupo": ("DW.dim_grupo_veiculo", "sk_grupo"),
            "sk_empresa_veiculo": ("DW.dim_empresa", "sk_empresa"),
        },
        required=("sk_tempo", "sk_patio", "sk_veiculo", "sk_grupo", "origem_veiculo", "fonte_grupo"),
        checks=(
            one_of("origem_veiculo", C.OWN, C.FOREIGN),
        ),
    ),
}

CATALOG = {**G1, **G2, **G3, **G4, **DW}
