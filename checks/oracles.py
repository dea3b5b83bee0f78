"""SQL counterparts of the registered queries, written directly over the given tables."""

from __future__ import annotations


def days(a: str, b: str) -> str:
    """Whole days from a to b."""
    return f"CAST(extract('day' FROM ({b}) - ({a})) AS INTEGER)"


# The rental roles as common table expressions; each query uses those it names.
ROLES = f"""
WITH RECURSIVE fontes AS (SELECT * FROM (VALUES ('G1'), ('G2'), ('G3'), ('G4')) t(fonte)),
lugar AS (
  SELECT n_nationkey AS id, n_name AS nome, r_name AS dono, r_regionkey AS id_dono
  FROM nation JOIN region ON n_regionkey = r_regionkey),
marca AS (
  SELECT id, nome, diaria,
    CASE id % 4 WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' ELSE 'X' END AS letra,
    CASE id % 4 WHEN 1 THEN 'BASICO' WHEN 2 THEN 'INTERMEDIARIO' WHEN 3 THEN 'LUXO' ELSE 'SEM CLASSE' END AS palavra
  FROM (SELECT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id, p_brand AS nome,
          CAST(MIN(p_retailprice) AS DECIMAL(10,2)) AS diaria FROM part GROUP BY p_brand)),
peca AS (
  SELECT p_partkey AS id, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS grupo, p_size, p_name, p_type,
    'P' || p_partkey AS placa,
    CASE WHEN p_size = 13 THEN '9BO' ELSE '9BW' END || lpad(CAST(p_partkey AS VARCHAR), 14, '0') AS chassi,
    split_part(p_name, ' ', 1) AS cor
  FROM part),
pessoa AS (
  SELECT c_custkey AS id, 'G' || (1 + c_custkey % 4) AS fonte, c_name AS nome, n_name AS cidade, r_name AS regiao,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'PJ' ELSE 'PF' END AS tipo
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
pedido AS (
  SELECT *, retirada + to_days(CAST(1 + cliente % 14 AS INTEGER)) + to_hours(CAST(id % 10 AS INTEGER)) AS devolucao
  FROM (SELECT o_orderkey AS id, o_custkey AS cliente, 'G' || (1 + o_custkey % 4) AS fonte, o_orderstatus AS st,
          o_orderdate AS pedido_em, CAST(o_totalprice AS DECIMAL(10,2)) AS preco,
          o_orderdate + to_days(CAST(1 + o_orderkey % 30 AS INTEGER)) + to_hours(9) AS retirada,
          1 + o_orderkey % 25 AS grupo, o_orderkey % 25 AS patio, (o_orderkey + o_custkey) % 25 AS patio_dev
        FROM orders)),
loc AS (
  SELECT *, CASE WHEN feita THEN envio + to_days(1 + (q + linha) % 20) + to_hours(CAST(peca % 24 AS INTEGER)) END AS volta
  FROM (SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS pedido, o_custkey AS cliente,
          'G' || (1 + o_custkey % 4) AS fonte, l_partkey AS peca, l_suppkey AS vaga, l_linenumber AS linha,
          CAST(l_quantity AS INTEGER) AS q, CAST(l_extendedprice AS DECIMAL(10,2)) AS preco,
          l_linestatus = 'F' AS feita, CAST(s_nationkey AS BIGINT) AS patio, CAST(c_nationkey AS BIGINT) AS patio_dev,
          l_shipdate AS envio, l_shipdate + to_hours(l_linenumber) AS saida,
          l_shipdate + to_days(1 + CAST(l_quantity AS INTEGER) % 14) AS prevista
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey)),
dev3 AS (
  SELECT id, arg_min(volta, peca * 100000000 + vaga) AS volta,
    arg_min(patio_dev, peca * 100000000 + vaga) FILTER (WHERE peca % 13 <> 0) AS patio
  FROM loc WHERE feita GROUP BY id),
d_empresa AS (
  SELECT row_number() OVER (ORDER BY fonte, nome) AS sk, fonte, nome,
    CASE WHEN fonte IN ('G1', 'G4') THEN row_number() OVER (PARTITION BY fonte ORDER BY nome)
         WHEN fonte = 'G3' THEN id_dono END AS id
  FROM (SELECT DISTINCT fonte, CASE WHEN fonte = 'G2' THEN 'EMPRESA_G2' ELSE dono END AS nome,
          CASE WHEN fonte <> 'G2' THEN id_dono END AS id_dono FROM lugar CROSS JOIN fontes)),
d_patio AS (
  SELECT row_number() OVER (ORDER BY fonte, id) AS sk, fonte, id,
    CASE WHEN fonte = 'G2' THEN upper(nome) ELSE nome END AS nome,
    CASE WHEN fonte = 'G2' THEN 'EMPRESA_G2' ELSE dono END AS dono,
    CASE WHEN fonte IN ('G3', 'G4') THEN upper(nome) END AS cidade,
    CASE WHEN fonte IN ('G3', 'G4') THEN upper(substr(dono, 1, 2)) END AS uf
  FROM lugar CROSS JOIN fontes),
d_grupo AS (
  SELECT row_number() OVER (ORDER BY fonte, id) AS sk, fonte, id, nome, diaria,
    CASE WHEN fonte = 'G2' THEN 'C' || id END AS codigo,
    CASE WHEN fonte IN ('G1', 'G2') THEN palavra
         WHEN fonte = 'G4' THEN CASE WHEN letra = 'X' THEN 'DESCONHECIDO' ELSE palavra END END AS classe
  FROM marca CROSS JOIN fontes),
d_veiculo AS (
  SELECT row_number() OVER (ORDER BY p.fonte, p.id) AS sk, p.*, g.sk AS sk_grupo, e.sk AS sk_empresa
  FROM (SELECT fonte, peca.* FROM peca CROSS JOIN fontes WHERE NOT (fonte = 'G4' AND id % 23 = 0)) p
    JOIN d_grupo g ON g.fonte = p.fonte AND g.id = p.grupo
    LEFT JOIN d_empresa e ON e.fonte = p.fonte AND p.fonte = 'G2'),
d_cliente AS (
  SELECT row_number() OVER (ORDER BY fonte, id) AS sk, fonte, id, nome,
    CASE WHEN fonte IN ('G1', 'G2') THEN tipo ELSE 'PF' END AS tipo,
    CASE WHEN fonte = 'G3' AND id % 7 = 0 THEN NULL
         WHEN fonte = 'G2' AND tipo = 'PJ' THEN lpad(CAST(id AS VARCHAR), 14, '0')
         ELSE lpad(CAST(id AS VARCHAR), 11, '0') END AS documento,
    CASE WHEN fonte = 'G1' THEN 'NAO_INFORMADO' ELSE upper(cidade) END AS cidade,
    CASE WHEN fonte IN ('G3', 'G4') THEN upper(substr(regiao, 1, 2)) END AS uf
  FROM pessoa),
d_tempo AS (
  SELECT row_number() OVER (ORDER BY d) AS sk, d FROM (
    SELECT CAST(range AS DATE) AS d FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2006-01-01', INTERVAL 1 DAY))),
locacao AS (
  SELECT l.id, l.fonte, l.peca, CAST(l.saida AS DATE) AS d_saida, CAST(l.volta_real AS DATE) AS d_volta,
    CASE WHEN l.fonte = 'G1' AND l.peca % 10 = 0 THEN NULL
         WHEN l.fonte = 'G3' AND l.peca % 19 = 0 THEN NULL ELSE l.cliente END AS cliente,
    l.p_saida, l.p_volta, l.p_saida IS DISTINCT FROM l.p_volta AS inter,
    CASE WHEN l.fonte = 'G1' THEN {days('l.saida', 'l.prevista')}
         WHEN l.fonte = 'G2' AND l.peca % 10 <> 0 THEN {days('p.retirada', 'p.devolucao')}
         WHEN l.fonte = 'G3' AND l.peca % 19 <> 0 THEN {days('p.retirada', 'p.devolucao')} END AS previstos,
    {days('l.saida', 'l.volta_real')} AS reais,
    CASE WHEN l.fonte IN ('G2', 'G4') THEN l.preco END AS diaria,
    CASE WHEN l.fonte = 'G1' THEN CASE WHEN feita THEN l.preco END
         WHEN l.fonte = 'G3' THEN CASE WHEN l.peca % 19 <> 0 THEN p.preco END
         ELSE CAST(l.preco * {days('l.saida', 'l.volta_real')} AS DECIMAL(10,2)) END AS total,
    CASE WHEN l.fonte = 'G2' AND feita THEN q * 10 END AS km,
    CASE WHEN l.fonte = 'G2' AND feita AND l.peca % 11 = 0 THEN 'CANCELADA'
         WHEN l.volta_real IS NOT NULL THEN 'CONCLUIDA' ELSE 'EM_ANDAMENTO' END AS status
  FROM (SELECT loc.*, CASE WHEN fonte = 'G3' THEN dev3.volta ELSE loc.volta END AS volta_real,
          CASE WHEN fonte = 'G4' AND peca % 17 = 0 THEN NULL ELSE loc.patio END AS p_saida,
          CASE WHEN fonte = 'G3' THEN dev3.patio WHEN fonte = 'G2' OR feita THEN loc.patio_dev END AS p_volta
        FROM loc LEFT JOIN dev3 ON loc.fonte = 'G3' AND dev3.id = loc.id) l
    JOIN pedido p ON p.id = l.pedido),
resolvida AS (
  SELECT l.*, t1.sk AS sk_saida, t2.sk AS sk_volta, c.sk AS sk_cliente, v.sk AS sk_veiculo, v.sk_grupo,
    p1.sk AS sk_p_saida, p2.sk AS sk_p_volta,
    CASE WHEN l.fonte IN ('G1', 'G3') THEN g.diaria ELSE l.diaria END AS valor_diaria
  FROM locacao l
    LEFT JOIN d_tempo t1 ON t1.d = l.d_saida LEFT JOIN d_tempo t2 ON t2.d = l.d_volta
    LEFT JOIN d_cliente c ON c.fonte = l.fonte AND c.id = l.cliente
    LEFT JOIN d_veiculo v ON v.fonte = l.fonte AND v.id = l.peca
    LEFT JOIN d_grupo g ON g.sk = v.sk_grupo
    LEFT JOIN d_patio p1 ON p1.fonte = l.fonte AND p1.id = l.p_saida
    LEFT JOIN d_patio p2 ON p2.fonte = l.fonte AND p2.id = l.p_volta),
fl AS (
  SELECT * FROM resolvida
  WHERE sk_saida IS NOT NULL AND sk_cliente IS NOT NULL AND sk_veiculo IS NOT NULL AND sk_p_saida IS NOT NULL),
reserva AS (
  SELECT p.id, p.fonte, CASE WHEN p.fonte = 'G1' AND p.id % 9 = 0 THEN NULL ELSE p.grupo END AS grupo, p.cliente,
    p.patio, CASE WHEN p.fonte <> 'G1' THEN p.patio_dev END AS patio_dev, CAST(p.pedido_em AS DATE) AS d_pedido,
    CAST(p.retirada AS DATE) AS d_retirada, CAST(p.devolucao AS DATE) AS d_devolucao,
    {days('p.retirada', 'p.devolucao')} AS previstos,
    CASE WHEN p.fonte = 'G3' THEN CASE p.id % 4 WHEN 0 THEN 'EM_ANDAMENTO' WHEN 1 THEN 'CANCELADA'
                                       WHEN 2 THEN 'CONFIRMADA' ELSE 'DESCONHECIDO' END
         ELSE CASE p.st WHEN 'F' THEN 'CONFIRMADA' WHEN 'O' THEN 'EM_FILA_ESPERA' ELSE 'CANCELADA' END END AS status
  FROM pedido p WHERE p.fonte <> 'G4'),
fr AS (
  SELECT r.*, t1.sk AS sk_pedido, t2.sk AS sk_retirada, t3.sk AS sk_devolucao, c.sk AS sk_cliente, g.sk AS sk_grupo,
    p1.sk AS sk_patio, p2.sk AS sk_patio_dev
  FROM reserva r
    JOIN d_tempo t1 ON t1.d = r.d_pedido JOIN d_tempo t2 ON t2.d = r.d_retirada JOIN d_tempo t3 ON t3.d = r.d_devolucao
    JOIN d_cliente c ON c.fonte = r.fonte AND c.id = r.cliente
    JOIN d_grupo g ON g.fonte = r.fonte AND g.id = r.grupo
    JOIN d_patio p1 ON p1.fonte = r.fonte AND p1.id = r.patio
    LEFT JOIN d_patio p2 ON p2.fonte = r.fonte AND p2.id = r.patio_dev),
foto AS (
  SELECT t.sk AS sk_tempo, p.sk AS sk_patio, v.sk AS sk_veiculo, v.sk_grupo, v.sk_empresa, v.fonte,
    p.nome AS patio, p.dono,
    CASE WHEN p.dono = COALESCE(e.nome, p.dono) THEN 'PROPRIA' ELSE 'EXTERNA' END AS origem
  FROM d_veiculo v
    JOIN d_patio p ON p.fonte = v.fonte AND (v.fonte = 'G1' OR p.id = v.id % 25)
    JOIN d_tempo t ON t.d = DATE '2000-06-30'
    LEFT JOIN d_empresa e ON e.sk = v.sk_empresa
  WHERE v.fonte IN ('G1', 'G2') AND v.p_size % 3 = 0),
contagem AS (
  SELECT p1.nome AS origem, p2.nome AS destino, COUNT(*) AS n
  FROM fl JOIN d_patio p1 ON p1.sk = fl.sk_p_saida JOIN d_patio p2 ON p2.sk = fl.sk_p_volta
  WHERE status = 'CONCLUIDA' GROUP BY ALL),
matriz AS (
  SELECT origem, destino, n, total,
    CAST(((2 * n * 10000 + total) // (2 * total)) AS BIGINT) AS pct, CAST(((2 * n * 10000 + total) // (2 * total)) AS BIGINT) AS prob
  FROM contagem JOIN (SELECT origem, CAST(SUM(n) AS BIGINT) AS total FROM contagem GROUP BY origem) USING (origem))
"""

# Yard names are NATION_0..NATION_24 at every scale; the pivot has a column for each.
YARD_NAMES = sorted(f"NATION_{i}" for i in range(25))

BODIES = {
    "staging_row_counts": """
SELECT * FROM (
  SELECT lower(fonte) || '_patio' AS tabela, COUNT(*) AS linhas FROM lugar CROSS JOIN fontes GROUP BY fonte
  UNION ALL SELECT CASE fonte WHEN 'G1' THEN 'g1_grupo_veiculo' WHEN 'G4' THEN 'g4_categoria' ELSE lower(fonte) || '_grupo' END, COUNT(*)
    FROM marca CROSS JOIN fontes GROUP BY fonte
  UNION ALL SELECT lower(fonte) || '_veiculo', COUNT(*) FROM peca CROSS JOIN fontes GROUP BY fonte
  UNION ALL SELECT CASE WHEN fonte = 'G4' THEN 'g4_motorista' ELSE lower(fonte) || '_cliente' END, COUNT(*) FROM pessoa GROUP BY fonte
  UNION ALL SELECT lower(fonte) || '_reserva', COUNT(*) FROM pedido GROUP BY fonte
  UNION ALL SELECT lower(fonte) || '_locacao', COUNT(*) FROM loc GROUP BY fonte
  UNION ALL SELECT 'g3_devolucao', COUNT(*) FROM loc WHERE fonte = 'G3' AND feita
  UNION ALL SELECT fonte || '_vaga', (SELECT COUNT(*) FROM supplier) + (SELECT COUNT(*) FROM nation) FROM (VALUES ('g3'), ('g4')) t(fonte))
""",
    "incremental_extract": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
""",
    "subclass_flatten": """
SELECT id AS id_cliente, tipo AS tipo_pessoa, nome, '  ' || lower(cidade) || ' ' AS cidade_origem,
  CASE WHEN tipo = 'PF' THEN lpad(CAST(id AS VARCHAR), 11, '0') END AS cpf,
  CASE WHEN tipo = 'PF' THEN DATE '1960-01-01' + CAST(id % 10000 AS INTEGER) END AS data_nascimento,
  CASE WHEN tipo = 'PJ' THEN lpad(CAST(id AS VARCHAR), 14, '0') END AS cnpj
FROM pessoa
""",
    "denormalize_yards": """
SELECT fonte AS fonte_grupo, CAST(id AS BIGINT) AS id_patio, nome, dono AS empresa, '  ' || lower(nome) || ' ' AS cidade,
  lower(substr(dono, 1, 2)) AS uf
FROM lugar CROSS JOIN fontes WHERE fonte IN ('G3', 'G4')
""",
    "denormalize_clients": """
SELECT t.fonte AS fonte_grupo, id, nome,
  CASE WHEN t.fonte = 'G4' OR id % 7 <> 0 THEN lpad(CAST(id AS VARCHAR), 11, '0') END AS cpf,
  '  ' || lower(cidade) || ' ' AS cidade, lower(substr(regiao, 1, 2)) AS uf
FROM pessoa CROSS JOIN (VALUES ('G3'), ('G4')) t(fonte)
""",
    "conform_transmission": """
SELECT fonte AS fonte_grupo, id AS id_veiculo,
  CASE fonte WHEN 'G1' THEN CASE WHEN p_size % 5 IN (0, 1, 2) THEN 'AUTOMATICA' ELSE 'MANUAL' END
             WHEN 'G2' THEN CASE WHEN p_size % 2 = 0 THEN 'AUTOMATICA' ELSE 'MANUAL' END
             ELSE CASE WHEN p_size % 5 <> 4 AND p_size % 2 = 0 THEN 'AUTOMATICA' ELSE 'MANUAL' END END AS mecanizacao
FROM peca CROSS JOIN fontes WHERE fonte <> 'G4'
""",
    "conform_text": """
SELECT 'g1_patio.nome_localizacao' AS coluna, CAST(id AS BIGINT) AS id, nome AS valor FROM lugar
UNION ALL SELECT 'g1_reserva.status_reserva', id, CASE st WHEN 'F' THEN 'CONFIRMADA' WHEN 'O' THEN 'EM_FILA_ESPERA' ELSE 'CANCELADA' END FROM pedido
UNION ALL SELECT 'g2_patio.nome', id, upper(nome) FROM lugar
UNION ALL SELECT 'g2_grupo.classe_luxo', id, palavra FROM marca
UNION ALL SELECT 'g2_cliente.cidade_origem', id, upper(cidade) FROM pessoa
UNION ALL SELECT 'g2_locacao.status', id, CASE WHEN NOT feita THEN 'EM_ANDAMENTO' WHEN peca % 11 = 0 THEN 'CANCELADA' ELSE 'CONCLUIDA' END FROM loc
UNION ALL SELECT t || '_patio.cidade', id, upper(nome) FROM lugar CROSS JOIN (VALUES ('g3'), ('g4')) x(t)
UNION ALL SELECT t || '_patio.uf', id, substr(dono, 1, 2) FROM lugar CROSS JOIN (VALUES ('g3'), ('g4')) x(t)
UNION ALL SELECT t || '.cidade', id, upper(cidade) FROM pessoa CROSS JOIN (VALUES ('g3_cliente'), ('g4_motorista')) x(t)
UNION ALL SELECT t || '.uf', id, substr(regiao, 1, 2) FROM pessoa CROSS JOIN (VALUES ('g3_cliente'), ('g4_motorista')) x(t)
""",
    "infer_status": """
SELECT t.fonte AS fonte_grupo, loc.id AS id_locacao,
  CASE WHEN CASE WHEN t.fonte = 'G3' THEN dev3.volta ELSE loc.volta END IS NOT NULL THEN 'CONCLUIDA' ELSE 'EM_ANDAMENTO' END AS status
FROM loc LEFT JOIN dev3 ON dev3.id = loc.id CROSS JOIN (VALUES ('G1'), ('G3'), ('G4')) t(fonte)
""",
    "rental_duration": """
SELECT fonte AS fonte_grupo, id AS id_locacao, reais AS duracao_dias_real,
  CASE WHEN fonte = 'G1' THEN previstos END AS duracao_dias_prevista
FROM locacao
""",
    "update_from_lookup": f"""
SELECT loc.id AS id_locacao, CASE WHEN peca % 10 <> 0 THEN loc.pedido END AS reserva_id,
  CASE WHEN peca % 10 <> 0 THEN {days('p.retirada', 'p.devolucao')} END AS duracao_dias_prevista
FROM loc JOIN pedido p ON p.id = loc.pedido
""",
    "km_driven": """
SELECT id AS id_locacao, CAST(peca % 1000 AS INTEGER) AS km_saida,
  CASE WHEN feita THEN CAST(peca % 1000 + q * 10 AS INTEGER) END AS km_chegada,
  CASE WHEN feita THEN q * 10 END AS km_percorridos
FROM loc
""",
    "conform_status_code": f"""
SELECT id AS id_reserva, CAST(id % 4 AS INTEGER) AS estado_reserva,
  CASE id % 4 WHEN 0 THEN 'EM_ANDAMENTO' WHEN 1 THEN 'CANCELADA' WHEN 2 THEN 'CONFIRMADA' ELSE 'DESCONHECIDO' END AS status_conformado,
  {days('retirada', 'devolucao')} AS duracao_prevista_dias
FROM pedido
""",
    "resolve_return_yard": """
SELECT loc.id AS id_locacao, loc.patio AS id_patio, dev3.patio AS id_patio_entrega
FROM loc LEFT JOIN dev3 ON dev3.id = loc.id
""",
    "resolve_return_date": """
SELECT loc.id AS id_locacao, loc.saida AS data_locacao, dev3.volta AS data_devolucao
FROM loc LEFT JOIN dev3 ON dev3.id = loc.id
""",
    "slot_to_yard": """
SELECT id AS id_locacao, CASE WHEN peca % 17 = 0 THEN vaga + 2000000000000 ELSE vaga END AS id_vaga_retirada,
  CASE WHEN peca % 17 <> 0 THEN patio END AS id_patio_retirada,
  CASE WHEN feita THEN 1000000000000 + patio_dev END AS id_vaga_devolvida,
  CASE WHEN feita THEN patio_dev END AS id_patio_entrega
FROM loc
""",
    "conform_luxury_class": """
SELECT id AS id_categoria, letra AS classe_luxo, CASE WHEN letra = 'X' THEN 'DESCONHECIDO' ELSE palavra END AS classe_luxo_conf
FROM marca
""",
    "surrogate_keys": """
SELECT fonte AS fonte_grupo, id, row_number() OVER (ORDER BY fonte, id) AS sk FROM pedido
""",
    "surrogate_keys_reload": """
SELECT fonte AS fonte_grupo, id, row_number() OVER (ORDER BY CASE WHEN fonte IN ('G3', 'G4') THEN 0 ELSE 1 END, fonte, id) AS sk
FROM pedido
""",
    "dim_date": """
SELECT row_number() OVER (ORDER BY d) AS sk_tempo, d AS data_completa, CAST(day(d) AS INTEGER) AS dia,
  CAST(month(d) AS INTEGER) AS mes, CAST(quarter(d) AS INTEGER) AS trimestre,
  CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre, CAST(year(d) AS INTEGER) AS ano,
  CAST(weekofyear(d) AS INTEGER) AS num_semana_ano, CAST(dayofweek(d) + 1 AS INTEGER) AS dia_semana_num,
  rpad(dayname(d), 9, ' ') AS dia_semana_nome, rpad(monthname(d), 9, ' ') AS nome_mes,
  dayofweek(d) IN (0, 6) AS eh_fim_semana
FROM (SELECT CAST(unnest(range(date_trunc('year', a), date_trunc('year', b) + INTERVAL 2 YEAR, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(MIN(t) AS TIMESTAMP) AS a, CAST(MAX(t) AS TIMESTAMP) AS b
            FROM (SELECT l_shipdate AS t FROM lineitem UNION ALL SELECT o_orderdate FROM orders)))
""",
    "dim_company": """
SELECT sk AS sk_empresa, CAST(id AS BIGINT) AS id_empresa_orig, nome AS nome_empresa, CAST(NULL AS VARCHAR) AS cnpj,
  fonte AS fonte_grupo
FROM d_empresa
""",
    "dim_yard": """
SELECT sk AS sk_patio, CAST(id AS BIGINT) AS id_patio_orig, nome AS nome_patio, dono AS empresa_dona, cidade, uf, fonte AS fonte_grupo
FROM d_patio
""",
    "dim_vehicle_group": """
SELECT sk AS sk_grupo, id AS id_grupo_orig, codigo AS codigo_grupo, nome AS nome_grupo, classe AS classe_luxo,
  diaria AS valor_diaria, fonte AS fonte_grupo
FROM d_grupo
""",
    "dim_vehicle": """
SELECT sk AS sk_veiculo, id AS id_veiculo_orig, placa, chassi, CASE WHEN fonte <> 'G4' THEN p_type END AS marca,
  p_name AS modelo, CASE WHEN fonte <> 'G1' THEN CAST(2000 + p_size % 20 AS INTEGER) END AS ano_fabricacao,
  CASE WHEN fonte <> 'G4' THEN cor END AS cor,
  CASE fonte WHEN 'G1' THEN CASE WHEN p_size % 5 IN (0, 1, 2) THEN 'AUTOMATICA' ELSE 'MANUAL' END
             WHEN 'G2' THEN CASE WHEN p_size % 2 = 0 THEN 'AUTOMATICA' ELSE 'MANUAL' END
             WHEN 'G3' THEN CASE WHEN p_size % 5 <> 4 AND p_size % 2 = 0 THEN 'AUTOMATICA' ELSE 'MANUAL' END END AS mecanizacao,
  p_size % 2 = 1 AS ar_condicionado, sk_grupo, sk_empresa AS sk_empresa_origem, fonte AS fonte_grupo
FROM d_veiculo
""",
    "dim_client": """
SELECT sk AS sk_cliente, id AS id_cliente_orig, nome, tipo AS tipo_pessoa, documento AS cpf_cnpj, cidade AS cidade_origem,
  uf AS uf_origem, CAST(NULL AS VARCHAR) AS nacionalidade, fonte AS fonte_grupo
FROM d_cliente
""",
    "fact_rental": """
SELECT id AS id_locacao_orig, sk_saida AS sk_tempo_retirada, sk_volta AS sk_tempo_devolucao, sk_cliente, sk_veiculo, sk_grupo,
  sk_p_saida AS sk_patio_retirada, sk_p_volta AS sk_patio_entrega, CAST(NULL AS BIGINT) AS sk_empresa_veiculo,
  previstos AS duracao_dias_prevista, reais AS duracao_dias_real, valor_diaria, total AS valor_total,
  km AS km_percorridos, inter AS locacao_intercompanhia, status AS status_locacao, fonte AS fonte_grupo
FROM fl
""",
    "fact_reservation": """
SELECT id AS id_reserva_orig, sk_pedido AS sk_tempo_solicitacao, sk_retirada AS sk_tempo_retirada_prev,
  sk_devolucao AS sk_tempo_devolucao_prev, sk_cliente, sk_grupo, sk_patio AS sk_patio_retirada,
  sk_patio_dev AS sk_patio_devolucao, previstos AS duracao_prevista_dias, status AS status_reserva, fonte AS fonte_grupo
FROM fr
""",
    "intercompany_flag": """
SELECT fonte AS fonte_grupo, id AS id_locacao_orig, p_saida AS id_patio_retirada, p_volta AS id_patio_entrega,
  inter AS locacao_intercompanhia
FROM locacao
""",
    "yard_snapshot": """
SELECT sk_tempo, sk_patio, sk_veiculo, sk_grupo, sk_empresa AS sk_empresa_veiculo, origem AS origem_veiculo, fonte AS fonte_grupo
FROM foto
""",
    "own_or_foreign": """
SELECT p_partkey AS id_veiculo, dono, r_name AS nome_empresa,
  CASE WHEN r_name IS NULL OR r_name = dono THEN 'PROPRIA' ELSE 'EXTERNA' END AS origem_veiculo
FROM part JOIN lugar ON lugar.id = p_partkey % 25 LEFT JOIN region ON p_size % 7 <> 0 AND r_regionkey = p_partkey % 5
""",
    "loaded_row_counts": """
SELECT 'dim_patio' AS tabela, COUNT(*) AS linhas FROM d_patio
UNION ALL SELECT 'dim_empresa', COUNT(*) FROM d_empresa
UNION ALL SELECT 'dim_grupo_veiculo', COUNT(*) FROM d_grupo
UNION ALL SELECT 'dim_veiculo', COUNT(*) FROM d_veiculo
UNION ALL SELECT 'dim_cliente', COUNT(*) FROM d_cliente
UNION ALL SELECT 'fato_locacao', COUNT(*) FROM fl
UNION ALL SELECT 'fato_reserva', COUNT(*) FROM fr
UNION ALL SELECT 'fato_patio_snapshot', COUNT(*) FROM foto
UNION ALL SELECT 'fato_locacao:rejeitos', (SELECT COUNT(*) FROM locacao) - (SELECT COUNT(*) FROM fl)
UNION ALL SELECT 'fato_reserva:rejeitos', (SELECT COUNT(*) FROM reserva) - (SELECT COUNT(*) FROM fr)
""",
    "settled_rejects": """
SELECT fl.fonte AS fonte_grupo, fl.id AS id_locacao_orig, c.id AS id_cliente_orig, reais AS duracao_dias_real,
  total AS valor_total, status AS status_locacao
FROM fl JOIN d_cliente c ON c.sk = fl.sk_cliente
""",
    "report_a_yard_control": """
SELECT patio, dono AS empresa_dona_patio, g.nome AS grupo_veiculo, g.classe AS classe_luxo, origem,
  DATE '2000-06-30' AS data_snapshot, COUNT(*) AS total_veiculos
FROM foto JOIN d_grupo g ON g.sk = foto.sk_grupo GROUP BY ALL
""",
    "report_b_rental_control": """
SELECT g.nome AS grupo_veiculo, g.classe AS classe_luxo, status, COUNT(*) AS total_locacoes,
  AVG(reais) AS media_dias_duracao, MAX(reais) AS max_dias, MIN(reais) AS min_dias,
  AVG(CASE WHEN status = 'EM_ANDAMENTO' THEN previstos - (DATE '2000-06-30' - d_saida) END) AS media_dias_restantes,
  SUM(COALESCE(total, 0)) AS receita_total
FROM fl JOIN d_grupo g ON g.sk = fl.sk_grupo GROUP BY g.nome, g.classe, status
""",
    "report_b_monthly": """
SELECT CAST(year(d_saida) AS INTEGER) AS ano, CAST(month(d_saida) AS INTEGER) AS mes, rpad(monthname(d_saida), 9, ' ') AS nome_mes,
  g.nome AS nome_grupo, COUNT(*) AS total_locacoes, CAST(SUM(reais) AS BIGINT) AS total_dias_locados, SUM(total) AS receita_mes
FROM fl JOIN d_grupo g ON g.sk = fl.sk_grupo WHERE status = 'CONCLUIDA' GROUP BY 1, 2, 3, 4
""",
    "report_c_reservations": """
SELECT g.nome AS grupo_veiculo, p.nome AS patio_retirada, c.cidade AS cidade_cliente, c.uf AS uf_cliente,
  CAST(year(d_retirada) AS INTEGER) AS ano_retirada_prevista, CAST(month(d_retirada) AS INTEGER) AS mes_retirada_prevista,
  rpad(monthname(d_retirada), 9, ' ') AS nome_mes_retirada, status, COUNT(*) AS total_reservas,
  AVG(previstos) AS media_duracao_prevista
FROM fr JOIN d_grupo g ON g.sk = fr.sk_grupo JOIN d_patio p ON p.sk = fr.sk_patio JOIN d_cliente c ON c.sk = fr.sk_cliente
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
""",
    "report_c_next_week": """
SELECT g.nome AS nome_grupo, p.nome AS nome_patio, c.cidade AS cidade_origem, COUNT(*) AS reservas_proxima_semana
FROM fr JOIN d_grupo g ON g.sk = fr.sk_grupo JOIN d_patio p ON p.sk = fr.sk_patio JOIN d_cliente c ON c.sk = fr.sk_cliente
WHERE d_retirada BETWEEN DATE '2000-06-30' AND DATE '2000-07-07' AND status NOT IN ('CANCELADA')
GROUP BY 1, 2, 3
""",
    "report_d_group_by_city": """
SELECT c.cidade AS cidade_cliente, c.uf AS uf_cliente, g.nome AS grupo_veiculo, g.classe AS classe_luxo,
  COUNT(*) AS total_locacoes, CAST(SUM(reais) AS BIGINT) AS total_dias_locados, SUM(total) AS receita_total,
  CAST(CAST((2 * CAST(SUM(total) * 100 AS HUGEINT) + COUNT(total)) // (2 * COUNT(total)) AS DECIMAL(28,0)) * 0.01 AS DECIMAL(28,2)) AS ticket_medio
FROM fl JOIN d_cliente c ON c.sk = fl.sk_cliente JOIN d_grupo g ON g.sk = fl.sk_grupo
WHERE status = 'CONCLUIDA' GROUP BY 1, 2, 3, 4
""",
    "report_d_group_ranking": """
SELECT g.nome AS nome_grupo, g.classe AS classe_luxo, COUNT(*) AS total_locacoes, SUM(total) AS receita_total
FROM fl JOIN d_grupo g ON g.sk = fl.sk_grupo WHERE status = 'CONCLUIDA' GROUP BY 1, 2
""",
    "rental_count": "SELECT COUNT(*) AS total FROM fl",
    "markov_counts": "SELECT origem AS patio_origem, destino AS patio_destino, n AS total_transicoes FROM contagem",
    "markov_departures": """
SELECT p.nome AS patio_origem, COUNT(*) AS total_saidas FROM fl JOIN d_patio p ON p.sk = fl.sk_p_saida
WHERE status = 'CONCLUIDA' AND sk_p_volta IS NOT NULL GROUP BY p.nome
""",
    "markov_matrix": """
SELECT origem AS patio_origem, destino AS patio_destino, n AS total_transicoes, total AS total_saidas,
  CAST(pct * 0.01 AS DECIMAL(7,2)) AS percentual, CAST(prob * 0.0001 AS DECIMAL(7,4)) AS probabilidade
FROM matriz
""",
    "markov_pivot": "SELECT origem AS patio_origem, "
    + ", ".join(
        f"MAX(CASE WHEN destino = '{n}' THEN CAST(prob * 0.0001 AS DECIMAL(7,4)) END) AS \"{n}\"" for n in YARD_NAMES
    )
    + " FROM matriz GROUP BY origem",
    "markov_row_check": """
SELECT origem AS patio_origem, CAST(SUM(prob) * 0.0001 AS DECIMAL(12,4)) AS soma_probabilidades,
  CASE WHEN ABS(SUM(prob) - 10000) < 10 THEN 'OK ✓' ELSE 'ERRO — linha não soma 1' END AS validacao
FROM matriz GROUP BY origem
""",
    "markov_steady_state": """,
passos AS (
  SELECT 0 AS passo, nome AS patio, 1.0::DOUBLE / COUNT(*) OVER () AS p FROM (SELECT DISTINCT nome FROM d_patio)
  UNION ALL
  SELECT passo + 1, destino, SUM(p * prob / 10000.0::DOUBLE) FROM passos JOIN matriz ON origem = patio WHERE passo < 10
  GROUP BY passo, destino)
SELECT patio, CAST(ROUND(p * 100, 2) AS DECIMAL(10,2)) AS percentual_equilibrio FROM passos WHERE passo = 10
""",
    "markov_converged": """,
passos AS (
  SELECT 0 AS passo, nome AS patio, 1.0::DOUBLE / COUNT(*) OVER () AS p FROM (SELECT DISTINCT nome FROM d_patio)
  UNION ALL
  SELECT passo + 1, destino, SUM(p * prob / 10000.0::DOUBLE) FROM passos JOIN matriz ON origem = patio WHERE passo < 10
  GROUP BY passo, destino)
SELECT patio, CAST(ROUND(p * 100, 2) AS DECIMAL(10,2)) AS percentual_equilibrio, TRUE AS convergiu FROM passos WHERE passo = 10
""",
    "markov_classes": """,
mov AS (
  SELECT origem, destino FROM matriz WHERE prob > 0
  UNION SELECT destino, destino FROM matriz
  WHERE prob > 0 AND destino NOT IN (SELECT origem FROM matriz WHERE prob > 0)),
andar AS (
  SELECT 1 AS passo, origem AS de, destino AS ate FROM mov
  UNION SELECT passo + 1, de, destino FROM andar JOIN mov ON origem = ate WHERE passo < 25),
nomes AS (SELECT origem AS y FROM mov UNION SELECT destino FROM mov),
alcance AS (SELECT de, ate FROM andar UNION SELECT y, y FROM nomes),
cl AS (SELECT a.de AS y, MIN(a.ate) AS classe FROM alcance a JOIN alcance b ON b.de = a.ate AND b.ate = a.de GROUP BY a.de),
saida AS (
  SELECT a.classe, BOOL_AND(a.classe = b.classe) AS fechada
  FROM mov JOIN cl a ON a.y = origem JOIN cl b ON b.y = destino GROUP BY a.classe),
ciclo AS (SELECT DISTINCT classe, passo FROM andar JOIN cl ON y = de WHERE de = ate),
divisor AS (SELECT classe, d FROM ciclo, range(1, 26) r(d) GROUP BY classe, d HAVING BOOL_AND(passo % d = 0))
SELECT y AS patio, classe, fechada, CAST((SELECT MAX(d) FROM divisor x WHERE x.classe = cl.classe) AS INTEGER) AS periodo
FROM cl JOIN saida USING (classe)
""",
    "markov_long_run": """,
mov AS (
  SELECT origem, destino, prob::DOUBLE / SUM(prob) OVER (PARTITION BY origem) AS w FROM matriz WHERE prob > 0
  UNION ALL SELECT DISTINCT destino, destino, 1.0::DOUBLE FROM matriz
  WHERE prob > 0 AND destino NOT IN (SELECT origem FROM matriz WHERE prob > 0)),
meio AS (SELECT origem, destino, w / 2 AS w FROM mov UNION ALL SELECT DISTINCT origem, origem, 0.5::DOUBLE FROM mov),
passos AS (
  SELECT 0 AS passo, origem AS patio, 1.0::DOUBLE / COUNT(*) OVER () AS p FROM (SELECT DISTINCT origem FROM mov)
  UNION ALL
  SELECT passo + 1, destino, SUM(p * w) FROM passos JOIN meio ON origem = patio WHERE passo < 300 GROUP BY passo, destino)
SELECT patio, CAST(ROUND(p, 6) AS DECIMAL(10,6)) AS parcela FROM passos WHERE passo = 300
""",
    "src_vehicles_by_yard": """
SELECT upper(l.nome) AS patio, 'C' || p.grupo AS grupo, COUNT(*) AS total
FROM peca p JOIN lugar l ON l.id = p.id % 25 JOIN marca m ON m.id = p.grupo WHERE p_size % 3 = 0 GROUP BY 1, 2
""",
    "src_active_rentals": """
SELECT 'C' || p.grupo AS grupo, COUNT(*) AS total_locacoes FROM loc JOIN peca p ON p.id = loc.peca
WHERE NOT feita GROUP BY 1
""",
    "src_open_reservations": """
SELECT 'C' || o.grupo AS grupo, upper(l.nome) AS patio_retirada, upper(p.cidade) AS cidade_origem, COUNT(*) AS total
FROM pedido o JOIN marca m ON m.id = o.grupo JOIN lugar l ON l.id = o.patio JOIN pessoa p ON p.id = o.cliente
WHERE o.st IN ('F', 'O') GROUP BY 1, 2, 3
""",
    "src_groups_by_city": """
SELECT upper(c.cidade) AS cidade_origem, 'C' || p.grupo AS grupo, COUNT(*) AS total_locacoes
FROM loc JOIN peca p ON p.id = loc.peca JOIN pessoa c ON c.id = loc.cliente GROUP BY 1, 2
""",
    "src_yard_movements": """
SELECT upper(a.nome) AS patio_retirada, upper(b.nome) AS patio_devolucao, COUNT(*) AS total_locacoes
FROM loc JOIN lugar a ON a.id = loc.patio JOIN lugar b ON b.id = loc.patio_dev
WHERE feita AND peca % 11 <> 0 GROUP BY 1, 2
""",
    "audit_unique": """
SELECT 'locacao:unico:id' AS regra, CAST(id AS VARCHAR) AS chave, CAST(COUNT(*) AS VARCHAR) AS detalhe
FROM loc GROUP BY id HAVING COUNT(*) > 1
""",
    "audit_orphans": """
SELECT 'G3.Locacao:referencia:Id_reserva' AS regra, CAST(pedido + 2000000000000 AS VARCHAR) AS chave, CAST(COUNT(*) AS VARCHAR) AS detalhe
  FROM loc WHERE peca % 19 = 0 GROUP BY pedido
UNION ALL SELECT 'G4.Locacao:referencia:IDVagaRetirada', CAST(vaga + 2000000000000 AS VARCHAR), CAST(COUNT(*) AS VARCHAR)
  FROM loc WHERE peca % 17 = 0 GROUP BY vaga
UNION ALL SELECT 'G4.Veiculo:referencia:IDCategoria', CAST(grupo + 2000000000000 AS VARCHAR), CAST(COUNT(*) AS VARCHAR)
  FROM peca WHERE id % 23 = 0 GROUP BY grupo
""",
    "audit_required": """
SELECT 'G1.Locacao:obrigatorio:ID_Reserva' AS regra, CAST(id AS VARCHAR) AS chave, 'ID_Reserva' AS detalhe
  FROM loc WHERE peca % 10 = 0
UNION ALL SELECT 'G1.Locacao:obrigatorio:ID_Patio_Chegada_Realizada', CAST(id AS VARCHAR), 'ID_Patio_Chegada_Realizada'
  FROM loc WHERE NOT feita
UNION ALL SELECT 'G1.Veiculo:obrigatorio:Mecanizacao', CAST(id AS VARCHAR), 'Mecanizacao' FROM peca WHERE p_size % 5 = 4
""",
    "audit_domain": """
SELECT 'G4.Categoria:dominio:ClasseLuxo' AS regra, CAST(id AS VARCHAR) AS chave, letra AS detalhe FROM marca WHERE letra = 'X'
UNION ALL SELECT 'G2.veiculo:dominio:mecanizacao', CAST(id AS VARCHAR), CASE WHEN p_size % 2 = 0 THEN ' automatica ' ELSE 'manual' END FROM peca
UNION ALL SELECT 'G2.locacao:dominio:status', CAST(id AS VARCHAR), ' concluida ' FROM loc WHERE feita AND peca % 11 <> 0
""",
    "audit_range": """
SELECT 'cliente:faixa:saldo' AS regra, CAST(c_custkey AS VARCHAR) AS chave, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS detalhe
  FROM customer WHERE CAST(c_acctbal AS DECIMAL(12,2)) < 0
UNION ALL SELECT 'vaga:faixa:saldo', CAST(s_suppkey AS VARCHAR), CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR)
  FROM supplier WHERE CAST(s_acctbal AS DECIMAL(12,2)) <= 0
UNION ALL SELECT 'veiculo:faixa:p_size', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR) FROM part WHERE p_size < 10
UNION ALL SELECT 'veiculo:faixa:p_size', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR) FROM part WHERE p_size <= 3
""",
    "audit_order": """
SELECT 'locacao:ordem:back' AS regra, id || '|' || peca || '|' || vaga AS chave,
  CAST(volta AS VARCHAR) || ' <= ' || CAST(prevista AS VARCHAR) AS detalhe
FROM loc WHERE volta <= prevista
UNION ALL SELECT 'locacao:ordem:due', id || '|' || peca || '|' || vaga, CAST(prevista AS VARCHAR) || ' < ' || CAST(saida AS VARCHAR)
FROM loc WHERE prevista < saida
""",
    "audit_length": """
SELECT 'G3.Veiculo:tamanho:Placa' AS regra, CAST(id AS VARCHAR) AS chave, placa AS detalhe FROM peca WHERE length(placa) <> 7
UNION ALL SELECT 'G3.Veiculo:padrao:Chassi', CAST(id AS VARCHAR), chassi FROM peca WHERE p_size = 13
""",
    "audit_xor": """
SELECT 'G3.Documento_cliente:algum:identidade' AS regra, CAST(id AS VARCHAR) AS chave, 'CPF,Passaporte' AS detalhe
  FROM pessoa WHERE id % 7 = 0 AND id % 14 <> 0
UNION ALL SELECT 'G3.Documento_cliente:algum:habilitacao', CAST(id AS VARCHAR), 'CNH,Habilitacao_estrangeira'
  FROM pessoa WHERE id % 3 = 0 AND id % 6 <> 0
UNION ALL SELECT 'G3.Documento_cliente:exclusivo:titular', CAST(id AS VARCHAR), ''
  FROM pessoa WHERE id % 3 = 0 AND id % 6 <> 0
""",
    "audit_one_active": """
SELECT 'G2.locacao:um_ativo:veiculo_id' AS regra, CAST(peca AS VARCHAR) AS chave, CAST(COUNT(*) AS VARCHAR) AS detalhe
FROM loc WHERE NOT feita GROUP BY peca HAVING COUNT(*) > 1
""",
    "audit_future": """
SELECT 'G4.PessoaFisica:futuro:DtNascimento' AS regra, CAST(id AS VARCHAR) AS chave,
  CAST(DATE '1975-01-01' + CAST(id % 10000 AS INTEGER) AS VARCHAR) AS detalhe
  FROM pessoa WHERE DATE '1975-01-01' + CAST(id % 10000 AS INTEGER) >= DATE '1976-01-01'
UNION ALL SELECT 'reserva:futuro:o_orderdate', CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS VARCHAR)
  FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-30'
""",
    "audit_unresolved": """
SELECT fonte AS fonte_grupo, 'CLIENTE' AS motivo, COUNT(*) AS linhas, 'fato_locacao' AS fato FROM resolvida WHERE sk_cliente IS NULL GROUP BY fonte
UNION ALL SELECT fonte, 'DATA_RETIRADA', COUNT(*), 'fato_locacao' FROM resolvida WHERE sk_saida IS NULL GROUP BY fonte
UNION ALL SELECT fonte, 'PATIO_RETIRADA', COUNT(*), 'fato_locacao' FROM resolvida WHERE sk_p_saida IS NULL GROUP BY fonte
UNION ALL SELECT fonte, 'VEICULO', COUNT(*), 'fato_locacao' FROM resolvida WHERE sk_veiculo IS NULL GROUP BY fonte
UNION ALL SELECT fonte, 'GRUPO', COUNT(*), 'fato_reserva' FROM reserva WHERE grupo IS NULL GROUP BY fonte
""",
    "audit_catalog": """
SELECT * FROM (
  SELECT fonte || CASE fonte WHEN 'G1' THEN '.Locacao:unico:ID_Locacao' WHEN 'G2' THEN '.locacao:unico:id_locacao'
      WHEN 'G3' THEN '.Locacao:unico:Id_locacao' ELSE '.Locacao:unico:IDLocacao' END AS regra, COUNT(*) AS violacoes
    FROM (SELECT fonte, id FROM loc GROUP BY fonte, id HAVING COUNT(*) > 1) GROUP BY fonte
  UNION ALL SELECT 'G2.locacao:unico:reserva_id', COUNT(*)
    FROM (SELECT pedido FROM loc WHERE fonte = 'G2' AND peca % 10 <> 0 GROUP BY pedido HAVING COUNT(*) > 1)
  UNION ALL SELECT 'G3.Devolucao:unico:Id_devolucao', COUNT(*)
    FROM (SELECT 1 FROM loc WHERE fonte = 'G3' AND feita GROUP BY peca, vaga HAVING COUNT(*) > 1)
  UNION ALL SELECT 'G3.Devolucao:referencia:Id_vaga', COUNT(DISTINCT vaga)
    FROM loc WHERE fonte = 'G3' AND feita AND peca % 13 = 0
  UNION ALL SELECT 'G3.Locacao:referencia:Id_reserva', COUNT(DISTINCT pedido) FROM loc WHERE fonte = 'G3' AND peca % 19 = 0
  UNION ALL SELECT 'G4.Locacao:referencia:IDVagaRetirada', COUNT(DISTINCT vaga) FROM loc WHERE fonte = 'G4' AND peca % 17 = 0
  UNION ALL SELECT 'G4.Veiculo:referencia:IDCategoria', COUNT(DISTINCT grupo) FROM peca WHERE id % 23 = 0
  UNION ALL SELECT 'G1.Veiculo:obrigatorio:Mecanizacao', COUNT(*) FROM peca WHERE p_size % 5 = 4
  UNION ALL SELECT 'G3.Especificacoes_const:obrigatorio:Direcao_automatica', COUNT(DISTINCT p_size) FROM peca WHERE p_size % 5 = 4
  UNION ALL SELECT 'G2.veiculo:dominio:mecanizacao', COUNT(*) FROM peca
  UNION ALL SELECT 'G2.locacao:dominio:status', COUNT(*) FROM loc WHERE fonte = 'G2'
  UNION ALL SELECT 'G4.Categoria:dominio:ClasseLuxo', COUNT(*) FROM marca WHERE letra = 'X'
  UNION ALL SELECT 'G4.Endereco:dominio:UF', COUNT(*) FROM lugar
  UNION ALL SELECT 'G3.Veiculo:padrao:Chassi', COUNT(*) FROM peca WHERE p_size = 13
  UNION ALL SELECT 'G3.Veiculo:tamanho:Placa', COUNT(*) FROM peca WHERE length(placa) <> 7)
WHERE violacoes > 0
""",
    "fleet_availability": """
, frotas AS (SELECT fonte, grupo, COUNT(*) AS frota FROM peca CROSS JOIN fontes WHERE fonte <> 'G4' GROUP BY ALL)
SELECT *, frota - reservados AS livres FROM (
SELECT f.fonte AS fonte_grupo, f.grupo AS id_grupo, CAST(d.range AS DATE) AS dia, f.frota, COUNT(r.id) AS reservados
FROM frotas f CROSS JOIN range(TIMESTAMP '2000-06-30', TIMESTAMP '2000-12-31', INTERVAL 1 DAY) d
  LEFT JOIN reserva r ON r.fonte = f.fonte AND r.grupo = f.grupo AND r.status IN ('CONFIRMADA', 'EM_ANDAMENTO')
    AND CAST(d.range AS DATE) BETWEEN r.d_retirada AND r.d_devolucao
GROUP BY ALL)
""",
    "waiting_queue": """
, vagas AS (SELECT grupo, id % 25 AS patio, COUNT(*) AS n FROM peca WHERE p_size % 3 = 0 GROUP BY ALL),
fila AS (
  SELECT p.grupo, p.patio, p.id, p.retirada, p.devolucao, COALESCE(v.n, 0) AS n,
    row_number() OVER (PARTITION BY p.grupo, p.patio ORDER BY p.pedido_em, p.id) AS espera
  FROM pedido p LEFT JOIN vagas v ON v.grupo = p.grupo AND v.patio = p.patio WHERE p.st = 'O'),
passos AS (
  SELECT grupo, patio, CAST(0 AS BIGINT) AS espera, CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS vaga,
    list_transform(range(n), lambda i: TIMESTAMP '0001-01-01') AS livre
  FROM (SELECT DISTINCT grupo, patio, n FROM fila)
  UNION ALL
  SELECT grupo, patio, espera, id, CASE WHEN serve THEN k END,
    CASE WHEN serve THEN list_transform(livre, lambda t, i: CASE WHEN i = k THEN devolucao ELSE t END) ELSE livre END
  FROM (
    SELECT f.*, p.livre, list_position(p.livre, list_min(p.livre)) AS k, COALESCE(list_min(p.livre) <= f.retirada, FALSE) AS serve
    FROM passos p JOIN fila f ON f.grupo = p.grupo AND f.patio = p.patio AND f.espera = p.espera + 1))
SELECT grupo AS grupo_id, patio AS patio_id, id AS id_reserva, espera, CAST(vaga AS INTEGER) AS vaga FROM passos WHERE espera > 0
""",
    "yard_inventory": """
, movimento AS (
  SELECT fonte, peca, quando, arg_max(struct_pack(patio := patio), volta * 1000 + COALESCE(patio, -1)) AS m FROM (
    SELECT fonte, peca, saida AS quando, 0 AS volta, NULL::BIGINT AS patio FROM loc WHERE fonte IN ('G3', 'G4')
    UNION ALL
    SELECT l.fonte, l.peca, CASE WHEN l.fonte = 'G3' THEN dev3.volta ELSE l.volta END, 1,
      CASE WHEN l.fonte = 'G3' THEN dev3.patio WHEN feita THEN l.patio_dev END
    FROM loc l LEFT JOIN dev3 ON l.fonte = 'G3' AND dev3.id = l.id WHERE l.fonte IN ('G3', 'G4'))
  WHERE quando IS NOT NULL GROUP BY ALL),
trimestre AS (
  SELECT CAST(range AS DATE) - 1 AS dia FROM range(TIMESTAMP '1996-01-01', TIMESTAMP '2003-01-01', INTERVAL 3 MONTH)),
pergunta AS (
  SELECT fonte, peca, dia, CAST(dia AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS ate
  FROM (SELECT DISTINCT fonte, peca FROM movimento) CROSS JOIN trimestre),
parado AS (
  SELECT p.fonte, p.dia, m.m.patio AS patio
  FROM pergunta p ASOF JOIN movimento m ON m.fonte = p.fonte AND m.peca = p.peca AND p.ate >= m.quando)
SELECT f.fonte AS fonte_grupo, CAST(l.id AS BIGINT) AS id_patio, t.dia, COUNT(p.patio) AS veiculos
FROM lugar l CROSS JOIN (VALUES ('G3'), ('G4')) f(fonte) CROSS JOIN trimestre t
  LEFT JOIN parado p ON p.fonte = f.fonte AND p.dia = t.dia AND p.patio = l.id
GROUP BY ALL
""",
    "expand_quantities": """
SELECT origem, destino, CAST(SUM(q) AS BIGINT) AS unidades, CAST(SUM(q * antes + q * (q + 1) // 2) AS BIGINT) AS soma_numeros,
  CAST(MAX(antes + q) AS BIGINT) AS maior_numero
FROM (
  SELECT l_suppkey % 25 AS origem, l_orderkey % 25 AS destino, l_linenumber AS q, 0 AS antes FROM lineitem
  UNION ALL
  SELECT l_partkey % 25, l_suppkey % 7, CAST(l_partkey % 3 AS INTEGER), l_linenumber FROM lineitem)
WHERE q > 0 GROUP BY 1, 2
""",
}
BODIES["report_a_latest"] = BODIES["report_a_yard_control"]
BODIES["report_d_top10"] = (
    BODIES["report_d_group_by_city"]
    + "ORDER BY total_locacoes DESC, cidade_cliente, uf_cliente NULLS LAST, grupo_veiculo, classe_luxo NULLS LAST LIMIT 10"
)
BODIES["clients_of_source"] = BODIES["dim_client"] + "WHERE fonte = 'G1'"

ORACLES = {name: (ROLES.rstrip() + body) if body.startswith(",") else f"{ROLES}{body}" for name, body in BODIES.items()}
