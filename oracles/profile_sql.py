from __future__ import annotations

from lettera.constants import DEMO
from lettera.functions.metadata import (BLOCKS as SOURCE_BLOCKS, CATEGORICAL, FEATURES, FORMULAS, HYPOTHESIS_OF,
                                        INDICATORS, NUMERIC, grain, references)

from .ctes import block

COLS = ", ".join(f"{c}::DOUBLE AS {c}" for c in NUMERIC)
NAMES = ", ".join(NUMERIC)


def unpivot(table: str) -> str:
    return f"""
SELECT * FROM (SELECT id_municipio, rede_nome, sigla_uf, particao, alvo, {COLS} FROM {table})
UNPIVOT INCLUDE NULLS (valor FOR variavel IN ({NAMES}))"""


block("p_longa", unpivot("c_abt"))
block("p_longa_treino", "SELECT * FROM p_longa WHERE particao = 'treino' AND valor IS NOT NULL")
block("p_lugares", """
SELECT id_municipio, max(sigla_uf) AS sigla_uf, max(nome_regiao) AS nome_regiao, count(*) AS alunos,
       sum(alvo) AS alfabetizados, 100.0::DOUBLE * sum(alvo) / count(*) AS taxa, max(mun_meta_ciclo) AS meta,
       max(mun_taxa_ant) AS taxa_2023
FROM c_abt GROUP BY id_municipio""")
block("p_estaveis", "SELECT * FROM p_lugares WHERE alunos >= 20")
block("p_evolucao", "SELECT *, taxa - taxa_2023 AS variacao FROM p_estaveis WHERE taxa_2023 IS NOT NULL")
block("p_hipotese", "SELECT * FROM (VALUES " + ", ".join(
    f"('{v}', '{h}')" for v, h in HYPOTHESIS_OF.items()) + ") x(variavel, hipotese)")
block("p_pares", """
SELECT e.id_municipio, e.sigla_uf, e.taxa - m.taxa AS d_taxa, e.esc_pct_quadra - m.esc_pct_quadra AS d_quadra,
       e.esc_pct_biblioteca_ou_sala_leitura - m.esc_pct_biblioteca_ou_sala_leitura AS d_bib,
       e.esc_alunos_por_docente - m.esc_alunos_por_docente AS d_doc, e.esc_inse_medio - m.esc_inse_medio AS d_inse
FROM (SELECT *, 100.0::DOUBLE * alfabetizados / alunos AS taxa FROM c_redes
      WHERE rede_nome = 'Estadual' AND alunos >= 20) e
JOIN (SELECT *, 100.0::DOUBLE * alfabetizados / alunos AS taxa FROM c_redes
      WHERE rede_nome = 'Municipal' AND alunos >= 20) m USING (id_municipio)""")


def bins(n: int) -> str:
    """Every pupil ranked on its own, ties by the hash of unit and response."""
    return f"""
SELECT *, greatest(1, (r0 * {n} + total - 2) // greatest(total - 1, 1)) AS faixa FROM (
  SELECT variavel, valor, alvo, id_municipio,
         row_number() OVER (PARTITION BY variavel ORDER BY valor,
           md5(id_municipio || '/' || rede_nome || '/' || CAST(alvo AS VARCHAR)),
           id_municipio || '/' || rede_nome || '/' || CAST(alvo AS VARCHAR)) - 1 AS r0,
         count(*) OVER (PARTITION BY variavel) AS total
  FROM p_longa_treino)
WHERE variavel IN (SELECT variavel FROM p_longa_treino GROUP BY variavel HAVING count(DISTINCT valor) >= {n})"""


RATES = """SELECT variavel, faixa, count(*) AS alunos, 100.0::DOUBLE * sum(alvo) / count(*) AS taxa,
  count(DISTINCT id_municipio) AS municipios, avg(valor) AS valor FROM {t} GROUP BY variavel, faixa"""
for n in (5, 10):
    block(f"p_bin{n}", bins(n))
    block(f"p_taxa{n}", RATES.format(t=f"p_bin{n}"))
    block(f"p_grad{n}", f"""
SELECT variavel, amplitude_pp, contra / nullif(tudo, 0) AS ruido_relativo, maior AS maior_inversao_pp,
       erro AS erro_amostral_pp, maior > erro AS inversao_real, mun AS municipios_por_faixa
FROM (SELECT variavel, max(amplitude) AS amplitude_pp,
             coalesce(sum(abs(degrau)) FILTER (WHERE sign(degrau) = -sentido), 0) AS contra,
             sum(abs(degrau)) AS tudo,
             coalesce(max(abs(degrau)) FILTER (WHERE sign(degrau) = -sentido), 0) AS maior,
             100 * sqrt(avg(taxa) / 100 * (1 - avg(taxa) / 100) / median(municipios)) AS erro,
             median(municipios) AS mun
      FROM (SELECT *, CASE WHEN amplitude = 0 THEN 1 ELSE sign(amplitude) END AS sentido FROM (
        SELECT *, taxa - lag(taxa) OVER (PARTITION BY variavel ORDER BY faixa) AS degrau,
               max(taxa) FILTER (WHERE faixa = {n}) OVER (PARTITION BY variavel)
               - max(taxa) FILTER (WHERE faixa = 1) OVER (PARTITION BY variavel) AS amplitude
        FROM p_taxa{n})) GROUP BY variavel)""")
block("p_padrao", """
SELECT q.variavel, q.amplitude_pp AS amplitude_pp_q, q.ruido_relativo AS ruido_relativo_q,
       q.maior_inversao_pp AS maior_inversao_pp_q, q.erro_amostral_pp AS erro_amostral_pp_q,
       q.inversao_real AS inversao_real_q, q.municipios_por_faixa AS municipios_por_faixa_q,
       d.amplitude_pp AS amplitude_pp_d, d.ruido_relativo AS ruido_relativo_d,
       d.maior_inversao_pp AS maior_inversao_pp_d, d.erro_amostral_pp AS erro_amostral_pp_d,
       d.inversao_real AS inversao_real_d, d.municipios_por_faixa AS municipios_por_faixa_d,
       CASE WHEN NOT abs(q.amplitude_pp) > q.erro_amostral_pp THEN 'sem gradiente'
            WHEN NOT q.inversao_real THEN 'monotônica'
            WHEN q.ruido_relativo <= 0.25 THEN 'tendência com baixo ruído'
            WHEN q.ruido_relativo <= 0.45 THEN 'tendência com alto ruído'
            ELSE 'sem direção estável' END AS padrao
FROM p_grad5 q JOIN p_grad10 d USING (variavel)""")
block("p_treino", "SELECT row_number() OVER () AS linha, * FROM c_abt WHERE particao = 'treino'")
RANKS = ",\n".join(f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (ORDER BY {c}) "
                   f"+ (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE END AS {c}" for c in NUMERIC)
block("p_postos", f"SELECT alvo, {RANKS} FROM p_treino")
block("p_teto", """
SELECT corr(t, alvo) AS teto, var_pop(alvo) AS var_total, avg((t - m) * (t - m)) AS var_entre
FROM (SELECT alvo, avg(alvo) OVER (PARTITION BY id_municipio) AS t, avg(alvo) OVER () AS m FROM p_treino)""")
block("p_teto_faixas", """
SELECT avg(alvo) FILTER (WHERE faixa = 5) * 100 - avg(alvo) FILTER (WHERE faixa = 1) * 100 AS amplitude_maxima
FROM (SELECT alvo, greatest(1, (r0 * 5 + total - 2) // greatest(total - 1, 1)) AS faixa FROM (
  SELECT alvo, count(*) OVER () AS total, row_number() OVER (ORDER BY t,
           md5(id_municipio || '/' || rede_nome || '/' || CAST(alvo AS VARCHAR)),
           id_municipio || '/' || rede_nome || '/' || CAST(alvo AS VARCHAR)) - 1 AS r0
  FROM (SELECT *, avg(alvo) OVER (PARTITION BY id_municipio) AS t FROM p_treino)))""")
CORR = lambda table, y: "[" + ", ".join(
    f"{{'variavel': '{c}', 'r': nullif(corr({c}, {y}), 'NaN'::DOUBLE), 'n': count({c})}}" for c in NUMERIC) + "]"
block("p_corr", f"""
SELECT p.variavel, p.r AS pearson, s.r AS spearman
FROM (SELECT unnest({CORR('p_treino', 'alvo')}, recursive := true) FROM p_treino) p
JOIN (SELECT unnest({CORR('p_postos', 'alvo')}, recursive := true) FROM p_postos) s USING (variavel)
WHERE p.n > 0""")
SORTED = sorted(NUMERIC)
PAIRS = "[" + ", ".join(f"{{'a': '{a}', 'b': '{b}', 'rho': nullif(corr({a}, {b}), 'NaN'::DOUBLE)}}"
                        for i, a in enumerate(SORTED) for b in SORTED[i + 1:]) + "]"
block("p_matriz", f"SELECT unnest({PAIRS}, recursive := true) FROM p_postos")


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def each(columns, expr: str, table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS variavel, {expr.replace('{c}', c)} FROM {table}" for c in columns)


DUCK_TYPE = {"rede_nome": "string", "sigla_uf": "string", "nome_regiao": "string"}
BIGINTS = {"mun_alunos_ant": "int", "rede_porte_atual": "bigint", "mun_porte_atual": "bigint",
           "esc_quantidade": "bigint", "mun_populacao": "bigint", "mun_idade_mediana": "bigint"}
TYPES = {c: DUCK_TYPE.get(c, BIGINTS.get(c, "double")) for c in FEATURES}
TYPE_CASE = "CASE variavel " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in TYPES.items()) + " END"
block("p_inventario", f"""
SELECT variavel, 100.0::DOUBLE * count(valor) / count(*) AS preenchido_pct, count(DISTINCT valor) AS distintos,
       avg(valor) AS media, stddev_samp(valor) AS desvio, min(valor) AS minimo, median(valor) AS mediana,
       max(valor) AS maximo, 100.0::DOUBLE * count(*) FILTER (WHERE valor = 0) / nullif(count(valor), 0) AS zeros_pct
FROM p_longa GROUP BY variavel UNION ALL """ + " UNION ALL ".join(
    f"""SELECT '{c}', 100.0::DOUBLE * count({c}) / count(*), count(DISTINCT {c}), NULL, NULL, NULL, NULL, NULL, NULL
        FROM c_abt""" for c in CATEGORICAL))
block("p_categorias", " UNION ALL ".join(
    f"SELECT '{c}' AS variavel, {c} AS categoria, count(*) AS n, sum(alvo) AS sim FROM c_abt GROUP BY {c}"
    for c in CATEGORICAL))
FLAGS = " || ".join(f"CASE WHEN {c} IS NULL THEN 'X' ELSE '.' END" for c in SOURCE_BLOCKS.values())
block("p_redes_longa", f"""
SELECT * FROM (SELECT id_municipio || '/' || rede_nome AS unidade, {COLS} FROM c_redes WHERE particao = 'treino')
UNPIVOT INCLUDE NULLS (valor FOR variavel IN ({NAMES}))""")
block("p_par_a_par", """
SELECT a, b, nullif(corr(ra, rb), 'NaN'::DOUBLE) AS rho FROM (
  SELECT x.variavel AS a, y.variavel AS b,
         rank() OVER (PARTITION BY x.variavel, y.variavel ORDER BY x.valor)
         + (count(*) OVER (PARTITION BY x.variavel, y.variavel, x.valor) - 1) / 2.0::DOUBLE AS ra,
         rank() OVER (PARTITION BY x.variavel, y.variavel ORDER BY y.valor)
         + (count(*) OVER (PARTITION BY x.variavel, y.variavel, y.valor) - 1) / 2.0::DOUBLE AS rb
  FROM p_redes_longa x JOIN p_redes_longa y USING (unidade)
  WHERE x.variavel <> y.variavel AND x.valor IS NOT NULL AND y.valor IS NOT NULL)
GROUP BY a, b""")
block("p_vizinhos", """
SELECT a, b, rho, mesmo, row_number() OVER (PARTITION BY a, mesmo ORDER BY round(abs(rho), 9) DESC, b) AS ordem
FROM (SELECT a, b, rho, x.hipotese = y.hipotese AS mesmo FROM p_par_a_par
      JOIN p_hipotese x ON a = x.variavel JOIN p_hipotese y ON b = y.variavel WHERE rho IS NOT NULL)""")
META = ", ".join(f"('{v}', '{HYPOTHESIS_OF[v]}', '{grain(v)}', '{references(DEMO)[v]}', '{FORMULAS.get(v, '')}', "
                 f"'{'categórica' if v in CATEGORICAL else 'numérica'}')" for v in FEATURES)
PREP = ["rede_taxa_ant", "mun_participacao_ant", "esc_horas_aula_diarias", "esc_inse_medio", "mun_ivs",
        "rede_vs_municipio"]
SQL = {
    "near_cutoff_share": """
WITH a AS (SELECT proficiencia AS x FROM t_alunos WHERE ano = 2000 AND presente AND proficiencia IS NOT NULL)
SELECT 'proficiencia' AS medida, count(*) AS total, j AS distancia,
       count(*) FILTER (WHERE x >= 50000 - j AND x < 50000 + j) AS perto,
       100.0::DOUBLE * count(*) FILTER (WHERE x >= 50000 - j AND x < 50000 + j) / count(*) AS pct
FROM a, (VALUES (500), (1000), (2000), (5000)) s(j) GROUP BY j
UNION ALL SELECT 'taxa da rede', count(*), j, count(*) FILTER (WHERE abs(taxa_real - 53.0) <= j),
       100.0::DOUBLE * count(*) FILTER (WHERE abs(taxa_real - 53.0) <= j) / count(*)
FROM c_redes, (VALUES (3), (5)) s(j) GROUP BY j""",
    "response_by_group": """
SELECT rede_nome, count(*) AS alunos, sum(alvo)::BIGINT AS alfabetizados, 100.0::DOUBLE * sum(alvo) / count(*) AS taxa
FROM c_abt GROUP BY rede_nome HAVING count(*) > 100""",
    "describe_by_group": f"""
SELECT nome_regiao, count(*) AS municipios, {r('avg(taxa)', 'media')}, {r('stddev_samp(taxa)', 'desvio')},
       {r('min(taxa)', 'minimo')}, {r('quantile_cont(taxa, 0.25)', 'q1')}, {r('median(taxa)', 'mediana')},
       {r('quantile_cont(taxa, 0.75)', 'q3')}, {r('max(taxa)', 'maximo')},
       {r('stddev_samp(taxa) / nullif(avg(taxa), 0)', 'coef_variacao')}
FROM (SELECT nome_regiao, taxa FROM p_estaveis UNION ALL SELECT 'Brasil', taxa FROM p_estaveis) GROUP BY nome_regiao""",
    "pooled_vs_mean_rate": " UNION ALL ".join(f"""
SELECT '{by}' AS nivel, a.g AS grupo, a.alunos, municipios, round(p, 6) AS taxa_entre_alunos,
       round(m, 6) AS media_das_taxas_municipais, round(p - m, 6) AS efeito_do_peso
FROM (SELECT {by} AS g, count(*) AS alunos, 100.0::DOUBLE * sum(alvo) / count(*) AS p FROM c_abt GROUP BY 1) a
LEFT JOIN (SELECT {by} AS g, count(*) AS municipios, avg(taxa) AS m FROM p_estaveis GROUP BY 1) b USING (g)"""
        for by in ("nome_regiao", "sigla_uf")),
    "large_unit_effect": """
SELECT nome_regiao, alunos_dez_maiores, round(taxa_dez_maiores, 6) AS taxa_dez_maiores,
       round(taxa_da_maior, 6) AS taxa_da_maior, alunos, round(acima, 6) AS acima_da_maior_pct,
       round(alunos_dez_maiores / alunos::DOUBLE, 6) AS fracao_dez_maiores
FROM (SELECT nome_regiao, sum(alunos) FILTER (WHERE o <= 10)::BIGINT AS alunos_dez_maiores,
             100.0::DOUBLE * sum(alfabetizados) FILTER (WHERE o <= 10) / sum(alunos) FILTER (WHERE o <= 10)
               AS taxa_dez_maiores,
             max(taxa) FILTER (WHERE o = 1) AS taxa_da_maior, sum(alunos)::BIGINT AS alunos,
             100.0::DOUBLE * avg(acima::INTEGER) FILTER (WHERE alunos >= 20) AS acima
      FROM (SELECT *, taxa > max(taxa) FILTER (WHERE o = 1) OVER (PARTITION BY nome_regiao) AS acima
            FROM (SELECT *, row_number() OVER (PARTITION BY nome_regiao ORDER BY alunos DESC, id_municipio) AS o
                  FROM p_lugares)) GROUP BY nome_regiao)""",
    "top_bottom": """
WITH b AS (SELECT DISTINCT sigla_uf || '/' || rede_nome AS chave, uf_rede_taxa_ant AS valor
           FROM c_rede JOIN c_censo USING (id_municipio))
SELECT * FROM (SELECT chave, valor, 'maiores' AS lista FROM b ORDER BY valor DESC, chave LIMIT 5)
UNION ALL SELECT * FROM (SELECT chave, valor, 'menores' FROM b ORDER BY valor, chave LIMIT 5)
UNION ALL SELECT * FROM (SELECT id_municipio, max(mun_densidade_demografica) AS v, 'densidade' FROM c_abt
  GROUP BY 1 HAVING max(mun_densidade_demografica) IS NOT NULL ORDER BY v DESC, id_municipio LIMIT 5)""",
    "target_distance_by_state": " UNION ALL ".join(f"""
SELECT '{label}' AS nivel, {by} AS grupo, count(*) AS municipios,
       round(100.0::DOUBLE * avg((taxa < meta)::INTEGER), 6) AS pct_abaixo,
       coalesce(sum(alunos) FILTER (WHERE taxa - meta < 0), 0)::BIGINT AS alunos_abaixo,
       round(avg(taxa - meta), 6) AS distancia_media FROM p_lugares WHERE meta IS NOT NULL GROUP BY 2"""
        for label, by in (("região", "nome_regiao"), ("UF", "sigla_uf"))),
    "cycle_persistence": """
SELECT 'país' AS grupo, count(*) AS municipios, round(regr_slope(taxa, taxa_2023), 6) AS inclinacao,
       round(regr_intercept(taxa, taxa_2023), 6) AS intercepto, round(corr(taxa_2023, taxa), 6) AS correlacao,
       round(100.0::DOUBLE * avg((variacao < 0)::INTEGER), 6) AS pct_que_piorou,
       round(median(variacao), 6) AS variacao_mediana FROM p_evolucao
UNION ALL SELECT sigla_uf, count(*), NULL, NULL, NULL, round(100.0::DOUBLE * avg((variacao < 0)::INTEGER), 6),
       round(median(variacao), 6) FROM p_evolucao GROUP BY sigla_uf""",
    "change_by_quartile": """
WITH b AS (SELECT 'todos' AS recorte, * FROM p_evolucao
           UNION ALL SELECT 'sem um estado', * FROM p_evolucao WHERE sigla_uf <> 'NATION_0'),
     e AS (SELECT recorte, quantile_cont(taxa_2023, 0.25) AS q1, median(taxa_2023) AS q2,
                  quantile_cont(taxa_2023, 0.75) AS q3 FROM b GROUP BY recorte)
SELECT recorte, CASE WHEN taxa_2023 <= q1 THEN 'Q1 mais baixo' WHEN taxa_2023 <= q2 THEN 'Q2'
                     WHEN taxa_2023 <= q3 THEN 'Q3' ELSE 'Q4 mais alto' END AS quartil,
       round(median(taxa_2023), 6) AS taxa_2023, round(median(taxa), 6) AS taxa_2024,
       round(median(variacao), 6) AS variacao, count(*) AS municipios
FROM b JOIN e USING (recorte) GROUP BY 1, 2""",
    "paired_network_gap": """
WITH l AS (
  SELECT 'UF' AS corte, sigla_uf AS grupo, d_taxa AS d FROM p_pares
  UNION ALL SELECT 'público', CASE WHEN d_inse <= -0.05 THEN 'estadual atende famílias de nível menor'
    WHEN d_inse <= 0.05 THEN 'nível semelhante' ELSE 'estadual atende famílias de nível maior' END, d_taxa
    FROM p_pares WHERE d_inse IS NOT NULL
  UNION ALL SELECT 'infraestrutura', 'esc_pct_quadra', d_quadra FROM p_pares
  UNION ALL SELECT 'infraestrutura', 'esc_pct_biblioteca_ou_sala_leitura', d_bib FROM p_pares
  UNION ALL SELECT 'infraestrutura', 'esc_alunos_por_docente', d_doc FROM p_pares
  UNION ALL SELECT 'infraestrutura', 'esc_inse_medio', d_inse FROM p_pares),
k AS (SELECT rank() OVER (ORDER BY d_inse) + (count(*) OVER (PARTITION BY d_inse) - 1) / 2.0::DOUBLE AS ra,
             rank() OVER (ORDER BY d_taxa) + (count(*) OVER (PARTITION BY d_taxa) - 1) / 2.0::DOUBLE AS rb
      FROM p_pares WHERE d_inse IS NOT NULL)
SELECT corte, grupo, count(*) AS municipios, round(median(d), 6) AS diferenca_mediana,
       round(100.0::DOUBLE * avg((d > 0)::INTEGER), 6) AS estadual_maior_pct
FROM l WHERE d IS NOT NULL GROUP BY corte, grupo
UNION ALL SELECT 'spearman', 'diferença de INSE', count(*), round(corr(ra, rb), 6), NULL FROM k""",
    "network_share_by_state": """
SELECT sigla_uf, count(*) FILTER (WHERE rede_nome = 'Estadual') AS "Estadual",
       count(*) FILTER (WHERE rede_nome = 'Municipal') AS "Municipal",
       100.0::DOUBLE * count(*) FILTER (WHERE rede_nome = 'Estadual') / count(*) AS alunos_na_estadual_pct
FROM c_abt WHERE rede_nome <> 'Privada' GROUP BY sigla_uf""",
    "column_profile": f"""
SELECT variavel, {TYPE_CASE} AS tipo, {r('preenchido_pct', 'preenchido_pct')}, distintos, {r('media', 'media')},
       {r('desvio', 'desvio')}, {r('minimo', 'minimo')}, {r('mediana', 'mediana')}, {r('maximo', 'maximo')},
       {r('zeros_pct', 'zeros_pct')},
       CASE WHEN distintos <= 1 THEN 'sem variação; ' ELSE '' END
       || CASE WHEN preenchido_pct < 80 THEN 'cobertura baixa; ' ELSE '' END
       || CASE WHEN coalesce(zeros_pct, 0) > 90 THEN 'quase tudo zero; ' ELSE '' END AS alerta
FROM p_inventario""",
    "numeric_description": f"""
SELECT variavel, count(valor) AS n, {r('avg(valor)', 'media')}, {r('median(valor)', 'mediana')},
       {r('stddev_samp(valor)', 'desvio')},
       {r('quantile_cont(valor, 0.75) - quantile_cont(valor, 0.25)', 'amplitude_iq')},
       {r('CASE WHEN min(valor) >= 0 AND avg(valor) > 0 THEN stddev_samp(valor) / avg(valor) END', 'coef_variacao')},
       {r('avg(valor) - median(valor)', 'media_menos_mediana')}, {r('min(valor)', 'minimo')},
       {r('quantile_cont(valor, 0.01)', 'p01')}, {r('quantile_cont(valor, 0.99)', 'p99')}, {r('max(valor)', 'maximo')}
FROM p_longa WHERE valor IS NOT NULL GROUP BY variavel""",
    "scale_concentration": f"""
SELECT variavel, count(DISTINCT valor) AS valores_distintos,
       {r('100.0::DOUBLE * avg((valor >= lo + 0.9::DOUBLE * (hi - lo))::INTEGER)', 'no_topo_da_escala_pct')},
       {r('100.0::DOUBLE * avg((valor <= lo + 0.1::DOUBLE * (hi - lo))::INTEGER)', 'na_base_da_escala_pct')}
FROM (SELECT *, min(valor) OVER (PARTITION BY variavel) AS lo, max(valor) OVER (PARTITION BY variavel) AS hi
      FROM p_longa WHERE valor IS NOT NULL) GROUP BY variavel HAVING count(*) >= 100 AND count(DISTINCT valor) >= 3""",
    "categorical_profile": f"""
SELECT variavel, count(categoria) AS categorias,
       {r('100.0::DOUBLE * coalesce(sum(n) FILTER (WHERE categoria IS NOT NULL), 0) / sum(n)', 'preenchido_pct')},
       first(categoria ORDER BY n DESC, categoria) AS categoria_mais_comum,
       {r('100.0::DOUBLE * max(n) / sum(n)', 'frequencia_da_maior_pct')}, min(n) AS menor_categoria_n,
       count(*) FILTER (WHERE n / (SELECT count(*) FROM c_abt)::DOUBLE < 0.01) AS categorias_abaixo_de_1pct
FROM p_categorias GROUP BY variavel""",
    "rare_categories": f"""
SELECT variavel, categoria, n, {r('100.0::DOUBLE * n / (SELECT count(*) FROM c_abt)', 'pct')},
       {r('100.0::DOUBLE * sim / n', 'taxa')} FROM p_categorias WHERE n < 1000""",
    "shape_diagnostics": f"""
SELECT variavel, {r('assimetria', 'assimetria')}, {r('curtose', 'curtose')}, {r('fora', 'fora_de_tukey_pct')},
       {r('CASE WHEN med > 0 THEN p99 / med END', 'razao_p99_mediana')},
       CASE WHEN abs(round(assimetria, 2)) > 2 THEN 'logarítmica ou quantílica'
            WHEN abs(round(assimetria, 2)) > 1 THEN 'avaliar' ELSE 'nenhuma' END AS transformacao_sugerida
FROM (SELECT variavel, skewness(valor) AS assimetria, kurtosis(valor) AS curtose, any_value(med) AS med,
             quantile_cont(valor, 0.99) AS p99,
             100.0::DOUBLE * avg(((valor < q1 - 1.5::DOUBLE * (q3 - q1) OR valor > q3 + 1.5::DOUBLE * (q3 - q1))
               AND q3 > q1)::INTEGER) AS fora
      FROM (SELECT *, quantile_cont(valor, 0.25) OVER (PARTITION BY variavel) AS q1,
                   quantile_cont(valor, 0.75) OVER (PARTITION BY variavel) AS q3,
                   median(valor) OVER (PARTITION BY variavel) AS med
            FROM p_longa WHERE valor IS NOT NULL)
      GROUP BY variavel HAVING count(*) >= 100 AND count(DISTINCT valor) >= 3)""",
    "missing_summary": "SELECT * FROM (" + each(
        FEATURES, "count(*) - count({c}) AS ausentes, round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) "
                  "AS pct", "c_abt") + ") WHERE ausentes > 0",
    "missing_patterns": f"""
SELECT padrao, count(*) AS linhas, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM c_abt) AS pct,
       (length(padrao) - length(replace(padrao, 'X', '')))::INTEGER AS variaveis_ausentes
FROM (SELECT {FLAGS} AS padrao FROM c_abt) GROUP BY padrao
UNION ALL SELECT CASE WHEN sigla_uf IS NULL THEN 'sem UF' ELSE 'com UF' END || ', ' ||
  CASE WHEN mun_taxa_ajustada_ant IS NULL THEN 'sem histórico' ELSE 'com histórico' END, count(*), NULL, NULL
FROM c_abt GROUP BY 1""",
    "missing_gap": "SELECT variavel, round(g, 6) AS taxa_ausente, round(t, 6) AS taxa_presente, "
                   "round(g - t, 6) AS diferenca FROM (" + each(
        FEATURES, "100.0::DOUBLE * avg(alvo) FILTER (WHERE {c} IS NULL) AS g, "
                  "100.0::DOUBLE * avg(alvo) FILTER (WHERE {c} IS NOT NULL) AS t", "c_abt")
                   + ") WHERE g IS NOT NULL AND t IS NOT NULL",
    "block_coverage": " UNION ALL ".join(
        f"SELECT '{b}' AS bloco, count({c}) AS alunos, count({c}) / count(*)::DOUBLE AS cobertura FROM c_abt"
        for b, c in SOURCE_BLOCKS.items()),
    "variable_histogram": """
SELECT variavel, least(floor((valor - lo) / ((hi - lo) / 40.0::DOUBLE)), 39)::INTEGER AS faixa, count(*) AS linhas
FROM (SELECT *, min(valor) OVER (PARTITION BY variavel) AS lo, max(valor) OVER (PARTITION BY variavel) AS hi
      FROM p_longa WHERE valor IS NOT NULL) WHERE hi > lo GROUP BY 1, 2""",
    "partition_summary": """
SELECT particao, redes, bateram, alunos, pequenas_pct, bateram_pct, round(m, 6) AS mediana_ant FROM (
  SELECT particao, count(*) AS redes, sum(bateu_meta)::BIGINT AS bateram, sum(alunos)::BIGINT AS alunos,
         round(100.0::DOUBLE * avg((alunos < 20)::INTEGER), 6) AS pequenas_pct,
         round(100.0::DOUBLE * sum(bateu_meta) / count(*), 6) AS bateram_pct FROM c_redes GROUP BY particao)
LEFT JOIN (SELECT particao, median(rede_taxa_ant) AS m FROM c_abt WHERE rede_nome <> 'Privada' GROUP BY particao)
  USING (particao)""",
    "variance_ceiling": """
SELECT round(teto, 6) AS teto, round(var_total, 6) AS var_total, round(var_entre, 6) AS var_entre,
       round(var_total - var_entre, 6) AS var_dentro, round(var_entre / var_total, 6) AS parte_entre,
       round(amplitude_maxima, 6) AS amplitude_maxima FROM p_teto, p_teto_faixas""",
    "rate_by_quantile": f"""
SELECT variavel, faixa, alunos, {r('taxa', 'taxa')}, municipios, {r('valor', 'valor')} FROM p_taxa5""",
    "monotonicity": """
SELECT variavel, round(a, 6) AS taxa_primeiro_quintil, round(z, 6) AS taxa_ultimo_quintil,
       round(z - a, 6) AS amplitude_pp, round(m, 6) AS monotonicidade, mun AS municipios_por_quintil,
       round(100.0::DOUBLE * abs(z - a) / amplitude_maxima, 6) AS pct_do_teto
FROM (SELECT variavel, max(taxa) FILTER (WHERE faixa = 1) AS a, max(taxa) FILTER (WHERE faixa = 5) AS z,
             corr(faixa, posto) AS m, median(municipios) AS mun
      FROM (SELECT *, rank() OVER (PARTITION BY variavel ORDER BY taxa)
              + (count(*) OVER (PARTITION BY variavel, taxa) - 1) / 2.0::DOUBLE AS posto FROM p_taxa5)
      GROUP BY variavel), p_teto_faixas""",
    "gradient_pattern": """
SELECT variavel, padrao, inversao_real_q, inversao_real_d, municipios_por_faixa_q, municipios_por_faixa_d, """
    + ", ".join(r(c, c) for c in (
        "amplitude_pp_q", "ruido_relativo_q", "maior_inversao_pp_q", "erro_amostral_pp_q", "amplitude_pp_d",
        "ruido_relativo_d", "maior_inversao_pp_d", "erro_amostral_pp_d")) + " FROM p_padrao",
    "gradient_by_hypothesis": f"""
SELECT hipotese, count(*) AS variaveis, {r('max(abs(amplitude_pp_q))', 'amplitude_maxima')},
       {r('median(abs(amplitude_pp_q))', 'amplitude_mediana')},
       count(*) FILTER (WHERE padrao = 'monotônica') AS monotonicas,
       count(*) FILTER (WHERE padrao = 'tendência com baixo ruído') AS baixo_ruido,
       count(*) FILTER (WHERE padrao = 'tendência com alto ruído') AS alto_ruido,
       count(*) FILTER (WHERE padrao = 'sem direção estável') AS sem_direcao,
       count(*) FILTER (WHERE padrao = 'sem gradiente') AS sem_gradiente
FROM p_padrao JOIN p_hipotese USING (variavel)
WHERE hipotese NOT LIKE 'H8%' AND hipotese NOT LIKE 'controle%' GROUP BY hipotese""",
    "response_correlation": """
SELECT variavel, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman,
       round(100.0::DOUBLE * abs(spearman) / teto, 6) AS pct_do_teto FROM p_corr, p_teto""",
    "spearman_matrix": """
SELECT a AS variavel_a, b AS variavel_b, round(rho, 6) AS spearman FROM p_matriz WHERE rho IS NOT NULL""",
    "strong_pairs": """
SELECT a AS variavel_a, b AS variavel_b, round(rho, 6) AS spearman, x.hipotese AS hipotese_a, y.hipotese AS hipotese_b,
       x.hipotese = y.hipotese AS mesma_hipotese
FROM p_matriz JOIN p_hipotese x ON a = x.variavel JOIN p_hipotese y ON b = y.variavel WHERE abs(rho) >= 0.8""",
    "ranking_agreement": """
WITH d AS (SELECT variavel, spearman, amplitude_pp_q, padrao, round(abs(spearman), 3) AS x, round(abs(amplitude_pp_q), 1) AS y
           FROM p_corr JOIN p_padrao USING (variavel) WHERE spearman IS NOT NULL),
k AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry FROM d)
SELECT count(*) AS variaveis, round(corr(rx, ry), 6) AS concordancia,
       count(*) FILTER (WHERE x > (SELECT teto FROM p_teto)) AS acima_do_teto,
       coalesce(string_agg(variavel, ', ' ORDER BY variavel) FILTER (WHERE sign(spearman) <> sign(amplitude_pp_q)
         AND padrao <> 'sem gradiente'), '') AS sentido_diferente FROM k""",
    "impute_by_group": "SELECT t.id_municipio || '/' || t.rede_nome AS unidade, " + ", ".join(
        f"round(coalesce(t.{c}, g.{c}, o.{c}), 6) AS {c}" for c in PREP) + f"""
FROM c_redes t LEFT JOIN (SELECT sigla_uf, {', '.join(f'median({c}) AS {c}' for c in PREP)} FROM c_redes
  WHERE particao = 'treino' GROUP BY sigla_uf) g ON t.sigla_uf = g.sigla_uf,
  (SELECT {', '.join(f'median({c}) AS {c}' for c in PREP)} FROM c_redes WHERE particao = 'treino') o""",
    "data_dictionary": f"""
SELECT m.variavel, m.hipotese, m.grao, m.referencia, m.formula, m.papel, round(preenchido_pct, 1) AS preenchimento,
       distintos FROM (VALUES {META}) m(variavel, hipotese, grao, referencia, formula, papel) JOIN p_inventario USING (variavel)""",
    "theme_evidence": f"""
SELECT variavel, hipotese AS tema, {r('ausentes', 'ausentes_pct')}, {r('p25', 'p25')}, {r('p75', 'p75')},
       {r('comum', 'mais_comum_pct')}, i.b AS maior_no_tema, {r('i.rho', 'rho_no_tema')}, o.b AS maior_fora,
       {r('o.rho', 'rho_fora')}
FROM (SELECT variavel, 100.0::DOUBLE * (1 - count(valor) / count(*)::DOUBLE) AS ausentes,
             quantile_cont(valor, 0.25) AS p25, quantile_cont(valor, 0.75) AS p75 FROM p_redes_longa GROUP BY variavel) s
JOIN (SELECT variavel, 100.0::DOUBLE * max(n) / sum(n) AS comum FROM
        (SELECT variavel, valor, count(*) AS n FROM p_redes_longa WHERE valor IS NOT NULL GROUP BY 1, 2)
      GROUP BY variavel) c USING (variavel) JOIN p_hipotese USING (variavel)
LEFT JOIN (SELECT * FROM p_vizinhos WHERE mesmo AND ordem = 1) i ON variavel = i.a
LEFT JOIN (SELECT * FROM p_vizinhos WHERE NOT mesmo AND ordem = 1) o ON variavel = o.a""",
    "screening_facts": rf"""
WITH m AS (SELECT m.variavel, m.grao, regexp_extract_all(referencia, '\b(?:19|20)\d\d\b') AS anos, regexp_extract_all(formula, '\w+') AS palavras
           FROM (VALUES {META}) m(variavel, hipotese, grao, referencia, formula, papel)
           WHERE m.variavel IN (SELECT variavel FROM p_redes_longa)),
c AS (SELECT variavel, sum(n) AS n, max(n) AS top FROM (SELECT variavel, valor, count(*) AS n FROM p_redes_longa WHERE valor IS NOT NULL GROUP BY 1, 2) GROUP BY variavel),
f AS (SELECT m.variavel, 1 - coalesce(c.n, 0) / (SELECT count(*) FROM c_redes WHERE particao = 'treino')::DOUBLE AS ausentes,
             coalesce(c.top / c.n::DOUBLE, 1.0) AS mais_comum,
             list_has_any(palavras, (SELECT list(variavel) FROM m o WHERE o.variavel <> m.variavel)) AS tem_formula, grao <> 'rede' AS fora_da_rede,
             (2000 - coalesce(list_max(list_transform(anos, lambda x: x::INTEGER)), 0))::INTEGER AS idade
      FROM m LEFT JOIN c ON c.variavel = m.variavel)
SELECT variavel, {r('ausentes', 'ausentes')}, {r('mais_comum', 'mais_comum')}, tem_formula, fora_da_rede, idade,
       (dense_rank() OVER (ORDER BY tem_formula, fora_da_rede, idade, ausentes))::INTEGER AS posto FROM f""",
    "z_scores": f"""
SELECT unidade, variavel, round(CASE WHEN s > 0 THEN (valor - m) / s ELSE 0 END, 6) AS valor FROM (
  SELECT id_municipio || '/' || rede_nome AS unidade, variavel, valor, avg(valor) OVER w AS m, stddev_samp(valor) OVER w AS s
  FROM (SELECT id_municipio, rede_nome, {COLS} FROM c_redes) UNPIVOT (valor FOR variavel IN ({NAMES}))
  WINDOW w AS (PARTITION BY variavel))""",
    "prepared_matrix": f"""
WITH longa AS (SELECT * FROM (SELECT id_municipio || '/' || rede_nome AS unidade, sigla_uf AS uf, particao, {COLS} FROM c_redes)
               UNPIVOT INCLUDE NULLS (valor FOR variavel IN ({NAMES}))),
por_uf AS (SELECT uf, variavel, median(valor) AS m FROM longa WHERE particao = 'treino' AND uf IS NOT NULL GROUP BY uf, variavel),
pais AS (SELECT variavel, median(valor) AS m FROM longa WHERE particao = 'treino' GROUP BY variavel),
cheia AS (
  SELECT l.unidade, l.particao, l.variavel AS coluna,
         CASE WHEN l.variavel IN ('mun_populacao', 'mun_densidade_demografica') THEN ln(1 + coalesce(l.valor, u.m, p.m))
              ELSE coalesce(l.valor, u.m, p.m) END AS x
  FROM longa l LEFT JOIN por_uf u ON u.uf = l.uf AND u.variavel = l.variavel LEFT JOIN pais p ON p.variavel = l.variavel
  UNION ALL
  SELECT l.unidade, l.particao, i.nome, (l.valor IS NULL)::DOUBLE
  FROM longa l JOIN (VALUES {', '.join(f"('{n}', '{v}')" for n, v in INDICATORS.items())}) i(nome, variavel) ON i.variavel = l.variavel),
escala AS (SELECT coluna, avg(x) AS m, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS s
           FROM cheia WHERE particao = 'treino' GROUP BY coluna),
categorias AS (SELECT * FROM (SELECT id_municipio || '/' || rede_nome AS unidade, particao, rede_nome, sigla_uf, nome_regiao FROM c_redes)
               UNPIVOT INCLUDE NULLS (nivel FOR variavel IN ({', '.join(CATEGORICAL)}))),
niveis AS (SELECT variavel, nivel, row_number() OVER (PARTITION BY variavel ORDER BY nivel) - 1 AS lugar
           FROM (SELECT DISTINCT variavel, nivel FROM categorias WHERE particao = 'treino' AND nivel IS NOT NULL))
SELECT unidade, coluna AS variavel, round((x - m) / s, 6) AS valor FROM cheia JOIN escala USING (coluna) WHERE x IS NOT NULL AND m IS NOT NULL
UNION ALL
SELECT c.unidade, n.variavel || '__' || n.lugar, coalesce(c.nivel = n.nivel, false)::INTEGER::DOUBLE
FROM categorias c JOIN niveis n ON n.variavel = c.variavel""",
    "missing_indicators": "SELECT id_municipio || '/' || rede_nome AS unidade, " + ", ".join(
        f"({v} IS NULL)::INTEGER AS {n}" for n, v in INDICATORS.items()) + " FROM c_redes",
    "one_hot": "SELECT id_municipio || '/' || rede_nome AS unidade, " + ", ".join(
        f"(nome_regiao = '{v}')::INTEGER AS \"nome_regiao_{v}\"" for v in ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
               + " FROM c_redes",
    "standardize": """
WITH d AS (SELECT id_municipio || '/' || rede_nome AS unidade, particao, ln(1 + mun_densidade_demografica) AS a,
                  esc_pct_quadra AS b FROM c_redes WHERE mun_densidade_demografica IS NOT NULL)
SELECT unidade, round((a - (SELECT avg(a) FROM d WHERE particao = 'treino'))
                      / (SELECT stddev_pop(a) FROM d WHERE particao = 'treino'), 6) AS mun_densidade_demografica,
       round((b - (SELECT avg(b) FROM d WHERE particao = 'treino'))
             / (SELECT stddev_pop(b) FROM d WHERE particao = 'treino'), 6) AS esc_pct_quadra FROM d""",
}
