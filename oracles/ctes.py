"""Shared SQL building blocks: one named block per table, composed by `with_blocks`.

The blocks are written straight from the table definitions, at row grain, and know nothing of
the DataFrame code they check.
"""
from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}


def h(key: str, salt) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 8))::BIGINT"


def with_blocks(sql: str, extra: dict[str, str] | None = None) -> str:
    blocks = {**BLOCKS, **(extra or {})}
    order: list[str] = []

    def visit(text: str, seen: tuple = ()):
        for name in blocks:
            if name not in order and name not in seen and re.search(rf"\b{name}\b", text):
                visit(blocks[name], (*seen, name))
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    head = ",\n".join(f"{n} AS MATERIALIZED ({blocks[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql


NET = "CASE l_returnflag WHEN 'A' THEN 'Estadual' WHEN 'R' THEN 'Municipal' WHEN 'N' THEN 'Privada' END"
CODE = "CASE l_returnflag WHEN 'A' THEN '2' WHEN 'R' THEN '3' WHEN 'N' THEN '4' END"
WORD = "CASE l_returnflag WHEN 'A' THEN 'estadual' WHEN 'R' THEN 'municipal' WHEN 'N' THEN 'privada' END"

block("t_lugar", """
SELECT s_suppkey, printf('%d%06d', n_regionkey + 1, s_suppkey) AS id_municipio, s_name AS nome,
       n_name AS sigla_uf, r_name AS nome_regiao, s_acctbal
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
block("t_linha", """
SELECT l.*, year(l_shipdate)::INTEGER AS ano, d.id_municipio, d.sigla_uf, d.nome_regiao, d.s_acctbal
FROM lineitem l JOIN t_lugar d ON l_suppkey = s_suppkey""")
block("t_alunos", f"""
SELECT ano, id_municipio, {NET} AS rede_nome, l_discount > 0 AS presente,
       CASE WHEN l_discount > 0 THEN CASE WHEN l_extendedprice >= 50000 THEN '1' ELSE '0' END END
         AS alfabetizado,
       CASE WHEN l_discount > 0 THEN l_extendedprice END AS proficiencia, l_quantity AS peso_aluno
FROM t_linha""")
block("t_ciclo", f"""
SELECT ano, id_municipio, sigla_uf, nome_regiao, s_acctbal, rede,
       sum(CASE WHEN l_discount > 0 AND l_extendedprice >= 50000 THEN l_quantity ELSE 0 END) AS wy,
       sum(CASE WHEN l_discount > 0 THEN l_quantity ELSE 0 END) AS w,
       sum(CASE WHEN l_discount > 0 THEN round(l_extendedprice * 100)::BIGINT ELSE 0 END) AS score,
       count(*) FILTER (WHERE l_discount > 0) AS presentes, count(*) AS todos
FROM (SELECT *, {CODE} AS rede FROM t_linha WHERE l_returnflag IN ('A', 'R')
      UNION ALL SELECT *, '5' AS rede FROM t_linha WHERE l_returnflag IN ('A', 'R')) x
GROUP BY ALL HAVING count(*) FILTER (WHERE l_discount > 0) > 0""")
block("t_municipio", """
SELECT ano, id_municipio, rede,
       CASE rede WHEN '2' THEN 'Estadual' WHEN '3' THEN 'Municipal' ELSE 'Pública' END AS rede_nome,
       sigla_uf, nome_regiao, 100.0::DOUBLE * wy / w AS taxa_alfabetizacao,
       score / presentes / 100 AS media_portugues
FROM t_ciclo""")
block("t_indicador", """
SELECT a.ano, a.id_municipio, a.taxa, a.percentual_participacao,
       a.taxa * a.percentual_participacao / 100.0::DOUBLE AS taxa_ajustada, a.alunos_presentes,
       a.origem, b.taxa + 0.05::DOUBLE * (100.0::DOUBLE - b.taxa) AS meta_taxa
FROM (SELECT ano, id_municipio, 100.0::DOUBLE * wy / w AS taxa,
             100.0::DOUBLE * presentes / todos AS percentual_participacao,
             presentes::INTEGER AS alunos_presentes,
             CASE WHEN s_acctbal >= 0 THEN 'oficial_inep' ELSE 'estimado' END AS origem
      FROM t_ciclo WHERE rede = '5') a
LEFT JOIN (SELECT ano + 1 AS ano, id_municipio, 100.0::DOUBLE * wy / w AS taxa
           FROM t_ciclo WHERE rede = '5') b
  ON a.ano = b.ano AND a.id_municipio = b.id_municipio""")


def flag(off: int, mod: int, zero: int) -> str:
    r = f"((l_partkey * 17 + {off}) % {mod})"
    return f"CASE WHEN {r} = 0 THEN NULL WHEN {r} <= {zero} THEN 0 ELSE 1 END"


block("t_escola", f"""
SELECT ano, id_municipio, {CODE} AS rede,
       CASE WHEN p_size > 40 THEN '2' ELSE '1' END AS tipo_localizacao,
       CASE WHEN p_size <= 3 THEN '2' ELSE '1' END AS tipo_situacao_funcionamento,
       q AS quantidade_matricula_fundamental_2_ano,
       CASE WHEN p_size > 30 THEN q // 2 ELSE 0 END AS quantidade_matricula_zona_residencia_rural,
       q - CASE WHEN p_size > 30 THEN q // 2 ELSE 0 END AS quantidade_matricula_zona_residencia_urbana,
       {flag(1, 5, 2)} AS agua_rede_publica, {flag(2, 6, 3)} AS esgoto_rede_publica,
       {flag(3, 9, 1)} AS energia_rede_publica, {flag(4, 7, 2)} AS internet,
       CASE WHEN (l_partkey * 17 + 5) % 8 = 0 THEN 'sem dado' WHEN (l_partkey * 17 + 5) % 8 <= 3 THEN '0'
            ELSE '1' END AS biblioteca_sala_leitura,
       {flag(6, 11, 7)} AS laboratorio_informatica, {flag(7, 10, 5)} AS quadra_esportes,
       {flag(8, 13, 1)} AS alimentacao, {flag(9, 6, 2)} AS profissional_coordenador,
       {flag(10, 12, 9)} AS profissional_psicologo, {flag(11, 14, 11)} AS profissional_assistente_social,
       CASE WHEN l_partkey % 10 = 0 THEN '' WHEN l_partkey % 10 <= 6 THEN '0'
            ELSE CAST(l_partkey % 3 + 1 AS VARCHAR) END AS tipo_localizacao_diferenciada,
       q * 5 AS quantidade_matricula_fundamental_anos_iniciais,
       l_partkey % 20 AS quantidade_docente_fundamental_anos_iniciais,
       q * (10 + l_partkey % 30) // 20 AS quantidade_matricula_infantil_pre_escola,
       l_partkey % 12 AS quantidade_sala_utilizada,
       q * (p_size % 10) // 10 AS quantidade_matricula_utiliza_transporte_publico,
       q * 8 AS quantidade_matricula_educacao_basica
FROM (SELECT ano, id_municipio, l_returnflag, l_partkey, sum(l_quantity)::BIGINT AS q
      FROM t_linha GROUP BY ALL) JOIN part ON l_partkey = p_partkey""")
block("t_turma", f"""
SELECT ano, id_municipio, {WORD} AS rede, CASE WHEN l_orderkey % 3 < 2 THEN '15' ELSE '16' END
       AS etapa_ensino, q AS quantidade_matriculas
FROM (SELECT ano, id_municipio, l_returnflag, l_orderkey, sum(l_quantity)::BIGINT AS q
      FROM t_linha GROUP BY ALL)""")
block("t_pib", """
SELECT ano, id_municipio, sum(l_extendedprice) AS pib, sum(l_extendedprice * 0.5::DOUBLE) AS va,
       sum(l_extendedprice * 0.5::DOUBLE) FILTER (WHERE l_partkey % 3 = 0) AS va_agropecuaria,
       sum(l_extendedprice * 0.5::DOUBLE) FILTER (WHERE l_partkey % 3 = 1) AS va_servicos
FROM t_linha GROUP BY ALL""")
block("t_populacao", """
SELECT ano, id_municipio, (sum(l_quantity) * 10)::BIGINT AS populacao FROM t_linha GROUP BY ALL""")
block("t_adh", f"""
SELECT 1996 AS ano, id_municipio, {h('s_suppkey', 'idhm')} % 4000 / 10000.0::DOUBLE AS idhm,
       {h('s_suppkey', 'idhm_e')} % 4000 / 10000.0::DOUBLE AS idhm_e,
       {h('s_suppkey', 'idhm_r')} % 4000 / 10000.0::DOUBLE AS idhm_r,
       {h('s_suppkey', 'renda')} % 90000 / 100.0::DOUBLE AS renda_pc,
       {h('s_suppkey', 'gini')} % 600 / 1000.0::DOUBLE AS indice_gini,
       {h('s_suppkey', 'analf')} % 400 / 10.0::DOUBLE AS taxa_analfabetismo_18_mais,
       {h('s_suppkey', 'expect')} % 500 / 50.0::DOUBLE AS expectativa_anos_estudo,
       {h('s_suppkey', 'desloc')} % 300 / 10.0::DOUBLE AS taxa_vulner_desloc_1_hora
FROM t_lugar""")
block("t_avs", """
SELECT ano, id_municipio, avg(round(l_tax * 100)::BIGINT) / 10 AS ivs,
       avg(round(l_discount * 100)::BIGINT) / 10 AS ivs_infraestrutura_urbana,
       avg(l_quantity) / 50 AS ivs_capital_humano
FROM t_linha WHERE l_suppkey % 11 <> 0 GROUP BY ano, id_municipio, l_linestatus""")
block("t_sim", f"""
SELECT year(ts)::INTEGER - 25 AS ano, id_municipio,
       CASE WHEN user_id % 30 < 20 THEN 'X' || CAST(user_id % 30 + 80 AS VARCHAR)
            ELSE 'Y0' || CAST(user_id % 30 - 20 AS VARCHAR) END AS causa_basica,
       count(*) AS numero_obitos
FROM events JOIN t_lugar ON s_suppkey = {h('user_id', 'sim')} % (SELECT count(*) FROM supplier)
GROUP BY ALL""")
block("t_censo", f"""
SELECT d.id_municipio, d.sigla_uf, populacao, domicilios, {h('s_suppkey', 'area')} % 400 AS area,
       ({h('s_suppkey', 'alfab')} % 300 + 700) / 1000.0::DOUBLE AS taxa_alfabetizacao,
       {h('s_suppkey', 'idade')} % 25 + 20 AS idade_mediana
FROM t_lugar d JOIN (SELECT id_municipio, sum(l_quantity)::BIGINT AS populacao, count(*) AS domicilios
                     FROM t_linha GROUP BY ALL) p ON d.id_municipio = p.id_municipio""")
block("t_esgoto", """
SELECT id_municipio, p_type AS tipo_esgotamento_sanitario, sum(l_quantity)::BIGINT AS populacao
FROM t_linha JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
block("t_agua", """
SELECT id_municipio, l_linestatus AS tipo_ligacao_rede_geral, sum(l_quantity)::BIGINT AS populacao
FROM t_linha GROUP BY ALL""")
block("t_docentes_k", """
SELECT id_municipio, ano, rede, localizacao,
       CAST(s_suppkey AS VARCHAR) || '-' || CAST(ano AS VARCHAR) || '-' || rede || '-' || localizacao AS k
FROM t_lugar, (VALUES (1998), (1999)) a(ano), (VALUES ('estadual'), ('municipal'), ('privada')) r(rede),
     (VALUES ('total'), ('urbana')) t(localizacao)""")
block("t_docentes", f"""
SELECT ano, id_municipio, rede, localizacao,
       CAST({h('k', 'g1')} % 60 AS VARCHAR) AS afd_ef_anos_iniciais_grupo_1,
       CAST({h('k', 'g2')} % 20 AS VARCHAR) AS afd_ef_anos_iniciais_grupo_2,
       CAST({h('k', 'g3')} % 10 AS VARCHAR) AS afd_ef_anos_iniciais_grupo_3,
       CAST({h('k', 'g4')} % 5 AS VARCHAR) AS afd_ef_anos_iniciais_grupo_4,
       CAST(100 - {h('k', 'g1')} % 60 - {h('k', 'g2')} % 20 - {h('k', 'g3')} % 10 - {h('k', 'g4')} % 5
            AS VARCHAR) AS afd_ef_anos_iniciais_grupo_5,
       CASE WHEN {h('k', 'gap_ird')} % 15 = 0 THEN '--' ELSE CAST({h('k', 'ird1')} % 40 AS VARCHAR) END
         AS ird_baixa_regularidade,
       CAST({h('k', 'ird2')} % 30 AS VARCHAR) AS ird_media_baixa,
       CAST({h('k', 'ied5')} % 25 AS VARCHAR) AS ied_ef_anos_iniciais_nivel_5,
       CASE WHEN {h('k', 'gap_ied')} % 15 = 0 THEN '--' ELSE CAST({h('k', 'ied6')} % 15 AS VARCHAR) END
         AS ied_ef_anos_iniciais_nivel_6,
       CASE WHEN {h('k', 'gap_had')} % 15 = 0 THEN '--'
            ELSE CAST(({h('k', 'had')} % 40 + 30) / 10.0::DOUBLE AS VARCHAR) END AS had_ef_anos_iniciais
FROM t_docentes_k""")
block("t_inse", f"""
SELECT ano, id_municipio, rede, tipo_localizacao,
       CASE WHEN {h('k', 'zero')} % 20 = 0 THEN '0'
            ELSE CAST(({h('k', 'inse')} % 300 + 335) / 100.0::DOUBLE AS VARCHAR) END AS inse
FROM (SELECT id_municipio, ano, rede, tipo_localizacao,
             CAST(s_suppkey AS VARCHAR) || '-' || CAST(ano AS VARCHAR) || '-' || rede || '-' ||
             tipo_localizacao AS k
      FROM t_lugar, (VALUES (1997), (1999)) a(ano), (VALUES ('2'), ('3'), ('4')) r(rede),
           (VALUES ('0'), ('1')) t(tipo_localizacao))""")
block("t_sinasc", f"""
SELECT (1990 + {h('c_custkey', 'ano')} % 5)::INTEGER AS ano, id_municipio AS id_municipio_residencia,
       ['1', '2', '3', '4', '5', '9'][{h('c_custkey', 'mae')} % 6 + 1] AS escolaridade_mae,
       CASE WHEN {h('c_custkey', 'idade')} % 50 = 0 THEN 'ignorada'
            ELSE CAST({h('c_custkey', 'idade')} % 50 + 9 AS VARCHAR) END AS idade_mae
FROM customer JOIN t_lugar ON s_suppkey = {h('c_custkey', 'lugar')} % (SELECT count(*) FROM supplier)""")

# -- context tables ---------------------------------------------------------------------------
block("c_populacao_alvo", """
SELECT *, CASE WHEN alfabetizado = '1' THEN 1 ELSE 0 END AS alvo FROM t_alunos WHERE presente""")
block("c_rede", """
SELECT id_municipio, rede_nome, taxa_alfabetizacao AS rede_taxa_ant,
       media_portugues AS rede_media_portugues_ant,
       median(taxa_alfabetizacao) OVER (PARTITION BY sigla_uf, rede_nome) AS uf_rede_taxa_ant,
       taxa_alfabetizacao - median(taxa_alfabetizacao) OVER (PARTITION BY sigla_uf, rede_nome) AS rede_vs_uf
FROM t_municipio WHERE ano = 1999 AND rede IN ('2', '3')""")
block("c_mun", """
SELECT a.id_municipio, a.taxa AS mun_taxa_ant, a.percentual_participacao AS mun_participacao_ant,
       a.taxa_ajustada AS mun_taxa_ajustada_ant, a.alunos_presentes AS mun_alunos_ant,
       m.meta_taxa AS mun_meta_ciclo, m.meta_taxa - a.taxa AS mun_gap_meta
FROM (SELECT * FROM t_indicador WHERE ano = 1999 AND origem = 'oficial_inep') a
LEFT JOIN (SELECT id_municipio, meta_taxa FROM t_indicador WHERE ano = 2000 AND origem = 'oficial_inep') m
  USING (id_municipio)""")
block("c_porte_rede", """
SELECT id_municipio, rede_nome, count(*) AS rede_porte_atual FROM t_alunos WHERE ano = 2000 GROUP BY ALL""")
block("c_porte_mun", """
SELECT id_municipio, count(*) AS mun_porte_atual FROM t_alunos WHERE ano = 2000 GROUP BY ALL""")


def share(c: str) -> str:
    return f"round(100 * avg(coalesce({c}, 0)), 1)"


block("c_escola", f"""
SELECT id_municipio, CASE rede WHEN '2' THEN 'Estadual' WHEN '3' THEN 'Municipal' END AS rede_nome,
       count(*) AS esc_quantidade,
       round(100 * (sum(CASE WHEN tipo_localizacao = '2' THEN quantidade_matricula_fundamental_2_ano ELSE 0 END)
             / nullif(sum(quantidade_matricula_fundamental_2_ano), 0)::DOUBLE), 1) AS esc_pct_rural,
       round(100 * (sum(quantidade_matricula_zona_residencia_rural)
             / nullif(sum(quantidade_matricula_zona_residencia_rural)
                      + sum(quantidade_matricula_zona_residencia_urbana), 0)::DOUBLE), 1) AS esc_pct_alunos_zona_rural,
       {share('agua_rede_publica')} AS esc_pct_agua_rede, {share('esgoto_rede_publica')} AS esc_pct_esgoto_rede,
       {share('energia_rede_publica')} AS esc_pct_energia_rede, {share('internet')} AS esc_pct_internet,
       {share('TRY_CAST(biblioteca_sala_leitura AS DOUBLE)')} AS esc_pct_biblioteca_ou_sala_leitura,
       {share('laboratorio_informatica')} AS esc_pct_lab_informatica, {share('quadra_esportes')} AS esc_pct_quadra,
       {share('alimentacao')} AS esc_pct_alimentacao, {share('profissional_coordenador')} AS esc_pct_coordenador,
       {share('profissional_psicologo')} AS esc_pct_psicologo,
       {share('profissional_assistente_social')} AS esc_pct_assistente_social,
       round(100 * avg(CASE WHEN TRY_CAST(tipo_localizacao_diferenciada AS DOUBLE) > 0 THEN 1 ELSE 0 END), 1)
         AS esc_pct_area_diferenciada,
       round(sum(quantidade_matricula_fundamental_anos_iniciais)
             / nullif(sum(quantidade_docente_fundamental_anos_iniciais), 0)::DOUBLE, 1) AS esc_alunos_por_docente,
       sum(quantidade_sala_utilizada)::BIGINT AS esc_salas,
       sum(quantidade_matricula_utiliza_transporte_publico)::BIGINT AS esc_alunos_transporte,
       sum(quantidade_matricula_educacao_basica)::BIGINT AS esc_matriculas
FROM t_escola WHERE ano = 1999 AND rede IN ('2', '3') AND tipo_situacao_funcionamento = '1'
GROUP BY id_municipio, rede""")
block("c_turma", """
SELECT id_municipio, CASE rede WHEN 'estadual' THEN 'Estadual' WHEN 'municipal' THEN 'Municipal' END AS rede_nome,
       round(avg(quantidade_matriculas), 1) AS turma_media_alunos
FROM t_turma WHERE ano = 1999 AND rede IN ('estadual', 'municipal') AND etapa_ensino = '15'
GROUP BY ALL""")
block("c_economia", """
SELECT p.id_municipio, round(p.pib / nullif(pop.populacao, 0), 0) AS mun_pib_per_capita,
       round(100 * p.va_agropecuaria / nullif(p.va, 0), 1) AS mun_pct_agropecuaria,
       round(100 * p.va_servicos / nullif(p.va, 0), 1) AS mun_pct_servicos, pop.populacao AS mun_populacao
FROM t_pib p JOIN t_populacao pop ON p.id_municipio = pop.id_municipio AND p.ano = pop.ano
WHERE p.ano = 1997""")
block("c_humano", """
SELECT a.id_municipio, idhm AS mun_idhm, idhm_e AS mun_idhm_educacao, idhm_r AS mun_idhm_renda,
       renda_pc AS mun_renda_per_capita, indice_gini AS mun_gini,
       taxa_analfabetismo_18_mais AS mun_analfabetismo_adulto,
       expectativa_anos_estudo AS mun_expectativa_estudo,
       taxa_vulner_desloc_1_hora AS mun_pct_vulner_deslocamento_1h, v.ivs AS mun_ivs,
       v.ivs_infraestrutura_urbana AS mun_ivs_infraestrutura, v.ivs_capital_humano AS mun_ivs_capital_humano
FROM t_adh a LEFT JOIN (SELECT id_municipio, avg(ivs) AS ivs,
                               avg(ivs_infraestrutura_urbana) AS ivs_infraestrutura_urbana,
                               avg(ivs_capital_humano) AS ivs_capital_humano
                        FROM t_avs WHERE ano = 1996 GROUP BY id_municipio) v USING (id_municipio)
WHERE a.ano = 1996""")
block("c_violencia", """
SELECT e.id_municipio, round(100000 * coalesce(o.obitos, 0) / e.mun_populacao::DOUBLE, 1) AS mun_taxa_homicidio
FROM c_economia e LEFT JOIN (SELECT id_municipio, sum(numero_obitos) AS obitos FROM t_sim
       WHERE ano = 1999 AND regexp_matches(causa_basica, '^(X8[5-9]|X9[0-9]|Y0[0-9])')
       GROUP BY id_municipio) o USING (id_municipio)""")
block("c_censo", """
SELECT b.id_municipio, b.sigla_uf,
       CASE substr(b.id_municipio, 1, 1) WHEN '1' THEN 'AFRICA' WHEN '2' THEN 'AMERICA' WHEN '3' THEN 'ASIA'
            WHEN '4' THEN 'EUROPE' WHEN '5' THEN 'MIDDLE EAST' END AS nome_regiao,
       round(b.populacao / nullif(b.area, 0)::DOUBLE, 1) AS mun_densidade_demografica,
       round(b.populacao / nullif(b.domicilios, 0)::DOUBLE, 2) AS mun_pessoas_por_domicilio,
       round(100 * b.taxa_alfabetizacao, 1) AS mun_alfabetizacao_adulta, b.idade_mediana AS mun_idade_mediana,
       round(100 * e.com_esgoto / nullif(b.populacao, 0)::DOUBLE, 1) AS mun_pct_esgoto_adequado,
       round(100 * a.com_agua / nullif(b.populacao, 0)::DOUBLE, 1) AS mun_pct_agua_rede_geral
FROM t_censo b
LEFT JOIN (SELECT id_municipio, sum(populacao) AS com_esgoto FROM t_esgoto
           WHERE tipo_esgotamento_sanitario = 'ECONOMY' GROUP BY id_municipio) e USING (id_municipio)
LEFT JOIN (SELECT id_municipio, sum(populacao) AS com_agua FROM t_agua
           WHERE tipo_ligacao_rede_geral = 'F' GROUP BY id_municipio) a USING (id_municipio)""")
block("c_docentes_soma", """
SELECT id_municipio, upper(substr(rede, 1, 1)) || lower(substr(rede, 2)) AS rede_nome,
       TRY_CAST(afd_ef_anos_iniciais_grupo_1 AS DOUBLE) AS esc_pct_docentes_formacao_adequada,
       TRY_CAST(ird_baixa_regularidade AS DOUBLE) + TRY_CAST(ird_media_baixa AS DOUBLE)
         AS esc_pct_docentes_baixa_regularidade,
       TRY_CAST(ied_ef_anos_iniciais_nivel_5 AS DOUBLE) + TRY_CAST(ied_ef_anos_iniciais_nivel_6 AS DOUBLE)
         AS esc_pct_docentes_alto_esforco,
       TRY_CAST(had_ef_anos_iniciais AS DOUBLE) AS esc_horas_aula_diarias,
       TRY_CAST(afd_ef_anos_iniciais_grupo_1 AS DOUBLE) + TRY_CAST(afd_ef_anos_iniciais_grupo_2 AS DOUBLE)
       + TRY_CAST(afd_ef_anos_iniciais_grupo_3 AS DOUBLE) + TRY_CAST(afd_ef_anos_iniciais_grupo_4 AS DOUBLE)
       + TRY_CAST(afd_ef_anos_iniciais_grupo_5 AS DOUBLE) AS soma_grupos_formacao
FROM t_docentes WHERE ano = 1998 AND lower(localizacao) = 'total' AND lower(rede) IN ('estadual', 'municipal')""")
block("c_inse", """
SELECT id_municipio, CASE rede WHEN '2' THEN 'Estadual' WHEN '3' THEN 'Municipal' END AS rede_nome,
       nullif(TRY_CAST(inse AS DOUBLE), 0) AS esc_inse_medio
FROM t_inse WHERE ano = 1997 AND tipo_localizacao = '0' AND rede IN ('2', '3')""")
block("c_infancia", """
SELECT coalesce(n.id_municipio, p.id_municipio) AS id_municipio, mun_pct_maes_8_anos_estudo,
       mun_pct_maes_adolescentes, mun_indice_pre_escola
FROM (SELECT id_municipio_residencia AS id_municipio,
             round(100 * (count(*) FILTER (WHERE escolaridade_mae IN ('4', '5'))
               / nullif(count(*) FILTER (WHERE escolaridade_mae IN ('1', '2', '3', '4', '5')), 0)::DOUBLE), 1)
               AS mun_pct_maes_8_anos_estudo,
             round(100 * (count(*) FILTER (WHERE TRY_CAST(idade_mae AS BIGINT) BETWEEN 10 AND 19)
               / nullif(count(*) FILTER (WHERE TRY_CAST(idade_mae AS BIGINT) BETWEEN 10 AND 60), 0)::DOUBLE), 1)
               AS mun_pct_maes_adolescentes
      FROM t_sinasc WHERE ano IN (1992, 1993) GROUP BY 1) n
FULL JOIN (SELECT id_municipio,
                  round((sum(quantidade_matricula_infantil_pre_escola) / 2.0::DOUBLE)
                        / nullif(sum(quantidade_matricula_fundamental_anos_iniciais) / 5.0::DOUBLE, 0), 2)
                    AS mun_indice_pre_escola
           FROM t_escola WHERE ano = 1998 AND tipo_situacao_funcionamento = '1' GROUP BY 1) p
  ON n.id_municipio = p.id_municipio""")
block("c_lugares_ordem", f"""
SELECT id_municipio, row_number() OVER (ORDER BY md5(id_municipio || '|42'), id_municipio) AS pos,
       count(*) OVER () AS total
FROM (SELECT DISTINCT id_municipio FROM t_alunos WHERE ano = 2000 AND presente)""")
block("c_particao", """
SELECT id_municipio, CASE WHEN pos <= floor(total * 0.6) THEN 'treino'
         WHEN pos <= floor(total * 0.6) + floor((total - floor(total * 0.6)) * 0.5) THEN 'validacao'
         ELSE 'teste' END AS particao
FROM c_lugares_ordem""")
block("c_abt", """
SELECT a.ano, a.id_municipio, a.rede_nome, a.alvo, a.peso_aluno, a.proficiencia, particao,
       r.* EXCLUDE (id_municipio, rede_nome), m.* EXCLUDE (id_municipio),
       rede_porte_atual, mun_porte_atual,
       e.* EXCLUDE (id_municipio, rede_nome, esc_salas, esc_alunos_transporte, esc_matriculas),
       turma_media_alunos, ec.* EXCLUDE (id_municipio), hu.* EXCLUDE (id_municipio),
       ce.* EXCLUDE (id_municipio), mun_taxa_homicidio,
       d.* EXCLUDE (id_municipio, rede_nome, soma_grupos_formacao), esc_inse_medio,
       pi.* EXCLUDE (id_municipio),
       rede_taxa_ant - mun_taxa_ant AS rede_vs_municipio,
       rede_porte_atual / mun_porte_atual::DOUBLE AS rede_peso_no_municipio,
       esc_matriculas / nullif(esc_salas, 0)::DOUBLE AS esc_alunos_por_sala,
       100 * esc_alunos_transporte / nullif(esc_matriculas, 0)::DOUBLE AS esc_pct_transporte
FROM c_populacao_alvo a
JOIN c_particao USING (id_municipio)
LEFT JOIN c_rede r ON a.id_municipio = r.id_municipio AND a.rede_nome = r.rede_nome
LEFT JOIN c_mun m ON a.id_municipio = m.id_municipio
LEFT JOIN c_porte_rede pr ON a.id_municipio = pr.id_municipio AND a.rede_nome = pr.rede_nome
LEFT JOIN c_porte_mun pm ON a.id_municipio = pm.id_municipio
LEFT JOIN c_escola e ON a.id_municipio = e.id_municipio AND a.rede_nome = e.rede_nome
LEFT JOIN c_turma t ON a.id_municipio = t.id_municipio AND a.rede_nome = t.rede_nome
LEFT JOIN c_economia ec ON a.id_municipio = ec.id_municipio
LEFT JOIN c_humano hu ON a.id_municipio = hu.id_municipio
LEFT JOIN c_censo ce ON a.id_municipio = ce.id_municipio
LEFT JOIN c_violencia v ON a.id_municipio = v.id_municipio
LEFT JOIN c_docentes_soma d ON a.id_municipio = d.id_municipio AND a.rede_nome = d.rede_nome
LEFT JOIN c_inse i ON a.id_municipio = i.id_municipio AND a.rede_nome = i.rede_nome
LEFT JOIN c_infancia pi ON a.id_municipio = pi.id_municipio
WHERE a.ano = 2000""")
