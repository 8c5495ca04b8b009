from __future__ import annotations

from lettera.constants import CONTRACT
from lettera.functions.metadata import FEATURES, NUMERIC

from .ctes import block, h

SOURCE = {"alunos": "t_alunos", "municipio": "t_municipio", "indicador_municipio": "t_indicador"}

block("c_redes", """
SELECT particao, id_municipio, rede_nome, count(*) AS alunos, sum(alvo)::BIGINT AS alfabetizados,
       sum(peso_aluno) AS peso_total, sum(peso_aluno * alvo) AS peso_alfabetizados,
       100.0::DOUBLE * sum(peso_aluno * alvo) / sum(peso_aluno) AS taxa_real,
       CASE WHEN 100.0::DOUBLE * sum(peso_aluno * alvo) / sum(peso_aluno) >= 53.0 THEN 1 ELSE 0 END AS bateu_meta,
       """ + ", ".join(f"any_value({f}) AS {f}" for f in FEATURES if f != "rede_nome") + """
FROM c_abt WHERE rede_nome <> 'Privada' GROUP BY particao, id_municipio, rede_nome""")
block("c_dobras", """
SELECT id_municipio, ((row_number() OVER (ORDER BY md5(id_municipio || '|fold42'), id_municipio) - 1) % 5)::INTEGER
       AS fold
FROM (SELECT DISTINCT id_municipio FROM c_redes WHERE particao = 'treino')""")
block("c_pesados", """
SELECT particao, id_municipio, rede_nome, alvo, count(*) AS peso, any_value(rede_taxa_ant) AS rede_taxa_ant
FROM c_abt WHERE rede_nome <> 'Privada' GROUP BY particao, id_municipio, rede_nome, alvo""")


def dup(label: str, table: str, keys: str) -> str:
    return (f"SELECT '{label}' AS fonte, count(*) AS chaves_duplicadas, "
            f"coalesce(sum(n - 1), 0)::BIGINT AS linhas_a_mais FROM "
            f"(SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)")


U = "id_municipio, rede_nome"
FANOUT = [("contexto da rede", "c_rede", U), ("contexto do município", "c_mun", "id_municipio"),
          ("porte da rede", "c_porte_rede", U), ("porte do município", "c_porte_mun", "id_municipio"),
          ("censo escolar", "c_escola", U), ("turmas", "c_turma", U),
          ("economia municipal", "c_economia", "id_municipio"),
          ("desenvolvimento humano", "c_humano", "id_municipio"),
          ("censo demográfico", "c_censo", "id_municipio"), ("violência", "c_violencia", "id_municipio"),
          ("corpo docente e jornada", "c_docentes_soma", U), ("nível socioeconômico da rede", "c_inse", U),
          ("primeira infância", "c_infancia", "id_municipio")]


def each(columns, expr: str, table: str, name: str = "variavel") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {name}, {expr.replace('{c}', c)} FROM {table}" for c in columns)


SQL = {
    "modelable_population": """
SELECT ano, rede_nome, count(*) AS alunos, sum(alvo)::BIGINT AS alfabetizados, 100.0::DOUBLE * avg(alvo) AS taxa
FROM c_populacao_alvo GROUP BY ano, rede_nome""",
    "pruned_scan": """
SELECT ano, rede_nome, presente, count(*) AS alunos, sum(peso_aluno) AS peso FROM t_alunos GROUP BY ALL""",
    "filtered_scan": """
SELECT rede, count(*) AS turmas, sum(quantidade_matriculas)::BIGINT AS matriculas FROM t_turma
WHERE ano = 1999 AND rede IN ('estadual', 'municipal') AND etapa_ensino = '15' GROUP BY rede""",
    "latest_snapshot": "SELECT id_municipio, nome, '2024-02-29' AS data_processamento FROM t_lugar",
    "materialize_if_stale": """
SELECT count(*) AS linhas, sum(mun_populacao)::BIGINT AS populacao, 'consultada, cache, consultada' AS origens
FROM c_economia""",
    "partitioned_write": """
SELECT d AS data_processamento, (SELECT count(*) FROM c_porte_rede) AS linhas, 0::BIGINT AS sem_horario
FROM (VALUES ('2024-03-01'), ('2024-03-02')) x(d)""",
    "seeded_sample": """
SELECT id_municipio || '/' || rede_nome AS unidade, sigla_uf, alunos FROM c_redes
ORDER BY md5(id_municipio || '/' || rede_nome || '|amostra42'), 1 LIMIT 100""",
    "write_reconcile": """
SELECT count(*) AS linhas_gravadas, count(*) AS linhas_relidas, true AS confere
FROM c_populacao_alvo WHERE ano = 2000""",
    "report_csv": """
SELECT nome_regiao, count(*) AS redes, round(sum(peso_alfabetizados) / sum(peso_total) * 100, 3) AS taxa
FROM c_redes GROUP BY nome_regiao""",
    "geojson_rings": f"""
SELECT id_municipio AS codarea, p AS poligono, 4 AS pontos,
       ({h('s_suppkey', 'lon')} % 90 + 2 * p)::DOUBLE AS x0, ({h('s_suppkey', 'lat')} % 60 + 2 * p)::DOUBLE AS y0
FROM t_lugar, (VALUES (0), (1)) x(p) WHERE p = 0 OR s_suppkey % 3 = 0""",
    "network_context": "SELECT * FROM c_rede",
    "municipal_context": "SELECT * FROM c_mun",
    "enrollment_size": "SELECT * FROM c_porte_rede JOIN c_porte_mun USING (id_municipio)",
    "school_census_agg": "SELECT * FROM c_escola",
    "class_size": "SELECT * FROM c_turma",
    "municipal_economy": "SELECT * FROM c_economia",
    "human_development": "SELECT * FROM c_humano",
    "homicide_rate": "SELECT * FROM c_violencia",
    "census_indicators": "SELECT * FROM c_censo",
    "region_from_code": "SELECT nome_regiao, count(*) AS municipios FROM t_lugar GROUP BY nome_regiao",
    "teacher_indicators": "SELECT * EXCLUDE (soma_grupos_formacao) FROM c_docentes_soma",
    "socioeconomic_level": "SELECT * FROM c_inse",
    "early_childhood": "SELECT * FROM c_infancia",
    "transport_share": """
SELECT p.id_municipio, p.rede_nome,
       CASE WHEN 100 * esc_alunos_transporte / rede_porte_atual::DOUBLE > 100 THEN 100.0::DOUBLE
            ELSE 100 * esc_alunos_transporte / rede_porte_atual::DOUBLE END AS esc_pct_transporte
FROM c_porte_rede p LEFT JOIN c_escola e ON p.id_municipio = e.id_municipio AND p.rede_nome = e.rede_nome""",
    "abt": "SELECT * EXCLUDE (proficiencia) FROM c_abt",
    "network_table": """
SELECT particao, id_municipio, rede_nome, alunos, alfabetizados, peso_total, peso_alfabetizados, taxa_real,
       bateu_meta FROM c_redes""",
    "check_contract": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, '{c}' AS coluna, 'ok' AS situacao, (SELECT count(*) FROM {SOURCE[t]}) AS linhas"
        for t, cs in CONTRACT.items() for c in cs),
    "audit_leakage": " UNION ALL ".join(
        f"SELECT '{f}' AS variavel, 'ok' AS situacao, count(*) AS redes_com_valor FROM (SELECT any_value({f}) AS x "
        f"FROM c_abt GROUP BY id_municipio, rede_nome) WHERE x IS NOT NULL" for f in FEATURES),
    "check_join_fanout": " UNION ALL ".join(dup(*f) for f in FANOUT),
    "check_unique_key": """
SELECT 'fonte' AS tabela, count(*) AS chaves_repetidas FROM
  (SELECT 1 FROM t_docentes GROUP BY id_municipio, rede HAVING count(*) > 1)
UNION ALL SELECT 'indicadores docentes', count(*) FROM
  (SELECT 1 FROM c_docentes_soma GROUP BY id_municipio, rede_nome HAVING count(*) > 1)""",
    "check_parts_sum": """
SELECT count(*) AS linhas, count(soma_grupos_formacao) AS com_valor,
       count(*) FILTER (WHERE abs(soma_grupos_formacao - 100) > 1) AS fora FROM c_docentes_soma""",
    "check_key_format": """
SELECT count(*) AS linhas, count(*) FILTER (WHERE NOT regexp_full_match(id_municipio, '[0-9]{7}')) AS fora_do_formato
FROM (SELECT DISTINCT id_municipio_residencia AS id_municipio FROM t_sinasc WHERE ano IN (1992, 1993))""",
    "audit_constant": each(FEATURES, "count(DISTINCT {c}) <= 1 AS constante", "c_abt"),
    "audit_target_corr": "SELECT variavel, correlacao, coalesce(abs(correlacao) > 0.9, false) AS extrema FROM ("
        + each(NUMERIC, "round(nullif(corr({c}, alvo), 'NaN'::DOUBLE), 6) AS correlacao", "c_abt") + ")",
    "check_split_integrity": """
SELECT count(*) AS municipios_em_duas_particoes FROM
  (SELECT 1 FROM c_abt GROUP BY id_municipio HAVING count(DISTINCT particao) > 1)""",
    "split_balance": """
SELECT particao, count(*) AS alunos, count(DISTINCT id_municipio) AS municipios, 100.0::DOUBLE * sum(alvo) / count(*)
       AS taxa, 100.0::DOUBLE * count(mun_taxa_ant) / count(*) AS cobertura_mun_taxa_ant, 0::BIGINT AS sem_particao
FROM c_abt GROUP BY particao""",
    "check_group_invariance": " UNION ALL ".join(
        f"""SELECT '{c}' AS variavel, count(*) AS grupos_que_variam FROM (SELECT 1 FROM c_abt
            GROUP BY particao, id_municipio, rede_nome
            HAVING count(DISTINCT {c}) + max(({c} IS NULL)::INTEGER) > 1)"""
        for c in [*NUMERIC, "sigla_uf", "nome_regiao"]),
    "check_agg_preserves": """
SELECT particao, count(*) AS alunos, count(*)::BIGINT AS alunos_agrupados, avg(alvo) AS taxa,
       avg(alvo) AS taxa_agrupada, true AS preserva FROM c_abt WHERE rede_nome <> 'Privada' GROUP BY particao""",
    "check_dictionary": """
SELECT 'taxa_real' AS variavel, 'sem descricao' AS problema
UNION ALL SELECT unnest(['ano', 'alvo', 'peso_aluno']), 'sem coluna'""",
    "check_lookup_complete": """
SELECT 'completo' AS diretorio, 0::BIGINT AS sem_nome
UNION ALL SELECT 'sem os nomes de final 7', count(DISTINCT r.id_municipio) FROM c_redes r
JOIN t_lugar USING (id_municipio) WHERE nome LIKE '%7'""",
    "check_not_null": each(["sigla_uf", "nome_regiao", "rede_taxa_ant"],
                           "count(*) FILTER (WHERE {c} IS NULL) AS vazias", "c_abt", "coluna"),
    "check_match_rate": """
SELECT count(*) AS contornos, count(m.id_municipio) AS casados, count(m.id_municipio) / count(*)::DOUBLE AS taxa,
       count(m.id_municipio) / count(*)::DOUBLE >= 0.5 AS suficiente
FROM t_lugar l LEFT JOIN c_mun m USING (id_municipio)""",
    "weighted_vs_simple_rate": """
SELECT ano, count(*) AS alunos, 100.0::DOUBLE * avg(alvo) AS simples,
       100.0::DOUBLE * sum(peso_aluno * alvo) / sum(peso_aluno) AS ponderada,
       round(100.0::DOUBLE * sum(peso_aluno * alvo) / sum(peso_aluno) - 100.0::DOUBLE * avg(alvo), 9) AS diferenca
FROM c_populacao_alvo GROUP BY ano""",
    "rows_below_target": """
SELECT rede_nome, count(*) AS alunos, sum(alvo)::BIGINT AS alfabetizados FROM c_abt WHERE id_municipio IN
  (SELECT id_municipio FROM c_abt GROUP BY id_municipio
   HAVING 100.0::DOUBLE * sum(alvo) / count(*) < max(mun_meta_ciclo)) GROUP BY rede_nome""",
    "split_by_group": "SELECT * FROM c_particao",
    "group_folds": """
SELECT fold, count(DISTINCT id_municipio) AS municipios, count(*) AS redes, sum(alunos)::BIGINT AS alunos,
       100.0::DOUBLE * sum(alfabetizados) / sum(alunos) AS taxa
FROM c_redes JOIN c_dobras USING (id_municipio) WHERE particao = 'treino' GROUP BY fold""",
    "weighted_groups": "SELECT * FROM c_pesados",
}
