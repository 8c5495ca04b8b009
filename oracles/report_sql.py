from __future__ import annotations

from lettera.functions.metadata import FACTORS

from .ctes import block, h
from .profile_sql import r

block("r_nota", f"""
SELECT *, round(100.0::DOUBLE * p_cumprir, 2) AS p_cumprir_pct, round(100.0::DOUBLE * (1 - p_cumprir), 2) AS risco
FROM (SELECT *, id_municipio || '/' || rede_nome AS unidade,
        round(0.6::DOUBLE * ({h("(id_municipio || '/' || rede_nome)", 'score')} % 10000 / 10000.0::DOUBLE)
              + 0.4::DOUBLE * (coalesce(rede_taxa_ant, 50.0) / 100.0::DOUBLE), 4) AS p_cumprir FROM c_redes)""")
block("r_teste", "SELECT * FROM r_nota WHERE particao = 'teste'")
block("r_alunos", """
SELECT a.particao, a.alvo AS y, n.unidade, n.p_cumprir, n.rede_taxa_ant, n.alfabetizados / n.alunos::DOUBLE AS teto,
       n.id_municipio, n.unidade || '/' || CAST(a.alvo AS VARCHAR) AS desempate
FROM c_abt a JOIN r_nota n USING (id_municipio, rede_nome)""")
block("r_tres", """
WITH f AS (SELECT particao, median(rede_taxa_ant) AS fill FROM r_nota GROUP BY particao),
     x AS (SELECT * FROM r_alunos JOIN f USING (particao) WHERE particao <> 'treino')
SELECT particao, y, desempate, 'modelo' AS nota, p_cumprir AS p FROM x
UNION ALL SELECT particao, y, desempate, 'repetir o ciclo anterior', coalesce(rede_taxa_ant, fill) / 100.0::DOUBLE FROM x
UNION ALL SELECT particao, y, desempate, 'AUC máxima possível', teto FROM x""")


def auc(by: str, table: str) -> str:
    """Probability that a random positive outranks a random negative: sum of mean ranks."""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
SELECT {by + ',' if by else ''}
       (sum(posto) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1)
         / 2.0::DOUBLE) / nullif(count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0), 0) AS auc,
       avg(-CASE WHEN y = 1 THEN ln(pc) ELSE ln(1 - pc) END) AS log_loss,
       avg((y - pc) * (y - pc)) AS brier, count(*)::DOUBLE AS peso
FROM (SELECT *, greatest(least(p, 1 - 1e-6), 1e-6) AS pc,
             rank() OVER ({part} ORDER BY p)
             + (count(*) OVER (PARTITION BY {by + ',' if by else ''} p) - 1) / 2.0::DOUBLE AS posto FROM {table})
{'GROUP BY ' + by if by else ''}"""


def rows_bin(n: int, by: str = "", value: str = "p", tie: str = "desempate") -> str:
    return f"""greatest(1, ((row_number() OVER ({by} ORDER BY {value}, md5({tie}), {tie}) - 1) * {n}
      + count(*) OVER ({by}) - 2) // greatest(count(*) OVER ({by}) - 1, 1))"""


block("r_metricas", auc("particao, nota", "r_tres"))
block("r_dobra", """
SELECT fold, 1 AS w, a.alvo AS y, a.rede_taxa_ant, n.alfabetizados / n.alunos::DOUBLE AS teto
FROM c_abt a JOIN c_dobras USING (id_municipio) JOIN c_redes n USING (id_municipio, rede_nome)
WHERE a.particao = 'treino'""")
block("r_dobra_taxa", """
SELECT fold, (sum(sy) OVER () - sy) / (sum(n) OVER () - n)::DOUBLE AS taxa
FROM (SELECT fold, sum(y) AS sy, count(*) AS n FROM r_dobra GROUP BY fold)""")
block("r_bases", """
SELECT fold, y, 'constante' AS referencia, taxa AS p FROM r_dobra JOIN r_dobra_taxa USING (fold)
UNION ALL SELECT fold, y, 'repetir o ciclo anterior', coalesce(rede_taxa_ant / 100, taxa)
  FROM r_dobra JOIN r_dobra_taxa USING (fold)
UNION ALL SELECT fold, y, 'melhor previsão possível', teto FROM r_dobra""")
block("r_bases_medidas", auc("referencia, fold", "r_bases"))
MIXES = [("regressão logística", 0.2), ("regressão logística", 0.4), ("gradient boosting", 0.6),
         ("random forest", 0.5), ("random forest", 0.8)]
block("r_misturas", " UNION ALL ".join(f"""
SELECT fold, bateu_meta AS y, '{f}' AS familia, 'mistura={m}' AS parametros,
       round({m}::DOUBLE * p_cumprir + {1 - m}::DOUBLE * ({h('unidade', 'mistura')} % 10000 / 10000.0::DOUBLE), 6) AS p
FROM r_nota JOIN c_dobras USING (id_municipio) WHERE particao = 'treino'""" for f, m in MIXES))
block("r_misturas_dobra", auc("familia, parametros, fold", "r_misturas"))
SUMMARY = ", ".join([r("avg(auc)", "auc"), r("stddev_samp(auc)", "auc_desvio"), r("avg(log_loss)", "log_loss"),
                     r("stddev_samp(log_loss)", "log_loss_desvio"), r("avg(brier)", "brier")])
block("r_busca", f"SELECT familia, parametros, {SUMMARY} FROM r_misturas_dobra GROUP BY familia, parametros")
block("r_melhores", """
SELECT * EXCLUDE (o) FROM (SELECT *, row_number() OVER (PARTITION BY familia ORDER BY log_loss, parametros) AS o
FROM r_busca) WHERE o = 1""")
block("r_nacional", """
SELECT sum(peso_total) AS peso_nacional, 100.0::DOUBLE * sum(peso_alfabetizados) / sum(peso_total) AS taxa_nacional
FROM r_nota""")
block("r_ganhos", """
SELECT r.*, taxa_nacional, 100.0::DOUBLE * (0.53::DOUBLE * peso_total - peso_alfabetizados) / peso_nacional AS ganho_pp
FROM r_nota r, r_nacional WHERE p_cumprir < 0.5 AND bateu_meta = 0""")
block("r_corrido", """
SELECT *, sum(ganho_pp) OVER (ORDER BY ganho_pp DESC, md5(unidade), unidade ROWS UNBOUNDED PRECEDING) AS acumulado,
       row_number() OVER (ORDER BY ganho_pp DESC, md5(unidade), unidade) AS ordem,
       sum(ganho_pp) OVER () AS total FROM r_ganhos""")
BAND = """CASE WHEN {p} < 0 THEN NULL WHEN {p} <= 25 THEN 'até 25%' WHEN {p} <= 50 THEN '25 a 50%'
  WHEN {p} <= 75 THEN '50 a 75%' WHEN {p} <= 100 THEN 'acima de 75%' END"""
LABELS = ["até 25%", "25 a 50%", "50 a 75%", "acima de 75%"]
block("r_mun", """
SELECT id_municipio, round(sum(p_cumprir_pct * alunos) / sum(alunos), 9) AS p, sum(alunos)::BIGINT AS alunos
FROM r_nota GROUP BY id_municipio""")
block("r_silhueta", """
SELECT nome_regiao, pedaco, n / sum(n) OVER (PARTITION BY nome_regiao)::DOUBLE AS fracao
FROM (SELECT nome_regiao, least(floor(p_cumprir_pct / 10), 9) AS pedaco, count(*) AS n FROM r_nota GROUP BY 1, 2)""")
CUTS = [("alunos avaliados", "CASE WHEN alunos <= 19 THEN 'menos de 20' WHEN alunos <= 100 THEN '20 a 100' "
                             "WHEN alunos <= 1000 THEN '101 a 1.000' ELSE 'mais de 1.000' END"),
        ("porte do município", "CASE WHEN mun_populacao <= 20000 THEN 'até 20 mil' "
                               "WHEN mun_populacao <= 100000 THEN '20 a 100 mil' "
                               "WHEN mun_populacao > 100000 THEN 'mais de 100 mil' END"),
        ("região", "nome_regiao"), ("rede", "rede_nome"),
        ("estado", "CASE WHEN sigla_uf = 'NATION_1' THEN 'NATION_1' ELSE 'demais UFs' END")]
block("r_recortes", " UNION ALL ".join(
    f"SELECT '{k}' AS corte, {e} AS recorte, alunos, bateu_meta AS y, p_cumprir AS p FROM r_teste" for k, e in CUTS))
block("r_recortes_auc", auc("corte, recorte", "r_recortes"))
block("r_foco", " UNION ALL ".join(f"""
SELECT '{f}' AS variavel, {f}::DOUBLE AS valor, nome_regiao IN ('AFRICA', 'AMERICA') AND p_cumprir_pct <= 25 AS baixo,
       nome_regiao IN ('ASIA', 'EUROPE') AND p_cumprir_pct > 75 AS alto FROM r_nota""" for f in FACTORS))


def calib(label: str, table: str) -> str:
    return f"""
SELECT '{label}' AS corte, faixa, sum(w)::DOUBLE AS peso, round(sum(w * p) / sum(w), 6) AS prevista,
       round(sum(w * y) / sum(w)::DOUBLE, 6) AS observada,
       round(100.0::DOUBLE * abs(sum(w * p) / sum(w) - sum(w * y) / sum(w)::DOUBLE), 6) AS distancia_pp
FROM (SELECT *, {rows_bin(10)} AS faixa FROM ({table}) t) GROUP BY faixa"""


PUPILS = "SELECT desempate, p, y, {w} AS w FROM r_tres WHERE particao = 'validacao' AND nota = 'modelo'"
SQL = {
    "metrics_weighted": f"SELECT particao, nota, {r('auc', 'auc')}, {r('log_loss', 'log_loss')}, {r('brier', 'brier')}, "
                        "peso FROM r_metricas",
    "roc_points": """
SELECT nota, round(p, 6) AS limiar,
       round(sum(sum(1 - y)) OVER (PARTITION BY nota ORDER BY p DESC) / sum(sum(1 - y)) OVER (PARTITION BY nota), 6) AS fpr,
       round(sum(sum(y)) OVER (PARTITION BY nota ORDER BY p DESC) / sum(sum(y)) OVER (PARTITION BY nota), 6) AS tpr
FROM r_tres WHERE particao = 'teste' AND nota <> 'AUC máxima possível' GROUP BY nota, p""",
    "calibration_bins": calib("alunos, linhas iguais", PUPILS.format(w="count(*)") + " GROUP BY desempate, p, y")
        + " UNION ALL " + calib("alunos, pesos iguais", PUPILS.format(w=1))
        + " UNION ALL " + calib("redes", "SELECT unidade AS desempate, p_cumprir AS p, bateu_meta AS y, 1 AS w FROM r_teste"),
    "confusion": """
WITH x AS (SELECT 'modelo' AS nota, bateu_meta AS y, p_cumprir AS p FROM r_teste
           UNION ALL SELECT 'só o ciclo anterior', bateu_meta, coalesce(rede_taxa_ant / 100, 0.5) FROM r_teste)
SELECT nota, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS cumpriu_previu_cumprir,
       count(*) FILTER (WHERE y = 1 AND p < 0.5) AS cumpriu_previu_nao,
       count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS nao_cumpriu_previu_cumprir,
       count(*) FILTER (WHERE y = 0 AND p < 0.5) AS nao_cumpriu_previu_nao,
       round(100.0::DOUBLE * count(*) FILTER (WHERE y = 0 AND p < 0.5) / nullif(count(*) FILTER (WHERE y = 0), 0), 6)
         AS sensibilidade,
       round(100.0::DOUBLE * count(*) FILTER (WHERE y = 0 AND p < 0.5) / nullif(count(*) FILTER (WHERE p < 0.5), 0), 6)
         AS precisao,
       round(100.0::DOUBLE * count(*) FILTER (WHERE (y = 0) = (p < 0.5)) / count(*), 6) AS acuracia
FROM x GROUP BY nota""",
    "baselines": f"SELECT referencia, {SUMMARY} FROM r_bases_medidas GROUP BY referencia",
    "best_per_family": "SELECT * FROM r_melhores",
    "choose_family": """
WITH t AS (SELECT first(familia ORDER BY log_loss, familia) AS vencedora, min(log_loss) AS melhor,
                  first(log_loss_desvio ORDER BY log_loss, familia) AS tolerancia,
                  max(log_loss) FILTER (WHERE familia = 'regressão logística') AS linear FROM r_melhores)
SELECT vencedora, linear - melhor AS distancia, tolerancia,
       CASE WHEN linear - melhor <= tolerancia THEN 'regressão logística' ELSE vencedora END AS escolhida FROM t""",
    "slice_report": f"""
SELECT a.corte, a.recorte, a.redes, a.alunos, round(b, 6) AS bateram_pct, round(p, 6) AS prob_media_prevista_pct,
       round(auc, 6) AS auc, round(p - b, 6) AS diferenca_pp
FROM (SELECT corte, recorte, count(*) AS redes, sum(alunos)::BIGINT AS alunos, 100.0::DOUBLE * avg(y) AS b,
             100.0::DOUBLE * avg(p) AS p FROM r_recortes WHERE recorte IS NOT NULL GROUP BY 1, 2) a
JOIN r_recortes_auc c ON a.corte = c.corte AND a.recorte = c.recorte""",
    "unit_error": " UNION ALL ".join(f"""
SELECT '{name}' AS nota, count(*) AS grupos, round(corr(prevista, rl), 6) AS correlacao,
       round(median(abs(prevista - rl)), 6) AS erro_absoluto_mediano
FROM (SELECT id_municipio, 100.0::DOUBLE * avg({p}) AS prevista, 100.0::DOUBLE * avg(y) AS rl FROM r_alunos
      WHERE particao = 'validacao' GROUP BY id_municipio)""" for name, p in (
        ("modelo", "p_cumprir"), ("repetir o ciclo anterior", "coalesce(rede_taxa_ant / 100.0::DOUBLE, 0.5)"))),
    "ceiling_prediction": """
SELECT DISTINCT id_municipio || '/' || rede_nome AS unidade, count(*) OVER w AS alunos,
       sum(alvo) OVER w / (count(*) OVER w)::DOUBLE AS melhor_previsao
FROM c_abt WHERE rede_nome <> 'Privada' WINDOW w AS (PARTITION BY id_municipio, rede_nome)""",
    "risk_list": f"""
SELECT id_municipio, nome, r.sigla_uf, rede_nome, alunos, {r('taxa_real', 'taxa_real', 9)}, {r('risco', 'risco', 9)},
       {r('ganho_pp', 'ganho_pp', 9)}, {r('acumulado', 'ganho_acumulado', 9)},
       {r('taxa_nacional + acumulado', 'taxa_nacional_se_cumprissem', 9)}, particao
FROM r_corrido r LEFT JOIN t_lugar USING (id_municipio)""",
    "risk_summary": """
SELECT (SELECT count(*) FROM r_nota WHERE p_cumprir < 0.5) AS apontadas, count(*) AS confirmadas,
       sum(alunos)::BIGINT AS alunos, round(max(taxa_nacional), 6) AS taxa_nacional,
       round(max(taxa_nacional) + sum(ganho_pp), 6) AS taxa_se_todas_cumprissem,
       round(sum(ganho_pp) FILTER (WHERE ordem <= 15), 6) AS quinze_primeiras_pp,
       round(100.0::DOUBLE * sum(ganho_pp) FILTER (WHERE ordem <= 15) / sum(ganho_pp), 6) AS quinze_primeiras_pct_do_ganho,
       count(*) FILTER (WHERE acumulado < total / 2) + 1 AS redes_para_metade_do_ganho FROM r_corrido""",
    "risk_by_state": """
SELECT sigla_uf, count(*) AS redes, sum(alunos)::BIGINT AS alunos, round(sum(ganho_pp), 6) AS ganho_pp
FROM r_ganhos GROUP BY sigla_uf""",
    "region_profile": "SELECT nome_regiao, count(*) AS redes, sum(alunos)::BIGINT AS alunos, "
        + ", ".join(f"""round(100.0::DOUBLE * count(*) FILTER (WHERE {BAND.format(p='p_cumprir_pct')} = '{b}') / count(*), 6)
  AS "pct_{b}\"""" for b in LABELS)
        + ", round(median(taxa_real), 6) AS taxa_mediana_2024, round(median(p_cumprir_pct), 6) AS prob_mediana_pct "
          "FROM r_nota GROUP BY nome_regiao",
    "region_overlap": """
WITH g AS (SELECT a.nome_regiao, b.pedaco, coalesce(s.fracao, 0) AS f
           FROM (SELECT DISTINCT nome_regiao FROM r_silhueta) a CROSS JOIN (SELECT range AS pedaco FROM range(10)) b
           LEFT JOIN r_silhueta s ON a.nome_regiao = s.nome_regiao AND b.pedaco = s.pedaco)
SELECT a.nome_regiao AS regiao_a, b.nome_regiao AS regiao_b, round(100.0::DOUBLE * sum(least(a.f, b.f)), 6) AS sobreposicao
FROM g a JOIN g b USING (pedaco) GROUP BY 1, 2""",
    "probability_bands": f"""
SELECT s.faixa, coalesce(redes_teste, 0) AS redes_teste, coalesce(alunos_teste, 0) AS alunos_teste,
       round(med, 6) AS taxa_mediana_2024, round(nao, 6) AS nao_cumpriram_pct, round(sim, 6) AS cumpriram_pct,
       coalesce(m, 0) AS municipios_pais, coalesce(a, 0) AS alunos_pais,
       round(100.0::DOUBLE * coalesce(m, 0) / (SELECT count(*) FROM r_mun), 6) AS pct_dos_municipios,
       round(100.0::DOUBLE * coalesce(a, 0) / (SELECT sum(alunos) FROM r_mun), 6) AS pct_dos_alunos
FROM (SELECT unnest({LABELS}) AS faixa) s
LEFT JOIN (SELECT {BAND.format(p='p_cumprir_pct')} AS faixa, count(*) AS redes_teste, sum(alunos)::BIGINT AS alunos_teste,
                  median(taxa_real) AS med, 100.0::DOUBLE * avg(1 - bateu_meta) AS nao, 100.0::DOUBLE * avg(bateu_meta) AS sim
           FROM r_teste GROUP BY 1) t USING (faixa)
LEFT JOIN (SELECT {BAND.format(p='p')} AS faixa, count(*) AS m, sum(alunos)::BIGINT AS a FROM r_mun GROUP BY 1) u
  USING (faixa)""",
    "alert_municipalities": " UNION ALL ".join(f"""
SELECT '{label}' AS faixa, count(*) FILTER (WHERE {c}) AS municipios,
       round(100.0::DOUBLE * count(*) FILTER (WHERE {c}) / count(*), 6) AS pct_dos_municipios,
       coalesce(sum(alunos) FILTER (WHERE {c}), 0)::BIGINT AS alunos,
       round(100.0::DOUBLE * coalesce(sum(alunos) FILTER (WHERE {c}), 0) / sum(alunos), 6) AS pct_dos_alunos FROM r_mun"""
        for label, c in (("até 25%", "p <= 25"), ("25 a 50%", "p > 25 AND p <= 50"), ("as duas faixas juntas", "p <= 50"))),
    "trajectory_accuracy": """
WITH t AS (SELECT CASE WHEN rede_taxa_ant IS NULL THEN 'sem resultado anterior'
                       WHEN rede_taxa_ant >= 53 THEN CASE bateu_meta WHEN 1 THEN 'permaneceu acima' ELSE 'caiu' END
                       ELSE CASE bateu_meta WHEN 1 THEN 'virou para cima' ELSE 'permaneceu abaixo' END END AS grupo,
                  ((p_cumprir >= 0.5) = (bateu_meta = 1))::INTEGER AS acertou FROM r_teste)
SELECT grupo, count(*) AS redes, round(100.0::DOUBLE * avg(acertou), 6) AS acerto FROM (
  SELECT * FROM t UNION ALL SELECT CASE WHEN grupo LIKE 'permaneceu%' THEN 'permanência' ELSE 'mudança' END, acertou
  FROM t WHERE grupo <> 'sem resultado anterior') GROUP BY grupo""",
    "focus_contrast": f"""
SELECT variavel, {r('b', 'mediana_baixo')}, {r('a', 'mediana_alto')}, {r('p', 'mediana_pais')}, {r('a - b', 'diferenca')},
       {r('(a - b) / nullif(sd, 0)', 'em_desvios')}
FROM (SELECT variavel, median(valor) FILTER (WHERE baixo) AS b, median(valor) FILTER (WHERE alto) AS a,
             median(valor) AS p, stddev_samp(valor) AS sd FROM r_foco GROUP BY variavel)""",
}
