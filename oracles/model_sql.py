from __future__ import annotations

SQL = {
    # 14 numeric variables, 2 missing indicators, one column per level seen in train
    "check_prep_complete": """
SELECT unnest(['linear', 'árvore']) AS preparo, 0::BIGINT AS celulas_vazias,
       (16 + count(DISTINCT sigla_uf) + count(DISTINCT nome_regiao))::INTEGER AS colunas, true AS mesmas_colunas
FROM c_redes WHERE particao = 'treino'""",
}
