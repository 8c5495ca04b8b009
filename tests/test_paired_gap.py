from types import SimpleNamespace

from lettera.constants import DEMO
from lettera.plans import profile_queries


def test_every_state_has_a_row_however_few_its_pairs(spark):
    rows = []
    for uf, places in (("A", 12), ("B", 3), ("C", 1)):
        for k in range(places):
            for network, hits in (("Estadual", 30 + k), ("Municipal", 25)):
                rows.append((f"{uf}{k}", uf, network, 50, hits, 1.0 * k, 2.0, 3.0 + k, 4.0 + (k if network == "Estadual" else 0)))
    columns = ["id_municipio", "sigla_uf", "rede_nome", "alunos", "alfabetizados", *profile_queries.INFRA]
    ws = SimpleNamespace(redes=spark.createDataFrame(rows, columns), cycle=DEMO)
    got = {r.grupo: r.municipios for r in profile_queries.paired_network_gap(ws).where("corte = 'UF'").collect()}
    assert got == {"A": 12, "B": 3, "C": 1}
