"""The four runs end to end on small data and small searches."""
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lettera.operators.modeling import FOREST, LOGISTIC
from lettera.plans import pipeline, registry
from lettera.plans.pipeline import Settings
from lettera.sources import lake

SMALL = Settings(
    spaces={LOGISTIC: ({"C": [1.0], "max_iter": [20]}, 1),
            FOREST: ({"n_estimators": [5], "max_depth": [3], "min_samples_leaf": [2], "max_features": ["sqrt"]}, 1)},
    folds=2, rounds=1, minimum_rounds=1, shuffles=1, repeats=2,
    instrument={"learning_rate": .2, "max_iter": 2, "max_leaf_nodes": 4, "min_samples_leaf": 2})


@pytest.fixture(scope="module")
def ws(spark):
    return registry.workspace(spark, "/root/testdata/sf0.01")


def test_runs_follow_each_other(spark, ws, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    base = pipeline.build_base(ws, out, "2024-05-01")
    assert base.count() == ws.units.agg(F.sum("alunos")).first()[0]

    final, selected = pipeline.model_networks(ws, f"{out}/rede", SMALL,
                                              ["rede_taxa_ant", "mun_indice_pre_escola"])
    register = lake.read_register(spark, f"{out}/rede/registro").first()
    assert set(selected) <= {"rede_taxa_ant", "mun_indice_pre_escola", "rede_nome"}
    assert register.variaveis == final.variables and 0 <= register.metricas["auc"] <= 1
    assert register.validacao_cruzada.keys() == set(pipeline.FOLD_NAMES) and {"auc", "auc_redes_estaveis"} <= register.validacao.keys()
    report = lambda name: spark.read.option("header", True).csv(f"{out}/rede/reports/{name}")
    assert {"constante", "modelo final", "só o ciclo anterior"} <= {r.modelo for r in report("avaliacao_teste_rede").collect()}
    assert {LOGISTIC, FOREST, "só o ciclo anterior"} <= {r.modelo for r in report("validacao_rede").collect()}
    assert {"todas", "etapa A", "selecionadas"} >= {r.configuracao for r in report("conjuntos_variaveis").collect()} >= {"todas", "etapa A"}
    model, recipe = pipeline.rebuilt(ws, f"{out}/rede/registro", f"{out}/refeito")
    assert recipe.family == register.familia and model.variables == final.variables

    again = replace(SMALL, reuse_search=True, reuse_curation=True)
    _, kept = pipeline.curate(ws, f"{out}/rede", again, pipeline.full_design(again), ["rede_taxa_ant"])
    assert kept == selected                                   # read back, not searched again

    answers = pipeline.answer_questions(ws, f"{out}/respostas", final, None, SMALL)
    risk = answers["redes_risco"].toPandas().sort_values("ganho_acumulado")
    assert (risk.ganho_pp.diff().dropna() <= 1e-9).all()
    assert risk.ganho_pp.sum() == pytest.approx(risk.ganho_acumulado.max(), abs=.01)
    bands = answers["faixas_probabilidade"].toPandas()
    assert len(bands) == 4 and bands.redes_teste.sum() == ws.redes.where("particao = 'teste'").count()
    overlap = answers["semelhanca_regioes"].toPandas()
    assert (overlap[overlap.regiao_a == overlap.regiao_b].sobreposicao.round(6) == 100).all()
    with pytest.raises(lake.StopRun):
        pipeline.answer_questions(ws, f"{out}/respostas2", final, register.metricas["auc"] + .1, SMALL)


def test_pupil_model_registers_the_chosen_family(spark, ws, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pupil"))
    design = pipeline.Design(["rede_taxa_ant", "mun_indice_pre_escola"], ["sigla_uf"], {"sem_rede_ant": "rede_taxa_ant"})
    chosen = pipeline.model_pupils(ws, out, SMALL, design)
    register = lake.read_register(spark, f"{out}/registro").first()
    assert register.familia == chosen and register.variaveis == design.variables
    table = {r.modelo: r for r in spark.read.option("header", True).csv(f"{out}/reports/comparacao_modelos").collect()}
    assert table.keys() == {LOGISTIC, FOREST, pipeline.REPEAT, pipeline.CEILING, pipeline.CONSTANT}
    assert all(r.cv_auc and r.validacao_auc for r in table.values()) and table[pipeline.CEILING].validacao_pct_do_caminho == "100.0"
    assert {table[f].mesma_ordem for f in (LOGISTIC, FOREST)} in ({"true"}, {"false"}) and table[pipeline.REPEAT].mesma_ordem is None
    assert spark.read.option("header", True).csv(f"{out}/reports/referencias_logisticas").count() == 2
    assert register.validacao.keys() == {"auc", "log_loss", "brier"}
