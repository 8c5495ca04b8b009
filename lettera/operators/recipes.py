"""Model recipes: everything a fit needs, as text, and the fit that follows from it alone."""
from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import lake
from .modeling import BOOSTING, FOREST, LOGISTIC, Fitted, fit
from .prepare import Design

#: What each family's parameters are; a parameter may be missing or null where the type says so (fixed values).
PARAMETERS = {
    LOGISTIC: {"C": (float,), "max_iter": (int, None)},
    BOOSTING: {"learning_rate": (float,), "max_iter": (int,), "max_leaf_nodes": (int,), "min_samples_leaf": (int,),
               "l2_regularization": (float, None)},
    FOREST: {"n_estimators": (int,), "max_depth": (int, None), "min_samples_leaf": (int,), "max_features": (float, str)},
}


def typed(family: str, params: dict) -> dict:
    """`params` with the types of the family; an unknown, missing or ill-typed one is an error."""
    if family not in PARAMETERS:
        raise ValueError(f"unknown family: {family}")
    kinds, out = PARAMETERS[family], {}
    if unknown := set(params) - set(kinds):
        raise ValueError(f"unknown parameters of {family}: {sorted(unknown)}")
    for name, allowed in kinds.items():
        if params.get(name) is None:
            if None not in allowed:
                raise ValueError(f"{family} needs {name}")
            if name in params:
                out[name] = None
            continue
        value = params[name]
        if isinstance(value, str):
            fits = str in allowed
        elif isinstance(value, bool) or not isinstance(value, (int, float)):
            fits = False
        elif float in allowed:
            value, fits = float(value), True
        else:
            fits = int in allowed and float(value).is_integer()
            value = int(value) if fits else value
        if not fits:
            raise ValueError(f"{name} of {family} can't be {params[name]!r}")
        out[name] = value
    return out


@dataclass(frozen=True)
class Recipe:
    """A family with its parameters, the design of the columns, response, weight and seed; and what was measured."""

    family: str
    params: dict
    design: Design
    seed: int
    response: str = "bateu_meta"
    weight: str | None = None
    criterion: str = "menor log-loss na validação cruzada; a logística vence a menos de um desvio da melhor"
    folds: dict = field(default_factory=dict)        # cross validation: auc, auc_desvio, log_loss, log_loss_desvio, brier
    validation: dict = field(default_factory=dict)
    test: dict = field(default_factory=dict)

    def measured(self, **blocks: dict) -> "Recipe":
        return replace(self, **{k: {n: round(float(v), 5) for n, v in b.items() if v is not None} for k, b in blocks.items()})

    def refit(self, rows: DataFrame, path: str) -> Fitted:
        """Preparation and model, learned again on `rows`; nothing of an earlier fit is read."""
        return fit(rows, self.design, self.family, typed(self.family, self.params), self.seed, path, self.response, self.weight)

    def write(self, spark: SparkSession, path: str) -> None:
        params = typed(self.family, self.params)
        lake.write_register(spark, path, {
            "familia": self.family, "parametros": {k: float(v) for k, v in params.items() if isinstance(v, (int, float))},
            "parametros_texto": json.dumps(params, sort_keys=True), "desenho": json.dumps(asdict(self.design), ensure_ascii=False),
            "resposta": self.response, "peso": self.weight, "criterio": self.criterion, "semente": self.seed,
            "validacao_cruzada": self.folds, "validacao": self.validation, "metricas": self.test, "variaveis": self.design.variables})

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "Recipe":
        r = lake.read_register(spark, path).first()
        if r is None or not r.parametros_texto or not r.desenho:
            raise lake.StopRun(f"no whole recipe under {path}")
        return cls(r.familia, typed(r.familia, json.loads(r.parametros_texto)), Design(**json.loads(r.desenho)), r.semente, r.resposta,
                   r.peso, r.criterio, dict(r.validacao_cruzada or {}), dict(r.validacao or {}), dict(r.metricas or {}))


def replayed(recipe: Recipe, measured: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Registered and measured AUC side by side; `measured` has one row."""
    kept = float(recipe.test["auc"])
    return measured.select(F.lit(kept).alias("auc_registrada"), F.round("auc", 5).alias("auc_refeita"),
                           (F.abs(F.col("auc") - kept) <= tolerance).alias("confere"))
