"""Exact weighted metrics of a score column, for any number of models or slices at once.

Everything comes from the table of distinct scores: the weight of each class at a score and
ahead of it. Rows are summed by score before anything is ordered, and the order is built bucket
by bucket, so neither many rows nor many equal scores end up in one task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip, ratio, value_bucket
from .ordering import cumulate_many, equal_frequency_bins

FLOOR = 1e-6


def score_table(df: DataFrame, by: Sequence[str], score: str = "p", y: str = "y",
                w: str = "w") -> DataFrame:
    """Distinct scores with class weights at the score (`pos`, `neg`), below it (`pos_lt`,
    `neg_lt`) and overall (`pos_all`, `neg_all`)."""
    weight = F.col(w).cast("double")
    sums = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.when(F.col(y) == 1, weight).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0.0).otherwise(weight)).alias("neg"))
    return cumulate_many(sums, {"pos": ("pos_lt", "pos_all"), "neg": ("neg_lt", "neg_all")},
                         [value_bucket(score)], [F.col(score)], by)


def measure(df: DataFrame, by: Sequence[str] = (), score: str = "p", y: str = "y",
            w: str = "w") -> DataFrame:
    """AUC (ties count half; null with one class only), log-loss and Brier per group."""
    table = score_table(df, by, score, y, w)
    p = clip(score, FLOOR, 1 - FLOOR)
    pos, neg = F.col("pos"), F.col("neg")
    pairs = F.sum(pos * (F.col("neg_lt") + neg / 2))
    all_pairs = F.max("pos_all") * F.max("neg_all")
    total = F.sum(pos + neg)
    return table.groupBy(*by).agg(
        F.try_divide(pairs, all_pairs).alias("auc"),
        (F.sum(-pos * F.log(p) - neg * F.log(1 - p)) / total).alias("log_loss"),
        (F.sum(pos * (1 - p) * (1 - p) + neg * p * p) / total).alias("brier"),
        total.alias("peso"))


def roc_points(df: DataFrame, by: Sequence[str], score: str = "p", y: str = "y",
               w: str = "w") -> DataFrame:
    """One point per distinct threshold: shares of each class at or above it."""
    t = score_table(df, by, score, y, w)
    return t.select(*by, F.col(score).alias("limiar"),
                    F.try_divide(F.col("neg_all") - F.col("neg_lt"), F.col("neg_all")).alias("fpr"),
                    F.try_divide(F.col("pos_all") - F.col("pos_lt"), F.col("pos_all")).alias("tpr"))


def calibration(df: DataFrame, tie: str, n: int = 10, by: Sequence[str] = (),
                by_weight: bool = False) -> DataFrame:
    """Mean score and weighted response rate in `n` bins along the score.

    The bins hold the same number of rows; with `by_weight` the same number of the units the
    rows stand for. Columns: p, y, w and the text `tie` that orders equal scores.
    """
    d = df.withColumn("__one", F.lit(1).cast("bigint"))
    amount = "w" if by_weight else "__one"
    binned = equal_frequency_bins(d, "p", tie, amount, n, list(by))
    w = (F.col("in_bin") if by_weight else F.col("w")).cast("double")
    out = binned.groupBy(*by, "faixa").agg(
        F.sum(w).alias("peso"), (F.sum(w * F.col("p")) / F.sum(w)).alias("prevista"),
        (F.sum(w * F.col("y")) / F.sum(w)).alias("observada"))
    return out.withColumn("distancia_pp", F.lit(100.0) * F.abs(F.col("prevista") - F.col("observada")))


def confusion(df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """Counts of what happened against what was predicted, and precision, sensitivity and
    accuracy for the class that missed (`y` 0)."""
    missed, said = F.col("y") == 0, F.col("p") < threshold
    d = df.groupBy(*by).agg(
        F.count_if(~missed & ~said).alias("cumpriu_previu_cumprir"),
        F.count_if(~missed & said).alias("cumpriu_previu_nao"),
        F.count_if(missed & ~said).alias("nao_cumpriu_previu_cumprir"),
        F.count_if(missed & said).alias("nao_cumpriu_previu_nao"))
    hit = F.col("nao_cumpriu_previu_nao")
    all_rows = sum((F.col(c) for c in d.columns if c not in by), F.lit(0))
    right = hit + F.col("cumpriu_previu_cumprir")
    return d.withColumns({
        "sensibilidade": 100 * ratio(hit, hit + F.col("nao_cumpriu_previu_cumprir")),
        "precisao": 100 * ratio(hit, hit + F.col("cumpriu_previu_nao")),
        "acuracia": 100 * ratio(right, all_rows)})


def summarize_folds(folds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of the metrics over the folds."""
    return folds.groupBy(*by).agg(
        F.avg("auc").alias("auc"), F.stddev_samp("auc").alias("auc_desvio"),
        F.avg("log_loss").alias("log_loss"), F.stddev_samp("log_loss").alias("log_loss_desvio"),
        F.avg("brier").alias("brier"))


def best_per_family(search: DataFrame, order: Sequence[str] = ("parametros",)) -> DataFrame:
    """The row with the smallest log-loss of each family; ties go by the given columns."""
    every = [c for c in search.columns if c != "familia"]
    best = F.min_by(F.struct(*every), F.struct("log_loss", *order))
    return search.groupBy("familia").agg(best.alias("r")).select("familia", "r.*")


def choose_family(best: DataFrame, linear: str = "regressão logística") -> DataFrame:
    """Smallest log-loss wins; the linear family wins when it is within one deviation of it."""
    key = F.struct("log_loss", "familia")
    top = best.agg(F.min_by("familia", key).alias("vencedora"), F.min("log_loss").alias("__best"),
                   F.min_by("log_loss_desvio", key).alias("tolerancia"),
                   F.max(F.when(F.col("familia") == linear, F.col("log_loss"))).alias("__linear"))
    gap = F.col("__linear") - F.col("__best")
    pick = F.when(gap <= F.col("tolerancia"), linear).otherwise(F.col("vencedora"))
    return top.select("vencedora", gap.alias("distancia"), "tolerancia", pick.alias("escolhida"))


def baselines(rows: DataFrame, parts: Sequence[str] = ("fold",)) -> DataFrame:
    """Three references that learn nothing, scored on each part.

    `rows` are weighted class rows with `taxa_treino` (rate of the other parts), the previous
    rate and the unit's own sums. The best possible score of a unit is its own rate.
    """
    best = F.col("alfabetizados") / F.col("alunos")
    score = lambda name, p: F.struct(F.lit(name).alias("referencia"), p.alias("p"))
    long = rows.select(*parts, F.col("alvo").alias("y"), F.col("peso").alias("w"), F.inline(F.array(
        score("constante", F.col("taxa_treino")),
        score("repetir o ciclo anterior", F.coalesce(F.col("rede_taxa_ant") / 100, F.col("taxa_treino"))),
        score("melhor previsão possível", best))))
    return measure(long, ["referencia", *parts])


def way_to_ceiling(table: DataFrame, ceiling_auc) -> DataFrame:
    share = F.try_divide(F.col("auc") - 0.5, ceiling_auc - 0.5)
    return table.withColumn("pct_do_caminho", F.bround(100 * share, 0))
