"""The base tables of one run: context, analytic base table, unit table.

Pupils of one network share every feature. So the context of all sources is joined once at
network grain, and everything that describes pupils works on the unit table: one row per
municipality and network with pupil counts and weights. The unit table is written to the
shared folder once per application and read from there, like the stored base table it is.
"""
from __future__ import annotations

import hashlib
import re
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import Cycle, DEMO, PRIVATE
from ..functions.exprs import hash_number, is_label_one
from ..functions.metadata import FEATURES
from ..operators import context as ctx
from ..operators.splits import split_by_group
from ..sources.demo import DemoTables
from ..sources.lake import bucketed_if_absent, materialize_if_stale, run_folder

REGIONS = {"1": "AFRICA", "2": "AMERICA", "3": "ASIA", "4": "EUROPE", "5": "MIDDLE EAST"}
SEWAGE, WATER = "ECONOMY", "F"
UNIT = ctx.UNIT


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, cycle: Cycle = DEMO):
        self.spark, self.sf_dir, self.cycle = spark, sf_dir, cycle
        self.tables = DemoTables(spark, sf_dir, self.stored)

    @cached_property
    def alunos(self) -> DataFrame:
        return self.tables.alunos(self.cycle.score_cut)

    @cached_property
    def alunos_now(self) -> DataFrame:
        """Pupils of the target cycle; the year reaches the scan."""
        return self.tables.alunos(self.cycle.score_cut, [self.cycle.target])

    @cached_property
    def economy(self) -> DataFrame:
        return ctx.municipal_economy(*(t([self.cycle.economy_year]) for t in
                                       (self.tables.pib, self.tables.populacao)), self.cycle)

    @cached_property
    def enrollment(self) -> tuple[DataFrame, DataFrame]:
        c = self.cycle
        return ctx.enrollment_size(self.tables.matriculas([c.target]), c, "todos")

    @cached_property
    def census(self) -> DataFrame:
        t = self.tables
        return ctx.census_indicators(t.censo_municipio(), t.censo_esgoto(), t.censo_agua(),
                                     REGIONS, SEWAGE, WATER)

    def sources(self) -> list[tuple[str, DataFrame, list[str]]]:
        """Every source that is joined, with the key of its own grain; plans, not yet run."""
        t, c = self.tables, self.cycle
        before = [c.previous]
        by_net, by_mun = self.enrollment
        return [
            ("contexto da rede", ctx.network_context(t.municipio(before), c), UNIT),
            ("contexto do município", ctx.municipal_context(
                t.indicador_municipio([c.previous, c.target]), c), UNIT[:1]),
            ("porte da rede", by_net, UNIT),
            ("porte do município", by_mun, UNIT[:1]),
            ("censo escolar", ctx.school_census(t.escola(before), c), UNIT),
            ("turmas", ctx.class_size(t.turma(before), c), UNIT),
            ("economia municipal", self.economy, UNIT[:1]),
            ("desenvolvimento humano", ctx.human_development(t.adh(), t.avs([c.atlas_year]), c), UNIT[:1]),
            ("censo demográfico", self.census, UNIT[:1]),
            ("violência", ctx.homicide_rate(self.economy, t.sim(), c), UNIT[:1]),
            ("corpo docente e jornada",
             ctx.teacher_indicators(t.indicadores_educacionais(), c), UNIT),
            ("nível socioeconômico da rede", ctx.socioeconomic_level(t.inse(), c), UNIT),
            ("primeira infância", ctx.early_childhood(
                t.sinasc(), t.escola([c.preschool_year]), c), UNIT[:1]),
        ]

    @cached_property
    def stored_sources(self) -> list[tuple[str, DataFrame, list[str]]]:
        """The same sources, each run once and kept in buckets of its own key.

        The plans are made in this thread, which writes the sums they share; then the writes, which
        do not depend on each other, run side by side.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        app = re.sub(r"\W", "_", self.spark.sparkContext.applicationId)

        def keep(numbered):
            n, (label, df, keys) = numbered
            name = f"fonte_{n:02d}"
            return label, bucketed_if_absent(
                self.spark, run_folder(self.spark, "ml", name, self.key),
                f"lettera_{app}_{self.key}_{name}", lambda: df, keys, buckets), keys

        with ThreadPoolExecutor(4) as pool:
            return list(pool.map(keep, enumerate(self.sources())))

    def unit_context(self) -> DataFrame:
        """All features, one row per municipality and network of the cycle.

        Sources of the same grain are joined with each other first: they lie in buckets of that
        very key, so their joins need no shuffle, and only one join crosses from the municipality
        to the network. The sources are small next to the pupils but grow with the number of
        municipalities; none is broadcast by hand, Spark does so where the size allows.
        """
        found = {label: (df, keys) for label, df, keys in self.stored_sources}
        net, mun = found.pop("porte da rede")[0], found.pop("porte do município")[0]
        for df, keys in found.values():
            if keys == UNIT:
                net = net.join(df, keys, "left")
            else:
                mun = mun.join(df, keys, "left")
        mun = mun.join(self.split(), "id_municipio", "left")
        return ctx.derived_columns(net.join(mun, "id_municipio"))

    def split(self) -> DataFrame:
        pupils = self.tables.matriculas([self.cycle.target]).where("presentes > 0")
        return split_by_group(pupils, "id_municipio", self.cycle.seed)

    def abt(self) -> DataFrame:
        """Analytic base table: one row per pupil present, features, response, weight, part.

        The pupils are joined once, to the context of their network; a network that holds a
        large share of them is split by the adaptive skew join, as nothing after the join needs
        its partitioning.
        """
        pupils = ctx.modelable_population(self.alunos_now)
        return (pupils.join(self.context, UNIT, "left")
                .select("ano", "id_municipio", *FEATURES, "alvo", "peso_aluno", "particao"))

    @cached_property
    def context(self) -> DataFrame:
        return self.stored("contexto", self.unit_context, ["particao"])

    def pupil_sums(self) -> DataFrame:
        """Pupils present, summed per network: counts, weights, weighted rate, target met."""
        y = is_label_one("alfabetizado")
        sums = (self.alunos_now.where("presente").groupBy(*UNIT).agg(
                      F.count(F.lit(1)).alias("alunos"), F.sum(y).alias("alfabetizados"),
                      F.sum("peso_aluno").alias("peso_total"),
                      F.sum(F.col("peso_aluno") * y).alias("peso_alfabetizados")))
        rate = F.lit(100.0) * F.col("peso_alfabetizados") / F.col("peso_total")
        return (sums.withColumn("taxa_real", rate)
                .withColumn("bateu_meta", (F.col("taxa_real") >= self.cycle.unit_target).cast("int"))
                .withColumn("unidade", F.concat_ws("/", "id_municipio", "rede_nome")))

    def _unit_plan(self) -> DataFrame:
        return self.pupil_sums().join(self.context, UNIT, "left")

    @cached_property
    def key(self) -> str:
        """Names the source folder and every field of the cycle, so no run reads another one's tables."""
        return hashlib.md5(repr((self.sf_dir.rstrip("/"), self.cycle)).encode()).hexdigest()

    def stored(self, name: str, build, required=()) -> DataFrame:
        """A result several reports share, written once per application."""
        return materialize_if_stale(self.spark, run_folder(self.spark, "ml", name, self.key), build,
                                    required)[0]

    @cached_property
    def units(self) -> DataFrame:
        """All networks, private ones too, as the exploratory profile uses them."""
        return self.stored("unidades", self._unit_plan, ["unidade", "taxa_real"])

    @cached_property
    def redes(self) -> DataFrame:
        """Public networks: the grain of the second model and of the reports."""
        return self.units.where(F.col("rede_nome") != PRIVATE)

    @cached_property
    def train_units(self) -> DataFrame:
        return self.units.where(F.col("particao") == "treino")

    @cached_property
    def scored(self) -> DataFrame:
        """Public networks with a deterministic score, so that every report can be checked."""
        noise = hash_number("unidade", "score") % 10000 / F.lit(10000.0)
        lag = F.coalesce("rede_taxa_ant", F.lit(50.0)) / F.lit(100.0)
        p = F.round(F.lit(0.6) * noise + F.lit(0.4) * lag, 4)
        return (self.redes.withColumn("p_cumprir", p)
                .withColumn("p_cumprir_pct", F.round(F.lit(100.0) * F.col("p_cumprir"), 2))
                .withColumn("risco", F.round(F.lit(100.0) * (1 - F.col("p_cumprir")), 2)))
