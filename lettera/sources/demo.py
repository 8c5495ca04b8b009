"""Education tables derived from the order tables the test data ships.

Every function returns a lazy DataFrame with the columns the analysis expects. The facts are
summed per supplier key before the supplier's names are attached, so the wide join works on
pre-aggregated rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import with_totals
from ..functions.exprs import hash_number as h
from ..functions.exprs import recode
from .lake import read_clean

FLAG_TO_NETWORK = {"A": "Estadual", "R": "Municipal", "N": "Privada"}
FLAG_TO_CODE = {"A": "2", "R": "3", "N": "4"}
FLAG_TO_WORD = {"A": "estadual", "R": "municipal", "N": "privada"}


def hundredths(c: str):
    """A two-decimal amount as whole hundredths, so that sums do not depend on their order."""
    return F.round(F.col(c) * 100).cast("bigint")


class DemoTables:
    """Views over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, store=None):
        """`store(name, build)` keeps a table that several sources read, as `Workspace.stored` does; without it
        each source plans the table anew."""
        self.spark, self.sf_dir, self.store = spark, sf_dir, store

    def raw(self, name: str) -> DataFrame:
        return read_clean(self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    # -- keys -------------------------------------------------------------------------------
    def places(self) -> DataFrame:
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select("s_suppkey",
                        F.format_string("%d%06d", F.col("n_regionkey") + 1, F.col("s_suppkey"))
                        .alias("id_municipio"),
                        F.col("s_name").alias("nome"), F.col("n_name").alias("sigla_uf"),
                        F.col("r_name").alias("nome_regiao"), "s_acctbal"))

    def with_place(self, df: DataFrame, *keep: str) -> DataFrame:
        cols = ["s_suppkey", "id_municipio", *keep]
        return df.join(self.places().select(*cols), df.l_suppkey == F.col("s_suppkey")) \
                 .drop("l_suppkey", "s_suppkey")

    def place_count(self) -> DataFrame:
        return self.raw("supplier").agg(F.count(F.lit(1)).alias("n_places"))

    def lines(self, years=None) -> DataFrame:
        """Order lines with their year; a year range is put on the stored date, where the scan
        can skip row groups, and not on the computed year."""
        d = self.raw("lineitem")
        if years:
            kind = d.schema["l_shipdate"].dataType
            start, end = (F.lit(f"{y}-01-01").cast(kind) for y in (min(years), max(years) + 1))
            d = d.where((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
        return d.withColumn("ano", F.year("l_shipdate"))

    # -- one scan for all sources that are sums ------------------------------------------------
    def facts(self, years=None) -> DataFrame:
        """Order lines summed by supplier, year and both flags: what most sources read in place of the lines."""
        d = self.store("fatos", self._fact_sums) if self.store else self._fact_sums()
        return d.where(F.col("ano").between(min(years), max(years))) if years else d

    def _fact_sums(self) -> DataFrame:
        price, w, kind = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_partkey") % 3
        present = F.col("l_discount") > 0
        right = present & (price >= 50000.0)
        return self.lines().groupBy("l_suppkey", "ano", "l_returnflag", "l_linestatus").agg(
            F.count(F.lit(1)).alias("linhas"), F.count_if(present).alias("presentes"),
            F.sum(F.when(right, w)).alias("wy"), F.sum(F.when(present, w)).alias("w"),
            F.sum(F.when(present, hundredths("l_extendedprice"))).alias("score"),
            F.sum(w).alias("quantidade"), F.count(w).alias("n_quantidade"),
            F.sum(price).alias("pib"), F.sum(price * 0.5).alias("va"),
            F.sum(F.when(kind == 0, price * 0.5)).alias("va_agropecuaria"),
            F.sum(F.when(kind == 1, price * 0.5)).alias("va_servicos"),
            F.sum(hundredths("l_tax")).alias("imposto"), F.count("l_tax").alias("n_imposto"),
            F.sum(hundredths("l_discount")).alias("desconto"),
            F.count("l_discount").alias("n_desconto"))

    # -- assessment -------------------------------------------------------------------------
    def alunos(self, cut: float = 50000.0, years=None) -> DataFrame:
        present = F.col("l_discount") > 0
        d = self.lines(years).select(
            "l_suppkey", "ano", recode("l_returnflag", FLAG_TO_NETWORK).alias("rede_nome"),
            present.alias("presente"),
            F.when(present, F.when(F.col("l_extendedprice") >= cut, F.lit("1"))
                   .otherwise(F.lit("0"))).alias("alfabetizado"),
            F.when(present, F.col("l_extendedprice")).alias("proficiencia"),
            F.col("l_quantity").alias("peso_aluno"))
        return self.with_place(d).select(
            "ano", "id_municipio", "rede_nome", "presente", "alfabetizado", "proficiencia",
            "peso_aluno")

    def matriculas(self, years=None) -> DataFrame:
        """Pupils registered and present per year and network, summed."""
        d = self.facts(years).groupBy("ano", "l_suppkey", "l_returnflag").agg(
            F.sum("linhas").alias("todos"), F.sum("presentes").alias("presentes"))
        return self.with_place(d).select(
            "ano", "id_municipio", recode("l_returnflag", FLAG_TO_NETWORK).alias("rede_nome"),
            "todos", "presentes")

    def _cycle_sums(self, years=None) -> DataFrame:
        """Public networks per year and place: code '2', '3', and '5' for both together."""
        codes = F.explode(F.array(recode("l_returnflag", FLAG_TO_CODE), F.lit("5")))
        sums = {"wy": "wy", "w": "w", "score": "score", "presentes": "presentes", "todos": "linhas"}
        return (self.facts(years).where(F.col("l_returnflag").isin("A", "R"))
                .withColumn("rede", codes).groupBy("l_suppkey", "ano", "rede")
                .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()])
                .where("presentes > 0"))

    def municipio(self, years=None) -> DataFrame:
        d = self.with_place(self._cycle_sums(years), "sigla_uf", "nome_regiao")
        names = {"2": "Estadual", "3": "Municipal", "5": "Pública"}
        return d.select(
            "ano", "id_municipio", "rede", recode("rede", names).alias("rede_nome"),
            "sigla_uf", "nome_regiao",
            (F.lit(100.0) * F.col("wy") / F.col("w")).alias("taxa_alfabetizacao"),
            (F.col("score") / F.col("presentes") / 100).alias("media_portugues"))

    def indicador_municipio(self, years=None) -> DataFrame:
        d = self.with_place(self._cycle_sums(years).where("rede = '5'"), "s_acctbal")
        taxa = F.lit(100.0) * F.col("wy") / F.col("w")
        part = F.lit(100.0) * F.col("presentes") / F.col("todos")
        d = d.select("ano", "id_municipio", taxa.alias("taxa"),
                     part.alias("percentual_participacao"),
                     (taxa * part / F.lit(100.0)).alias("taxa_ajustada"),
                     F.col("presentes").cast("int").alias("alunos_presentes"),
                     F.when(F.col("s_acctbal") >= 0, F.lit("oficial_inep"))
                     .otherwise(F.lit("estimado")).alias("origem"))
        before = d.select((F.col("ano") + 1).alias("ano"), "id_municipio",
                          F.col("taxa").alias("taxa_antes"))
        goal = F.col("taxa_antes") + F.lit(0.05) * (F.lit(100.0) - F.col("taxa_antes"))
        return (d.join(before, ["ano", "id_municipio"], "left")
                .withColumn("meta_taxa", goal).drop("taxa_antes"))

    def diretorio_municipio(self) -> DataFrame:
        return self.places().select("id_municipio", "nome")

    # -- school census ----------------------------------------------------------------------
    def escola(self, years=None) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_size")
        d = (self.lines(years).groupBy("ano", "l_suppkey", "l_returnflag", "l_partkey")
             .agg(F.sum("l_quantity").cast("bigint").alias("q")))
        d = d.join(part, d.l_partkey == part.p_partkey)
        d = self.with_place(d)
        size, key, q = F.col("p_size"), F.col("l_partkey"), F.col("q")

        def flag(off: int, mod: int, zero: int):
            r = (key * 17 + off) % mod
            return F.when(r == 0, F.lit(None).cast("int")).when(r <= zero, F.lit(0)) \
                    .otherwise(F.lit(1))

        rural = F.when(size > 30, F.floor(q / 2)).otherwise(F.lit(0)).cast("bigint")
        return d.select(
            "ano", "id_municipio", recode("l_returnflag", FLAG_TO_CODE).alias("rede"),
            F.when(size > 40, F.lit("2")).otherwise(F.lit("1")).alias("tipo_localizacao"),
            F.when(size <= 3, F.lit("2")).otherwise(F.lit("1"))
            .alias("tipo_situacao_funcionamento"),
            q.alias("quantidade_matricula_fundamental_2_ano"),
            rural.alias("quantidade_matricula_zona_residencia_rural"),
            (q - rural).alias("quantidade_matricula_zona_residencia_urbana"),
            flag(1, 5, 2).alias("agua_rede_publica"), flag(2, 6, 3).alias("esgoto_rede_publica"),
            flag(3, 9, 1).alias("energia_rede_publica"), flag(4, 7, 2).alias("internet"),
            F.when((key * 17 + 5) % 8 == 0, F.lit("sem dado"))
            .when((key * 17 + 5) % 8 <= 3, F.lit("0")).otherwise(F.lit("1"))
            .alias("biblioteca_sala_leitura"),
            flag(6, 11, 7).alias("laboratorio_informatica"),
            flag(7, 10, 5).alias("quadra_esportes"), flag(8, 13, 1).alias("alimentacao"),
            flag(9, 6, 2).alias("profissional_coordenador"),
            flag(10, 12, 9).alias("profissional_psicologo"),
            flag(11, 14, 11).alias("profissional_assistente_social"),
            F.when(key % 10 == 0, F.lit("")).when(key % 10 <= 6, F.lit("0"))
            .otherwise((key % 3 + 1).cast("string")).alias("tipo_localizacao_diferenciada"),
            (q * 5).alias("quantidade_matricula_fundamental_anos_iniciais"),
            (key % 20).alias("quantidade_docente_fundamental_anos_iniciais"),
            F.floor(q * (10 + key % 30) / 20).cast("bigint")
            .alias("quantidade_matricula_infantil_pre_escola"),
            (key % 12).alias("quantidade_sala_utilizada"),
            F.floor(q * (size % 10) / 10).cast("bigint")
            .alias("quantidade_matricula_utiliza_transporte_publico"),
            (q * 8).alias("quantidade_matricula_educacao_basica"))

    def turma(self, years=None) -> DataFrame:
        d = (self.lines(years).groupBy("ano", "l_suppkey", "l_returnflag", "l_orderkey")
             .agg(F.sum("l_quantity").cast("bigint").alias("quantidade_matriculas")))
        return self.with_place(d).select(
            "ano", "id_municipio", recode("l_returnflag", FLAG_TO_WORD).alias("rede"),
            F.when(F.col("l_orderkey") % 3 < 2, F.lit("15")).otherwise(F.lit("16"))
            .alias("etapa_ensino"), "quantidade_matriculas")

    # -- economy, atlas, violence -----------------------------------------------------------
    def pib(self, years=None) -> DataFrame:
        d = self.facts(years).groupBy("ano", "l_suppkey").agg(
            *[F.sum(c).alias(c) for c in ("pib", "va", "va_agropecuaria", "va_servicos")])
        return self.with_place(d)

    def populacao(self, years=None) -> DataFrame:
        d = self.facts(years).groupBy("ano", "l_suppkey").agg(
            (F.sum("quantidade") * 10).cast("bigint").alias("populacao"))
        return self.with_place(d)

    def adh(self) -> DataFrame:
        k = "s_suppkey"
        part = lambda salt, n, div: (h(k, salt) % n) / F.lit(float(div))
        return self.places().select(
            F.lit(1996).alias("ano"), "id_municipio", part("idhm", 4000, 10000).alias("idhm"),
            part("idhm_e", 4000, 10000).alias("idhm_e"),
            part("idhm_r", 4000, 10000).alias("idhm_r"),
            part("renda", 90000, 100).alias("renda_pc"),
            part("gini", 600, 1000).alias("indice_gini"),
            part("analf", 400, 10).alias("taxa_analfabetismo_18_mais"),
            part("expect", 500, 50).alias("expectativa_anos_estudo"),
            part("desloc", 300, 10).alias("taxa_vulner_desloc_1_hora"))

    def avs(self, years=None) -> DataFrame:
        mean = lambda c: F.try_divide(F.sum(c).cast("double"), F.sum(f"n_{c}"))
        d = self.facts(years).where(F.col("l_suppkey") % 11 != 0) \
            .groupBy("ano", "l_suppkey", "l_linestatus").agg(
                (mean("imposto") / 10).alias("ivs"),
                (mean("desconto") / 10).alias("ivs_infraestrutura_urbana"),
                (mean("quantidade") / 50).alias("ivs_capital_humano"))
        return self.with_place(d)

    def sim(self) -> DataFrame:
        # deaths are summed per person first, then spread over the places
        d = self.raw("events").groupBy("user_id", F.year("ts").alias("y")) \
            .agg(F.count(F.lit(1)).alias("n"))
        d = d.transform(with_totals, self.place_count())
        code = F.col("user_id") % 30
        d = d.select((F.col("y") - 25).alias("ano"),
                     (h("user_id", "sim") % F.col("n_places")).alias("l_suppkey"),
                     F.when(code < 20, F.concat(F.lit("X"), (code + 80).cast("string")))
                     .otherwise(F.concat(F.lit("Y0"), (code - 20).cast("string")))
                     .alias("causa_basica"), "n")
        d = d.groupBy("ano", "l_suppkey", "causa_basica").agg(F.sum("n").alias("numero_obitos"))
        return self.with_place(d)

    # -- demographic census -----------------------------------------------------------------
    def censo_municipio(self) -> DataFrame:
        d = self.facts().groupBy("l_suppkey").agg(
            F.sum("quantidade").cast("bigint").alias("populacao"),
            F.sum("linhas").alias("domicilios"))
        d = self.places().join(d, F.col("s_suppkey") == F.col("l_suppkey"))
        return d.select("id_municipio", "sigla_uf", "populacao", "domicilios",
                        (h("s_suppkey", "area") % 400).alias("area"),
                        ((h("s_suppkey", "alfab") % 300 + 700) / 1000).alias("taxa_alfabetizacao"),
                        (h("s_suppkey", "idade") % 25 + 20).alias("idade_mediana"))

    def censo_esgoto(self) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_type")
        d = self.lines().groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
        d = d.join(part, d.l_partkey == part.p_partkey) \
             .groupBy("l_suppkey", F.col("p_type").alias("tipo_esgotamento_sanitario")) \
             .agg(F.sum("q").cast("bigint").alias("populacao"))
        return self.with_place(d)

    def censo_agua(self) -> DataFrame:
        d = self.facts().groupBy("l_suppkey", F.col("l_linestatus").alias("tipo_ligacao_rede_geral")) \
            .agg(F.sum("quantidade").cast("bigint").alias("populacao"))
        return self.with_place(d)

    # -- teachers, families, births ---------------------------------------------------------
    def indicadores_educacionais(self) -> DataFrame:
        d = (self.places().select("s_suppkey", "id_municipio")
             .withColumn("ano", F.explode(F.array(F.lit(1998), F.lit(1999))))
             .withColumn("rede", F.explode(F.array(*map(F.lit, ["estadual", "municipal", "privada"]))))
             .withColumn("localizacao", F.explode(F.array(F.lit("total"), F.lit("urbana"))))
             .withColumn("k", F.concat_ws("-", F.col("s_suppkey").cast("string"),
                                          F.col("ano").cast("string"), "rede", "localizacao")))
        part = lambda salt, n: h("k", salt) % n
        d = d.select("ano", "id_municipio", "rede", "localizacao", "k",
                     part("g1", 60).alias("g1"), part("g2", 20).alias("g2"),
                     part("g3", 10).alias("g3"), part("g4", 5).alias("g4"))
        text = lambda c: c.cast("string")
        gap = lambda c, salt: F.when(part(salt, 15) == 0, F.lit("--")).otherwise(text(c))
        return d.select(
            "ano", "id_municipio", "rede", "localizacao",
            text(F.col("g1")).alias("afd_ef_anos_iniciais_grupo_1"),
            text(F.col("g2")).alias("afd_ef_anos_iniciais_grupo_2"),
            text(F.col("g3")).alias("afd_ef_anos_iniciais_grupo_3"),
            text(F.col("g4")).alias("afd_ef_anos_iniciais_grupo_4"),
            text(100 - F.col("g1") - F.col("g2") - F.col("g3") - F.col("g4"))
            .alias("afd_ef_anos_iniciais_grupo_5"),
            gap(part("ird1", 40), "gap_ird").alias("ird_baixa_regularidade"),
            text(part("ird2", 30)).alias("ird_media_baixa"),
            text(part("ied5", 25)).alias("ied_ef_anos_iniciais_nivel_5"),
            gap(part("ied6", 15), "gap_ied").alias("ied_ef_anos_iniciais_nivel_6"),
            gap((part("had", 40) + 30) / 10, "gap_had").alias("had_ef_anos_iniciais"))

    def inse(self) -> DataFrame:
        d = (self.places().select("s_suppkey", "id_municipio")
             .withColumn("ano", F.explode(F.array(F.lit(1997), F.lit(1999))))
             .withColumn("rede", F.explode(F.array(*map(F.lit, ["2", "3", "4"]))))
             .withColumn("tipo_localizacao", F.explode(F.array(F.lit("0"), F.lit("1"))))
             .withColumn("k", F.concat_ws("-", F.col("s_suppkey").cast("string"),
                                          F.col("ano").cast("string"), "rede",
                                          "tipo_localizacao")))
        return d.select("ano", "id_municipio", "rede", "tipo_localizacao",
                        F.when(h("k", "zero") % 20 == 0, F.lit("0"))
                        .otherwise(((h("k", "inse") % 300 + 335) / 100).cast("string"))
                        .alias("inse"))

    def sinasc(self) -> DataFrame:
        d = self.raw("customer").select("c_custkey").transform(with_totals, self.place_count())
        d = d.select(
            (F.lit(1990) + h("c_custkey", "ano") % 5).cast("int").alias("ano"),
            (h("c_custkey", "lugar") % F.col("n_places")).alias("l_suppkey"),
            F.element_at(F.array(*map(F.lit, ["1", "2", "3", "4", "5", "9"])),
                         (h("c_custkey", "mae") % 6 + 1).cast("int")).alias("escolaridade_mae"),
            F.when(h("c_custkey", "idade") % 50 == 0, F.lit("ignorada"))
            .otherwise((h("c_custkey", "idade") % 50 + 9).cast("string")).alias("idade_mae"))
        return self.with_place(d).withColumnRenamed("id_municipio", "id_municipio_residencia")
