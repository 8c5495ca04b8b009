"""Fixed values of one analysis cycle.

`Cycle` carries every year and threshold the steps need, so that a run for another year is
a new `Cycle`, not an edited function.
"""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Cycle:
    target: int = 2024
    score_cut: float = 743.0
    unit_target: float = 59.9
    min_stable: int = 20
    seed: int = 42
    folds: int = 5
    rare_limit: int = 1000        # pupils below which a category is rare
    # reference years of the slower public sources
    atlas_year: int = 2010
    violence_year: int = 2019
    teacher_year: int = 2022
    socio_year: int = 2021

    @property
    def previous(self) -> int:
        return self.target - 1

    @property
    def economy_year(self) -> int:
        return self.target - 3

    @property
    def preschool_year(self) -> int:
        return self.target - 2

    @property
    def birth_years(self) -> tuple[int, int]:
        return (self.target - 8, self.target - 7)


# The cycle the test tables are mapped onto (see FIXTURES.md).
DEMO = Cycle(target=2000, score_cut=50000.0, unit_target=53.0, atlas_year=1996,
             violence_year=1999, teacher_year=1998, socio_year=1997)

STATE, MUNICIPAL, PRIVATE = "Estadual", "Municipal", "Privada"
PUBLIC_NETWORKS = (STATE, MUNICIPAL)
NETWORK_BY_CODE = {"2": STATE, "3": MUNICIPAL}
NETWORK_BY_NAME = {"estadual": STATE, "municipal": MUNICIPAL}
TRAIN, VALID, TEST = "treino", "validacao", "teste"

# Column contract of the inputs.
CONTRACT = {
    "alunos": ["ano", "id_municipio", "rede_nome", "presente", "alfabetizado", "proficiencia",
               "peso_aluno"],
    "municipio": ["ano", "id_municipio", "rede", "rede_nome", "sigla_uf", "nome_regiao",
                  "taxa_alfabetizacao", "media_portugues"],
    "indicador_municipio": ["ano", "id_municipio", "taxa", "percentual_participacao",
                            "taxa_ajustada", "alunos_presentes", "meta_taxa", "origem"],
}

# Columns that would leak the response, and current-cycle columns known before the test.
FORBIDDEN = ("proficiencia", "alfabetizado", "presente", "peso_aluno")
KNOWN_BEFORE_TEST = ("rede_porte_atual", "mun_porte_atual", "rede_peso_no_municipio",
                     "mun_meta_ciclo", "mun_gap_meta")
DERIVED_CONTEXT = ("rede_vs_municipio", "rede_vs_uf", "esc_alunos_por_sala",
                   "esc_pct_transporte")
LAG_SUFFIX = "_ant"
CONTEXT_PREFIXES = ("esc_", "mun_", "turma_", "uf_")

# Fixed limits of the variable curation.
MAX_MISSING = 0.20
MAX_MODE_SHARE = 0.90
MAX_VIF = 10.0
MAX_ABS_RHO = 0.80
NOISE_LOW, NOISE_HIGH = 0.25, 0.45

BANDS = ((0, 25, "até 25%"), (25, 50, "25 a 50%"), (50, 75, "50 a 75%"),
         (75, 100, "acima de 75%"))
