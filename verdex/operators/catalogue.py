"""Hits to a typed, flat catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdex.functions.dates import parse_date
from verdex.functions.text import clean_text, truncate_text, variant_to_string
from verdex.sources.pages import LIST_FIELDS

# Catalogue column -> field of the hit's `_source` (`score` is the hit's `_score`).
CATALOGUE_FIELDS = {
    "id": "id",
    "titulo": "titulo",
    "base": "base",
    "score": "_score",
    "processo_codigo_completo": "processo_codigo_completo",
    "processo_numero": "processo_numero",
    "processo_classe": "processo_classe_processual_unificada_extenso",
    "processo_classe_sigla": "processo_classe_processual_unificada_classe_sigla",
    "procedencia_uf": "procedencia_geografica_uf_sigla",
    "procedencia_uf_extenso": "procedencia_geografica_uf_extenso",
    "procedencia_completo": "procedencia_geografica_completo",
    "ministro_facet": "ministro_facet",
    "relator_processo": "relator_processo_nome",
    "relator_acordao": "relator_acordao_nome",
    "julgamento_data": "julgamento_data",
    "publicacao_data": "publicacao_data",
    "republicacao_data": "republicacao_data",
    "orgao_julgador": "orgao_julgador",
    "is_questao_ordem": "is_questao_ordem",
    "is_repercussao_geral": "is_repercussao_geral",
    "is_repercussao_geral_merito": "is_repercussao_geral_merito",
    "is_colac": "is_colac",
    "is_processo_antigo": "is_processo_antigo",
    "inteiro_teor_url": "inteiro_teor_url",
    "acompanhamento_processual_url": "acompanhamento_processual_url",
    "dje_url": "dje_url",
    "ementa_texto": "ementa_texto",
    "acordao_ata": "acordao_ata",
    "partes_lista_texto": "partes_lista_texto",
    "documental_publicacao": "documental_publicacao_lista_texto",
    "documental_indexacao": "documental_indexacao_texto",
    "documental_tese_tipo": "documental_tese_tipo",
    "documental_tese_texto": "documental_tese_texto",
    "documental_tese_tema": "documental_tese_tema_texto",
    "dg_atualizado_em": "dg_atualizado_em",
    "ods_onu": "ods_onu",
}
# Cleaned text columns with their cut length (None: cleaned, not cut).
CLEANED = {
    "ementa_texto": 1000,
    "acordao_ata": 500,
    "partes_lista_texto": None,
    "documental_publicacao": None,
    "documental_indexacao": 500,
    "documental_tese_texto": None,
    "documental_tese_tema": None,
}
# Date columns.
DATE_COLUMNS = ("julgamento_data", "publicacao_data", "republicacao_data", "dg_atualizado_em")
# The columns shown first.
MAIN_COLUMNS = (
    "titulo", "processo_classe_sigla", "procedencia_uf", "orgao_julgador", "julgamento_data",
    "is_repercussao_geral", "score",
)


def catalogue(hits: DataFrame, fields: Mapping[str, str] = CATALOGUE_FIELDS) -> DataFrame:
    """(…, hit) -> one flat row per hit."""

    def column(name: str, field: str):
        if field == "_score":
            return F.col("hit._score").alias(name)
        c = F.col(f"hit._source.{field}")
        if field in LIST_FIELDS:
            c = variant_to_string(c)
        if name in CLEANED:
            c = clean_text(c)
            if CLEANED[name]:
                c = truncate_text(c, CLEANED[name])
        return c.alias(name)

    return hits.select(*[column(name, field) for name, field in fields.items()])


def coerce_dates(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Text dates (ISO or day first) to timestamps; what is neither becomes null."""
    return df.withColumns({c: parse_date(F.col(c)) for c in cols if c in df.columns})
