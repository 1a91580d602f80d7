"""Documents to paragraphs that mention given terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdex.functions import text as T

# The search terms, in order.
SEARCH_TERMS = (
    "consequencialismo", "tragédia dos comuns", "natureza da firma", "eficiência de Pareto",
    "produtos rivais", "produtos não-rivais", "barreiras de entrada", "custo de oportunidade",
    "teorema de Coase", "bens públicos", "perda social",
    "meios alternativos de solução de conflitos", "análise econômica da litigância",
    "teoria da escolha racional", "teoria dos jogos", "custos sociais", "economia comportamental",
    "seleção adversa", "externalidades negativas", "captura regulatória", "enforcement",
    "falhas de mercado", "excedente do consumidor", "assimetria regulatória",
    "sistema de incentivos", "custos de transação", "trade-off", "teoria da escolha pública",
    "assimetria de informações", "problema do agente-principal", "eficiência de Kaldor–Hicks",
    "monopólio legal", "Posner", "Coase", "Cooter", "Ulen", "Shavell", "North", "Mackaay",
    "análise econômica do direito",
)


def paragraphs(df: DataFrame, id: str, text: str, min_len: int = 300) -> DataFrame:
    """(id, pos, paragraph) for every paragraph of every document. No shuffle."""
    lines = df.select(id, T.sentence_line(F.col(text)).alias("_line"))
    return lines.select(
        id, F.posexplode(T.paragraphs_of_line(F.col("_line"), min_len)).alias("pos", "paragraph")
    )


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition holds, through a generator instead of a filter.

    Spark pushes a filter on a computed column below the projection that computes it, and then
    computes it again for every mention. Costly text columns are therefore tested this way.
    """
    kept = df.select("*", F.explode(F.when(condition, F.array(F.lit(True)))).alias("_kept"))
    return kept.drop("_kept")


def match_terms(df: DataFrame, text: str, terms: Sequence[str] = SEARCH_TERMS) -> DataFrame:
    """Adds `terms`, the terms the text contains in any case; rows without any are dropped."""
    lowered = df.withColumn("_lower", F.lower(text))
    found = lowered.withColumn("terms", T.matched_terms(F.col("_lower"), terms)).drop("_lower")
    return keep_rows(found, F.size("terms") > 0)


def search_any(df: DataFrame, text: str, terms: Sequence[str] = SEARCH_TERMS) -> DataFrame:
    """Rows whose text contains at least one term, in any case."""
    lowered = df.withColumn("_lower", F.lower(text))
    return keep_rows(lowered, T.contains_any(F.col("_lower"), terms)).drop("_lower")


def dedup_prefix(df: DataFrame, id: str, text: str, pos: str, n: int = 100) -> DataFrame:
    """The first row by `pos` per document and first `n` characters.

    Spark limits each group to its first row on the map side already, so a prefix that holds a
    large share of all rows does not travel.
    """
    window = Window.partitionBy(id, F.substring(text, 1, n)).orderBy(pos)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def term_paragraphs(
    df: DataFrame, id: str, text: str, terms: Sequence[str] = SEARCH_TERMS, min_len: int = 300
) -> DataFrame:
    """(id, pos, terms, paragraph): paragraphs with a term, first per document and prefix.

    Documents without any term are dropped before they are cut. A paragraph is a piece of the
    sentence line with its last dot, so a document whose line has no term has no such paragraph.
    """
    lines = df.select(id, T.sentence_line(F.col(text)).alias("_line"))
    lines = lines.withColumn("_lower", F.lower(F.concat("_line", F.lit("."))))
    pieces = F.when(
        T.contains_any(F.col("_lower"), terms), T.paragraphs_of_line(F.col("_line"), min_len)
    )
    cut = lines.select(id, F.posexplode(pieces).alias("pos", "paragraph"))
    first = dedup_prefix(match_terms(cut, "paragraph", terms), id, "paragraph", "pos")
    return first.select(id, "pos", "terms", "paragraph")
