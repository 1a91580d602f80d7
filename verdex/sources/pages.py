"""Search-API pages: read, split good from bad, one row per hit, audit of declared totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a hit's `_source`. Flags are booleans; the two list-or-scalar
# fields are kept as variant; the others are text.
FLAG_FIELDS = (
    "is_questao_ordem", "is_repercussao_geral", "is_repercussao_geral_merito", "is_colac",
    "is_processo_antigo",
)
LIST_FIELDS = ("ministro_facet", "ods_onu")
TEXT_FIELDS = (
    "id", "titulo", "base", "processo_codigo_completo", "processo_numero",
    "processo_classe_processual_unificada_extenso",
    "processo_classe_processual_unificada_classe_sigla", "procedencia_geografica_uf_sigla",
    "procedencia_geografica_uf_extenso", "procedencia_geografica_completo",
    "relator_processo_nome", "relator_acordao_nome", "julgamento_data", "publicacao_data",
    "republicacao_data", "orgao_julgador", "inteiro_teor_url", "acompanhamento_processual_url",
    "dje_url", "ementa_texto", "acordao_ata", "partes_lista_texto",
    "documental_publicacao_lista_texto", "documental_indexacao_texto", "documental_tese_tipo",
    "documental_tese_texto", "documental_tese_tema_texto", "dg_atualizado_em",
)


def page_schema() -> str:
    source = ", ".join(
        [f"{f}: string" for f in TEXT_FIELDS]
        + [f"{f}: boolean" for f in FLAG_FIELDS]
        + [f"{f}: variant" for f in LIST_FIELDS]
    )
    hit = f"struct<_score: double, _source: struct<{source}>>"
    return f"result struct<hits: struct<total: struct<value: bigint>, hits: array<{hit}>>>, _bad string"


def read_raw_pages(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(path, body) of every page that exists, and the paths (or globs) that match nothing.

    A page is an API answer with a bounded number of hits, so a page per row is a small row.
    """
    conf, place = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    found, missing = [], []
    for path in paths:  # asks the file system alone; no job
        there = place(path).getFileSystem(conf).globStatus(place(path))
        (found if there else missing).append(path)
    if not found:
        raise FileNotFoundError(f"no page found under {list(paths)}")
    raw = spark.read.text(found, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("page"), F.col("value").alias("body")), missing


def parse_pages(raw: DataFrame) -> DataFrame:
    """(page, body) -> (page, declared, hits); `hits` is null for a bad page."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = raw.select("page", F.from_json("body", page_schema(), options).alias("p"))
    return parsed.select(
        "page",
        F.col("p.result.hits.total.value").alias("declared"),
        F.col("p.result.hits.hits").alias("hits"),
        F.col("p._bad").isNotNull().alias("malformed"),
    )


def split_hits(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per hit (page, pos, hit) and the quarantine (page, reason).

    The outer generator keeps Spark from inferring a size filter, for which it would parse every
    page a second time.
    """
    hits = pages.select("page", F.posexplode_outer("hits").alias("pos", "hit"))
    hits = hits.where(F.col("pos").isNotNull())
    reason = F.when(F.col("malformed"), "invalid JSON").otherwise("no result.hits.hits")
    quarantine = pages.where(F.col("hits").isNull()).select("page", reason.alias("reason"))
    return hits, quarantine


def in_page_order(hits: DataFrame) -> DataFrame:
    """Hits sorted by the last number in the page's name (page 10 after page 9), name and position."""
    number = F.regexp_extract(F.col("page").cast("string"), r"(\d+)\D*$", 1).try_cast("bigint")
    return hits.orderBy(number, "page", "pos")


def read_hits(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Hits of all good pages with their place (page, pos), and the quarantine table."""
    raw, missing = read_raw_pages(spark, paths)
    hits, quarantine = split_hits(parse_pages(raw))
    return hits, with_missing(quarantine, missing)


def with_missing(quarantine: DataFrame, missing: Sequence[str]) -> DataFrame:
    """The quarantine table with the paths that match nothing."""
    if not missing:
        return quarantine
    lost = quarantine.sparkSession.createDataFrame([(p, "not found") for p in missing], "page string, reason string")
    return quarantine.unionByName(lost)


def hits_audit(pages: DataFrame) -> DataFrame:
    """Declared total against the hits present, over all good pages."""
    return pages.agg(
        F.count("hits").alias("pages"),
        F.coalesce(F.max("declared"), F.lit(0)).alias("declared"),
        F.coalesce(F.sum(F.size("hits").cast("bigint")), F.lit(0)).alias("actual"),
    ).withColumn("missing", F.col("declared") - F.col("actual"))
