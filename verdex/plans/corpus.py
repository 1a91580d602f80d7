"""The two corpus flows: saved pages to a checked catalogue, ruling files to term paragraphs.

Every stage that is read more than once is a written table, so a lost executor costs no more than
the stage it worked on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from verdex.operators import audit
from verdex.operators.catalogue import catalogue, coerce_dates
from verdex.operators.terms import SEARCH_TERMS, term_paragraphs
from verdex.runtime import cut, spread
from verdex.sources.files import file_ids, ingest_documents
from verdex.sources.pages import hits_audit, in_page_order, parse_pages, read_hits, read_raw_pages, split_hits, with_missing
from verdex.sources.sinks import write_csv, write_json, write_parquet
from verdex.sources.tables import catalogue_ids


def merge_pages(spark: SparkSession, paths: Sequence[str], out: str) -> dict[str, DataFrame]:
    """Write the hits of all good pages as JSON Lines, in page order; (audit, quarantine) tells what
    was read. Without hits nothing is written."""
    raw, missing = read_raw_pages(spark, paths)
    pages = cut(parse_pages(raw))  # parsed once
    hits, quarantine = split_hits(pages)
    if not hits.isEmpty():
        write_json(in_page_order(hits).select("page", "pos", "hit._score", "hit._source"), out)
    return {"audit": hits_audit(pages), "quarantine": with_missing(quarantine, missing)}


def build_catalogue(spark: SparkSession, paths: Sequence[str], out: str) -> DataFrame:
    """Pages to the catalogue CSV at `out`; gives the catalogue."""
    table = coerce_dates(catalogue(read_hits(spark, paths)[0]))
    write_csv(table, out)
    return table


def check_corpus(spark: SparkSession, catalogue_csv: str, folder: str, suffix: str = "pdf") -> dict[str, DataFrame]:
    """Catalogue ids without a file, and files without a catalogue row."""
    listed, present = catalogue_ids(spark, catalogue_csv), file_ids(spark, folder, suffix)
    return {
        "missing": audit.missing_ids(listed, present, "id"),
        "extra": audit.missing_ids(present, listed, "id"),
    }


def check_duplicates(documents: DataFrame, id: str = "nome_pdf", text: str = "texto_completo") -> dict[str, DataFrame]:
    return {
        "stats": audit.duplicate_stats(documents, text),
        "rows": audit.duplicate_rows(documents, id, text),
    }


def build_documents(
    spark: SparkSession,
    folder: str,
    out: str,
    extractor: Callable[[bytes], Iterable[str]] | None = None,
    suffix: str = "pdf",
) -> DataFrame:
    """Ruling files to the documents table (nome_pdf, texto_completo) at `out`."""
    texts = ingest_documents(spark, folder, extractor, suffix).select("nome_pdf", "texto_completo")
    write_parquet(texts, out)
    return spark.read.parquet(out)


def build_term_paragraphs(
    documents: DataFrame, out: str, terms: Sequence[str] = SEARCH_TERMS
) -> DataFrame:
    """Documents table to the table of paragraphs to label, at `out`."""
    texts = spread(documents.select("nome_pdf", "texto_completo"))
    found = term_paragraphs(texts, "nome_pdf", "texto_completo", terms)
    table = found.selectExpr(
        "nome_pdf", "array_join(terms, ', ') AS termos_encontrados", "paragraph AS paragrafo_completo"
    )
    write_parquet(table, out)
    return documents.sparkSession.read.parquet(out)
