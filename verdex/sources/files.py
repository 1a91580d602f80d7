"""Ruling files: listing and text extraction."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdex.functions.text import html_to_text, strip


def any_case(suffix: str) -> str:
    return "*." + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in suffix)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_ids(spark: SparkSession, folder: str, suffix: str = "pdf") -> DataFrame:
    """Ids (stems) of the files with the suffix, in any case; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", any_case(suffix)).load(folder)
    return listing.select(file_stem(F.col("path")).alias("id")).distinct()


def ingest_documents(
    spark: SparkSession,
    folder: str,
    extractor: Callable[[bytes], Iterable[str]] | None = None,
    suffix: str = "pdf",
) -> DataFrame:
    """One row per file: (nome_pdf, texto_completo, error).

    `extractor` turns the bytes of a file into page texts; it runs on the executors, on Arrow
    batches. A file it cannot read gives an empty text and the error. Without an extractor the
    files are read as HTML, JVM-side.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", any_case(suffix)).load(folder)
    if extractor is None:
        return files.select(
            file_name(F.col("path")).alias("nome_pdf"),
            html_to_text(F.decode("content", "UTF-8")).alias("texto_completo"),
            F.lit(None).cast("string").alias("error"),
        )

    def extract(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    pages, error = [str(p) for p in extractor(bytes(content))], None
                except Exception as exc:  # an unreadable file is a row with its error
                    pages, error = [], f"{type(exc).__name__}: {exc}"
                rows.append((path, pages, error))
            yield pd.DataFrame(rows, columns=["path", "pages", "error"])

    pages = files.select("path", "content").mapInPandas(
        extract, "path string, pages array<string>, error string"
    )
    return pages.select(
        file_name(F.col("path")).alias("nome_pdf"),
        strip(F.array_join("pages", "\n")).alias("texto_completo"),
        "error",
    )


def fold_pages(df: DataFrame, doc: str, page_no: str, text: str, chunk: int = 256) -> DataFrame:
    """Page rows to one text per document, pages in order, glued with a line feed.

    Pages are first folded in chunks of neighbouring page numbers, so the pages of one very long
    document are sorted and glued by many tasks; only the glued chunks meet at the end.
    """
    pieces = (
        df.where(F.col(text).isNotNull())
        .groupBy(doc, F.floor(F.col(page_no) / chunk).alias("_chunk"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col(page_no).alias("n"), F.col(text).alias("t")))).alias("_p"))
        .select(doc, "_chunk", F.array_join(F.col("_p.t"), "\n").alias("_text"))
    )
    return (
        pieces.groupBy(doc)
        .agg(F.sort_array(F.collect_list(F.struct("_chunk", "_text"))).alias("_p"))
        .select(doc, strip(F.array_join(F.col("_p._text"), "\n")).alias("text"))
    )
