"""Text layer of PDF files, one block per page; the reading library is optional."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = "slug string, page int, text string, error string"


def by_mupdf(content: bytes) -> list[str]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as document:
        return [page.get_text() or "" for page in document]


def by_pypdf(content: bytes) -> list[str]:
    import io

    from PyPDF2 import PdfReader

    return [page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages]


def read_pages(content: bytes, readers: tuple[Callable[[bytes], list[str]], ...] = (by_mupdf, by_pypdf)) -> list[str]:
    """Page texts by the first reader that is installed and can read the file."""
    failures = []
    for reader in readers:
        try:
            return reader(content)
        except Exception as failure:  # noqa: BLE001 - the next reader may do better
            failures.append(f"{type(failure).__name__}: {failure}")
    raise ValueError("; ".join(failures))


def pdf_pages(files: DataFrame, reader: Callable[[bytes], list[str]] = read_pages) -> DataFrame:
    """Pages of PDF files (slug, content). A file that cannot be read gives one row with the error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for slug, content in zip(batch["slug"], batch["content"]):
                try:
                    texts, error = reader(bytes(content)), None
                except Exception as failure:  # noqa: BLE001 - any reader failure becomes a row
                    texts, error = [None], f"{type(failure).__name__}: {failure}"
                texts = texts or [None]  # a file without pages is reported as well
                pages = range(1, len(texts) + 1)
                yield pd.DataFrame({"slug": slug, "page": pages, "text": texts, "error": error})

    return files.select("slug", "content").mapInPandas(read, PAGES)


def pdf_errors(pages: DataFrame) -> DataFrame:
    """Files that cannot be read and files without any text: slug, category, message."""
    per_file = pages.groupBy("slug").agg(F.max("error").alias("error"), F.max(F.length(F.trim(F.coalesce("text", F.lit(""))))).alias("longest"))
    return per_file.where(F.col("error").isNotNull() | (F.col("longest") == 0)).select(
        "slug",
        F.when(F.col("error").isNotNull(), "pdf_corrupt_or_unsupported").otherwise("partial_extraction").alias("category"),
        F.coalesce("error", F.lit("No page of the PDF has a text layer.")).alias("message"),
    )


def pdf_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of PDF pages (slug, page, text), ready for the profile parsers."""
    good = pages.where(F.col("text").isNotNull())
    size = good.groupBy("slug").agg(F.max("page").alias("page_count"))
    return good.join(size, "slug").select(
        "slug",
        F.col("page").cast("bigint").alias("block_ord"),
        F.concat(F.col("slug"), F.lit("-p"), F.col("page"), F.lit("-text")).alias("block_id"),
        F.lit("body").alias("block_type"),
        "text",
        "page",
        F.col("page").alias("original_page"),
        F.lit(None).cast("int").alias("line_start"),
        F.lit(None).cast("int").alias("line_end"),
        F.array().cast("array<string>").alias("heading_path"),
        F.lit("local_pdf").alias("provider"),
        "page_count",
    )
