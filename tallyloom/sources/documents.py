"""From page texts to whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_documents(
    pages: DataFrame,
    file: str = "file_name",
    page_no: str = "page_no",
    text: str = "text",
    pages_per_block: int = 256,
) -> DataFrame:
    """One row per file: its pages in order, joined by a blank line; a missing page is empty.

    Pages are first joined in blocks of neighbouring pages, so the pages of one very long file
    are sorted and joined by many tasks, and the last step handles a few long strings.
    """
    block = F.floor(F.col(page_no) / pages_per_block)
    blocks = pages.groupBy(file, block.alias("_block")).agg(
        F.expr(
            f"listagg(coalesce(`{text}`, ''), '\\n\\n') WITHIN GROUP (ORDER BY `{page_no}`)"
        ).alias("_text")
    )
    return (
        blocks.groupBy(file)
        .agg(F.expr("listagg(_text, '\\n\\n') WITHIN GROUP (ORDER BY _block)").alias("raw_content"))
        .withColumn("ingested_at", F.current_timestamp())
    )
