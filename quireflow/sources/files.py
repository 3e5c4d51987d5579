"""Files as tables: inventories, Markdown notes, archives, page blocks, and sinks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, name, extension, size, digest) of the files below a folder; names that begin with a dot or ~$ are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.filter(~name.rlike(r"^(?:\.|~\$)")).select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"), F.col("length").alias("size"), F.sha2("content", 256).alias("digest"))


def notes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the Markdown files below a folder, without a byte order mark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "").alias("text"))


def archives(spark: SparkSession, folder: str, most: int = 1 << 28) -> DataFrame:
    """(path, member, size, content, error) of the members of ZIP files; unsafe names and members over ``most`` bytes have an error and no content."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch.path, batch.content):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for m in z.infolist():
                            if m.is_dir():
                                continue
                            bad = "unsafe name" if m.filename.startswith(("/", "\\")) or ".." in m.filename.replace("\\", "/").split("/") or ":" in m.filename[:3] else "too large" if m.file_size > most else None
                            yield pd.DataFrame({"path": [path], "member": [m.filename], "size": [m.file_size], "content": [None if bad else z.read(m)], "error": [bad]})
                except zipfile.BadZipFile:
                    yield pd.DataFrame({"path": [path], "member": [None], "size": [None], "content": [None], "error": ["no archive"]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInPandas(read, "path string, member string, size long, content binary, error string")


BLOCK = "struct<block_id: string, page: int, page_idx: int, type: string, bbox: array<double>, text: string>"


def page_blocks(rows: DataFrame, column: str) -> DataFrame:
    """Blocks of pages from JSON, one row each: a flat list with page_idx from 0, a list of lists by page, or an object with ``blocks``.

    Missing ids are numbered within the record, missing pages follow from the layout.
    """
    flat = F.from_json(column, f"array<{BLOCK}>")
    nested = F.from_json(column, f"array<array<{BLOCK}>>")
    held = F.from_json(column, f"struct<blocks: array<{BLOCK}>>")["blocks"]
    is_nested = F.col(column).rlike(r"^\s*\[\s*\[")
    numbered = F.flatten(F.transform(nested, lambda page, i: F.transform(page, lambda b: b.withField("page_idx", F.coalesce(b["page_idx"], i.cast("int"))))))
    blocks = F.when(is_nested, numbered).when(F.col(column).rlike(r"^\s*\{"), held).otherwise(flat)
    out = rows.select(*[c for c in rows.columns if c != column], F.posexplode(blocks).alias("_at", "b"))
    rest = [c for c in rows.columns if c != column]
    return out.select(*rest, F.coalesce(F.col("b.block_id"), F.concat(F.lit("b"), (F.col("_at") + 1).cast("string"))).alias("block_id"), F.coalesce(F.col("b.page"), F.col("b.page_idx") + 1, F.lit(1)).alias("page"), F.col("b.type").alias("type"), F.col("b.bbox").alias("bbox"), F.col("b.text").alias("text"))


def write_new(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A Parquet sink that refuses to replace what is there unless asked; a failed write leaves no finished table."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
