"""Pages of HTML as rows: texts by blocks, table rows, tables as grids. The parsing is a helper on the rows of an Arrow batch.

Defined cases: a null page has no blocks, rows or cells; a null key is a key, and pages that repeat a key are each read;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import markup

_BLOCKS = pa.list_(pa.struct([("tag", pa.string()), ("depth", pa.int32()), ("text", pa.string())]))
_ROWS = pa.list_(pa.struct([("cells", pa.list_(pa.string())), ("head", pa.string())]))
_CELLS = pa.list_(pa.struct([("table_idx", pa.int32()), ("depth", pa.int32()), ("row_idx", pa.int32()), ("column_idx", pa.int32()), ("row_span", pa.int32()), ("column_span", pa.int32()), ("header", pa.bool_()), ("text", pa.string())]))


def _each(pages: DataFrame, key: str, name: str, arrow: pa.DataType, ddl: str, of: Callable[[markup.Page], list]) -> DataFrame:
    """key and what `of` gives of each page, of which the part `name` is read; one list a page, so a page is parsed once and read by built-in functions afterwards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([of(markup.read(h, frozenset((name,)))) for h in b.column("html").to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays([b.column(key), found], names=[key, name])

    return pages.select(key, "html").mapInArrow(work, f"{key} {pages.schema[key].dataType.simpleString()}, {name} {ddl}")


def blocks(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, block_idx, tag, depth, text) of pages (key, html): text with single spaces, by the nearest block element it stands in."""
    of = lambda p: p.blocks
    found = _each(pages, key, "blocks", _BLOCKS, "array<struct<tag string, depth int, text string>>", of)
    return found.select(key, F.posexplode("blocks").alias("block_idx", "b")).select(key, "block_idx", "b.*")


def table_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, rows) of pages (key, html): for every table row its cells' texts, and those joined as one lower-case head."""
    of = lambda p: [*zip(p.rows, p.heads, strict=True)]
    return _each(pages, key, "rows", _ROWS, "array<struct<cells array<string>, head string>>", of)


def grids(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, table_idx, depth, row_idx, column_idx, row_span, column_span, header, text) of every cell; tables inside cells are tables of their own."""
    of = lambda p: p.cells
    ddl = "array<struct<table_idx int, depth int, row_idx int, column_idx int, row_span int, column_span int, header boolean, text string>>"
    return _each(pages, key, "cells", _CELLS, ddl, of).select(key, F.explode("cells").alias("c")).select(key, "c.*")


def filled(grid: DataFrame) -> DataFrame:
    """grids() with a row for every place that a cell spans, at that place, and whether the cell begins there."""
    places = F.arrays_zip(F.flatten(F.transform(F.sequence(F.lit(0), F.col("row_span") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.col("column_span") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))))).alias("at"))
    out = grid.withColumn("p", F.explode(places)).withColumn("begins", (F.col("p.at.i") == 0) & (F.col("p.at.j") == 0))
    return out.withColumns({"row_idx": F.col("row_idx") + F.col("p.at.i"), "column_idx": F.col("column_idx") + F.col("p.at.j")}).drop("p", "row_span", "column_span")
