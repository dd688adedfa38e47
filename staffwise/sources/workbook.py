"""Spreadsheet sources (S5-S7): one task per workbook.

Workbooks are read as bytes with the ``binaryFile`` source and parsed on the
executors by ``mapInPandas`` (pandas' Excel reader, which needs the optional
``openpyxl`` package on the executors).  Each sheet row comes out as
``(file, sheet, row_no, cells)`` with ``cells`` a ``map<string,string>``; a
second step turns the map keys into columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_SCHEMA = "file string, sheet string, row_no long, cells map<string,string>"


def available() -> bool:
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        return False
    return True


def excel_book(content: bytes, header: int):
    """Default parser: ``{sheet name: pandas frame of text}`` in sheet order."""
    import io

    import pandas as pd

    book = pd.ExcelFile(io.BytesIO(content))
    return {name: book.parse(name, header=header, dtype=str) for name in book.sheet_names}


def read_sheets(spark: SparkSession, pattern: str, sheet: int | str | None = 0, sheet_regex: str | None = None,
                header: int = 0, parser=None) -> DataFrame:
    """Rows of the chosen sheet (by index or name, S5/S7) or of every sheet whose
    name matches ``sheet_regex`` case-insensitively (S6), as text.

    ``parser(content, header) -> {sheet: pandas frame}`` reads one workbook; the
    default uses pandas' Excel reader (needs ``openpyxl`` on the executors).
    """
    if parser is None:
        if not available():
            raise ImportError("reading workbooks needs the openpyxl package on the executors")
        parser = excel_book
    rx = re.compile(sheet_regex, re.IGNORECASE) if sheet_regex else None

    def parse(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                book = parser(bytes(content), header)
                names = list(book)
                if rx is not None:
                    chosen = [n for n in names if rx.match(n)]
                elif isinstance(sheet, int):
                    chosen = [names[sheet]] if sheet < len(names) else []
                else:
                    chosen = [sheet] if sheet in names else []
                for name in chosen:
                    frame = book[name]
                    for i, rec in enumerate(frame.to_dict("records")):
                        cells = {str(k): (None if pd.isna(v) else str(v)) for k, v in rec.items()}
                        out.append((path.rsplit("/", 1)[-1], name, i, cells))
            yield pd.DataFrame(out, columns=["file", "sheet", "row_no", "cells"])

    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInPandas(parse, ROW_SCHEMA)


def cells_to_columns(rows: DataFrame) -> DataFrame:
    """Spread the cell map to columns (the key set is small metadata)."""
    keys = sorted(r[0] for r in rows.select(F.explode(F.map_keys("cells"))).distinct().collect())
    return rows.select("file", "sheet", "row_no", *[F.col("cells")[k].alias(k) for k in keys])
