"""Rows that fail to parse: CSV records are separated from the valid ones, with the first reason that applies.

Records are assembled from physical lines with respect to quotes (:func:`assemble_records`), each is parsed with
the strict ``csv`` reader inside ``mapInPandas`` (:func:`parse_records`), structural faults are caught before the
typed fields are looked at. Nothing is shuffled by the parser: it is one map over the input, whatever its size.

Defined results: a NULL record counts as an empty one (reason ``columns``); further line ends at a record's end don't matter; an empty table gives an empty result;
repeated records are judged one by one; columns of the input keep their values, and one that is named like a column
that the parser adds (``fields`` or ``reason``) is replaced.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadweave.constants import EMAIL, PLACEHOLDERS

csv.field_size_limit(1 << 30)

FIELDS = ("country", "company", "email", "website", "source_url")
_LINE_END = re.compile(r"(?:\r\n|\n|\r)\Z")
_EMAIL = re.compile(EMAIL)
_HOST = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+(?::[0-9]{1,5})?(?:[/?#]\S*)?"
_WEBSITE = re.compile(r"(?:[Hh][Tt][Tt][Pp][Ss]?://)?" + _HOST)
_SOURCE = re.compile(r"[Hh][Tt][Tt][Pp][Ss]?://" + _HOST)


def _bare_quote(record: str) -> bool:
    """A quote inside an unquoted field, in a record whose quoted fields the strict reader accepted."""
    quoted, start, k, n = False, True, 0, len(record)
    while k < n:
        ch = record[k]
        if quoted:
            if ch == '"':
                if k + 1 < n and record[k + 1] == '"':
                    k += 1
                else:
                    quoted = False
        elif ch == '"':
            if not start:
                return True
            quoted = True
        start = not quoted and ch in ",\r\n"
        k += 1
    return False


def split_record(record: str | None) -> tuple[list[str] | None, str | None]:
    """(fields, None), or (None, 'quoting' or 'columns'). A line break outside quotes ends the record: 'columns'."""
    record = _LINE_END.sub("", record or "", count=1)
    try:
        rows = list(csv.reader(io.StringIO(record, newline="") if record else [""], strict=True))
    except csv.Error:
        # the reader also objects to things that RFC 4180 allows (a NUL); quotes are the only reason it has otherwise
        return None, "quoting" if '"' in record else "columns"
    if '"' in record and _bare_quote(record):
        return None, "quoting"
    if len(rows) != 1 or len(rows[0]) != len(FIELDS):
        return None, "columns"
    return rows[0], None


def field_fault(fields: list[str]) -> str | None:
    """The first of the typed fields that is invalid."""
    email, website, source = (x.strip() for x in fields[2:5])
    if not _EMAIL.fullmatch(email):
        return "email"
    if website and website.lower() not in PLACEHOLDERS and not _WEBSITE.fullmatch(website):
        return "website"
    if source and not _SOURCE.fullmatch(source):
        return "source_url"
    return None


def parse_records(df: DataFrame, record: str = "raw_line") -> DataFrame:
    """``df`` with ``fields`` (array of the five values, NULL if the record doesn't load) and ``reason`` (NULL if it does)."""
    keep = [c for c in df.columns if c.lower() not in ("fields", "reason")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fields, reasons = [], []
            for raw in pdf[record]:
                got, why = split_record(raw)
                why = why or field_fault(got)
                fields.append(None if why else got)
                reasons.append(why)
            yield pdf.assign(fields=fields, reason=pd.Series(reasons, dtype=object, index=pdf.index))

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("fields", T.ArrayType(T.StringType())), T.StructField("reason", T.StringType())])
    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInPandas(run, schema)


def loaded(parsed: DataFrame, id_col: str = "line_no") -> DataFrame:
    """The valid records as rows of the typed table; ``list_no`` is the number in the file's name."""
    return parsed.filter("reason is null").select(
        F.col(id_col).alias("row_id"),
        *[F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(FIELDS)],
        F.regexp_extract("file_name", r"(\d+)\D*\z", 1).try_cast("int").alias("list_no"),
        F.col("arrived_at").alias("received_at"),
    )


def assemble_records(lines: DataFrame, file: str = "file", line_no: str = "line_no", line: str = "line", block: int = 50_000) -> DataFrame:
    """Records (``file``, ``first_line``, ``raw_line``) of physical lines: a line break inside quotes doesn't end one.

    Whether a line starts inside quotes is the parity of all quotes before it in its file. The parity is summed in two
    levels, blocks of ``block`` lines and then lines inside a block, so that a file of any length never meets one task.
    A record itself must fit into memory. NULL lines count as empty; line numbers must be unique in a file.
    """
    x = lines.select(F.col(file).alias("file"), F.col(line_no).cast("long").alias("n"), F.coalesce(F.col(line), F.lit("")).alias("line"))
    x = x.withColumn("q", F.length("line") - F.length(F.replace("line", F.lit('"')))).withColumn("b", F.floor(F.col("n") / block))
    blocks = x.groupBy("file", "b").agg(F.sum("q").alias("bq"))
    w = Window.partitionBy("file").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "b", F.coalesce(F.sum("bq").over(w), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "b").orderBy("n")
    x = x.join(blocks, ["file", "b"]).withColumn("odd", (F.col("before") + F.coalesce(F.sum("q").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2)
    x = x.withColumn("start", F.when(F.col("odd") == 0, F.col("n")))
    # the record that runs into a block begins in an earlier one
    heads = x.groupBy("file", "b").agg(F.max("start").alias("last"))
    heads = heads.select("file", "b", F.last("last", True).over(w).alias("carried"))
    x = x.join(heads, ["file", "b"]).withColumn("first_line", F.coalesce(F.last("start", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "carried"))
    parts = F.array_sort(F.collect_list(F.struct("n", "line")))
    return x.groupBy("file", "first_line").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("raw_line"))
