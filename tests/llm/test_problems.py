"""Every pN query on small tables with NULLs, repeated rows, very long texts and clashing columns, and on empty ones."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

TABLES = ("leads", "firmalar", "sent_log", "incoming_list", "incoming_raw", "documents", "doc_labels", "eval_items", "mix_targets", "ref_cities", "ref_countries", "mail_providers")
NAMES = sorted(n for n in entry.queries() if n.endswith("_found") or n == "p8_shares")
CLASHING = ("key", "k", "label", "src", "id", "text_", "rec", "score", "batch", "n", "a", "b", "_v")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def empty(spark, small, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(f"{at}/{t}.parquet")
    return at


@pytest.fixture(scope="module")
def odd(spark, small, tmp_path_factory):
    """The small tables, each with a row of NULLs (but for its number), a repeated row and more columns."""
    at = str(tmp_path_factory.mktemp("odd"))
    for t in TABLES:
        df = spark.read.parquet(f"{small}/{t}.parquet")
        first = df.columns[0]
        nulls = df.limit(1).select(*[(F.lit(10_000_000) if dict(df.dtypes)[c] in ("bigint", "int") and c == first else F.lit(None)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
        out = df.unionByName(nulls)
        if t not in ("mix_targets", "ref_cities", "ref_countries", "mail_providers", "eval_items"):
            out = out.unionByName(df.orderBy(first).limit(1))
        if t == "documents":
            long = df.limit(1).withColumn("doc_id", F.lit(20_000_000).cast("long")).withColumn("text", F.concat(F.repeat(F.lit("wort zwei. "), 60_000), F.repeat(F.lit("x"), 300_000)))
            out = out.unionByName(long)
        for c in CLASHING:
            if c not in out.columns:
                out = out.withColumn(c, F.lit("clash"))
        out.write.parquet(f"{at}/{t}.parquet")
    return at


@pytest.mark.parametrize("name", NAMES)
def test_empty(spark, empty, name):
    df = entry.queries()[name](spark, empty)
    assert df.count() == 0 or name in ("p8_shares",)


@pytest.mark.parametrize("name", NAMES)
def test_odd(spark, small, odd, name):
    got = rows_of(entry.queries()[name](spark, odd))
    assert got is not None
    if name in ("p1_found", "p4_found", "p5_found", "p7_found"):
        plain = set(rows_of(entry.queries()[name](spark, small)))
        assert plain <= set(got)


def test_subpackage_is_optional():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "leadweave")):
        if "llm" not in os.path.relpath(folder, root).split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "leadweave.llm" not in f.read()
