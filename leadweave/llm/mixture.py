"""Mixing sources to target weights by systematic sampling.

Sizes are tokens of a public tokenizer, counted once and written to the shared folder. The largest mixture whose
listed sources with documents all reach their target share (relative to each other) without a document being used
more than ``max_repeats`` times gives every source its expected copies a document. Inside a source the documents are
ordered by size, then by a hash: the running sum of expected copies plus one random offset crosses a whole number once
per emitted copy. Ordering by size makes the emitted tokens follow the expected ones closely.

The running sum is two-level: counts by (source, size, slice) are summed over the small table of sizes, and rows are
numbered inside a slice only, so no source, however large, meets one task.

Defined results: documents without text or tokens are never emitted; a NULL or unlisted source has share 0; a listed
source without documents reaches 0 and the others keep their proportions; repeated rows are documents of their own;
empty tables give an empty mixture and a report with zeros.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadweave.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published split pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PIECE = 200_000


def _pieces(text: str) -> Iterator[str]:
    """Parts of a very long text, cut where the split pattern cuts anyway: before a blank between two words."""
    at = 0
    while len(text) - at > _PIECE:
        k = at + _PIECE
        while k < len(text) and not (text[k] == " " and text[k - 1].isalpha() and text[k + 1 : k + 2].isalpha()):
            k += 1
        yield text[at:k]
        at = k
    yield text[at:]


def token_count(text: F.Column, vocabulary: str = TOKENIZER) -> F.Column:
    """Tokens of a text column under a public byte-level vocabulary in rank format; 0 for NULL."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            yield pd.Series([sum(len(coder.encode_ordinary(p)) for p in _pieces(t)) if t else 0 for t in batch], dtype="int64")

    return count(text)


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", vocabulary: str = TOKENIZER) -> DataFrame:
    """(source, doc_id, n_tokens) of the documents with tokens, written once."""
    out = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), token_count(F.col(text_col), vocabulary).alias("n_tokens"))
    return cut(out, "sizes").filter("n_tokens > 0")


def plan(sized: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 17) -> DataFrame:
    """One row a listed source: its tokens, expected copies a document and random offset.

    Without ``total_tokens`` the mixture is as large as the caps allow; a larger wish leaves capped sources at their cap.
    """
    t = targets.filter("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    p = t.join(have, "source", "left").fillna(0, ["tokens", "docs"])
    usable = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    every = Window.partitionBy(F.lit(0))  # the target table: one row a source
    p = p.withColumn("weight", F.when(usable, F.col("target_share") / F.sum(F.when(usable, F.col("target_share"))).over(every)).otherwise(0.0))
    most = F.min(F.when(F.col("weight") > 0, F.col("tokens") * F.col("max_repeats") / F.col("weight"))).over(every)
    p = p.withColumn("total", F.coalesce(F.lit(total_tokens).cast("double") if total_tokens else most, F.lit(0.0)))
    copies = F.when(F.col("weight") > 0, F.least(F.col("weight") * F.col("total") / F.col("tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return p.select("source", "target_share", "max_repeats", "tokens", "docs", copies.alias("copies"), offset.alias("offset"))


def mix(sized: DataFrame, planned: DataFrame, slice_rows: int = 100_000, seed: int = 17) -> DataFrame:
    """(source, doc_id, n_tokens, copy_no): every emitted copy."""
    # the plan has one row a listed source; a longer list than a broadcast may carry is joined by shuffle
    rows = planned.count()
    p = planned.select("source", "copies", "offset", "max_repeats").filter("copies > 0")
    x = sized.join(F.broadcast(p) if rows <= 100_000 else p, "source").withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
    counts = x.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg(F.max("n")).first()[0] or 1
    slices = max(1, -(-largest // slice_rows))
    x = x.withColumn("slice", F.pmod("h", F.lit(slices)))
    counts = x.groupBy("source", "n_tokens", "slice").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy("n_tokens", "slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("source", "n_tokens", "slice", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "n_tokens", "slice").orderBy("h", "doc_id"))
    x = x.withColumn("k", inside).join(before, ["source", "n_tokens", "slice"]).withColumn("k", F.col("k") + F.col("before"))
    upto = lambda k: F.floor(F.col("offset") + F.col("copies") * k)
    n = F.least(upto(F.col("k")) - upto(F.col("k") - 1), F.col("max_repeats").cast("long"))
    x = x.withColumn("n", n).filter("n > 0")
    return x.select("source", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy_no"))


def shares(mixed: DataFrame, planned: DataFrame) -> DataFrame:
    """The report: per listed source the target and the reached share, emitted copies and tokens, most uses of a document."""
    got = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("copies"), F.sum("n_tokens").alias("tokens"), F.max("copy_no").cast("long").alias("most_uses"))
    r = planned.select("source", "target_share", F.col("max_repeats").cast("long").alias("max_repeats"), F.col("tokens").alias("tokens_there")).join(got, "source", "left").fillna(0, ["copies", "tokens", "most_uses"])
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return r.withColumn("reached_share", F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0))
