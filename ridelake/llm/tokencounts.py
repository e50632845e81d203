"""Exact token counts for every context limit from one histogram of encoded lengths.

Every whole text is encoded once; documents are then only their length. The histogram has one
row per distinct length, and sums up to and beyond each length answer totals, quantiles and
what truncating at any limit leaves.

Defined cases: null and empty texts have length 0; very long texts are encoded whole; repeated rows count each; an empty table
gives an empty histogram, totals of 0 and null quantiles. Columns other than text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch, running_total

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the pattern that cuts a text before its pieces are encoded by this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[int, object] = {}


def _encoder(ranks: bytes):
    """The encoder of a vocabulary file, built once per worker process."""
    import tiktoken

    key = hash(ranks)
    if key not in _encoders:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The encoded length of every text, one column n_tokens.

    The vocabulary file, about a megabyte whatever the corpus, is read by the driver and sent
    along, so executors need not see its folder.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(sent.value).encode_ordinary
        for batch in batches:
            sizes = [len(encode(text.as_py() or "")) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(run, "n_tokens long")


def histogram(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per distinct length, as a context limit: what is at most that long, what is longer, and the truncated total.

    Columns: n_tokens, n_docs (of this length), docs_up_to, tokens_up_to, docs_beyond and
    truncated_total (tokens left when every document is cut at n_tokens).
    """
    scratch = Scratch(docs.sparkSession, "tokencounts")
    counts = lengths(docs, tokenizer).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counts = scratch.freeze(counts.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")), "counts")
    counts = running_total(scratch, "by_docs", counts, ["n_tokens"], "n_docs", "docs_before")
    counts = running_total(scratch, "by_tokens", counts, ["n_tokens"], "tokens", "tokens_before")
    total = counts.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n")).first().n
    beyond = F.lit(total) - F.col("docs_before") - F.col("n_docs")
    return counts.select(
        "n_tokens",
        "n_docs",
        (F.col("docs_before") + F.col("n_docs")).alias("docs_up_to"),
        (F.col("tokens_before") + F.col("tokens")).alias("tokens_up_to"),
        beyond.alias("docs_beyond"),
        (F.col("tokens_before") + F.col("tokens") + beyond * F.col("n_tokens")).alias("truncated_total"),
    )


def truncated_totals(lengths_table: DataFrame, limits: list[int]) -> DataFrame:
    """Tokens left at any context limits, also those that are no document's length."""
    each = lengths_table.withColumn("limit", F.explode(F.array(*(F.lit(n).cast("long") for n in limits))))
    return each.groupBy("limit").agg(
        F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("tokens"),
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
    )


def quantile(lengths_table: DataFrame, q: float) -> int | None:
    """The shortest length that a share ``q`` of the documents does not exceed; null for an empty table."""
    total = F.max(F.col("docs_up_to") + F.col("docs_beyond"))
    n = lengths_table.agg(total.alias("n")).first().n
    if not n:
        return None
    return lengths_table.where(F.col("docs_up_to") >= q * n).agg(F.min("n_tokens").alias("n")).first().n
