"""Token counts by a two-tier lookup on the map side, without a shuffle of pre-tokens.

Tier one is a broadcast table of frequent pre-tokens and their lengths, of bounded size. Tier two are caches in
the Python workers: a chunk or pre-token that a worker has not met is encoded once and remembered.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tallyloom.llm.shared import commonest, sampled, written
from tallyloom.llm.tokens import PRE_TOKEN, ChunkEncoder, Memo, load, vocabulary


def frequent_pre_tokens(docs: DataFrame, text: str, path: str, sample_rows: int, entries: int) -> dict[str, int]:
    """Token counts of at most entries pre-tokens, the commonest of a sample of at most about sample_rows texts.

    The table only saves work: what it lacks is encoded. So the sample has no effect on any count.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern, seen = regex.compile(PRE_TOKEN), Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen.update(pattern.findall(value))
        rows = seen.most_common(entries)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["token", "n"])

    counts = written(
        sampled(docs.select(F.col(text).alias("text")).where(F.col("text").isNotNull()), sample_rows)
        .mapInArrow(counted, "token string, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )
    rows = commonest(counts, "n", entries).select("token").collect()
    tokenizer, _ = load(path)
    return {row.token: len(tokenizer.encode(row.token, add_special_tokens=False).ids) for row in rows}


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    vocabulary_name: str = "byte_bpe_50k.json",
    sample_rows: int = 4_000,
    entries: int = 32_768,
    cached: int = 400_000,
    keep_text: bool = True,
) -> DataFrame:
    """docs with n_bytes and n_tokens (long) of each whole text; columns of these names are replaced.

    Null and empty texts have 0 of both. Rows are counted one by one, so repeated rows and null keys need no
    care. entries bounds the broadcast table, cached the chunks that a worker remembers. Without keep_text the
    text column is left out of the result.
    """
    if text in ("n_bytes", "n_tokens"):
        raise ValueError(f"the text column {text!r} would be replaced")
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens")]
    schema = StructType([docs.schema[c] for c in kept if keep_text or c != text])
    schema = schema.add("n_bytes", LongType()).add("n_tokens", LongType())
    names = schema.names
    spark, place = docs.sparkSession, kept.index(text)
    frequent = spark.sparkContext.broadcast(frequent_pre_tokens(docs, text, vocabulary(vocabulary_name), sample_rows, entries))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        tokenizer, special = load(vocabulary(vocabulary_name))
        length = lambda part: len(tokenizer.encode(part, add_special_tokens=False).ids)
        table, pieces, rare = frequent.value, regex.compile(PRE_TOKEN).findall, Memo(length, cached // 4)

        def of_chunk(chunk: str) -> int:
            return sum(rare[piece] if (n := table.get(piece)) is None else n for piece in pieces(chunk))

        encoder = ChunkEncoder(of_chunk, length, special, cached)
        for batch in batches:
            texts = batch.column(place)
            sizes, counts = [], []
            for value in texts:
                value = value.as_py() or ""
                sizes.append(len(value.encode()))
                counts.append(sum(encoder.parts(value)))
            own = [c for i, c in enumerate(batch.columns) if i != place or keep_text]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=names)

    return docs.select(*kept).mapInArrow(counted, schema)


def op4_token_count(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents. Only key and size leave Python."""
    return count_tokens(docs.select("doc_id", "text"), keep_text=False).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))
