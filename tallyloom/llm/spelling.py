"""Spelling variants: words one edit apart, and the commoner form that each of them leads to.

Letters are hashed to a few symbols. Two words one edit apart have reduced words that are equal or one edit apart,
so the neighbourhood of every reduced word is generated and joined with the reduced vocabulary; what meets is
verified on the words themselves. Each pair is generated from one side only: a deletion from the longer word stands
for the insertion into the shorter one, and a replacement by a higher symbol for the one by a lower symbol.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written
from tallyloom.llm.words import mix

RUN = "a-zÀ-ÿ"
_OUTSIDE = re.compile(f"[^{RUN}]")
_SPREAD = 0x9E3779B97F4A7C15
_PLACE = np.uint64(_SPREAD)
SECTION = 1 << 20


def sections(text: str, size: int = SECTION) -> Iterator[str]:
    """The text in parts of about size code points that end where a run ends."""
    at = 0
    while len(text) - at > size:
        end = _OUTSIDE.search(text, at + size)
        end = end.start() if end else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def counted_words(docs: DataFrame, doc_id: str, text: str, least_points: int, every: int, entries: int = 300_000) -> DataFrame:
    """word and n of all texts; one row per word and task, or more where a task meets more than entries words."""
    runs = re.compile(f"[{RUN}]{{{least_points},}}")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not data.is_valid:
                    continue
                start = zlib.crc32(b"" if key is None else str(key).encode())
                start = zlib.crc32(b":", start)
                lowered = data.as_buffer().to_pybytes().lower().decode()  # bytes have A-Z lower-cased only
                for part in sections(lowered):
                    for run, n in Counter(runs.findall(part)).items():
                        h = zlib.crc32(run.encode(), start)
                        if h % every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least_points:
                                continue
                        total[run] += n
                if len(total) > entries:
                    yield out(total)
                    total = Counter()
        yield out(total)

    def out(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(found, "word string, n long")


def symbols_of(words: list[str], symbols: int) -> np.ndarray:
    """Symbols of words of one length, a row each."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)
    return (mix(points.astype(np.uint64)) % np.uint64(symbols)).astype(np.int64)


def _named(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + np.uint64(length * _SPREAD % (1 << 64))).view(np.int64)


def neighbourhood(words: list[str], symbols: int, own_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of one length: row of the word, key of a reduced word, and whether it is the word's own.

    With own_only just that. Else also the keys with one symbol left out, each once, and with one symbol replaced by
    a higher one.
    """
    marks = symbols_of(words, symbols)
    n, length = marks.shape
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(length - 1, _PLACE)]))
    value = (marks + 1).astype(np.uint64)
    terms = value * power
    total = terms.sum(axis=1, dtype=np.uint64)
    rows, keys = [np.arange(n)], [_named(total, length)]
    if not own_only:
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        moved = value[:, 1:] * power[:-1]
        after = np.zeros_like(terms)
        after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        fresh = np.ones((n, length), dtype=bool)
        fresh[:, 1:] = marks[:, 1:] != marks[:, :-1]  # leaving out either of two equal neighbours is the same
        rows.append(np.nonzero(fresh)[0])
        keys.append(_named((before + after)[fresh], length - 1))
        for up in range(1, symbols):
            can = marks + up < symbols
            rows.append(np.nonzero(can)[0])
            keys.append(_named((total[:, None] + np.uint64(up) * power)[can], length))
    own = np.arange(sum(map(len, rows))) < n
    return np.concatenate(rows), np.concatenate(keys), own


def keyed(vocabulary: DataFrame, symbols: int, own_only: bool) -> DataFrame:
    """word and n of the vocabulary under each key of its neighbourhood."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            lengths = np.array([len(w) for w in words], dtype=np.int64)
            for length in np.unique(lengths):
                picked = np.flatnonzero(lengths == length)
                step = max(1, 500_000 // int(length * symbols))
                for at in range(0, len(picked), step):
                    part = picked[at : at + step]
                    rows, keys, own = neighbourhood([words[i] for i in part], symbols, own_only)
                    places = pa.array(part[rows])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array(own), batch.column(0).take(places), batch.column(1).take(places)], names=["key", "own", "word", "n"]
                    )

    return vocabulary.select("word", "n").mapInArrow(made, "key long, own boolean, word string, n long")


def near_pairs(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """a, na, b, nb: all pairs of words that differ by one inserted, deleted or replaced code point, each once."""
    left = keyed(vocabulary, symbols, own_only=False).withColumnsRenamed({"word": "a", "n": "na"})
    right = keyed(vocabulary, symbols, own_only=True).drop("own").withColumnsRenamed({"word": "b", "n": "nb"})
    once = ~F.col("own") | (F.col("a") < F.col("b"))
    return left.join(right.hint("merge"), "key").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb")


def roots(forms: DataFrame) -> DataFrame:
    """word and root for all words that have a form, by joining the table with itself until nothing moves.

    A form is at least twice as common as its word, so there are no circles, and a chain has fewer than 64 words:
    each round doubles the steps that a word has gone.
    """
    up = written(forms.select("word", F.col("form").alias("root")))
    while True:
        on = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(up.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        up = step.select("word", "root")
        if step.where("moved").isEmpty():
            return up


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_points: int = 5, least_count: int = 3, times: int = 2, every: int = 97, symbols: int = 8
) -> DataFrame:
    """One row per word: word, form, root (string), n, n_near, form_n (long).

    Runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, are words; where every divides the crc32 of
    "doc_id:run", the code point at crc32 % length is left out first (a null doc_id is written as nothing). Words of
    least_points code points that come least_count times in all are kept. form is the commonest word one edit away,
    ties going to the first in code-point order, if it comes times as often as the word or more; else form and form_n
    are null. root is where forms lead in the end, the word itself if it has none.

    Null and empty texts hold no words, repeated rows count as often as they come, an empty table gives no rows, and
    long texts are read in sections. Only the two named columns are read, so others may have any name. symbols
    decides how many candidates are verified, not the result.
    """
    counts = counted_words(docs, doc_id, text, least_points, every)
    vocabulary = written(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))
    pairs = written(near_pairs(vocabulary, symbols))
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form")))
    near = pairs.select(F.inline(ways)).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= F.lit(times) * F.col("n")
    words = written(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")
        )
    )
    ends = roots(words.where("form is not null"))
    return words.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    return spelling_variants(docs)


#: crc32 is taken byte by byte: the table holds what each of the 256 bytes does to the remainder.
ORACLE_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT byte, 0 AS bit, CAST(byte AS BIGINT) AS c FROM (SELECT unnest(range(256)) AS byte)
  UNION ALL
  SELECT byte, bit + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE bit < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE bit = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, CAST(length(x) AS BIGINT), 2),
      lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[CAST((xor(a, b) & 255) + 1 AS BIGINT)]))) AS h
  FROM bytes, crc),
counts AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM counts)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN counts b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN counts b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM near GROUP BY word),
words AS (
  SELECT counts.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM counts LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM words
  UNION ALL
  SELECT chain.word, words.form FROM chain JOIN words ON chain.at = words.word WHERE words.form IS NOT NULL)
SELECT words.word, form, chain.at AS root, n, n_near, form_n
FROM words JOIN chain ON chain.word = words.word
WHERE chain.at IN (SELECT word FROM words WHERE form IS NULL)
"""
