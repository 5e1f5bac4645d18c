"""Benchmark decontamination by winnowing.

Of every run of consecutive k-grams the one with the least hash is a fingerprint, so any span of 13 words that a
document shares with a benchmark item holds a fingerprint of both. Fingerprints of the items fill a bitmap of
fixed size, which is broadcast; a document sends on only fingerprints that may be among them, each with the
hashes of the 13-word windows around it. A join on fingerprints and windows extends and confirms the hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import bitmap, in_bitmap, written
from tallyloom.llm.words import ALNUM, grams, texts, words

HITS = "array<struct<start:int,width:int,hash:bigint>>"
HIT_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("width", pa.int32()), ("hash", pa.int64())]))


def fingerprints(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the least grams of one text's runs of window - gram + 1 grams (rightmost on a tie)."""
    grams_here = grams(hashes, gram)
    run = window - gram + 1
    if len(grams_here) < run:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    views = np.lib.stride_tricks.sliding_window_view(grams_here, run)
    place = np.unique(np.arange(len(views)) + (run - 1 - views[:, ::-1].argmin(axis=1)))
    return place, grams_here[place]


def item_windows(items: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """item_id (text), width, window hash and fingerprint (null in items shorter than a window) of all windows."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys = batch.column(0).to_pylist()
            for first, end, data, starts in texts(batch.column(1)):
                hashes, before = words(data, starts, ALNUM)
                for i in range(end - first):
                    own = hashes[before[i] : before[i + 1]]
                    if not len(own):
                        continue
                    width = min(window, len(own))
                    spans = grams(own, width).astype(np.int64)
                    if width < window:
                        rows.append((keys[first + i], width, int(spans[0]), None))
                        continue
                    place, prints = fingerprints(own, window, gram)
                    for s, h in enumerate(spans):
                        inside = prints[(place >= s) & (place <= s + window - gram)].astype(np.int64)
                        rows.extend((keys[first + i], width, int(h), int(p)) for p in inside)
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "width", "hash", "print"])

    picked = items.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    return picked.mapInArrow(found, "item_id string, width int, hash long, print long").distinct()


def candidate_windows(docs: DataFrame, doc_id: str, text: str, prints: np.ndarray, short: dict[int, np.ndarray], window: int, gram: int) -> DataFrame:
    """doc_id, n_words and the windows that may be an item's: those around a fingerprint in the bitmap prints, and
    those as wide as a short item whose hash is in the bitmap of that width."""
    names = ["doc_id", "n_words", "windows"]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((prints, short))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, short = shared.value
        run = window - gram + 1
        for batch in batches:
            counts, ends, hits = [], [0], []
            for first, end, data, starts in texts(batch.column(1)):
                hashes, before = words(data, starts, ALNUM)
                rows = np.searchsorted(before, np.arange(len(hashes)), side="right") - 1
                last = before[1:][rows]  # where the row of each word ends
                starts_, widths_, values_ = [], [], []
                if len(hashes) >= gram:
                    all_grams = grams(hashes, gram)
                    here = np.arange(len(all_grams))
                    valid = here + gram <= last[: len(here)]
                    ranked = np.where(valid, all_grams, np.uint64(0xFFFFFFFFFFFFFFFF))
                    least = ranked.copy()
                    for i in range(1, run):  # least of the run that starts here
                        least[: len(here) - i] = np.minimum(least[: len(here) - i], ranked[i:])
                    spans = grams(hashes, window)
                    whole = np.arange(len(spans)) + window <= last[: len(spans)]
                    chosen = whole & in_bitmap(prints, least[: len(spans)])
                    at = np.flatnonzero(chosen)
                    starts_.append(at), widths_.append(np.full(len(at), window)), values_.append(spans[at])
                for width, members in short.items():
                    if len(hashes) >= width:
                        spans = grams(hashes, width)
                        at = np.flatnonzero((np.arange(len(spans)) + width <= last[: len(spans)]) & in_bitmap(members, spans))
                        starts_.append(at), widths_.append(np.full(len(at), width)), values_.append(spans[at])
                at = np.concatenate(starts_) if starts_ else np.zeros(0, dtype=np.int64)
                order = np.argsort(at, kind="stable")
                at = at[order]
                width = np.concatenate(widths_)[order] if starts_ else at
                value = np.concatenate(values_)[order] if starts_ else at.astype(np.uint64)
                per_row = np.searchsorted(at, before)
                counts.append(np.diff(before))
                ends.extend((ends[-1] + per_row[1:]).tolist())
                hits.append((at - before[:-1][rows[at]] if len(at) else at, width, value))
            flat = [np.concatenate(x) if hits else np.zeros(0) for x in zip(*hits)] or [np.zeros(0)] * 3
            values = pa.StructArray.from_arrays(
                [pa.array(flat[0].astype(np.int32)), pa.array(flat[1].astype(np.int32)), pa.array(flat[2].astype(np.uint64).view(np.int64))], fields=list(HIT_TYPE.value_type)
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            n_words = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), lists.cast(HIT_TYPE)], names=names)

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(found, f"doc_id long, n_words long, windows {HITS}")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    window: int = 13,
    gram: int = 8,
    bits: int = 22,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items (long), item_ids (sorted array of text), spans (array
    of first and end word of hit stretches), contaminated (boolean).

    A document is contaminated if words in windows of items are a twentieth of its words or more. Items shorter
    than a window count as one window of their own width. Null texts and texts without words have no window.
    Items that repeat an id count once; input rows are documents of their own, repeated rows and null keys
    included. bits sets the size of the broadcast bitmaps, which does not depend on the tables.
    """
    windows = written(item_windows(items, item_id, text, window, gram))
    prints = bitmap(windows.where(F.col("print").isNotNull()), "print", bits)
    widths = [row.width for row in windows.where(F.col("width") < window).select("width").distinct().collect()]
    short = {w: bitmap(windows.where(F.col("width") == w), "hash", bits - 4) for w in widths}
    found = written(
        candidate_windows(docs, doc_id, text, prints, short, window, gram).withColumn("row", F.monotonically_increasing_id())
    )
    one = windows.select("item_id", "width", "hash").distinct()
    places = found.select("row", F.explode("windows").alias("w")).select("row", "w.start", "w.width", "w.hash")
    # documents share few windows with items, but one window may be in very many documents: only its items meet them
    matched = places.join(one, ["width", "hash"]).select("row", "start", "width", "item_id")
    items_of = matched.select("row", "item_id").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    earlier = Window.partitionBy("row").orderBy("start", "width").rowsBetween(Window.unboundedPreceding, -1)
    distinct = matched.select("row", "start", (F.col("start") + F.col("width")).alias("end"), "width").distinct()
    reach = distinct.withColumn("reach", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    new = reach.withColumn("from", F.greatest("start", "reach")).where(F.col("end") > F.col("from"))
    spans = new.groupBy("row").agg(
        F.sum(F.col("end") - F.col("from")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("from", "end"))).alias("spans"),
    )
    hits = spans.join(items_of, "row")
    return (
        found.drop("windows")
        .join(hits, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("spans", F.array().cast("array<struct<from:int,end:int>>")).alias("spans"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def op9_winnowing(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns for documents against benchmark."""
    return decontaminate(docs.select("doc_id", "text"), items.select("item_id", "text")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
ig AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS width, w[i : i + least(len(w), 13) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM iw WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM ig),
dg AS (
  SELECT doc_id, i, width, w[i : i + width - 1] AS g
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM dw, widths WHERE len(w) >= width)),
hit AS (SELECT dg.doc_id, dg.i, dg.width, ig.item_id FROM dg JOIN ig ON dg.width = ig.width AND dg.g = ig.g),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
  coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= coalesce(len(w), 0) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
