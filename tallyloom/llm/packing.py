"""Packing documents into training sequences as a cutting-stock problem solved by column generation.

Documents become token ids in one Arrow pass, are cut into full sequences, and leave one rest each. Lengths are
rounded up to units, and only the histogram of rests, at most one number per class, reaches the driver. There a
linear program over patterns (which classes share a sequence) is solved by column generation; a knapsack over
the dual prices finds the next pattern. Rounded patterns become a table of bounded size, and each rest finds its
sequence from its rank among the rests of its class.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import written
from tallyloom.llm.tokens import id_encoder, vocabulary

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, units int, rank long"


def cut(docs: DataFrame, doc_id: str, text: str, size: int, unit: int, vocabulary_name: str, end_id: int) -> DataFrame:
    """The pieces of every document: full ones of size ids, then the rest.

    units is the length in units, rounded up. part is the number of the task and rank counts that task's pieces
    of one class, so that (part, units, rank) names a piece. Both are settled once the table is written.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids = id_encoder(vocabulary(vocabulary_name))
        end, part = np.array([end_id], dtype="<u4").tobytes(), TaskContext.get().partitionId()
        next_rank = [0] * (size // unit + 1)
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = ids(value.as_py() or "") + end
                total = len(whole) // 4
                for start in range(0, total, size):
                    length = min(size, total - start)
                    crc = zlib.crc32(whole[4 * start : 4 * (start + length)])
                    units = -(-length // unit)
                    rows.append((key, start, length, crc, total, part, units, next_rank[units]))
                    next_rank[units] += 1
            columns = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, PIECES)


def best_pattern(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of the highest price that fits into size."""
    value, choice = np.zeros(size + 1), np.full(size + 1, -1)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for room in range(1, size + 1):
        value[room], choice[room] = value[room - 1], -1
        if n := fits[room]:
            gain = value[room - lengths[:n]] + prices[:n]
            best = int(gain.argmax())
            if gain[best] > value[room] + 1e-12:
                value[room], choice[room] = gain[best], best
    pattern, room = np.zeros(len(lengths), dtype=np.int64), size
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= lengths[choice[room]]
    return float(value[size]), pattern


def solve(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float, most_steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Basis patterns (one per row) and how often each is used, by the revised simplex method.

    It starts from patterns of one length and stops when the bound from the prices shows that no more than the
    share gap of sequences can be saved, or after most_steps; every step is a whole solution.
    """
    n = len(lengths)
    patterns = np.diag(size // lengths).astype(np.int64)
    inverse = np.diag(1.0 / (size // lengths))
    amount = demand / (size // lengths)
    for _ in range(most_steps):
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(lengths, np.maximum(prices, 0), size)
        if worth <= 1 + gap:
            break
        direction = (inverse * pattern).sum(axis=1)
        steps = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(steps.argmin())
        patterns[out] = pattern
        amount = amount - steps[out] * direction
        amount[out] = steps[out]
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
    return patterns, np.maximum(amount, 0)


def rounded(lengths: np.ndarray, demand: np.ndarray, patterns: np.ndarray, amount: np.ndarray, size: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of patterns that hold each rest exactly once: rounded down, then best fit for what is left.

    What is left has at most as many sequences as there are lengths, whatever the input.
    """
    times = np.floor(amount + 1e-6).astype(np.int64)
    over = np.flatnonzero(times)
    left = demand - patterns.T @ times
    while (left < 0).any():
        length = int(np.flatnonzero(left < 0)[0])
        user = max((i for i in over if patterns[i, length] and times[i]), key=lambda i: patterns[i, length])
        times[user] -= 1
        left = left + patterns[user]
    plan = [(patterns[i], int(times[i])) for i in over if times[i]]
    while left.any():
        room, pattern = size, np.zeros(len(lengths), dtype=np.int64)
        for i in range(len(lengths) - 1, -1, -1):
            fit = min(int(left[i]), room // int(lengths[i]))
            pattern[i], room = fit, room - fit * int(lengths[i])
        times_now = int(min(left[i] // pattern[i] for i in np.flatnonzero(pattern)))
        left = left - times_now * pattern
        plan.append((pattern, times_now))
    return plan


def slots(histogram: dict[int, int], size: int, gap: float = 0.003, most_steps: int = 3_000) -> list[tuple]:
    """For each use of a class by a pattern: units, first and last rank, uses per sequence, first sequence, slot.

    size is that of a sequence in units, and pieces of just that size are sequences of their own.
    """
    rows, plan, first_sequence, ranks = [], [], 0, dict.fromkeys(histogram, 0)
    if full := histogram.get(size, 0):
        plan.append(({size: 1}, full))
    lengths = np.array(sorted(x for x, n in histogram.items() if x < size and n), dtype=np.int64)
    if len(lengths):
        demand = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
        patterns, amount = solve(lengths, demand, size, gap, most_steps)
        plan += [({int(lengths[i]): int(p[i]) for i in np.flatnonzero(p)}, n) for p, n in rounded(lengths, demand, patterns, amount, size)]
    for pattern, times in plan:
        slot = 0
        for units, uses in sorted(pattern.items(), reverse=True):
            rows.append((units, ranks[units], ranks[units] + uses * times - 1, uses, first_sequence, slot))
            ranks[units] += uses * times
            slot += uses
        first_sequence += times
    return rows


SLOTS = "units int, first_rank long, last_rank long, uses long, first_sequence long, first_slot long"


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    unit: int = 8,
    vocabulary_name: str = "byte_bpe_50k.json",
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (all long).

    Every document ends with end_id, so null and empty texts are pieces of one id. Sequence numbers and, within a
    sequence, offsets run from 0 without gaps. Each input row is a document of its own, repeated rows and null
    keys included; extra columns are not carried. No rows give no pieces. size is a multiple of unit.
    """
    if size % unit:
        raise ValueError("size must be a multiple of unit")
    spark = docs.sparkSession
    pieces = written(cut(docs, doc_id, text, size, unit, vocabulary_name, end_id))
    by_task = pieces.groupBy("part", "units").agg(F.count("*").alias("n"))
    histogram = {row.units: row.n for row in by_task.groupBy("units").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first_ranks = by_task.select("part", "units", F.coalesce(before, F.lit(0)).alias("before"))
    table = F.broadcast(spark.createDataFrame(slots(histogram, size // unit), SLOTS).withColumnRenamed("units", "of_units"))
    ranked = pieces.join(first_ranks, ["part", "units"]).withColumn("rank", F.col("rank") + F.col("before"))
    within = (F.col("units") == F.col("of_units")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))
    place = F.col("rank") - F.col("first_rank")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.join(table, within)
        .withColumn("sequence_id", (F.col("first_sequence") + F.floor(place / F.col("uses"))).cast("long"))
        .withColumn("slot", F.col("first_slot") + place % F.col("uses"))
        .withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )


def op7_packing(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    return pack(docs)
