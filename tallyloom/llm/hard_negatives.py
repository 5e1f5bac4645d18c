"""Hard negatives for anchors: rows of another label that score nearly as high as a positive.

Every vector is kept as rotated one-bit codes. Level by level, what is left of the vector is rotated, its signs are
the code, and the alignment of vector and code is stored with the length of the new rest. A query is rotated alike
and rounded to a few bit planes, so popcounts estimate its product with each code. The Cauchy-Schwarz inequality
bounds what the rests can add, so every score has an interval that surely holds it. Rows whose interval cannot reach
a result are left out, and the others are scored in integers. So results are exact.

The anchors are read in blocks of bounded size; each block is broadcast and meets all rows where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import fresh_folder, tracked, written

#: Larger components take no part: products of two such vectors would not fit a long.
LARGEST = 1 << 25
LONGEST = 4096
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_numbers(table: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """vec_id, label and vector in whole numbers of the rows that take part, each once."""
    numbers = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(LARGEST) / scale)))
    picked = table.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & sound)
    picked = picked.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), numbers.alias("vector"))
    lengths = picked.groupBy(F.size("vector").alias("length")).count().where(f"length between 1 and {LONGEST}")
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return picked.where(F.size("vector") == (most.length if most else 0)).dropDuplicates()


def rotations(length: int, levels: int, seed: int = 5) -> np.ndarray:
    """Random orthogonal matrices, one a level, over length rounded up to whole 64-bit words."""
    rng, size = np.random.default_rng(seed), -(-length // 64) * 64
    return np.stack([np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(levels)])


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.ascontiguousarray(np.packbits(bits, axis=-1)).view(np.uint64)


def encoded(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments and lengths of the rests (rows, levels)."""
    levels, size = turn.shape[:2]
    rest = np.zeros((len(vectors), size))
    rest[:, : vectors.shape[1]] = vectors
    codes, along, left = [], [], []
    for matrix in turn:
        turned = rest @ matrix.T
        sign = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(size)
        along.append((turned * sign).sum(axis=1))
        codes.append(packed(turned >= 0))
        rest = rest - (along[-1][:, None] * sign) @ matrix
        left.append(np.linalg.norm(rest, axis=1))
    return np.stack(codes, axis=1), np.stack(along, axis=1), np.stack(left, axis=1)


def indexed(rows: DataFrame, turn: np.ndarray) -> DataFrame:
    """The rows with their codes, alignments and rests."""
    shared = rows.sparkSession.sparkContext.broadcast(turn)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = matrix_of(batch.column(2), np.int64)
                codes, along, left = encoded(vectors, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, lists_of(codes.reshape(len(codes), -1).view(np.int64)), lists_of(along), lists_of(left)],
                    names=["vec_id", "label", "vector", "mark", "codes", "along", "left"],
                )

    marked = rows.select("vec_id", "label", "vector", F.xxhash64("label", "vector").alias("mark"))
    return marked.mapInArrow(made, "vec_id long, label long, vector array<long>, mark long, codes array<long>, along array<double>, left array<double>")


def matrix_of(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def lists_of(rows: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(rows).ravel()))


class Query:
    """One anchor, rotated and rounded to bit planes at each level."""

    def __init__(self, vector: np.ndarray, turn: np.ndarray, planes: int = 6):
        size, top = turn.shape[1], (1 << planes) - 1
        whole = np.zeros(size)
        whole[: len(vector)] = vector
        self.vector, self.size, self.length = vector, size, float(np.linalg.norm(whole))
        self.levels = []
        for matrix in turn:
            turned = matrix @ whole
            low, step = turned.min(), max((turned.max() - turned.min()) / top, 1e-300)
            steps = np.clip(np.rint((turned - low) / step), 0, top).astype(np.int64)
            error = float(np.linalg.norm(turned - (low + step * steps)))
            bits = [packed(((steps >> j) & 1).astype(bool)) for j in range(planes)]
            self.levels.append((low, step, error, bits, [int(np.bitwise_count(b).sum()) for b in bits]))

    def estimate(self, level: int, codes: np.ndarray) -> np.ndarray:
        """Product of the rounded query with each code (rows, words) of a level, from popcounts."""
        low, step, _, bits, ones = self.levels[level]
        total = low * (2.0 * np.bitwise_count(codes).sum(axis=1, dtype=np.int64) - self.size)
        for j, (plane, held) in enumerate(zip(bits, ones)):
            total += step * (1 << j) * (2.0 * np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) - held)
        return total / np.sqrt(self.size)

    def survivors(self, tile: Tile, rows: np.ndarray, possible) -> np.ndarray:
        """The rows of the tile for which possible(low, high) holds at every level, as intervals get narrower."""
        middle, spread = np.zeros(len(rows)), np.zeros(len(rows))
        for level, (_, _, error, _, _) in enumerate(self.levels):
            along = tile.along[rows, level]
            middle = middle + along * self.estimate(level, tile.codes[rows, level])
            spread = spread + along * error
            # the last term is for the rounding of doubles
            reach = spread + self.length * tile.left[rows, level] + 1e-6 + 1e-9 * self.length * (tile.left[rows, level] + along)
            keep = possible(middle - reach, middle + reach)
            rows, middle, spread = rows[keep], middle[keep], spread[keep]
            if not len(rows):
                break
        return rows

    def scores(self, tile: Tile, rows: np.ndarray) -> np.ndarray:
        return tile.vectors[rows] @ self.vector


class Tile:
    """Rows of the index as arrays, sorted by label."""

    def __init__(self, batch: pa.RecordBatch, levels: int):
        label = batch.column(1).to_numpy()
        order = np.argsort(label, kind="stable")
        self.label, self.ids, self.marks = label[order], batch.column(0).to_numpy()[order], batch.column(3).to_numpy()[order]
        self.vectors = matrix_of(batch.column(2), np.int64)[order]
        self.codes = matrix_of(batch.column(4), np.int64).view(np.uint64).reshape(len(order), levels, -1)[order]
        self.along, self.left = (matrix_of(batch.column(i), np.float64)[order] for i in (5, 6))

    def of(self, label: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the label, and the others."""
        a, b = np.searchsorted(self.label, [label, label + 1])
        return np.arange(a, b), np.concatenate([np.arange(a), np.arange(b, len(self.label))])


class Best:
    """The first few rows by score, then by id, then by content."""

    def __init__(self, most: int):
        self.most, self.rows = most, np.zeros((0, 3), dtype=np.int64)

    def least(self) -> float:
        """What a score must reach to come in."""
        return self.rows[-1, 0] if len(self.rows) == self.most else -np.inf

    def add(self, scores: np.ndarray, tile: Tile, rows: np.ndarray) -> None:
        both = np.concatenate([self.rows, np.stack([scores, tile.ids[rows], tile.marks[rows]], axis=1)])
        self.rows = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[: self.most]]


def nth_largest(values: np.ndarray, n: int) -> float:
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def tiles(batches: Iterator[pa.RecordBatch], levels: int, rows: int = 8192) -> Iterator[Tile]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield Tile(batch.slice(at, rows), levels)


def positives(index: DataFrame, block: dict[str, np.ndarray], turn: np.ndarray, most: int) -> DataFrame:
    """anchor (its place in the block), id, mark and score of the first rows of each anchor's label."""
    shared = index.sparkSession.sparkContext.broadcast((block, turn))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, turn = shared.value
        queries = [Query(v, turn) for v in block["vector"]]
        best = [Best(most) for _ in queries]
        for tile in tiles(batches, len(turn)):
            for query, kept, label, own, mark in zip(queries, best, block["label"], block["id"], block["mark"]):
                rows = tile.of(label)[0]
                rows = rows[(tile.ids[rows] != own) | (tile.marks[rows] != mark)]
                rows = query.survivors(tile, rows, lambda low, high: high >= max(kept.least(), nth_largest(low, most)))
                if len(rows):
                    kept.add(query.scores(tile, rows), tile, rows)
        yield from results(best, np.arange(len(best)))

    return first_of(index.mapInArrow(found, "place long, score long, id long, mark long"), most)


def negatives(index: DataFrame, block: dict[str, np.ndarray], wanted: np.ndarray, turn: np.ndarray, most: int, percent: int) -> DataFrame:
    """place (of a row of wanted: anchor's place, positive's score), id, mark and score of the first rows of another
    label with percent of the positive's score or more, and no more than that."""
    shared = index.sparkSession.sparkContext.broadcast((block, wanted, turn))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, wanted, turn = shared.value
        queries = [Query(v, turn) for v in block["vector"]]
        best = [Best(most) for _ in wanted]
        ends = np.searchsorted(wanted[:, 0], np.arange(len(queries) + 1))
        for tile in tiles(batches, len(turn)):
            for at, query in enumerate(queries):
                asked = range(ends[at], ends[at + 1])
                if not asked:
                    continue
                tops = [int(wanted[i, 1]) for i in asked]

                def possible(low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    useful = np.zeros(len(low), dtype=bool)
                    for i, top in zip(asked, tops):
                        floor = percent * top / 100
                        sure = nth_largest(low[(high <= top) & (low >= floor)], most)
                        useful |= (low <= top) & (high >= max(floor, best[i].least(), sure))
                    return useful

                rows = query.survivors(tile, tile.of(block["label"][at])[1], possible)
                scores = query.scores(tile, rows)
                for i, top in zip(asked, tops):
                    inside = (100 * scores <= 100 * top) & (100 * scores >= percent * top)
                    if inside.any():
                        best[i].add(scores[inside], tile, rows[inside])
        yield from results(best, np.arange(len(best)))

    return first_of(index.mapInArrow(found, "place long, score long, id long, mark long"), most)


def results(best: list[Best], places: np.ndarray) -> Iterator[pa.RecordBatch]:
    found = [x.rows for x in best]
    if found:
        flat = np.concatenate(found)
        columns = [np.repeat(places, [len(x) for x in found]), flat[:, 0], flat[:, 1], flat[:, 2]]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x), pa.int64()) for x in columns], names=["place", "score", "id", "mark"])


def first_of(found: DataFrame, most: int) -> DataFrame:
    """The first rows of each place from what the tasks have found, at most `most` from each."""
    order = Window.partitionBy("place").orderBy(F.desc("score"), "id", "mark")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    table: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    most_positives: int = 5,
    most_negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
    levels: int = 4,
    block: int = 2048,
) -> DataFrame:
    """anchor_id, positive_id (long), rank (int, from 1), negative_id, positive_score, negative_score (long).

    Components x become floor(scale * x), and a score is the product of two vectors in these. Anchors are the rows
    that pass the condition on vec_id. For each of an anchor's first most_positives other rows of its label, the first
    most_negatives rows of other labels whose score is percent to 100 percent of the positive's. Higher scores come
    first, ties go to the smaller vec_id.

    Rows with a null id, label, vector or component take no part, nor do those with NaN, infinity or components of
    2^25 / scale or more, those without components or with more than 4096, and those of another length than most rows
    have. Repeated rows count once; rows that share an id but not label or vector are rows of their own. An empty
    table, or one without anchors, gives no rows. Only the three named columns are read.

    Results are exact for any levels. block bounds the anchors that are broadcast, and brought to the driver, at once.
    """
    spark = table.sparkSession
    rows = written(whole_numbers(table, vec_id, vector, label, scale))
    one = rows.select(F.size("vector").alias("length")).first()
    if one is None:
        return spark.createDataFrame([], RESULT)
    turn = rotations(one.length, levels)
    index = written(indexed(rows, turn))
    chosen = index.where(anchors).select("vec_id", "label", "vector", "mark")
    blocks = -(-2 * chosen.count() // block)  # half full on average, as rows are dealt by hash
    dealt = written(chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "mark"), F.lit(max(1, blocks)))))
    path = fresh_folder(spark)
    spark.createDataFrame([], RESULT).write.parquet(path)
    for at in range(blocks):
        held = dealt.where(F.col("block") == at).orderBy("vec_id", "mark").toArrow()
        if not held.num_rows:
            continue
        own = {"id": held["vec_id"].to_numpy(), "label": held["label"].to_numpy(), "mark": held["mark"].to_numpy()}
        own["vector"] = matrix_of(held["vector"].combine_chunks(), np.int64)
        close = positives(index, own, turn, most_positives).orderBy("place", "rank").toArrow()
        wanted = np.stack([close["place"].to_numpy(), close["score"].to_numpy()], axis=1)
        far = negatives(index, own, wanted, turn, most_negatives, percent)
        pairs = pa.table({"place": np.arange(len(wanted)), "anchor_id": own["id"][wanted[:, 0]], "positive_id": close["id"], "positive_score": close["score"]})
        named = far.join(F.broadcast(spark.createDataFrame(pairs)), "place")
        named = named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        named.write.mode("append").parquet(path)
    return tracked(spark, path, RESULT)


def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The contract's columns: anchors are rows whose vec_id 100 divides; where 7 divides it, labels move on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


ORACLE_SQL = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
