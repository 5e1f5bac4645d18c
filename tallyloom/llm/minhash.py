"""Near duplicates by an inverted join on signature coordinates.

Equal shingle sets are one class first, so copies cost one signature. Each class is posted under the
(coordinate, value) pairs of a prefix of its signature, rare pairs first: two classes that agree in at least
`least_matches` of `coordinates` places agree in one of the first coordinates - least_matches + 1. Pairs that only one
class holds meet nobody, and a class with fewer others than it needs to agree in is not posted at all. Merging
compares signatures of classes that met and skips those that agree too seldom; the rest are confirmed on full
shingle sets.

A family of near copies needs no look at all its pairs to become one component. So in several turns each posting
list compares its members with one leader, another in every turn, and lists whose members are all in one component
are done. Lists that still hold several components after that are looked through exhaustively, but only between
components. So no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.shared import bitmap, in_bitmap, map_bits, sweep, written
from tallyloom.llm.words import NOT_BLANK, grams, mix, texts, words

_SEEDS = np.random.default_rng(11)
_XOR = _SEEDS.integers(1, 1 << 63, 256, dtype=np.uint64)
_TIMES = _SEEDS.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_TURNS = tuple(int(x) for x in _SEEDS.integers(0, 1 << 62, 64))
SIGNED = "doc_id long, n_shingles long, set_id long, check long, signature array<int>"


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes. Fewer words than size are one shingle, no words none."""
    for first, end, data, starts in texts(column):
        hashes, before = words(data, starts, NOT_BLANK)
        whole = grams(hashes, size)
        for i in range(end - first):
            a, b = before[i], before[i + 1]
            if b - a >= size:
                yield first + i, np.unique(whole[a : b - size + 1])
            elif b > a:
                yield first + i, grams(hashes[a:b], b - a) + np.uint64(b - a)
            else:
                yield first + i, np.zeros(0, dtype=np.uint64)


def named(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set."""
    one, two = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ _XOR[0]).sum(dtype=np.uint64)
    return int(np.int64(one.astype(np.int64))), int(np.int64(two.astype(np.int64)))


def signature(shingles: np.ndarray, coordinates: int, section: int = 16_384) -> np.ndarray:
    """The least value of the set under each of the coordinates' orders, 32 bits each."""
    low = np.full(coordinates, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(shingles), section):
        part = shingles[at : at + section]
        for k in range(coordinates):
            low[k] = min(low[k], ((part ^ _XOR[k]) * _TIMES[k]).min())
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signed(docs: DataFrame, doc_id: str, text: str, size: int, coordinates: int) -> DataFrame:
    """Set size, name and signature of each document."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ones, twos, marks = [], [], [], []
            for _, shingles in shingle_sets(batch.column(1), size):
                one, two = named(shingles)
                sizes.append(len(shingles)), ones.append(one), twos.append(two)
                marks.append(signature(shingles, coordinates))
            flat = np.concatenate(marks) if marks else np.zeros(0, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(range(0, len(flat) + 1, coordinates), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, ones, twos)), lists], names=[x.split()[0] for x in SIGNED.split(", ")]
            )

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(found, SIGNED)


def posted(classes: DataFrame, prefix: int, least_matches: int, levels: tuple[int, ...] = (1, 4, 32, 256, 2048)) -> DataFrame:
    """id, n and post (coordinate and value in one number) of the prefix of each class's signature.

    All classes order their posts alike: rare ones first, then by coordinate. Posts held by many classes, such as those
    of a line that very many texts share, come last, so they are in a prefix only where a text has hardly anything
    else. Bitmaps tell the levels; a wrong bit changes the order for all classes alike. Posts of the prefix that one
    class alone holds are left out, and so are all of a class that has fewer than least_matches others.
    """
    post = F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    held = classes.select(F.posexplode("signature").alias("k", "v")).groupBy(post.alias("post")).agg(F.count("*").alias("n"))
    spread = F.col("post").bitwiseXOR(F.shiftright("post", 17))
    common = written(held.where(F.col("n") > levels[0]).select("n", spread.alias("spread")))
    sizes = common.agg(*(F.count_if(F.col("n") > x) for x in levels)).first()
    maps = [bitmap(common.where(F.col("n") > x), "spread", map_bits(n)) for x, n in zip(levels, sizes)]
    shared = classes.sparkSession.sparkContext.broadcast(maps)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack(batch.column(2).to_numpy(zero_copy_only=False)).astype(np.int64) & 0xFFFFFFFF
            posts = marks | (np.arange(marks.shape[1], dtype=np.int64) << 32)
            level = sum(in_bitmap(x, (posts ^ (posts >> 17)).view(np.uint64).ravel()).astype(np.int64) for x in shared.value)
            level = level.reshape(posts.shape)
            first = np.argsort(level, axis=1, kind="stable")[:, :prefix]
            useful = np.take_along_axis(level, first, axis=1) > 0
            useful &= ((level > 0).sum(axis=1) >= least_matches)[:, None]
            row = pa.array(np.nonzero(useful)[0])
            flat = np.take_along_axis(posts, first, axis=1)[useful]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(flat)], names=["id", "n", "post"])

    return classes.select("id", "n", "signature").mapInArrow(chosen, "id long, n long, post long")


def sets_of(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """id and full shingle set of the classes in wanted (id, set_id, check).

    A bitmap keeps most other sets from being sent; the join leaves out the rest of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "set_id", map_bits(wanted.count())))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            names, sets, held = [], [], 0
            for _, shingles in shingle_sets(batch.column(0), size):
                if not len(shingles):
                    continue
                name = named(shingles)
                if name not in seen and in_bitmap(shared.value, np.array(name[:1], dtype=np.int64).view(np.uint64))[0]:
                    names.append(name), sets.append(shingles.view(np.int64))
                    held += len(shingles)
                    if len(seen) < 200_000:
                        seen.add(name)
                if held > 500_000:
                    yield out(names, sets)
                    names, sets, held = [], [], 0
            if sets:
                yield out(names, sets)

    def out(names: list, sets: list) -> pa.RecordBatch:
        one, two = (pa.array([x[i] for x in names], pa.int64()) for i in (0, 1))
        ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
        return pa.RecordBatch.from_arrays([one, two, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))], names=["set_id", "check", "shingles"])

    each = docs.select(F.col(text).alias("text")).mapInArrow(found, "set_id long, check long, shingles array<long>")
    return each.dropDuplicates(["set_id", "check"]).join(wanted, ["set_id", "check"]).select("id", "shingles")


def close(a: Column, b: Column, percent: int) -> Column:
    """Whether two set sizes allow the similarity at all."""
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def merged(pairs: DataFrame, classes: DataFrame, least_matches: int) -> DataFrame:
    """The pairs a, b whose signatures agree in least_matches places or more, by seven bits of each place.

    Seven bits agree wherever all 32 do, so no pair is lost, and a pair takes a quarter of the room.
    """
    low = F.transform("signature", lambda x: x.bitwiseAND(F.lit(127)).cast("tinyint"))
    marks = classes.select("id", low.alias("signature"))
    both = pairs.join(marks.withColumnsRenamed({"id": "a", "signature": "sa"}), "a")
    both = both.join(marks.withColumnsRenamed({"id": "b", "signature": "sb"}), "b")
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    return both.where(agree >= least_matches).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets have the similarity."""
    both = pairs.join(sets.withColumnsRenamed({"id": "b", "shingles": "xb"}), "b")
    both = both.join(sets.withColumnsRenamed({"id": "a", "shingles": "xa"}), "a")
    shared = F.size(F.array_intersect("xa", "xb"))
    return both.where(F.lit(100) * shared >= F.lit(percent) * (F.size("xa") + F.size("xb") - shared)).select("a", "b")


SKETCH = tuple(f"bits{i}" for i in range(16))


def sketched(sets: DataFrame) -> DataFrame:
    """id, how many of its shingles other sets of the table have too, and the set bits of these by a hash of ten bits.

    Two sets have no more in common than either shares with any, less one for each bit that the other lacks.
    """
    each = sets.select("id", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count("*").alias("held"), F.min("id").alias("id")).where("held = 1")
    alone = alone.groupBy("id").agg(F.collect_list("shingle").alias("alone"))
    rest = F.when(F.col("alone").isNull(), F.col("shingles")).otherwise(F.array_except("shingles", "alone"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, rows = [], []
            for x in batch.column(1):
                own = x.values.to_numpy(zero_copy_only=False).view(np.uint64)
                bits = np.zeros(64 * len(SKETCH), dtype=bool)
                bits[mix(own ^ _XOR[1]) % np.uint64(len(bits))] = True
                sizes.append(len(own)), rows.append(np.packbits(bits).view(np.int64))
            words = np.array(rows, dtype=np.int64).reshape(len(rows), len(SKETCH))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), *(pa.array(np.ascontiguousarray(w)) for w in words.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "shared", *SKETCH])

    return sets.join(alone, "id", "left").select("id", rest.alias("rest")).mapInArrow(found, "id long, shared long, " + ", ".join(f"{x} long" for x in SKETCH))


def most_common(a: str, b: str) -> Column:
    """A bound of the shingles that two sketched sets have in common; a and b end the names of their columns."""
    less = lambda x, y: F.col(f"shared_{x}") - reduce(Column.__add__, (F.bit_count(F.col(f"{c}_{x}").bitwiseAND(F.bitwise_not(f"{c}_{y}"))) for c in SKETCH))
    return F.least(less(a, b), less(b, a))


def rerooted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (id, root) after links a, b between ids: only roots that links join are looked at."""
    of = lambda side: roots.withColumnsRenamed({"id": side, "root": f"root_{side}"})
    ends = links.join(of("a"), "a").join(of("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b").distinct()
    moved = components(ends).select(F.col("node").alias("root"), F.col("root").alias("further"))
    return written(roots.join(moved, "root", "left").select("id", F.coalesce("further", "root").alias("root")))


def linked(listed: DataFrame, classes: DataFrame, sets: DataFrame, least_matches: int, percent: int, turns: int) -> DataFrame:
    """id and root (least id of its component) of all ids in posting lists (post, id, n).

    In a turn each list that holds several components compares the members outside its leader's component with the
    leader, the least id after some bits are turned over, others each time. A turn that links fewer than one pair in
    forty that passed the merge is the last. Then members of different components meet in the lists that are left, if
    the shingles that each shares with any of these members are enough for the similarity; see sketched.
    """
    spark = listed.sparkSession
    roots = written(listed.select("id").distinct().withColumn("root", F.col("id")))
    alive, tested = listed, None
    for turned in (0, *_TURNS)[:turns]:
        rooted = written(alive.join(roots, "id").select("post", "id", "n", "root"))
        leader = F.min(F.col("id").bitwiseXOR(F.lit(turned))).bitwiseXOR(F.lit(turned))
        lists = rooted.groupBy("post").agg(leader.alias("leader"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        lists = written(lists.join(roots.withColumnsRenamed({"id": "leader", "root": "leader_root"}), "leader").select("post", "leader", "leader_root"))
        if lists.isEmpty():
            return roots
        alive = written(rooted.join(lists, "post"))
        met = alive.where("root <> leader_root").groupBy("leader", "id").agg(F.min("n").alias("n"))
        met = met.join(classes.select(F.col("id").alias("leader"), F.col("n").alias("leader_n")), "leader").where(close(F.col("n"), F.col("leader_n"), percent))
        pairs = met.select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b")).distinct()
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(merged(pairs, classes, least_matches))
        links = written(confirmed(pairs, sets, percent))
        tested = pairs if tested is None else tested.unionByName(pairs)
        alive = alive.select("post", "id", "n")
        found = links.count()
        if found:
            roots = rerooted(roots, links)
        sweep(spark, collect=True)
        if 40 * found < pairs.count():
            break
    rooted = alive.join(roots, "id").select("post", "id", "n", "root")
    several = rooted.groupBy("post").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("post")
    rooted = written(rooted.join(several, "post"))
    posts = rooted.groupBy("id").agg(F.collect_list("post").alias("posts"))
    rooted = written(rooted.join(sketched(sets.join(posts, "id", "left_semi")).join(posts, "id"), "id"))
    one, two = (rooted.select("post", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "root", "posts", "shared", *SKETCH))) for side in "ab")
    needed = F.lit(percent) * (F.col("n_a") + F.col("n_b"))
    enough = (F.lit(100 + percent) * F.least("shared_a", "shared_b") >= needed) & (F.lit(100 + percent) * most_common("a", "b") >= needed)
    first = F.array_min(F.array_intersect("posts_a", "posts_b")) == F.col("post")  # of the lists that hold both
    met = one.join(two, "post").where((F.col("root_a") < F.col("root_b")) & enough & first)
    pairs = met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
    pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
    links = written(confirmed(written(merged(pairs, classes, least_matches)), sets, percent))
    return roots if links.isEmpty() else rerooted(roots, links)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 75,
    coordinates: int = 48,
    least_matches: int = 19,
    turns: int = 2,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, set_id, component_id (long), kept, first (boolean).

    Documents are linked if their sets of size-word shingles have percent or more of their union in common.
    component_id is the least doc_id that links reach; documents without words are linked with nothing. kept means
    doc_id = component_id; first is true for exactly one row of each component, even where rows repeat. A null
    doc_id never gives the component its name while another has one.

    Null and empty texts have no words and an empty set. An empty table gives no rows; repeated rows are linked with
    each other; only the two named columns are read, so others may have any name. A text is handled as a whole within
    one task.

    At a similarity of 0.75, 36 of 48 coordinates agree on average; fewer than 19 do in one pair of ten million.
    Shingles are 64-bit hashes, and 128 bits name a set; set_id has half of them.
    """
    spark = docs.sparkSession
    table = written(signed(docs, doc_id, text, size, coordinates).withColumn("row", F.monotonically_increasing_id()))
    classes = table.where("n_shingles > 0").groupBy("set_id", "check").agg(F.min("n_shingles").alias("n"), F.first("signature").alias("signature"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()))
    sweep(spark, collect=True)
    posts = written(posted(classes, coordinates - least_matches + 1, least_matches))
    several = written(posts.groupBy("post").agg(F.count("*").alias("members")).where("members > 1").select("post"))
    listed = written(posts.join(several, "post").select("post", "id", "n"))
    members = listed.select("id").distinct()
    sets = written(sets_of(docs, text, size, written(classes.join(members, "id", "left_semi").select("id", "set_id", "check"))))
    del posts, several, members
    sweep(spark, collect=True)
    roots = linked(listed, classes, sets, least_matches, percent, turns)

    groups = written(classes.select("id", "set_id", "check").join(roots, "id", "left").select("set_id", "check", F.coalesce("root", "id").alias("group")))
    del listed, sets, roots, classes
    # documents without words are groups of their own, numbered from below zero
    rows = table.drop("signature").join(groups, ["set_id", "check"], "left")
    rows = written(rows.withColumn("group", F.when(F.col("n_shingles") == 0, -1 - F.col("row")).otherwise(F.col("group"))))
    name = F.min("doc_id").alias("component_id")
    heads = rows.groupBy("group").agg(name, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head"))
    heads = written(heads.select("group", "component_id", F.col("head.row").alias("head")))
    sweep(spark, collect=True)
    return rows.join(heads, "group").select(
        "doc_id",
        "n_shingles",
        "set_id",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        (F.col("row") == F.col("head")).alias("first"),
    )


def op2_minhash(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i : i + 4] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
reached AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
SELECT doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""
