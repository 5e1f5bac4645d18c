"""Removal of bytes in strings of 400 bytes or more that start twice or more, within or across documents.

Every window of `length` units (bytes, or words) has a minimiser, the leftmost least hash of its grams; equal windows
have the same one at the same place. Neighbouring windows with one minimiser form a run. Runs of equal content settle
all their windows at once. Only where a minimiser has runs of differing content, at the edges of repeated passages, are
windows compared: first the cores that bands of them share, then single windows of bands whose cores meet. Counts are
exact joins and sums; bitmaps only narrow what is sent to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import bitmap, in_bitmap, map_bits, sweep, written
from tallyloom.llm.words import NOT_BLANK, mix, texts, word_places, words

_RANDOM = np.random.default_rng(77)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
BLOCK = 1 << 16


class Units(NamedTuple):
    """What windows are counted in: bytes, or words between blanks; and the units of a window and of a gram."""

    kind: str
    length: int
    gram: int

    @property
    def band(self) -> int:
        """Windows so near to each other share a core of length - band + 1 units."""
        return max(1, self.length // 8)


class Runs(NamedTuple):
    """The runs of some texts, each with its text's number in the block. Places are units of all texts together."""

    text: np.ndarray
    minimiser: np.ndarray
    content: np.ndarray
    first: np.ndarray
    count: np.ndarray
    place: np.ndarray


def spans(base: np.ndarray, width: int, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size the hash of the string of that size at every place, from mixed hashes of strings of width units.

    Hashes of 2, 4, ... times that width are built from each other; two that overlap make up a size.
    """
    out: list[np.ndarray] = [base[:0]] * len(sizes)
    power, level = base, 0
    while len(power):
        for k, size in enumerate(sizes):
            if width == size:
                out[k] = power
            elif width < size < 2 * width:
                out[k] = _combined(power[: len(power) - min(len(power), size - width)], power[size - width :], 32 + level)
        if 2 * width > max(sizes):
            break
        power = _combined(power[:-width], power[width:], level)
        width, level = 2 * width, level + 1
    return out


def _combined(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    x = right * _STEP[level]
    x += left
    x ^= x >> np.uint64(32)
    return x


def least_left(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every run of width values, by least values of blocks from both ends.

    The upper 33 bits are compared, and the place in the lower 31 settles ties, so equal windows agree.
    """
    n = len(values) - width + 1
    padded = -(-len(values) // width) * width
    whole = np.full(padded, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    whole[: len(values)] = ((values >> np.uint64(31)) << np.uint64(31)) | np.arange(len(values), dtype=np.uint64)
    blocks = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    return (low & np.uint64((1 << 31) - 1)).astype(np.int64)


class Block:
    """Some texts of a batch, read at once: hashes of windows and cores at every unit, and all runs."""

    def __init__(self, units: Units, first: int, end: int, data: np.ndarray, starts: np.ndarray):
        self.units, self.rows, self.data, self.starts = units, range(first, end), data, starts
        if units.kind == "bytes":
            held = np.zeros(len(data) + 8, dtype=np.uint8)
            held[: len(data)] = data
            wide = min(units.gram, units.length - units.band + 1) >= 8
            base = mix(np.ndarray(len(data), "<u8", held, strides=(1,)) if wide else _BYTE[data])
            width, at, self.begin = (8 if wide else 1), starts, None
        else:
            base, at = words(data, starts, NOT_BLANK, _BYTE)
            self.begin, self.finish = word_places(data, starts)
            width = 1
        length = units.length
        grams, self.windows, self.cores = spans(base, width, (units.gram, length, length - units.band + 1))
        none = np.zeros(0, dtype=np.int64)
        self.runs = Runs(none, none.astype(np.uint64), none.astype(np.uint64), none, none, none)
        sizes = np.maximum(0, np.diff(at) - length + 1)
        if not sizes.sum():
            return
        windows, grams = self.windows, grams[: len(base) - units.gram + 1]
        valid = np.repeat(at[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        place = least_left(grams, length - units.gram + 1)[valid]
        new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        first, place, count = valid[new], place[new], np.diff(np.append(new, len(place)))
        # all windows of a run hold its minimiser, so its first and last window overlap and fix its content
        content = mix(windows[first] * _STEP[1] + windows[first + count - 1] * _STEP[2] + count.astype(np.uint64) * _STEP[3])
        content = mix(content + (place - first).astype(np.uint64) * _STEP[4])
        self.runs = Runs(np.searchsorted(at, first, side="right") - 1, grams[place], content, first, count, place)

    def text(self, i: int) -> np.ndarray:
        return self.data[self.starts[i] : self.starts[i + 1]]

    def begins(self, window: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Where windows of texts begin in them, in bytes."""
        return (window if self.begin is None else self.begin[window]) - self.starts[text]

    def ends(self, window: np.ndarray, text: np.ndarray) -> np.ndarray:
        return (window + self.units.length if self.begin is None else self.finish[window + self.units.length - 1]) - self.starts[text]


def _blocks(column: pa.Array, units: Units) -> Iterator[Block]:
    for first, end, data, starts in texts(column, BLOCK):
        yield Block(units, first, end, data, starts)


def _longs(x) -> pa.Array:
    x = np.asarray(x)
    return pa.array(x.astype(np.uint64).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _name(doc_key: int | None, data: np.ndarray) -> int:
    held = hashlib.blake2b(data.tobytes(), digest_size=8, salt=str(doc_key)[:16].encode())
    return int.from_bytes(held.digest(), "little", signed=True)


RUN = "array<struct<minimiser:bigint,content:bigint,start:int,end:int>>"


def survey(docs: DataFrame, units: Units) -> DataFrame:
    """Of each document its name (a hash of key and text), size, digest and runs."""
    kind = pa.list_(pa.struct([("minimiser", pa.int64()), ("content", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names, sizes, digests, ends, parts = batch.column(0).to_pylist(), [], [], [], [np.zeros(1, dtype=np.int64)], []
            for block in _blocks(batch.column(1), units):
                for i, row in enumerate(block.rows):
                    data = block.text(i)
                    names.append(_name(keys[row], data)), sizes.append(len(data)), digests.append(hashlib.sha256(data).hexdigest())
                r = block.runs
                ends.append(ends[-1][-1] + np.searchsorted(r.text, np.arange(len(block.rows)), side="right"))
                parts.append((r.minimiser, r.content, block.begins(r.first, r.text), block.ends(r.first + r.count - 1, r.text)))
            flat = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, dtype=np.int64)] * 4
            struct = pa.StructArray.from_arrays(
                [_longs(flat[0]), _longs(flat[1]), pa.array(flat[2].astype(np.int32)), pa.array(flat[3].astype(np.int32))], fields=list(kind.value_type)
            )
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), struct).cast(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), lists],
                names=["doc_id", "name", "n_bytes", "sha256", "runs"],
            )

    return docs.mapInArrow(found, f"doc_id long, name long, n_bytes long, sha256 string, runs {RUN}")


def _bands(block: Block, pick: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the picked runs all bands: run, first and last window, and a hash of the core that the band's windows share.

    A band holds the windows whose minimiser lies as many units after their start, to a multiple of the band's size,
    so that equal windows are in equal bands.
    """
    r, band = block.runs, block.units.band
    low = (r.place - r.first - r.count + 1)[pick] // band
    sizes = (r.place - r.first)[pick] // band - low + 1
    run = np.repeat(pick, sizes)
    k = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    last = r.place[run] - k * band
    core = mix(block.cores[last] + k.astype(np.uint64) * _STEP[5])
    return run, np.maximum(r.first[run], last - band + 1), np.minimum(r.first[run] + r.count[run] - 1, last), core


def shared_cores(docs: DataFrame, units: Units, mixed: np.ndarray) -> DataFrame:
    """Core and run content of all bands of runs whose minimiser may be mixed, each content once a task."""
    shared = docs.sparkSession.sparkContext.broadcast(mixed)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for block in _blocks(batch.column(1), units):
                pick = _fresh(block.runs.content, np.flatnonzero(in_bitmap(shared.value, block.runs.minimiser)), seen)
                if len(pick):
                    run, _, _, core = _bands(block, pick)
                    yield pa.RecordBatch.from_arrays([_longs(core), _longs(block.runs.content[run])], names=["core", "content"])

    return docs.mapInArrow(found, "core long, content long")


def _fresh(content: np.ndarray, pick: np.ndarray, seen: set[int]) -> np.ndarray:
    """Those of the picked runs whose content is not in seen; seen gets them, and is emptied where it is long."""
    if len(seen) > 500_000:
        seen.clear()
    return np.array([j for j in pick if (c := int(content[j])) not in seen and (seen.add(c) or True)], dtype=np.int64)


def edge_windows(docs: DataFrame, units: Units, mixed: np.ndarray, alone: np.ndarray, met: np.ndarray) -> DataFrame:
    """Hash, run content, document name and place of all windows of bands whose core may be met, in runs whose
    minimiser may be mixed. Contents that are not alone, and so are settled, come once a task for others to meet, and
    are not open."""
    shared = docs.sparkSession.sparkContext.broadcast((mixed, alone, met))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixed, alone, met = shared.value
        seen: set[int] = set()
        for batch in batches:
            keys, parts, held = batch.column(0).to_pylist(), [], 0
            for block in _blocks(batch.column(1), units):
                r = block.runs
                pick = np.flatnonzero(in_bitmap(mixed, r.minimiser))
                if not len(pick):
                    continue
                run, begin, last, core = _bands(block, pick)
                held_core = in_bitmap(met, core)
                run, begin, last = run[held_core], begin[held_core], last[held_core]
                each = np.unique(run)
                single = in_bitmap(alone, r.content[each])
                keep = np.isin(run, np.concatenate([each[single], _fresh(r.content, each[~single], seen)]))
                run, begin, last = run[keep], begin[keep], last[keep]
                if not len(run):
                    continue
                open_ = in_bitmap(alone, r.content[run])
                names = {int(t): _name(keys[block.rows[t]], block.text(t)) for t in np.unique(r.text[run[open_]])}
                named = np.array([names.get(int(t), 0) for t in r.text[run]], dtype=np.int64)
                sizes = last - begin + 1
                at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                text = np.repeat(r.text[run], sizes)
                parts.append((block.windows[at], np.repeat(r.content[run], sizes), np.repeat(named, sizes), block.begins(at, text), block.ends(at, text), np.repeat(open_, sizes)))
                held += len(at)
                if held > 500_000:
                    yield out(parts)
                    parts, held = [], 0
            if parts:
                yield out(parts)

    def out(parts: list) -> pa.RecordBatch:
        *longs, open_ = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays([*map(_longs, longs), pa.array(open_)], names=["hash", "content", "name", "start", "end", "open"])

    return docs.mapInArrow(found, "hash long, content long, name long, start long, end long, open boolean")


def sized_bitmap(df: DataFrame, column: str) -> np.ndarray:
    return bitmap(df, column, map_bits(df.count()))


def _differ(df: DataFrame, key: str) -> DataFrame:
    """Values of key with two contents or more."""
    return written(df.groupBy(key).agg(F.min("content").alias("lo"), F.max("content").alias("hi")).where("lo <> hi").select(key))


def repeated_intervals(docs: DataFrame, table: DataFrame, units: Units) -> DataFrame:
    """name, start and end of all stretches of windows that occur twice or more."""
    each = table.select("name", F.explode("runs").alias("r")).select("name", "r.*")
    contents = written(each.groupBy("minimiser", "content").agg(F.count("*").alias("n")))
    several = written(contents.groupBy("minimiser").agg(F.count("*").alias("k")).where("k > 1").select("minimiser"))
    mixed = sized_bitmap(several, "minimiser")
    twice = contents.where("n > 1").select("minimiser", "content")
    settled = each.join(twice, ["minimiser", "content"]).select("name", "start", "end")
    if not mixed.any():
        return settled
    cores = _differ(shared_cores(docs, units, mixed), "core")
    met = sized_bitmap(cores, "core")
    if not met.any():
        return settled
    alone = sized_bitmap(written(contents.where("n = 1").join(several, "minimiser", "left_semi").select("content")), "content")
    sweep(docs.sparkSession, collect=True)
    edges = written(edge_windows(docs, units, mixed, alone, met))
    single = edges.where("open").join(_differ(edges, "hash"), "hash")
    return settled.unionByName(single.select("name", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))


def whole_characters(piece: bytes) -> bytes:
    """A piece of UTF-8 without the bytes of characters that begin before it or end after it."""
    first = 0
    while first < len(piece) and piece[first] & 0xC0 == 0x80:
        first += 1
    last = len(piece)
    for back in range(1, min(3, last - first) + 1):
        lead = piece[last - back]
        if lead & 0xC0 != 0x80:
            size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            return piece[first : last - back] if size > back else piece[first:]
    return piece[first:]


REMOVED = "array<struct<start:int,end:int>>"


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, gram: int = 200, n_words: int = 0) -> DataFrame:
    """One row per document: doc_id, name, n_bytes, n_removed, n_spans (long), kept_sha256, kept (binary, null where
    nothing is removed, as the text stays as it is), kept_text.

    Removed is each byte in a string of length bytes that also starts elsewhere, judged on the input; with n_words,
    also each byte of so many words in a row that also start elsewhere, whatever blanks are between them there. Null
    is empty; texts with fewer bytes (and words) lose nothing. Rows with equal text remove each other whole, so repeated rows
    need no care; nor do null keys. kept_text (string, null as kept is) is kept without characters of which a cut
    took some bytes. An empty table gives no rows; there are no ties; only the two named columns are read. Rows equal
    in key and text share a name, and what is found for one of them holds for all. One text's windows are handled
    within one task, half a megabyte of text at a time where rows are shorter than that.
    """
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    units = Units("bytes", length, gram)
    table = written(survey(picked, units))
    found = repeated_intervals(picked, table, units)
    if n_words:
        units = Units("words", n_words, max(1, n_words // 4))
        found = found.unionByName(repeated_intervals(picked, written(survey(picked, units).select("name", "runs")), units))
    found = found.distinct()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, lists = [], batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values
            all_starts = flat.field("start").to_numpy().astype(np.int64)
            all_ends = flat.field("end").to_numpy().astype(np.int64)
            for a, b in zip(offsets[:-1], offsets[1:]):
                order = np.argsort(all_starts[a:b], kind="stable")
                begin, reach = all_starts[a:b][order], np.maximum.accumulate(all_ends[a:b][order])
                new = np.concatenate([[True], begin[1:] > reach[:-1]])
                last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
                out.append([{"start": int(x), "end": int(y)} for x, y in zip(begin[new], reach[last])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["name", "removed"])

    removed = written(
        found.groupBy("name").agg(F.collect_list(F.struct("start", "end")).alias("s")).mapInArrow(joined, f"name long, removed {REMOVED}")
    )
    named = sized_bitmap(removed, "name")
    sweep(docs.sparkSession, collect=True)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(named)
    least = min(length, 2 * n_words - 1) if n_words else length

    def affected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names, values = batch.column(0).to_pylist(), [], []
            for first, end, data, starts in texts(batch.column(1), BLOCK):
                for i in range(end - first):
                    own = data[starts[i] : starts[i + 1]]
                    if len(own) >= least:
                        name = _name(keys[first + i], own)
                        if in_bitmap(shared.value, np.array([name], dtype=np.int64).view(np.uint64))[0]:
                            names.append(name), values.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.binary())], names=["name", "data"])

    whole = (F.size("removed") == 1) & (F.col("removed")[0]["end"] - F.col("removed")[0]["start"] == F.col("n_bytes"))
    sizes = table.select("name", "n_bytes").join(removed, "name").dropDuplicates(["name"])
    partly = sizes.where(~whole).select("name", "removed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, whole = [], []
            for data, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at, parts = 0, []
                for x in [*marks, {"start": len(data), "end": len(data)}]:
                    parts.append(data[at : x["start"]])
                    at = x["end"]
                kept.append(b"".join(parts))
                whole.append(b"".join(map(whole_characters, parts)).decode())
            digest = [hashlib.sha256(x).hexdigest() for x in kept]
            columns = [batch.column(0), pa.array(kept, pa.binary()), pa.array(digest, pa.string()), pa.array(whole, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "kept", "digest", "kept_text"])

    texts_of = picked.mapInArrow(affected, "name long, data binary").join(partly, "name").dropDuplicates(["name"])
    rest = texts_of.mapInArrow(cut, "name long, kept binary, digest string, kept_text string")
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["start"])
    return (
        table.drop("runs")
        .join(removed, "name", "left")
        .join(rest, "name", "left")
        .select(
            "doc_id",
            "name",
            "n_bytes",
            F.coalesce(total, F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_spans"),
            F.when(F.col("removed").isNull(), F.col("sha256")).when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("digest")).alias("kept_sha256"),
            F.when(F.col("removed").isNotNull(), F.when(whole, F.lit(b"")).otherwise(F.col("kept"))).alias("kept"),
            F.when(F.col("removed").isNotNull(), F.when(whole, F.lit("")).otherwise(F.col("kept_text"))).alias("kept_text"),
        )
    )


def op10_repeats(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    return without_repeats(docs).drop("name", "kept", "kept_text")
