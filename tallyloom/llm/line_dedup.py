"""Removal of lines that many documents share.

Lines are exploded, normalised and hashed; documents are counted per hash, each once, in every task before the
shuffle. Lines over the threshold are looked up by a join and leave by position; what stays is put together again in
order. All of it is built-in functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written

BLANKS = " \t\n\x0b\f\r"
HASH = ("line_one", "line_two")
NAME = ("text_one", "text_two")


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z as a-z; other letters stay, whatever their case."""
    ascii_only = F.octet_length(line) == F.char_length(line)
    lowered = F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, string.ascii_uppercase, string.ascii_lowercase))
    return F.trim(lowered, F.lit(BLANKS))


def _two_hashes(value: Column, names: tuple[str, str]) -> list[Column]:
    """128 bits that stand for a text: enough for lines without number."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit("second"), value).alias(names[1])]


def shared_lines(texts: DataFrame, least_documents: int, least_points: int) -> DataFrame:
    """Hashes of line keys of least_points or more that least_documents rows or more hold, with their number n."""
    keys = F.array_distinct(F.transform(F.split("text", "\n"), line_key))
    each = texts.select(F.explode(keys).alias("key")).where(F.char_length("key") >= least_points)
    return each.groupBy(*_two_hashes(F.col("key"), HASH)).agg(F.count("*").alias("n")).where(F.col("n") >= least_documents)


def dropped_places(texts: DataFrame, common: DataFrame, entries: int) -> DataFrame:
    """Places (from 0, ascending) of the lines of each text that are among the common ones; texts are named by hash.

    Of the common lines, fewer than entries can be in more than an entries-th of all that was counted. These are
    broadcast and meet the lines where they are read, so a line that a third of all documents hold is never shuffled.
    The others, none of them hot, meet by a shuffled join. If there are no more than entries, all are broadcast.
    """
    total = common.agg(F.count("*").alias("lines"), F.sum("n").alias("held")).first()
    lines = (
        texts.select(*_two_hashes(F.col("text"), NAME), F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .select(*NAME, "at", line_key(F.col("line")).alias("key"))
        .where("key <> ''")
        .select(*NAME, "at", *_two_hashes(F.col("key"), HASH))
    )
    if total.lines <= entries:
        hits = lines.join(F.broadcast(common.select(*HASH)), list(HASH), "left_semi")
    else:
        hot = F.col("n") > total.held / entries
        frequent, others = common.where(hot).select(*HASH), common.where(~hot).select(*HASH)
        hits = lines.join(F.broadcast(frequent), list(HASH), "left_semi")
        rest = lines.join(F.broadcast(frequent), list(HASH), "left_anti")
        hits = hits.unionByName(rest.join(others.hint("merge"), list(HASH)).select(*hits.columns))
    return hits.groupBy(*NAME).agg(F.array_sort(F.collect_set("at")).alias("dropped"))


def without_shared_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_documents: int = 10, least_points: int = 1, entries: int = 50_000
) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped (long), kept (string, the lines that stay, joined by \\n).

    A line goes if its key, the line without blanks at its ends and with A-Z lower-cased, has least_points code
    points or more and is found in least_documents rows or more. Null and empty texts are one empty line, which
    stays. Each row is a document of its own, whatever doc_id it has, null included, so repeated rows count as often
    as they come; a key that a row holds twice counts once. Only the two named columns are read, so others may have
    any name. There are no ties, and an empty table gives no rows. A text is handled as one row, so it has to fit a
    task's memory a few times over; work grows in proportion to its length.

    Texts are named by 128 bits, and equal texts share what is found for one of them. entries bounds what is
    broadcast; see dropped_places.
    """
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    common = written(shared_lines(whole, least_documents, least_points))
    dropped = written(dropped_places(whole.select("text"), common, entries))
    lines = whole.select("doc_id", *_two_hashes(F.col("text"), NAME), F.split("text", "\n").alias("lines"))
    found = lines.join(dropped, list(NAME), "left")

    def gap(j: Column) -> Column:
        """The lines between one dropped place and the next."""
        begin = F.coalesce(F.get("dropped", j - 1) + 1, F.lit(0))
        return F.slice("lines", begin + 1, F.coalesce(F.get("dropped", j), F.size("lines")) - begin)

    gaps = F.transform(F.sequence(F.lit(0), F.size("dropped")), gap)
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.flatten(gaps))
    return found.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


def op11_line_dedup(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    return without_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT *, key IN (SELECT key FROM common) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
