"""Quality rules, line first: rules judge each line, and a document that loses too much text is rejected.

Only DataFrame functions are used. All work on a document happens in its own row, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but blanks.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: Lines that sites repeat around their content.
BOILERPLATE = (
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|accept (all )?cookies|we use cookies"
    r"|sign up for our newsletter|enable javascript|skip to (main )?content|share (this )?on (facebook|twitter))\b"
)
WINDOW = 8


def _let(value: Column, body) -> Column:
    """body of value, with value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows of eight words that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash, built from those of two and four words. Sorted by hash and place, a window is
    repeated if a neighbour has its hash; the covered words follow from the gaps between repeated places.
    """
    def repeated(ordered: Column) -> Column:
        same = lambda w, j: F.get(ordered, j)["h"] == w["h"]
        return F.transform(
            F.filter(ordered, lambda w, j: F.coalesce(same(w, j - 1), F.lit(False)) | F.coalesce(same(w, j + 1), F.lit(False))),
            lambda w: w["i"],
        )

    def covered(places: Column) -> Column:
        gap = lambda p, j: F.least(F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        return F.aggregate(F.transform(places, gap), F.lit(0).cast("bigint"), lambda total, g: total + g)

    def doubled(part: Column, width: int) -> Column:
        pair = lambda h, i: F.xxhash64(h, F.get(part, i + width))
        return F.slice(F.transform(part, pair), F.lit(1), F.size(part) - width)

    def covered_by(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = _let(ordered, lambda o: _let(F.sort_array(repeated(o)), covered))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0).cast("bigint"))

    found = _let(doubled(hashes, 1), lambda two: _let(doubled(two, 2), lambda four: _let(doubled(four, 4), covered_by)))
    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(found).cast("bigint")


def line_passes(line: Column) -> Column:
    """Whether a line reads as text. A line without a word passes, as it holds nothing to judge.

    Otherwise it fails if
    - punctuation: one character in 12 or more is a symbol (# * $ % & | < >) or an exclamation mark;
    - navigation: it has three separators (| > » ·) or more, and one for every 24 characters at least;
    - boilerplate: it has at most 200 characters and a phrase that sites repeat around their content;
    - shouting: eight words in a row are capitals.
    """
    length = F.length(line)
    separators = F.regexp_count(line, F.lit("[|>»·]"))
    fails = (
        (F.regexp_count(line, F.lit("[#*$%&|<>!]")) * 12 >= length)
        | F.when(separators >= 3, separators * 24 >= length).otherwise(F.lit(False))
        | F.when(length <= 200, line.rlike(BOILERPLATE)).otherwise(F.lit(False))
        | line.rlike(r"(?:\p{Lu}{2,}\P{L}+){8}")
    )
    return ~line.rlike(NOT_BLANK) | ~fails


def clean_lines(
    docs: DataFrame,
    text: str = "text",
    most_lost: float = 0.5,
    least_words: int = 20,
    most_repeated: float = 0.3,
) -> DataFrame:
    """docs with counts, verdict and the text of the lines that pass.

    Columns added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long), base_failed, kept
    (boolean), lost_share (characters of words in failed lines among all) and cleaned_text. An input column of
    one of these names is replaced. A document fails at the base with fewer than least_words words or with more
    than most_repeated of its words in repeated windows; it is kept if it passes that and loses at most
    most_lost of its text. Null text counts as no words and gives a null cleaned_text. Rows are judged one by
    one, so repeated rows and null keys need no care.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    chars = lambda whole: F.length(F.regexp_replace(whole, BLANK_RUN, "")).cast("long")
    found = docs.withColumns({
        "_words": F.when(body.rlike(NOT_BLANK), F.split(F.btrim(body, F.lit(BLANKS)), BLANK_RUN)).otherwise(F.array().cast("array<string>")),
        "_lines": F.split(body, "\n", -1),
    })
    found = found.withColumns({
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        "_full": F.filter("_lines", lambda x: x.rlike(NOT_BLANK)),
        "_good": F.filter("_lines", line_passes),
    })
    found = found.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": chars(body),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOL)).cast("long"),
        "n_dup_lines": (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_hashes")),
    })
    base = (F.col("n_words") < least_words) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(round(100 * most_repeated)) * F.col("n_words")
    )
    lost = F.when(F.size("_good") < F.size("_lines"), 1 - chars(F.array_join("_good", "\n")) / F.greatest("word_chars", F.lit(1)))
    found = found.withColumns({"base_failed": base, "lost_share": F.coalesce(lost, F.lit(0.0))})
    return found.withColumns({
        "kept": ~F.col("base_failed") & (F.col("lost_share") <= most_lost),
        "cleaned_text": F.when(F.col(text).isNotNull(), F.array_join("_good", "\n")),
    }).drop("_words", "_lines", "_hashes", "_full", "_good")


def op5_line_cleaning(docs: DataFrame) -> DataFrame:
    """The contract's columns for documents."""
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_share")
    return clean_lines(docs).select("doc_id", *columns)


ORACLE_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i, w[i : i + 7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY doc_id),
lines AS (
  SELECT doc_id, t, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, len(l) AS n_lines,
    list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS filled,
    list_filter(l, lambda x: NOT regexp_matches(x, '[^\x20\x09-\x0D]') OR NOT (
      len(regexp_extract_all(x, '[#*$%&|<>!]')) * 12 >= length(x)
      OR (len(regexp_extract_all(x, '[|>»·]')) >= 3 AND len(regexp_extract_all(x, '[|>»·]')) * 24 >= length(x))
      OR (length(x) <= 200 AND regexp_matches(x, '{BOILERPLATE}'))
      OR regexp_matches(x, '(?:\p{{Lu}}{{2,}}\P{{L}}+){{8}}'))) AS good
  FROM w),
counted AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    n_words < 20 OR 100 * coalesce(covered.n, 0) > 30 * n_words AS base_failed,
    CASE WHEN len(good) < n_lines THEN 1 - CAST(
        length(regexp_replace(array_to_string(good, chr(10)), '[\x20\x09-\x0D]+', '', 'g')) AS DOUBLE) / greatest(word_chars, 1)
      ELSE 0.0 END AS lost_share
  FROM lines LEFT JOIN covered USING (doc_id))
SELECT *, NOT base_failed AND lost_share <= 0.5 AS kept FROM counted
"""
