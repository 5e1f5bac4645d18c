"""Line dedup, hard negatives and spelling variants against plain versions, and on inputs that tend to break things."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives, line_dedup, spelling

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))


def extra(table):
    """The table with columns whose names the operators use inside."""
    names = "key n at line dropped lines text_one line_one word a b own place score rank mark codes kept".split()
    return table.withColumns({x: F.lit("x") for x in names})


def by_hand(texts, least_documents, least_points):
    """Per text: lines, dropped lines, and what stays."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\v\f\r"))
    split = [(t or "").split("\n") for t in texts]
    held = Counter(k for lines in split for k in {key(x) for x in lines})
    common = {k for k, n in held.items() if n >= least_documents and len(k) >= least_points}
    kept = [[x for x in lines if key(x) not in common] for lines in split]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(split, kept)]


LINES = [
    None,
    "",
    "\n",
    "\n\n",
    "Top\nown one\nTOP \nend",
    "\ttop\r\nown two\r\nend\n",
    "top",
    "top\ntop\ntop",
    "end\nÉtat\nétat\nown three",
    "  état\nend",
    "State\x0b\nstate",
    "own one",
    LONG + "\nend\n" + LONG,
    "\n".join(f"line {i}\ntop" for i in range(20_000)),
]


@pytest.mark.parametrize(("least_documents", "least_points", "entries"), [(2, 1, 50_000), (2, 1, 2), (3, 1, 1), (3, 4, 50_000), (10, 1, 50_000)])
def test_line_dedup_by_hand(spark, least_documents, least_points, entries):
    """Also where common lines are too many to broadcast, and only some or none of them are."""
    texts = LINES + ["Top\nown one\nTOP \nend"] * 2
    table = extra(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = line_dedup.without_shared_lines(table, least_documents=least_documents, least_points=least_points, entries=entries).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == dict(enumerate(by_hand(texts, least_documents, least_points)))


def test_rows_that_share_a_key_are_documents_of_their_own(spark):
    table = spark.createDataFrame([(None, "a\nb"), (None, "a\nc"), (1, "a"), (1, "a")], "doc_id long, text string")
    got = line_dedup.without_shared_lines(table, least_documents=4).select("doc_id", "n_dropped", "kept").collect()
    assert Counter(map(tuple, got)) == Counter([(None, 1, "b"), (None, 1, "c"), (1, 1, ""), (1, 1, "")])


def test_line_dedup_digest_and_empty_table(spark):
    table = spark.createDataFrame([(i, "same\nown" + str(i)) for i in range(10)] + [(10, "same")], "doc_id long, text string")
    got = {r.doc_id: r.kept_sha256 for r in line_dedup.op11_line_dedup(table).collect()}
    assert got == {i: hashlib.sha256(f"own{i}".encode()).hexdigest() for i in range(10)} | {10: hashlib.sha256(b"").hexdigest()}
    assert line_dedup.op11_line_dedup(table.limit(0)).collect() == []


def test_line_dedup_runs_no_python(spark):
    table = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_dedup.without_shared_lines(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "Arrow" not in plan


def pairs_by_hand(rows, anchors, percent=80):
    """Rows of (id, label, vector of whole numbers); every score is computed."""
    out = []
    for i, (own, label, v) in enumerate(rows):
        if not anchors(own):
            continue
        scores = sorted((-int(np.dot(v, w)), other, k) for k, (other, _, w) in enumerate(rows) if k != i)
        for minus, positive, _ in [x for x in scores if rows[x[2]][1] == label][:5]:
            inside = [x for x in scores if rows[x[2]][1] != label and percent * -minus <= 100 * -x[0] <= 100 * -minus]
            out += [(own, positive, rank, x[1], -minus, -x[0]) for rank, x in enumerate(inside[:5], 1)]
    return Counter(out)


def vectors(rng, n, length, labels=4):
    """Clusters that cross labels, with equal vectors among them."""
    centres = rng.normal(size=(6, length))
    rows = [(i, int(rng.integers(labels)), centres[rng.integers(6)] * 0.1 + rng.normal(size=length) * 0.03) for i in range(n)]
    same = rows[3][2]
    return [(i, label, same if i % 5 == 0 else v) for i, label, v in rows]


@pytest.mark.parametrize(("length", "block", "levels"), [(64, 2048, 4), (64, 8, 1), (70, 16, 3), (3, 2048, 2), (200, 2048, 5)])
def test_hard_negatives_by_hand(spark, length, block, levels):
    rows = vectors(np.random.default_rng(length), 400, length)
    table = extra(spark.createDataFrame([(i, x, v.tolist()) for i, x, v in rows], "vec_id long, label int, embedding array<double>").repartition(3))
    got = hard_negatives.hard_negatives(table, F.col("vec_id") % 9 == 0, block=block, levels=levels).collect()
    whole = [(i, x, np.floor(256 * v).astype(np.int64)) for i, x, v in rows]
    assert got and Counter(map(tuple, got)) == pairs_by_hand(whole, lambda i: i % 9 == 0)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(1)
    table = rng.integers(-150, 150, (500, 100))
    turn = hard_negatives.rotations(100, 4)
    codes, along, left = hard_negatives.encoded(table, turn)
    assert (np.diff(left, axis=1) <= 1e-9).all()
    tile = hard_negatives.Tile.__new__(hard_negatives.Tile)
    tile.codes, tile.along, tile.left, tile.vectors = codes, along, left, table
    for v in (table[0], np.zeros(100, dtype=np.int64), rng.integers(-150, 150, 100)):
        true, seen = table @ v, []
        query = hard_negatives.Query(v, turn)

        def inside(low, high):
            seen.append(high - low)
            return (low <= true) & (true <= high)

        assert len(query.survivors(tile, np.arange(500), inside)) == 500
        assert all((b <= a + 1e-3).all() or not v.any() for a, b in zip(seen, seen[1:]))


def test_hard_negatives_of_hard_rows(spark):
    """Nulls, numbers that are none, vectors of other lengths, repeated rows and ties."""
    nan, inf = float("nan"), float("inf")
    rows = [(100, 1, [0.5, 0.5]), (100, 1, [0.5, 0.5]), (1, 1, [0.4, 0.4]), (2, 2, [0.4, 0.4]), (3, 2, [0.4, 0.4]), (4, 2, [0.3, 0.3])]
    bad = [(None, 2, [0.4, 0.4]), (5, None, [0.4, 0.4]), (6, 2, None), (7, 2, [0.4, None]), (8, 2, [nan, 0.4]), (9, 2, [inf, 0.4])]
    bad += [(10, 2, []), (11, 2, [0.4]), (12, 2, [0.4] * 3), (13, 2, [1e30, 0.4])]
    table = spark.createDataFrame(rows + bad, "vec_id long, label int, embedding array<double>")
    anchors = F.col("vec_id") == 100
    got = hard_negatives.hard_negatives(table, anchors).collect()
    score = 2 * 128 * 102
    assert sorted(map(tuple, got)) == [(100, 1, 1, 2, score, score), (100, 1, 2, 3, score, score)]
    assert hard_negatives.hard_negatives(table.limit(0), anchors).collect() == []
    assert hard_negatives.hard_negatives(table, F.lit(False)).collect() == []
    assert hard_negatives.op12_hard_negatives(table.where("embedding is null")).columns[0] == "anchor_id"


def near_by_hand(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_by_hand(rows, every=97):
    counts = Counter()
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near, form = {w: [x for x in words if near_by_hand(w, x)] for w in words}, {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


@pytest.mark.parametrize("symbols", [2, 8])
def test_spelling_variants_by_hand(spark, symbols):
    rng = np.random.default_rng(8)
    letters, made = "abcdeéÀ×", []
    for i in range(60):
        word = "".join(rng.choice(list(letters), rng.integers(4, 8)))
        made += [word] * int(rng.integers(2, 30))
        for _ in range(6):
            at = int(rng.integers(len(word)))
            other = [word[:at] + word[at + 1 :], word[:at] + rng.choice(list(letters)) + word[at:], word[:at] + rng.choice(list(letters)) + word[at + 1 :]]
            word = other[int(rng.integers(3))] or word
            made += [word] * int(rng.integers(1, 9))
    rng.shuffle(made)
    rows = [(int(i) if i % 9 else None, " ".join(x.upper() if k % 7 == 0 and x.isascii() else x for k, x in enumerate(made[i::40])) + "-123-" + "z" * 400 + " chains chains chains chainz" + " chaizz" * (i < 12)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "ĀĀĀ"), (53, "abcde " * 5), (53, "abcde " * 5), (54, "漢abcde字 abcde_abcde")]
    table = extra(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = variants_by_hand(rows, 5)
    got = spelling.spelling_variants(table, every=5, symbols=symbols).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected
    assert [(r.form, r.root) for r in got if r.word == "chaizz"] == [("chainz", "chains")]
    assert spelling.op13_spelling(table.limit(0)).collect() == []


def test_sections_end_where_runs_end():
    text = "ab cd " * 10 + "x" * 50 + " yz"
    parts = list(spelling.sections(text, 7))
    assert "".join(parts) == text
    assert Counter(x for p in parts for x in re.findall("[a-z]+", p)) == Counter(re.findall("[a-z]+", text))


def test_every_near_pair_has_a_common_key_once():
    rng = np.random.default_rng(6)
    words = sorted({"".join(rng.choice(list("abcd"), rng.integers(5, 8))) for _ in range(500)})
    posts, owners = defaultdict(list), defaultdict(list)
    for length in {len(w) for w in words}:
        some = [w for w in words if len(w) == length]
        rows, keys, own = spelling.neighbourhood(some, 3)
        for r, k, o in zip(rows, keys, own):
            posts[k].append((some[r], o))
        rows, keys, _ = spelling.neighbourhood(some, 3, own_only=True)
        for r, k in zip(rows, keys):
            owners[k].append(some[r])
    met = Counter(frozenset((a, b)) for k, v in posts.items() for a, o in v for b in owners.get(k, []) if a != b and (not o or a < b))
    true = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if near_by_hand(a, b)}
    assert true and all(met[p] == 1 for p in true)
