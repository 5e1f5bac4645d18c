"""Each stage of the pipeline against a plain version of it, on what the stages before it have left."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tallyloom.llm import tokens

SMALL = "/root/testdata/sf0.001"
SPACE, LETTERS = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOREIGN = "".join(chr(0x4E00 + i * 37 % 2000) for i in range(400))


def lowered(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def planted(real, items):
    """Rows that each stage has something to do with, made of clean documents."""
    clean = sorted((r for r in real if r.text and r.lang and 1200 < len(r.text) < 6000), key=lambda r: r.doc_id)
    passage = clean[0].text[:500]
    rows = [(5000, None, "en"), (5001, "", "en"), (5002, "12 34 !!", None), (5003, FOREIGN, None), (None, clean[1].text, "en")]
    for i, r in enumerate(clean[2:8]):  # exact copies, one under the same key, and copies with a changed word
        words = r.text.split(" ")
        rows += [(r.doc_id, r.text, r.lang), (5100 + i, r.text, r.lang)]
        rows.append((5200 + i, " ".join([*words[: len(words) // 2], "other", *words[len(words) // 2 + 1 :]]), r.lang))
    for i, (r, first, last) in enumerate(zip(clean[8:12], "éĩéa", "éèêa")):  # a cut through characters on either side
        half = len(r.text) // 2
        rows.append((5300 + i, f"� {r.text[:half]}{first}{passage}{last}{r.text[half:]} �", r.lang))
    for i, (r, item) in enumerate(zip(clean[12:18], sorted(items, key=lambda x: -len(x.text or "")))):
        rows.append((5400 + i, " ".join([r.text[:300], item.text, r.text[300:600]]), r.lang))
    return rows


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """By stage: the rows it was given, in the order of its one file, and those it returned."""
    folder = str(tmp_path_factory.mktemp("stages"))
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items.coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    real = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    every = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in real]
    every += [(key, text, lang, "planted", len(text or "")) for key, text, lang in planted(real, items.collect())]
    docs = spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long")
    found = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/{i}"
        docs.coalesce(1).write.parquet(path)
        docs = spark.read.parquet(path)
        given = docs.collect()
        docs = stage(spark, docs, folder)
        found[name] = given, docs.collect()
    return found


def test_language_leaves_clean_rows_as_they_are(steps):
    given, got = steps["language_id"]
    gone = Counter(given) - Counter(got)
    assert not Counter(got) - Counter(given)
    without_letters = {r.doc_id for r in given if not re.search(r"[^\W\d_]", r.text or "")}
    assert without_letters | {5003} <= {r.doc_id for r in gone} and {5000, 5001, 5002} <= without_letters
    assert sum(gone.values()) <= len(without_letters) + 1 + len(given) // 50


def test_near_duplicates_against_all_pairs(steps):
    given, got = steps["minhash_near_dedup"]
    sets = []
    for r in given:
        words = lowered(r.text, SPACE)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert Counter(got) == Counter(r for i, r in enumerate(given) if find(i) == i)
    assert len(given) - len(got) >= 18


def test_repeats_against_all_windows(steps):
    given, got = steps["suffix_array_dedup"]
    data = [(r.text or "").encode() for r in given]
    seen = Counter(t[i : i + 400] for t in data for i in range(len(t) - 399))
    expected, cut = [], 0
    for r, t in zip(given, data):
        mark = bytearray(len(t))
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                mark[i : i + 400] = b"\1" * 400
        place, kept = 0, []
        for c in r.text or "":
            size = len(c.encode())
            if not any(mark[place : place + size]):
                kept.append(c)
            cut += 0 < sum(mark[place : place + size]) < size
            place += size
        text = "".join(kept) if any(mark) else r.text
        expected.append((r.doc_id, text, r.lang, r.source, len(text) if any(mark) else r.n_chars))
    assert cut >= 2  # characters that lost a part of their bytes
    assert Counter(map(tuple, got)) == Counter(expected)
    ends = [r.text for r in got if r.doc_id in range(5300, 5304)]
    assert len(ends) >= 2 and all(t[0] == t[-1] == "�" and t.count("�") == 2 for t in ends)  # the author's own stay


def test_decontamination_against_all_windows(spark, steps):
    given, got = steps["benchmark_decontamination"]
    windows = set()
    for item in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        words = lowered(item.text, LETTERS)
        windows |= {tuple(words[i : i + 13]) for i in range(max(1, len(words) - 12))} if words else set()
    expected = []
    for r in given:
        words = lowered(r.text, LETTERS)
        hit = set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
        if not (hit and 20 * len(hit) >= len(words)):
            expected.append(r)
    assert Counter(got) == Counter(expected)
    assert len(given) - len(got) >= 5


def test_packing_against_whole_texts(steps):
    given, got = steps["packing"]
    tokenizer, _ = tokens.load(tokens.vocabulary())
    whole = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in given}
    assert len(whole) == len(given)  # copies under one key are gone by now
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = whole[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, total in [(pieces[k], len(ids)) for k, ids in whole.items()] + [(s, None) for s in sequences.values()]:
        end = 0
        for start, length in sorted(parts):
            assert start == end and length > 0
            end += length
        assert end == total if total else end <= 1024
