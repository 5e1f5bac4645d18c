"""Written tables and when they go, samples, and operators on workers that do not know the library."""

import os
import subprocess
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

from tallyloom.llm import minhash, shared
from tallyloom.llm.labelled import labelled_sample
from tallyloom.llm.repeats import whole_characters

REPO = Path(__file__).resolve().parents[2]

APART = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", {folder!r}).getOrCreate())
import importlib.util
import pyarrow as pa
def known(batches):
    yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("tallyloom") is not None])], names=["x"])
assert not spark.range(1, numPartitions=1).mapInArrow(known, "x boolean").first()[0]
for name in ("documents", "labels", "benchmark", "embeddings"):
    spark.read.parquet(f"/root/testdata/sf0.001/{{name}}.parquet").limit(80).write.parquet(f"{folder}/in/{{name}}.parquet")
from tallyloom.llm.queries import QUERIES
import corpus_pipeline
for name, query in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    print(name, query(spark, "{folder}/in").count(), flush=True)
"""


def test_workers_need_not_know_the_library(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = APART.format(repo=str(REPO), folder=str(tmp_path))
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert len(ran.stdout.split("\n")) >= 14
    assert not list(tmp_path.glob("tallyloom-*")), "written tables stay after the driver's end"


def paths(spark):
    return [p for p in shared._HELD if Path(p.removeprefix("file:")).exists()]


def test_written_tables_go_when_nothing_reads_them(spark):
    shared.sweep(spark, collect=True)
    before = set(paths(spark))
    table = shared.written(spark.range(100).withColumn("x", F.col("id") * 2))
    [path] = set(paths(spark)) - before
    derived = table.where("x > 10").groupBy((F.col("x") % 3).alias("y")).count()
    del table
    shared.sweep(spark, collect=True)
    assert path in paths(spark) and derived.count() == 3
    del derived
    for _ in range(20):  # references are cleared some time after a collection
        shared.sweep(spark, collect=True)
        if path not in shared._HELD:
            break
        time.sleep(0.2)
    assert path not in paths(spark) and not Path(path).exists()


def test_a_step_beyond_the_bound_is_kept_in_part(spark):
    table = spark.range(1000).select("id", F.lit(5).alias("n"))
    top, rest, more = shared.parted(table, "n", 100)
    assert more and 50 <= top.count() <= 100 and top.unionByName(rest).distinct().count() == 1000
    top, rest, more = shared.parted(table, "n", 1000)
    assert not more and top.count() == 1000 and rest.count() == 0
    assert shared.commonest(table.limit(0), "n", 10).count() == 0


def test_samples_do_not_depend_on_partitions(spark, setting):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    docs = labels.select("doc_id", F.concat(F.lit("text "), "doc_id").alias("text"))
    drawn = []
    for partitions, coalesce in (("8", "true"), ("5", "false"), ("3", "true")):
        setting(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__coalescePartitions__enabled=coalesce)
        sample = labelled_sample(docs, labels.repartition(int(partitions)), "toxic", F.lit(True), 500)
        drawn.append(sorted(map(tuple, sample.collect())))
    assert drawn[0] == drawn[1] == drawn[2] and 400 < len(drawn[0]) < 600


def test_whole_characters():
    text = "aé漢😀z".encode()
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            kept = whole_characters(text[a:b]).decode()
            starts = [i for i in range(len(text)) if text[i] & 0xC0 != 0x80] + [len(text)]
            whole = [(i, j) for i, j in zip(starts, starts[1:]) if a <= i and j <= b]
            assert kept == (text[whole[0][0] : whole[-1][1]].decode() if whole else "")


def test_a_family_without_links_and_hidden_links(spark):
    """Near copies of one text that are mostly too far from each other, in any number of turns."""
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in range(2 + i % 4):
            words[(i * 31 + k * 29) % 150] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for _, t in rows]
    root = list(range(60))
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert 1 < len(set(root)) < 60
    for turns in (0, 1, 3):
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(table, turns=turns).collect()}
        assert got == dict(enumerate(root))
