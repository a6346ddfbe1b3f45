"""Intermediate tables have files by the data, however many shuffle partitions the session has."""

import os
import random

import pytest

from plaintlens.llm import common
from plaintlens.llm.exact_dedup import exact_dedup
from plaintlens.llm.simhash import simhash_components
from plaintlens.llm.suffix_dedup import suffix_dedup


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "120", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize(
    "operator, tables",
    [
        (suffix_dedup, {"suffix-records", "suffix-repeats"}),
        (simhash_components, {"different-fingerprints", "edges", "least", "large"}),
        (exact_dedup, {"recipe-groups"}),
    ],
)
def test_files_follow_the_data(spark, many_partitions, monkeypatch, operator, tables):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(400)]
    texts += [t + " end" for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    paths, plain = [], common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda s, name: paths.append((name, plain(s, name))) or paths[-1][1])
    result = operator(df)
    assert result.count() == 800
    files = {}
    for name, path in paths:
        own = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
        files[name] = max(files.get(name, 0), len(own))
    most = 4 * spark.sparkContext.defaultParallelism
    assert most < 120 and all(0 < files[name] <= most for name in tables), files


def test_task_count(spark):
    cores = spark.sparkContext.defaultParallelism
    assert common.task_count(spark, 0, 10) == 4 * cores
    assert common.task_count(spark, 100 * cores + 1, 10) == 10 * cores + 1
