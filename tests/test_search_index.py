from __future__ import annotations

import re

import pytest
from helpers import rows

from plumbline.operators import investigate, search_index

DATA = [
    (1, "MTR-00012", "RAW-1"), (2, "mtr-00120", "RAW-22"), (3, None, "raw-mtr-00012-x"), (4, "", None), (5, "É_%1", "ab"), (6, "aaaa", "aaa"),
    (7, "MTR-00012", "RAW-1"), (8, None, None), (9, "a.b", "x" * 500 + "needle"),
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    df = spark.createDataFrame(DATA, "id int, meter string, reading string").repartition(3)
    path = str(tmp_path_factory.mktemp("index"))
    search_index.build_index(df, ["meter", "reading"], path)
    return df, path


@pytest.mark.parametrize("text", ["", "m", "r-", "mtr", "R-0001", "00012", "mtr-00012", "aaaa", "aaaaa", "É_%", "é", ".", "%", "needle", "not there", "raw-1"])
def test_index_equals_the_scan(indexed, text):
    df, path = indexed
    columns = ["meter", "reading"]
    assert rows(search_index.indexed_search(df, path, text, columns)) == rows(investigate.text_search(df, text, columns))


def test_only_parts_of_the_rarest_triples_are_read(spark, indexed):
    _, path = indexed
    plan = search_index.matching_values(spark, path, "mtr-00012")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*part#\d+ (IN|INSET)", plan) and "In(gram" in plan


def test_index_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "id int, meter string")
    search_index.build_index(df, ["meter"], str(tmp_path / "none"))
    assert search_index.indexed_search(df, str(tmp_path / "none"), "abc", ["meter"]).collect() == []
