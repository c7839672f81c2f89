"""Shared folders of the operators, and ids of other types."""

from datetime import date
from types import SimpleNamespace

import pytest

from rillet.llm.common import _set_checkpoint_folder
from rillet.llm.decontaminate import leaks


def session(master, folder=None):
    found = []
    context = SimpleNamespace(master=master, setCheckpointDir=found.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: folder)), found


def test_folder_of_the_session():
    spark, found = session("k8s://host", "hdfs://shared/x")
    _set_checkpoint_folder(spark)
    assert found == ["hdfs://shared/x"]


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host"])
def test_no_local_folder_on_a_cluster(master):
    spark, found = session(master)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _set_checkpoint_folder(spark)
    assert found == []


def test_local_session_has_its_own():
    spark, found = session("local[2]")
    _set_checkpoint_folder(spark)
    assert len(found) == 1


@pytest.mark.parametrize("kind, ids", [("smallint", (1, 2)), ("date", (date(2024, 1, 1), None)), ("double", (0.5, 1.5)), ("binary", (b"a", b"b"))])
def test_leaks_with_other_ids(spark, kind, ids):
    text = "which of these five rivers flows through the old city"
    docs = spark.createDataFrame([(ids[0], f"so {text} then"), (ids[1], "nothing here")], f"doc_id {kind}, text string")
    items = spark.createDataFrame([(ids[1], text)], f"item_id {kind}, text string")
    (row,) = leaks(docs, items).collect()
    assert (row.doc_id, row.item_id, row.similarity, row.first_word) == (*ids, 1.0, 1)
