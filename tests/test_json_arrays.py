import json
import random

import pytest

from veridact.operators import records
from veridact.schemas import ContractError
from veridact.sources import adapters, json_arrays


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "293", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hard(n, seed):
    rnd = random.Random(seed)
    bits = ['"', "\\", "{", "}", "[", "]", ",", "가", "\n", "é", " ", "x", '\\"', "}{", '"}']
    word = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30)))
    rows = [{"id": i, word(): word(), "deep": [{"a": [word(), {}]}, []]} for i in range(n)]
    rows[n // 2]["long"] = "}" * 700 + '{"' * 200  # goes over many splits
    return rows


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_of_many_splits_equal_the_whole_parse(spark, tmp_path, small_splits, indent):
    want = []
    for k in range(2):
        rows = hard(40, k)
        want += rows
        (tmp_path / f"{k}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=k == 0), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ]\n")
    (tmp_path / "void.json").write_text("")
    assert json_arrays._fragments(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    got = [json.loads(r.json) for r in json_arrays.elements(spark, str(tmp_path)).collect()]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1', '{"a": 1}', '[{"a": "x}]', "[{}]]"])
def test_files_that_are_no_closed_array_stop(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ContractError, match="closed JSON array"):
        json_arrays.elements(spark, str(tmp_path / "x.json"))


@pytest.mark.parametrize("text", ['[{"a": 1}, 3]', "[null]", '["a}b", {"a": 1}]', '[[{"a": 1}]]', '[{"a": 1, "b": 2}]', "[{}]"])
def test_elements_out_of_contract_stop(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ContractError, match="out of contract"):
        json_arrays.read(spark, str(tmp_path / "x.json"), "a int", ("a",))


def test_written_arrays_come_back(spark, tmp_path, small_splits):
    rows = [(i, None if i % 3 == 0 else '}"\\{' * (i % 7)) for i in range(40)]
    json_arrays.write(spark.createDataFrame(rows, "i int, t string").repartition(3), str(tmp_path / "a"))
    got = json_arrays.read(spark, str(tmp_path / "a"), "i int, t string", ("i", "t"))
    assert sorted(map(tuple, got.collect())) == rows
    empty = spark.createDataFrame([], "i int, t string")
    json_arrays.write(empty, str(tmp_path / "e"))
    assert json_arrays.read(spark, str(tmp_path / "e"), "i int, t string", ("i", "t")).count() == 0


def test_inputs_of_the_gates(spark, tmp_path):
    whole = dict.fromkeys(records.KNOWN_FIELDS) | {"reviewId": 1}
    (tmp_path / "r.json").write_text(json.dumps([whole]))
    (tmp_path / "p.json").write_text(json.dumps([dict.fromkeys(adapters.PRODUCT_FIELDS) | {"product_id": "p"}]))
    with pytest.raises(ContractError, match=r"missing input: tags \(.*t.json does not exist\)$"):
        adapters.load_inputs(spark, str(tmp_path / "r.json"), str(tmp_path / "t.json"), str(tmp_path / "p.json"))
    (tmp_path / "t.json").write_text('{"reviewId": 1, "aspect": "a", "polarity": "positive"}\n')
    found = adapters.load_inputs(spark, str(tmp_path / "r.json"), str(tmp_path / "t.json"), str(tmp_path / "p.json"))
    assert [d.count() for d in found] == [1, 1, 1]
