import copy
import hashlib
import json

import pytest

from veridact.schemas import FAILURES, SEVERITIES, ContractError, TrustPolicy
from veridact.sources import vocabularies

WEIGHTS = {"version": "trust-v1", "weights": {"contentLength": 0.6, "uniqueContent": 0.4, "onTopic": 0.5, "hasPhoto": 0, "usagePeriod": 0, "likes": 0}, "contentLength": {"floorChars": 22, "capChars": 478, "shape": "sqrt"}}
BOOK = {"note": "x", "skinType": {"A01": "dry"}, "skinTone": {"B01": "cool"}, "skinTrouble": {"C01": "spots", "C02": "pores"}}
TAXONOMY = {"version": "f-v1", "severityOrder": list(SEVERITIES), "types": [{"key": k, "label": k, "severity": s, "order": o} for k, s, o in FAILURES]}


def put(path, body):
    path.write_text(body if isinstance(body, str) else json.dumps(body))
    return str(path)


def test_loaded_values_and_digests(spark, tmp_path):
    path = put(tmp_path / "w.json", WEIGHTS)
    got = vocabularies.trust_policy(spark, path)
    assert got.value == TrustPolicy() and got.version == "trust-v1"
    assert got.digest == hashlib.sha256((tmp_path / "w.json").read_bytes()).hexdigest()
    book = vocabularies.codebook(spark, put(tmp_path / "b.json", BOOK)).value
    assert sorted(map(tuple, book.collect())) == [("skinTone", "B01", "cool"), ("skinTrouble", "C01", "spots"), ("skinTrouble", "C02", "pores"), ("skinType", "A01", "dry")]
    uses = vocabularies.labelled_uses(spark.createDataFrame([("skinType", "A01"), ("skinType", "A01"), ("skinTone", None)], "axis string, code string"), book)
    assert {r.code: r.uses for r in uses.collect()} == {"A01": 2, "B01": 0, "C01": 0, "C02": 0}
    got = vocabularies.failures(spark, put(tmp_path / "f.json", TAXONOMY))
    assert sorted(map(tuple, got.value.collect())) == sorted(FAILURES) and got.version == "f-v1"


def changed(body, *path, value):
    body = copy.deepcopy(body)
    at = body
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    return body


@pytest.mark.parametrize("load, body, says", [
    ("trust_policy", changed(WEIGHTS, "version", value="trust-v9"), "trust-v9"),
    ("trust_policy", changed(WEIGHTS, "weights", "likes", value=-1), "likes"),
    ("trust_policy", changed(WEIGHTS, "weights", "likes", value=True), "likes"),
    ("trust_policy", changed(WEIGHTS, "weights", "shade", value=1), "shade"),
    ("trust_policy", changed(WEIGHTS, "weights", value={"likes": 1}), "contentLength"),
    ("trust_policy", changed(WEIGHTS, "weights", value=dict.fromkeys(WEIGHTS["weights"], 0) | {"onTopic": 1}), "ingest"),
    ("trust_policy", changed(WEIGHTS, "contentLength", "capChars", value=22), "ramp"),
    ("trust_policy", '{"version": "trust-v1", "version": "trust-v1"}', "repeated"),
    ("trust_policy", "[1]", "object"),
    ("trust_policy", "{", "trust weights"),
    ("codebook", changed(BOOK, "skinTone", value={}), "skinTone"),
    ("codebook", changed(BOOK, "skinTone", "A02", value="x"), "A02"),
    ("codebook", changed(BOOK, "skinTone", "B02", value=" "), "B02"),
    ("codebook", '{"skinType": {"A01": "x", "A01": "y"}}', "repeated"),
    ("failures", changed(TAXONOMY, "version", value=" "), "version"),
    ("failures", changed(TAXONOMY, "types", 0, "severity", value="mild"), "severity"),
    ("failures", changed(TAXONOMY, "types", 0, "key", value=TAXONOMY["types"][1]["key"]), "repeated"),
    ("failures", changed(TAXONOMY, "types", 0, value={"key": "x"}), "label"),
])
def test_files_out_of_contract_stop(spark, tmp_path, load, body, says):
    with pytest.raises(ContractError, match=says):
        getattr(vocabularies, load)(spark, put(tmp_path / "x.json", body))


def test_missing_and_large_files_stop(spark, tmp_path):
    with pytest.raises(ContractError, match="does not exist"):
        vocabularies.codebook(spark, str(tmp_path / "none.json"))
    with pytest.raises(ContractError, match="at most"):
        vocabularies.codebook(spark, put(tmp_path / "x.json", '{"a": "' + "x" * vocabularies.MAX_BYTES + '"}'))
