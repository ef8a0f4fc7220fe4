"""Vocabularies and weights from small JSON files, with the digest that results are attributed to."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CODE_PREFIX, FAILURES, SEVERITIES, ContractError, TrustPolicy
from .json_arrays import present

#: A vocabulary is small; a larger file is a table given by mistake.
MAX_BYTES = 1 << 20
#: Weight names of the file (fixed values) and the policy's fields.
SIGNALS = {"contentLength": "content_length", "uniqueContent": "unique_content", "onTopic": "on_topic", "hasPhoto": "has_photo", "usagePeriod": "usage_period", "likes": "likes"}
#: Signals that aren't there yet when reviews come in.
LATER = ("onTopic",)


@dataclass(frozen=True)
class Loaded:
    """What a file holds, its version (null where its kind has none) and the SHA-256 of its bytes."""

    value: Any
    version: str | None
    digest: str


def _pairs(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    names = [k for k, _ in pairs]
    twice = sorted({k for k in names if names.count(k) > 1})
    if twice:
        raise ContractError(f"repeated keys: {twice}")
    return dict(pairs)


def _body(spark: SparkSession, path: str, name: str) -> tuple[dict[str, Any], str]:
    """(object, digest) of the one file at path. A missing or large file, repeated keys and what is no object stop."""
    present(spark, **{name: path})
    files = spark.read.format("binaryFile").load(path)
    sizes = [r.length for r in files.select("length").take(2)]
    if len(sizes) != 1 or sizes[0] > MAX_BYTES:
        raise ContractError(f"{name}: one file of at most {MAX_BYTES} bytes is needed, found sizes {sizes}")
    row = files.select("content", F.sha2("content", 256).alias("digest")).first()
    try:
        body = json.loads(bytes(row.content).decode("utf-8"), object_pairs_hook=_pairs)
    except ValueError as e:
        raise ContractError(f"{name}: {e}") from None
    if not isinstance(body, dict):
        raise ContractError(f"{name}: a JSON object is needed")
    return body, row.digest


def _version(body: dict[str, Any], known: tuple[str, ...], name: str) -> str:
    if body.get("version") not in known:
        raise ContractError(f"{name}: version {body.get('version')!r} isn't one of {list(known)}")
    return body["version"]


def trust_policy(spark: SparkSession, path: str, versions: tuple[str, ...] = ("trust-v1",)) -> Loaded:
    """The trust policy of a file: a weight for every signal (0 is said, not left out), none negative or unknown,
    one above 0 among those known when reviews come in, and a ramp that rises."""
    body, digest = _body(spark, path, "trust weights")
    version = _version(body, versions, "trust weights")
    weights = body.get("weights")
    if not isinstance(weights, dict) or set(weights) != set(SIGNALS):
        given = set(weights) if isinstance(weights, dict) else set()
        raise ContractError(f"trust weights: unknown {sorted(given - set(SIGNALS))}, missing {sorted(set(SIGNALS) - given)}")
    for name, w in weights.items():
        if isinstance(w, bool) or not isinstance(w, (int, float)) or not 0 <= w < float("inf"):
            raise ContractError(f"trust weights: {name} is {w!r}, not a number from 0 on")
    if not any(w > 0 for name, w in weights.items() if name not in LATER):
        raise ContractError("trust weights: no signal known at ingest weighs anything")
    ramp = body.get("contentLength")
    ramp = ramp if isinstance(ramp, dict) else {}
    low, high = ramp.get("floorChars", 0), ramp.get("capChars", 0)
    if any(isinstance(x, bool) or not isinstance(x, int) for x in (low, high)):
        raise ContractError(f"trust weights: floorChars {low!r} and capChars {high!r} are integers")
    policy = TrustPolicy(**{SIGNALS[n]: float(w) for n, w in weights.items()}, floor_chars=low, cap_chars=high, shape=ramp.get("shape", "sqrt"))
    return Loaded(policy, version, digest)


def codebook(spark: SparkSession, path: str) -> Loaded:
    """(axis, code, label) of a file with a map from codes to labels for each axis; codes are an axis' letter and two digits.

    Other keys of the file are remarks. The book has no version: its digest names it.
    """
    body, digest = _body(spark, path, "codebook")
    rows = []
    for axis, letter in CODE_PREFIX.items():
        entries = body.get(axis)
        if not isinstance(entries, dict) or not entries:
            raise ContractError(f"codebook: no codes of {axis}")
        for code, label in entries.items():
            if not re.fullmatch(letter + "[0-9]{2}", code) or not isinstance(label, str) or not label.strip():
                raise ContractError(f"codebook: {axis} {code!r} is no code of the form {letter}01, or has no label")
            rows.append((axis, code, label))
    return Loaded(spark.createDataFrame(rows, "axis string, code string, label string"), None, digest)


def failures(spark: SparkSession, path: str) -> Loaded:
    """(failure, severity, position) of a taxonomy's file; severities are those of its own order, which the engine's holds."""
    body, digest = _body(spark, path, "failures")
    version = body.get("version")
    if not isinstance(version, str) or not version.strip():
        raise ContractError("failures: a version is needed, or no result can be attributed to it")
    order, types = body.get("severityOrder"), body.get("types")
    if not isinstance(order, list) or not order or not set(order) <= set(SEVERITIES) or not isinstance(types, list) or not types:
        raise ContractError("failures: severityOrder and types are needed, severities known")
    for t in types:
        lost = [f for f in ("key", "label", "severity", "order") if not isinstance(t, dict) or f not in t]
        if lost or t["severity"] not in order:
            raise ContractError(f"failures: {t!r} lacks {lost or 'a severity of the order'}")
    keys = [t["key"] for t in types]
    if len(set(keys)) < len(keys) or not set(keys) <= {f[0] for f in FAILURES}:
        raise ContractError(f"failures: keys are repeated or unknown: {keys}")
    return Loaded(spark.createDataFrame([(t["key"], t["severity"], t["order"]) for t in types], "failure string, severity string, position int"), version, digest)


def labelled_uses(found: DataFrame, book: DataFrame) -> DataFrame:
    """(axis, code, label, uses) of every code of the book; found: axis, code, one row a use. Null codes are unstated and not counted."""
    uses = found.where("code is not null").groupBy("axis", "code").agg(F.count("*").alias("uses"))
    return book.join(uses, ["axis", "code"], "left").select("axis", "code", "label", F.coalesce("uses", F.lit(0)).alias("uses"))
