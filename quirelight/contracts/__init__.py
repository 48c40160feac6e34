"""Versioned contracts: YAML files beside this module, and a manifest of their versions and content hashes."""

from __future__ import annotations

import hashlib
from functools import cache
from pathlib import Path

import yaml

HERE = Path(__file__).parent


def available() -> list[str]:
    return sorted(p.stem for p in HERE.glob("*.yaml") if p.stem != "manifest")


def content_hash(name: str) -> str:
    """The first 16 hex digits of the SHA-256 of the file with line ends as line feeds."""
    return hashlib.sha256((HERE / f"{name}.yaml").read_bytes().replace(b"\r\n", b"\n")).hexdigest()[:16]


@cache
def load(name: str) -> dict:
    return yaml.safe_load((HERE / f"{name}.yaml").read_text(encoding="utf-8"))


def versions() -> dict[str, str]:
    return {n: load(n)["version"] for n in available()}


def read_manifest() -> dict[str, dict[str, str]]:
    return yaml.safe_load((HERE / "manifest.yaml").read_text(encoding="utf-8")) or {}


def write_manifest() -> None:
    rows = "".join(f'{n}: {{version: "{load(n)["version"]}", hash: "{content_hash(n)}"}}\n' for n in available())
    (HERE / "manifest.yaml").write_text(rows, encoding="utf-8")


def verify() -> list[tuple[str, str]]:
    """(name, finding) for each contract that is missing from the manifest, drifted, stale or an orphan there."""
    listed, out = read_manifest(), []
    for name in sorted({*available(), *listed}):
        if name not in listed:
            out.append((name, "missing"))
        elif name not in available():
            out.append((name, "orphan"))
        elif content_hash(name) != listed[name]["hash"]:
            out.append((name, "drifted" if load(name)["version"] == listed[name]["version"] else "stale"))
    return out


def findings(listed, found):
    """DataFrames of name, version, content_hash: the manifest's rows and the contracts'. name, finding: as verify()."""
    from pyspark.sql import functions as F

    both = listed.select("name", F.col("version").alias("l_version"), F.col("content_hash").alias("l_hash")).join(found, "name", "full")
    drifted = F.when(F.col("l_version") == F.col("version"), "drifted").otherwise("stale")
    finding = F.when(F.col("l_hash").isNull(), "missing").when(F.col("content_hash").isNull(), "orphan").when(F.col("l_hash") != F.col("content_hash"), drifted)
    return both.select("name", finding.alias("finding")).where("finding is not null")
