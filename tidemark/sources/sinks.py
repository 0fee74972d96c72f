"""Writers: checked builds, atomic publishing, manifests, twin exports."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import parity


class Refused(ValueError):
    """A build that failed its checks; what was published before stays."""


def checked(df: DataFrame, checks: dict[str, F.Column]) -> dict[str, int]:
    """The rows that break each check, counted in one pass."""
    row = df.agg(*[F.count_if(F.coalesce(~c, F.lit(True))).alias(k) for k, c in checks.items()]).first()
    return row.asDict()


def publish(df: DataFrame, folder: str, checks: dict[str, F.Column] | None = None, partition_by: tuple[str, ...] = (), compression: str = "zstd") -> str:
    """Write a new version beside the old one, check what was written, then switch the pointer file in one rename.

    Returns the version's path; raises Refused, with the old version still current, where a check counts a row.
    """
    version = f"v-{uuid.uuid4().hex}"
    path = os.path.join(folder, version)
    df.write.option("compression", compression).partitionBy(*partition_by).parquet(path)
    bad = {k: n for k, n in checked(df.sparkSession.read.parquet(path), checks or {"any": F.lit(True)}).items() if n}
    if bad:
        raise Refused(f"rows that break checks: {bad}")
    pointer = Path(folder) / "CURRENT"
    staged = pointer.with_name(f".{version}")
    staged.write_text(version)
    os.replace(staged, pointer)
    return path


def current(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, (Path(folder) / "CURRENT").read_text()))


def write_once(df: DataFrame, path: str) -> bool:
    """An immutable snapshot: written if it isn't there, and otherwise left alone."""
    if os.path.exists(os.path.join(path, "_SUCCESS")):
        return False
    df.write.parquet(path)
    return True


def export_twins(df: DataFrame, parquet: str, csv: str) -> None:
    """Parquet and CSV of the same rows, proven by reading both back and comparing them as multisets; blanks are null."""
    clean = df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    clean.write.parquet(parquet)
    clean.write.csv(csv, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert_twins(df.sparkSession, parquet, csv)


def assert_twins(spark: SparkSession, parquet: str, csv: str) -> None:
    a = spark.read.parquet(parquet)
    b = spark.read.schema(a.schema).csv(csv, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
    diff = parity(a, b).first()
    if diff["only_a"] or diff["only_b"]:
        raise Refused(f"the copies differ: {diff.asDict()}")


def export_years(df: DataFrame, path: str, date: str = "d") -> DataFrame:
    """One folder a year in one pass, and (year, n_rows, first, last) of each."""
    years = df.withColumn("year", F.year(date))
    years.write.partitionBy("year").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path).groupBy("year").agg(F.count("*").alias("n_rows"), F.min(date).alias("first"), F.max(date).alias("last"))


def fingerprint(value) -> str:
    """SHA-256 of a value's canonical JSON."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def manifest(folder: str) -> dict:
    """Hash and size of every file of a published tree, and their fingerprint."""
    files = {}
    for p in sorted(Path(folder).rglob("*")):
        if p.is_file() and p.name != "manifest.json":
            files[str(p.relative_to(folder))] = {"sha256": hashlib.sha256(p.read_bytes()).hexdigest(), "bytes": p.stat().st_size}
    return {"files": files, "fingerprint": fingerprint(files)}


def verify(folder: str, made: dict) -> dict[str, list[str]]:
    """Files missing from, changed in, and unexpected in a tree against its manifest."""
    now, then = manifest(folder)["files"], made["files"]
    return {"missing": sorted(then.keys() - now.keys()), "changed": sorted(k for k in then.keys() & now.keys() if then[k] != now[k]), "unexpected": sorted(now.keys() - then.keys())}


def changed_partitions(inputs: dict[str, str], built: dict[str, str]) -> list[str]:
    """Partitions whose input fingerprint isn't the one they were built from."""
    return sorted(k for k, v in inputs.items() if built.get(k) != v)


def partition_fingerprints(df: DataFrame, by: str) -> DataFrame:
    """(by, n_rows, digest): a digest of each partition's multiset of rows, by sums, not XOR, of row hashes."""
    parts = [F.sum(F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1 << 31))).alias(f"s{seed}") for seed in (1, 2)]
    return df.groupBy(by).agg(F.count("*").alias("n_rows"), *parts).select(by, "n_rows", F.sha2(F.concat_ws("|", "n_rows", "s1", "s2"), 256).alias("digest"))
