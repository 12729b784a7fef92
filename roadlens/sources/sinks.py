"""Writers: reports, partitioned comparisons, demand files, checked snapshots and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import rounded
from roadlens.operators.audit import table_fingerprint
from roadlens.operators.quality import QualityError
from roadlens.operators.summary import REPORT_COLUMNS


def write_table(frame: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """A complete table; csv gets a header."""
    writer = frame.write.mode("overwrite").partitionBy(*partition_by) if partition_by else frame.write.mode("overwrite")
    (writer.option("header", True).csv(path) if kind == "csv" else writer.format(kind).save(path))
    return path


def write_statistics(report: DataFrame, path: str) -> str:
    """The statistics report: fixed columns, two decimals, one file (a few dozen rows)."""
    return write_table(rounded(report.select(*REPORT_COLUMNS), 2).orderBy("time_period", "jur_name").coalesce(1), path, "csv")


def write_demand(od: DataFrame, path: str) -> str:
    """Sparse demand in zone order: range-partitioned, sorted inside the files."""
    keys = [c for c in ("time_period", "mode") if c in od.columns]
    ranged = od.repartitionByRange(*keys, "o_zone_id").sortWithinPartitions(*keys, "o_zone_id", "d_zone_id")
    return write_table(ranged, path, "parquet", keys)


def write_manifest(facts: DataFrame, path: str) -> str:
    """A one-row (or few-row) table of counts and hashes as JSON."""
    facts.coalesce(1).write.mode("overwrite").json(path)
    return path


def publish_snapshot(new: DataFrame, old: DataFrame, root: str, keys: Sequence[str], changed: Sequence[str]) -> str:
    """Write a new version beside the old one and point to it only if nothing else changed.

    The new table is written first and read back; row count and content of every column not in
    ``changed`` must equal the old table.  The old version stays as the backup, the pointer is one
    JSON row.  A failed check leaves the pointer untouched.
    """
    spark = new.sparkSession
    untouched = [c for c in old.columns if c not in changed]
    stamp = table_fingerprint(new).first()
    path = f"{root.rstrip('/')}/version={stamp['hash_xor'] & (2**63 - 1):016x}"
    new.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    want, got = (table_fingerprint(f, (), untouched).first() for f in (old, back))
    if want != got:
        raise QualityError(f"columns outside {sorted(changed)} changed or rows were lost; snapshot {path} is not published")
    spark.createDataFrame([(path, got["rows"])], "current STRING, rows BIGINT").coalesce(1).write.mode("overwrite").json(
        f"{root.rstrip('/')}/_current")
    return path


def current_snapshot(spark, root: str) -> DataFrame:
    pointer = spark.read.json(f"{root.rstrip('/')}/_current").first()
    return spark.read.parquet(pointer["current"])


def largest_difference(frame: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Largest absolute difference per column after a write, and rows missing on one side."""
    j = frame.alias("a").join(expected.alias("b"), list(keys), "full_outer")
    lost = F.lit(False)
    for c in columns:
        lost = lost | (F.col(f"a.{c}").isNull() != F.col(f"b.{c}").isNull())
    return j.agg(F.count_if(lost).alias("unmatched"), *[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in columns])


def reusable(fingerprint: DataFrame, stored: DataFrame) -> bool:
    """Whether a derived table may be reused: its inputs have the stored fingerprint."""
    return fingerprint.exceptAll(stored).isEmpty() and stored.exceptAll(fingerprint).isEmpty()
