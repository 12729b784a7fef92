"""Readers of the period files: location, scan, headers, corridor catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.columns import number, text_flag
from roadlens.operators.quality import QualityError, duplicate_keys, enforce, require_columns

# Where a period's file may lie below the root, first hit wins ({p} period, {f} file,
# {stem} file without its ending).
LAYOUTS = ["{p}/{f}", "{p}/{p}_origIDs/{f}", "{p}_origIDs/{f}", "{stem}_{p}.csv", "Outputs/{out}/{stem}_{p}.csv"]
CATALOG_FILE = "06-qvdf-calibration/primary_qvdf_fit_catalog.csv"
REFERENCE_FILE = "01-input-and-qc/link_reference.csv"
CATALOG_COLUMNS = ["corridor", "sensor_uid", "calibration_period", "status", "n_episodes", "n", "s", "f_p", "f_d", "alpha", "beta"]
FIT_OF_PARAMETER = {"n": "n", "s": "s", "cp": "f_p", "cd": "f_d", "alpha": "alpha", "beta": "beta"}


def candidate_paths(root: str, period: str, file: str, outputs: str = "*") -> list[str]:
    stem = file.rsplit(".", 1)[0]
    return [f"{root.rstrip('/')}/{t.format(p=period.lower(), f=file, stem=stem, out=outputs)}" for t in LAYOUTS]


def resolve_period_file(spark: SparkSession, root: str, period: str, file: str, outputs: str = "*") -> str:
    """First existing layout, on whatever file system the path names.

    ``outputs`` is the folder of the run below ``Outputs``; without it there must be only one.
    """
    tried = candidate_paths(root, period, file, outputs)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in tried:
        p = jvm.org.apache.hadoop.fs.Path(path)
        hits = p.getFileSystem(conf).globStatus(p)
        if hits is not None and len(hits) > 1:
            raise QualityError(f"more than one {file} for period {period}: {', '.join(h.getPath().toString() for h in hits)}")
        if hits is not None and len(hits) > 0:
            return hits[0].getPath().toString()
    raise FileNotFoundError(f"no {file} for period {period}; tried: {', '.join(tried)}")


def read_period_tables(spark: SparkSession, root: str, periods: Sequence[str], file: str, outputs: str = "*") -> DataFrame:
    """One table over the files of all periods, tagged with the lower-case period.

    Columns are matched by name, a column only some periods have is NULL elsewhere; an empty file
    fails.
    """
    out: DataFrame | None = None
    for period in periods:
        path = resolve_period_file(spark, root, period, file, outputs)
        one = spark.read.option("header", True).csv(path)
        if one.isEmpty():
            raise QualityError(f"file is empty: {path}")
        one = one.withColumn("time_period", F.lit(period.lower()))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no period given")
    return out


def typed(frame: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Lenient casts of the named columns; bad text becomes NULL."""
    def cast(name: str, kind: str):
        return number(name) if kind == "double" else number(name).cast(kind) if kind in ("int", "bigint") else F.col(name).cast(kind)
    return frame.withColumns({n: cast(n, k) for n, k in kinds.items() if n in frame.columns})


def corridor_fits(spark: SparkSession, root: str) -> DataFrame:
    """Accepted corridor fits, long: (corridor, time_period, n_episodes, parameters, source_catalog).

    All catalogs are one scan; duplicates of corridor and period and non-finite values fail.
    """
    raw = spark.read.option("header", True).csv(f"{root.rstrip('/')}/*/{CATALOG_FILE}")
    require_columns(raw, CATALOG_COLUMNS, "corridor catalog")
    low = lambda c: F.lower(F.trim(F.col(c)))
    accepted = raw.withColumn("source_catalog", F.col("_metadata.file_path")).where(
        (low("sensor_uid") == "all") & (low("status") == "ok") & low("calibration_period").isin("am", "md", "pm"))
    fits = accepted.select(
        F.trim("corridor").alias("corridor"), low("calibration_period").alias("time_period"), number("n_episodes").alias("n_episodes"),
        *[number(src).alias(k) for k, src in FIT_OF_PARAMETER.items()], "source_catalog")
    if fits.isEmpty():
        raise QualityError(f"no accepted corridor calibration under {root}")
    enforce(duplicate_keys(fits, ["corridor", "time_period"]), "duplicate corridor-period rows")
    gap = F.lit(False)
    for k in FIT_OF_PARAMETER:
        gap = gap | F.col(k).isNull()
    enforce(fits.where(gap).select("corridor", "time_period"), "non-finite corridor calibration")
    return fits


def corridor_pairs(spark: SparkSession, root: str, fits: DataFrame) -> DataFrame:
    """Selected node pairs of accepted corridors: (a, b, corridor, direction, tmc_code)."""
    from roadlens.operators.transfer import corridor_conflicts

    raw = spark.read.option("header", True).csv(f"{root.rstrip('/')}/*/{REFERENCE_FILE}")
    require_columns(raw, ["corridor", "direction", "network_from_node_id", "network_to_node_id",
                          "network_selected_for_node_pair_lookup"], "corridor link reference")
    tmc = F.col("tmc_code") if "tmc_code" in raw.columns else F.lit("")
    rows = raw.where(text_flag("network_selected_for_node_pair_lookup")).select(
        number("network_from_node_id").cast("bigint").alias("a"), number("network_to_node_id").cast("bigint").alias("b"),
        F.trim("corridor").alias("corridor"), "direction", tmc.alias("tmc_code"), F.col("_metadata.file_path").alias("file"))
    rows = rows.where(F.col("a").isNotNull() & F.col("b").isNotNull()).join(fits.select("corridor").distinct(), "corridor", "left_semi")
    enforce(corridor_conflicts(rows), "a node pair maps to more than one corridor")
    # The first folder in order names the pair; within a file the least direction and code.
    first = rows.groupBy("a", "b").agg(F.min(F.struct("file", "corridor", "direction", "tmc_code")).alias("x"))
    return first.select("a", "b", "x.corridor", "x.direction", "x.tmc_code").orderBy("corridor", "a", "b")


def compact_reference(network: DataFrame) -> DataFrame:
    """Only the columns the lineage needs."""
    return network.select(*[c for c in ("A", "B", "ATYPE", "FTYPE", "STREETNAME", "geometry") if c in network.columns])


def ordered(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sort numerically where a column is numeric throughout, else as text (one aggregation decides)."""
    checks = frame.agg(*[F.bool_and(F.col(c).isNull() | number(c).isNotNull()).alias(c) for c in columns]).first()
    return frame.orderBy(*[number(c) if checks[c] else F.col(c).cast("string") for c in columns])
