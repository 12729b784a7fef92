"""Origin-destination demand: dense rows to sparse cells, zone remapping, distinct pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.quality import QualityError, require, unique_by

# Demand names of the matrices and the mode they belong to; modes by period with
# value of time and persons per vehicle (passenger car equivalent is 1 throughout).
LANE_USE_MODE = {"apv": "apv", "com": "com", "hv2": "hov2", "hv3": "hov3", "sov": "sov", "trk": "trk"}
MODES = ["sov", "hov2", "hov3", "com", "trk", "apv"]
OCCUPANCY = [1.0, 2.0, 3.5, 1.0, 1.0, 1.6]
VALUE_OF_TIME = {
    "am": [24, 40, 60, 30, 30, 30],
    "md": [20, 15, 15, 30, 30, 30],
    "pm": [20, 30, 60, 30, 30, 30],
    "nt": [20, 15, 15, 30, 30, 30],
}


def mode_table(spark) -> DataFrame:
    rows = [(p, i + 1, m, float(v), 1.0, o) for p, vots in VALUE_OF_TIME.items()
            for i, (m, v, o) in enumerate(zip(MODES, vots, OCCUPANCY))]
    return spark.createDataFrame(rows, "time_period STRING, mode_type_id INT, mode_type STRING, vot DOUBLE, pce DOUBLE, occ DOUBLE")


def mode_of(matrix_name):
    """``AM_HV2S`` -> hov2; NULL for names of no known mode (transit matrices)."""
    key = F.regexp_extract(F.lower(matrix_name), r"^[a-z]+_([a-z0-9]+?)s?$", 1)
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in LANE_USE_MODE.items() for x in kv]), key)


def require_matrices(present: set[str], period: str) -> None:
    wanted = {f"{period.upper()}_{use.upper()}S" for use in LANE_USE_MODE}
    missing = sorted(wanted - {p.upper() for p in present})
    if missing:
        raise QualityError(f"missing matrices: {', '.join(missing)}")


def od_sparse(matrix: DataFrame, values: str = "values", origin: str = "o_index", keep: list[str] | None = None) -> DataFrame:
    """Cells above zero with 1-based zone ids; one narrow stage over the dense rows."""
    keep = keep or []
    cells = matrix.select(*keep, (F.col(origin) + 1).cast("bigint").alias("o_zone_id"), F.posexplode(values).alias("p", "v"))
    return cells.where(F.col("v") > 0).select(
        *keep, "o_zone_id", (F.col("p") + 1).cast("bigint").alias("d_zone_id"), F.col("v").cast("double").alias("volume"))


def od_remap(od: DataFrame, zones: DataFrame, strict: bool = True) -> DataFrame:
    """Replace both zone ids by the mapped ones.  ``zones`` is (old_zone, new_zone), unique by old.

    ``strict`` fails the job on a zone without a mapping; otherwise such cells keep NULL.
    """
    z = unique_by(zones.select("old_zone", "new_zone"), ["old_zone"], "zone map")
    o = z.select(F.col("old_zone").alias("o_zone_id"), F.col("new_zone").alias("new_o"))
    d = z.select(F.col("old_zone").alias("d_zone_id"), F.col("new_zone").alias("new_d"))
    j = od.join(o, "o_zone_id", "left").join(d, "d_zone_id", "left")
    if strict:
        j = require(j, F.col("new_o").isNotNull() & F.col("new_d").isNotNull(), F.concat(
            F.lit("zone without mapping in "), F.concat_ws("->", F.col("o_zone_id").cast("string"), F.col("d_zone_id").cast("string"))))
    rest = [c for c in od.columns if c not in ("o_zone_id", "d_zone_id")]
    return j.select(F.col("new_o").alias("o_zone_id"), F.col("new_d").alias("d_zone_id"), *rest)


def unmapped_zones(od: DataFrame, zones: DataFrame) -> DataFrame:
    """Zones of either end the map does not know, with the cells and volume they hold."""
    ends = od.select(F.explode(F.array("o_zone_id", "d_zone_id")).alias("old_zone"), "volume")
    per_zone = ends.groupBy("old_zone").agg(F.count("*").alias("cells"), F.sum("volume").alias("volume"))
    return per_zone.join(zones.select("old_zone").distinct(), "old_zone", "left_anti")


def distinct_od(routes: DataFrame, o: str = "o_zone_id", d: str = "d_zone_id") -> DataFrame:
    """Number of distinct zone pairs; -1 when the table has no zone columns.

    Two plain groupings instead of one distinct counter: the pairs are spread over all tasks and
    only the count meets in one.
    """
    if not {o, d} <= set(routes.columns):
        return routes.sparkSession.createDataFrame([(-1,)], "unique_od BIGINT")
    return routes.select(o, d).distinct().agg(F.count("*").alias("unique_od"))
