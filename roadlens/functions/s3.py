"""The three-parameter S-shaped speed-density curve as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import KM_PER_MILE, is_close, positive_of
from roadlens.functions.samples import Made, percentile

# Fallbacks of the parameter chain.
P95_RANGE = (35.0, 85.0)
ASSUMED_VC_SHARE = 0.75
ASSUMED_LANE_CAPACITY = 1800.0
CRITICAL_NAMES = ["speed_at_capacity_mph", "vc_mph", "fd_vc_mph"]
SHAPE_NAMES = ["s3_shape_m", "s3_m"]


def observed_free_speed(speeds: Made | Column) -> Column:
    """95th percentile of the non-negative speeds of a link, kept inside 35..85, 35 if there is none."""
    low, high = P95_RANGE
    return F.coalesce(F.greatest(F.lit(low), F.least(F.lit(high), percentile(speeds, 0.95))), F.lit(low))


def with_parameters(frame: DataFrame, speeds: str = "speeds") -> DataFrame:
    """Free speed, critical speed, shape, lanes, capacity and critical density, each with its source.

    Network columns carry the prefix ``network_``; the generic network free speed is km/h.
    """
    prefixed = [*CRITICAL_NAMES, *[f"network_{n}" for n in CRITICAL_NAMES]]
    shapes = [*SHAPE_NAMES, *[f"network_{n}" for n in SHAPE_NAMES]]
    vf, vf_src = positive_of(frame, [("network_vdf_free_speed_mph", 1.0), ("free_speed_mph", 1.0),
                                     ("network_free_speed", 1 / KM_PER_MILE)])
    vc, vc_src = positive_of(frame, [(n, 1.0) for n in prefixed])
    m, m_src = positive_of(frame, [(n, 1.0) for n in shapes])
    lanes, lanes_src = positive_of(frame, [("network_lanes", 1.0)])
    # The samples are sorted only for the links that need them.
    unknown = vf.isNull() & (vc.isNull() | m.isNull())
    out = frame.withColumns({"__observed": observed_free_speed(F.when(unknown, F.col(speeds))), "__vf": vf, "__vfs": vf_src, "__vc": vc, "__vcs": vc_src, "__m": m, "__ms": m_src,
                             "s3_lanes": F.coalesce(lanes, F.lit(1.0)),
                             "lanes_source": F.coalesce(lanes_src, F.lit("assumed_1_lane"))})
    vf, vc, m = F.col("__vf"), F.col("__vc"), F.col("__m")
    spread = F.pow(F.lit(2.0), 2 / m)
    out = out.withColumns({
        "s3_free_speed": F.coalesce(vf, vc * spread, F.col("__observed")),
        "free_speed_source": F.coalesce(F.col("__vfs"), F.when(vc.isNotNull() & m.isNotNull(), F.lit("derived_from_vc_and_m")),
                                        F.lit("assumed_observed_p95_clipped_35_85_mph")),
    })
    free = F.col("s3_free_speed")
    given = F.when(vc < free, vc)
    derived = F.when(given.isNull() & m.isNotNull(), free / spread)
    derived = F.when((derived > 0) & (derived < free), derived)
    out = out.withColumns({
        "critical_speed_mph": F.coalesce(given, derived, ASSUMED_VC_SHARE * free),
        "critical_speed_source": F.when(given.isNotNull(), F.col("__vcs")).when(derived.isNotNull(), F.lit("derived_from_vf_and_m"))
        .otherwise(F.lit("assumed_0.75_vf")),
    })
    implied = 2 * F.log(F.lit(2.0)) / F.log(free / F.col("critical_speed_mph"))
    out = out.withColumn("__implied", implied)
    fits = F.coalesce(is_close(m, "__implied", 1e-6, 1e-8), F.lit(False))
    cap_own, cap_own_src = positive_of(frame, [("link_capacity", 1.0)])
    cap_net, cap_net_src = positive_of(frame, [("network_capacity", 1.0), ("lane_capacity", 1.0)])
    lanes = F.col("s3_lanes")
    out = out.withColumns({
        "s3_m": F.when(fits, m).otherwise(F.col("__implied")),
        "s3_m_source": F.when(fits, F.col("__ms")).otherwise(F.lit("derived_from_vf_and_vc")),
        "s3_capacity": F.coalesce(cap_own, cap_net * lanes, ASSUMED_LANE_CAPACITY * lanes),
        "capacity_source": F.coalesce(cap_own_src, F.concat(cap_net_src, F.lit("*lanes")), F.lit("assumed_1800_vphpl*lanes")),
    })
    return out.withColumn("critical_density_veh_per_mile", F.col("s3_capacity") / F.col("critical_speed_mph")) \
        .drop("__observed", "__vf", "__vfs", "__vc", "__vcs", "__m", "__ms", "__implied")
