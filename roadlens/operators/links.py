"""Network conversion: period link tables, nodes, districts and capacity adjustment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import geometry as geo
from roadlens.functions.columns import KM_PER_MILE, METRES_PER_MILE, PAIR, number, number_in
from roadlens.operators.quality import QualityError, require, require_columns, unique_by

# Class tables of the network, the closed-use codes, and adjustment factors.
SPEED_BY_CLASS = {
    0: 17, 1: 17, 2: 17, 3: 23, 4: 29, 5: 35, 6: 40, 11: 63, 12: 63, 13: 69, 14: 69, 15: 75, 16: 75,
    21: 40, 22: 40, 23: 52, 24: 52, 25: 58, 26: 58, 31: 40, 32: 40, 33: 46, 34: 46, 35: 46, 36: 52,
    41: 35, 42: 35, 43: 35, 44: 40, 45: 40, 46: 40, 51: 52, 52: 52, 53: 58, 54: 58, 55: 58, 56: 63,
    61: 23, 62: 23, 63: 35, 64: 35, 65: 40, 66: 58,
}
CAPACITY_BY_CLASS = {
    0: 3150, 1: 3150, 2: 3150, 3: 3150, 4: 3150, 5: 3150, 6: 3150, 11: 1900, 12: 1900, 13: 2000, 14: 2000,
    15: 2000, 16: 2000, 21: 600, 22: 800, 23: 960, 24: 960, 25: 1100, 26: 1100, 31: 500, 32: 600, 33: 700,
    34: 840, 35: 900, 36: 900, 41: 500, 42: 500, 43: 600, 44: 800, 45: 800, 46: 800, 51: 1100, 52: 1200,
    53: 1200, 54: 1400, 55: 1600, 56: 1600, 61: 1000, 62: 1000, 63: 1000, 64: 1000, 65: 2000, 66: 2000,
}
USES_BY_LIMIT = {0: "sov;hov2;hov3;trk;apv;com", 1: "sov;hov2;hov3;trk;apv;com", 2: "hov2;hov3", 3: "hov3",
                 4: "sov;hov2;hov3;com;apv", 5: "apv", 6: "", 7: "", 8: "", 9: "closed"}
CAPACITY_FACTOR = {(0, 0): 1.0, (0, 1): 1.05, (1, 0): 1.01, (1, 1): 1.06}
DISTRICT_OF_NAME = {"Arlington": 2, "Alexandria": 1, "Fairfax": 3, "Fairfax City": 4, "Falls Church": 5,
                    "Loudoun": 6, "Prince William": 9, "Manassas": 7, "Manassas Park": 8}
OTHER_DISTRICT = 10
ZONE_BELOW = 10000
PARAMETERS = ["plf", "qdf", "n", "s", "cp", "cd", "alpha", "beta"]
TOLL_MODES = ["sov", "hov2", "hov3", "com", "trk", "apv"]
# Link-type baseline by facility digit, used by the night period and by the simple volume-delay form.
ALPHA_BY_FACILITY = {0: 0.1, 1: 0.87, 2: 0.96, 3: 0.96, 4: 0.96, 5: 0.87, 6: 0.96}
BETA_BY_FACILITY = {0: 2.0, 1: 5.0, 2: 2.3, 3: 2.3, 4: 2.3, 5: 5.0, 6: 2.3}
ALPHA_BETA_ALL = (0.128, 4.96)
NIGHT = {"plf": 1.0, "qdf": 0.090909091, "n": 1.24, "s": 4.0, "cp": 0.24, "cd": 1.0}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def look_up(values: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(values), key)


def period_rows(network: DataFrame, periods: Sequence[str], fields: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per link and period from columns named by a template such as ``{P}LANE``.

    All periods come out of a single pass over the network.
    """
    rows = F.array(*[
        F.struct(F.lit(p).alias("time_period"), *[
            (F.col(t.format(P=p.upper())) if t.format(P=p.upper()) in network.columns else F.lit(None)).cast("string").alias(n)
            for n, t in fields.items()]) for p in periods])
    return network.select(*keep, F.explode(rows).alias("__r")).select(*keep, "__r.*")


def baseline_parameters(code: Column) -> dict[str, Column]:
    """Night parameters of a link-type code, from its facility digit; ``all`` has its own pair."""
    digit = (code.try_cast("int") % 10)
    alpha = F.when(code == "all", F.lit(ALPHA_BETA_ALL[0])).otherwise(look_up(ALPHA_BY_FACILITY, digit))
    beta = F.when(code == "all", F.lit(ALPHA_BETA_ALL[1])).otherwise(look_up(BETA_BY_FACILITY, digit))
    return {**{k: F.lit(v) for k, v in NIGHT.items()}, "alpha": alpha, "beta": beta}


def normal_code(code: Column | str) -> Column:
    """``100.0`` -> ``100``, ``ALL`` -> ``all``, other text trimmed."""
    text = F.trim((F.col(code) if isinstance(code, str) else code).cast("string"))
    as_number = number(text)
    whole = as_number.isNotNull() & (as_number == F.floor(as_number))
    return F.when(F.lower(text) == "all", F.lit("all")).when(whole, as_number.cast("bigint").cast("string")).otherwise(text)


def parameter_table(wide: DataFrame, periods: Sequence[str] = ("am", "md", "pm"), night: str | None = "nt") -> DataFrame:
    """Link-type parameters, long: (vdf_code, time_period, eight parameters).

    Input columns are ``QVDF_<param><n>``.  Wrong row kinds, blank codes, duplicate codes and text in
    a numeric cell fail the job; the night rows come from the baseline.
    """
    require_columns(wide, ["data_type", "vdf_code"], "parameter table")
    rows = wide.withColumn("vdf_code", normal_code("vdf_code"))
    rows = require(rows, F.lower(F.trim("data_type")) == "vdf_code", "unsupported data_type in the parameter table")
    rows = require(rows, F.length("vdf_code") > 0, "blank vdf_code in the parameter table")
    rows = unique_by(rows, ["vdf_code"], "parameter table")
    if rows.where("vdf_code = 'all'").isEmpty():
        raise QualityError("the parameter table has no row `all`")

    def cell(name: str) -> Column:
        if name not in wide.columns:
            return F.lit(None).cast("double")
        text = F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))
        return F.when(text.isNotNull() & text.try_cast("double").isNull(),
                      F.raise_error(F.concat(F.lit(f"non-numeric {name}: "), text)).cast("double")).otherwise(text.try_cast("double"))
    entries = [F.struct(F.lit(p).alias("time_period"), *[cell(f"QVDF_{k}{i + 1}").alias(k) for k in PARAMETERS])
               for i, p in enumerate(periods)]
    if night:
        base = baseline_parameters(F.col("vdf_code"))
        entries.append(F.struct(F.lit(night).alias("time_period"), *[base[k].cast("double").alias(k) for k in PARAMETERS]))
    return rows.select("vdf_code", F.inline(F.array(*entries)))


def simple_parameters(spark, area_types: int = 6) -> DataFrame:
    """The built-in table of the simple volume-delay form, generated from the facility rule."""
    codes = ["0"] + [str(100 * a + f) for a in range(1, area_types + 1) for f in range(7)]
    rows = [(c, 1.0, ALPHA_BY_FACILITY[int(c) % 10], BETA_BY_FACILITY[int(c) % 10]) for c in codes]
    rows.append(("all", 1.0, *ALPHA_BETA_ALL))
    return spark.createDataFrame(rows, "vdf_code STRING, plf DOUBLE, alpha DOUBLE, beta DOUBLE")


def select_parameters(links: DataFrame, table: DataFrame, strict: bool = True) -> DataFrame:
    """Exact link-type row, else the ``all`` row, with the code used as ``vdf_source``.

    The ``all`` rows are one per period (unique by construction), hence the broadcast.
    """
    exact = table.where(F.col("vdf_code") != "all").select(
        F.col("vdf_code").alias("__code"), "time_period", F.struct(*PARAMETERS).alias("__exact"))
    rest = table.where(F.col("vdf_code") == "all").groupBy("time_period").agg(F.any_value(F.struct(*PARAMETERS)).alias("__all"))
    j = links.withColumn("__code", F.col("link_type").cast("string")).join(exact, ["__code", "time_period"], "left")
    j = j.join(F.broadcast(rest), "time_period", "left")
    chosen = F.coalesce("__exact", "__all")
    if strict:
        filled = F.lit(True)
        for k in PARAMETERS:
            filled = filled & chosen[k].isNotNull()
        j = require(j, filled, F.concat(F.lit("parameter missing for link type "), F.col("__code")))
    out = j.withColumn("vdf_source", F.when(F.col("__exact").isNotNull(), F.col("__code")).otherwise(F.lit("all")))
    return out.withColumns({f"vdf_{k}": chosen[k] for k in PARAMETERS}).drop("__code", "__exact", "__all")


def whole_number(rows: DataFrame, name: str) -> Column:
    """Integer value of a cell; text that is not written as an integer (``2.5``, ``2.0``) is NULL."""
    if rows.schema[name].dataType.simpleString() == "string":
        return F.when(F.col(name).rlike(r"^\s*[+-]?[0-9]+\s*$"), number(F.trim(name))).cast("int")
    return number(name).cast("int")


def reject_reason(rows: DataFrame, loops: bool = False) -> Column:
    """Why a period link is refused, first reason only; NULL for an accepted link.

    Rows may carry ``nodes_known``; a link with an unknown end node is refused then.
    """
    lanes, cap, spd = (whole_number(rows, c) for c in ("lane", "CAPCLASS", "SPDCLASS"))
    known = F.col("nodes_known") if "nodes_known" in rows.columns else F.lit(True)
    reasons = [
        ("self_loop", F.lit(False) if loops else F.col("from_node_id") == F.col("to_node_id")),
        ("unknown_node", ~known),
        ("lanes_not_integer", lanes.isNull()),
        ("no_lanes", lanes <= 0),
        ("capacity_class_not_integer", cap.isNull()),
        ("capacity_class_unknown", look_up(CAPACITY_BY_CLASS, cap).isNull()),
        ("speed_class_not_integer", spd.isNull()),
        ("speed_class_unknown", look_up(SPEED_BY_CLASS, spd).isNull()),
    ]
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in reasons])


def period_links(network: DataFrame, periods: Sequence[str], nodes: DataFrame | None = None, loops: bool = False) -> DataFrame:
    """Unpivoted network rows with their reject reason; with ``nodes`` (node_id) both end nodes must be among them.

    A link from a node to itself is refused, as the source does, unless ``loops`` says that the network may have them.
    """
    if nodes is not None:
        ids = nodes.select("node_id").where("node_id IS NOT NULL").distinct()
        for end, mark in zip(PAIR, ("__from", "__to")):
            network = network.join(ids.select(F.col("node_id").alias(end), F.lit(True).alias(mark)), end, "left")
        network = network.withColumn("nodes_known", F.col("__from").isNotNull() & F.col("__to").isNotNull()).drop("__from", "__to")
    keep = ["link_id", *PAIR, "ATYPE", "FTYPE", "CAPCLASS", "SPDCLASS", "DISTANCE",
            *[c for c in ("geometry", "STREETNAME", "TAZ", "order_id", "nodes_known") if c in network.columns]]
    rows = period_rows(network, periods, {"lane": "{P}LANE", "limit": "{P}LIMIT", "toll_cents": "{P}TOLL"}, keep)
    return rows.withColumn("reject_reason", reject_reason(rows, loops)).drop("nodes_known")


def rejected_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("time_period", F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("links"))


def convert_links(network: DataFrame, periods: Sequence[str], parameters: DataFrame, nodes: DataFrame | None = None, loops: bool = False) -> DataFrame:
    """Accepted links of all periods in kernel units, with class values, tolls and parameters.

    An unknown limit code fails the job.  ``loops`` as in ``period_links``.
    """
    rows = period_links(network, periods, nodes, loops).where(F.col("reject_reason").isNull()).drop("reject_reason")
    zero = F.lit(0)
    a, f = (F.coalesce(number(c).cast("int"), zero) for c in ("ATYPE", "FTYPE"))
    limit = F.coalesce(number("limit").cast("int"), zero)
    rows = require(rows, look_up(USES_BY_LIMIT, limit).isNotNull(), "unknown limit code")
    miles = F.coalesce(number("DISTANCE"), F.lit(0.0))
    rows = rows.withColumns({
        "link_type": (100 * a + f).cast("int"),
        "lanes": number("lane").cast("int"),
        "capacity": look_up(CAPACITY_BY_CLASS, number("CAPCLASS").cast("int")),
        "vdf_free_speed_mph": look_up(SPEED_BY_CLASS, number("SPDCLASS").cast("int")),
        "allowed_use": look_up(USES_BY_LIMIT, limit),
        "vdf_length_mi": miles,
        "length": miles * METRES_PER_MILE,
        "toll": F.coalesce(number("toll_cents") / 100, F.lit(0.0)),
        "ref_volume": zero, "ref_cost": zero, "vdf_type": F.lit(2), "qvdf_profile_mode": F.lit(2), "dir_flag": F.lit(1),
    })
    fftt = 60 * F.col("vdf_length_mi") / F.col("vdf_free_speed_mph")
    rows = rows.withColumns({
        "free_speed": F.col("vdf_free_speed_mph") * KM_PER_MILE,
        "vdf_fftt": F.when(fftt > 0, fftt),
        **{f"toll_{m}": F.col("toll") for m in TOLL_MODES},
    }).drop("lane", "limit", "toll_cents", "CAPCLASS", "SPDCLASS", "DISTANCE")
    return select_parameters(rows, parameters)


def drop_old_parameter_columns(frame: DataFrame) -> DataFrame:
    """Without carried columns of the old style: every ``VDF_`` or ``QVDF_`` name that ends in a digit."""
    import re

    return frame.drop(*[c for c in frame.columns if re.fullmatch(r"Q?VDF_.*[0-9]", c)])


def build_nodes(network: DataFrame, order: str = "order_id", wkt: str = "geometry") -> DataFrame:
    """End points of all links; the first occurrence of a node id gives its coordinates.

    An aggregate (``min_by``) per node: links of a hub are combined on the map side.
    """
    line = geo.points(wkt)
    ends = network.select(F.col(order).alias("o"), *PAIR, line.alias("l")).select(F.inline(F.array(
        F.struct(F.col(PAIR[0]).alias("node_id"), (F.col("o") * 2).alias("seq"), geo.first_point(F.col("l")).alias("p")),
        F.struct(F.col(PAIR[1]).alias("node_id"), (F.col("o") * 2 + 1).alias("seq"), geo.last_point(F.col("l")).alias("p")))))
    first = ends.groupBy("node_id").agg(F.min_by("p", "seq").alias("p"))
    return first.select("node_id", F.when(F.col("node_id") < ZONE_BELOW, F.col("node_id")).alias("zone_id"),
                        F.col("p.x").alias("x_coord"), F.col("p.y").alias("y_coord"))


def assign_districts(links: DataFrame, jurisdictions: DataFrame, order: str | None = None) -> DataFrame:
    """Jurisdiction name by zone (-1 unknown) and district id by name (10 otherwise)."""
    name = F.any_value("JUR_NAME") if order is None else F.max_by("JUR_NAME", order)
    by_zone = jurisdictions.groupBy("TAZ").agg(name.alias("JUR_NAME"))
    j = links.drop("JUR_NAME", "district_id").join(by_zone, "TAZ", "left")
    return j.withColumn("JUR_NAME", F.coalesce("JUR_NAME", F.lit("-1"))).withColumn(
        "district_id", F.coalesce(look_up(DISTRICT_OF_NAME, F.col("JUR_NAME")), F.lit(OTHER_DISTRICT)))


def node_districts(nodes: DataFrame, links: DataFrame, order: str) -> DataFrame:
    """District of a node: that of the last link leaving it, -1 when none does."""
    last = links.groupBy(F.col(PAIR[0]).alias("node_id")).agg(F.max_by("district_id", order).alias("district_id"))
    return nodes.drop("district_id").join(last, "node_id", "left").withColumn("district_id", F.coalesce("district_id", F.lit(-1)))


def adjust_capacity(links: DataFrame) -> DataFrame:
    """Capacity factor by the ITS and intersection flags; rows with other flag values are dropped.

    With one flag missing from the table its value counts as 0.  Without both nothing changes.
    """
    flags = [c for c in ("ITS", "INTERSECTI") if c in links.columns]
    if not flags:
        return links
    its, inter = (number_in(links, c) if c in flags else F.lit(0.0) for c in ("ITS", "INTERSECTI"))
    factor = F.coalesce(*[F.when((its == a) & (inter == b), F.lit(v)) for (a, b), v in CAPACITY_FACTOR.items()])
    return links.withColumn("__f", factor).where(F.col("__f").isNotNull()) \
        .withColumn("capacity", F.col("capacity") * F.col("__f")).drop("__f")


def dense_link_ids(links: DataFrame) -> DataFrame:
    """Link ids 1..N in the order of the pair, without gathering the table in one task.

    Rows are range-partitioned by the pair; counts of the partitions (one row each) give offsets.
    The ranges come from a sample, so they are fixed by a checkpoint before they are used twice.
    """
    from pyspark.sql import Window as W

    from roadlens.session import cut_lineage

    ranged = cut_lineage(links.repartitionByRange(*PAIR).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    offsets = sizes.withColumn("__before", F.coalesce(
        F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    local = F.row_number().over(W.partitionBy("__part").orderBy(*PAIR))
    return ranged.withColumn("__rank", local).join(F.broadcast(offsets), "__part") \
        .withColumn("link_id", (F.col("__before") + F.col("__rank")).cast("bigint")).drop("__part", "__rank", "__before")
