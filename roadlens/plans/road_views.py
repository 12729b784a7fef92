"""Road tables derived from the driver's tables.

The driver offers no road data, so every input of the queries is a deterministic view of its
tables.  The text runs unchanged in Spark and in DuckDB: Spark reads the view as the input of an
operator, the check SQL uses it as a common table expression.  All views cover the whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.plans import sample_views

TABLES = ["supplier", "part", "orders", "lineitem", "embeddings"]

_PERIOD = "CASE (l_linenumber - 1) % 4 WHEN 0 THEN 'am' WHEN 1 THEN 'md' WHEN 2 THEN 'pm' ELSE 'nt' END"

_PERF = """
SELECT {period} AS time_period,
       CAST(l_suppkey + 1 AS BIGINT) AS from_node_id,
       CAST(l_partkey + 10001 AS BIGINT) AS to_node_id,
       CAST(sum(l_quantity) AS DOUBLE) AS volume,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS mod_vol_trk,
       CAST(17 + l_partkey % 59 AS DOUBLE) * (1 - 8 * max(l_discount)) AS speed_mph,
       CAST((l_suppkey + l_partkey) % 5 AS DOUBLE) / 2 AS "Severe_Congestion_P"
FROM lineitem {where}
GROUP BY (l_linenumber - 1) % 4, l_suppkey, l_partkey
"""

VIEWS: dict[str, str] = {
    "periods": """
SELECT * FROM (VALUES ('am', 0, 360, 540, 360), ('md', 1, 540, 900, 540),
                      ('pm', 2, 900, 1140, 900), ('nt', 3, 1140, 360, 1140))
  AS t(time_period, period_index, period_start, period_end, timeline_start)
""",
    "grid": """
SELECT time_period, explode(sequence(a, b, 5)) AS minute
FROM (VALUES ('am', 360, 539), ('md', 540, 899), ('pm', 900, 1139), ('nt', 1140, 1439)) AS t(time_period, a, b)
""",
    "link": """
SELECT CAST(l.l_suppkey + 1 AS BIGINT) AS from_node_id,
       CAST(l.l_partkey + 10001 AS BIGINT) AS to_node_id,
       CAST((l.l_suppkey + 1) * 4294967296 + l.l_partkey + 10001 AS BIGINT) AS link_id,
       CAST(s.s_nationkey % 10 + 1 AS INT) AS district_id,
       CAST(1400 + (l.l_suppkey * 37 + l.l_partkey) % 1500 AS INT) AS "TAZ",
       CAST(100 * (l.l_partkey % 6 + 1) + (l.l_suppkey + l.l_partkey) % 7 AS INT) AS link_type,
       CAST((l.l_suppkey + l.l_partkey) % 7 AS INT) AS "FT",
       CAST(p.p_size AS DOUBLE) / 10 AS length_in_mile,
       CAST(17 + l.l_partkey % 59 AS DOUBLE) AS free_speed,
       CAST(1 + l.l_suppkey % 4 AS INT) AS lanes,
       CAST(600 + 100 * (l.l_partkey % 15) AS INT) AS capacity,
       CAST(l.l_partkey % 5 AS INT) AS "TOLLGRP",
       CAST((l.l_suppkey + l.l_partkey) % 4 AS INT) AS period_limit,
       CASE WHEN l.l_partkey % 17 = 0 THEN 'closed' WHEN (l.l_suppkey + l.l_partkey) % 4 = 2 THEN 'hov2;hov3'
            ELSE 'sov;hov2;hov3;trk;apv;com' END AS allowed_use,
       p.p_name AS "STREETNAME"
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) l
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN part p ON p.p_partkey = l.l_partkey
""",
    "link_performance": _PERF.format(period=_PERIOD, where=""),
    "link_performance_nb": _PERF.format(period=_PERIOD, where="WHERE l_linestatus = 'O'"),
    # persons by resident district and mode; a fifth of the orders belong to the next district
    "persons": f"""
SELECT {_PERIOD} AS time_period,
       CAST(l_suppkey + 1 AS BIGINT) AS from_node_id,
       CAST(l_partkey + 10001 AS BIGINT) AS to_node_id,
       CAST(CASE WHEN l_orderkey % 5 = 0 THEN (s_nationkey + 1) % 10 + 1 ELSE s_nationkey % 10 + 1 END AS INT) AS person_district,
       CASE l_orderkey % 7 WHEN 0 THEN 'sov' WHEN 1 THEN 'hov2' WHEN 2 THEN 'hov3' WHEN 3 THEN 'com'
            WHEN 4 THEN 'trk' ELSE 'apv' END AS mode,
       CAST(l_quantity AS DOUBLE) AS persons
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
""",
    # long five-minute speeds of every link and period
    "link_speed": """
SELECT f.time_period, f.from_node_id, f.to_node_id, g.minute,
       f.speed_mph * (0.7 + 0.05 * ((f.from_node_id * 7 + f.to_node_id * 13 + g.minute) % 11)) AS speed_mph
FROM link_performance f JOIN grid g ON g.time_period = f.time_period
""",
}
_NEEDS = {"link_speed": ["link_performance", "grid"]}
# The same table with its keys computed before they are grouped by: Spark then knows that the rows lie by the keys, and joins by
# them do not shuffle again.
_PERF_SPARK = """
SELECT time_period, from_node_id, to_node_id, CAST(sum(l_quantity) AS DOUBLE) AS volume,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS mod_vol_trk,
       CAST(17 + (to_node_id - 10001) % 59 AS DOUBLE) * (1 - 8 * max(l_discount)) AS speed_mph,
       CAST((from_node_id + to_node_id - 10002) % 5 AS DOUBLE) / 2 AS "Severe_Congestion_P"
FROM (SELECT {hint} {period} AS time_period, CAST(l_suppkey + 1 AS BIGINT) AS from_node_id, CAST(l_partkey + 10001 AS BIGINT) AS to_node_id,
             l_quantity, l_linestatus, l_discount FROM lineitem {where}) AS item
GROUP BY time_period, from_node_id, to_node_id
"""
_SPARK = {
    "link_performance": _PERF_SPARK.format(period=_PERIOD, where="", hint=""),
    "link_performance_nb": _PERF_SPARK.format(period=_PERIOD, where="WHERE l_linestatus = 'O'", hint=""),
}
# The items of a link meet first, for what goes on to group by links: all its periods then lie in one partition.
_BY_LINK = _SPARK | {"link_performance": _PERF_SPARK.format(period=_PERIOD, where="", hint="/*+ REPARTITION(from_node_id, to_node_id) */")}
_DUCK = {
    "grid": """
SELECT time_period, CAST(unnest(range(a, b + 1, 5)) AS INT) AS minute
FROM (VALUES ('am', 360, 539), ('md', 540, 899), ('pm', 900, 1139), ('nt', 1140, 1439)) AS t(time_period, a, b)
""",
}


def add_view(name: str, sql: str, needs: list[str] | None = None, duck: str | None = None) -> None:
    VIEWS[name] = sql
    if needs:
        _NEEDS[name] = needs
    if duck:
        _DUCK[name] = duck


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in _NEEDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def check_sql(names: str, body: str, ctes: str = "") -> str:
    """One DuckDB statement: the named views (space-separated), extra CTEs, and the body."""
    parts = [f"{n} AS ({_DUCK.get(n, VIEWS[n]).strip()})" for n in _ordered(names.split())]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def road(spark: SparkSession, sf_dir: str, name: str, by_link: bool = False) -> DataFrame:
    """The view as a Spark table over the driver's parquet files; `by_link`: the same rows, those of a link together."""
    if name in sample_views.VIEWS:
        return sample_views.with_samples(road(spark, sf_dir, "link_performance", by_link), name)
    names, spark_text = _ordered([name]), _BY_LINK if by_link else _SPARK
    text = "WITH " + ",\n".join(f"{n} AS ({spark_text.get(n, VIEWS[n]).strip()})" for n in names) + f"\nSELECT * FROM {name}"
    text = re.sub(r'"(\w+)"', r"`\1`", text)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b{t}\b", text)}
    text = re.sub(r"[{}]", lambda m: m.group(0) * 2, text)
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **used)


def settle(frame: DataFrame, digits: int) -> DataFrame:
    """Round doubles for the comparison with the check SQL.

    A nudge of a thousandth of the last digit decides exact ties the same way in both engines.
    """
    names = [f.name for f in frame.schema.fields if f.dataType.simpleString() == "double"]
    return frame.withColumns({n: F.round(F.col(n) + F.lit(float(f"1e-{digits + 3}")), digits) for n in names})


def settled(names: list[str], digits: int) -> str:
    """The same rounding as SQL select items."""
    return ", ".join(f'{tie(chr(34) + n + chr(34), digits)} AS "{n}"' for n in names)


def tie(expression: str, digits: int) -> str:
    return f"round({expression} + 1e-{digits + 3}, {digits})"
