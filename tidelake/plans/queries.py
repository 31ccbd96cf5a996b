"""The registered queries of the reference's operators, each with the SQL that it must equal.

The driver's tables stand in for series: `lineitem` for a multi-year one (node
l_suppkey, instant l_shipdate, value l_extendedprice, a file a year), `events` for
an hourly one (node user_id), keys of `customer` and `supplier` for positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import calendars as C
from tidelake.functions import geo, naming
from tidelake.operators import extract as X
from tidelake.operators import periods, spatial, stations, tides
from tidelake.plans.metadata import resolved

QUERIES: dict = {}
SQL: dict[str, str] = {}

L = "SELECT l_suppkey AS node_id, CAST(year(l_shipdate) AS INTEGER) AS file_year, CAST(date_diff('microsecond', TIMESTAMP '1900-01-01', l_shipdate) AS DOUBLE) / 3.6e9 AS time_h, l_shipdate AS ts, l_extendedprice AS value FROM lineitem"
E = "SELECT user_id AS node_id, CAST(year(ts) AS INTEGER) AS file_year, CAST(date_diff('microsecond', TIMESTAMP '1900-01-01', ts) AS DOUBLE) / 3.6e9 AS time_h, ts, value, event_type FROM events"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def years(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("node_id"), F.year(ts).alias("file_year"), C.hours_since_epoch(ts).alias("time_h"), F.col("l_extendedprice").alias("value"))


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("node_id"), F.year("ts").alias("file_year"), C.hours_since_epoch(F.col("ts")).alias("time_h"), "value", "ts", "event_type")


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


DAY = """WITH s AS ({series}), d AS (SELECT *, CAST({shift} AS DATE) AS day FROM s)
SELECT node_id, CAST(year(day) AS INTEGER) AS y, CAST(month(day) AS INTEGER) AS m, CAST(day(day) AS INTEGER) AS d, max(value) AS value, round(min_by(time_h, (-value, time_h)), 6) AS time_h FROM d GROUP BY node_id, day"""


@query(DAY.format(series=E, shift="ts"))
def daily_max(spark, sf_dir):
    return rounded(periods.daily_max(hours(spark, sf_dir), check=False), "time_h")


@query(DAY.format(series=E, shift="ts - INTERVAL 1 SECOND"))
def daily_max_end_convention(spark, sf_dir):
    return rounded(periods.daily_max(hours(spark, sf_dir), convention="end", check=False), "time_h")


@query(DAY.format(series=L, shift="ts"))
def daily_max_years(spark, sf_dir):
    return rounded(periods.daily_max(years(spark, sf_dir)), "time_h")


@query(f"""WITH s AS ({L}) SELECT node_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, max(value) AS value, min_by(time_h, (-value, time_h)) AS time_h FROM s GROUP BY ALL""")
def monthly_max_raw(spark, sf_dir):
    return periods.monthly_max_raw(years(spark, sf_dir))


FOLD = f"""WITH RECURSIVE s AS ({L}), ranked AS (
  SELECT node_id AS k, year(ts) * 12 + month(ts) - 1 AS ym, value AS v, time_h AS h, row_number() OVER (PARTITION BY node_id, year(ts) * 12 + month(ts) ORDER BY value DESC, time_h) AS rn FROM s
), g AS (SELECT k, ym, list(v ORDER BY rn) AS vs, list(h ORDER BY rn) AS hs FROM ranked WHERE rn <= 11 GROUP BY k, ym
), mon AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ym) AS i, count(*) OVER (PARTITION BY k) AS n FROM g
), pr AS (SELECT a.k, a.i, a.vs AS pv, a.hs AS ph, b.vs AS cv, b.hs AS ch FROM mon a JOIN mon b ON a.k = b.k AND b.i = a.i + 1
), st AS (
  SELECT k, i, 0 AS it, 1 AS pp, 1 AS cp, coalesce(abs(ch[1] - ph[1]) < 168, false) AS viol, pv[1] <= cv[1] AS lp FROM pr WHERE i = 1
  UNION ALL
  SELECT z.k, z.i, z.it, z.pp, z.cp, z.it < 5 AND coalesce(abs(p.ch[z.cp] - p.ph[z.pp]) < 168, false), p.pv[z.pp] <= p.cv[z.cp] FROM (
    SELECT k, CASE WHEN viol THEN i ELSE i + 1 END AS i, CASE WHEN viol THEN it + 1 ELSE 0 END AS it,
      CASE WHEN viol THEN CASE WHEN lp THEN pp + 1 ELSE pp END ELSE cp END AS pp, CASE WHEN viol THEN CASE WHEN lp THEN cp ELSE cp + 1 END ELSE 1 END AS cp FROM st) z
  JOIN pr p ON p.k = z.k AND p.i = z.i
), ptr AS (
  SELECT k, i, pp AS pos FROM st WHERE NOT viol
  UNION ALL SELECT st.k, st.i + 1, st.cp FROM st JOIN mon ON mon.k = st.k AND mon.i = st.i AND mon.n = st.i + 1 WHERE NOT viol
  UNION ALL SELECT k, i, 1 FROM mon WHERE n = 1
), fin AS (SELECT m.k, m.ym, m.vs[p.pos] AS value, m.hs[p.pos] AS time_h, p.pos FROM mon m JOIN ptr p ON p.k = m.k AND p.i = m.i)
"""


@query(FOLD + "SELECT k AS node_id, CAST(ym // 12 AS INTEGER) AS y, CAST(ym % 12 + 1 AS INTEGER) AS m, value, time_h, pos > 1 AS adjusted, CAST(pos - 1 AS INTEGER) AS n_excluded FROM fin")
def monthly_max_separated(spark, sf_dir):
    return periods.monthly_max(years(spark, sf_dir), hours=168.0).drop("residual_violation")


@query(FOLD + "SELECT CAST(sum(pos - 1) AS BIGINT) AS n_events, CAST(count(*) FILTER (pos > 1) AS BIGINT) AS n_node_months FROM fin")
def monthly_adjustment_counts(spark, sf_dir):
    return periods.adjustment_counts(periods.monthly_max(years(spark, sf_dir), hours=168.0))


@query(f"""WITH s AS ({L}), r AS (SELECT node_id, year(ts) AS y, month(ts) AS m, value, time_h, row_number() OVER (PARTITION BY node_id, year(ts), month(ts) ORDER BY value DESC, time_h) AS rank FROM s)
SELECT node_id, CAST(y AS INTEGER) AS y, CAST(m AS INTEGER) AS m, CAST(rank AS INTEGER) AS rank, value, time_h FROM r WHERE rank <= 11""")
def top_values_per_month(spark, sf_dir):
    got = periods.month_candidates(years(spark, sf_dir)).select("node_id", "ym", F.explode("cands").alias("c"))
    return got.select("node_id", F.floor(F.col("ym") / 12).cast("int").alias("y"), (F.pmod("ym", F.lit(12)) + 1).cast("int").alias("m"), F.col("c.__rank").alias("rank"), F.col("c.v").alias("value"), F.col("c.h").alias("time_h"))


SHIFTED = f"""WITH s AS ({L}), t AS (SELECT node_id, file_year, time_h + 24 AS time_h, ts + INTERVAL 1 DAY AS ts, value FROM s),
f AS (SELECT file_year, max(time_h) AS last, lead(file_year) OVER (ORDER BY file_year) AS nxt FROM t GROUP BY file_year),
o AS (SELECT t.*, CASE WHEN t.time_h = last AND month(ts) = 1 AND day(ts) = 1 AND CAST(ts AS TIME) = TIME '00:00:00' THEN true ELSE false END AS moved, nxt FROM t JOIN f USING (file_year)),
w AS (SELECT *, CASE WHEN moved THEN coalesce(nxt, file_year) ELSE file_year END AS owner_file, moved AND nxt IS NULL AS orphan FROM o)
"""


def _shifted(spark, sf_dir) -> DataFrame:
    return years(spark, sf_dir).withColumn("time_h", F.col("time_h") + 24)


@query(SHIFTED + "SELECT file_year, owner_file, orphan, count(*) AS n, max(value) AS value FROM w GROUP BY ALL")
def year_boundary_carry(spark, sf_dir):
    return periods.with_owner(_shifted(spark, sf_dir)).groupBy("file_year", "owner_file", "orphan").agg(F.count("*").alias("n"), F.max("value").alias("value"))


@query(SHIFTED.replace("ts + INTERVAL 1 DAY AS ts, value FROM s)", "ts + INTERVAL 1 DAY AS ts, value FROM s UNION ALL SELECT node_id, file_year, time_h + 12, ts + INTERVAL 12 HOUR, value FROM s)") + ", d AS (SELECT *, CAST(CASE WHEN orphan THEN ts ELSE ts - INTERVAL 1 SECOND END AS DATE) AS day FROM w) SELECT CAST(year(day) AS INTEGER) AS y, CAST(month(day) AS INTEGER) AS m, CAST(day(day) AS INTEGER) AS d, count(DISTINCT (owner_file, orphan)) AS n_files FROM d GROUP BY day HAVING count(DISTINCT (owner_file, orphan)) > 1")
def duplicate_periods(spark, sf_dir):
    noon = years(spark, sf_dir).withColumn("time_h", F.col("time_h") + 12)
    dated = periods._dated(_shifted(spark, sf_dir).unionByName(noon), None, "end")
    return periods.duplicate_periods(dated, "day").select("day.y", "day.m", "day.d", "n_files")


@query(f"""WITH s AS ({L}), b AS (SELECT *, (SELECT min(time_h) FROM s) AS f FROM s), g AS (SELECT *, CAST(floor((time_h - f) / 72) AS BIGINT) AS block FROM b)
SELECT node_id, block, max(value) AS value, min_by(time_h, (-value, time_h)) AS time_h, f + (block + 0.5) * 72 AS center_h FROM g GROUP BY node_id, block, f""")
def block_max_72h(spark, sf_dir):
    return periods.block_max(years(spark, sf_dir))


@query(f"WITH s AS ({E}) SELECT node_id, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS value FROM s GROUP BY ALL")
def hourly_resample_mean(spark, sf_dir):
    return rounded(stations.hourly_mean(hours(spark, sf_dir), ["node_id"]).withColumn("hour", F.col("hour").cast("timestamp_ntz")), "value")


SKILL = """WITH s AS ({series}), m AS (SELECT {keys} date_trunc('hour', ts) AS hour, avg(value) AS m FROM s WHERE event_type = 'view' GROUP BY ALL),
o AS (SELECT {keys} date_trunc('hour', ts) AS hour, avg(value) AS o FROM s WHERE event_type = 'click' GROUP BY ALL),
b AS (SELECT {keys} m, o, m - o AS d FROM m JOIN o USING ({keys} hour))
SELECT {keys} count(*) AS n, round(avg(d), 4) AS bias, round(sqrt(avg(d * d)), 4) AS rmse, round(corr(m, o), 4) AS corr, round(CASE WHEN stddev_pop(o) > 0 THEN sqrt(avg(d * d)) / stddev_pop(o) END, 4) AS scatter_index,
round(avg(m), 4) AS mean_model, round(avg(o), 4) AS mean_obs, round(stddev_pop(m), 4) AS std_model, round(stddev_pop(o), 4) AS std_obs FROM b {group} HAVING count(*) >= 24"""


def _skill(spark, sf_dir, keys: list[str]) -> DataFrame:
    s = hours(spark, sf_dir)
    part = lambda kind: stations.hourly_mean(s.filter(F.col("event_type") == kind), keys)
    return stations.skill(part("view"), part("click"), keys)


@query(SKILL.format(series=E, keys="", group=""))
def skill_metrics(spark, sf_dir):
    return _skill(spark, sf_dir, [])


@query(SKILL.format(series=E.replace("user_id AS node_id", "user_id % 5 AS node_id"), keys="node_id,", group="GROUP BY node_id"))
def skill_by_node(spark, sf_dir):
    s = hours(spark, sf_dir).withColumn("node_id", F.col("node_id") % 5)
    part = lambda kind: stations.hourly_mean(s.filter(F.col("event_type") == kind), ["node_id"])
    return stations.skill(part("view"), part("click"), ["node_id"])


@query(f"WITH s AS ({L}) SELECT node_id, time_h, value FROM s WHERE ts BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1998-02-28'")
def date_clip(spark, sf_dir):
    return X.clip(years(spark, sf_dir), "1997-03-01", "1998-02-28").select("node_id", "time_h", "value")


@query(f"WITH s AS ({E}), v AS (SELECT node_id, CASE WHEN value > 100 THEN -99999 ELSE value END AS value FROM s) SELECT node_id, count(*) AS n, count(*) FILTER (value < -9999) AS n_dry, round(max(CASE WHEN value >= -9999 THEN value END), 6) AS value FROM v GROUP BY node_id")
def sentinel_to_null(spark, sf_dir):
    v = X.dry_to_null(F.when(F.col("value") > 100, F.lit(-99999.0)).otherwise(F.col("value")))
    rows = hours(spark, sf_dir).select("node_id", v.alias("value"))
    return rounded(rows.groupBy("node_id").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("n_dry"), F.max("value").alias("value")), "value")


@query(f"WITH s AS ({E}) SELECT node_id, count(*) AS n, round(sum(value), 4) AS total FROM s WHERE event_type <> 'error' AND value <> 0 GROUP BY node_id")
def qc_filter(spark, sf_dir):
    obs = hours(spark, sf_dir).select("node_id", F.nullif("value", F.lit(0.0)).alias("sea_level"), (F.col("event_type") != "error").cast("int").alias("use_flag"))
    return rounded(stations.quality_filter(obs).groupBy("node_id").agg(F.count("*").alias("n"), F.sum("sea_level").alias("total")), "total", places=4)


@query("""WITH r AS (SELECT o_custkey AS node_id, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY o_custkey),
t AS (SELECT node_id, CASE WHEN node_id % 7 = 0 THEN '' WHEN node_id % 5 = 0 THEN 'unknown' ELSE strftime(s, '%Y/%m/%d') END AS start_date, strftime(e, '%Y/%m/%d') AS end_date FROM r)
SELECT node_id, start_date, end_date FROM t WHERE start_date <> '' AND (start_date = 'unknown' OR strptime(start_date, '%Y/%m/%d') <= TIMESTAMP '1996-06-30' AND strptime(end_date, '%Y/%m/%d') >= TIMESTAMP '1996-01-01')
  AND NOT (start_date = 'unknown' AND strptime(end_date, '%Y/%m/%d') < TIMESTAMP '1996-01-01')""")
def station_overlap(spark, sf_dir):
    r = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("node_id")).agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    form = lambda c: F.date_format(c, "yyyy/MM/dd")
    start = F.when(F.col("node_id") % 7 == 0, "").when(F.col("node_id") % 5 == 0, "unknown").otherwise(form("s"))
    t = r.select("node_id", start.alias("start_date"), form("e").alias("end_date"))
    return t.filter(stations.overlaps(F.col("start_date"), F.col("end_date"), F.lit("1996-01-01").cast("timestamp"), F.lit("1996-06-30").cast("timestamp")))


POINTS = "SELECT c_custkey AS point_id, (c_custkey * 37 % 3600) / 10.0 - 180 AS lon, (c_custkey * 53 % 1300) / 10.0 - 65 AS lat FROM customer"
MESH = "SELECT s_suppkey AS node_index, (s_suppkey * 71 % 3600) / 10.0 - 180 AS lon, (s_suppkey * 29 % 1300) / 10.0 - 65 AS lat, CAST(s_suppkey % 50 AS DOUBLE) AS depth FROM supplier"
XYZ = "6371.0 * cos(radians(lat)) * cos(radians(lon)) AS x, 6371.0 * cos(radians(lat)) * sin(radians(lon)) AS y, 6371.0 * sin(radians(lat)) AS z"
NEAREST = f"""WITH p AS (SELECT *, {XYZ} FROM ({POINTS})), m AS (SELECT *, {XYZ} FROM ({MESH}) {{wet}}), c AS (
  SELECT p.point_id, m.node_index, sqrt((p.x - m.x) ** 2 + (p.y - m.y) ** 2 + (p.z - m.z) ** 2) AS d FROM p, m),
n AS (SELECT point_id, arg_min(node_index, (d, node_index)) AS node_index, min(d) AS d FROM c GROUP BY point_id)
"""


def _positions(df: DataFrame, key: str, name: str, a: int, b: int) -> DataFrame:
    k = F.col(key)
    return df.select(k.alias(name), ((k * a % 3600) / 10.0 - 180).alias("lon"), ((k * b % 1300) / 10.0 - 65).alias("lat"))


def points_of(spark, sf_dir) -> DataFrame:
    return _positions(table(spark, sf_dir, "customer"), "c_custkey", "point_id", 37, 53)


def mesh_of(spark, sf_dir) -> DataFrame:
    return _positions(table(spark, sf_dir, "supplier"), "s_suppkey", "node_index", 71, 29).withColumn("depth", (F.col("node_index") % 50).cast("double"))


@query(NEAREST.format(wet="") + "SELECT point_id, node_index, round(d, 6) AS dist_km FROM n")
def nearest_node(spark, sf_dir):
    got = spatial.nearest(points_of(spark, sf_dir), mesh_of(spark, sf_dir), max_km=1e6, cell_km=200.0)
    return rounded(got.select("point_id", "node_index", "dist_km"), "dist_km")


@query(NEAREST.format(wet="") + "SELECT point_id, CASE WHEN d <= 500 THEN node_index ELSE -1 END AS node_index, round(d, 6) AS dist_km FROM n")
def nearest_node_within(spark, sf_dir):
    got = spatial.nearest(points_of(spark, sf_dir), mesh_of(spark, sf_dir), max_km=500.0, cell_km=200.0)
    return rounded(got.select("point_id", "node_index", "dist_km"), "dist_km")


@query(NEAREST.format(wet="WHERE node_index % 3 <> 0") + "SELECT point_id, node_index, round(d, 6) AS dist_km FROM n")
def nearest_wet_node(spark, sf_dir):
    mesh = mesh_of(spark, sf_dir)
    wet = spatial.wet_only(mesh, mesh.select("node_index", (F.col("node_index") % 3 != 0).alias("always_wet")))
    return rounded(spatial.nearest(points_of(spark, sf_dir), wet, max_km=1e6, cell_km=200.0).select("point_id", "node_index", "dist_km"), "dist_km")


@query(NEAREST.format(wet="") + "SELECT round(median(d), 6) AS median_km, round(max(d), 6) AS max_km, count(*) FILTER (d > 100) AS n_far FROM n")
def match_distance_stats(spark, sf_dir):
    got = spatial.nearest(points_of(spark, sf_dir), mesh_of(spark, sf_dir), max_km=1e6, cell_km=200.0)
    return rounded(spatial.match_stats(got), "median_km", "max_km")


@query(NEAREST.format(wet="") + f", s AS ({L}) SELECT n.point_id AS node_id, count(*) AS n, round(max(CAST(s.value AS FLOAT)), 2) AS value FROM n JOIN s ON s.node_id = n.node_index GROUP BY n.point_id")
def node_gather(spark, sf_dir):
    nodes = spatial.match_points(points_of(spark, sf_dir), mesh_of(spark, sf_dir))
    got = X.extract(years(spark, sf_dir).withColumnRenamed("node_id", "node_index"), nodes)
    return got.groupBy("node_id").agg(F.count("*").alias("n"), F.round(F.max("value"), 2).alias("value"))


@query(f"WITH s AS ({L}), k AS (SELECT node_index FROM ({MESH}) WHERE node_index % 3 = 0) SELECT node_id AS node_index, count(*) AS n, round(sum(value), 2) AS total FROM s WHERE node_id IN (SELECT node_index FROM k) GROUP BY node_id")
def sparse_gather(spark, sf_dir):
    nodes = mesh_of(spark, sf_dir).filter("node_index % 3 = 0")
    got = X.extract_sparse(years(spark, sf_dir).withColumnRenamed("node_id", "node_index"), nodes)
    return got.groupBy("node_index").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(f"SELECT point_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM (SELECT *, {XYZ} FROM ({POINTS}))")
def ecef_project(spark, sf_dir):
    p = points_of(spark, sf_dir)
    return p.select("point_id", *(F.round(c, 6).alias(n) for n, c in zip("xyz", geo.ecef(F.col("lon"), F.col("lat")))))


@query(f"WITH m AS (SELECT *, {XYZ} FROM ({MESH})) SELECT a.node_index, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2), 6) AS km FROM m a JOIN m b ON b.node_index = a.node_index + 1")
def chord_distance(spark, sf_dir):
    a = mesh_of(spark, sf_dir).select("node_index", "lon", "lat")
    b = a.select((F.col("node_index") - 1).alias("node_index"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    km = geo.chord(geo.ecef(F.col("lon"), F.col("lat")), geo.ecef(F.col("lon2"), F.col("lat2")))
    return a.join(b, "node_index").select("node_index", F.round(km, 6).alias("km"))


@query(f"WITH s AS ({E}) SELECT node_id, ts, round(time_h, 6) AS time_h FROM s")
def hours_since_epoch(spark, sf_dir):
    return rounded(hours(spark, sf_dir).select("node_id", "ts", "time_h"), "time_h")


def _decoded(spark, sf_dir, calendar: str) -> DataFrame:
    day = C.day_number(F.col("time_h"))
    s = years(spark, sf_dir).select(day.alias("day")).distinct()
    date = C.date_of_day(F.col("day"), calendar)
    return s.select("day", date["y"].alias("y"), date["m"].alias("m"), date["d"].alias("d"), C.day_of_date(date["y"], date["m"], date["d"], calendar).alias("again"))


DAYS = f"WITH s AS ({L}), x AS (SELECT DISTINCT CAST(floor(time_h / 24) AS BIGINT) AS day FROM s)"


@query(DAYS + " SELECT day, CAST(1900 + day // 360 AS INTEGER) AS y, CAST(day % 360 // 30 + 1 AS INTEGER) AS m, CAST(day % 30 + 1 AS INTEGER) AS d, day AS again FROM x")
def decode_360_day(spark, sf_dir):
    return _decoded(spark, sf_dir, "360_day")


# In a year without leap days, month and day are those of a common year, such as 2001.
@query(DAYS + ", y AS (SELECT day, DATE '2001-01-01' + CAST(day % 365 AS INTEGER) AS t FROM x) SELECT day, CAST(1900 + day // 365 AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m, CAST(day(t) AS INTEGER) AS d, day AS again FROM y")
def decode_noleap(spark, sf_dir):
    return _decoded(spark, sf_dir, "noleap")


@query(DAYS + ", y AS (SELECT day, DATE '2000-01-01' + CAST(day % 366 AS INTEGER) AS t FROM x) SELECT day, CAST(1900 + day // 366 AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m, CAST(day(t) AS INTEGER) AS d, day AS again FROM y")
def decode_all_leap(spark, sf_dir):
    return _decoded(spark, sf_dir, "all_leap")


# 1900 has a leap day in this calendar; after it, it runs 13 days behind up to 2100, counted from day 12 before.
@query(DAYS + ", y AS (SELECT day, DATE '1900-01-13' + CAST(day AS INTEGER) - 13 AS t FROM x) SELECT day, CAST(year(t) AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m, CAST(day(t) AS INTEGER) AS d, day AS again FROM y")
def decode_julian(spark, sf_dir):
    return _decoded(spark, sf_dir, "julian")


@query(DAYS + ", y AS (SELECT day, DATE '1900-01-01' + CAST(day AS INTEGER) AS t FROM x) SELECT day, CAST(year(t) AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m, CAST(day(t) AS INTEGER) AS d, day AS again FROM y")
def decode_standard(spark, sf_dir):
    return _decoded(spark, sf_dir, "standard")


@query("SELECT c_custkey, 'twl_1hr_' || 'G' || c_nationkey || '_F_S_' || 'L' || c_custkey || '_' || (1950 + c_custkey % 50) || '01-' || (1950 + c_custkey % 50) || '12.nc' AS name, CAST(1950 + c_custkey % 50 AS INTEGER) AS file_year FROM customer")
def filename_build_and_parse(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    year = (1950 + F.col("c_custkey") % 50).cast("string")
    made = c.select("c_custkey", naming.file_name_column(F.lit("twl"), F.lit("1hr"), F.concat(F.lit("G"), F.col("c_nationkey").cast("string")), F.lit("F"), F.lit("S"), F.concat(F.lit("L"), F.col("c_custkey").cast("string")), year).alias("name"))
    return made.withColumn("file_year", naming.start_year(F.col("name"), "twl"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '200001-200012' WHEN 1 THEN '194701-202512' ELSE '197903-198107' END AS time_range FROM supplier")
def time_range_format(spark, sf_dir):
    given = F.when(F.col("s_suppkey") % 3 == 0, "2000").when(F.col("s_suppkey") % 3 == 1, "1947-2025").otherwise("197903-198107")
    return table(spark, sf_dir, "supplier").select("s_suppkey", naming.time_range_column(given).alias("time_range"))


@query("SELECT p_partkey // 10 AS dir, max(p_partkey % 10) AS suffix FROM part WHERE p_partkey % 10 <> 7 GROUP BY 1")
def best_file_by_suffix(spark, sf_dir):
    from tidelake.sources.files import best_files

    k = F.col("p_partkey")
    version = F.when(k % 10 == 0, "fort.63.nc").when(k % 10 == 7, "fort.63.nc.bak").otherwise(F.concat(F.lit("fort.63.nc-"), (k % 10).cast("string")))
    paths = table(spark, sf_dir, "part").select(F.concat_ws("/", F.lit("runs"), F.floor(k / 10).cast("string"), version).alias("path"))
    got = best_files(paths)
    return got.select(F.regexp_extract("dir", r"([0-9]+)$", 1).cast("long").alias("dir"), naming.version_suffix(F.col("path")).cast("long").alias("suffix"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'cli' WHEN c_custkey % 3 = 0 THEN 'yaml' WHEN c_custkey % 5 = 0 THEN 'source' ELSE 'default' END AS scenario FROM customer")
def metadata_precedence(spark, sf_dir):
    k = F.col("c_custkey")
    layer = lambda n, name: F.when(k % n == 0, name).otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", resolved(layer(2, "cli"), layer(3, "yaml"), layer(5, "source"), F.lit("default")).alias("scenario"))


@query("SELECT s_suppkey AS node_index, s_suppkey + 1 AS on_disk FROM supplier")
def index_base_shift(spark, sf_dir):
    from tidelake.sources.files import node_index

    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("node_index"))
    disk = node_index(nodes, 1, on_disk=False)
    return node_index(disk.withColumn("on_disk", F.col("node_index")), 1, on_disk=True).select("node_index", "on_disk")


@query(f"SELECT min(lon) AS lon_min, max(lon) AS lon_max, min(lat) AS lat_min, max(lat) AS lat_max, min(depth) AS depth_min, max(depth) AS depth_max FROM ({MESH})")
def geospatial_extent(spark, sf_dir):
    return spatial.extent(mesh_of(spark, sf_dir), "lon", "lat", "depth")


@query(f"SELECT 'POLYGON((' || a || ' ' || b || ', ' || c || ' ' || b || ', ' || c || ' ' || d || ', ' || a || ' ' || d || ', ' || a || ' ' || b || '))' AS wkt FROM (SELECT min(lon)::DOUBLE a, min(lat)::DOUBLE b, max(lon)::DOUBLE c, max(lat)::DOUBLE d FROM ({MESH}))")
def extent_wkt(spark, sf_dir):
    e = spatial.extent(mesh_of(spark, sf_dir), "lon", "lat", "depth")
    return e.select(geo.bounds_wkt(*(F.col(c) for c in ("lon_min", "lat_min", "lon_max", "lat_max"))).alias("wkt"))


@query(f"WITH s AS ({L}) SELECT file_year, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS time_coverage_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS time_coverage_end, max(time_h) - min(time_h) AS total_hours FROM s GROUP BY file_year")
def time_coverage(spark, sf_dir):
    g = years(spark, sf_dir).groupBy("file_year").agg(F.min("time_h").alias("a"), F.max("time_h").alias("b"))
    return g.select("file_year", C.time_text(F.col("a")).alias("time_coverage_start"), C.time_text(F.col("b")).alias("time_coverage_end"), (F.col("b") - F.col("a")).alias("total_hours"))


W = f"{tides.np.radians(tides.speed('M2')):.17g}"
SUMS = f"WITH s AS ({E}), t AS (SELECT node_id, cos(time_h * {W}) AS c, sin(time_h * {W}) AS s, value AS v FROM s), g AS (SELECT node_id, count(*) AS n, sum(c) AS a, sum(s) AS b, sum(c * c) AS p, sum(s * s) AS q, sum(c * s) AS r, sum(v) AS y, sum(c * v) AS cy, sum(s * v) AS sy FROM t GROUP BY node_id)"


@query(SUMS + " SELECT node_id, n, round(a, 4) AS s_c, round(b, 4) AS s_s, round(p, 4) AS s_cc, round(q, 4) AS s_ss, round(r, 4) AS s_cs, round(y, 4) AS s_y, round(cy, 4) AS s_cy, round(sy, 4) AS s_sy FROM g")
def harmonic_normal_equations(spark, sf_dir):
    got = tides.harmonic_sums(hours(spark, sf_dir))
    return rounded(got, *(c for c in got.columns if c.startswith("s_")), places=4)


FIT = SUMS + ", k AS (SELECT *, p * q - r * r AS m00, b * r - a * q AS m01, a * r - b * p AS m02, n * q - b * b AS m11, a * b - n * r AS m12, n * p - a * a AS m22 FROM g), d AS (SELECT *, n * m00 + a * m01 + b * m02 AS det FROM k), f AS (SELECT node_id, n, CASE WHEN abs(det) > 1e-6 THEN (m00 * y + m01 * cy + m02 * sy) / det END AS mean, CASE WHEN abs(det) > 1e-6 THEN (m01 * y + m11 * cy + m12 * sy) / det END AS cos_amp, CASE WHEN abs(det) > 1e-6 THEN (m02 * y + m12 * cy + m22 * sy) / det END AS sin_amp FROM d)"


@query(FIT + " SELECT node_id, n, round(mean, 4) AS mean, round(cos_amp, 4) AS cos_amp, round(sin_amp, 4) AS sin_amp FROM f")
def harmonic_fit_m2(spark, sf_dir):
    return rounded(tides.harmonic_fit(hours(spark, sf_dir)), "mean", "cos_amp", "sin_amp", places=4)


@query(FIT + f" SELECT s.node_id, count(*) AS n, round(sum((s.value - f.mean - f.cos_amp * cos(s.time_h * {W}) - f.sin_amp * sin(s.time_h * {W})) ** 2), 2) AS squares FROM s JOIN f USING (node_id) GROUP BY s.node_id")
def harmonic_residual_m2(spark, sf_dir):
    s = hours(spark, sf_dir)
    w = float(W)
    r = F.col("value") - F.col("mean") - F.col("cos_amp") * F.cos(F.col("time_h") * w) - F.col("sin_amp") * F.sin(F.col("time_h") * w)
    return s.join(tides.harmonic_fit(s).drop("n"), "node_id").groupBy("node_id").agg(F.count("*").alias("n"), F.round(F.sum(r * r), 2).alias("squares"))


@query(f"WITH s AS ({L}) SELECT node_id, round(regr_slope(value, time_h), 6) AS slope, round(regr_intercept(value, time_h), 2) AS intercept FROM s GROUP BY node_id")
def linear_trend(spark, sf_dir):
    return tides.linear_trend(years(spark, sf_dir)).select("node_id", F.round("slope", 6).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query(f"WITH s AS ({L}), f AS (SELECT file_year, min(time_h) AS a FROM s GROUP BY file_year) SELECT file_year, CAST(floor((time_h - a) / 240) AS BIGINT) AS nodal_window, count(*) AS n FROM s JOIN f USING (file_year) GROUP BY ALL")
def nodal_windows(spark, sf_dir):
    return tides.nodal_window(years(spark, sf_dir)).groupBy("file_year", "nodal_window").agg(F.count("*").alias("n"))


@query(f"WITH s AS ({L}) SELECT DISTINCT file_year FROM s WHERE file_year NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_orderkey % 2 = 0 AND o_orderdate < TIMESTAMP '1998-01-01')")
def todo_years(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0 and o_orderdate < timestamp_ntz'1998-01-01'").select(F.year("o_orderdate").alias("file_year")).distinct()
    return X.todo_years(years(spark, sf_dir).select("file_year").distinct(), done)


# The fit of MM and MF over all files, written out: windows of 240 h from each file's first hour, the model's columns at
# every instant, A'A inverted by elimination, and each node's A'Y.
_NODE = f"radians({tides.NODE_START} + {tides.NODE_RATE:.17g} * mid)"


def _pair(name: str) -> str:
    a, b, c = tides.NODAL[name]
    arg = f"radians({tides.speed(name):.17g} * h + ({c}) * sin(node))"
    return f"({a} + ({b}) * cos(node)) * cos({arg}), ({a} + ({b}) * cos(node)) * sin({arg})"


def _model(names: list[str]) -> str:
    """CTEs of series s: columns x of the model at each instant (model), each node's A'Y (sums)."""
    return f"""r AS (SELECT min(time_h) AS t0, max(time_h) - min(time_h) AS total FROM s), fs AS (SELECT file_year, min(time_h) AS a FROM s GROUP BY 1),
    w AS (SELECT file_year, floor((time_h - a) / 240) AS k, (min(time_h) + max(time_h)) / 2 AS mid FROM s JOIN fs USING (file_year) GROUP BY ALL),
    axis AS (SELECT DISTINCT file_year, time_h, time_h - t0 AS h, total, {_NODE} AS node FROM s JOIN fs USING (file_year) JOIN w USING (file_year) CROSS JOIN r WHERE k = floor((time_h - a) / 240)),
    model AS (SELECT file_year, time_h, [1.0::DOUBLE, {", ".join(map(_pair, names))}, h / total] AS x FROM axis),
    sums AS (SELECT node_id, i, sum(value * x[i]) AS y FROM s JOIN model USING (file_year, time_h), range(1, {2 * len(names) + 3}) t(i) GROUP BY ALL)"""


DETIDED = f"""WITH RECURSIVE s0 AS ({L}), s AS (SELECT node_id, file_year, time_h, max(value) AS value FROM s0 GROUP BY ALL), {_model(["MM", "MF"])},
    cells AS (SELECT i, j, sum(x[i] * x[j]) AS v FROM model, range(1, 7) a(i), range(1, 7) b(j) GROUP BY ALL),
    lines AS (SELECT i, list_concat(list(v ORDER BY j), list_transform(range(1, 7), lambda j: CASE WHEN i = j THEN 1.0 ELSE 0.0 END)) AS line FROM cells GROUP BY i),
    step AS (SELECT 1 AS k, (SELECT list(line ORDER BY i) FROM lines) AS m
      UNION ALL SELECT k + 1, list_transform(m, lambda row, i: CASE WHEN i = k THEN list_transform(row, lambda v: v / m[k][k]) ELSE list_transform(row, lambda v, j: v - row[k] * m[k][j] / m[k][k]) END) FROM step WHERE k <= 6),
    inverse AS (SELECT i, j, m[i][j + 6] AS v FROM step, range(1, 7) a(i), range(1, 7) b(j) WHERE k = 7),
    c AS (SELECT node_id, list(c ORDER BY i) AS c FROM (SELECT node_id, inverse.i, sum(v * y) AS c FROM sums JOIN inverse ON inverse.j = sums.i GROUP BY ALL) GROUP BY node_id)
SELECT node_id, count(*) AS n, round(sqrt(avg(CAST(value - list_dot_product(c, x) AS FLOAT)::DOUBLE ** 2)), 1) AS rms FROM s JOIN model USING (file_year, time_h) JOIN c USING (node_id) GROUP BY node_id"""


def _yearly(spark, sf_dir) -> DataFrame:
    return years(spark, sf_dir).groupBy("node_id", "file_year", "time_h").agg(F.max("value").alias("value"))


@query(DETIDED)
def detided_years(spark, sf_dir):
    """The multi-constituent detiding of the multi-year series: the residual's root mean square by node."""
    got = tides.detide(_yearly(spark, sf_dir), names=["MM", "MF"])
    return got.groupBy("node_id").agg(F.count("*").alias("n"), F.round(F.sqrt(F.avg(F.col("value").cast("double") * F.col("value").cast("double"))), 1).alias("rms"))


@query(f"""WITH s0 AS ({L}), s AS (SELECT node_id, file_year, time_h, max(value) AS value FROM s0 GROUP BY ALL), {_model(["MM"])} SELECT node_id, i AS term, round(y, 1) AS total FROM sums""")
def restart_sums(spark, sf_dir):
    """The sums A'Y of a fit that stopped after its second file and went on."""
    from tidelake.sources import scratch
    from tidelake.streaming import incremental

    s, out = scratch.stored(_yearly(spark, sf_dir), "yearly"), scratch.fresh(spark, "fit")
    incremental.Fit(spark, out, s, ["MM"]).add(s, most=2)
    kept = incremental.Fit(spark, out, s, ["MM"])
    kept.add(s)
    sums = tides.added(spark.read.parquet(*(f"{kept.path}/aty/file={f}" for f in kept.files)), 4)
    return sums.select("node_id", F.posexplode("__aty").alias("k", "y")).select("node_id", (F.col("k") + 1).cast("long").alias("term"), F.round("y", 1).alias("total"))


# Days from 1900-01-01 to 1970-01-01 in each calendar.
TO_1970 = {"standard": 25567, "360_day": 25200, "noleap": 25550, "all_leap": 25620, "julian": 25568}


@query(f"WITH s AS ({L}), x AS (SELECT DISTINCT time_h FROM s) SELECT time_h, calendar, round((time_h - days * 24 - 6) / 24, 6) AS encoded, time_h AS again FROM x, (VALUES {', '.join(f"('{k}', {v})" for k, v in TO_1970.items())}) c(calendar, days)")
def time_encode(spark, sf_dir):
    """Instants as values on an axis of another epoch and unit, and back, in five calendars."""
    x = years(spark, sf_dir).select("time_h").distinct()
    units = "days since 1970-01-01 06:00:00"
    each = [F.struct(F.lit(c).alias("calendar"), C.axis_values(F.col("time_h"), units, c).alias("v"), C.axis_hours(C.axis_values(F.col("time_h"), units, c), units, c).alias("again")) for c in TO_1970]
    return x.select("time_h", F.explode(F.array(*each)).alias("x")).select("time_h", "x.calendar", F.round("x.v", 6).alias("encoded"), F.round("x.again", 6).alias("again"))


@query(f"WITH s AS ({L}), x AS (SELECT DISTINCT date_trunc('second', ts) AS ts FROM s) SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS text, round(CAST(date_diff('second', TIMESTAMP '1900-01-01', ts) AS DOUBLE) / 3600, 6) AS time_h FROM x")
def time_from_text(spark, sf_dir):
    """Axes that hold dates as ISO texts: hours since the epoch, and the text again."""
    ts = F.date_format(F.date_trunc("second", "l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss")
    x = table(spark, sf_dir, "lineitem").select(ts.alias("given")).distinct().select(C.iso_hours(F.col("given")).alias("h"))
    return x.select(C.time_text(F.col("h"), None, "T").alias("text"), F.round("h", 6).alias("time_h"))


@query("SELECT count(*) AS n_nodes, count(*) FILTER (s_suppkey % 4 <> 0) AS n_wet FROM supplier")
def wet_node_count(spark, sf_dir):
    return spatial.wet_count(mesh_of(spark, sf_dir).select("node_index", (F.col("node_index") % 4 != 0).alias("always_wet")))


@query("SELECT l_orderkey % 97 AS file, CAST(year(min(l_shipdate)) AS INTEGER) AS file_year FROM lineitem GROUP BY 1")
def year_of_first_instant(spark, sf_dir):
    from tidelake.sources.files import first_years

    series = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 97).alias("file"), C.hours_since_epoch(F.col("l_shipdate")).alias("time_h"))
    return first_years(series)


@query("SELECT CAST(1900 + p_partkey // 10 AS INTEGER) AS year, max(p_partkey % 10) AS suffix FROM part WHERE p_partkey % 10 <> 7 AND p_partkey // 10 < 200 GROUP BY 1")
def best_file_by_year(spark, sf_dir):
    from tidelake.sources.files import best_files_by_year

    k = F.col("p_partkey")
    dir_ = F.when(k < 2000, (1900 + F.floor(k / 10)).cast("string")).otherwise(F.concat(F.lit("y"), k.cast("string")))
    version = F.when(k % 10 == 0, "fort.63.nc").when(k % 10 == 7, "fort.63.nc.bak").otherwise(F.concat(F.lit("fort.63.nc-"), (k % 10).cast("string")))
    got = best_files_by_year(table(spark, sf_dir, "part").select(F.concat_ws("/", F.lit("runs"), dir_, version).alias("path")))
    return got.select("year", naming.version_suffix(F.col("path")).cast("long").alias("suffix"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS file_year, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1")
def hourly_files_listed(spark, sf_dir):
    from tidelake.sources.files import hourly_files

    y = F.year("o_orderdate").cast("string")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "_day_").otherwise("_1hr_")
    paths = table(spark, sf_dir, "orders").select(F.concat(F.lit("out/twl"), kind, F.lit("g_f_s_l_"), y, F.lit("01-"), y, F.lit("12.nc")).alias("path"))
    return hourly_files(paths, "twl").groupBy("file_year").agg(F.count("*").alias("n"))


@query("SELECT user_id AS file, date_trunc('second', ts) AS ts, CASE WHEN event_id % 11 = 0 THEN -99.5 ELSE CAST(event_id % 1000 AS DOUBLE) / 100 END AS sea_level FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0")
def gauge_parse(spark, sf_dir):
    """Gauge lines made of the events: every fifth is flagged as not for use, every seventh has no level; headers in between."""
    from tidelake.schema import NO_LEVEL
    from tidelake.sources.files import gauge_rows

    k = F.col("event_id")
    level = F.when(k % 7 == 0, F.lit(str(NO_LEVEL))).when(k % 11 == 0, F.lit("-99.5")).otherwise((k % 1000 / 100).cast("string"))
    line = F.concat_ws("  ", F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), level, F.lit("1"), F.when(k % 5 == 0, "0").otherwise("1"))
    lines = table(spark, sf_dir, "events").select(F.col("user_id").alias("file"), F.explode(F.array(F.lit("# SITE NAME: x"), line)).alias("value"))
    got = gauge_rows(lines)
    return got.select("file", F.col("ts").cast("timestamp_ntz").alias("ts"), "sea_level")


@query("SELECT 'station-' || s_suppkey || '.txt' AS filename, 'Site ' || s_suppkey AS site_name, (s_suppkey % 90) / 2.0 AS latitude, (s_suppkey % 170) / 2.0 AS longitude, '1979/01/01' AS start_date, CAST(s_suppkey % 12 AS DOUBLE) AS timezone, 'chart' AS datum FROM supplier WHERE s_suppkey % 6 <> 0")
def gauge_catalogue(spark, sf_dir):
    """Gauge headers made of the suppliers; every sixth has no readable latitude."""
    from tidelake.sources.files import gauge_headers

    k = F.col("s_suppkey")
    lat = F.when(k % 6 == 0, "unknown").otherwise((k % 90 / 2).cast("string"))
    lines = [F.concat(F.lit("# SITE NAME: Site "), k.cast("string")), F.concat(F.lit("# LATITUDE "), lat), F.concat(F.lit("# LONGITUDE "), (k % 170 / 2).cast("string")), F.lit("# START DATE 1979/01/01"), F.concat(F.lit("# TIME ZONE hours "), (k % 12).cast("string")), F.lit("# DATUM INFORMATION chart")]
    texts = table(spark, sf_dir, "supplier").select(F.concat(F.lit("gauges/station-"), k.cast("string"), F.lit(".txt")).alias("path"), F.concat_ws("\n", *lines).alias("value"))
    return gauge_headers(texts).select("filename", "site_name", "latitude", "longitude", "start_date", "timezone", "datum")


@query(f"WITH s AS ({L}), m AS ({MESH}) SELECT a.*, m.lon AS node_lon, m.lat AS node_lat, m.depth AS node_depth FROM (SELECT node_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, max(value) AS value, min_by(time_h, (-value, time_h)) AS time_h FROM s GROUP BY ALL) a LEFT JOIN m ON m.node_index = a.node_id")
def monthly_with_nodes(spark, sf_dir):
    nodes = mesh_of(spark, sf_dir).select(F.col("node_index").alias("node_id"), F.col("lon").alias("node_lon"), F.col("lat").alias("node_lat"), F.col("depth").alias("node_depth"))
    return spatial.with_nodes(periods.monthly_max_raw(years(spark, sf_dir)), nodes)


SPEEDS = ", ".join(f"('{n}', {tides.speed(n):.17g}::DOUBLE)" for n in tides.CONSTITUENTS)


@query(f"WITH s AS ({L}), t AS (SELECT node_id, file_year, max(time_h) - min(time_h) AS total FROM s GROUP BY ALL) SELECT node_id, file_year, name FROM t JOIN (VALUES {SPEEDS}) v(name, speed) ON total * speed > 720")
def constituent_filter(spark, sf_dir):
    t = years(spark, sf_dir).groupBy("node_id", "file_year").agg((F.max("time_h") - F.min("time_h")).alias("total"))
    return t.select("node_id", "file_year", F.explode(tides.resolvable_in(F.col("total"))).alias("name"))


@query(NEAREST.format(wet="") + f", s AS ({L}) SELECT n.point_id AS node_id, count(*) AS n, round(max(CAST(s.value AS FLOAT)), 2) AS value FROM n JOIN s ON s.node_id = n.node_index GROUP BY n.point_id")
def bucketed_gather(spark, sf_dir):
    """node_gather from a series that is stored by buckets of nodes: no exchange of the series."""
    from tidelake.sources import scratch

    path = scratch.fresh(spark, "buckets")
    stored = X.bucketed(years(spark, sf_dir).withColumnRenamed("node_id", "node_index"), path.rsplit("/", 1)[1].replace("-", "_"), 8, path)
    got = X.gather(stored, spatial.match_points(points_of(spark, sf_dir), mesh_of(spark, sf_dir)))
    return got.groupBy("node_id").agg(F.count("*").alias("n"), F.round(F.max("value"), 2).alias("value"))


NODE5 = "SELECT DISTINCT user_id % 5 AS node_index, (user_id % 5) * 10.0 AS lon, (user_id % 5) * 7.0 - 20 AS lat FROM events"


@query(f"""WITH m AS (SELECT *, {XYZ} FROM ({NODE5})), st AS (SELECT node_index + 100 AS station, lon + 0.125 AS lon, lat - 0.25 AS lat FROM ({NODE5})), p AS (SELECT *, {XYZ} FROM st),
c AS (SELECT p.station, m.node_index, sqrt((p.x - m.x) ** 2 + (p.y - m.y) ** 2 + (p.z - m.z) ** 2) AS d FROM p, m), near AS (SELECT station, arg_min(node_index, (d, node_index)) AS node_index, min(d) AS d FROM c GROUP BY station HAVING min(d) <= 50),
v AS (SELECT user_id % 5 AS node_index, date_trunc('hour', ts) AS hour, avg(value) AS m FROM events WHERE event_type = 'view' GROUP BY ALL),
o AS (SELECT user_id % 5 + 100 AS station, date_trunc('hour', ts) AS hour, avg(CAST(event_id % 1000 AS DOUBLE) / 100) AS o FROM events WHERE event_type <> 'view' AND event_id % 5 <> 0 AND event_id % 7 <> 0 GROUP BY ALL),
b AS (SELECT station, node_index, near.d AS dist, m, o, m - o AS d FROM near JOIN v USING (node_index) JOIN o USING (station, hour))
SELECT 'station-' || station || '.txt' AS filename, node_index, round(dist, 6) AS dist_km, count(*) AS n, round(avg(d), 3) AS bias, round(sqrt(avg(d * d)), 3) AS rmse, round(corr(m, o), 3) AS corr FROM b GROUP BY ALL HAVING count(*) >= 24""")
def gauge_to_skill(spark, sf_dir):
    """One run from gauge texts to scores: catalogue, nearest node, the node's series, skill. Gauges and a mesh of five nodes are made of the events."""
    from tidelake.schema import NO_LEVEL
    from tidelake.sources.files import gauge_headers, gauge_rows

    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    node = F.col("user_id") % 5
    mesh = e.select(node.alias("node_index"), (node * 10.0).alias("lon"), (node * 7.0 - 20).alias("lat")).distinct()
    path = F.concat(F.lit("gauges/station-"), (node + 100).cast("string"), F.lit(".txt"))
    heads = mesh.select(F.concat(F.lit("gauges/station-"), (F.col("node_index") + 100).cast("string"), F.lit(".txt")).alias("path"), F.concat_ws("\n", F.concat(F.lit("# LATITUDE "), (F.col("lat") - 0.25).cast("string")), F.concat(F.lit("# LONGITUDE "), (F.col("lon") + 0.125).cast("string"))).alias("value"))
    level = F.when(k % 7 == 0, F.lit(str(NO_LEVEL))).otherwise((k % 1000 / 100).cast("string"))
    lines = e.filter("event_type <> 'view'").select(path.alias("file"), F.concat_ws("  ", F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), level, F.lit("1"), F.when(k % 5 == 0, "0").otherwise("1")).alias("value"))
    series = e.filter("event_type = 'view'").select(node.alias("node_index"), C.hours_since_epoch(F.col("ts")).alias("time_h"), "value")
    near = stations.matched(gauge_headers(heads), spatial.index_mesh(mesh))
    got = stations.scored(near, series, gauge_rows(lines))
    return got.select("filename", "node_index", F.round("dist_km", 6).alias("dist_km"), "n", *(F.round(c, 3).alias(c) for c in ("bias", "rmse", "corr")))
