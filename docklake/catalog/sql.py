"""Common table expressions of the SQL equivalents."""

OBS = """
obs AS (
  SELECT user_id AS station, date_trunc('second', ts) AS timetag, event_id,
         user_id / 1000.0 + 41 AS latitude, user_id / 500.0 + 2 AS longitude,
         CASE WHEN event_type = 'error' THEN 'CLS' ELSE 'OPN' END AS status,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS slots,
         CAST(floor(value) AS INTEGER) AS bikes
  FROM events
)"""

ORDER_OBS = """
obs AS (
  SELECT o_custkey AS station, o_orderdate AS timetag, o_orderkey AS event_id,
         o_custkey / 1000.0 + 41 AS latitude, o_custkey / 500.0 + 2 AS longitude,
         CASE WHEN o_orderstatus = 'F' THEN 'CLS' ELSE 'OPN' END AS status,
         CAST(o_orderkey % 30 AS INTEGER) AS slots, CAST(floor(o_totalprice % 40) AS INTEGER) AS bikes
  FROM orders
)"""


def over_months(query: str) -> str:
    """The same query over observations of many months."""
    return query.replace(OBS, ORDER_OBS)


FACT = OBS + """,
uniq AS (
  SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY station, timetag ORDER BY event_id DESC) = 1
),
moved AS (
  SELECT *, lag(bikes) OVER (PARTITION BY station ORDER BY timetag) AS previous FROM uniq
),
fact AS (
  SELECT station, timetag, status,
         CAST(CASE WHEN status = 'OPN' THEN slots ELSE 0 END AS BIGINT) AS slots,
         CAST(CASE WHEN status = 'OPN' THEN bikes ELSE 0 END AS BIGINT) AS available,
         CAST(CASE WHEN status = 'OPN' THEN slots + bikes ELSE 0 END AS BIGINT) AS capacity,
         CAST(coalesce(greatest(previous - bikes, 0), 0) AS BIGINT) AS lent,
         CAST(coalesce(greatest(bikes - previous, 0), 0) AS BIGINT) AS returned
  FROM moved
)"""


def calendar(ts: str) -> str:
    return f"""
  CAST(minute({ts}) AS INTEGER) AS minute, CAST(hour({ts}) AS INTEGER) AS hour,
  CASE WHEN hour({ts}) < 4 THEN '[00:00 - 04:00)' WHEN hour({ts}) < 8 THEN '[04:00 - 08:00)'
       WHEN hour({ts}) < 12 THEN '[08:00 - 12:00)' WHEN hour({ts}) < 16 THEN '[12:00 - 16:00)'
       WHEN hour({ts}) < 20 THEN '[16:00 - 20:00)' ELSE '[20:00 - 00:00)' END AS daysixth,
  CASE WHEN hour({ts}) BETWEEN 6 AND 9 THEN 'GO-WORK' WHEN hour({ts}) BETWEEN 10 AND 12 THEN 'MORNING'
       WHEN hour({ts}) BETWEEN 13 AND 14 THEN 'LUNCH' WHEN hour({ts}) BETWEEN 15 AND 16 THEN 'AFTERNOON'
       WHEN hour({ts}) BETWEEN 17 AND 18 THEN 'BACK-HOME' ELSE 'NIGHT' END AS part,
  CAST(day({ts}) AS INTEGER) AS month_day, CAST(dayofyear({ts}) AS INTEGER) AS year_day,
  {month_week_us(ts)} AS month_week, CAST(weekofyear({ts}) AS INTEGER) AS year_week,
  CAST(month({ts}) AS INTEGER) AS month, CAST(quarter({ts}) AS INTEGER) AS trimester,
  CAST(year({ts}) AS INTEGER) AS year"""


def month_week_us(ts: str) -> str:
    return f"CAST(floor((day({ts}) + dayofweek(date_trunc('month', {ts})) - 1) / 7.0) + 1 AS INTEGER)"


def month_week_es(ts: str) -> str:
    lead = f"(isodow(date_trunc('month', {ts})) - 1)"
    return f"CAST(floor((day({ts}) - 1 + {lead}) / 7.0) + CASE WHEN {lead} <= 3 THEN 1 ELSE 0 END AS INTEGER)"


def bands(density: str = "pop_density", population: str = "population", size: str = "size") -> str:
    return f"""
  CASE WHEN {density} < 10 THEN '[0 - 10)' WHEN {density} < 15 THEN '[10 - 15)' WHEN {density} < 20 THEN '[15 - 20)'
       WHEN {density} < 25 THEN '[20 - 25)' WHEN {density} < 30 THEN '[25 - 30)'
       WHEN {density} >= 30 THEN '[30+' END AS pop_density_range,
  CASE WHEN {population} < 100 THEN '[0 - 100)' WHEN {population} < 150 THEN '[100 - 150)'
       WHEN {population} < 200 THEN '[150 - 20)' WHEN {population} >= 200 THEN '[200+' END AS pop_range,
  CASE WHEN {size} < 5 THEN '[0 - 5)' WHEN {size} < 10 THEN '[5 - 10)' WHEN {size} < 15 THEN '[10 - 15)'
       WHEN {size} < 20 THEN '[15 - 20)' WHEN {size} >= 20 THEN '[20+' END AS size_range"""


def dimension(name: str, prefix: str, key: str, segment: str) -> str:
    balance = f"{prefix}_acctbal"
    return f"""
dim AS (
  SELECT {key} AS id, nullif(CASE WHEN r_name = 'MIDDLE EAST' THEN 'NULL' ELSE r_name END, 'NULL') AS district,
         n_name AS neighborhood, {segment} AS postal_code, {prefix}_name AS address,
         {balance} / 300 AS pop_density, CAST(floor({balance} / 40) AS BIGINT) AS population,
         {balance} / 500 AS size
  FROM {name} JOIN nation ON {prefix}_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


CUSTOMER_DIM = dimension("customer", "c", "c_custkey", "c_mktsegment")
SUPPLIER_DIM = dimension("supplier", "s", "s_suppkey", "'NONE'")

DIM_FIELDS = "district, neighborhood, postal_code, address, pop_density, population, size"

BIG_SELECT = f"""
big AS (
  SELECT station, timetag, status, slots, available, capacity, lent, returned, lent + returned AS traffic,
         {DIM_FIELDS}, {bands()}, {calendar('timetag')}
  FROM fact JOIN dim ON station = id
)"""

BIG = FACT + "," + CUSTOMER_DIM + "," + BIG_SELECT
BIG_SUPPLIER = FACT + "," + SUPPLIER_DIM + "," + BIG_SELECT

LAST = {
    "last_month": "(year, trimester, month) = (SELECT (year, trimester, month) FROM big ORDER BY timetag DESC LIMIT 1)",
    "last_week": (
        "(year, trimester, month, month_week) = "
        "(SELECT (year, trimester, month, month_week) FROM big ORDER BY timetag DESC LIMIT 1)"
    ),
    "last_hour": (
        "(year, trimester, month, month_week, month_day, hour) = "
        "(SELECT (year, trimester, month, month_week, month_day, hour) FROM big ORDER BY timetag DESC LIMIT 1)"
    ),
}

DAY_SIXTHS = ["[00:00 - 04:00)", "[04:00 - 08:00)", "[08:00 - 12:00)", "[12:00 - 16:00)", "[16:00 - 20:00)",
              "[20:00 - 00:00)"]


def pivoted(measure: str, column: str) -> str:
    parts = [f"CAST(sum({column}) AS BIGINT) AS {measure}"]
    for label in DAY_SIXTHS:
        name = f"{measure}_{label[1:3]}_{label[9:11]}"
        parts.append(f"CAST(sum({column}) FILTER (WHERE daysixth = '{label}') AS BIGINT) AS {name}")
    return ", ".join(parts)


RAW = """
pieces AS (
  SELECT event_id, event_type, value, user_id, CAST(user_id AS VARCHAR) AS number, CAST(floor(value) AS INTEGER) AS whole,
         lpad(CAST(user_id AS VARCHAR), 9, '0') AS digits, json_extract_string(props, '$.k') AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS updatetime
  FROM events
),
raw AS (
  SELECT event_type AS datasource, event_id AS arrival,
         CASE WHEN value > 100 THEN NULL ELSE updatetime * 1000 END AS timestamp_ms,
         CASE WHEN value > 100 THEN '<snapshot><updatetime>soon</updatetime><station>' ELSE
           '<?xml version="1.0" encoding="UTF-8"?><snapshot><updatetime><![CDATA[' || updatetime || ']]></updatetime>'
           || '<station><id>' || number || '</id><lat>41.' || digits || '</lat><long>2.' || digits || '</long>'
           || '<street><![CDATA[Street ' || event_type || ']]></street><height>' || whole || '</height>'
           || '<streetNumber>' || event_id || '</streetNumber><nearbyStationList>' || number || ',' || event_id
           || ',x</nearbyStationList><status>' || CASE WHEN event_type = 'error' THEN 'CLS' ELSE 'OPN' END
           || '</status><slots>' || k || '</slots><bikes>' || whole || '</bikes></station>'
           || '<station><id>' || CASE WHEN event_type = 'view' THEN 'none' ELSE '-' || number END
           || '</id><lat>41.' || digits || '</lat><long>41.' || digits || '</long><street></street><height></height>'
           || '<streetNumber>12b</streetNumber><nearbyStationList></nearbyStationList><status>OPN</status>'
           || '<bikes>99999999999' || number || '</bikes></station></snapshot>' END AS content
  FROM pieces
)"""
