"""The registered queries as plain SQL for DuckDB, over the same tables. Used to check results, never to make them."""

from __future__ import annotations

from rollfeat.operators.rolling import RollingBlock
from rollfeat.plans.presets import PRESET_A, PRESET_B, Preset
from rollfeat.queries import (
    FIRST_LOAD_UNTIL,
    HOT_BLOCK,
    LABELLED_TRAIN,
    LABELLED_VALIDATION,
    PASS_THROUGH,
    TRAIN,
    VALIDATION,
    CUSTOMER,
    TERMINAL,
    block,
)

EVENTS = """
  SELECT cast(event_id AS varchar) AS tx_id, ts AS tx_ts, user_id AS customer_id,
         cast(json_extract_string(props, '$.k') AS bigint) AS terminal_id, value AS tx_amount, event_type
  FROM events"""
TX = f"SELECT tx_id, tx_ts, customer_id, terminal_id, tx_amount FROM ({EVENTS})"
STAGED = f"""
  SELECT t.tx_ts, t.tx_id, t.customer_id, t.terminal_id, t.tx_amount, l.toxic AS tx_fraud
  FROM ({TX}) t LEFT JOIN labels l ON t.tx_id = cast(l.doc_id AS varchar)"""
ORDERS = """
  SELECT cast(o_orderkey AS varchar) AS tx_id, o_orderdate AS tx_ts, o_custkey AS customer_id,
         c_nationkey AS terminal_id, o_totalprice AS tx_amount
  FROM orders JOIN customer ON o_custkey = c_custkey"""
LINES = """
  SELECT concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS tx_id, l_shipdate AS tx_ts,
         o_custkey AS customer_id, l_suppkey AS terminal_id, l_extendedprice AS tx_amount, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

SECOND = "cast(floor(epoch({})) AS bigint)"


def rolling_sql(b: RollingBlock) -> list[str]:
    """A block as window expressions. Sums are taken in decimals, or in whole cents for moments."""
    end = "1 PRECEDING" if b.exclude_current_row else "CURRENT ROW"
    items = []
    for f in b.features():
        over = (
            f"OVER (PARTITION BY {', '.join(b.partition)} ORDER BY {SECOND.format(b.timestamp)} NULLS FIRST "
            f"RANGE BETWEEN {f.seconds} PRECEDING AND {end})"
        )
        count, money = f"count({f.column}) {over}", f"cast({f.column} AS decimal(18,2))"
        cents = f"cast(round({f.column} * 100) AS bigint)"
        total, squares = f"sum({cents}) {over}", f"sum({cents} * {cents}) {over}"
        centre = f"(2 * {total} + {count}) // (2 * {count})"
        drift = f"cast({total} - {count} * ({centre}) AS double)"
        deviations = (
            f"greatest(cast({squares} - 2 * ({centre}) * {total} + {count} * ({centre}) * ({centre}) AS double) "
            f"- {drift} * {drift} / cast({count} AS double), 0.0)"
        )
        variance = f"CASE WHEN {count} > 1 THEN {deviations} / (cast({count} AS double) - 1.0) / 10000.0 END"
        expression = {
            "count": count,
            "avg": f"cast(sum({money}) {over} AS double) / nullif({count}, 0)",
            "sum": f"cast(sum({money}) {over} AS double)",
            "min": f"cast(min({f.column}) {over} AS double)",
            "max": f"cast(max({f.column}) {over} AS double)",
            "count_distinct": f"count(DISTINCT {f.column}) {over}",
            "var_samp": variance,
            "stddev": f"sqrt({variance})",
            # A sketch of a few values holds them all, so its estimate is the exact number.
            "approx_count_distinct": f"cast(count(DISTINCT {f.column}) {over} AS double)",
        }[f.aggregation]
        items.append(f"{expression} AS {f.name}")
    return items


def with_features(source: str, *blocks: RollingBlock, columns: str = "*") -> str:
    items = ",\n  ".join(i for b in blocks for i in rolling_sql(b))
    return f"SELECT {columns},\n  {items}\nFROM ({source})"


def preset_sql(source: str, preset: Preset) -> str:
    return with_features(source, *preset.blocks, columns="*, dayname(tx_ts) AS day_of_the_week")


def between(source: str, bounds: tuple[str, str], column: str = "tx_ts") -> str:
    return f"SELECT * FROM ({source}) WHERE {column} >= TIMESTAMP '{bounds[0]}' AND {column} < TIMESTAMP '{bounds[1]}'"


HASH = "cast(('0x' || substr(md5(tx_id), 1, 15)) AS bigint)"
SAMPLED = f"abs({HASH} % 100) = 1"

INSTANCES = (
    "SELECT tx_id, tx_ts AS timestamp, customer_id AS customer, terminal_id AS terminal, "
    + ", ".join(PASS_THROUGH)
    + " FROM ({})"
)


def mapped(mapping) -> str:
    features = ", ".join(f"{column} AS {name}" for name, column in mapping.source_fields.items())
    return (
        f"SELECT {mapping.entity_id_field} AS entity_id, {mapping.feature_time} AS feature_time, tx_id AS tie_break, "
        f"{features} FROM ({preset_sql(STAGED, PRESET_B)})"
    )


# Feature types of the columns of the second preset's table.
VALUE_TYPES = {
    "tx_id": "STRING",
    "customer_id": "INT64",
    "terminal_id": "INT64",
    "tx_amount": "DOUBLE",
    "tx_fraud": "INT64",
    "day_of_the_week": "STRING",
} | {name: "INT64" if name.startswith("count_") else "DOUBLE" for name in PRESET_B.feature_names}


def counted(rows: list[tuple[dict[str, str], str]]) -> str:
    """One row per (constant columns, counted column)."""
    parts = [
        "SELECT " + ", ".join(f"'{v}' AS {k}" for k, v in constants.items()) + f", count({column}) AS n_values FROM f"
        for constants, column in rows
    ]
    return f"WITH f AS ({preset_sql(STAGED, PRESET_B)}) " + " UNION ALL ".join(parts)


def mapping_rows(mapping, wanted=None) -> list[tuple[dict[str, str], str]]:
    return [
        ({"entity_type": mapping.entity_type, "feature_name": name, "column_name": column}, column)
        for name, column in mapping.source_fields.items()
        if wanted is None or name in wanted
    ]


def asof_sql(instances: str, features: str, names: list[str]) -> str:
    """Latest feature row at or before ``as_of``. One row per (entity, time) is left on the feature side first."""
    picked = ", ".join(f"f.{n}" for n in names)
    return f"""
WITH i AS ({instances}),
f AS (SELECT * FROM ({features}) QUALIFY row_number() OVER (PARTITION BY entity, as_of ORDER BY tie DESC) = 1)
SELECT i.*, {picked} FROM i ASOF LEFT JOIN f ON i.entity = f.entity AND i.as_of >= f.as_of"""


def hourly(entity: str, tx_id: str = "tx_id") -> str:
    return f"SELECT tx_id AS {tx_id}, {entity} AS entity, cast(date_trunc('hour', tx_ts) AS timestamp) AS as_of FROM ({EVENTS})"


CUSTOMER_VALUES = f"""
  SELECT customer_id AS entity, tx_ts AS as_of, tx_id AS tie, avg_tx_amount_by_customer_id_1h_1s AS avg_1h,
         avg_tx_amount_by_customer_id_5d_1s AS avg_5d
  FROM ({with_features(TX, block(['avg'], ['1h', '5d']))})"""
TERMINAL_VALUES = f"""
  SELECT terminal_id AS entity, tx_ts AS as_of, tx_id AS tie, max_tx_amount_by_terminal_id_3d_1s AS max_3d, tx_amount
  FROM ({with_features(TX, block(['max'], ['3d'], partition=['terminal_id']))})"""


def per_feature_sql() -> str:
    one = "(SELECT * FROM v WHERE {0} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity, as_of ORDER BY tie DESC) = 1)"
    return f"""
WITH i AS ({hourly('customer_id')}), v AS ({CUSTOMER_VALUES}),
a AS (SELECT i.*, f.avg_1h FROM i ASOF LEFT JOIN {one.format('avg_1h')} f ON i.entity = f.entity AND i.as_of >= f.as_of)
SELECT a.*, f.avg_5d FROM a ASOF LEFT JOIN {one.format('avg_5d')} f ON a.entity = f.entity AND a.as_of >= f.as_of"""


def serve_sql() -> str:
    latest = "(SELECT * FROM ({}) QUALIFY row_number() OVER (PARTITION BY entity_id, feature_time ORDER BY tie_break DESC) = 1)"
    passed = ", ".join(f"i.{c}" for c in ["tx_id", "timestamp", *PASS_THROUGH])
    return f"""
WITH features AS ({preset_sql(STAGED, PRESET_B)}), i AS ({INSTANCES.format(between('SELECT * FROM features', TRAIN))}),
c AS (SELECT i.*, f.avg_amount_7d, f.count_28d FROM i
      ASOF LEFT JOIN {latest.format(mapped(CUSTOMER))} f ON i.customer = f.entity_id AND i.timestamp >= f.feature_time)
SELECT {passed.replace('i.', 'c.')}, c.customer AS entity_type_customer, c.terminal AS entity_type_terminal,
       c.avg_amount_7d, c.count_28d, f.max_amount_28d, f.max_amount_90d
FROM c ASOF LEFT JOIN {latest.format(mapped(TERMINAL))} f ON c.terminal = f.entity_id AND c.timestamp >= f.feature_time"""


def incremental_sql(history: str) -> str:
    if history == "full":
        return preset_sql(STAGED, PRESET_B)
    cut = f"DATE '{FIRST_LOAD_UNTIL.isoformat()}'"
    parts = [preset_sql(f"SELECT * FROM ({STAGED}) WHERE cast(tx_ts AS date) {op} {cut}", PRESET_B) for op in ("<=", ">")]
    return " UNION ALL ".join(f"({p})" for p in parts)


def train_features_sql() -> str:
    numeric = ["tx_amount", *PRESET_B.feature_names]
    values = ", ".join(f"coalesce(cast({c} AS double), 0.0) AS {c}" for c in numeric)
    missing = ", ".join(f"CASE WHEN {c} IS NULL THEN 1.0::double ELSE 0.0::double END AS {c}__missing" for c in numeric)
    return f"""
WITH t AS (SELECT * FROM ({between(preset_sql(STAGED, PRESET_B), LABELLED_TRAIN)}) WHERE tx_fraud IS NOT NULL),
d AS (SELECT day_of_the_week, row_number() OVER (ORDER BY count(*) DESC, day_of_the_week) - 1 AS n FROM t GROUP BY 1)
SELECT cast(tx_fraud AS double) AS tx_fraud, cast(d.n AS double) AS day_of_the_week__index, {values}, {missing}
FROM t JOIN d USING (day_of_the_week)"""


def in_turn(first: list[int], second: list[int]) -> str:
    """Two runs over one table, each with some of the customer features; the others are NULL."""
    fields = list(CUSTOMER.source_fields.items())
    names = [fields[i][0] for i in dict.fromkeys(first + second)]
    kinds = {name: "BIGINT" if name.startswith("count") else "DOUBLE" for name in names}
    parts = []
    for run in (first, second):
        own = dict(fields[i] for i in run)
        items = ", ".join(f"{own.get(n, 'NULL')}::{kinds[n]} AS {n}" for n in names)
        parts.append(f"SELECT customer_id AS entity_id, tx_ts AS feature_time, tx_id AS tie_break, {items} FROM ({preset_sql(STAGED, PRESET_B)})")
    return " UNION ALL ".join(parts)


def moments_sql() -> str:
    """Numbers near 3e18 have the moments of what they exceed it by, which is a whole number: no cents."""
    source = f"SELECT *, floor(tx_amount) AS large FROM ({ORDERS})"
    amounts, large = (
        rolling_sql(block(["stddev", "var_samp"], ["28d", "175d"], column=c, partition=["terminal_id"])) for c in ("tx_amount", "large")
    )
    large = [item.replace("round(large * 100)", "large").replace(" / 10000.0", " / 1.0") for item in large]
    return f"SELECT tx_id, {', '.join(amounts + large)} FROM ({source})"


def rolled(source: str, *blocks: RollingBlock) -> str:
    return with_features(source, *blocks, columns="tx_id")


def exact_sum_sql(source: str, limbs: list[str], first_place: int, divisor: str) -> str:
    """``source`` with the double next to a sum of whole numbers ``limbs[i] * 2**(60 * (first_place + i))``, divided, as ``value``."""
    base = "1152921504606846976::HUGEINT"

    def carried(numbers: str) -> str:
        digit = f"(a.c % {base} + {base}) % {base}"
        return (
            f"list_reduce(list_transform({numbers}, lambda x: {{'c': x, 'd': []::HUGEINT[]}}), "
            f"lambda a, x: {{'c': x.c + (a.c - {digit}) // {base}, 'd': a.d || [{digit}]}})"
        )

    unit = "CAST(pow(2.0, shift) AS HUGEINT)"
    return f"""
SELECT *, sign * (CAST(leading_bits + CASE WHEN leading_bits % 2 = 0 AND more THEN 1 ELSE 0 END AS DOUBLE) * pow(2.0, shift) / {divisor})
       * pow(2.0, place // 2) * pow(2.0, place - place // 2) AS value
FROM (SELECT *, CAST(high * CAST(pow(2.0, 60 - shift) AS HUGEINT) + low // {unit} AS BIGINT) AS leading_bits,
             len(list_filter(n.d[1:greatest(at_place - 2, 0)], lambda d: d <> 0)) > 0 OR low % {unit} <> 0 AS more, 60 * ({first_place} + at_place - 2) AS place
FROM (SELECT *, n.d[at_place] AS high, CASE WHEN at_place > 1 THEN n.d[at_place - 1] ELSE 0 END AS low, greatest(length(bin(CAST(n.d[at_place] AS BIGINT))) - 2, 0) AS shift
FROM (SELECT *, list_max(list_transform(n.d, lambda d, i: CASE WHEN d <> 0 THEN i END)) AS at_place
FROM (SELECT *, CASE WHEN r.c < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sign, CASE WHEN r.c < 0 THEN {carried("list_transform(l, lambda x: -x)")} ELSE r END AS n
FROM (SELECT *, {carried("l")} AS r FROM (SELECT *, [{', '.join(limbs)}, 0, 0, 0] AS l FROM ({source})))))))"""


def all_magnitudes_sql() -> str:
    places = range(-18, 18)
    limbs = []
    for place in places:
        a, b = -60 * place // 2, -60 * place - -60 * place // 2
        scaled = f"(wide * pow(2.0, {a}) * pow(2.0, {b}))"
        part = f"CAST(trunc({scaled}) - trunc({scaled} / pow(2.0, 60)) * pow(2.0, 60) AS HUGEINT)"
        beyond = 60 * (place + 1) + 53
        limbs.append(f"{f'CASE WHEN abs(wide) < pow(2.0, {beyond}) THEN {part} ELSE 0::HUGEINT END' if beyond < 1024 else part} AS p{place - places.start}")
    wide = f"SELECT *, tx_amount * CASE WHEN tx_id::BIGINT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * pow(2.0, tx_id::BIGINT % 1993 - 996) AS wide FROM ({TX})"
    frames = []
    for lookback, seconds in (("1h", 3600), ("5d", 432000)):
        over = f"OVER (PARTITION BY customer_id ORDER BY {SECOND.format('tx_ts')} NULLS FIRST RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING)"
        sums = ", ".join(f"coalesce(CAST(sum(p{i}) {over} AS HUGEINT), 0) AS s{i}" for i in range(len(places)))
        frames.append(f"SELECT tx_id, '{lookback}' AS lookback, count(wide) {over} AS n, {sums} FROM limbs")
    finished = []
    for name, divisor in (("sum", "1.0"), ("avg", "rows_")):
        value = exact_sum_sql("SELECT * RENAME (n AS rows_) FROM frames WHERE n > 0", [f"s{i}" for i in range(len(places))], places.start, divisor)
        finished.append(f"SELECT tx_id, lookback, '{name}' AS name, coalesce(value, 0.0) AS value FROM ({value})")
    columns = ", ".join(
        f"max(value) FILTER (name = '{name}' AND lookback = '{lookback}') AS {name}_wide_by_customer_id_{lookback}_1s" for name in ("avg", "sum") for lookback in ("1h", "5d")
    )
    return f"""
WITH wide AS ({wide}), limbs AS (SELECT *, {', '.join(limbs)} FROM wide), frames AS ({' UNION ALL '.join(frames)}),
finished AS ({' UNION ALL '.join(finished)}), wanted AS (SELECT tx_id, {columns} FROM finished GROUP BY tx_id)
SELECT w.* REPLACE (t.tx_id AS tx_id), plan FROM ({TX}) t LEFT JOIN wanted w ON t.tx_id = w.tx_id CROSS JOIN (VALUES ('direct'), ('chunked')) AS p(plan)"""


ORACLE: dict[str, str] = {
    "scan_tx": TX,
    "scan_txlabels": "SELECT cast(doc_id AS varchar) AS tx_id, toxic AS tx_fraud FROM labels",
    "ctas_tx": f"SELECT *, cast(cast(tx_ts AS date) AS varchar) AS tx_date FROM ({TX})",
    "ctas_txlabels": "SELECT cast(doc_id AS varchar) AS tx_id, toxic AS tx_fraud FROM labels",
    "ctas_customers": "SELECT * FROM customer",
    "ctas_terminals": "SELECT * FROM supplier",
    "ctas_customersterminals": """
SELECT c.*, s.* FROM (SELECT DISTINCT o_custkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey""",
    "typed_read": f"""
SELECT tx_id, tx_ts, cast(cast(tx_amount AS decimal(18,2)) AS double) AS tx_amount, cast(tx_fraud AS bigint) AS tx_fraud,
       tx_amount > 50 AS large FROM ({STAGED})""",
    "staging_join": STAGED,
    "features_preset_a": preset_sql(STAGED, PRESET_A),
    "features_preset_b": preset_sql(STAGED, PRESET_B),
    "features_preset_a_orders": preset_sql(ORDERS, PRESET_A),
    "features_preset_b_orders": preset_sql(ORDERS, PRESET_B),
    "read_instances": f"SELECT * FROM ({INSTANCES.format(between(preset_sql(STAGED, PRESET_A), TRAIN))}) WHERE {SAMPLED}",
    "training_columns": f"SELECT * EXCLUDE (tx_id, tx_ts, customer_id, terminal_id) FROM ({preset_sql(STAGED, PRESET_B)})",
    "time_split_train": between(STAGED, TRAIN),
    "time_split_val": between(STAGED, VALIDATION),
    "hash_sample": f"SELECT * FROM ({STAGED}) WHERE {SAMPLED}",
    "hash_sample_values": f"SELECT tx_id, {HASH} AS hash FROM ({STAGED})",
    "weekday": f"SELECT tx_id, dayname(tx_ts) AS day_of_the_week FROM ({TX})",
    "unix_seconds": f"SELECT tx_id, {SECOND.format('tx_ts')} AS seconds FROM ({TX})",
    "event_dates": f"SELECT tx_id, cast(cast(tx_ts AS date) AS varchar) AS tx_date FROM ({TX})",
    "roll_count": rolled(TX, block(["count"], ["1h", "5d"])),
    "roll_avg": rolled(TX, block(["avg"], ["1h", "5d"])),
    "roll_min": rolled(TX, block(["min"], ["1h", "5d"])),
    "roll_max": rolled(ORDERS, block(["max"], ["3d", "28d", "175d"], partition=["terminal_id"])),
    "roll_sum": rolled(TX, block(["sum"], ["1h", "5d"])),
    "roll_stddev": rolled(TX, block(["stddev", "var_samp"], ["1d", "7d"])),
    "roll_count_distinct": rolled(TX, block(["count", "count_distinct"], ["1h", "2d", "7d"], column=["terminal_id", "tx_amount"])),
    "roll_count_distinct_hot": rolled(
        EVENTS,
        block(["count_distinct"], ["10m", "36h", "14d"], column="customer_id", partition=["event_type"], exclude_current_row=False),
    ),
    "roll_approx_distinct": rolled(TX, block(["approx_count_distinct"], ["1h", "2d"], column="terminal_id")),
    "roll_include_current": rolled(
        ORDERS, block(["count", "avg", "max"], ["1d", "28d"], partition=["terminal_id"], exclude_current_row=False)
    ),
    "roll_units": rolled(TX, block(["count"], ["3600s", "90m", "6h", "2d", "1w"])),
    "roll_multi_key": rolled(ORDERS, block(["count", "avg"], ["28d", "52w"], partition=["customer_id", "terminal_id"])),
    "roll_multi_col": rolled(
        LINES,
        block(["count", "avg", "max"], ["28d", "175d"], column=["tx_amount", "l_quantity"], partition=["terminal_id"]),
    ),
    "roll_hot_key": rolled(EVENTS, HOT_BLOCK),
    "roll_chunked_orders": rolled(
        ORDERS, block(["count", "avg", "min", "max"], ["28d", "90d", "175d"], partition=["terminal_id"])
    ),
    "incremental_full": incremental_sql("full"),
    "incremental_delta": incremental_sql("delta"),
    "incremental_late": incremental_sql("full"),
    "incremental_states": incremental_sql("full"),
    "incremental_batches": incremental_sql("full"),
    "ingest_batch_twice": mapped(CUSTOMER),
    "incremental_first_load": incremental_sql("full"),
    "incremental_filter": f"""
SELECT * FROM ({TX}) WHERE cast(tx_ts AS date) >
  (SELECT max(cast(tx_ts AS date)) FROM ({TX}) WHERE cast(tx_ts AS date) <= DATE '{FIRST_LOAD_UNTIL.isoformat()}')""",
    "target_high_date": f"""
SELECT cast(max(cast(tx_ts AS date)) AS varchar) AS high_date, count(*) AS rows_on_it FROM ({TX})
WHERE cast(tx_ts AS date) = (SELECT max(cast(tx_ts AS date)) FROM ({TX}))""",
    "dq_not_null": f"SELECT tx_id, tx_amount FROM ({STAGED}) WHERE tx_fraud IS NULL",
    "dq_unique": f"SELECT tx_id, count(*) AS n FROM ({LINES}) WHERE tx_id IS NOT NULL GROUP BY tx_id HAVING count(*) > 1",
    "dq_freshness": f"""
SELECT latest, age_seconds,
       CASE WHEN age_seconds > 108000 THEN 'error' WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(tx_ts) AS latest,
             {SECOND.format("TIMESTAMP '2024-01-31 12:00:00'")} - {SECOND.format('max(tx_ts)')} AS age_seconds FROM ({TX}))""",
    "dq_report": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({failing})"
        for name, failing in {
            "events_tx_id_not_null": f"SELECT tx_id FROM ({TX}) WHERE tx_id IS NULL",
            "events_tx_id_unique": f"SELECT tx_id FROM ({TX}) GROUP BY tx_id HAVING count(*) > 1",
            "lineitem_tx_id_not_null": f"SELECT tx_id FROM ({LINES}) WHERE tx_id IS NULL",
            "lineitem_tx_id_unique": f"SELECT tx_id FROM ({LINES}) GROUP BY tx_id HAVING count(*) > 1",
            "orders_tx_id_unique": f"SELECT tx_id FROM ({ORDERS}) GROUP BY tx_id HAVING count(*) > 1",
        }.items()
    ),
    "schema_types": counted([({"column_name": c, "value_type": kind}, c) for c, kind in VALUE_TYPES.items()]),
    "feature_mapping": counted(mapping_rows(CUSTOMER) + mapping_rows(TERMINAL)),
    "registry_new_rows": counted(
        [({**row, "value_type": VALUE_TYPES[column]}, column) for row, column in mapping_rows(CUSTOMER)]
    ),
    "type_check": counted(
        [({**row, "stored_type": "DOUBLE", "table_type": "INT64"}, c) for row, c in mapping_rows(CUSTOMER, ["count_28d"])]
    ),
    "ingest_customer": mapped(CUSTOMER),
    "ingest_new_feature": in_turn([0], [0, 1]),
    "ingest_subset": in_turn([0, 1], [1]),
    "ingest_two_tables": f"""
SELECT customer_id AS entity_id, tx_ts AS feature_time, tx_id AS tie_break, avg_tx_amount_by_customer_id_7d_1s AS avg_amount_7d,
       NULL::BIGINT AS order_count_28d FROM ({preset_sql(STAGED, PRESET_B)})
UNION ALL SELECT customer_id, tx_ts, tx_id, NULL, count_tx_amount_by_customer_id_28d_1s FROM ({preset_sql(ORDERS, PRESET_B)})""",
    "asof_ties": " UNION ALL ".join(
        f"SELECT *, '{plan}' AS plan FROM (" + asof_sql(
            f"SELECT tx_id AS probe_id, event_type AS entity, tx_ts AS as_of FROM ({EVENTS})",
            f"SELECT event_type AS entity, cast(date_trunc('hour', tx_ts) AS timestamp) AS as_of, tx_id AS tie, tx_id AS row_id, tx_amount FROM ({EVENTS})",
            ["row_id", "tx_amount"],
        ) + ")"
        for plan in ("whole", "sliced")
    ),
    "features_created_at": f"SELECT tx_id, tx_ts, TIMESTAMP '2024-02-01 04:00:00' AS created_timestamp FROM ({STAGED})",
    "full_refresh": preset_sql(STAGED, PRESET_B),
    "roll_approx_distinct_wide": "SELECT tx_id, " + ", ".join(
        f"count(tx_id) OVER (PARTITION BY event_type ORDER BY {SECOND.format('tx_ts')} RANGE BETWEEN {days * 86400} PRECEDING AND 1 PRECEDING) AS n_{days}d, true AS close_{days}d"
        for days in (7, 28)
    ) + f" FROM ({EVENTS})",
    "roll_odd_lookback": rolled(ORDERS, block(["count", "avg", "max"], ["100003m", "28d"], partition=["terminal_id"])),
    "roll_stddev_double": moments_sql(),
    "roll_avg_double": all_magnitudes_sql(),
    "train_split_stats": " UNION ALL ".join(
        f"SELECT '{name}' AS split, count(*) AS n_rows, avg(cast(tx_fraud AS double)) AS label_mean FROM ({between(STAGED, bounds)}) WHERE tx_fraud IS NOT NULL"
        for name, bounds in (("train", LABELLED_TRAIN), ("validation", LABELLED_VALIDATION))
    ),
    "top_counted": "SELECT l_partkey AS feature, count(*) AS score FROM lineitem GROUP BY 1 ORDER BY score DESC, feature LIMIT 40",
    "ingest_terminal": mapped(TERMINAL),
    "asof_customer": asof_sql(hourly("customer_id"), CUSTOMER_VALUES, ["avg_1h", "avg_5d"]),
    "asof_terminal": asof_sql(hourly("terminal_id"), TERMINAL_VALUES, ["max_3d", "tx_amount"]),
    "asof_per_feature": per_feature_sql(),
    "asof_hot_entity": asof_sql(
        hourly("event_type", "probe_id"),
        f"SELECT event_type AS entity, tx_ts AS as_of, tx_id AS tie, tx_id AS row_id, tx_amount FROM ({EVENTS})",
        ["row_id", "tx_amount"],
    ),
    "serve_point_in_time": serve_sql(),
    "train_features": train_features_sql(),
}
