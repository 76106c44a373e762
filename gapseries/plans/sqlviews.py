"""ANSI-SQL (DuckDB dialect) twins of the derived driver views.

Used only by ``oracle_sql()``: each oracle query starts with ``WITH`` plus
the CTEs it needs, so it runs against the raw pre-registered tables.
"""

from gapseries.sources.driver import GAS_LIMIT, SCALED_DENCUN, SCALED_LONDON, SCALED_MERGE


def _block_select(factor: int, seq: int, src: str) -> str:
    return f"""SELECT CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS "timestamp",
        event_id AS number,
        CAST({GAS_LIMIT} AS BIGINT) AS gas_limit,
        CAST(LEAST({GAS_LIMIT}, CAST(round(value * {factor}) AS BIGINT)) AS BIGINT) AS gas_used,
        CAST(CASE WHEN event_id >= {SCALED_LONDON} THEN (20 + (event_id * 7919) % 81) * 1000000000 ELSE 0 END
             AS BIGINT) AS base_fee_per_gas,
        CAST(1 + user_id AS BIGINT) AS transaction_count,
        CAST(50000 + 200 * (1 + user_id) AS BIGINT) AS size,
        CAST(CASE WHEN event_id >= {SCALED_DENCUN} THEN 131072 * (event_id % 7) END AS BIGINT) AS blob_gas_used,
        CAST(CASE WHEN event_id >= {SCALED_DENCUN} THEN 131072 * ((event_id * 3) % 5) END AS BIGINT)
             AS excess_blob_gas,
        CASE WHEN event_id >= {SCALED_MERGE} THEN CAST(0 AS DECIMAL(38,0))
             ELSE CAST(1000000000000000 + event_id * 1000 AS DECIMAL(38,0)) END AS difficulty,
        CAST('58750003716598352816469' AS DECIMAL(38,0)) AS total_difficulty,
        CAST({seq} AS BIGINT) AS _ingest_seq
      FROM {src}"""


RAW_BLOCKS = f"""ev AS (SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'error'),
raw_blocks AS (
  {_block_select(60000, 1, 'ev')}
  UNION ALL
  {_block_select(61000, 2, "ev WHERE event_type = 'click'")}
)"""

BLOCKS = RAW_BLOCKS + """,
blocks AS (
  SELECT * EXCLUDE (_rn, _ingest_seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY number ORDER BY _ingest_seq DESC) AS _rn FROM raw_blocks
  ) WHERE _rn = 1
)"""

SOURCES = f"""src_primary AS (
  SELECT * EXCLUDE (_ingest_seq) FROM ({_block_select(60000, 1,
    "events WHERE event_type NOT IN ('error', 'signup')")})
),
src_backfill AS (
  SELECT * EXCLUDE (_ingest_seq) FROM ({_block_select(60000, 3,
    "events WHERE event_type IN ('signup', 'view')")})
)"""

PURCHASES = """purchases AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, value FROM events WHERE event_type = 'purchase'
)"""

VIEWS = """views AS (
  SELECT event_id AS view_id, CAST(ts AS TIMESTAMP) AS ts, user_id, value AS view_value
  FROM events WHERE event_type = 'view'
)"""

BARS = PURCHASES + """,
bars AS (
  SELECT 'EVT' AS symbol, date_trunc('hour', ts) AS ts,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, sum(value) AS volume, count(*) AS trades
  FROM purchases GROUP BY date_trunc('hour', ts)
)"""


TXS = """txs AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_hash, l_orderkey AS block_number,
         CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN 1 ELSE 2 END AS type,
         CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_extendedprice) AS BIGINT) * 1000000 END AS gas_price,
         CASE WHEN l_returnflag = 'N' THEN CAST(round(l_extendedprice) AS BIGINT) * 2000000 END AS max_fee_per_gas,
         CASE WHEN l_returnflag = 'N' THEN CAST(round(l_discount * 100) AS BIGINT) * 1000000000 END
           AS max_priority_fee_per_gas,
         CAST(CAST(l_quantity AS DECIMAL(38,0)) * CAST('100000000000000000' AS DECIMAL(38,0)) AS DECIMAL(38,0)) AS value_wei,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN NULL
              ELSE '0x' || lpad(lower(hex(l_suppkey)), 40, '0') END AS to_address,
         CASE WHEN l_linestatus = 'O' THEN '0xa9059cbb' ELSE '0x' END AS input
  FROM lineitem
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
