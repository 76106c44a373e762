"""Block table contract: the one source of truth for column types.

The contract is a ``StructType`` whose ``StructField.metadata`` carries what
the rules need (feature rank, deprecated flag, block the column exists from,
``minimum``). Readers pass it to ``DataFrameReader.schema`` so no schema is
inferred, and the quality layer derives its checks from it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source contract for right results)
# Protocol era boundaries on Ethereum mainnet, block numbers:
#   London / EIP-1559 (base fee introduced)   12965000
#   The Merge (difficulty is 0 from here)      15537394
#   Dencun / EIP-4844 (blob gas introduced)    19426587
# Blob gas per blob 131072, default maximum blobs per block 6.
# Total difficulty reached at the Merge 58750003716598352816469.
# ---------------------------------------------------------------------------
LONDON_BLOCK = 12_965_000
MERGE_BLOCK = 15_537_394
DENCUN_BLOCK = 19_426_587
BLOB_GAS_PER_BLOB = 131_072
DEFAULT_MAX_BLOBS = 6
TERMINAL_TOTAL_DIFFICULTY = 58750003716598352816469

# Standard projection order of a block read; the two deprecated columns are
# added only on request.
STANDARD_COLUMNS = [
    "timestamp", "number", "gas_limit", "gas_used", "base_fee_per_gas",
    "transaction_count", "size", "blob_gas_used", "excess_blob_gas",
]
DEPRECATED_COLUMNS = ["difficulty", "total_difficulty"]

UINT256 = T.DecimalType(38, 0)


@dataclass(frozen=True)
class Era:
    name: str
    start_block: int
    description: str


def _field(name, dtype, nullable, rank=None, deprecated=False, since=None, minimum=None, comment=None):
    md = {}
    if rank is not None:
        md["rank"] = rank
    if deprecated:
        md["deprecated"] = True
    if since is not None:
        md["since_block"] = since
    if minimum is not None:
        md["minimum"] = minimum
    if comment:
        md["comment"] = comment
    return T.StructField(name, dtype, nullable, md)


def block_contract(eras: dict[str, int] | None = None) -> T.StructType:
    """Block table schema with rule metadata.

    ``eras`` overrides the availability boundaries (used for scaled test
    data); keys ``london``, ``merge``, ``dencun``.
    """
    e = {"london": LONDON_BLOCK, "merge": MERGE_BLOCK, "dencun": DENCUN_BLOCK}
    e.update(eras or {})
    return T.StructType([
        _field("timestamp", T.TimestampType(), False, comment="block time, UTC, ms"),
        _field("number", T.LongType(), False, minimum=0, comment="block number, key"),
        _field("gas_limit", T.LongType(), False, rank=None, minimum=0),
        _field("gas_used", T.LongType(), False, rank=2, minimum=0),
        _field("base_fee_per_gas", T.LongType(), False, rank=1, since=e["london"], minimum=0),
        _field("transaction_count", T.LongType(), False, rank=3, minimum=0),
        _field("size", T.LongType(), False, rank=4, minimum=0),
        _field("blob_gas_used", T.LongType(), True, since=e["dencun"], minimum=0),
        _field("excess_blob_gas", T.LongType(), True, since=e["dencun"], minimum=0),
        _field("difficulty", UINT256, False, deprecated=True, minimum=0),
        _field("total_difficulty", UINT256, False, deprecated=True, minimum=0),
    ])


def mempool_contract() -> T.StructType:
    """Bitcoin mempool snapshot schema (9 columns)."""
    return T.StructType([
        _field("timestamp", T.TimestampType(), False),
        _field("unconfirmed_count", T.LongType(), False, minimum=0),
        _field("vsize_mb", T.DoubleType(), False, minimum=0),
        _field("total_fee_btc", T.DoubleType(), False, minimum=0),
        _field("fastest_fee", T.DoubleType(), False, minimum=1),
        _field("half_hour_fee", T.DoubleType(), False, minimum=1),
        _field("hour_fee", T.DoubleType(), False, minimum=1),
        _field("economy_fee", T.DoubleType(), False, minimum=1),
        _field("minimum_fee", T.DoubleType(), False, minimum=1),
    ])


GAP_STATE_SCHEMA = T.StructType([
    T.StructField("gap_start", T.LongType(), False),
    T.StructField("gap_end", T.LongType(), False),
    T.StructField("gap_size", T.LongType(), False),
    T.StructField("first_seen", T.TimestampType(), False),
    T.StructField("last_seen", T.TimestampType(), False),
    T.StructField("notified", T.BooleanType(), False),
])

CONTRACTS = {"ethereum_mainnet": block_contract, "bitcoin_mempool": mempool_contract}


def contract_schema(name: str, **kw) -> T.StructType:
    """Contract by chain name (SRC-14): a built-in one, or one that :func:`load_contract` has read."""
    if name not in CONTRACTS:
        raise ValueError(f"unknown contract {name!r}; known: {sorted(CONTRACTS)}")
    return CONTRACTS[name](**kw)


#: what a column of a contract file may say
COLUMN_KEYS = {"name", "type", "nullable", "minimum", "since_block", "rank", "deprecated", "comment"}


def parse_contract(text: str) -> tuple[str, T.StructType]:
    """``(chain, contract)`` of a JSON document ``{"chain": ..., "columns": [{"name", "type", ...}]}``.

    A column has a name and a Spark SQL type (``bigint``, ``decimal(38,0)``,
    ``array<string>``) and may say ``nullable`` (default true), ``minimum``,
    ``since_block``, ``rank``, ``deprecated`` and ``comment``. Whatever else
    the document says is refused, so that a misspelt rule is not a lost one.
    """
    doc = json.loads(text)
    if not isinstance(doc, dict) or not isinstance(doc.get("chain"), str) or not isinstance(doc.get("columns"), list) or not doc["columns"]:
        raise ValueError("a contract has a chain and a list of columns")
    if set(doc) - {"chain", "columns"}:
        raise ValueError(f"unknown entry {sorted(set(doc) - {'chain', 'columns'})[0]!r} in the contract of {doc['chain']}")
    fields = []
    for c in doc["columns"]:
        where = f"column {c.get('name')!r} of {doc['chain']}"
        if set(c) - COLUMN_KEYS:
            raise ValueError(f"unknown entry {sorted(set(c) - COLUMN_KEYS)[0]!r} in {where}")
        if not isinstance(c.get("name"), str) or not isinstance(c.get("type"), str):
            raise ValueError(f"{where} needs a name and a type")
        if any(isinstance(c.get(k), bool) or not isinstance(c.get(k, 0), (int, float)) for k in ("minimum", "since_block", "rank")):
            raise ValueError(f"minimum, since_block and rank of {where} are numbers")
        fields.append(_field(c["name"], T.DataType.fromDDL(c["type"]), bool(c.get("nullable", True)), c.get("rank"), bool(c.get("deprecated")),
                             c.get("since_block"), c.get("minimum"), c.get("comment")))
    names = [f.name.lower() for f in fields]
    if len(set(names)) < len(names):
        raise ValueError(f"the contract of {doc['chain']} names a column twice")
    return doc["chain"], T.StructType(fields)


def load_contract(spark: SparkSession, path: str) -> T.StructType:
    """SRC-14: read a contract file (from any store Spark reads) and make it known to :func:`contract_schema`."""
    chain, contract = parse_contract(spark.read.text(path, wholetext=True).first()[0])
    CONTRACTS[chain] = lambda: contract
    return contract


def violations(contract: T.StructType, key: str | None = None):
    """Column: names of the rules a row breaks (``<column>:null``, ``<column>:minimum``), in the contract's order.

    A column that exists from ``since_block`` on must hold a value only for
    rows whose ``key`` has reached that block; its minimum holds everywhere.
    """
    checks = []
    for f in contract.fields:
        md = f.metadata or {}
        if not f.nullable:
            missing = F.col(f"`{f.name}`").isNull()
            if md.get("since_block") is not None and key:
                missing = missing & (F.col(key) >= F.lit(md["since_block"]))
            checks.append(F.when(missing, F.lit(f"{f.name}:null")))
        if md.get("minimum") is not None:
            checks.append(F.when(F.col(f"`{f.name}`") < F.lit(md["minimum"]), F.lit(f"{f.name}:minimum")))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def read_contract(spark: SparkSession, path: str, contract: T.StructType, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-14: a Parquet table read by its contract: ``(rows that keep it, rows that break it with their violations)``.

    The contract is the read schema: nothing is inferred, other columns are
    not read, a column that the files lack is NULL and so breaks a null rule.
    """
    # declared nullable for the read: the null rules are checked, not assumed
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in contract.fields])
    rows = spark.read.schema(schema).parquet(path).withColumn("violations", violations(contract, key))
    return rows.filter(F.size("violations") == 0).drop("violations"), rows.filter(F.size("violations") > 0)


def default_eras(london: int = LONDON_BLOCK, merge: int = MERGE_BLOCK, dencun: int = DENCUN_BLOCK) -> list[Era]:
    return [
        Era("london", london, "EIP-1559: base_fee_per_gas introduced"),
        Era("merge", merge, "Proof of stake: difficulty is 0"),
        Era("dencun", dencun, "EIP-4844: blob gas introduced"),
    ]


def protocol_eras(spark: SparkSession, eras: list[Era] | None = None) -> DataFrame:
    """META-2: the era table, one row per protocol era (3 rows).

    ``end_block`` is the first block of the next era (half-open) or NULL.
    """
    eras = eras or default_eras()
    rows = []
    for i, e in enumerate(eras):
        nxt = eras[i + 1].start_block if i + 1 < len(eras) else None
        rows.append((e.name, e.start_block, nxt, e.description))
    schema = "era string, start_block bigint, end_block bigint, description string"
    return spark.createDataFrame(rows, schema)


def schema_diff(spark: SparkSession, contract: T.StructType, live: T.StructType) -> DataFrame:
    """JN-10: contract vs live columns, both directions.

    One row per column name present on either side: ``status`` is
    ``missing_in_live``, ``extra_in_live``, ``type_mismatch``,
    ``comment_mismatch`` (only when both sides carry a comment) or ``ok``.
    Both inputs are schemas (metadata), so the join is between two tiny
    DataFrames of column descriptions.
    """
    def rows(st):
        return [(f.name, f.dataType.simpleString(), f.nullable, (f.metadata or {}).get("comment")) for f in st.fields]
    schema = "name string, type string, nullable boolean, comment string"
    c = spark.createDataFrame(rows(contract), schema).alias("c")
    lv = spark.createDataFrame(rows(live), schema).alias("l")
    j = c.join(lv, on="name", how="full")
    status = (F.when(F.col("c.type").isNull(), "extra_in_live")
              .when(F.col("l.type").isNull(), "missing_in_live")
              .when(F.col("c.type") != F.col("l.type"), "type_mismatch")
              .when(F.col("c.comment").isNotNull() & F.col("l.comment").isNotNull()
                    & (F.col("c.comment") != F.col("l.comment")), "comment_mismatch")
              .otherwise("ok"))
    return j.select("name", F.col("c.type").alias("contract_type"), F.col("l.type").alias("live_type"),
                    status.alias("status"))
