"""Registry of named query plans bound to the driver tables.

A plan is a function ``(spark, sf_dir) -> DataFrame``; its optional SQL twin
(DuckDB dialect, over the raw tables) is the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

_PLANS: dict[str, Plan] = {}
_SQL: dict[str, str] = {}
_IDS: dict[str, str] = {}


def register(name: str, ids: str = "", sql: str | None = None):
    def deco(fn: Plan) -> Plan:
        if name in _PLANS:
            raise ValueError(f"duplicate plan {name}")
        _PLANS[name] = fn
        _IDS[name] = ids
        if sql is not None:
            _SQL[name] = round9_sql(sql)
        return fn
    return deco


SCALE = 1e9


def round9_sql(sql: str) -> str:
    """Rewrite ``round(x, 9)`` as ``round(x * 1e9) / 1e9``: the same IEEE operations
    as :func:`round_doubles`, so both engines round a value to the same double."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k, depth = j + len(key), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        head, _, tail = inner.rpartition(",")
        if head and tail.strip() == "9":
            out.append(sql[i:j] + f"(round(({round9_sql(head)}) * 1e9) / 1e9)")
        else:
            out.append(sql[i:k])
        i = k


def plans() -> dict[str, Plan]:
    _load()
    return dict(_PLANS)


def sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def operator_ids() -> dict[str, str]:
    _load()
    return dict(_IDS)


def _load() -> None:
    # importing the modules fills the registry
    from gapseries.plans import (  # noqa: F401
        q_reads, q_gaps, q_windows, q_joins, q_rollups, q_quality, q_sources, q_features, q_streaming, q_sinks,
        q_coverage,
    )


def round_doubles(df, digits: int = 9):
    """Round every double column of a plan's output (oracle comparisons
    hash values; float sums in another order differ in the last bits)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    scale = F.lit(float(10 ** digits))
    return df.select(*[(F.round(F.col(f.name) * scale) / scale).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def r9(c):
    """``round(x * 1e9) / 1e9`` on a column (or column name): the Spark half of :func:`round9_sql`."""
    from pyspark.sql import functions as F
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(SCALE)) / F.lit(SCALE)
