"""Embedding near-duplicates by cross-polytope hashing.

Vectors are normalised in double precision and rotated by three rounds of
random signs and a fast Hadamard transform; the hash of a rotation is the
signed axis of its largest component (a vertex of the cross-polytope). A table
concatenates ``PER_TABLE`` rotations; there are ``TABLES`` tables. Each vector
lies in its own bucket of every table and also probes the ``PROBES`` next best
ones (the vertices that lose least against the best). A pair is a candidate
where one side's own bucket is among the other's buckets, and linked only if
its exact cosine reaches the threshold.

Equal vectors are merged first, so copies cost one row. A bucket is compared
in blocks of ``BLOCK`` members against ``BLOCK`` members (a group per pair of
blocks, in separate tasks), so a large bucket is neither collected nor cut. A
pair is counted in the first table where it meets only. Blocks emit link
counts per vector and a spanning forest of their links, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, groups, materialise
from gapseries.llm.components import components

COSINE = 0.95
TABLES = 8
PER_TABLE = 3
PROBES = 3
BLOCK = 1024
SEED = 20240607


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two wide), scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def signs(width: int) -> np.ndarray:
    """(tables, rotations, rounds, width) of +1 and -1."""
    return np.random.default_rng([SEED, width]).choice([-1.0, 1.0], (TABLES, PER_TABLE, 3, width))


def buckets(unit: np.ndarray) -> np.ndarray:
    """(vectors, tables, 1 + PROBES) bucket codes; the first is the vector's own, the rest its probes."""
    n, dim = unit.shape
    width = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    flips, out = signs(width), np.zeros((n, TABLES, 1 + PROBES), np.int64)
    for t in range(TABLES):
        order, loss = [], []
        for r in range(PER_TABLE):
            x = padded
            for k in range(3):
                x = hadamard(x * flips[t, r, k])
            both = np.concatenate([x, -x], axis=1)              # one column per vertex
            top = np.argsort(-both, axis=1, kind="stable")[:, :1 + PROBES]
            value = np.take_along_axis(both, top, 1)
            order.append(top)
            loss.append((value[:, :1] - value) ** 2)
        codes, cost = order[0], loss[0]
        for r in range(1, PER_TABLE):                           # cheapest combinations of vertices
            codes = (codes[:, :, None] * (2 * width) + order[r][:, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] + loss[r][:, None, :]).reshape(n, -1)
            pick = np.argsort(cost, axis=1, kind="stable")[:, :1 + PROBES]
            codes, cost = np.take_along_axis(codes, pick, 1), np.take_along_axis(cost, pick, 1)
        out[:, t, :codes.shape[1]] = codes
        out[:, t, codes.shape[1]:] = codes[:, :1]
    return out


def normalise(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of a list column that can link, and their unit vectors (double precision)."""
    good, out = [], []
    for i, x in enumerate(column):
        if x.is_valid and len(x.values) and not x.values.null_count:
            v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(v).max()
            if np.isfinite(top) and top > 0:
                v = v / top                                     # no overflow or underflow in the squares
                good.append(i)
                out.append(v / np.sqrt(v @ v))
    return np.array(good, np.int64), out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links (a, b) over nodes 0..n-1."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = find(i), find(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``(id, n_links, component_id, kept)``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; vectors of different lengths do not link. Copies link
    with each other. ``component_id``: the smallest id reachable over links.
    ``kept``: the id is its component's. Rows that share an id are all returned
    and count as vectors of their own. Other columns are ignored; an empty
    table gives an empty result.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = (F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists("v", lambda x: x != 0.0))
    # adding zero turns -0.0 into 0.0, so that equal vectors are equal bytes
    classes = materialise(own.where(usable).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
                          .groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "classes")
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("c"), "v", "least", "copies"), "classes")
    hashes = T.StructType([T.StructField("c", T.LongType()), T.StructField("copies", T.LongType()),
                           T.StructField("codes", T.BinaryType()), T.StructField("unit", T.BinaryType())])
    keys = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("c", T.LongType()), T.StructField("home", T.BooleanType())])

    def hashed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                good, units = normalise(part.column(1))
                by_size: dict[int, list[int]] = {}
                for k, u in enumerate(units):
                    by_size.setdefault(len(u), []).append(k)
                for members in by_size.values():
                    unit = np.stack([units[k] for k in members])
                    take = part.take(pa.array(good[members]))
                    yield [take.column(0), take.column(2), pa.array([c.tobytes() for c in buckets(unit)], pa.binary()),
                           pa.array([u.tobytes() for u in unit], pa.binary())]

    def spread(batches):
        table = np.repeat(np.arange(TABLES), 1 + PROBES)
        home = np.tile(np.arange(1 + PROBES) == 0, TABLES)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n = part.num_rows
                codes = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64).reshape(n, -1)
                size = np.array([len(u.as_buffer()) for u in part.column(2)], np.int64)[:, None]
                key = (codes * 65_536 + size % 65_536) * TABLES + table
                yield [pa.array(key.ravel()), pa.array(np.repeat(part.column(0).to_numpy(), key.shape[1])),
                       pa.array(np.tile(home, n))]
    table = materialise(classes.select("c", "v", "copies").mapInArrow(arrow_rows(hashed, hashes), hashes), "hashes")
    # a probe may repeat the own bucket when the vector is short
    places = (table.select("c", "codes", "unit").mapInArrow(arrow_rows(spread, keys), keys)
              .groupBy("bucket", "c").agg(F.max("home").alias("home")))
    places = materialise(places, "buckets")
    # buckets of one member need no comparison; the others are cut into blocks
    sizes = (places.groupBy("bucket").agg(F.count("*").alias("n"), F.max("home").alias("any")).where("n > 1 and any")
             .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    member = (places.join(sizes, "bucket").join(table, "c")
              .withColumn("block", F.pmod(F.xxhash64(F.lit(5), "c"), F.col("blocks")).cast("int"))
              # a member's block meets every block: the pairs (low, high) that contain it
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                      "block", "c", "copies", "home", "codes", "unit")
              .repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high"))
    out = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("n", T.LongType())])

    def compare(group: pa.Table) -> list:
        n, t = group.num_rows, group.column(0)[0].as_py() % TABLES
        blocks = group.column(1)[0].as_py() != group.column(2)[0].as_py()
        block, c, copies = (group.column(k).to_numpy() for k in (3, 4, 5))
        home = group.column(6).to_numpy(zero_copy_only=False)
        codes = np.frombuffer(b"".join(group.column(7).to_pylist()), np.int64).reshape(n, TABLES, 1 + PROBES)
        unit = np.frombuffer(b"".join(group.column(8).to_pylist()), np.float64).reshape(n, -1)
        left, right = [], []
        for i0 in range(0, n, 512):                             # bounded memory a step
            i, j = np.nonzero(unit[i0:i0 + 512] @ unit.T >= cosine - 1e-9)
            i = i + i0
            ok = (i < j) & (home[i] | home[j])
            if blocks:
                ok &= block[i] != block[j]
            i, j = i[ok], j[ok]
            for at in range(0, len(i), 50_000):
                x, y = i[at:at + 50_000], j[at:at + 50_000]
                good = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
                # the two may meet in either one's own bucket: then the one with the smaller class counts
                other, owner = np.where(home[x], y, x), np.where(home[x], x, y)
                good &= (home[x] & home[y]) | (c[owner] < c[other]) | ~(codes[other, t, :1] == codes[owner, t, :]).any(1)
                for s in range(t):                              # met in an earlier table already?
                    good &= ~((codes[x, s, :1] == codes[y, s, :]).any(1) | (codes[y, s, :1] == codes[x, s, :]).any(1))
                left.append(x[good])
                right.append(y[good])
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
        count = np.zeros(n, np.int64)
        np.add.at(count, a, copies[b])
        np.add.at(count, b, copies[a])
        some, tree = np.flatnonzero(count), _forest(n, a, b)
        return [c[some].tolist() + [int(c[i]) for i, _ in tree], [None] * len(some) + [int(c[j]) for _, j in tree],
                count[some].tolist() + [0] * len(tree)]

    def compared(batches):
        columns: list[list] = [[], [], []]
        for group in groups(batches, 3):
            for column, more in zip(columns, compare(group)):
                column += more
            if len(columns[0]) > 50_000:
                yield columns
                columns = [[], [], []]
        if columns[0]:
            yield columns
    found = materialise(member.mapInArrow(arrow_rows(compared, out), out), "links")
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "c")
    roots = components(found.where("b is not null").select("a", "b").distinct()).withColumnsRenamed({"node": "c"})
    placed = (classes.join(links, "c", "left").join(roots, "c", "left")
              .select("v", "least", F.coalesce("root", "c").alias("root"),
                      (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = placed.join(least, "root").select("v", "n_links", "component_id")
    every = own.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0)))).join(labelled, "v", "left")
    component = F.coalesce("component_id", "id")
    return every.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
