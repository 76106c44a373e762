"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints are 64-bit SimHashes of word shingles (XXH64). The anchors are
the codewords of the binary Hamming code [63, 57] on bits 0..62 times all
values of bit 63: a covering code of radius R = 1 over the 64-bit words. A
fingerprint is replicated to every anchor within its reach and fingerprints
are compared inside each anchor's cell.

Reach: two fingerprints at distance <= t have a midpoint at distance <=
ceil(t/2) from both, and some anchor lies within R of that midpoint. So both
reach it within R + ceil(t/2), a part of the ball "radius plus threshold"
that already loses no pair (t = 2: 33 anchors a fingerprint instead of 652).
The cell of an anchor then holds at most sum(C(64, i), i <= reach) distinct
fingerprints (2,081 for t = 2), whatever the data: equal fingerprints are
merged before, so no group of copies can fill a task.

Per cell only a spanning forest of the links is emitted, never all pairs;
its components are the components of all links.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise, pieces
from gapseries.llm.components import components

SEED = 42
RADIUS = 1


def words(text: str) -> list[bytes]:
    """Lower-case A-Z and split on space and U+0009..U+000D (bytes methods touch ASCII only)."""
    return text.encode().lower().split()


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash: bit i is set when over half the shingle hashes have it set; 0 without words."""
    own = words(text or "")
    if not own:
        return 0
    if len(own) < shingle:
        grams = [b" ".join(own)]
    else:
        grams = map(b" ".join, zip(*(own[i:] for i in range(shingle))))
    digests = b"".join(map(xxhash.xxh64_digest, grams, repeat(SEED)))
    hashes = np.frombuffer(digests, ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):       # bounded memory on very long texts
        part = hashes[at:at + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 key_col: str | None = None) -> DataFrame:
    """``(id, fingerprint)`` of every row, the fingerprint as a signed 64-bit integer; with ``key_col`` (binary) that column too."""
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("fingerprint", T.LongType()),
                           *([T.StructField(key_col, T.BinaryType())] if key_col else [])])

    def run(batches):
        for batch in pieces(batches):
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.columns[-1]), np.uint64, batch.num_rows)
            yield [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[1:-1]]
    kept = [F.col(key_col)] if key_col else []
    return docs.select(F.col(id_col).cast("long"), *kept, F.col(text_col)).mapInArrow(arrow_rows(run, schema), schema)


@cache
def anchor_masks(reach: int) -> list[np.ndarray]:
    """By syndrome: the masks of weight <= reach that turn a word of that syndrome into an anchor."""
    by: list[list[int]] = [[] for _ in range(64)]
    for weight in range(reach + 1):
        for bits in combinations(range(64), weight):
            syndrome, mask = 0, 0
            for b in bits:
                syndrome ^= (b + 1) & 63       # bit 63 has position 64: outside the code, syndrome 0
                mask |= 1 << b
            by[syndrome].append(mask)
    return [np.array(m, np.uint64) for m in by]


def syndromes(prints: np.ndarray) -> np.ndarray:
    """Hamming-code syndrome (XOR of the positions 1..63 of the set bits) of uint64 words."""
    out = np.zeros(len(prints), np.int64)
    for b in range(6):
        mask = np.uint64(sum(1 << j for j in range(63) if (j + 1) >> b & 1))
        out |= (np.bitwise_count(prints & mask) & 1).astype(np.int64) << b
    return out


def anchors(prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """All (anchor, fingerprint) pairs of the reach."""
    masks, own = anchor_masks(reach), syndromes(prints)
    left, right = [], []
    for s in np.unique(own):
        of = prints[own == s]
        left.append((of[:, None] ^ masks[s][None, :]).ravel())
        right.append(np.repeat(of, len(masks[s])))
    return np.concatenate(left), np.concatenate(right)


def forest(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``members`` (distinct uint64) with at most ``distance`` differing bits."""
    members = np.sort(members)
    root = np.arange(len(members))
    for i in range(len(members) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(members[i + 1:] ^ members[i]) <= distance)
        if len(near):
            roots = np.unique(root[np.append(near, i)])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    kids = np.flatnonzero(root != np.arange(len(members)))
    return list(zip(members[kids].view(np.int64).tolist(), members[root[kids]].view(np.int64).tolist()))


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints; their components are those of all links."""
    if not 0 <= distance <= 4:
        raise ValueError("distance must be 0 to 4")
    reach = RADIUS + -(-distance // 2)
    edge = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def replicate(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(own), 20_000):
                a, b = anchors(own[at:at + 20_000], reach)
                yield [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]

    def compare(batches):
        for batch in batches:
            out: list[tuple[int, int]] = []
            for cell in batch.column(0):
                out += forest(cell.values.to_numpy(zero_copy_only=False).view(np.uint64), distance)
            if out:
                yield [list(x) for x in zip(*out)]
    cells = (prints.mapInArrow(arrow_rows(replicate, edge), edge)
             .groupBy("a").agg(F.collect_set("b").alias("members")).where(F.size("members") > 1).select("members"))
    return cells.mapInArrow(arrow_rows(compare, edge), edge).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 2, key_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``(id, fingerprint, component_id)``.

    ``fingerprint``: 16 lower-case hex digits. ``component_id``: the smallest id
    reachable over links of at most ``distance`` bits, the row's own included.

    Null or wordless texts have fingerprint zero and link like any other; a null
    id never becomes a component id unless the whole component has null ids.
    Repeated rows are all returned. Other columns are ignored, but for a binary
    ``key_col``, which every row then brings back as a last column. An empty
    table gives an empty result.
    """
    kept = ["key"] if key_col else []
    own = materialise(fingerprints(docs, id_col, text_col, shingle, key_col).toDF("id", "fp", *kept), "fingerprints")
    groups = own.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(groups.select("fp"), distance)).withColumnsRenamed({"node": "fp"})
    placed = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = placed.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return own.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        *(F.col(k).alias(key_col) for k in kept))
