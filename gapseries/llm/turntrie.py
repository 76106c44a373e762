"""Prefix trie of conversations with totals per subtree, rolled up in depth bands.

A node is a distinct sequence of first ``d`` turns; its key is a prefix hash.
Turns are ordered by ranges of ``(conversation, turn)``, so one conversation
with a third of all turns is spread over many tasks: a walk of a partition
numbers turns and extends the prefix hash, and what a border cuts is carried on
(``ordering.spans``). The prefix hash is a polynomial over the 128-bit digests
of the turns modulo the prime 2^127 - 1, hence sums up over borders.

*Depth-band rollup.* Depths are cut into bands of ``band`` levels. A node is
exploded only to its ancestors within its band (at most ``band`` rows, and only
nodes that have something to add), which completes the totals inside a band.
The totals of the band roots form a trie that is ``band`` times less deep; it is
rolled up in the same way, the completed total of a band root is given to its
parent in the band above, and one more explosion within bands spreads it. So
there are ``log(depth) / log(band)`` rounds, and no node meets more than
``band`` ancestors in any of them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise
from gapseries.llm.ordering import spans

BAND = 16
CHUNK_BYTES = 1 << 20               # of a list of members that is hashed
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefix").digest(), "big") % PRIME
ROOT = bytes(16)
_LONG, _BYTES = T.LongType(), T.BinaryType()


def _int(x: bytes) -> int:
    return int.from_bytes(x, "big")


def _bytes(x: int) -> bytes:
    return x.to_bytes(16, "big")


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``(conv, turn, digest, words)``: the turn's content as 128 bits and the words of its text.

    Null roles and texts count as empty. Rows without a conversation id belong to no conversation and are left out.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(content, 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, pos, prefix, before, words)``: position from 1 and the prefix hash with and without the turn.

    Turns are in the order of ``turn`` (null first); turns that tie are in the order of their digests.
    """
    fields = [T.StructField("conv", _LONG), T.StructField("pos", _LONG), T.StructField("prefix", _BYTES), T.StructField("before", _BYTES),
              T.StructField("words", _LONG)]

    def walk(batches):
        own, pos, state = None, 0, 0
        for batch in batches:
            convs, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at, after, before = [], [], []
            for conv, digest in zip(convs, digests):
                if conv != own:
                    own, pos, state = conv, 0, 0
                before.append(_bytes(state))
                pos, state = pos + 1, (state * BASE + _int(digest) + 1) % PRIME
                at.append(pos)
                after.append(_bytes(state))
            yield [batch.column(0), at, after, before, batch.column(3)]
    cut = spans(turns, ["conv", "turn", "digest"], walk, fields, "turns")
    # one row a partition: how it starts and what its last conversation has come to
    edges = cut.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "pos", "prefix")).alias("last")).collect()
    carried, open_ = {}, None
    for e in sorted(edges, key=lambda e: e["part"]):
        conv, pos, state = e["last"]["conv"], e["last"]["pos"], _int(e["last"]["prefix"])
        if open_ and open_[0] == e["first"]:
            carried[e["part"]] = open_
            if conv == e["first"]:
                state = (open_[2] * pow(BASE, pos, PRIME) + state) % PRIME
                pos += open_[1]
        open_ = (conv, pos, state)
    shared = cut.sparkSession.sparkContext.broadcast(carried)

    def mend(batches):
        known = shared.value
        for batch in batches:
            part, *columns = (c.to_pylist() for c in batch.columns)
            if not known.keys().isdisjoint(part):
                for i, (p, conv, pos) in enumerate(zip(part, columns[0], columns[1])):
                    if p in known and known[p][0] == conv:
                        _, done, state = known[p]
                        power = pow(BASE, pos - 1, PRIME)
                        columns[1][i] = pos + done
                        columns[3][i] = _bytes((state * power + _int(columns[3][i])) % PRIME)
                        columns[2][i] = _bytes((state * power * BASE + _int(columns[2][i])) % PRIME)
            yield columns
    schema = T.StructType(fields)
    return cut.mapInArrow(arrow_rows(mend, schema), schema)


def members(own: DataFrame, head: Column | None = None, source: Column | None = None, most: int = 3) -> DataFrame:
    """``(conv, depth, id, before, words, last)``: the nodes that each (rebuilt) conversation passes, the root included.

    ``own``: rows of ``prefixes``. A conversation ``conv`` is rebuilt as the first ``head`` (0 to ``most``) turns of conversation
    ``source`` (both are expressions over ``conv``; all if it has fewer, none if it is absent), then its own turns after its
    first ``head``. Without ``head`` conversations stay as they are. ``last`` marks the node at which the conversation ends.
    """
    head = F.lit(0) if head is None else head
    source = F.col("conv") if source is None else source
    start = [F.max(F.when(F.col("pos") == i, F.struct("prefix", "words"))).alias(f"at{i}") for i in range(1, most + 1)]
    convs = own.groupBy("conv").agg(F.max("pos").alias("turns"), *start)
    first = F.struct(F.lit(ROOT).alias("prefix"), F.lit(0).cast("long").alias("words"))
    convs = convs.select("conv", "turns", F.array(first, *[f"at{i}" for i in range(1, most + 1)]).alias("start"),
                         head.cast("long").alias("head"), source.alias("source"))
    convs = materialise(convs, "conversations")
    plan = (convs.alias("c").join(convs.select(F.col("conv").alias("source"), F.col("turns").alias("there"), F.col("start").alias("lead")).alias("s"),
                                  "source", "left")
            .select("conv", "turns", "start", "lead", "head", F.least("head", F.coalesce("there", F.lit(0).cast("long"))).alias("taken"),
                    F.least("head", "turns").alias("cut")))
    plan = plan.withColumn("total", F.col("taken") + F.col("turns") - F.col("cut"))
    lead = F.coalesce("lead", F.array(first))
    depth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken"))).alias("depth")
    heads = plan.select("conv", "total", lead.alias("lead"), depth).select(
        "conv", "depth", F.element_at("lead", (F.col("depth") + 1).cast("int"))["prefix"].alias("id"),
        F.element_at("lead", F.greatest("depth", F.lit(1)).cast("int"))["prefix"].alias("before"),
        F.element_at("lead", (F.col("depth") + 1).cast("int"))["words"].alias("words"), (F.col("depth") == F.col("total")).alias("last"))
    pick = lambda column, i: F.element_at(column, (F.col(i) + 1).cast("int"))["prefix"]     # noqa: E731
    tails = own.join(plan.where("total > taken").select("conv", "cut", "taken", "total", pick("start", "cut").alias("from_"),
                                                        pick(lead, "taken").alias("onto")), "conv").where("pos > cut")
    out = T.StructType([T.StructField("conv", _LONG), T.StructField("depth", _LONG), T.StructField("id", _BYTES), T.StructField("before", _BYTES),
                        T.StructField("words", _LONG), T.StructField("last", T.BooleanType())])

    def graft(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for conv, pos, prefix, before, words, cut, taken, total, from_, onto in zip(*(c.to_pylist() for c in batch.columns)):
                if from_ != onto:
                    shift, power = _int(onto) - _int(from_), pow(BASE, pos - cut - 1, PRIME)
                    before = _bytes((_int(before) + shift * power) % PRIME)
                    prefix = _bytes((_int(prefix) + shift * power * BASE) % PRIME)
                depth = taken + pos - cut
                for column, value in zip(columns, (conv, depth, prefix, before, words, depth == total)):
                    column.append(value)
            yield columns
    tails = tails.select("conv", "pos", "prefix", "before", "words", "cut", "taken", "total", "from_", "onto").mapInArrow(arrow_rows(graft, out), out)
    return materialise(heads.select(*out.names).unionByName(tails), "members")


def _paths(steps: DataFrame, band: int) -> DataFrame:
    """``steps`` (conv, depth, id, ...) with ``path``: the ids from the band's top to the node itself."""
    within = Window.partitionBy("conv", F.floor(F.col("depth") / band)).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("path", F.collect_list("id").over(within))       # at most band ids


def _spread(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Totals ``(id, *values)`` of every node over its descendants within its band; nodes that add nothing travel nowhere."""
    some = nodes.where(" or ".join(f"{v} <> 0" for v in values))
    return some.select(F.explode("path").alias("id"), *values).groupBy("id").agg(*[F.sum(v).alias(v) for v in values])


def rollup(nodes: DataFrame, steps: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """``(id, *values)``: for every node the sums of ``values`` over its subtree, itself included (no row: zeros).

    ``nodes``: ``(id, depth, before, path, *values)``, one row a node, ``before`` its parent; ``steps``: ``(conv, depth, id)``,
    every node of every conversation, from which the paths of band roots are taken.
    """
    deepest = nodes.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < band:
        return _spread(nodes, values)
    roots = steps.where(F.col("depth") % band == 0).select("conv", (F.col("depth") / band).cast("long").alias("depth"), "id")
    roots = materialise(roots, "roots")
    up = _paths(roots, band).groupBy("id", "depth").agg(F.first("path").alias("path"))
    inside = nodes.groupBy(F.element_at("path", 1).alias("id")).agg(*[F.sum(v).alias(v) for v in values])
    links = nodes.where((F.col("depth") > 0) & (F.col("depth") % band == 0)).select("id", "before")
    tops = links.join(nodes.select(F.col("id").alias("before"), F.element_at("path", 1).alias("top")), "before").select("id", F.col("top").alias("before"))
    # the trie of band roots is band times less deep; there the parent is the top of the band above
    bands = materialise(up.join(inside, "id").join(tops, "id", "left"), "bands")
    done = materialise(rollup(bands, roots, values, band), "completed")
    given = (done.join(links, "id")
             .groupBy(F.col("before").alias("id")).agg(*[F.sum(v).alias(f"more_{v}") for v in values]))
    nodes = nodes.join(given, "id", "left").select("id", "path", *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0).cast("long"))).alias(v) for v in values])
    return _spread(nodes, values)


def _ends(steps: DataFrame) -> DataFrame:
    """``(id, ends_sha256)`` of the conversations that end at a node, ascending, comma-joined.

    Ranges of ``(node, conversation)`` are joined to chunks first, so a node at which a third of all conversations end
    reaches its one hashing task as a few chunks, which it reads one after the other.
    """
    chunk = T.StructType([T.StructField("id", _BYTES), T.StructField("first", _LONG), T.StructField("text", _BYTES)])
    ends = steps.where("last").select("id", "conv").repartitionByRange("id", "conv").sortWithinPartitions("id", "conv")

    def join(batches):
        own, first, held, size, out = None, 0, [], 0, [[], [], []]
        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (node != own or size >= CHUNK_BYTES):
                    for column, value in zip(out, (own, first, ",".join(held).encode())):
                        column.append(value)
                    held, size = [], 0
                if not held:
                    own, first = node, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if sum(map(len, out[2])) >= CHUNK_BYTES:
                yield out
                out = [[], [], []]
        if held:
            for column, value in zip(out, (own, first, ",".join(held).encode())):
                column.append(value)
        if out[0]:
            yield out
    digest = T.StructType([T.StructField("id", _BYTES), T.StructField("ends_sha256", T.StringType())])

    def hash_(batches):
        own, state = None, None
        for batch in batches:
            out: list[list] = [[], []]
            for node, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                if node != own:
                    if state:
                        out[0].append(own)
                        out[1].append(state.hexdigest())
                    own, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.as_py())
            yield out
        if state:
            yield [[own], [state.hexdigest()]]
    chunks = materialise(ends.mapInArrow(arrow_rows(join, chunk), chunk), "ends")
    return chunks.repartition("id").sortWithinPartitions("id", "first").mapInArrow(arrow_rows(hash_, digest), digest)


def trie(steps: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie over ``steps`` (rows of ``members``).

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: a node is named by its
    smallest member and its depth; the root's parent is null. ``saved_tokens``: over the node's subtree, the words of each
    node's last text for all members but one. An empty table has no node, not even a root.
    """
    if band < 2:
        raise ValueError("a band has at least two levels")
    nodes = _paths(steps, band).groupBy("id", "depth").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.first("path").alias("path"), F.first("before").alias("before"),
        F.first("words").alias("words"))
    nodes = materialise(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("before").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = materialise(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "trie")
    totals = rollup(nodes, steps, ["leaves", "saved"], band)
    parents = nodes.where("n_children > 0").select(F.col("id").alias("before"), F.col("conv").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"))
    zero = F.lit(0).cast("long")
    return (nodes.drop("leaves", "saved").join(totals, "id", "left").join(_ends(steps), "id", "left")
            .join(parents, ["before", "depth"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("leaves", zero).alias("n_leaves"),
                    F.coalesce("saved", zero).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def mixed_trie(conversations: DataFrame, group: int = 20, heads: int = 4, band: int = BAND) -> DataFrame:
    """The trie of rebuilt conversations: see ``trie`` for the columns.

    Conversation ``c`` becomes the first ``h`` turns of conversation ``c - c % group`` and its own turns after its first
    ``h``, with ``h`` the CRC-32 of the decimal ``c`` modulo ``heads``. Null roles and texts are empty, rows without a
    ``conv_id`` are left out, a null turn comes first, turns that tie are ordered by the digest of role and text; repeated
    rows are turns of their own, other columns are ignored, an empty table gives an empty result.
    """
    own = prefixes(turn_rows(conversations))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    return trie(members(own, head, F.col("conv") - F.col("conv") % group, heads - 1), band)
