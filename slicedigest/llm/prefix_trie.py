"""The trie of conversations that share their first turns, by bitmaps of conversations per position and turn."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows
from slicedigest.runtime import materialise

SHARD = 4096
"""Conversation ids of one shard: the width of a bitmap."""
ROOT = bytes(16)
BASE_STEP = 100
SHARED_TURNS = 6
"""A conversation takes fewer turns than this from its base."""

NODE = "key binary, parent binary, depth int, first bigint, n bigint, size bigint, sizes bigint, weight bigint, leaves bigint, ends string"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn_key`` and ``size`` (code points of the text) of every turn.

    Turns are in the order of ``turn``, null first, then of role and of a hash of the text. Null role or text is empty. Rows
    without ``conv_id`` belong to no conversation and are left out. Only hashes move, no text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))).alias("turn_key"),
        F.length(text).cast("bigint").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_key")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "turn_key", "size")


def rebuilt(numbered: DataFrame) -> DataFrame:
    """The same columns, each conversation beginning with turns of its base; one of no turns has a row at ``pos`` 0.

    Conversation c takes the first h turns of c - c % 100 and goes on with its own turns behind its first h, where h is the
    CRC-32 of its decimal id modulo 6.
    """
    own = F.col("conv_id")
    base = own - own % BASE_STEP
    h = (F.crc32(F.encode(own.cast("string"), "UTF-8")) % SHARED_TURNS).cast("int")
    lengths = numbered.groupBy("conv_id").agg(F.count("*").cast("int").alias("turns")).select("conv_id", base.alias("base"), h.alias("h"))
    heads = numbered.where((own % BASE_STEP == 0) & (F.col("pos") < SHARED_TURNS))
    heads = heads.select(own.alias("base"), F.struct("pos", "turn_key", "size").alias("turn"))
    heads = heads.groupBy("base").agg(F.sort_array(F.collect_list("turn")).alias("head"))  # fewer than SHARED_TURNS
    taken = lengths.join(heads, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:int,turn_key:binary,size:bigint>>")), 1, F.col("h")).alias("head")
    )
    first = taken.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.turn_key", "t.size")
    start = taken.select("conv_id", "h", F.size("head").alias("held"))
    rest = numbered.join(start, "conv_id").where("pos > h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("held")).alias("pos"), "turn_key", "size")
    every = start.select("conv_id", F.lit(0).alias("pos"), F.lit(ROOT).alias("turn_key"), F.lit(0).cast("bigint").alias("size"))
    return first.unionByName(rest).unionByName(every)


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def shard_nodes(conversations: list[tuple[int, list[tuple[bytes, int]]]]) -> Iterator[tuple]:
    """The nodes of one shard's trie, in the order of `NODE`, children before their parent.

    ``conversations`` has ids in ascending order with their turns' keys and sizes. ``sizes``, ``weight`` (sizes times members)
    and ``leaves`` are summed over the subtree.
    """
    ids = [c for c, _ in conversations]
    held = [t for _, t in conversations]
    postings: dict[tuple[int, bytes], int] = {}
    ending: dict[int, int] = {}
    for i, own in enumerate(held):
        for pos, (turn, _) in enumerate(own, 1):
            postings[pos, turn] = postings.get((pos, turn), 0) | 1 << i
        ending[len(own)] = ending.get(len(own), 0) | 1 << i

    # key, parent, depth, members, size, members still to be dealt to children, sums of the subtree
    stack = [[ROOT, None, 0, (1 << len(ids)) - 1, 0, None, 0, 0, 0]]
    while stack:
        node = stack[-1]
        key, parent, depth, members, size, left = node[:6]
        if left is None:
            left = members & ~ending.get(depth, 0)
            node[8] = 0 if left else 1
        if left:
            turn, length = held[(left & -left).bit_length() - 1][depth]
            child = left & postings[depth + 1, turn]
            node[5] = left & ~child
            stack.append([hashlib.md5(key + turn).digest(), key, depth + 1, child, length, None, 0, 0, 0])
            continue
        stack.pop()
        n = members.bit_count()
        sums = node[6] + size, node[7] + size * n, node[8]
        if stack:
            for i, x in enumerate(sums):
                stack[-1][6 + i] += x
        ended = members & ending.get(depth, 0)
        ends = ",".join(str(ids[i]) for i in _bits(ended)) if ended else None
        yield key, parent, depth, ids[(members & -members).bit_length() - 1], n, size, *sums, ends


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (`rebuilt`), with the sums over its subtree.

    ``conv_id`` is the node's smallest member, ``parent_conv_id`` its parent's (null at the root), ``n_convs`` and
    ``n_children`` count members and children, ``n_leaves`` the childless nodes below it or itself, ``saved_tokens`` sums each
    node's members but one times the code points of its last text, ``ends_sha256`` hashes the ids of the members that end
    there. An empty table gives no rows, not even a root; rows that repeat are turns each; other columns are ignored.

    Conversations are dealt to shards by ranges of their ids. A shard indexes (position, turn) to bitmaps of its
    conversations and walks its trie depth first: a node's bitmap meets the posting of the turn that its first open member
    takes next, which gives a child, until no member is left. Nodes of several shards are merged by a hash of their turns.
    A node that one shard has alone keeps that shard's sums, as all of its subtree is there. The others are summed up in
    rounds that reach twice as far each time. A shard keeps the turn hashes of its conversations in memory, no texts.
    """
    whole = rebuilt(materialise(turns(conversations)))

    def walk(batches: Iterable[dict]) -> Iterator[tuple]:
        shard, held = None, []
        for batch in batches:
            for s, conv, pos, turn, size in zip(batch["shard"], batch["conv_id"], batch["pos"], batch["turn_key"], batch["size"], strict=True):
                if s != shard:
                    if held:
                        yield from ((shard, *node) for node in shard_nodes(held))
                    shard, held = s, []
                if pos == 0:
                    held.append((conv, []))
                else:
                    held[-1][1].append((turn, size))
        if held:
            yield from ((shard, *node) for node in shard_nodes(held))

    sharded = whole.select(F.floor(F.col("conv_id") / SHARD).alias("shard"), "conv_id", "pos", "turn_key", "size")
    sharded = sharded.repartition("shard").sortWithinPartitions("shard", "conv_id", "pos")
    local = materialise(map_rows(sharded, walk, f"shard bigint, {NODE}"))
    # depth, size and parent follow from the key
    sums = [F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("first").alias("first"), F.min("size").alias("size")]
    sums += [F.sum(c).alias(c) for c in ("n", "sizes", "weight", "leaves")]
    nodes = materialise(local.groupBy("key").agg(*sums, F.count("*").alias("shards")))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    nodes = materialise(nodes)
    totals = _summed(nodes)
    parents = nodes.select(F.col("key").alias("parent"), F.col("first").alias("parent_conv_id"))
    made = nodes.where("shards = 1").select("key", "parent", "depth", "first", "n", "n_children", "weight", "sizes", "leaves")
    shared = nodes.where("shards > 1").drop("sizes", "leaves").join(totals, "key")
    made = made.unionByName(shared.select(made.columns)).join(parents, "parent", "left").join(_end_hashes(local), "key", "left")
    return made.select(
        F.col("first").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        (F.col("weight") - F.col("sizes")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _summed(nodes: DataFrame) -> DataFrame:
    """``key``, ``sizes`` and ``leaves`` of the subtrees of nodes that several shards have.

    Such a node starts with its own size and the sums of its children of one shard. In round k each node adds what has been
    summed so far at its descendants 2^k below; then its pointer to its ancestor is doubled.
    """
    single = nodes.where("shards = 1 AND parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
    single = single.agg(F.sum("sizes").alias("below"), F.sum("leaves").alias("under"))
    zero = F.lit(0).cast("bigint")
    start = nodes.where("shards > 1").join(single, "key", "left").select(
        "key",
        F.col("parent").alias("up"),
        (F.col("size") + F.coalesce("below", zero)).alias("sizes"),
        (F.when(F.col("n_children") == 0, 1).otherwise(0) + F.coalesce("under", zero)).cast("bigint").alias("leaves"),
    )
    state = materialise(start)
    while not (pointing := state.where("up IS NOT NULL")).isEmpty():
        added = pointing.groupBy(F.col("up").alias("key")).agg(F.sum("sizes").alias("more"), F.sum("leaves").alias("further"))
        above = state.select(F.col("key").alias("up"), F.col("up").alias("next"))
        state = materialise(
            state.join(added, "key", "left").join(above, "up", "left").select(
                "key",
                F.col("next").alias("up"),
                (F.col("sizes") + F.coalesce("more", zero)).alias("sizes"),
                (F.col("leaves") + F.coalesce("further", zero)).alias("leaves"),
            )
        )
    return state.select("key", "sizes", "leaves")


def _end_hashes(local: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256`` of the nodes at which conversations end; the shards' lists are hashed as they stream by."""

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        key, state = None, None
        for batch in batches:
            for k, ends in zip(batch["key"], batch["ends"], strict=True):
                if k != key:
                    if state is not None:
                        yield key, state.hexdigest()
                    key, state = k, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
        if state is not None:
            yield key, state.hexdigest()

    rows = local.where("ends IS NOT NULL").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    return map_rows(rows, run, "key binary, ends_sha256 string")
