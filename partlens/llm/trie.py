"""A trie of conversation prefixes, each shard of it written as balanced parentheses."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partlens.llm.common import stored

SHARD_TURNS = 32_768
BLOCK = 64
SCANNED = 1 << 16
FIELDS = (
    "node binary, parent binary, depth long, first long, parent_first long, n_convs long, n_children long, "
    "n_leaves long, saved long, ends string, shared boolean, parent_shared boolean, shard int"
)
# Stands above every identifier of a node that no conversation of the shard ends in.
NONE = np.iinfo(np.int64).max


class Parens:
    """A tree as balanced parentheses, with the least excess of every block and of blocks of blocks.

    ``opens`` is true for each opening parenthesis; a node is the place of its own. Excess is the
    number of open parentheses after a place.
    """

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        self.rank = np.cumsum(opens)
        pairs = np.zeros(len(opens), np.int64)
        pairs[:-1] = opens[:-1] & ~opens[1:]
        self.pairs = np.cumsum(pairs)
        padded = np.full(-(-max(len(opens), 1) // BLOCK) * BLOCK, len(opens) + 1, np.int64)
        padded[: len(opens)] = self.excess
        self.blocks = padded.reshape(-1, BLOCK)
        self.least = [self.blocks.min(axis=1)]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            if len(below) % 2:
                below = np.append(below, len(opens) + 1)
            self.least.append(below.reshape(-1, 2).min(axis=1))

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        parts = [self._find(places[i : i + SCANNED]) for i in range(0, len(places), SCANNED)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _find(self, places: np.ndarray) -> np.ndarray:
        wanted = self.excess[places] - 1
        block = places // BLOCK
        below = (self.blocks[block] <= wanted[:, None]) & (np.arange(BLOCK) > (places % BLOCK)[:, None])
        found = block * BLOCK + below.argmax(axis=1)
        far = np.flatnonzero(~below.any(axis=1))
        if len(far):
            target = self._next_block(block[far], wanted[far])
            found[far] = target * BLOCK + (self.blocks[target] <= wanted[far][:, None]).argmax(axis=1)
        return found

    def _next_block(self, block: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first block after each whose least excess is as low as wanted: up the tree of minima, and down."""
        at, level = block + 1, np.zeros(len(block), np.int64)
        climbing = np.arange(len(block))
        for height, least in enumerate(self.least):
            level[climbing] = height
            climbing = climbing[least[at[climbing]] > wanted[climbing]]
            if not len(climbing):
                break
            # The next one after a right child is its parent's; a left one's parent starts with what was ruled out.
            at[climbing] = (at[climbing] + 1) // 2
        for height in range(len(self.least) - 1, 0, -1):
            going = np.flatnonzero(level >= height)
            left = at[going] * 2
            low = self.least[height - 1][left] <= wanted[going]
            at[going] = np.where(low, left, left + 1)
        return at


def _least_of_ranges(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first:last] for each pair; ``NONE`` where that is empty."""
    out = np.full(len(first), NONE, np.int64)
    table, width, length = values, 1, last - first
    while len(table):
        fits = (length >= width) & (length < 2 * width)
        out[fits] = np.minimum(table[first[fits]], table[last[fits] - width])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table[:0]
        width *= 2
    return out


def _chain(path: list[bytes], depth: int) -> list[bytes]:
    """What names the nodes of a path down to a depth, whichever shard sees them."""
    names = [hashlib.sha256(b"").digest()]
    for turn in path[:depth]:
        names.append(hashlib.sha256(names[-1] + turn).digest())
    return names


def shard_nodes(paths: list[list[bytes]], sizes: list, ids: np.ndarray, seen: int, following: int, shard: int) -> pd.DataFrame:
    """The nodes of one shard: conversations in order of path, then identifier.

    ``seen`` is the depth down to which the first path was in the shard before, ``following`` that to
    which the last one is in the next; -1 where there is none. Nodes above those depths are shared:
    of them a shard tells only its own part, and counts a shared node as a child or its text as
    saved only in the first shard that has it, and as a leaf only in the last.
    """
    opens, parent, depth, weight, stops = [], [-1], [0], [0], []
    opens.append(True)
    stack, before = [0], []
    for path, lengths in zip(paths, sizes):
        path = list(path)
        common = 0
        for mine, other in zip(path, before):
            if mine != other:
                break
            common += 1
        opens.extend([False] * (len(before) - common))
        del stack[common + 1 :]
        for place in range(common, len(path)):
            opens.append(True)
            parent.append(stack[-1])
            depth.append(place + 1)
            weight.append(lengths[place])
            stack.append(len(parent) - 1)
        stops.append(stack[-1])
        before = path
    opens.extend([False] * len(stack))

    parent, depth, weight = np.array(parent), np.array(depth), np.array(weight, np.int64)
    count = len(parent)
    tree = Parens(np.array(opens))
    places = np.flatnonzero(tree.opens)
    closes = tree.find_close(places)
    node, end = np.arange(count), tree.rank[closes]
    ended = np.bincount(np.array(stops), minlength=count)
    members = np.concatenate(([0], np.cumsum(ended)))
    n_convs = members[end] - members[node]
    first = _least_of_ranges(ids, members[node], members[end])
    own = np.ones(count, np.int64)
    own[: seen + 1] = 0
    children = np.bincount(parent[1:], weights=own[1:], minlength=count).astype(np.int64)
    leaves = tree.pairs[closes] - np.where(places > 0, tree.pairs[places - 1], 0)
    if following == len(before):
        leaves[stack] -= 1
    spared = np.concatenate(([0], np.cumsum((n_convs - own) * weight)))
    saved = spared[end] - spared[node]

    shared = np.zeros(count, bool)
    shared[: seen + 1] = True
    shared[stack[: following + 1]] = True
    names: list[bytes | None] = [None] * count
    for number, name in enumerate(_chain(list(paths[0]), seen) if seen >= 0 else []):
        names[number] = name
    for number, name in zip(stack, _chain(before, following) if following >= 0 else []):
        names[number] = name
    told = {}
    start = 0
    for number in np.flatnonzero(ended).tolist():
        told[number] = ",".join(map(str, ids[start : start + ended[number]].tolist()))
        start += ended[number]
    nothing = hashlib.sha256(b"").hexdigest()
    ends = [
        (told.get(n, "") if s else hashlib.sha256(told[n].encode()).hexdigest() if n in told else nothing)
        for n, s in enumerate(shared.tolist())
    ]
    above = np.maximum(parent, 0)
    return pd.DataFrame(
        {
            "node": names,
            "parent": [None] + [names[p] for p in parent[1:].tolist()],
            "depth": depth,
            "first": first,
            "parent_first": pd.array(np.where(parent < 0, 0, first[above]), dtype="Int64"),
            "n_convs": n_convs,
            "n_children": children,
            "n_leaves": leaves,
            "saved": saved,
            "ends": ends,
            "shared": shared,
            "parent_shared": (parent >= 0) & shared[above],
            "shard": np.full(count, shard, np.int32),
        }
    )


def _by_shard(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("_place")
    row = frame.iloc[0]
    ids = frame["conv_id"].to_numpy(np.int64)
    return shard_nodes(list(frame["path"]), list(frame["sizes"]), ids, int(row["_seen"]), int(row["_following"]), int(row["_shard"]))


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per shared node, from its parts in order of node and shard; a node's list of ends is hashed as it passes."""
    held: dict | None = None
    digest, listed = hashlib.sha256(), False

    def closed() -> dict:
        return held | {"ends": digest.hexdigest()}

    for batch in batches:
        done = []
        for row in batch.itertuples(index=False):
            if held is None or held["node"] != row.node:
                if held is not None:
                    done.append(closed())
                held = {"node": row.node, "parent": row.parent, "depth": row.depth, "first": NONE}
                held |= {"n_convs": 0, "n_children": 0, "n_leaves": 0, "saved": 0}
                digest, listed = hashlib.sha256(), False
            held["first"] = min(held["first"], row.first)
            for name in ("n_convs", "n_children", "n_leaves", "saved"):
                held[name] += getattr(row, name)
            if row.ends:
                digest.update((("," if listed else "") + row.ends).encode())
                listed = True
        if done:
            yield pd.DataFrame(done)
    if held is not None:
        yield pd.DataFrame([closed()])


def turn_lists(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, structs of ``digest`` (128 bits of role and text) and ``size`` (UTF-8 bytes of the text).

    Turns are ordered by ``turn_col``, null first, ties by digest. Null roles and texts are empty, repeated rows are turns each, and
    rows without a conversation are none. Texts are not shuffled, their digests are; a conversation's must fit in a task's memory.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """Conversations c that begin as conversation c - c % 5 does: its first h turns, then their own after h; h is crc32(c) % 9.

    Where that conversation has fewer turns all of them come, and where there is none, none does.
    """
    kept = stored(lists, "lists")
    heads = kept.select(F.col("conv_id").alias("_head"), F.slice("turns", 1, 8).alias("_turns"))
    joined = kept.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("_head"), "left")
    joined = joined.withColumn("_h", (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int"))
    begun = F.expr("coalesce(slice(_turns, 1, _h), slice(turns, 1, 0))")
    own = F.expr("slice(turns, _h + 1, greatest(size(turns) - _h, 0))")
    return joined.select("conv_id", F.concat(begun, own).alias("turns"))


def _common(one: Column, other: Column) -> Column:
    """How many turns two paths share at their start; -1 where there is no other path."""
    place = F.array_position(F.zip_with(one, other, lambda a, b: a.eqNullSafe(b)), F.lit(False))
    return F.when(other.isNull(), -1).when(place == 0, F.size(one)).otherwise(place - 1).cast("int")


def prefix_trie(lists: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the ``turns`` of ``lists``, down from the empty one, the root.

    ``conv_id`` is the smallest conversation that begins so, ``depth`` the number of turns, ``parent_conv_id``
    the parent's ``conv_id`` (null for the root), ``n_convs`` how many begin so, ``n_children`` and ``n_leaves`` count
    the nodes one turn longer and the childless ones below (a childless node itself),
    ``saved_tokens`` sums over the node and all below the bytes of the last text for each conversation but
    one, and ``ends_sha256`` hashes the identifiers of the conversations that end here, rising, joined by commas.

    Conversations are sorted by path and dealt into ranges, so a first turn, or a whole
    conversation, that very many share fills many shards. Each shard writes its part of the trie as
    balanced parentheses: the closing one delimits a subtree, ranks count its nodes and leaf
    pairs, and running sums between the two give members and savings. The nodes that a shard shares with its
    neighbours are the upper ends of its first and last path. How deep that goes is known from the
    paths at the edges, so a shard can tell which share of them is its own; the shares are then summed.

    Conversations without turns end at the root. Each ``conv_id`` must be there once, as :func:`turn_lists` gives them. An empty
    table gives no rows, other columns take no part. Memory goes with the turns of a shard, or with one
    conversation's if it has more.
    """
    paths = lists.select(
        "conv_id", F.transform("turns", lambda t: t["digest"]).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )
    kept = stored(paths, "paths")
    total = kept.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_turns))
    ranged = kept.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    # Written with its ranges: a task run again must not deal them anew.
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("_shard"), F.monotonically_increasing_id().alias("_place")), "shards")
    edges = ranged.groupBy("_shard").agg(F.min("path").alias("_low"), F.max("path").alias("_high"))
    # A row per shard.
    order = W.orderBy("_shard")
    edges = edges.select(
        F.col("_shard"),
        _common(F.col("_low"), F.lag("_high").over(order)).alias("_seen"),
        _common(F.col("_high"), F.lead("_low").over(order)).alias("_following"),
    )
    nodes = ranged.join(edges, "_shard").groupBy("_shard").applyInPandas(_by_shard, FIELDS)
    nodes = stored(nodes, "nodes")
    numbers = ["depth", "first", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    parts = nodes.where("shared").select("node", "parent", *numbers, "shard").repartition("node").sortWithinPartitions("node", "shard")
    merged = stored(
        parts.mapInPandas(
            _merged, "node binary, parent binary, depth long, first long, n_convs long, n_children long, n_leaves long, saved long, ends string"
        ),
        "shared",
    )
    known = merged.select(F.col("node").alias("_parent"), F.col("first").alias("_first"))
    hung = nodes.where("NOT shared AND parent_shared").select("parent", *numbers).union(merged.select("parent", *numbers))
    hung = hung.join(known, F.col("parent") == F.col("_parent"), "left").select(*numbers, F.col("_first").alias("parent_first"))
    alone = nodes.where("NOT shared AND NOT parent_shared")
    alone = alone.select(*numbers, F.when(F.col("depth") > 0, F.col("parent_first")).alias("parent_first"))
    return alone.union(hung).select(
        F.col("first").alias("conv_id"),
        "depth",
        F.col("parent_first").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
