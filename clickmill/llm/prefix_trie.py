"""Prefix trie of conversations: which turns are shared from the start, and what sharing saves.

A node is a distinct sequence of first turns, known by a chained 128-bit digest. Conversations are
walked once to give a digest per prefix, and prefixes are counted into nodes. Nodes are dealt into
shards that hold whole subtrees. In a shard every digest gets a slot of a minimal perfect hash,
numbers are scattered into flat arrays, and totals move from each slot to its parent's, deepest
turns first.

No shard has to hold a wide subtree. Nodes of more than ``most`` conversations are a layer above the
others, those of more than ``most ** 2`` one above that: a layer falls into subtrees of at most
``most`` times the turns of a conversation, whose tops hand their totals to the layer above.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import kept, small

ROOT = bytes(16)
NODE = ["n1", "n2"]
ROWS_AT_ONCE = 1 << 16
PREFIXES = "n1 bigint, n2 bigint, p1 bigint, p2 bigint, conv_id bigint, depth bigint, chars bigint, last boolean"


@dataclass(frozen=True)
class Settings:
    """``most`` conversations share a node of the lowest layer; ``shard`` nodes are aimed at a task;
    ids of one range of ``ids`` are put together before they are hashed."""

    most: int = 4096
    shard: int = 200_000
    ids: int = 4096


@dataclass(frozen=True)
class Splice:
    """A conversation's first ``head`` turns are those of the conversation with the id ``lead``.

    Both are columns over ``conv_id``; ``lead`` is not above it. ``longest`` bounds ``head``.
    """

    lead: Column
    head: Column
    longest: int


def by_hundreds() -> Splice:
    """Up to five first turns from the conversation that opens the hundred."""
    conv = F.col("conv_id")
    return Splice(conv - F.pmod(conv, F.lit(100)), F.crc32(conv.cast("string").cast("binary")) % 6, 5)


def _walk(longest: int):
    """Rows ordered by lead, conversation and turn, as a row per prefix of every conversation."""
    def walked(batches):
        blake = hashlib.blake2b
        nodes, ups, ids, depths, sizes, ends = [], [], [], [], [], []
        lead_of, lead, conv, at, depth, skip = None, [], None, ROOT, 0, 0

        def flush(keep: int):
            """Rows but the last ``keep``, whose end is not known yet."""
            n = len(nodes) - keep
            one, two = (np.frombuffer(b"".join(x[:n]), "<i8").reshape(n, 2) for x in (nodes, ups))
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in (one[:, 0], one[:, 1], two[:, 0], two[:, 1])]
                + [pa.array(x[:n], pa.int64()) for x in (ids, depths, sizes)] + [pa.array(ends[:n], pa.bool_())],
                ["n1", "n2", "p1", "p2", "conv_id", "depth", "chars", "last"])
            for x in (nodes, ups, ids, depths, sizes, ends):
                del x[:n]
            return out

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lead", "conv_id", "head", "digest", "chars"))
            for family, own, head, digest, size in zip(*columns, strict=True):
                if own != conv:
                    if ends:
                        ends[-1] = True
                    conv, at, depth = own, ROOT, 0
                    if family != lead_of:
                        lead_of, lead = family, []
                    skip = 0 if own == family else head
                    nodes.append(ROOT)
                    ups.append(ROOT)
                    ids.append(own)
                    depths.append(0)
                    sizes.append(0)
                    ends.append(False)
                    first = lead[:skip]
                else:
                    first = []
                if skip:
                    skip -= 1
                else:
                    first = [*first, (digest, size)]
                    if own == family and len(lead) < longest:
                        lead.append((digest, size))
                for turn, length in first:
                    ups.append(at)
                    at, depth = blake(at + turn, digest_size=16).digest(), depth + 1
                    nodes.append(at)
                    ids.append(own)
                    depths.append(depth)
                    sizes.append(length)
                    ends.append(False)
            if len(nodes) > 1:
                yield flush(1)
        if ends:
            ends[-1] = True
            yield flush(0)

    return walked


def prefixes(conversations: DataFrame, splice: Splice | None = None) -> DataFrame:
    """A row per conversation and depth, the root included: its node, the node above, the code points
    of its last turn, and whether the conversation ends there.

    Only digests of turns are moved. One shuffle brings a conversation together with the one that
    leads it; it is walked turn by turn in bounded memory, however long it is.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    splice = splice or Splice(F.col("conv_id"), F.lit(0), 0)
    turns = conversations.where("conv_id IS NOT NULL").select(
        splice.lead.cast("bigint").alias("lead"), F.col("conv_id").cast("bigint").alias("conv_id"),
        splice.head.cast("bigint").alias("head"), F.col("turn").alias("turn"), role.alias("role"),
        F.unhex(F.substring(F.sha2(told.cast("binary"), 256), 1, 32)).alias("digest"),
        F.length(text).cast("bigint").alias("chars"))
    ordered = turns.repartition("lead").sortWithinPartitions(
        "lead", "conv_id", F.col("turn").asc_nulls_first(), "role", "digest")
    return ordered.select("lead", "conv_id", "head", "digest", "chars").mapInArrow(_walk(splice.longest), PREFIXES)


class Slots:
    """Minimal perfect hash of distinct pairs of longs, with the pairs kept to verify a slot.

    In each round keys that alone hit a place of a bit array get it; the others go on to the next
    array. A slot is the number of set places before it.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray) -> None:
        self.rounds: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, left = len(one), np.arange(len(one))
        slots, taken = np.empty(len(one), np.int64), 0
        while len(left):
            places = self._places(one[left], two[left], len(self.rounds), 2 * len(left) + 1)
            bits = np.bincount(places, minlength=2 * len(left) + 1) == 1
            ranks = taken + np.cumsum(bits) - 1
            mine = bits[places]
            slots[left[mine]] = ranks[places[mine]]
            self.rounds.append((bits, ranks))
            taken, left = taken + int(mine.sum()), left[~mine]
        self.slots = slots
        self.one, self.two = np.empty_like(one), np.empty_like(two)
        self.one[slots], self.two[slots] = one, two

    @staticmethod
    def _places(one: np.ndarray, two: np.ndarray, turn: int, size: int) -> np.ndarray:
        x = one.view(np.uint64) + two.view(np.uint64) * np.uint64(2 * turn + 0x9E3779B1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x % np.uint64(size)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Slots of the pairs; -1 for those that were not among the keys."""
        found, left = np.full(len(one), -1, np.int64), np.arange(len(one))
        for turn, (bits, ranks) in enumerate(self.rounds):
            places = self._places(one[left], two[left], turn, len(bits))
            hit = bits[places]
            found[left[hit]] = ranks[places[hit]]
            left = left[~hit]
        known = found >= 0
        known[known] = (self.one[found[known]] == one[known]) & (self.two[found[known]] == two[known])
        return np.where(known, found, -1)


TOTALS = ("n1 bigint, n2 bigint, p1 bigint, p2 bigint, conv_id bigint, depth bigint, parent_conv_id bigint, "
          "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, top boolean")


def _accumulate(batches):
    """Totals of a shard's subtrees; a node whose parent is in no shard of the layer is a ``top``."""
    whole = [b for b in batches if b.num_rows]
    if not whole:
        return
    table = pa.Table.from_batches(whole)
    given = {c: table.column(c).fill_null(0).to_numpy() for c in table.column_names if c != "up"}
    slots = Slots(given["n1"], given["n2"])

    def scattered(name: str) -> np.ndarray:
        flat = np.empty_like(given[name])
        flat[slots.slots] = given[name]
        return flat

    depth, conv, convs = scattered("depth"), scattered("conv_id"), scattered("n_convs")
    one, two = scattered("p1"), scattered("p2")
    parent = np.where(depth > 0, slots.find(one, two), -1)
    inner = parent >= 0
    children = scattered("more_children") + np.bincount(parent[inner], minlength=slots.size)
    leaves = scattered("more_leaves") + (children == 0)
    saved = scattered("more_saved") + (convs - 1) * scattered("chars")
    order = np.flatnonzero(inner)
    order = order[np.argsort(-depth[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    order = np.empty(slots.size, np.int64)
    order[slots.slots] = np.arange(slots.size)
    above = pc.if_else(pa.array(inner), pa.array(conv[parent]), table.column("up").combine_chunks().take(pa.array(order)))
    out = pa.Table.from_arrays(
        [pa.array(x) for x in (slots.one, slots.two, one, two, conv, depth)] + [above]
        + [pa.array(x) for x in (convs, children, leaves, saved, ~inner)],
        ["n1", "n2", "p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
         "saved_tokens", "top"])
    yield from out.to_batches(ROWS_AT_ONCE)


def _sums(batches):
    """SHA-256 of every node's parts, which come in order; nothing is held but the running hash."""
    node, running = None, None

    def row(key, sums):
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in key], pa.int64()), pa.array([k[1] for k in key], pa.int64()), pa.array(sums)],
            ["n1", "n2", "ends_sha256"])

    for batch in batches:
        keys, sums = [], []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "ids")), strict=True):
            if (a, b) == node:
                running.update(b",")
            else:
                if node:
                    keys.append(node)
                    sums.append(running.hexdigest())
                node, running = (a, b), hashlib.sha256()
            running.update(ids.encode())
        if keys:
            yield row(keys, sums)
    if node:
        yield row([node], [running.hexdigest()])


def end_sums(walked: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``n1, n2, ends_sha256`` of nodes at which conversations end, over their ids in order.

    Ids of a range are put together first, so that a node at which a third of all conversations
    end reaches the task that hashes it as few long rows.
    """
    ends = walked.where("last").withColumn("range", F.floor(F.col("conv_id") / settings.ids))
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    parts = ends.groupBy(*NODE, "range").agg(F.array_join(ids, ",").alias("ids"))
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "range").select(*NODE, "ids").mapInArrow(
        _sums, "n1 bigint, n2 bigint, ends_sha256 string")


def nodes_of(walked: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct nodes with their layer, the subtree of the layer they are in (``part``), and, for a
    subtree's top, the smallest conversation of the node above (``up``).

    Wide nodes are few: each stands for more than ``most`` prefixes. They alone are joined to the
    prefixes, along which the layer falls.
    """
    wide = kept(walked.groupBy(*NODE).agg(F.count("*").alias("wide"), F.min("conv_id").alias("first")).where(
        F.col("wide") > settings.most), "wide-nodes")
    widest = wide.agg(F.max("wide")).first()[0] or 0
    layer, limit = F.lit(0), settings.most
    while limit < widest:
        layer = layer + F.coalesce((F.col("wide") > limit).cast("int"), F.lit(0))
        limit *= settings.most
    along = Window.partitionBy("conv_id").orderBy("depth")
    placed = walked.join(small(wide), NODE, "left").withColumn("layer", layer).withColumns(
        {"before": F.lag("layer").over(along), "above": F.lag("first").over(along)})
    entered = F.when(F.col("before").isNull() | (F.col("before") != F.col("layer")), F.col("n1"))
    placed = placed.withColumn("part", F.last(entered, ignorenulls=True).over(along))
    return placed.groupBy(*NODE).agg(
        *[F.min(c).alias(c) for c in ("p1", "p2", "conv_id", "depth", "chars", "layer", "part")],
        F.min("above").alias("up"), F.count("*").alias("n_convs"))


def prefix_trie(conversations: DataFrame, splice: Splice | None = None, settings: Settings = Settings()) -> DataFrame:
    """A row per distinct sequence of first turns of ``conversations`` (``conv_id, turn, role, text``).

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``:
    a node goes by its depth and its smallest member. Turns go by ``turn``, null first, those
    that tie by role, then by digest. Null roles and texts are empty. Rows without a ``conv_id``
    belong to no conversation; repeated rows are turns of their own; no conversations give no
    nodes, not even a root. Ids below 0 count on from below. A conversation may be of any length.
    Other columns are not read. Nodes with equal digests are one; two sequences have the same
    digest with a chance of 2 ** -128 a pair.
    """
    walked = kept(prefixes(conversations, splice), "prefixes")
    nodes = kept(nodes_of(walked, settings), "nodes")
    layers = {r["layer"]: r["n"] for r in nodes.groupBy("layer").agg(F.count("*").alias("n")).collect()}
    done = None
    for layer in sorted(layers):
        part = nodes.where(F.col("layer") == layer)
        more = {"more_children": F.count("*"), "more_leaves": F.sum("n_leaves"), "more_saved": F.sum("saved_tokens")}
        if done is None:
            part = part.withColumns({c: F.lit(0).cast("bigint") for c in more})
        else:
            handed = done.where("top AND depth > 0").groupBy(
                F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(*[m.alias(c) for c, m in more.items()])
            part = part.join(handed, NODE, "left")
        columns = [*NODE, "p1", "p2", "conv_id", "depth", "chars", "n_convs", "up", *more]
        shards = -(-layers[layer] // settings.shard)
        found = kept(part.repartition(shards, "part").select(*columns).mapInArrow(_accumulate, TOTALS), "totals")
        done = found if done is None else done.union(found)
    if done is None:
        done = conversations.sparkSession.createDataFrame([], TOTALS)
    nothing = hashlib.sha256(b"").hexdigest()
    return done.join(end_sums(walked, settings), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
