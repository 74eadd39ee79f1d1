"""MinHash near-dedup.

A document's set is its distinct 5-word shingles. Equal sets are one class. Many universal hash
minima form a class's signature; bands of minima put classes into buckets; members of a bucket are
paired, pairs with unlike signatures dropped, and the rest confirmed on the full sets. Links become
connected components by alternating large-star and small-star.

Within a bucket not all pairs are made. Members are first paired with the bucket's least member;
once links have joined them, only buckets that still hold several components go on: in blocks of
bounded size every member meets every member of another component on their full sets, and only
links come out that join components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import LOWER, kept, small, text_rows

SHINGLE = 5
SHINGLES_AT_ONCE = 4096


@dataclass(frozen=True)
class Settings:
    """With 32 bands of 4 minima, a pair at 0.75 shares no bucket once in 190,000 times. Members of
    shared buckets get ``verify`` minima, of which at least 338 agree but once in 800,000."""

    bands: int = 32
    rows: int = 4
    similarity: int = 75  # hundredths
    verify: int = 512
    min_agree: int = 338
    cell: int = 2048  # members of a block in the last round, and bytes of their sets
    cell_bytes: int = 16 << 20
    seed: int = 5


def normal_words(text: str) -> list[bytes]:
    """Words of the text with A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def shingles(text: str) -> np.ndarray:
    """The set as sorted 64-bit hashes; fewer words than a shingle make one of their own."""
    import xxhash

    words = normal_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    ends = (starts + sizes - 1)[SHINGLE - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh3_64_intdigest
    found = [digest(joined[s:e]) for s, e in zip(starts.tolist(), ends, strict=False)]
    return np.unique(np.array(found, np.uint64))


def hash_family(settings: Settings, size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    return (rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, size, dtype=np.uint64))


def minima(found: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least upper half of ``a * x + b`` for every member of the family; its low 16 bits."""
    a, b = family
    least = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for start in range(0, len(found), SHINGLES_AT_ONCE):
        block = found[start:start + SHINGLES_AT_ONCE]
        np.minimum(least, (a[:, None] * block[None, :] + b[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint16)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` per row; no digest without words."""
    def signed(batches):
        import xxhash

        family = hash_family(settings, settings.bands * settings.rows)
        for part, texts in text_rows(batches):
            sizes, digests, marks = [], [], []
            for text in texts:
                found = shingles(text)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                marks.append(minima(found, family).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(marks, pa.binary())],
                ["doc_id", "n_shingles", "digest", "signature"])

    return docs.select("doc_id", "text").mapInArrow(
        signed, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def buckets(classes: DataFrame, settings: Settings) -> DataFrame:
    """``bucket, node`` for every band of every class."""
    width = settings.rows * 2
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(settings.bands - 1)),
        lambda band: F.xxhash64(band, F.substring(F.col("signature"), band * width + 1, F.lit(width))))
    return classes.select(F.explode(keys).alias("bucket"), "node")


def set_table(docs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """``node, found, signature``: the full sets of the documents named, with their minima."""
    def collected(batches):
        family = hash_family(settings, settings.verify)
        for part, texts in text_rows(batches):
            sets = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([x.tobytes() for x in sets], pa.binary()),
                 pa.array([minima(x, family).tobytes() for x in sets], pa.binary())], ["node", "found", "signature"])

    chosen = docs.select("doc_id", "text").join(small(nodes.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    return chosen.mapInArrow(collected, "node bigint, found binary, signature binary").where(F.length("found") > 0)


def confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose signatures agree in enough minima and whose full sets are similar enough."""
    def similar(x: bytes, y: bytes) -> bool:
        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if 100 * min(len(p), len(q)) < settings.similarity * max(len(p), len(q)):
            return False
        both = len(np.intersect1d(p, q, assume_unique=True))
        return 100 * both >= settings.similarity * (len(p) + len(q) - both)

    def exact(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                one, two = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(part.num_rows, -1)
                            for c in ("sa", "sb"))
                part = part.filter(pa.array((one == two).sum(axis=1) >= settings.min_agree))
                ok = [similar(x, y) for x, y in zip(
                    part.column("fa").to_pylist(), part.column("fb").to_pylist(), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one, two = (sets.select(F.col("node").alias(n), F.col("found").alias(f"f{n}"), F.col("signature").alias(f"s{n}"))
                for n in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "fa", "fb", "sa", "sb").mapInArrow(
        exact, "a bigint, b bigint")


def _is_forest(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller one, and that has none itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(links.select("b", F.lit(0)))
    odd = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return odd.where("ups > 1 OR (ups = 1 AND low = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of an edge ``a, b``.

    Links lead from a node to a smaller one. Large-star moves every link of a node's larger
    neighbours to its least neighbour; small-star those of its smaller neighbours. They alternate
    until every component is a star. Each step keeps its links in the shared folder, and a node's
    least neighbour is found by partial sums before links are joined to it, from files, so that a
    node with a third of all links can be split.
    """
    state = kept(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _is_forest(state):
        low = kept(state.groupBy("a").agg(F.min("b").alias("m")), "least").select(F.col("a").alias("n"), "m")
        large = kept(state.join(low, F.col("b") == F.col("n"), "left").select(
            "a", F.coalesce("m", "b").alias("b")).distinct(), "links")
        low = kept(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        rest = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = kept(rest.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        state.select(F.col("b"), F.col("b"))).distinct()


def joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``known``, joined by further links: only components that a link touches are looked at."""
    ends = links
    for end, own in (("a", "p"), ("b", "q")):
        own_of = known.select(F.col("node").alias(end), F.col("component").alias(own))
        ends = ends.join(own_of, end, "left").withColumn(own, F.coalesce(own, end))
    ends = kept(ends, "ends")
    moved = kept(components(ends.select(F.col("p").alias("a"), F.col("q").alias("b"))), "moved")
    nodes = known.union(ends.select("a", "p")).union(ends.select("b", "q")).distinct()
    moves = small(moved.select(F.col("node").alias("component"), F.col("component").alias("to")))
    return nodes.join(moves, "component", "left").select("node", F.coalesce("to", "component").alias("component"))


def _centred(members: DataFrame) -> DataFrame:
    """Pairs of each member with the least one of its bucket."""
    first = kept(members.groupBy("bucket").agg(F.min("node").alias("centre")), "centres")
    return members.join(first, "bucket").where("node != centre").select(
        F.col("node").alias("a"), F.col("centre").alias("b")).distinct()


def _still_open(members: DataFrame, known: DataFrame) -> DataFrame:
    """Members with their component, of buckets of three and more that hold several components.

    In a bucket of two the only pair has been looked at.
    """
    named = members.select("bucket", "node").join(known, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component"))
    wide = named.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x < y AND n > 2")
    return named.join(wide.select("bucket"), "bucket", "left_semi")


def _spanning(components: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
              similarity: int) -> list[tuple[int, int]]:
    """Links between members of different components, none between those joined by earlier ones.

    Every left member meets every right one through an index of the right ones' shingles, which
    gives the exact size of each intersection.
    """
    label, links = components.copy(), []
    sizes = np.array([len(s) for s in sets])
    values, inverse = np.unique(np.concatenate([sets[r] for r in right]), return_inverse=True)
    counts = np.bincount(inverse, minlength=len(values))
    starts = np.cumsum(counts) - counts
    holders = np.repeat(np.arange(len(right)), sizes[right])[np.argsort(inverse, kind="stable")]
    for at in left.tolist():
        if (label[right] == label[at]).all():
            continue
        own = sets[at]
        place = np.minimum(np.searchsorted(values, own), len(values) - 1)
        place = place[values[place] == own]
        runs, ends = counts[place], np.cumsum(counts[place])
        shared = holders[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[place] - (ends - runs), runs)]
        both = np.bincount(shared, minlength=len(right))
        near = right[100 * both >= similarity * (len(own) + sizes[right] - both)]
        for other in near.tolist():
            if label[other] != label[at]:
                links.append((at, other))
                label[label == label[other]] = label[at]
    return links


def _across(members: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Confirmed links between members of different components of a bucket, block against block.

    A block holds bounded members and bytes of sets, and a pair of blocks, a cell, is one task's
    work. Every pair of a bucket meets in some cell, is compared on its full sets, and gives a link
    only if nothing in the cell has joined its components before: a cell of m members gives less
    than m links, however many of its pairs are similar.
    """
    def compared(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            cell = np.stack([held.column(c).to_numpy() for c in ("bucket", "i", "j")], 1)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            for start, end in zip(np.append(0, cuts), cuts, strict=False):
                yield _cell(held.slice(start, end - start))
            held = held.slice(int(cuts[-1])) if len(cuts) else held
        if held is not None:
            yield _cell(held)

    def _cell(rows):
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        block, node = rows.column("block").to_numpy(), rows.column("node").to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in rows.column("found").to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = _spanning(rows.column("component").to_numpy(), found, left, right, settings.similarity) if len(left) and len(right) else []
        one, two = (node[[pair[k] for pair in links]] for k in (0, 1)) if links else (node[:0], node[:0])
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(one, two)), pa.array(np.minimum(one, two))], ["a", "b"])

    weights = sets.select("node", "found", F.length("found").alias("bytes"))
    sized = members.join(kept(weights.select("node", "bytes"), "weights"), "node")
    sizes = kept(sized.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / settings.cell), F.ceil(F.sum("bytes") / settings.cell_bytes)).cast("int").alias("blocks")), "sizes")
    placed = members.join(small(sizes), "bucket").withColumn("block", F.pmod(F.xxhash64(F.lit(settings.seed), "node"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "node", "component", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    filled = cells.join(weights.select("node", "found"), "node")
    spread = filled.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return spread.select("bucket", "i", "j", "block", "node", "component", "found").mapInArrow(
        compared, "a bigint, b bigint").distinct()


def link(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, n_shingles, node`` per row, ``node, component`` of the nodes that have links).

    A node is the least id of the documents with the same set, null for a document without words.
    """
    signed = kept(signatures(docs, settings), "signatures")
    usable = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = kept(usable.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "classes")
    rows = signed.join(classes.select("digest", "node"), "digest", "left").select("doc_id", "n_shingles", "node")
    keyed = buckets(classes, settings)
    # Joined from files, here and below, so that a hot key can be split at run time.
    shared = kept(keyed.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("bucket"), "buckets")
    members = kept(keyed.join(shared, "bucket"), "members")
    sets = kept(set_table(docs, members.select("node").distinct(), settings), "sets")
    # The same id may stand on rows with different sets.
    twice = usable.groupBy("doc_id").agg(F.min("digest").alias("p"), F.max("digest").alias("q")).where("p != q")
    edges = rows.where("node != doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).join(
        twice.select(F.col("doc_id").alias("a")), "a", "left_semi")
    pairs = kept(_centred(members), "pairs")
    known = kept(components(edges.union(confirmed(pairs, sets, settings))), "components")
    still = kept(_still_open(members, known), "members")
    if not still.isEmpty():
        found = kept(_across(still, sets, settings), "links")
        if not found.isEmpty():
            known = kept(joined(known, found), "components")
    return rows, known


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    A document without words or text is linked with nothing. A row with a null id takes part in
    nothing: its component is null and it is kept. A very long text is a set like any other, held by
    one task at a time. Rows sharing an id are one document, linked by
    whatever links any of their texts. Other columns are not read; no rows give no rows.
    """
    rows, named = link(docs, settings)
    labelled = rows.withColumn("node", F.coalesce("node", "doc_id")).join(named, "node", "left")
    component = F.coalesce("component", "node")
    return labelled.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; rows repeating a kept id stay."""
    dropped = near_duplicates(docs, settings).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
