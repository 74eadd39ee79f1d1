"""Benchmark decontamination by suffix arrays of the training texts.

Every task turns its documents into shards of word numbers, sorts the shard's suffixes, and looks
up every suffix of every benchmark item by binary search, word by word. The interval of a suffix
after ten words holds all places where that window occurs; the last interval that is not empty
gives the longest verbatim match. Only words of the benchmark have numbers, and a suffix is sorted
only if enough such words follow for a window to fit; no other place can hold one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import LOWER, kept, text_rows

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_BYTES = 16 << 20  # of benchmark text that a task holds at once
#: Bytes that end a word after lower-casing: ASCII other than digits and lower-case letters.
WORD_BYTES = bytes(
    32 if LOWER[b] < 0x30 or 0x3A <= LOWER[b] <= 0x60 or 0x7B <= LOWER[b] <= 0x7F else LOWER[b] for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


@dataclass(frozen=True)
class Items:
    """A block of benchmark items as word numbers from 1; each item ends with 0."""

    vocabulary: dict[bytes, int]
    tokens: np.ndarray
    ends: np.ndarray  # for every place, the end of its item
    owners: np.ndarray  # for every place, the number of its item
    item_ids: list[str | None]
    shortest: int  # words of the shortest window
    longest: int  # words of the longest item

    @staticmethod
    def of(rows: list[tuple[object, list[bytes]]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        tokens, ends, owners = [], [], []
        for number, (_, item) in enumerate(rows):
            end = len(tokens) + len(item)
            tokens += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in item] + [0]
            ends += [end] * (len(item) + 1)
            owners += [number] * (len(item) + 1)
        sizes = [len(item) for _, item in rows]
        return Items(vocabulary, np.array(tokens, np.int64), np.array(ends, np.int64), np.array(owners, np.int64),
                     [None if i is None else str(i) for i, _ in rows],
                     min(WINDOW, min(sizes)), max(sizes))


def item_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of about ``most`` bytes of text, dealt by hash; those without words are left out.

    The driver and a task hold one block at a time. Several blocks lie in the shared folder, from
    where each is fetched when it is its turn.
    """
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = -(-size // most)
    if number > 1:
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
        items = kept(items.withColumn("block", place).repartition("block"), "benchmark")
    for block in range(number):
        rows = (items.where(F.col("block") == block) if number > 1 else items).select("item_id", "text").collect()
        found = [(r["item_id"], words(r["text"])) for r in sorted(rows, key=lambda r: (str(r["item_id"]), r["text"]))]
        found = [row for row in found if row[1]]
        if found:
            yield Items.of(found)


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Places of all words above 0, sorted by the ``depth`` words from there, by prefix doubling."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) if len(tokens) else tokens
    reach = 1
    while reach < depth:
        after = np.zeros_like(rank)
        after[:-reach or None] = rank[reach:] if reach < len(rank) else 0
        joint = rank * (int(rank.max()) + 1) + after
        joint[tokens == 0] = -1
        rank = np.unique(joint, return_inverse=True)[1].astype(np.int64)
        reach *= 2
        if rank.max() + 1 >= np.count_nonzero(tokens) + 1:
            break
    order = np.argsort(rank, kind="stable")
    return order[tokens[order] > 0]


def _bound(tokens, suffixes, low, high, depth, wanted, after: bool) -> np.ndarray:
    """For each query, the first suffix in its interval whose word at ``depth`` is the wanted one
    or, with ``after``, larger."""
    low, high = low.copy(), high.copy()
    while True:
        live = low < high
        if not live.any():
            return low
        middle = (low + high) // 2
        word = tokens[np.minimum(suffixes[np.where(live, middle, 0)] + depth, len(tokens) - 1)]
        right = live & ((word <= wanted) if after else (word < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(live & ~right, middle, high)


def search(tokens: np.ndarray, items: Items) -> tuple[list, list]:
    """Occurrences of windows and longest matches in a shard.

    ``tokens`` are word numbers, 0 for words outside the benchmark and after each document.
    Returns (place, length, item) arrays of windows, and of the longest match of every item suffix.
    """
    zero = np.flatnonzero(np.append(tokens, 0) == 0)
    room = np.diff(np.concatenate(([-1], zero))) - 1  # words before each zero
    lasts = zero[room >= items.shortest]
    if not len(lasts):
        return [], []
    firsts = lasts - room[room >= items.shortest]
    lengths = lasts - firsts + 1
    # The runs worth sorting, each with a zero behind it, and where they were.
    shifts = np.repeat(firsts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    places = np.arange(lengths.sum()) + shifts
    dense = np.append(tokens, 0)[places]
    suffixes = suffix_array(dense, items.longest)
    query = np.flatnonzero(items.tokens)
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(suffixes), np.int64)
    sizes = items.ends - np.searchsorted(items.owners, items.owners)  # of each place's item
    windows, longest = [], []
    for depth in range(items.longest):
        inside = query + depth < items.ends[query]
        over = ~inside
        if over.any():
            longest.append((query[over], low[over], high[over], depth))
            query, low, high = query[inside], low[inside], high[inside]
        if not len(query):
            break
        wanted = items.tokens[query + depth]
        new_low = _bound(dense, suffixes, low, high, depth, wanted, False)
        new_high = _bound(dense, suffixes, new_low, high, depth, wanted, True)
        gone = new_low >= new_high
        if gone.any() and depth:
            longest.append((query[gone], low[gone], high[gone], depth))
        query, low, high = query[~gone], new_low[~gone], new_high[~gone]
        whole = np.minimum(sizes[query], WINDOW) == depth + 1
        # An item of fewer words than a window is one window as a whole, so only from its start.
        whole &= query + depth + 1 <= items.ends[query]
        if whole.any():
            windows.append((query[whole], low[whole], high[whole], depth + 1))
    if len(query):
        longest.append((query, low, high, items.longest))
    return ([_places(w, suffixes, places, items) for w in windows],
            [_places(m, suffixes, places, items) for m in longest])


def _places(found, suffixes, places, items):
    query, low, high, length = found
    sizes = high - low
    rows = np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    return places[suffixes[rows]], np.full(len(rows), length), items.owners[np.repeat(query, sizes)]


def _shards(batches) -> Iterator[list]:
    """Whole documents, with what earlier passes found, in shards of about ``SHARD_WORDS`` words."""
    shard, size = [], 0
    for part, texts in text_rows(batches):
        rows = part.drop_columns(["text"]).to_pylist()
        for row, text in zip(rows, texts, strict=True):
            shard.append((row, text))
            size += len(text) // 6
            if size >= SHARD_WORDS:
                yield shard
                shard, size = [], 0
    if shard:
        yield shard


def _merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans, as rows of start and end, that cover the same words."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    return np.stack([spans[new, 0], np.append(reach[:-1][new[1:]], reach[-1])], 1)


STATE = "doc_id bigint, n_words bigint, n_hit bigint, spans binary, items array<string>, longest_words int, longest_start int, longest_item string"


def _pass(block, with_text: bool):
    names = [part.split()[0] for part in STATE.split(", ")]

    def run(batches):
        items = block.value
        for shard in _shards(batches):
            lists = [_numbers(text, items) for _, text in shard]
            starts = np.cumsum([0] + [len(x) for x in lists])
            windows, longest = search(np.concatenate(lists), items)
            out = []
            for (row, text), x in zip(shard, lists, strict=True):
                out.append({**row, "text": text, "n_words": len(x) - 1})
            _note(out, starts, windows, longest, items)
            columns = {n: [r[n] for r in out] for n in names + ["text"] * with_text}
            kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_hit": pa.int64(), "spans": pa.binary(), "items": pa.list_(pa.string()),
                     "longest_words": pa.int32(), "longest_start": pa.int32(), "longest_item": pa.string(),
                     "text": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[n]) for n, v in columns.items()], list(columns))

    return run


def _note(out, starts, windows, longest, items) -> None:
    """Put a shard's matches on its documents' rows."""
    if windows:
        place, length, owner = (np.concatenate(x) for x in zip(*windows, strict=True))
        doc = np.searchsorted(starts, place, "right") - 1
        order = np.argsort(doc, kind="stable")
        cuts = np.flatnonzero(np.diff(doc[order])) + 1
        for rows in np.split(order, cuts) if len(order) else ():
            row, start = out[doc[rows[0]]], starts[doc[rows[0]]]
            new = np.stack([place[rows] - start, place[rows] - start + length[rows]], 1)
            old = np.frombuffer(row["spans"], np.int64).reshape(-1, 2)
            spans = _merged(np.concatenate([old, new])).astype(np.int64)
            row["spans"], row["n_hit"] = spans.tobytes(), int((spans[:, 1] - spans[:, 0]).sum())
            ids = {items.item_ids[o] for o in np.unique(owner[rows])} - {None}
            row["items"] = sorted(ids.union(row["items"]))
    if longest:
        place, length, owner = (np.concatenate(x) for x in zip(*longest, strict=True))
        doc = np.searchsorted(starts, place, "right") - 1
        order = np.lexsort((place, -length, doc))
        first = order[np.append(True, np.diff(doc[order]) > 0)] if len(order) else order
        for at in first:
            row = out[doc[at]]
            if length[at] > row["longest_words"]:
                row["longest_words"] = int(length[at])
                row["longest_start"] = int(place[at] - starts[doc[at]])
                row["longest_item"] = items.item_ids[owner[at]]


def matches(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``n_words``, merged ``spans`` of words hit (pairs of 64-bit start and
    end), ``items`` found, and the longest verbatim match with its place and item.

    The benchmark is read in blocks of bounded size; with several, the documents pass one block
    after the other, kept in the shared folder in between. Documents are never split, so a shard
    holds at least one, however long.
    Null or wordless texts match nothing and no item occurs without words. An item with a null id
    marks words but is not listed; equal ids count once. Rows of ``docs`` with null or repeated ids
    are searched each on its own. Only ``doc_id, text`` and ``item_id, text`` are read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").selectExpr(
        "doc_id", "0L AS n_words", "0L AS n_hit", "cast('' AS binary) AS spans", "cast(array() AS array<string>) AS items",
        "0 AS longest_words", "cast(NULL AS int) AS longest_start", "cast(NULL AS string) AS longest_item", "text")
    nothing = Items({}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), [], 1, 0)
    blocks = iter(item_blocks(benchmark, block_bytes))
    block = next(blocks, nothing)
    while block is not None:
        after = next(blocks, None)
        held = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_pass(held, after is not None), STATE + ", text string" if after else STATE)
        if after:
            rows = kept(rows, "searched")
            held.destroy()
        block = after
    return rows


def report(found: DataFrame) -> DataFrame:
    """Words, words hit, items and the verdict per row of ``matches``."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.col("longest_words").cast("bigint").alias("longest_words"),
        F.col("longest_start").cast("bigint").alias("longest_start"), "longest_item")


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without a word inside an occurring window, with all their columns.

    Rows are told apart by position in their batch, not by id, so that null and repeated ids do no harm.
    """
    spark, blocks = docs.sparkSession, iter(item_blocks(benchmark, block_bytes))
    items = next(blocks, None)
    while items is not None:
        after = next(blocks, None)
        block = spark.sparkContext.broadcast(items)

        def untouched(batches, block=block):
            for batch in batches:
                texts = ((part, texts) for part, texts in text_rows(iter([batch])))
                for part, found in texts:
                    lists = [_numbers(t, block.value) for t in found]
                    starts = np.cumsum([0] + [len(x) for x in lists])
                    windows, _ = search(np.concatenate(lists), block.value)
                    hit = np.zeros(len(lists), bool)
                    for place, _, _ in windows:
                        hit[np.searchsorted(starts, place, "right") - 1] = True
                    yield part.filter(pa.array(~hit))

        docs = docs.mapInArrow(untouched, docs.schema)
        if after:
            docs = kept(docs, "untouched")
            block.destroy()
        items = after
    return docs


def _numbers(text: str, items: Items) -> np.ndarray:
    """A text's words as numbers, 0 for those not in the benchmark, with a 0 behind the last."""
    number = items.vocabulary.get
    return np.array([number(w, 0) for w in words(text)] + [0], np.int64)
