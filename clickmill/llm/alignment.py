"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes.

A text is encoded by A, a byte-level BPE, and by B, a BPE over pieces. Tokens are intervals of bytes.
All of both are sorted by start and their ends maximised from the left; where a start reaches the
running maximum nothing spans the place, and a group ends. Within a group every A token is linked
with every B token.

Both tokenizers part at an isolated space before a solid character, so that texts are cut there and
each distinct piece is aligned once. Texts are worked on in blocks of bounded size; a block asks
once for the corpus-wide count of each pair of ids it holds.
"""

from __future__ import annotations

import hashlib
import json
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import kept, text_rows

#: Bytes of text of a block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Links of all remembered pieces beyond which a worker forgets those it met in the fewest blocks.
REMEMBERED = 2_000_000
#: Pieces handed to a tokenizer at once; its answers take a kilobyte each.
PIECES_AT_ONCE = 4096
#: Pieces encoded as one text.
JOINED = 64
#: Links of a group from which on equal ones are counted rather than listed.
WIDE = 1024
#: A pair of ids is ``a << B_BITS | b``.
B_BITS = 24
PIECE_SPACE = "▁"
#: Bytes that begin a solid character: printable ASCII, or the first byte from a range without white space.
SOLID = np.array([0x20 < c < 0x7F or 0xC2 < c < 0xE1 or c > 0xE3 for c in range(256)])


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies spell bytes: visible Latin-1 as it is, others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(other)}


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of runs laid end to end."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token, given their lengths in bytes, in order."""
    ends = np.concatenate((np.cumsum(a_sizes), np.cumsum(b_sizes)))
    starts = ends - np.concatenate((a_sizes, b_sizes))
    kind = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    first = np.ones(len(order), bool)
    first[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    return group[:len(a_sizes)], group[len(a_sizes):]


def laid_out(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each list has."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), sizes


class Flat:
    """The bytes of all tokens of a vocabulary in a row."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.chars = np.frombuffer(b"".join(tokens), np.uint8)

    def spells(self, flat: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text, put together, are the text."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        owner = np.repeat(np.arange(len(texts)), counts)
        fits = np.bincount(owner, self.sizes[flat], len(texts)).astype(np.int64) == sizes
        flat = flat[fits[owner]]
        said = self.chars[_ragged(self.starts[flat], self.sizes[flat])]
        meant = np.frombuffer(b"".join([t for t, ok in zip(texts, fits.tolist(), strict=True) if ok]), np.uint8)
        wrong = np.repeat(np.flatnonzero(fits), sizes[fits])[said != meant]
        fits[wrong] = False
        return fits


class Aligner:
    """Alignments of pieces of text, each distinct one worked out once and remembered by its number."""

    def __init__(self, a_path: str, b_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        added = {t["content"] for t in json.loads(self.a.to_str())["added_tokens"]}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = token.encode() if token in added else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(PIECE_SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_flat, self.b_flat = Flat(self.a_bytes), Flat(self.b_bytes)
        self.digits = [str(i) for i in range(max(len(self.a_bytes), len(pieces)))]
        self.cuts = _parts_at_spaces(json.loads(self.a.to_str()), pieces)
        self.known: dict[bytes, int] = {}
        self.groups: list[str | None] = []
        #: A row per piece: A tokens, B tokens, groups, links, places in ``links``; and the blocks it was in.
        self.numbers, self.met = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)
        #: Distinct pairs as they came, and by value; the links of all pieces as places of their pair.
        self.pairs, self.sorted, self.place = (np.zeros(0, np.int64) for _ in range(3))
        self.links, self.weights = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def forget(self, links: int) -> None:
        """Keep at most ``links``: of the pieces met in most blocks."""
        held = self.numbers[:, 4]
        often = np.bincount(np.minimum(self.met, 64), held, 65)[::-1].cumsum()[::-1]
        stays = np.minimum(self.met, 64) >= np.argmax(np.append(often, 0) <= links)
        at = _ragged((np.cumsum(held) - held)[stays], held[stays])
        self.links, self.weights = self.links[at], self.weights[at]
        self.numbers, self.met = self.numbers[stays], self.met[stays]
        self.groups = [g for g, ok in zip(self.groups, stays.tolist(), strict=True) if ok]
        names = [p for p, ok in zip(self.known, stays.tolist(), strict=True) if ok]
        self.known = dict(zip(names, range(len(names)), strict=True))

    def learn(self, pieces: list[bytes]) -> None:
        """Align pieces not known yet; each begins with a space. One that a tokenizer does not give back has no groups."""
        plain = [p for p in pieces if len(p) > 1 and SOLID[p[1]] and p[-1] != 0x20]
        if len(plain) < len(pieces):
            # Those that a tokenizer may not part from their neighbours come last, one by one.
            odd = [p for p in pieces if not (len(p) > 1 and SOLID[p[1]] and p[-1] != 0x20)]
            pieces = plain + odd
            parts = [self._encoded(plain)] if self.cuts and plain else [self._ids(plain)] if plain else []
            a, n_a, b, n_b = (np.concatenate(column) for column in zip(*parts, self._ids(odd), strict=True))
        else:
            a, n_a, b, n_b = self._encoded(pieces) if self.cuts else self._ids(pieces)
        whole = self.a_flat.spells(a, n_a, pieces) & self.b_flat.spells(b, n_b, pieces)
        if not whole.all():
            a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
            n_a, n_b = n_a * whole, n_b * whole
        in_a, in_b = coalesce(self.a_flat.sizes[a], self.b_flat.sizes[b])
        groups = int(in_a[-1]) + 1 if len(in_a) else 0
        g_a, g_b = np.bincount(in_a, minlength=groups), np.bincount(in_b, minlength=groups)
        a_at, b_at = np.cumsum(g_a) - g_a, np.cumsum(g_b) - g_b
        owner = np.repeat(np.arange(len(pieces)), n_a)[a_at]
        n_groups = np.bincount(owner, minlength=len(pieces))
        said_a, said_b = ([self.digits[i] for i in x.tolist()] for x in (a, b))
        spelled = [
            f"{said_a[x]}|{said_b[y]}" if n == m == 1 else f"{','.join(said_a[x:x + n])}|{','.join(said_b[y:y + m])}"
            for x, n, y, m in zip(a_at.tolist(), g_a.tolist(), b_at.tolist(), g_b.tolist(), strict=True)]
        ends = np.cumsum(n_groups).tolist()
        self.groups += [";".join(spelled[e - n:e]) if ok else None
                        for e, n, ok in zip(ends, n_groups.tolist(), whole.tolist(), strict=True)]
        at, pairs, weights = self._expand(a, b, a_at, b_at, g_a, g_b, g_a * g_b)
        order = np.argsort(owner[at], kind="stable")
        held = np.bincount(owner[at], minlength=len(pieces))
        self.known.update(zip(pieces, range(len(self.numbers), len(self.numbers) + len(pieces)), strict=True))
        self.met = np.append(self.met, np.zeros(len(pieces), np.int64))
        all_links = np.bincount(owner, g_a * g_b, len(pieces)).astype(np.int64)
        self.numbers = np.concatenate((self.numbers, np.stack([n_a, n_b, n_groups, all_links, held], 1)))
        self.links = np.concatenate((self.links, self._places(pairs[order]).astype(np.int32)))
        self.weights = np.concatenate((self.weights, weights[order].astype(np.int32)))

    def _ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, how many each text has, and the same of B, which adds the space before a text itself."""
        said = [t.decode("utf-8") for t in texts]
        a_ids = [e.ids for e in self.a.encode_batch_fast(said, add_special_tokens=False)]
        return *laid_out(a_ids), *laid_out(self.b.encode([t[1:] for t in said], num_threads=1))

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``_ids`` of all pieces. Both tokenizers part between them, so that many are encoded as one text."""
        found = []
        for start in range(0, len(pieces), PIECES_AT_ONCE):
            part = pieces[start:start + PIECES_AT_ONCE]
            joined = [b"".join(part[k:k + JOINED]) for k in range(0, len(part), JOINED)]
            a, n_a, b, n_b = self._ids(joined)
            if (self.a_flat.spells(a, n_a, joined) & self.b_flat.spells(b, n_b, joined)).all():
                ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
                n_a, n_b = (np.diff(np.searchsorted(np.cumsum(flat.sizes[ids]), ends, "right"), prepend=0)
                            for flat, ids in ((self.a_flat, a), (self.b_flat, b)))
                found.append((a, n_a, b, n_b))
            else:
                found.append(self._ids(part))
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def _places(self, pairs: np.ndarray) -> np.ndarray:
        """Places of pairs in ``pairs``, where new ones are added."""
        values, inverse = np.unique(pairs, return_inverse=True)
        new = values[~np.isin(values, self.sorted, assume_unique=True)]
        if len(new):
            self.pairs = np.concatenate((self.pairs, new))
            self.place = np.argsort(self.pairs)
            self.sorted = self.pairs[self.place]
        return self.place[np.searchsorted(self.sorted, values)][inverse]

    @staticmethod
    def _expand(a, b, a_at, b_at, g_a, g_b, links):
        """(group, pair, how often) of all links; those of a wide group by its distinct ids."""
        few = np.flatnonzero(links <= WIDE)
        group = np.repeat(few, links[few])
        k = _ragged(np.zeros(len(few), np.int64), links[few])
        pairs = a[a_at[group] + k // g_b[group]] << B_BITS | b[b_at[group] + k % g_b[group]]
        found = [(group, pairs, np.ones(len(pairs), np.int64))]
        for g in np.flatnonzero(links > WIDE):
            x, n = np.unique(a[a_at[g]:a_at[g] + g_a[g]], return_counts=True)
            y, m = np.unique(b[b_at[g]:b_at[g] + g_b[g]], return_counts=True)
            found.append((np.full(len(x) * len(y), g), (x[:, None] << B_BITS | y).ravel(), (n[:, None] * m).ravel()))
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, none of them empty, and where each text's begin."""
        raw = b"".join([b" " + t.encode("utf-8") for t in texts])
        sizes = np.fromiter((len(t.encode("utf-8")) + 1 for t in texts), np.int64, len(texts))
        begins = np.cumsum(sizes) - sizes
        marks = np.zeros(len(raw), bool)
        marks[begins] = True
        if self.cuts:
            chars = np.frombuffer(raw, np.uint8)
            marks[1:-1] |= (chars[1:-1] == 0x20) & (chars[:-2] != 0x20) & SOLID[chars[2:]]
        starts = np.flatnonzero(marks)
        offsets = np.append(starts, len(raw))
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.links) > REMEMBERED:
            self.forget(REMEMBERED // 2)
        missing = [p for p in distinct if p not in self.known]
        if missing:
            self.learn(missing)
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        self.met[numbers] += 1
        return numbers[coded.indices.to_numpy()], np.searchsorted(starts, begins)


@cache
def aligner_of(a_path: str, b_path: str) -> Aligner:
    """A worker's aligner; what it remembers serves its later tasks too."""
    return Aligner(a_path, b_path)


def _parts_at_spaces(a_file: dict, b_pieces: list[str]) -> bool:
    """Whether the files say that no token of either lies across a space with other characters before it.

    A splits texts by the usual pattern, in which one space belongs to the word behind it. In B no
    piece has a space behind something else.
    """
    split = a_file["pre_tokenizer"] or {}
    a_parts = a_file["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex")
    return bool(a_parts) and not any(
        x != PIECE_SPACE and y == PIECE_SPACE for p in b_pieces for x, y in zip(p, p[1:], strict=False))


BLOCKS = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
          "groups_sha256 string, codes binary, times binary, pairs array<bigint>, docs array<bigint>")


def _block(aligner: Aligner, number: int, ids: list, texts: list[str], spell: bool) -> pa.RecordBatch:
    """Rows of a block's documents, and one with the pairs they hold and how many hold each."""
    there = [k for k, t in enumerate(texts) if t]
    counts = np.zeros((len(texts), 4), np.int64)
    told, sums = [""] * len(texts) if spell else [None] * len(texts), [""] * len(texts)
    codes, times = [b""] * len(texts), [b""] * len(texts)
    used = np.zeros(0, np.int64)
    holders = used
    if there:
        pieces, begins = aligner.pieces([texts[k] for k in there])
        numbers = aligner.numbers
        spans = list(zip(begins.tolist(), [*begins[1:].tolist(), len(pieces)], strict=True))
        groups, listed = aligner.groups, pieces.tolist()
        good = np.ones(len(there), bool)
        for k, (start, end) in enumerate(spans):
            parts = [groups[p] for p in listed[start:end]]
            if None in parts:
                good[k] = False
            else:
                line = ";".join(parts)
                sums[there[k]] = hashlib.sha256(line.encode()).hexdigest()
                if spell:
                    told[there[k]] = line
        counts[np.array(there)[good]] = np.add.reduceat(numbers[pieces, :4], begins)[good]
        doc = np.repeat(np.arange(len(there)), np.diff(np.append(begins, len(pieces))))
        pieces, doc = pieces[good[doc]], doc[good[doc]]
        held = numbers[pieces, 4]
        at = _ragged((np.cumsum(numbers[:, 4]) - numbers[:, 4])[pieces], held)
        link, weight = aligner.links[at], aligner.weights[at]
        found = np.flatnonzero(np.bincount(link, minlength=len(aligner.pairs)))
        used = aligner.pairs[found]
        local = np.zeros(len(aligner.pairs), np.int64)
        local[found] = np.arange(len(found))
        key = np.repeat(doc, held) * len(used) + local[link]
        if (weight == 1).all():
            key.sort()
        else:
            order = np.argsort(key)
            key, weight = key[order], weight[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        often = np.add.reduceat(weight, first, dtype=np.int64) if len(key) else first
        owner, code = np.divmod(key[first], max(len(used), 1))
        holders = np.bincount(code, minlength=len(used))
        edges = np.searchsorted(owner, np.arange(len(there) + 1))
        code, often = code.astype(np.int32), often.astype(np.int64)
        for k, place in enumerate(there):
            codes[place] = code[edges[k]:edges[k + 1]].tobytes()
            times[place] = often[edges[k]:edges[k + 1]].tobytes()
    n = len(texts) + 1
    columns = [pa.array([number] * n, pa.int64()), pa.array([*ids, None], pa.int64())]
    columns += [pa.array([*c.tolist(), None], pa.int64()) for c in counts.T]
    columns += [pa.array([*x, None], pa.string()) for x in (told, sums)]
    columns += [pa.array([*x, None], pa.binary()) for x in (codes, times)]
    columns += [pa.ListArray.from_arrays(pa.array([None] * (n - 1) + [0, len(x)], pa.int32()), pa.array(x))
                for x in (used, holders)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in BLOCKS.split(", ")])


def _encode(a_path: str, b_path: str, block_bytes: int, spell: bool):
    def encode(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner, number = aligner_of(a_path, b_path), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for part, more in text_rows(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), more, strict=True):
                if texts and size + len(text) > block_bytes:
                    yield _block(aligner, number, ids, texts, spell)
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield _block(aligner, number, ids, texts, spell)

    return encode


def blocks(docs: DataFrame, paths: tuple[str, str] | None = None, block_bytes: int = BLOCK_BYTES,
           spell: bool = False) -> DataFrame:
    a_path, b_path = paths or tokenizer_paths()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _encode(a_path, b_path, block_bytes, spell), BLOCKS)


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups`` per row of ``docs``; groups read ``a1,a2|b1;a3|b2``.

    Rows as in ``align``.
    """
    rows = blocks(docs, paths, spell=True).where("pairs IS NULL")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def pair_counts(worked: DataFrame) -> DataFrame:
    """``pair, held, top``: how many documents hold a pair linked, and whether no pair of its A id is in more.

    An A id has at most as many pairs as B has ids, so a window over them is bounded.
    """
    held = worked.where("pairs IS NOT NULL").select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("docs").alias("n"))))
    counted = held.groupBy("pair").agg(F.sum("n").alias("held"))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counted.select("pair", "held", (F.col("held") == F.max("held").over(of_a)).alias("top"))


def _weighed(docs: pa.Table, asked: pa.Table) -> pa.Table:
    """A block's documents with the counts of their links."""
    held, top = (np.zeros(asked.num_rows, np.int64) for _ in range(2))
    at = asked.column("code").to_numpy()
    held[at], top[at] = asked.column("held").to_numpy(), asked.column("best").to_numpy()
    best, total = [], []
    for codes, times in zip(docs.column("codes").to_pylist(), docs.column("times").to_pylist(), strict=True):
        code, often = np.frombuffer(codes, np.int32), np.frombuffer(times, np.int64)
        best.append(int(often @ top[code]))
        total.append(int(often @ held[code]))
    given = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return given.append_column("n_best", pa.array(best, pa.int64())).append_column(
        "count_sum", pa.array(total, pa.int64())).append_column("groups_sha256", docs.column("groups_sha256"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``paths`` are the files of A (tokenizers, byte-level) and B (sentencepiece). Special strings in a
    text are plain text. A null or empty text, and one whose bytes a tokenizer does not give back,
    has no tokens, zeros and an empty ``groups_sha256``. Every row is a document, also rows that
    repeat an id or have none; ties for the highest count are all highest. A very long text is a
    block of its own, held by one task. Other columns are not read; no rows give no rows.
    """
    worked = kept(blocks(docs, paths, block_bytes), "alignments")
    counts = kept(pair_counts(worked), "pair-counts")
    asked = worked.where("pairs IS NOT NULL").select(F.col("block").alias("of"), F.posexplode("pairs").alias("code", "pair"))
    answers = asked.join(counts, "pair").select("of", "code", "held", F.col("top").cast("bigint").alias("best"))
    rows = worked.where("pairs IS NULL").drop("groups", "pairs", "docs")
    return rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(
        _weighed, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                  "count_sum bigint, groups_sha256 string")
