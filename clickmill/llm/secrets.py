"""Secret scans: fixed patterns, and novelty measured by a primed compressor.

A candidate string in a sensitive context is compressed after the text around it and a dictionary
of code and identifiers. What it adds, per character, is its novelty: names, paths and words that
the dictionary or the surroundings foretell add little; keys add all their bits.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import text_rows

KINDS = ("assign", "access", "hex", "novel")
# What counts as a secret whatever its novelty.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words near a string that make it worth measuring.
CONTEXT = re.compile(
    r"password|passwd|passphrase|secret|token|(?:api|access|private)[ _-]?key|credential|bearer|authorization|signature",
    re.IGNORECASE | re.ASCII)
CONTEXT_WORDS = ("passw", "passphrase", "secret", "token", "key", "credential", "bearer", "authorization", "signature")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: What joins the parts of one secret: tokens in parts, keys over several lines, quoted or not.
JOINT = re.compile(r"""[ \t\\,+]{0,40}[.\r\n"'][.\s"'\\,+]{0,40}""")
PEM_TAIL = re.compile(r"""[\s"'\\,+]{1,40}([A-Za-z0-9+/=]{1,15})[\s"'\\,+]{1,40}-----END """)
REACH = 64  # characters between a context word and a candidate
AROUND = 512  # characters before and after a candidate that foretell it
MIN_NOVELTY = 0.55

IDENTIFIERS = """
import from return class def function const let var public private static final void int string
bool true false null none self this new for while if else elif try except catch finally raise throw
with as lambda yield async await package module export default require include define struct enum
interface extends implements override protected abstract namespace using template typename virtual
config settings environment variable value values name names user username account client server host
port path file folder directory database connection session request response header body content type
application json text html http https www com org net localhost index main test example sample demo
get set put post delete update insert select where order group limit offset create table alter drop
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000 1234567890 xxxxxxxxxxxx
password passwd passphrase secret token api_key apikey access_key private_key credential bearer
authorization signature changeme placeholder your_key_here replace_me example_key dummy
"""


class Novelty:
    """Marginal compressed size of strings, in bytes per character."""

    def __init__(self, identifiers: str = IDENTIFIERS) -> None:
        import zstandard

        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(
            level=19, dict_data=primed, write_checksum=False, write_content_size=False)

    def of(self, text: str, start: int, end: int) -> float:
        """What ``text[start:end]`` adds to its surroundings, other copies of it left out."""
        value = text[start:end]
        # Room for copies that the edge would cut, as a part of one foretells as well.
        before = text[max(0, start - AROUND - len(value)):start].replace(value, "")[-AROUND:]
        after = text[end:end + AROUND + len(value)].replace(value, "")[:AROUND]
        around = (before + after).encode("utf-8", "surrogatepass")
        with_it = around + value.encode("utf-8", "surrogatepass")
        return (len(self.packer.compress(with_it)) - len(self.packer.compress(around))) / (end - start)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    folded = text.lower()
    if any(w in folded for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def novel_spans(text: str, taken: list[tuple[int, int, str]], novelty: Novelty) -> list[tuple[int, int, str]]:
    """Strings near a context word, outside the base spans, that nothing around them foretells.

    What is joined to a reported string is in its context, before and after it.
    """
    folded = text.lower()
    if not any(w in folded for w in CONTEXT_WORDS):
        return []
    near = [m.span() for m in CONTEXT.finditer(text)]
    if not near:
        return []
    spans = [m.span() for m in CANDIDATE.finditer(text)]
    begins, ends = [s for s, _ in near], [e for _, e in near]
    known: dict[int, bool] = {}
    reported: list[bool] = []
    covers, cover, most = sorted(taken), 0, 0

    def judged(i: int) -> bool:
        if i not in known:
            start, end = spans[i]
            value = text[start:end]
            known[i] = (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
                        and novelty.of(text, start, end) >= MIN_NOVELTY)
        return known[i]

    def joined(i: int) -> bool:
        return JOINT.fullmatch(text, spans[i][1], spans[i + 1][0]) is not None

    covered = []
    for i, (start, end) in enumerate(spans):
        while cover < len(covers) and covers[cover][0] < end:
            most = max(most, covers[cover][1])
            cover += 1
        covered.append(most > start)
        # The first word that ends within reach before the candidate, or begins within reach behind it.
        at = bisect_left(ends, start - REACH)
        beside = at < len(near) and begins[at] <= end + REACH
        reported.append(covered[i] or (
            (beside or (i > 0 and reported[i - 1] and joined(i - 1))) and judged(i)))
    for i in range(len(spans) - 2, -1, -1):
        if not reported[i] and reported[i + 1] and joined(i):
            reported[i] = judged(i)
    found = []
    for i, (start, end) in enumerate(spans):
        if reported[i]:
            if not covered[i]:
                found.append((start, end, "novel"))
            # The last line of a key, which may be too short to measure.
            tail = PEM_TAIL.match(text, end)
            if tail and not any(s < tail.end(1) and e > tail.start(1) for s, e, _ in taken):
                found.append((*tail.span(1), "novel"))
    return found


def find_spans(text: str, novelty: Novelty) -> list[tuple[int, int, str]]:
    """All spans by start, then kind; ends are exclusive and places are code points."""
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, novelty), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found`` (an array of ``kind, start, end``) for every row of ``docs``.

    The fixed patterns find spans anywhere. Beside them a string is a candidate if it has 16 or more
    characters and stands within ``REACH`` characters of a sensitive word, before or behind it,
    or is joined to one that is reported; ``AROUND`` characters on either side foretell it.
    Null and empty texts have no spans. A very long text is scanned whole, by one task. Null or repeated
    ids and repeated rows are scanned each on its own; no rows give no rows; columns other than
    ``doc_id, text`` are not read.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scanned(batches):
        novelty = Novelty()
        for part, texts in text_rows(batches):
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in find_spans(t, novelty)] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(
        scanned, "doc_id bigint, found array<struct<kind string, start int, end int>>")


def summary(scanned: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the fixed patterns' spans, and all spans as text."""
    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("found", lambda s: s["kind"] != "novel")
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        count("novel").alias("n_novel"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret, and each run of overlapping ones, replaced by ``mark``.

    Texts without a secret stay as they are, null ones stay null.
    """
    def cleaned(batches):
        novelty = Novelty()
        for part, texts in text_rows(batches):
            at = part.schema.get_field_index("text")
            nulls = part.column(at).is_null().to_pylist()
            new = [None if null else replaced(t, find_spans(t, novelty), mark)
                   for t, null in zip(texts, nulls, strict=True)]
            yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    return docs.mapInArrow(cleaned, docs.schema)


def replaced(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    parts, done, open_until = [], 0, -1
    for start, end, _ in spans:
        if start >= open_until:
            parts += [text[done:start], mark]
        done = open_until = max(end, open_until)
    return "".join(parts) + text[done:] if spans else text
