"""HTML extraction by wrapper induction.

Pages of a host are aligned by simple tree matching of their block elements, runs of like siblings
counting as one; where siblings of a run begin with different elements, those of each kind are a
run of their own. The merged tree, the host's wrapper, knows of every node how many pages have it
and whether its text is always the same. Constant nodes are template; varying ones are content if
they lie in the article or, on pages that mark none, in the part of the wrapper that holds most of
the varying text. Menus, forms, comments and the like are told by their element and are never
content, even though they vary. A class or id that names such a thing has a say only as far as the
wrapper has none: if most of what varies on a host lies in one part of that name, it is content.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import SLICE_ROWS, kept

# Elements of HTML, and names by which pages mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
NOT_CONTENT = frozenset("head nav aside form button select menu dialog object audio video canvas footer".split())
MAIN = frozenset("article main".split())
NOT_CONTENT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer cookie cookies consent notice notices alert popup modal overlay "
    "newsletter subscribe subscription share sharing social comment comments respond replies disqus related "
    "recommended widget toolbar masthead login signup search pagination pager skip".split())
#: Of those, names that parts of an article have too; inside one the wrapper decides.
DOUBTFUL_NAMES = frozenset(
    "notice notices alert related recommended social comment search banner promo promotion menu widget login signup "
    "consent skip pager pagination navigation subscription subscribe overlay toolbar".split())
REMARK_NAMES = frozenset("comment comments respond replies disqus".split())
NEVER_BY_NAME = frozenset("html body".split())
HEADER_NAMES = frozenset("header masthead topbar".split())
NOT_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
#: An open element of the key ends when one of the values opens; no value: any block does.
ENDED_BY = {
    "p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "h1": None, "h2": None, "h3": None, "h4": None, "h5": None, "h6": None,
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?>(?:[^>"']+|"[^"]*"|'[^']*')*))>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
DEPTH = 64  # elements nested deeper count as part of the one at this depth
MAX_NODES = 2000  # nodes a wrapper remembers; rarer ones are then taken for varying
BY_NAME, BY_ELEMENT = 1, 2  # what makes a node boilerplate
NAMED = "~"  # begins the label of a wrapper node that is boilerplate by name
CUT = "*"  # label of what the cut nodes had, which no element has
TEMPLATE_SHARE = 0.8  # of the host's distinct pages, two at least, that agree where a text is template
MAIN_SHARE = 0.8
HOSTS_HELD = 500
MERGED_AT_ONCE = 64


@dataclass(slots=True)
class Node:
    """A block element of one page, or a run of like siblings."""

    label: str
    boiler: int
    main: bool
    kids: list[Node] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)


def _named(attributes: str) -> tuple[str, set[str], str]:
    """Label part, name tokens and role of an element's attributes."""
    label, tokens, role = [], set(), ""
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            role = value.strip()
        else:
            label.append(re.sub(r"\d+", "#", value))
            # A token of several words counts if all of them are names: "cookie-notice", not "has-sidebar".
            for token in value.split():
                words = re.findall(r"[a-z]+", token)
                if len(words) == 1 or NOT_CONTENT_NAMES.issuperset(words):
                    tokens.update(words)
    return ".".join(label), tokens, role


def parse(text: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree of block elements and, in page order, the blocks of text with their nodes.

    If all that a page marks as its article is called something else by name, be it the article
    itself or what holds it, then the names of those elements do not count. Several articles of the
    kind are a list of others, as long as there is text beside them; comments are never spared.
    """
    root, blocks, seen, named = _parsed(text, frozenset())
    if not (seen or not named or (len(named) > 1 and any(not node.boiler for node, _ in blocks))):
        root, blocks, *_ = _parsed(text, frozenset().union(*named))
    runs: dict[int, Node] = {}
    _join_runs(root, runs)
    return root, [(runs.get(id(node), node), block) for node, block in blocks]


def _join_runs(node: Node, runs: dict[int, Node]):
    """Like siblings that follow each other become one node; ``runs`` tells which (by ``id``).

    Like are those of the same label. If they begin with different elements, as a menu, a story
    and a footer do that are all a ``div``, that goes into the labels and parts them.
    """
    kids, start = node.kids, 0
    node.kids = []
    while start < len(kids):
        first, stop = kids[start], start + 1
        while stop < len(kids) and kids[stop].label == first.label and kids[stop].boiler == first.boiler:
            stop += 1
        begun = [k.kids[0].label.partition(".")[0] if k.kids else "" for k in kids[start:stop]]
        if len(set(begun)) > 1:
            for kid, by in zip(kids[start:stop], begun, strict=True):
                kid.label += f">{by}" if by else ""
        for kid in kids[start:stop]:
            run = node.kids[-1] if node.kids else None
            if run is not None and run.label == kid.label and run.boiler == kid.boiler:
                run.kids += kid.kids
                run.texts += kid.texts
                run.main |= kid.main
                runs[id(kid)] = run
            else:
                node.kids.append(kid)
        start = stop
    for kid in node.kids:
        _join_runs(kid, runs)


def _parsed(text: str, spared: frozenset[int]) -> tuple[Node, list[tuple[Node, str]], bool, list[set[int]]]:
    """Tree and blocks, whether an article was seen that is not boilerplate, and for each one that
    is only by name its place in the text and those of the elements around it. Names of elements
    at the places ``spared`` are not regarded.
    """
    root = Node("", 0, False)
    stack: list[tuple[str, Node]] = [("", root)]
    opened: list[tuple[int, bool]] = [(-1, False)]  # place of each open element; boilerplate other than by these names
    seen, named = False, []
    blocks: list[tuple[Node, str]] = []
    words: list[str] = []

    def flush():
        block = " ".join("".join(words).split())
        words.clear()
        if block:
            node = stack[-1][1]
            blocks.append((node, block))
            node.texts.append(block)

    def close(upto: int):
        flush()
        del stack[upto:], opened[upto:]

    at, end = 0, len(text)
    while at < end:
        m = TOKEN.search(text, at)
        chunk = text[at:m.start() if m else end]
        if chunk:
            words.append(entities.unescape(chunk) if "&" in chunk else chunk)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in INLINE:
                continue
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] == tag:
                    close(place)
                    break
            else:
                flush()
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(text, at)
            at = over.end() if over else end
            continue
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr", "img"):
                words.append(" ")
            continue
        # Elements that this one ends, though nothing says so.
        for place in range(len(stack) - 1, 0, -1):
            name = stack[place][0]
            if name in ENDED_BY:
                by = ENDED_BY[name]
                if by is None or tag in by:
                    close(place)
                    continue
            elif name in ("ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "html"):
                break
        flush()
        parent = stack[-1][1]
        names, tokens, role = _named(m[3] or m[6] or "")
        inside = parent.main
        if tag in NEVER_BY_NAME or m.start() in spared:
            tokens = set()
        elif inside:
            tokens -= DOUBTFUL_NAMES
        otherwise = (
            opened[-1][1] or tag in NOT_CONTENT or role in NOT_CONTENT_ROLES or (not inside and tag == "header")
            or bool(tokens & REMARK_NAMES))
        by_name = parent.boiler or tokens & NOT_CONTENT_NAMES or (not inside and tokens & HEADER_NAMES)
        boiler = BY_ELEMENT if otherwise else BY_NAME if by_name else 0
        opened.append((m.start(), otherwise))
        if tag in MAIN or role == "main":
            seen = seen or not boiler
            if boiler and not otherwise:
                named.append({place for place, _ in opened})
        if len(stack) >= DEPTH:
            # Still an element of its own for closing; its text belongs to the node above.
            stack.append((tag, parent if boiler == parent.boiler else Node(tag, boiler, inside)))
            continue
        main = inside or tag in MAIN or role == "main"
        label = f"{tag}.{names}" if names else tag
        node = Node(label, boiler, main)
        parent.kids.append(node)
        stack.append((tag, node))
    flush()
    return root, blocks, seen, named


# A wrapper node is [label, pages, mark of its text, whether that varies, characters, children].
def wrapper_of(node: Node) -> list:
    text = "\n".join(node.texts)
    return [_label(node), 1, zlib.crc32(text.encode("utf-8", "surrogatepass")), False, len(text),
            [wrapper_of(k) for k in node.kids if k.boiler != BY_ELEMENT]]


def _label(node: Node) -> str:
    return NAMED + node.label if node.boiler else node.label


def _weight(one: list, two: list) -> int:
    """Simple tree matching: the most nodes that two trees with the same root can share in order."""
    if one[0] != two[0]:
        return 0
    return 1 + _table(one[-1], two[-1])[-1][-1]


def _table(ones: list, twos: list) -> list[list[int]]:
    table = [[0] * (len(twos) + 1) for _ in range(len(ones) + 1)]
    for i, one in enumerate(ones):
        for j, two in enumerate(twos):
            gain = _weight(one, two) if one[0] == two[0] else 0
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + gain)
    return table


def align(ones: list, twos: list) -> list[tuple[int | None, int | None]]:
    """Children matched in order, and those without a partner, in an order that fits both."""
    if [o[0] for o in ones] == [t[0] for t in twos]:
        return [(i, i) for i in range(len(ones))]
    table = _table(ones, twos)
    i, j, pairs = len(ones), len(twos), []
    while i or j:
        if j and table[i][j] == table[i][j - 1]:
            j -= 1
            pairs.append((None, j))
        elif i and table[i][j] == table[i - 1][j]:
            i -= 1
            pairs.append((i, None))
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def merge(one: list, two: list) -> list:
    """Both wrappers as one; their roots have the same label."""
    kids = []
    for i, j in align(one[-1], two[-1]):
        kids.append(two[-1][j] if i is None else one[-1][i] if j is None else merge(one[-1][i], two[-1][j]))
    return [one[0], one[1] + two[1], one[2], one[3] or two[3] or one[2] != two[2], one[4] + two[4], kids]


def _nodes(wrapper: list) -> int:
    return 1 + sum(map(_nodes, wrapper[-1]))


def trimmed(wrapper: list) -> list:
    """Without the nodes of fewest pages while there are more than ``MAX_NODES``."""
    least = 1
    while _nodes(wrapper) > MAX_NODES:
        least *= 2
        wrapper = _without(wrapper, least)
    return wrapper


def _without(wrapper: list, least: int) -> list:
    """Nodes of fewer pages are cut; their characters stay, as varying text, in a child ``CUT``."""
    kids, lost = [], {CUT: 0, NAMED + CUT: 0}
    for k in wrapper[-1]:
        if k[0] not in lost and k[1] >= least:
            kids.append(_without(k, least))
        else:
            lost[NAMED + CUT if k[0].startswith(NAMED) else CUT] += _characters(k)
    return [*wrapper[:-1], kids + [[label, 0, 0, True, n, []] for label, n in lost.items() if n]]


def _characters(wrapper: list) -> int:
    return wrapper[4] + sum(map(_characters, wrapper[-1]))


def _varying(node: list, named: bool, sums: dict[int, int]) -> int:
    """Characters of ``node`` and below that vary, by ``id`` in ``sums``; ``named``: of named nodes too."""
    own = node[4] if (node[3] or node[1] < 2) and (named or not node[0].startswith(NAMED)) else 0
    sums[id(node)] = own + sum(_varying(k, named, sums) for k in node[-1])
    return sums[id(node)]


def _centre(wrapper: list, sums: dict[int, int]) -> list:
    """The innermost node, other than a leaf, that holds most of what varies."""
    centre = wrapper
    while sums[id(wrapper)]:
        inner = next((k for k in centre[-1] if sums[id(k)] >= MAIN_SHARE * sums[id(wrapper)]), None)
        if inner is None or not inner[-1]:
            break
        centre = inner
    return centre


def compile_wrapper(wrapper: list) -> list:
    """The wrapper as [label, flags, children]: 1 for constant text, 2 for the part of the content,
    4 where that part is content in spite of its name.
    """
    sums: dict[int, int] = {}
    _varying(wrapper, True, sums)
    centre = _centre(wrapper, sums)
    lifted = wrapper[1] > 1 and centre[0].startswith(NAMED)
    if not lifted:
        _varying(wrapper, False, sums)
        centre = _centre(wrapper, sums)
    enough = max(2, TEMPLATE_SHARE * wrapper[1])

    def agreed(node) -> bool:
        return node[1] >= enough and not node[3] and node[4] > 0

    def template(node) -> int:
        own = node[4] if agreed(node) and (lifted or not node[0].startswith(NAMED)) else 0
        return own + sum(map(template, node[-1]))

    def trusted(scope) -> bool:
        """Where template outweighs what varies, the pages may be near copies of each other."""
        return template(scope) <= sums[id(scope)]

    everywhere, within = trusted(wrapper), trusted(centre)

    def flagged(node, inside: bool) -> list:
        inside = inside or node is centre
        constant = agreed(node) and (within if inside else everywhere)
        return [node[0], constant + (2 + 4 * lifted) * inside,
                [flagged(k, inside) for k in node[-1] if k[0].removeprefix(NAMED) != CUT]]

    return flagged(wrapper, False)


def chosen(root: Node, rules: list | None) -> set[int]:
    """The nodes (by ``id``) of a page whose text is content."""
    nodes: dict[int, tuple[Node, int]] = {}

    def walk(node: Node, rule: list | None, flags: int):
        flags = rule[1] if rule is not None else flags & 6
        nodes[id(node)] = node, flags
        kids = [k for k in node.kids if k.boiler != BY_ELEMENT]
        if rule is None:
            for k in kids:
                walk(k, None, flags)
            return
        shapes = [_shape(k) for k in kids]
        for i, j in align(rule[-1], shapes):
            if j is not None:
                walk(kids[j], None if i is None else rule[-1][i], flags)

    walk(root, rules, 2)
    marked = any(n.main and not n.boiler for n, _ in nodes.values())
    return {
        key for key, (n, flags) in nodes.items()
        if not flags & 1 and (n.main and not n.boiler if marked else flags & (4 if n.boiler else 2))}


def _shape(node: Node) -> list:
    return [_label(node), 0, [_shape(k) for k in node.kids if k.boiler != BY_ELEMENT]]


def extract(text: str, rules: list | None) -> str:
    """The content of a page, a block to a line."""
    root, blocks = parse(text)
    if not blocks:
        return ""
    content = chosen(root, rules)
    return "\n".join(block for node, block in blocks if id(node) in content)


HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host``; a page without a readable host has none."""
    host = F.lower(F.regexp_extract("url", HOST, 1))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        F.when(host != "", host).alias("host"))


def induce(hosted: DataFrame) -> DataFrame:
    """``host, rules`` from all distinct pages of each host.

    Every task merges the pages it reads into one wrapper per host; those are merged by the
    dozens, level after level, so that no group holds more than ``MERGED_AT_ONCE`` wrappers.
    """
    def partial(batches):
        held: dict[str, list] = {}
        shapes: dict[str, dict[str, bool]] = {}

        def out():
            names = list(held)
            rows = [json.dumps(trimmed(held[n])) for n in names]
            held.clear()
            return pa.RecordBatch.from_pydict({"host": pa.array(names, pa.string()), "wrapper": pa.array(rows, pa.string())})

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for host, text in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = wrapper_of(parse(text)[0])
                    old = held.get(host)
                    held[host] = page if old is None else merge(old, page)
                    if old is not None and old[1] % 512 == 0:
                        held[host] = trimmed(held[host])
            if len(held) > HOSTS_HELD:
                yield out()
        if held:
            yield out()

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        wrappers = sorted(group["wrapper"])
        whole = json.loads(wrappers[0])
        for more in wrappers[1:]:
            whole = merge(whole, json.loads(more))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "part": [group["up"].iloc[0]],
                             "wrapper": [json.dumps(trimmed(whole))]})

    def ruled(batches):
        for batch in batches:
            rules = [json.dumps(compile_wrapper(json.loads(w))) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(rules, pa.string())], ["host", "rules"])

    parts = kept(
        hosted.where("host IS NOT NULL").select("host", "html", F.md5(F.col("html").cast("binary")).alias("digest"))
        .dropDuplicates(["host", "digest"]).select("host", "html").mapInArrow(partial, "host string, wrapper string")
        .withColumn("part", F.monotonically_increasing_id()), "wrappers")
    # Number the parts of each host from 0, so that neighbours can be merged.
    from pyspark.sql import Window

    numbered = parts.withColumn("part", F.row_number().over(Window.partitionBy("host").orderBy("part")).cast("bigint") - 1)
    most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        groups = numbered.withColumn("up", F.expr(f"part div {MERGED_AT_ONCE}")).groupBy("host", "up")
        numbered = kept(groups.applyInPandas(merged, "host string, part bigint, wrapper string"), "wrappers")
        most = -(-most // MERGED_AT_ONCE)
    return numbered.select("host", "wrapper").mapInArrow(ruled, "host string, rules string")


def extract_pages(pages: DataFrame, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    Null and empty pages have an empty text. Pages without a host are judged by their own elements
    alone. Null or repeated ids and urls are extracted each on its own; other columns are not read.
    White space is what Unicode calls so, the no-break space included. ``br`` is white space. A very
    long page is read whole, by one task; no rows give no rows.
    """
    hosted = with_host(pages)
    rules = kept(induce(hosted), "wrapper-rules")
    size = rules.agg(F.sum(F.length("rules") + F.length("host"))).first()[0] or 0
    joined = hosted.join(F.broadcast(rules) if size <= broadcast_bytes else rules, "host", "left")

    def extracted(batches):
        known: dict[str | None, list | None] = {None: None}
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = []
                for text, rule in zip(part.column("html").to_pylist(), part.column("rules").to_pylist(), strict=True):
                    if rule not in known:
                        if len(known) > HOSTS_HELD:
                            known = {None: None}
                        known[rule] = json.loads(rule)
                    texts.append(extract(text, known[rule]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "rules").mapInArrow(
        extracted, "page_id bigint, url string, text string, n_chars bigint")
