"""Main text of web pages by wrapper induction.

Pages of one host are aligned with each other: each page becomes a small skeleton of its DOM tree (signature of every
node and a hash of its own text), and within blocks of a host's pages simple tree matching aligns every skeleton with
the wrapper tree grown so far. A node whose text is the same on most of a host's pages is template, a node whose text
varies is content. Votes are summed over the host's blocks, so hosts of any size are split over many tasks.

What the tags themselves say is used as well: navigation, footers, asides, forms, scripts, reader comments, adverts and
the like never are content, and a page with an explicit article (or main) element is read, and aligned, from there on.
Inside an article, too, a node is template if its own text stands at the same path in at least half of the host's
distinct articles, and in at least half of those that vote: articles that have at least a third of their text (by length) for
themselves. Edited copies of one article share more than that, so they don't vote, and what only they share stays.
There, text with inline markup is judged as a whole: a constant word or link within a varying sentence is content. A
constant heading stays while varying text follows before the next heading of its level; a constant label (dt, th, td,
caption and the like, or a block that is all bold) stays while the next block varies.

Defined results: a null or empty html has the empty text; a null page_id or url is carried (pages without a host share
one); repeated rows are extracted one by one, and only count once each in the votes' share; extra columns are ignored;
an empty table gives an empty result. Line breaks inside a block are white space. Broken markup (unclosed or crossed
tags, cut-off comments) is read the way browsers do, as far as it matters for text.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common
from .language_fusion import host_of

BLOCK_PAGES = 64
TEMPLATE_SHARE = 0.5
TEMPLATE_PAGES = 3
OWN_SHARE = 1 / 3  # of an article's text, for it to vote

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea select object title head".split())
RAW_TEXT = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"},
         "option": {"select"}}
NEVER = frozenset("nav footer aside form button dialog menu script style noscript template iframe svg math textarea select "
                  "object title head".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar form alert".split())
NEVER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                        "consent gdpr popup modal overlay notice notices sidebar sidenav aside menu nav navbar navigation breadcrumb breadcrumbs "
                        "share sharing social related recommended comment comments reply replies disqus respond subscribe "
                        "newsletter signup login footer pagination pager toolbar skip widget outbrain taboola hidden".split())
MAIN_WORDS = frozenset("article content main post entry story body text page wrapper container".split())
COMMENT_WORDS = frozenset("comment comments reply respond ad sponsored promo related".split())
HEADINGS = {f"h{i}": i for i in range(1, 7)}
LABELS = frozenset("dt th td caption legend summary figcaption".split())
BOLD = frozenset("b strong".split())
STATE_WORDS = frozenset("no has with without free enabled disabled".split())  # a name with one tells what the page has

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "sign", "items", "never", "main", "named")

    def __init__(self, tag: str, sign: int = 0, never: bool = False, main: bool = False, named: bool = False):
        self.tag, self.sign, self.never, self.main = tag, sign, never, main
        self.named = named  # never content by its names alone
        self.items: list = []  # child nodes and strings, in page order


def _named(found: dict, words: frozenset) -> bool:
    """Whether class or id holds one of the words: in a name of only such words, or in another one of an element that no
    name calls a main part."""
    names = [{w.lower() for w in NAME_PART.findall(x)} for k in ("class", "id") for x in found.get(k, "").split()]
    hits = [x for x in names if x & words and not x & STATE_WORDS]
    return any(x <= words for x in hits) or bool(hits) and not any(x and x <= MAIN_WORDS for x in names)


def _kind(tag: str, attributes: str, inside_main: bool) -> tuple[int, bool, bool, bool]:
    """Signature (tag and class), whether the element never is content, whether it is an explicit main part, and whether
    only its names say the former."""
    if not attributes or attributes.isspace():
        return zlib.crc32(tag.encode()), tag in NEVER or tag == "header" and not inside_main, tag in ("article", "main"), False
    found = {}
    for name, value in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), value.strip("\"'") if value else "")
    role = found.get("role", "").lower()
    never = tag in NEVER or tag == "header" and not inside_main or role in NEVER_ROLES or "hidden" in found \
        or found.get("aria-hidden", "").lower() == "true" or SPACES.sub("", found.get("style", "").lower()).startswith("display:none")
    main = tag in ("article", "main") or role in ("main", "article") or "articlebody" in found.get("itemprop", "").lower()
    named = False
    if not never and tag not in ("html", "body"):
        if main and tag == "article":  # reader comments are often articles of their own
            never = _named(found, COMMENT_WORDS)
        else:
            never = named = not main and _named(found, NEVER_WORDS)
    sign = zlib.crc32(f"{tag}.{' '.join(sorted(found.get('class', '').split()))}".encode())
    return sign, never, main, named


def parse(page: str) -> Node:
    root = Node("#root")
    stack, depth_main = [root], 0
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        closing, tag, attributes = m[1], m[2], m[3]
        if tag is None:
            closing, tag, attributes = m[4], m[5], m[6]
        if tag is None:
            text = m[0]
            if text.startswith("<![CDATA["):
                continue
            if text[0] != "<" or text == "<":
                stack[-1].items.append(text)
            continue
        tag = tag.lower()
        if closing:
            inline = tag in INLINE
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    depth_main -= sum(x.main for x in stack[i:])
                    del stack[i:]
                    break
                if inline and stack[i].tag not in INLINE:
                    break  # a crossed inline tag closes no block
            continue
        if tag in CLOSES_P or tag in SIBLINGS:
            ends = SIBLINGS.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                name = stack[i].tag
                if name == "p" and tag in CLOSES_P or name in ends:
                    depth_main -= sum(x.main for x in stack[i:])
                    del stack[i:]
                    if name == "p":
                        break
                elif name in SCOPE.get(tag, ()) or name not in INLINE and name not in ends and name != "p":
                    break
        node = Node(tag, *_kind(tag, attributes or "", depth_main > 0))
        stack[-1].items.append(node)
        if tag in VOID or (attributes or "").rstrip().endswith("/") and tag in RAW | {"path", "g", "circle", "rect"}:
            continue
        if tag in RAW_TEXT:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            node.items.append(page[at:end.start() if end else n])
            at = end.end() if end else n
            continue
        stack.append(node)
        depth_main += node.main
    return root


def _own_text(node: Node) -> str:
    return SPACES.sub(" ", html_lib.unescape(" ".join(x for x in node.items if isinstance(x, str)))).strip()


# --- skeletons and simple tree matching ------------------------------------------------------------------------------

def skeleton(root: Node) -> bytes:
    """Pre-order rows (depth, signature, hash and length of own text) of the nodes that may be content; the first one stands
    for the page and says whether it has an article."""
    explicit, tops = _tops(root)
    rows = [(0, int(explicit), 0, 0)]

    def walk(node: Node, depth: int) -> None:
        text = _own_text(node)
        rows.append((depth, node.sign, zlib.crc32(text.encode("utf-8", "surrogatepass")) if text else 0, len(text)))
        for x in node.items:
            if isinstance(x, Node) and not x.never and x.tag not in RAW and x.tag not in VOID:
                walk_stack.append((x, depth + 1))

    walk_stack = [(x, 1) for x in reversed(tops)]
    while walk_stack:  # children are pushed last to first, so rows come out in page order
        before = len(walk_stack) - 1
        node, depth = walk_stack.pop()
        walk(node, depth)
        walk_stack[before:] = walk_stack[before:][::-1]
    return np.array(rows, dtype="<u4").tobytes()


class Slot:
    """A node of the wrapper: its signature, its children, and on which pages (bits) each own text stood there."""
    __slots__ = ("sign", "children", "texts", "shape")

    def __init__(self, sign: int):
        self.sign, self.children, self.texts, self.shape = sign, [], {}, -1


def tree(data: bytes, page: int = 0) -> Slot:
    rows = np.frombuffer(data, "<u4").reshape(-1, 4).tolist()
    path: list[Slot] = []
    for depth, sign, text, _ in rows:
        slot = Slot(sign)
        if text:
            slot.texts[text] = 1 << page
        del path[depth:]
        if path:
            path[-1].children.append(slot)
        path.append(slot)
    return path[0]


class Shapes:
    """Simple tree matching (the most nodes two trees share in order, root to root) over shapes: numbers of equal trees of
    signatures. A pair of shapes is matched once, on an explicit stack, so trees may be deep."""

    def __init__(self):
        self.known: dict = {}
        self.sign, self.kids, self.nodes, self.sizes = [], [], [], {}

    def put(self, root: Slot) -> None:
        """Give every slot of the tree its shape."""
        order = [root]
        for slot in order:
            order += slot.children
        for slot in reversed(order):
            key = slot.sign, tuple(x.shape for x in slot.children)
            if key not in self.known:
                self.known[key] = len(self.sign)
                self.sign.append(slot.sign)
                self.kids.append(key[1])
                self.nodes.append(1 + sum(self.nodes[x] for x in key[1]))
            slot.shape = self.known[key]

    def _size(self, x: int, y: int) -> int | None:
        if self.sign[x] != self.sign[y]:
            return 0
        if x == y:
            return self.nodes[x]
        return self.sizes.get((x, y)) if self.kids[x] and self.kids[y] else 1

    def _ends(self, x: int, y: int) -> tuple[int, int, int]:
        """How many children are equal from the left, and where those equal from the right begin; equal trees at either
        end are matched as they stand (an optimal choice)."""
        left, right, lo = self.kids[x], self.kids[y], 0
        while lo < min(len(left), len(right)) and left[lo] == right[lo]:
            lo += 1
        i, j = len(left), len(right)
        while i > lo and j > lo and left[i - 1] == right[j - 1]:
            i, j = i - 1, j - 1
        return lo, i, j

    def match(self, x: int, y: int) -> int:
        todo = [(x, y)]
        while todo:
            x, y = todo[-1]
            if self._size(x, y) is not None:
                todo.pop()
                continue
            lo, i, j = self._ends(x, y)
            rows, columns = self.kids[x][lo:i], self.kids[y][lo:j]
            others = set(columns)
            missing = [(r, c) for r in set(rows) for c in others if self._size(r, c) is None]
            if missing:
                todo += missing
                continue
            ends = sum(self.nodes[k] for k in self.kids[x][:lo] + self.kids[x][i:])
            self.sizes[x, y] = 1 + ends + int(self._scores(rows, columns)[-1])
            todo.pop()
        return self._size(x, y)

    def _weights(self, rows, columns) -> dict[int, np.ndarray]:
        names, at = np.unique(np.array(columns, dtype=np.int64), return_inverse=True)
        names = names.tolist()
        return {x: np.array([self.match(x, y) for y in names], dtype=np.int64)[at] for x in set(rows)}

    def _scores(self, rows, columns) -> np.ndarray:
        """The best weight of all rows against the first n columns, for every n; memory for one line."""
        line = np.zeros(len(columns) + 1, dtype=np.int64)
        weight = self._weights(rows, columns) if rows and columns else {}
        for x in rows if columns else ():
            line[1:] = np.maximum(line[1:], np.where(weight[x] > 0, line[:-1] + weight[x], 0))
            np.maximum.accumulate(line, out=line)
        return line

    def align(self, x: int, y: int) -> list[tuple[int, int]]:
        """Positions of the matched children of two trees with equal roots. Long lists are halved where the best
        alignment passes, so memory is bounded and the alignment exact for every length."""
        lo, i, j = self._ends(x, y)
        left, right = self.kids[x], self.kids[y]
        pairs = [(k, k) for k in range(lo)] + [(i + k, j + k) for k in range(len(left) - i)]
        todo = [(lo, i, lo, j)]
        while todo:
            r0, r1, c0, c1 = todo.pop()
            if r0 == r1 or c0 == c1:
                continue
            rows, columns = left[r0:r1], right[c0:c1]
            if len(rows) == 1:
                weight = self._weights(rows, columns)[rows[0]]
                c = int(weight.argmax())
                if weight[c]:
                    pairs.append((r0, c0 + c))
                continue
            middle = len(rows) // 2
            cut = int((self._scores(rows[:middle], columns) + self._scores(rows[middle:][::-1], columns[::-1])[::-1]).argmax())
            todo += [(r0, r0 + middle, c0, c0 + cut), (r0 + middle, r1, c0 + cut, c1)]
        return sorted(pairs)


def grow(wrapper: Slot, page: Slot, shapes: Shapes) -> None:
    """Align a page with the wrapper: aligned nodes add their texts, new ones join at their place."""
    shapes.put(wrapper)
    shapes.put(page)
    todo = [(wrapper, page)]
    while todo:
        a, b = todo.pop()
        for text, which in b.texts.items():
            a.texts[text] = a.texts.get(text, 0) | which
        partner = {id(b.children[j]): a.children[i] for i, j in (shapes.align(a.shape, b.shape) if a.sign == b.sign else ())}
        if not partner:
            a.children = a.children + b.children
            continue
        place, merged = {id(x): i for i, x in enumerate(a.children)}, []
        done = 0
        for child in b.children:
            old = partner.get(id(child))
            if old is None:
                merged.append(child)
                continue
            merged += a.children[done:place[id(old)] + 1]
            done = place[id(old)] + 1
            todo.append((old, child))
        a.children = merged + a.children[done:]


def path_key(parent: int, sign: int) -> int:
    return (parent * 0x9E3779B97F4A7C15 + sign + 1) & 0x7FFFFFFFFFFFFFFF


def votes(pages: list[bytes]) -> dict[int, int]:
    """For one block of distinct pages: how many share a text at an aligned node, by (path, text); at least two do."""
    wrapper, shapes = tree(pages[0]), Shapes()
    for number, data in enumerate(pages[1:], 1):
        grow(wrapper, tree(data, number), shapes)
    found: dict[int, int] = {}  # pages of all slots of the same path and text
    todo = [(wrapper, 0)]
    while todo:
        slot, parent = todo.pop()
        path = path_key(parent, slot.sign)
        for text, which in slot.texts.items():
            key = path_key(path, text)
            found[key] = found.get(key, 0) | which
        todo += [(c, path) for c in slot.children]
    return {key: which.bit_count() for key, which in found.items() if which.bit_count() > 1 or len(pages) == 1}


def own_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(path, text) key and text length of every node of a skeleton that has own text."""
    rows = np.frombuffer(data, "<u4").reshape(-1, 4).tolist()
    path, keys, lengths = [], [], []
    for depth, sign, text, length in rows:
        del path[depth:]
        path.append(path_key(path[-1] if path else 0, sign))
        if text:
            keys.append(path_key(path[-1], text))
            lengths.append(length)
    return np.array(keys, dtype=np.int64), np.array(lengths, dtype=np.int64)


# --- extraction ------------------------------------------------------------------------------------------------------

def main_text(page: str, template: frozenset | set = frozenset()) -> str:
    """Blocks of the page's content, one per line. ``template``: keys of the host's constant nodes."""
    explicit, tops = _tops(parse(page))
    blocks: list[tuple[str, bool, str]] = []  # text, whether it varies, and the heading or label that it is
    held: list[str] = []
    opened = [""]  # block elements around
    varies = plain = False  # whether what is held has text that is not template; text that is not bold

    def close() -> None:
        nonlocal varies, plain
        text = SPACES.sub(" ", html_lib.unescape("".join(held))).strip()
        if text:
            tag = opened[-1]
            blocks.append((text, varies, tag if tag in HEADINGS or tag in LABELS else "" if plain else "b"))
        held.clear()
        varies = plain = False

    for top in tops:
        # (node, path, whether within bold text) to open, (string, whether it is template, bold), or None to end a block
        stack: list = [(top, path_key(0, int(explicit)), False)]
        while stack:
            item = stack.pop()
            if item is None:
                close()
                opened.pop()
            elif isinstance(item[0], str):
                held.append(item[0])
                if not (varies and plain or item[1] and item[2]) and html_lib.unescape(item[0]).strip():
                    varies, plain = varies or not item[1], plain or not item[2]
            else:
                node, parent, bold = item
                if node.never or node.tag in RAW:
                    continue
                if node.tag == "br":
                    held.append("\n")
                    continue
                path = path_key(parent, node.sign)
                block = node.tag not in INLINE
                bold = not block and (bold or node.tag in BOLD)
                if block:
                    close()
                    opened.append(node.tag)
                    stack.append(None)
                constant = False
                if template:
                    text = _own_text(node)
                    constant = bool(text) and path_key(path, zlib.crc32(text.encode("utf-8", "surrogatepass"))) in template
                stack += [(x, constant if isinstance(x, str) else path, bold) for x in reversed(node.items)
                          if explicit or not (constant and isinstance(x, str))]
        close()
        blocks.append(("", False, "h1"))  # nothing leads over the end of a part
    return "\n".join(_kept(blocks))


def _kept(blocks: list[tuple[str, bool, str]]) -> list[str]:
    """Texts of the blocks that vary, and of the constant headings and labels that lead to one."""
    kept: list[str] = []
    below = 0  # the sections that hold a kept block so far, seen from the end: bit n for a heading of level n
    after = False  # whether the next block is kept
    for text, keep, lead in reversed(blocks):
        level = HEADINGS.get(lead, 0)
        keep = keep or (bool(below >> level & 1) if level else bool(lead) and after)
        if keep and text:
            kept.append(text)
        if level:  # the section ends here for every heading of this level or a lower one
            below = (below if not text else below | 0x7E if keep else below) & ((1 << level) - 1)
        elif keep:
            below = 0x7E
        after = keep and bool(text)
    return kept[::-1]


def _tops(root: Node) -> tuple[bool, list[Node]]:
    """Whether the page has an explicit main part with text, and the nodes to read: these parts, or the whole page."""
    mains = _mains(root)
    if not any(_has_text(m) for m in mains):  # names don't hide the page's only article
        opened = []
        for m, above in _mains_within_named(root):
            if _has_text(m):
                opened += above
        for node in opened:
            node.never = False
        mains = _mains(root) if opened else mains
    inner = [a for m in mains if m.tag != "article" for a in _articles(m)]
    if inner:  # a main element around articles: the articles
        mains = [a for m in mains for a in ([m] if m.tag == "article" else _articles(m) or [m])]
    explicit = any(_has_text(m) for m in mains)
    return explicit, mains if explicit else [root]


def _mains(root: Node) -> list[Node]:
    mains, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.never:
            continue
        if node.main:
            mains.append(node)
            continue
        todo += [x for x in reversed(node.items) if isinstance(x, Node)]
    return mains


def _mains_within_named(root: Node):
    """Main parts inside elements that only their names hide, with these elements; also those inside other main parts."""
    todo: list = [(root, ())]
    while todo:
        node, above = todo.pop()
        if node.never and not node.named:
            continue
        if node.named:
            above = (*above, node)
        if node.main and above:
            yield node, above
            continue
        todo += [(x, above) for x in reversed(node.items) if isinstance(x, Node)]


def _articles(node: Node) -> list[Node]:
    found, todo = [], [node]
    while todo:
        x = todo.pop()
        if x.never:
            continue
        if x.tag == "article":
            found.append(x)
            continue
        todo += [y for y in reversed(x.items) if isinstance(y, Node)]
    return found


def _has_text(node: Node) -> bool:
    todo = [node]
    while todo:
        x = todo.pop()
        if x.never or x.tag in RAW:
            continue
        for y in x.items:
            if isinstance(y, Node):
                todo.append(y)
            elif not y.isspace():
                return True
    return False


def _skeletons(batches):
    for pdf in batches:
        found = [skeleton(parse(h)) for h in pdf["html"]]
        yield pd.DataFrame({"host": pdf["host"], "article": [x[4] == 1 for x in found], "skeleton": found})


def _block_votes(pdf: pd.DataFrame) -> pd.DataFrame:
    found = votes(sorted(set(pdf["skeleton"])))
    return pd.DataFrame({"host": pdf["host"].iloc[0], "article": pdf["article"].iloc[0], "node": pd.Series(list(found), dtype="int64"),
                         "n": pd.Series(list(found.values()), dtype="int64")})


def _own_votes(batches):
    """Of every article with enough text of its own: a row without a node, and one per shared node it holds."""
    for pdf in batches:
        hosts, nodes = [], []
        for host, data, shared in zip(pdf["host"], pdf["skeleton"], pdf["shared"], strict=True):
            keys, lengths = own_keys(data)
            common_text = np.isin(keys, np.asarray(shared, dtype=np.int64))
            if lengths[~common_text].sum() >= OWN_SHARE * lengths.sum():
                found = [None, *np.unique(keys[common_text]).tolist()]
                hosts += [host] * len(found)
                nodes += found
        yield pd.DataFrame({"host": pd.Series(hosts, dtype=object), "node": pd.Series(nodes, dtype="Int64")})


def induce(pages: DataFrame, path: str) -> DataFrame:
    """host and template: keys of the nodes whose text is constant over the host's distinct articles, or its distinct
    pages without one."""
    spark = pages.sparkSession
    slim = pages.select("host", "html").mapInPandas(_skeletons, "host string, article boolean, skeleton binary").withColumn("copy", F.xxhash64("skeleton"))
    # equal skeletons (copies of an article, whatever stands around it, or of a page) say nothing about what is template; of each, one is enough
    slim.dropDuplicates(["host", "copy"]).write.mode("errorifexists").parquet(f"{path}/skeletons")
    slim = spark.read.parquet(f"{path}/skeletons")
    slim.groupBy("host", "article").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") > 1).write.mode("errorifexists").parquet(f"{path}/hosts")
    hosts = spark.read.parquet(f"{path}/hosts")
    blocks = F.ceil(F.col("pages") / BLOCK_PAGES)
    dealt = slim.join(hosts, ["host", "article"]).withColumn("block", F.pmod("copy", blocks).cast("int"))
    voted = dealt.groupBy("host", "article", "block").applyInPandas(_block_votes, "host string, article boolean, node long, n long")
    shared = voted.groupBy("host", "article", "node").agg(F.sum("n").alias("n")).join(hosts, ["host", "article"])
    constant = shared.where((F.col("n") >= TEMPLATE_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("pages")))
    # at most the nodes of a page times 1 / TEMPLATE_SHARE per host
    constant.groupBy("host", "article").agg(F.collect_list("node").alias("shared")).write.mode("errorifexists").parquet(f"{path}/shared")
    shared = spark.read.parquet(f"{path}/shared")
    # the voting articles' own count of these nodes
    voters = slim.where("article").join(shared.where("article"), ["host", "article"]).select("host", "skeleton", "shared")
    voters.mapInPandas(_own_votes, "host string, node long").groupBy("host", "node").agg(F.count(F.lit(1)).alias("n")) \
        .write.mode("errorifexists").parquet(f"{path}/voters")
    counts = spark.read.parquet(f"{path}/voters")
    voting = counts.where("node IS NULL").select("host", F.col("n").alias("voters"))
    agreed = counts.where("node IS NOT NULL").join(voting, "host").where((F.col("n") >= TEMPLATE_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("voters")))
    nodes = agreed.select("host", "node").unionByName(shared.where(~F.col("article")).select("host", F.explode("shared").alias("node")))
    nodes.groupBy("host").agg(F.collect_list("node").alias("template")).write.mode("errorifexists").parquet(f"{path}/templates")
    return spark.read.parquet(f"{path}/templates")


def extract(pages: DataFrame, path: str | None = None) -> DataFrame:
    """page_id, url, text per row."""
    path = path or scratch_path(pages.sparkSession, "wrappers")
    held = pages.select("page_id", "url", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    templates = induce(held, path)

    def texts(batches):
        for pdf in batches:
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": [
                main_text(h, frozenset() if t is None else frozenset(t)) for h, t in zip(pdf["html"], pdf["template"], strict=True)]})

    joined = held.join(templates, "host", "left").select("page_id", "url", "html", "template")
    return joined.mapInPandas(texts, "page_id long, url string, text string")


def op10_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
