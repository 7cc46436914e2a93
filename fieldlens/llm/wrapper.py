"""Main text of web pages by wrapper induction.

Of every host a bounded number of pages with different content, the smallest by a hash, are aligned as DOM trees by simple tree matching. Nodes
whose text is the same in all of them are the host's template; the others are slots. Every page is aligned with its host's wrapper; what falls
on template nodes with the template's text goes. So does a text that is under the same path of keys on ``LEAST`` or more different pages and
on ``CONSTANT`` of the host's, or of those of its kind, counted over all pages. Pages of a kind have the same parts of the body. So do elements that by their kind or name are never content (navigation, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments). Where a page marks an article or main part, only that part counts.

A host with fewer than ``LEAST`` different pages has no template; the rules on kinds and names work alone. If everything in a page would be
template, it is a copy, not a template, and stays. A null html or url is an empty one, pages of an empty url share a host. Repeated rows
are extracted each. An empty table gives no rows. Other columns are not read. White space is what Unicode calls so.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import pieces, saved, sized

SEEDS = 4
LEAST = 3
#: Share of the different pages on which a text is template.
CONSTANT = 0.75
#: Bytes of all wrappers up to which they are broadcast; beyond it they are joined by a shuffle.
BROADCAST = 32 << 20

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
NAME = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEVER = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "audio", "video", "canvas", "object", "label", "input"}
BLOCK = set("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
            "html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: Parts of class, id and role names that mark what is not content.
MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|adv|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|sidebar|side|menu|nav|navbar|navigation|"
                   r"breadcrumbs?|footer|header|masthead|share|sharing|social|comments?|disqus|replies|respond|related|recommended|newsletter|subscribe|"
                   r"signup|login|search|popup|modal|overlay|toolbar|pagination|pager|widget|skip)(?:$|[\s_-])", re.I)


class Node:
    __slots__ = ("key", "kids", "texts", "never", "main", "shape", "template")

    def __init__(self, key: str, never: bool, main: bool):
        self.key, self.never, self.main = key, never, main
        self.kids: list[Node] = []
        self.texts: list[tuple[int, str]] = []  # text before the kid of that number
        self.shape, self.template = 0, None


_SHAPES: dict[tuple, int] = {}
_SCORES: dict[tuple[int, int], int] = {}


def _closes(tag: str, opened: str) -> bool:
    """Whether a start tag ends an open element of a kind whose end tag may be left out."""
    if opened == "p":
        return tag in BLOCK
    return (opened == tag == "li" or opened in ("dd", "dt") and tag in ("dd", "dt") or opened in ("td", "th") and tag in ("td", "th", "tr")
            or opened == tag == "tr" or opened == tag == "option")


def parse(html: str) -> Node:
    """The DOM tree as far as content needs it; broken markup is read as browsers mostly do."""
    root, low = Node("root", False, False), None
    stack, tags, at = [root], ["root"], 0
    while True:
        m = TOKEN.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text and not text.isspace():
            stack[-1].texts.append((len(stack[-1].kids), text))
        elif text and stack[-1].texts:
            stack[-1].texts.append((len(stack[-1].kids), " "))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in tags:
                while tags.pop() != tag:
                    stack.pop()
                stack.pop()
                if not stack:
                    stack, tags = [root], ["root"]
            continue
        k = len(tags) - 1
        while k > 0 and tags[k] not in ("ul", "ol", "table", "div", "article", "section", "body", "main", "td", "dl"):
            if _closes(tag, tags[k]):
                del tags[k:], stack[k:]
                break
            k -= 1
        else:
            if k > 0 and _closes(tag, tags[k]):
                del tags[k:], stack[k:]
        named = " ".join(x or y or z for x, y, z in NAME.findall(m[3] or m[6] or ""))
        node = Node(f"{tag} {named.lower()}" if named else tag, tag in NEVER or bool(named and MARKS.search(named)), tag in ("article", "main") or "main" == named)
        stack[-1].kids.append(node)
        if tag in RAW:
            low = low or html.lower()
            end = low.find(f"</{tag}", at)
            at = len(html) if end < 0 else html.find(">", end) + 1 or len(html)
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/"):
            stack.append(node)
            tags.append(tag)
    _shape(root)
    return root


def _shape(root: Node) -> None:
    """Numbers equal for trees of equal structure. The walk keeps its own stack, as trees may be deep."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.kids
    for node in reversed(order):
        node.shape = _SHAPES.setdefault((node.key, tuple(k.shape for k in node.kids)), len(_SHAPES) + 1)


def own_text(node: Node) -> str:
    return " ".join(" ".join(unescape(t) for _, t in node.texts).split())


def score(a: Node, b: Node, depth: int = 0) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired with order and parents kept."""
    if a.key != b.key:
        return 0
    if (a.shape, b.shape) in _SCORES:
        return _SCORES[a.shape, b.shape]
    got = 1 + (sum(score(x, y, depth + 1) for x, y in paired(a.kids, b.kids, depth)) if depth < 200 else 0)
    if len(_SCORES) > 200_000:
        _SCORES.clear()
    _SCORES[a.shape, b.shape] = got
    return got


def paired(xs: list[Node], ys: list[Node], depth: int = 0) -> list[tuple[Node, Node]]:
    """The pairs of children in the best matching. Equal ends are paired at once, the middle by dynamic programming."""
    i, n = 0, min(len(xs), len(ys))
    while i < n and xs[i].shape == ys[i].shape:
        i += 1
    j = 0
    while j < n - i and xs[-1 - j].shape == ys[-1 - j].shape:
        j += 1
    out = list(zip(xs[:i], ys[:i])) + (list(zip(xs[len(xs) - j:], ys[len(ys) - j:])) if j else [])
    xs, ys = xs[i:len(xs) - j], ys[i:len(ys) - j]
    if not xs or not ys:
        return out
    w = [[score(x, y, depth + 1) for y in ys] for x in xs]
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for p in range(len(xs)):
        for q in range(len(ys)):
            best[p + 1][q + 1] = max(best[p][q + 1], best[p + 1][q], best[p][q] + w[p][q])
    p, q = len(xs), len(ys)
    while p and q:
        if w[p - 1][q - 1] and best[p][q] == best[p - 1][q - 1] + w[p - 1][q - 1]:
            p, q = p - 1, q - 1
            out.append((xs[p], ys[q]))
        elif best[p][q] == best[p - 1][q]:
            p -= 1
        else:
            q -= 1
    return out


def aligned(a: Node, b: Node):
    """All pairs of nodes in the best matching of two trees of one root."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        yield x, y
        todo += paired(x.kids, y.kids)


def induced(pages: list[str]) -> str | None:
    """The wrapper of a host from some of its pages, as JSON: for the first page's tree, nested [key, constant text or null, kids]."""
    trees = [parse(p) for p in dict.fromkeys(pages)]
    if len(trees) < LEAST:
        return None
    first, texts = trees[0], {}
    for other in trees[1:]:
        for x, y in aligned(first, other):
            texts.setdefault(id(x), []).append(own_text(y))

    def told(node: Node, depth: int = 0):
        same = own_text(node)
        constant = same if same and texts.get(id(node)) == [same] * (len(trees) - 1) else None
        return [node.key, constant, [told(k, depth + 1) for k in node.kids] if depth < 150 else []]

    return json.dumps(told(first))


def _tree(told: list) -> Node:
    node = Node(told[0], False, False)
    node.template = told[1]
    node.kids = [_tree(k) for k in told[2]]
    return node


_NUMBER = re.compile(r"\d+")


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def kind(root: Node) -> int:
    """A number equal for pages whose bodies have parts of the same keys."""
    body, todo = root, [root]
    while todo:
        node = todo.pop()
        if node.key.split(" ", 1)[0] == "body":
            body = node
            break
        todo += reversed(node.kids)
    return _hash("\n".join(sorted({_NUMBER.sub("#", k.key) for k in body.kids})))


def placed(root: Node):
    """All nodes that bear text, each with the hash of its path and text."""
    todo = [(root, "")]
    while todo:
        node, path = todo.pop()
        if node.never:
            continue
        path = f"{_hash(path + '/' + _NUMBER.sub('#', node.key)):x}"
        text = own_text(node) if node.texts else ""
        if text:
            yield node, _hash(path + " " + text)
        todo += [(k, path) for k in node.kids]


COUNTS = "host string, kind long, item long, pages double"


def _count(batches):
    """Of each host and kind: pages, as item 0, and pages with a text under a path. A page among n copies counts as one nth."""
    for batch in batches:
        for lo, hi in pieces(batch, "html"):
            found: Counter = Counter()
            for host, html, copies in zip(*(batch.column(c)[lo:hi].to_pylist() for c in ("host", "html", "copies"))):
                root = parse(html or "")
                own = kind(root)
                for item in {0, *(i for _, i in placed(root))}:
                    found[host, own, item] += 1 / copies
            if len(_SHAPES) > 500_000:
                _SHAPES.clear()
                _SCORES.clear()
            if found:
                hosts, kinds, items = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(kinds, pa.int64()), pa.array(items, pa.int64()),
                                                  pa.array(list(found.values()), pa.float64())], names=["host", "kind", "item", "pages"])


def constants(pages: DataFrame) -> DataFrame:
    """(host, items): texts under paths that are template by their counts, as structs of kind, 0 for any, and item. Pages are (host, h, html)."""
    copies = sized(pages.groupBy("host", "h").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    told = pages.join(copies, ["host", "h"], "left").select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))
    counts = saved(told.mapInArrow(_count, COUNTS).groupBy("host", "kind", "item").agg(F.sum("pages").alias("pages")))

    def often(found: DataFrame, *by: str) -> DataFrame:
        every = found.filter("item = 0").select(*by, F.col("pages").alias("every"))
        return found.filter((F.col("item") != 0) & (F.col("pages") > LEAST - 0.01)).join(every, [*by]).filter(
            F.col("pages") > CONSTANT * F.col("every") - 0.01).select("host", "item", *by[1:])

    anywhere = often(counts.groupBy("host", "item").agg(F.sum("pages").alias("pages")), "host")
    of_kind = often(counts, "host", "kind").join(anywhere, ["host", "item"], "left_anti").select("host", "item", "kind")
    return anywhere.select("host", "item", F.lit(0).cast("long").alias("kind")).unionByName(of_kind).groupBy("host").agg(
        F.collect_list(F.struct("kind", "item")).alias("items"))


def main_text(html: str, wrapper: Node | None, items: frozenset = frozenset()) -> str:
    """Blocks of the content slots in page order."""
    root = parse(html)
    fixed = {id(y) for x, y in aligned(wrapper, root) if x.template is not None and x.template == own_text(y)} if wrapper else set()
    if items:
        own = kind(root)
        fixed |= {id(node) for node, item in placed(root) if (0, item) in items or (own, item) in items}
    within, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.never:
            if node.main:
                within.append(node)
            else:
                todo += reversed(node.kids)
    roots = within or [root]
    text = _blocks(roots, fixed)
    return text or (_blocks(roots, set()) if fixed else "")


def _blocks(roots: list[Node], fixed: set[int]) -> str:
    out, line = [], []

    def close():
        block = " ".join(unescape("".join(line)).split())
        if block:
            out.append(block)
        line.clear()

    for root in roots:
        todo: list = [("in", root)]
        while todo:
            what, node = todo.pop()
            if what == "text":
                line.append(node)
            elif what == "close":
                close()
            elif not node.never and id(node) not in fixed:
                tag = node.key.split(" ", 1)[0]
                if tag == "br":
                    line.append(" ")
                    continue
                if tag in BLOCK or tag == "root":
                    close()
                    todo.append(("close", None))
                steps, texts, t = [], node.texts, 0
                for k in range(len(node.kids) + 1):
                    while t < len(texts) and texts[t][0] == k:
                        steps.append(("text", texts[t][1]))
                        t += 1
                    if k < len(node.kids):
                        steps.append(("in", node.kids[k]))
                todo += reversed(steps)
    close()
    return "\n\n".join(out)


def _learn(key, pdf: pd.DataFrame) -> pd.DataFrame:
    got = induced([h for h in pdf.sort_values("h")["html"] if h])
    return pd.DataFrame({"host": [key[0]], "wrapper": [got]})


def _extract(batches):
    wrappers: dict[str, Node | None] = {}
    fixed: dict[str, frozenset] = {}
    for batch in batches:
        for lo, hi in pieces(batch, "html", 1 << 20):
            texts = []
            hosts, lists = batch.column("host")[lo:hi].to_pylist(), batch.column("items")[lo:hi]
            for k, (html, told) in enumerate(zip(batch.column("html")[lo:hi].to_pylist(), batch.column("wrapper")[lo:hi].to_pylist())):
                if hosts[k] not in fixed:
                    if len(fixed) > 500:
                        fixed.clear()
                    fixed[hosts[k]] = frozenset((x["kind"], x["item"]) for x in lists[k].as_py() or ())
                if told is not None and told not in wrappers:
                    if len(wrappers) > 500:
                        wrappers.clear()
                    node = _tree(json.loads(told))
                    _shape(node)
                    wrappers[told] = node
                if len(_SHAPES) > 500_000:
                    _SHAPES.clear()
                    _SCORES.clear()
                    wrappers.clear()
                    if told is not None:
                        node = _tree(json.loads(told))
                        _shape(node)
                        wrappers[told] = node
                texts.append(main_text(html or "", wrappers.get(told), fixed[hosts[k]]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id")[lo:hi], batch.column("url")[lo:hi], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    hashed = pages.filter("html <> ''").select("host", F.xxhash64("html").alias("h"), "html")
    # Numbering within a host keeps at most SEEDS hashes of each task before its shuffle.
    first = hashed.select("host", "h").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("host").orderBy("h"))).filter(F.col("nth") <= SEEDS)
    seeds = hashed.join(sized(first.select("host", "h")), ["host", "h"]).groupBy("host", "h").agg(F.min("html").alias("html"))
    wrappers = seeds.groupBy("host").applyInPandas(_learn, "host string, wrapper string")
    wrappers = saved(wrappers.join(constants(hashed), "host", "full"))
    size = wrappers.agg(F.sum(F.coalesce(F.octet_length("wrapper"), F.lit(0)) + F.octet_length("host") + F.greatest(F.size("items"), F.lit(0)) * 16)).first()[0] or 0
    return pages.join(F.broadcast(wrappers) if size <= BROADCAST else wrappers, "host", "left").select("page_id", "url", "html", "host", "wrapper", "items").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")


def op10(pages: DataFrame) -> DataFrame:
    return extract(pages)
