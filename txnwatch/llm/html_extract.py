"""Main text of web pages: site template removal plus the page's own structure.

Pages are parsed into element trees (in tasks, one page at a time). Every element's subtree is hashed (names, classes and
text); Spark counts on how many different pages of its host each subtree occurs (pages with the same main text count
once, so a page posted again and again does not make its own text a template), and subtrees that recur on many pages of a
host are its template and are cut out. Inside a marked article only containers are, not paragraphs, headings or cells. What the structure itself says is no article goes too: scripts, styles, menus, headers
and footers of the page, sidebars, forms, and blocks whose class or id names them as adverts, notices or comments. The
rest's blocks are the text; where a page marks its article, only the article's.

Counting goes by (host, hash, page content) with partial sums, so a host with a third of all pages is spread over its
subtrees and pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_digest

from txnwatch.session import ensure_checkpoint_dir

#: A subtree is template if it is on at least PAGES different pages of its host, and on PAGES more for each doubling of the
#: host beyond PAGES / SHARE pages.
PAGES, SHARE = 5, 0.05
#: Template subtrees that are sent to all tasks (8 bytes each), and ways in which the pages with a subtree are dealt out in the join.
SENT, SALT = 1 << 20, 16
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
                   "thead title tr ul".split())
NEVER = frozenset("aside button canvas dialog embed fieldset footer form head iframe input menu nav noscript object option script select style "
                  "svg template textarea title".split())
#: What can be template inside a marked article.
CONTAINERS = frozenset("center details dir div dl figure ol section summary table ul".split())
#: Words of class and id names that mark a block as no article.
MARKS = re.compile(r"(?:^|[\s_-])(ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|login|masthead|menu|nav|navbar"
                   r"|navigation|newsletter|notices?|pagination|popup|promo\w*|related|replies|reply|share|sharing|sidebar|signup|social|sponsor\w*"
                   r"|subscribe|toolbar|widgets?)(?:$|[\s_-])", re.I)
#: Those of them that also name things of an article (social-policy, entry-header): inside one only as a whole name.
BOTH = re.compile(r"consent|header|notices?|related|replies|reply|share|sharing|social|widgets?", re.I)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
#: An open element that a new one ends, as HTML's optional end tags go: new -> names it closes.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tbody", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
#: How far that looks: not out of these.
SCOPES = frozenset("ul ol dl table body html article section div td th select".split())
SPACE = re.compile(r"[ \t\n\x0b\x0c\r\x85\xa0  -     　]+")


class Node:
    __slots__ = ("attrs", "children", "hash", "most", "name", "size", "words")

    def __init__(self, name: str, attrs: str):
        self.name, self.attrs, self.children, self.hash, self.words = name, attrs, [], 0, False
        self.size, self.most = 0, False


class Tree(HTMLParser):
    """The element tree of a page; ``root`` holds strings and nodes. Broken markup never fails: what is not closed ends
    with its parent, an end tag without its start is nothing."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", "")
        self.open = [self.root]
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and not attrs:
            return
        if tag in BLOCKS:
            self.end_paragraph()
        ends = ENDS.get(tag, ())
        if ends:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].name in ends:
                    del self.open[k:]
                    if self.open[-1].name in ends:
                        continue
                    break
                if self.open[k].name in SCOPES:
                    break
        names = {k: v or "" for k, v in attrs if k in ("class", "id", "role")}
        node = Node(tag, "\x1f".join(names.get(k, "") for k in ("class", "id", "role")))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].name == tag and tag in ("svg", "path", "iframe"):
            self.open.pop()

    def end_paragraph(self):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == "p":
                del self.open[k:]
                return
            if self.open[k].name in BLOCKS:
                return

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == tag:
                del self.open[k:]
                return
            if tag not in BLOCKS and self.open[k].name in BLOCKS:
                return  # an inline end tag does not close blocks

    def handle_data(self, data):
        self.open[-1].children.append(data)


def hash_subtrees(root: Node) -> None:
    """64-bit hashes of all subtrees, whether they hold words, and the forms that hold most of the page's text, bottom up,
    without recursion (markup may nest deeper than Python)."""
    order, stack, forms = [], [root], []
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if c.__class__ is Node]
    for node in reversed(order):
        parts = [node.name, node.attrs]
        for c in node.children:
            if c.__class__ is Node:
                parts.append(f"\x01{c.hash}")
                node.words |= c.words
                if c.name == "form" or c.name not in NEVER:
                    node.size += c.size
            elif said := " ".join(c.split()):
                parts.append("\x02" + said)
                node.words = True
                node.size += len(said)
        node.hash = hash64("\x1e".join(parts))
        if node.name == "form":
            forms.append(node)
    for node in forms:
        node.most = node.size * 2 > root.size


def hash64(text: str) -> int:
    """A signed 64-bit hash, the same in all workers."""
    return int.from_bytes(xxh3_64_digest(text.encode("utf-8", "surrogatepass")), "little", signed=True)


def excluded(node: Node, in_article: bool) -> bool:
    """Whether an element by its own name, class, id or role is no part of an article. A header inside an article is its
    headline, one outside is the page's; a form with most of the page's text is around the page."""
    if node.name in NEVER and not node.most or node.name == "header" and not in_article:
        return True
    if not node.attrs.strip("\x1f") or node.name in ("html", "body", "article", "main"):
        return False
    cls, id_, role = node.attrs.split("\x1f")
    return any(_marked(names, node.name, in_article) for names in (cls, id_)) or role.lower() in ROLES


def _marked(names: str, element: str, in_article: bool) -> bool:
    if not in_article or not MARKS.search(names):
        return bool(MARKS.search(names))
    for name in names.split():
        if BOTH.fullmatch(name):
            if element != "header":
                return True
        elif any(MARKS.fullmatch(word) and not BOTH.fullmatch(word) for word in re.split("[_-]", name)):
            return True
    return False


def main_text(root: Node, template: frozenset[int] | set[int]) -> str:
    """The blocks that are left, one a line; with articles on the page, only what is inside the outermost ones. The tree is
    one that ``hash_subtrees`` has seen."""
    articles = [n for n in _top(root, "article") if n.words] or [n for n in _top(root, "main") if n.words]
    blocks: list[str] = []
    words: list[str] = []

    def flush():
        if said := SPACE.sub(" ", "".join(words)).strip(" "):
            blocks.append(said)
        words.clear()

    for top in articles or [root]:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                words.append(item)
            elif item is not top and (excluded(item, bool(articles)) or item.hash in template and (
                    not articles or item.name in CONTAINERS)):
                if item.name in BLOCKS:
                    flush()
            else:
                block = item.name in BLOCKS
                if block:
                    flush()
                    stack.append(None)
                elif item.name == "br":
                    words.append(" ")
                stack += reversed(item.children)
        flush()
    return "\n".join(blocks)


def _top(root: Node, name: str) -> list[Node]:
    """The outermost elements of a name that lie in nothing excluded, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.name == name:
            out.append(node)
        elif node is root or not excluded(node, False):
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def hashes(root: Node) -> tuple[set[int], int]:
    """(the subtrees that can be cut as template, what tells the page from others of its host). These are blocks with words
    below the page's own frame; inside an article, containers. Pages are told apart by their articles, or else their text."""
    out, mine, stack = set(), [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        for c in node.children:
            if c.__class__ is Node and c.words:
                if c.name in ("article", "main"):
                    mine.append(c.hash)
                elif c.name in (CONTAINERS if inside else BLOCKS) and c.name not in ("html", "body"):
                    out.add(c.hash)
                stack.append((c, inside or c.name in ("article", "main")))
    return out, hash64(repr(sorted(mine)) if mine else main_text(root, frozenset()))


def host(url: str | None) -> str:
    found = re.match(r"(?i)\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def subtrees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, content, hash): the distinct subtrees of each page, and one row with a null hash for the page itself; a page
    without a host counts for the host ''."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                for url, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    root = Tree(source or "").root
                    hash_subtrees(root)
                    found, content = hashes(root)
                    rows += [(host(url), content, h) for h in [None, *found]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                                  pa.array([r[2] for r in rows], pa.int64())], names=["host", "content", "hash"])

    return pages.select(url_col, html_col).mapInArrow(run, "host string, content bigint, hash bigint")


def own_subtrees(pages: DataFrame, key_col: str, url_col: str, html_col: str) -> DataFrame:
    """(host, key, hash): the distinct subtrees of each page, with the page's key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = []
                for key, url, source in zip(*(c.to_pylist() for c in batch.slice(at, 128).columns), strict=True):
                    root = Tree(source or "").root
                    hash_subtrees(root)
                    rows += [(host(url), key, h) for h in hashes(root)[0]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                                  pa.array([r[2] for r in rows], pa.int64())], names=["host", "key", "hash"])

    return pages.select(key_col, url_col, html_col).mapInArrow(run, "host string, key bigint, hash bigint")


def templates(found: DataFrame, least: int = PAGES, share: float = SHARE) -> DataFrame:
    """(host, hash): the subtrees that recur across a host's different pages. The pages needed grow with the logarithm of
    the host, so that a section of a large host is template too; a host's list has no bound."""
    distinct = found.groupBy("host", "hash", "content").agg(F.lit(1).alias("once"))
    counted = distinct.groupBy("host", "hash").agg(F.count("*").alias("pages")).where(
        F.col("hash").isNull() | (F.col("pages") >= least)).checkpoint()  # read twice; the pages are parsed once
    per_host = counted.where("hash IS NULL").select(F.col("host").alias("h"), F.col("pages").alias("all"))
    often = counted.where(F.col("hash").isNotNull()).join(per_host, F.col("host") == F.col("h"))
    needed = (F.log2(F.greatest(F.col("all") * share / least, F.lit(1.0))) + 1) * least
    return often.where(F.col("pages") >= needed).select("host", "hash")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = PAGES,
            share: float = SHARE) -> DataFrame:
    """(id, url, text) per row: the main text, '' where there is none.

    Null html counts as empty, a null url as a page of the host ''. Repeated rows are pages of their own; null ids stay.
    Other columns are not read; an empty table gives an empty one. Up to SENT template subtrees go to all tasks, so that
    pages are read where they lie; of more, each page gets those it has by a join on its own subtrees, hot ones dealt out by
    salt.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    kind, url_kind = dict(pages.dtypes)[id_col], dict(pages.dtypes)[url_col]
    cut = templates(subtrees(pages, url_col, html_col), least, share).checkpoint()
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    schema = f"`{id_col}` {kind}, `{url_col}` {url_kind}, text string"
    known = None
    if cut.count() <= SENT:
        lists = cut.groupBy("host").agg(F.collect_list("hash").alias("hashes"))
        known = pages.sparkSession.sparkContext.broadcast({r["host"]: frozenset(r["hashes"]) for r in lists.toLocalIterator()})
    else:
        rows = rows.withColumn("_key", F.xxhash64("_url", "_html"))
        own = own_subtrees(rows, "_key", "_url", "_html").withColumn("salt", F.pmod("key", F.lit(SALT)).cast("int"))
        cut = cut.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        mine = own.join(cut, ["host", "hash", "salt"]).groupBy("key").agg(F.collect_set("hash").alias("_cut"))
        rows = rows.join(mine.withColumnRenamed("key", "_key"), "_key", "left").select("_id", "_url", "_html", "_cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                urls = part.column(1).to_pylist()
                lists = [known.value.get(host(u), ()) for u in urls] if known else part.column(3).to_pylist()
                out = []
                for source, own in zip(part.column(2).to_pylist(), lists, strict=True):
                    root = Tree(source or "").root
                    hash_subtrees(root)
                    out.append(main_text(root, set(own or ())))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string())], names=[id_col, url_col, "text"])

    return rows.mapInArrow(run, schema)
