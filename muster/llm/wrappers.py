"""Main text of web pages by wrappers induced from pages of the same host.

Pages are read as trees of block elements.  The different pages of a host that hold their text in the same kind of
place form a ring, and each is aligned with the next by simple tree matching.  Blocks that agree with the blocks
they meet are the host's template, those whose text varies are slots.  A page's text is that of its slots, within
the article where there is one.  Elements named after menus, headers, footers, sidebars, notices, adverts, forms or
comments go, but a name that merely contains such a word decides only if the element does not hold the text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import Met, flat, pieces
from muster.session import discard, materialize

LEAST_PAGES = 3  # different pages that must agree before a text is template
RING_PAGES = 256  # pages of a host beyond which they form several rings, dealt by hash
DEPTH = 60  # elements nested deeper count as children of this level when trees are aligned
CELLS = 1 << 20  # cells of an alignment's table that are held; larger ones are halved

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^<>]*>?""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math noembed noframes object audio video canvas select button".split())
# How far an element's tag, role or name speaks against its text.
WEAK, STRONG, HIDDEN = 1, 2, 3
TAGS = {"form": WEAK, "header": WEAK, "nav": STRONG, "footer": STRONG, "aside": STRONG, "dialog": STRONG, "menu": STRONG, "head": HIDDEN}
ROLES = {"banner": WEAK, "form": WEAK} | dict.fromkeys(
    "navigation contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split(), STRONG)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption".split())
# An element opened here ends the open ones listed, up to the nearest that bars it.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
_ALWAYS = (r"ads?|advert\w*|sponsor\w*|cookies?|consent|gdpr|nav|navbar|navigation|breadcrumbs?|footer|comments?|commentlist|"
           r"respond|reply|disqus|newsletter|subscribe|paywall|pagination|pager|skip-link")
_ALONE = (r"promo\w*|banner|notices?|notification|alert|side-?bar|widget|menu|header|masthead|topbar|share|sharing|social|related|"
          r"recommended|signup|login|popup|modal|overlay")
_HOLDERS = r"posts?|articles?|links?|box|block|list|container|wrapper|wrap|bar|area|section|message|icons?|buttons?|items?|stories|inner|panel|form"
_STRONG = re.compile(rf"(?:^|[^a-z])(?:{_ALWAYS})(?:$|[^a-z])|^(?:{_ALONE})(?:[-_]*(?:{_HOLDERS}|{_ALONE}))*$")
_WEAK = re.compile(rf"(?:^|[^a-z])(?:{_ALONE})(?:$|[^a-z])")
_STATE = re.compile(r"(?:has|no|not|with|without|is)[-_]")
_HEADER = re.compile(r"(?:^|[^a-z])(?:header|masthead|banner)(?:$|[^a-z])")
_DIGITS = re.compile(r"\d+")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" /") else {}


def _against(tag: str, attributes: dict[str, str]) -> tuple[int, bool]:
    """How far an element speaks against its text, and whether it does so as a header."""
    level, header = TAGS.get(tag, 0), tag == "header"
    if attributes:
        if attributes.get("aria-hidden") == "true" or "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower():
            return HIDDEN, False
        level = max(level, ROLES.get(attributes.get("role", "").lower(), 0))
        if tag not in ("html", "body", "main", "article"):
            for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
                if not _STATE.match(name):
                    own = STRONG if _STRONG.search(name) else WEAK if _WEAK.search(name) else 0
                    header = header or (own > 0 and bool(_HEADER.search(name)))
                    level = max(level, own)
    return level, header and level < HIDDEN


class Block:
    """A run of text between the limits of block elements."""

    __slots__ = ("path", "text", "marks", "article")

    def __init__(self, path: tuple[str, ...], text: str, marks: tuple[int, ...], article: int):
        self.path, self.text = path, text
        self.marks = marks  # the elements around it, outer ones first, that speak against its text
        self.article = article  # how many of these are around its article; -1 without an article

    @property
    def prose(self) -> bool:
        return bool(self.path) and self.path[-1].split(".")[0] in PROSE


def blocks(page: str) -> tuple[list[Block], list[tuple[int, bool]], bool]:
    """Blocks of a page in order, what speaks against its elements by their mark, and whether it has an article.

    Against an element may speak: how far, whether as a header.
    The path has each block element with its class, runs of digits as 0.  End tags without a start are passed over,
    and missing ones added as browsers do for paragraphs, list items and table cells.  White space becomes one
    space; empty blocks go.
    """
    out, levels, has_article = [], [], False
    stack, text, at = [], [], 0  # stack: tag, path name, is block, marks, marks around the article

    def flush():
        joined = " ".join(entities.unescape("".join(text)).split()) if text else ""
        text.clear()
        if joined:
            marks, article = (stack[-1][3], stack[-1][4]) if stack else ((), -1)
            out.append(Block(tuple(s[1] for s in stack if s[2]), joined, marks, article))

    def close(count):
        for _ in range(count):
            if stack[-1][2] or stack[-1][0] in RAW:
                flush()
            stack.pop()

    def depth_of(names, bars=frozenset()):
        for back, s in enumerate(reversed(stack), 1):
            if s[0] in names:
                return back
            if s[0] in bars:
                return 0
        return 0

    size = len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            text.append(page[at:])
            break
        if token.start() > at:
            text.append(page[at:token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if tag == "p" and not depth_of(("p",)):
                flush()
            back = depth_of((tag,))
            if back and not (tag not in BLOCKS and any(s[2] for s in stack[-back:])):
                close(back)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                text.append(" ")
                if tag == "hr":
                    flush()
            continue
        raw = token[3] or ""
        if tag in RAW:
            # What is inside is text to the browser, up to the end tag.
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if tag not in ("svg", "math", "button", "select", "object", "noscript", "template") or found:
                at = found.end() if found else size
            if tag in BLOCKS:
                flush()
            continue
        if tag in BLOCKS:
            back = depth_of(("p",), frozenset(BLOCKS - {"p"}))
            if back:
                close(back)
            if tag in ENDS:
                names, bars = ENDS[tag]
                while back := depth_of(names, bars):
                    close(back)
            flush()
        attributes = _attributes(raw)
        marks, article = (stack[-1][3], stack[-1][4]) if stack else ((), -1)
        level = _against(tag, attributes)
        if level[0]:
            marks = (*marks, len(levels))
            levels.append(level)
        if article < 0 and tag in ("article", "main"):
            article, has_article = len(marks), True
        name = tag + ("." + ".".join(sorted(_DIGITS.sub("0", attributes["class"]).split())) if attributes.get("class") else "")
        stack.append((tag, name, tag in BLOCKS, marks, article))
    while stack:
        close(1)
    flush()
    return out, levels, has_article


def layout(found: list[Block]) -> tuple[str, ...]:
    """Where a page holds its text: the path, four elements at most, of containers that hold more than half of it."""
    held: Counter = Counter()
    for b in found:
        containers = [n for n in b.path if n.split(".")[0] not in PROSE and n.split(".")[0] not in ("ul", "ol", "li", "tr", "dl")]
        for depth in range(1, min(len(containers), 4) + 1):
            held[tuple(containers[:depth])] += len(b.text)
    total = sum(len(b.text) for b in found)
    return max((p for p, n in held.items() if 2 * n > total), key=len, default=())


def keys_of(found: list[Block]) -> list[int]:
    """64-bit digests of the blocks' paths and texts."""
    memo = {}

    def digest(b: Block) -> int:
        if b.path not in memo:
            memo[b.path] = hashlib.blake2b(("\x1f".join(b.path[:DEPTH]) + "\x1e").encode("utf-8", "replace"), digest_size=8)
        own = memo[b.path].copy()
        own.update(b.text.encode("utf-8", "replace"))
        return int.from_bytes(own.digest(), "little", signed=True)

    return [digest(b) for b in found]


def _name(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


TEXT = 0  # name of text nodes


def outline(found: list[Block], keys: list[int]) -> tuple[list[int], list[int], list[int]]:
    """A page's tree in preorder: depth, name and, of texts, key of every node; the root is left out."""
    depths, names, texts, open_path, memo = [], [], [], (), {}
    for b, key in zip(found, keys):
        path = b.path[:DEPTH]
        common = 0
        while common < min(len(path), len(open_path)) and path[common] == open_path[common]:
            common += 1
        for i in range(common, len(path)):
            if path[i] not in memo:
                memo[path[i]] = _name(path[i]) or 1
            depths.append(i + 1)
            names.append(memo[path[i]])
            texts.append(0)
        depths.append(len(path) + 1)
        names.append(TEXT)
        texts.append(key)
        # The next paragraph is an element of its own.
        open_path = path[:-1] if path and (b.prose or path[-1].split(".")[0] == "li") else path
    return depths, names, texts


class Node:
    """An element of a page's tree, or one of its texts.  Nodes of equal shape have equal trees of names below them."""

    __slots__ = ("name", "key", "children", "size", "shape")

    def __init__(self, name: int, key: int = 0):
        self.name, self.key, self.children, self.size, self.shape = name, key, [], 1, 0


class Trees:
    """Builds and aligns trees; shapes are numbered, and sizes of alignments remembered by shapes."""

    def __init__(self):
        self.shapes: dict[tuple, int] = {}
        self.sizes: dict[tuple[int, int], int] = {}

    def forget(self) -> bool:
        """Forget all shapes once there are many; trees built before must not be used any more."""
        if len(self.shapes) + len(self.sizes) < 100_000:
            return False
        self.shapes.clear()
        self.sizes.clear()
        return True

    def build(self, depths, names, texts) -> Node:
        nodes = [Node(-1)]

        def finish():
            done = nodes.pop()
            done.size = 1 + sum(c.size for c in done.children)
            done.shape = self.shapes.setdefault((done.name, *[c.shape for c in done.children]), len(self.shapes))
            return done

        for depth, name, key in zip(depths, names, texts):
            while len(nodes) > depth:
                done = finish()
                nodes[-1].children.append(done)
            nodes.append(Node(name, key))
        while len(nodes) > 1:
            done = finish()
            nodes[-1].children.append(done)
        return finish()

    def size(self, one: Node, other: Node) -> int:
        """Simple tree matching: the most nodes that pair up with their parents, in order."""
        if one.name != other.name:
            return 0
        if one.shape == other.shape:
            return one.size
        shapes = (one.shape, other.shape)
        if shapes not in self.sizes:
            start, a, b = self._ends(one.children, other.children)
            self.sizes[shapes] = 1 + sum(x.size for x in one.children) - sum(x.size for x in a) + int(self._row(a, b)[-1])
        return self.sizes[shapes]

    def _ends(self, a: list[Node], b: list[Node]) -> tuple[int, list[Node], list[Node]]:
        """Children without the equal shapes at both ends, which some best alignment pairs, and how many went in front."""
        start, stop = 0, 0
        least = min(len(a), len(b))
        while start < least and a[start].shape == b[start].shape:
            start += 1
        while stop < least - start and a[-1 - stop].shape == b[-1 - stop].shape:
            stop += 1
        return start, a[start:len(a) - stop], b[start:len(b) - stop]

    def _weights(self, x: Node, b: list[Node]) -> np.ndarray:
        return np.fromiter((self.size(x, y) for y in b), np.int64, len(b))

    def _rows(self, a: list[Node], b: list[Node]) -> Iterator[np.ndarray]:
        """Best sizes of a's first children with b's first children, a row for each of a's."""
        kinds, at = {}, np.zeros(len(b), np.int64)
        for j, y in enumerate(b):
            at[j] = kinds.setdefault(y.shape, len(kinds))
        different = [None] * len(kinds)
        for y in b:
            different[kinds[y.shape]] = y
        memo: dict[int, np.ndarray] = {}
        row = np.zeros(len(b) + 1, np.int64)
        for x in a:
            if x.shape not in memo:
                memo[x.shape] = self._weights(x, different)
            best = row.copy()
            np.maximum(best[1:], row[:-1] + memo[x.shape][at], out=best[1:])
            row = np.maximum.accumulate(best)
            yield row

    def _row(self, a: list[Node], b: list[Node]) -> np.ndarray:
        row = np.zeros(len(b) + 1, np.int64)
        for row in self._rows(a, b):
            pass
        return row

    def pairs(self, one: Node, other: Node) -> Iterator[tuple[Node, Node]]:
        """The pairs of a largest alignment."""
        waiting = [(one, other)] if one.name == other.name else []
        while waiting:
            x, y = waiting.pop()
            yield x, y
            if x.shape == y.shape:
                waiting += zip(x.children, y.children)
                continue
            start, a, b = self._ends(x.children, y.children)
            waiting += zip(x.children[:start], y.children[:start])
            waiting += zip(x.children[start + len(a):], y.children[start + len(b):])
            waiting += self._paired(a, b)

    def _paired(self, a: list[Node], b: list[Node]) -> list[tuple[Node, Node]]:
        if not a or not b:
            return []
        if len(a) * len(b) > CELLS and len(a) > 1:
            # Halve a where the best sizes of both halves add up to most, so that no whole table is held.
            half = len(a) // 2
            cut = int(np.argmax(self._row(a[:half], b) + self._row(a[half:][::-1], b[::-1])[::-1]))
            return self._paired(a[:half], b[:cut]) + self._paired(a[half:], b[cut:])
        table = [np.zeros(len(b) + 1, np.int64), *self._rows(a, b)]
        out, i, j = [], len(a), len(b)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((a[i], b[j]))
        return out


class Ring:
    """Counts, over the pages of a ring in order, how often a block agrees with the block that the next page has there."""

    def __init__(self, trees: Trees):
        self.trees, self.first, self.last, self.pages = trees, None, None, 0
        self.same, self.differs = Counter(), Counter()

    def add(self, nodes: tuple) -> None:
        self.pages += 1
        if self.first is None:
            self.first = nodes
        else:
            self._align(self.last, nodes)
        self.last = nodes

    def _align(self, one: tuple, other: tuple) -> None:
        self.trees.forget()
        for x, y in self.trees.pairs(self.trees.build(*one), self.trees.build(*other)):
            if x.name == TEXT:
                if x.key == y.key:
                    self.same[x.key] += 1
                else:
                    self.differs[x.key] += 1
                    self.differs[y.key] += 1

    def close(self) -> list[tuple[int, int, int]]:
        """``key, same, differs`` of the ring's blocks."""
        if self.pages >= LEAST_PAGES:
            self._align(self.last, self.first)
        return [(k, self.same[k], self.differs[k]) for k in self.same.keys() | self.differs.keys()]


def constant(same, differs):
    """Whether a block is template: it agrees on at least three pages, and at least as often as not."""
    return (same >= LEAST_PAGES - 1) & (same >= differs)


def induce(pages: list[str]) -> list[int]:
    """Keys of the template's blocks of one host's pages; for few pages, without Spark."""
    rings: dict[tuple, Ring] = {}
    trees = Trees()
    for page in sorted(set(pages)):
        found = blocks(page)[0]
        rings.setdefault(layout(found), Ring(trees)).add(outline(found, keys_of(found)))
    totals: dict[int, list[int]] = {}
    for ring in rings.values():
        for key, same, differs in ring.close():
            own = totals.setdefault(key, [0, 0])
            own[0] += same
            own[1] += differs
    return sorted(k for k, (same, differs) in totals.items() if constant(same, differs))


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """Text of a page, its blocks joined by line breaks.

    * With an article or main element its blocks count, else those of the whole page.
    * Hidden elements go.  So do those whose tag, role or name says strongly that they are not the text, and those
      that say so weakly unless they hold more than half of the rest; elements around the article do not matter,
      and its headers stay.
    * Blocks of the host's template go, but for prose within an article, which is the article's own even where pages
      repeat it.  A heading in a header outside an article stays if it varies over the host's pages.
    * Prose outside the article counts as well if it varies and has over four times the article's characters.
    * Where names alone have removed all text of a page without article, they are ignored.
    """
    every, levels, has_article = blocks(page)
    keys = keys_of(every) if template else [0] * len(every)
    found = [(b, k in template) for b, k in zip(every, keys) if all(levels[m][0] < HIDDEN for m in b.marks)]
    inside = [(b, t) for b, t in found if b.article >= 0]
    pool = [(b, t) for b, t in inside if all(levels[m][0] < STRONG for m in b.marks[:b.article])] or inside
    article = bool(pool)
    if not article:
        pool = found
    own = {id(b): b.marks[max(b.article, 0):] for b, _ in pool}
    speaking = [b for b, _ in pool if all(levels[m][0] < STRONG for m in own[id(b)])]
    total, held = sum(len(b.text) for b in speaking), Counter()
    for b in speaking:
        for m in own[id(b)]:
            held[m] += len(b.text)

    def stays(b: Block, constant: bool) -> bool:
        if constant and not (article and b.prose):
            return False
        for m in own[id(b)]:
            level, header = levels[m]
            if level >= STRONG:
                return False
            title = bool(template) and bool(b.path) and b.path[-1].split(".")[0] in ("h1", "h2")
            if not (2 * held[m] > total or (header and (article or title))):
                return False
        return True

    kept = [b for b, t in pool if stays(b, t)]
    if article and template:
        outside = [b for b, t in found if b.article < 0 and b.prose and not t and not b.marks]
        if sum(len(b.text) for b in outside) > 4 * sum(len(b.text) for b in kept):
            chosen = {id(b) for b in (*kept, *outside)}
            kept = [b for b, _ in found if id(b) in chosen]
    if not kept and not has_article and not template:
        kept = [b for b, _ in found if not any(n.split(".")[0] in TAGS for n in b.path) and b.prose]
    return "\n".join(b.text for b in kept)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def host_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, template``: by digest of the host, the keys of its constant blocks, from all its different pages.

    Trees, not texts, are shuffled.  A host's pages of one layout form a ring, or several of about half of
    ``RING_PAGES`` pages; the counts of a host's rings add up.
    """
    rows = pages.select(F.xxhash64(host_of(F.col(url_col))).alias("host"), F.col(html_col).alias("html"))
    rows = rows.filter("html <> ''").withColumn("h", F.xxhash64("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for batch in pieces(batches, "html"):
            out: list[list] = [[], [], [], [], [], []]
            for host, page, h in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "h"))):
                if met.new((host, h)):
                    found = blocks(page)[0]
                    place = _name("\x1f".join(layout(found)))
                    for column, value in zip(out, (host, place, h, *outline(found, keys_of(found)))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in out[:3]], flat([np.array(x, np.int32) for x in out[3]], pa.int32()),
                 *[flat([np.array(x, np.int64) for x in c], pa.int64()) for c in out[4:]]],
                ["host", "layout", "h", "depths", "names", "texts"])

    trees = materialize(rows.select("host", "html", "h").mapInArrow(
        read, "host long, layout long, h long, depths array<int>, names array<long>, texts array<long>"), "trees")
    large = trees.groupBy("host", "layout").count().filter(F.col("count") > RING_PAGES)
    rings = trees.join(large, ["host", "layout"], "left")
    rings = rings.withColumn("ring", F.expr(f"pmod(h, coalesce(count * 2 div {RING_PAGES}, 1))")).drop("count")
    order = ["host", "layout", "ring"]
    rings = rings.repartition(*order).sortWithinPartitions(*order, "h")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.schema([(c, pa.int64()) for c in ("host", "key", "same", "differs")])
        shapes, ring, at, last = Trees(), None, None, None

        def counts():
            closed = ring.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * len(closed), pa.int64()), *[pa.array([c[i] for c in closed], pa.int64()) for i in range(3)]], schema=names)

        for batch in batches:
            columns = [batch.column(c) for c in ("host", "layout", "ring", "h", "depths", "names", "texts")]
            for i in range(batch.num_rows):
                *place, h = (c[i].as_py() for c in columns[:4])
                if place != at:
                    if ring is not None:
                        yield counts()
                    ring, at, last = Ring(shapes), place, None
                if h != last:
                    ring.add(tuple(c[i].as_py() for c in columns[4:]))
                    last = h
        if ring is not None:
            yield counts()

    blocks_of = rings.mapInArrow(walk, "host long, key long, same long, differs long")
    totals = blocks_of.groupBy("host", "key").agg(F.sum("same").alias("same"), F.sum("differs").alias("differs"))
    templates = totals.filter(constant(F.col("same"), F.col("differs"))).groupBy("host").agg(F.collect_list("key").alias("template"))
    templates = materialize(templates, "templates")
    discard(trees)
    return templates


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page row.

    Null and empty pages give an empty text; a null url is a host of its own; copies are alike and count once for
    the template.  A host may have several layouts.  Other columns are not looked at.
    """
    templates = host_templates(pages, url_col, html_col)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    joined = rows.withColumn("host", F.xxhash64(host_of(F.col("url")))).join(templates, "host", "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            both = zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())
            texts = [main_text(h or "", frozenset(t or ())) for h, t in both]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "template").mapInArrow(
        extract, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
