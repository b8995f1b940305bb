"""Main text of web pages by a minimum cut over their text blocks."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import query, table

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "noembed", "xmp"}
RAW_END = {name: re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I) for name in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select"
    " summary svg table tbody td tfoot th thead tr ul".split()
)
#: An open element of the second column ends where one of the first begins, up to a border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}

#: Elements and roles that never hold the article, and words that do not in a class or id, unless most of the evidence is below.
NEVER_TAGS = {"nav", "aside", "footer", "menu", "dialog", "select", "button", "head", "svg", "search"}
NEVER_WORDS = set(
    "nav navbar navigation menu sidebar footer comment comments reply replies disqus cookie cookies consent gdpr ad ads advert adverts"
    " advertisement advertising adsbygoogle sponsor sponsored promo promotion newsletter subscribe subscription signup login breadcrumb"
    " breadcrumbs pagination pager popup modal overlay complementary contentinfo dialog related recommended respond".split()
)
#: Words of reader comments, which stay out however long they are.
TALK_WORDS = set("comment comments reply replies disqus respond".split())
#: Beginnings of class names that describe a layout: 'no-sidebar' and 'has-comments' say nothing of what is inside.
LAYOUT = re.compile(r"(?:no|has|have|with|without|hide|show)[-_]")
#: Words that usually do not, unless the article starts further inside.
SELDOM_WORDS = set("header masthead banner notice alert share sharing social widget toolbar form search skip legal copyright side teaser teasers".split())
ARTICLE_TAGS = {"article", "main"}
ARTICLE_WORDS = set("article story post entry content main text body".split())

# Costs in hundredths: what labelling a block against its evidence costs, and neighbours apart.
NEVER, SELDOM, SELDOM_OUTSIDE, ARTICLE, ARTICLE_WORD, VETO = -1000, -700, -300, 600, 250, 600
SHORT_LINE, SENTENCE, LONG, MOSTLY_LINKS, SOME_LINKS, RIGHTS = -200, 200, 150, -400, -200, -400
NEXT_SAME, NEXT_OTHER, SIBLING = 100, 40, 60

RIGHTS_LINE = re.compile(r"\s*(?:©|\(c\)|copyright\b|all rights reserved)", re.I)
ENDS = tuple('.!?…:;"”»)。！？．」』”។။།')
#: Scripts without spaces between words, by the usual letters a word; the last have no full stop either.
UNSPACED = {
    2: re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]+"),
    4: re.compile("[\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff]+"),
}
NO_STOP = re.compile("[\u0e00-\u0eff]\\Z")
#: Words of a sentence that counts as prose; the second where a page has no such sentence.
SENTENCE_WORDS = (8, 5)


class Element:
    __slots__ = ("article", "articles", "covered", "key", "never", "seldom", "tag", "talk", "vetoes", "word")

    def __init__(self, key: int, tag: str, attributes: str, parent: Element | None):
        words: set[str] = set()
        certain: set[str] = set()
        if attributes and tag not in ("html", "body"):
            for name, *value in ATTRIBUTE.findall(attributes):
                value, name = "".join(value), name.lower()
                if name in ("class", "id", "role"):
                    named = [n for n in CAMEL.sub(" ", value).lower().split() if not LAYOUT.match(n)]
                    found = WORD.findall(" ".join(named))
                    words.update(found)
                    if name == "role":
                        certain.update(found)
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) or name == "aria-hidden" and value == "true":
                    certain.add("dialog")
            if re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes):
                certain.add("dialog")
        self.key, self.tag = key, tag
        hard = tag in NEVER_TAGS or not certain.isdisjoint(NEVER_WORDS)
        veto = not words.isdisjoint(NEVER_WORDS)
        never = hard or veto
        seldom = tag in ("header", "form", "fieldset") or not words.isdisjoint(SELDOM_WORDS)
        article = tag in ARTICLE_TAGS and not never and not seldom or "articleBody" in attributes
        # how deep the evidence is: an article inside weakens what stands outside
        self.never = hard or bool(parent and parent.never)
        outside = parent.vetoes if parent else ()
        self.vetoes = (*outside, key) if veto and not hard else outside
        # comment sections around this element, and those that an article of their own covers it from
        self.articles: dict[int, int] = parent.articles if parent else {}
        self.talk, self.covered = (parent.talk, parent.covered) if parent else ((), ())
        if not words.isdisjoint(TALK_WORDS):
            self.talk = (*self.talk, key)
        elif tag in ARTICLE_TAGS and self.talk:
            for k in self.talk:
                self.articles[k] = self.articles.get(k, 0) + 1
            self.talk, self.covered = (), (*self.covered, *self.talk)
        inside = bool(parent and parent.article)
        self.article = article or inside
        if tag == "header" and inside:
            seldom = not words.isdisjoint(SELDOM_WORDS - {"header"})
        outer = parent.seldom if parent else 0
        self.seldom = SELDOM if seldom else (SELDOM_OUTSIDE if article and outer else outer)
        self.word = not words.isdisjoint(ARTICLE_WORDS) or bool(parent and parent.word)


class Block:
    __slots__ = ("element", "linked", "parent", "tag", "text")

    def __init__(self, text: str, linked: int, element: Element, parent: int):
        self.text, self.linked, self.element, self.parent, self.tag = text, linked, element, parent, element.tag


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; scripts, styles, comments and markup are gone, references decoded."""
    stack = [Element(0, "", "", None)]
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    state = {"key": 0, "links": 0}

    def flush():
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                linked = sum(len("".join(p.split())) for p, is_link in parts if is_link)
                out.append(Block(text, linked, stack[-1], stack[-2].key if len(stack) > 1 else 0))
            parts.clear()

    def say(raw: str):
        if raw:
            parts.append((unescape(raw) if "&" in raw else raw, state["links"] > 0))

    def pop(tags: set[str], borders: set[str]):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in borders:
                return

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        closing, name = bool(m.group(1) or m.group(4)), name.lower()
        attributes = m.group(3) or m.group(6) or ""
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = RAW_END[name].search(page, at)
                at = end.end() if end else size
        elif name == "br":
            parts.append((" ", False))
        elif name == "a":
            state["links"] = 0 if closing else 1
        elif name in BLOCK:
            flush()
            state["links"] = 0
            if closing:
                pop({name}, {"td", "th", "table"} if name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th") else set())
            else:
                if stack[-1].tag == "p" or name != "p" and any(e.tag == "p" for e in stack[-3:]):
                    pop({"p"}, set())
                if name in CLOSES:
                    pop(*CLOSES[name])
                if name not in VOID and not (attributes.endswith("/") and name == "svg"):
                    state["key"] += 1
                    stack.append(Element(state["key"], name, attributes, stack[-1]))
    flush()
    return out


def words_in(text: str) -> int:
    """Words by spaces, and by code points where the script has no spaces."""
    words = text.count(" ") + 1
    if not text.isascii():
        words += sum(sum(map(len, letters.findall(text))) // size for size, letters in UNSPACED.items())
    return words


def evidence(block: Block, sentence: int = SENTENCE_WORDS[0]) -> int:
    """Cost of calling the block boilerplate; below zero, of calling it content. Vetoes by class are left out."""
    e, text = block.element, block.text
    if e.never:
        return NEVER
    solid = sum(map(len, text.split())) or 1
    words = words_in(text)
    score = e.seldom + (ARTICLE if e.article else 0) + (ARTICLE_WORD if e.word else 0)
    ended = text.endswith(ENDS)
    if words >= sentence and (ended or NO_STOP.search(text)):
        score += SENTENCE
    elif words < 5 and not ended:
        score += SHORT_LINE
    if words >= 25:
        score += LONG
    links = block.linked / solid
    score += MOSTLY_LINKS if links > 0.6 else SOME_LINKS if links > 0.3 else 0
    if RIGHTS_LINE.match(text):
        score += RIGHTS
    return score


def costs(blocks: list[Block], sentence: int = SENTENCE_WORDS[0]) -> list[int]:
    """Evidence of all blocks, and NEVER below a class or id that vetoes.

    A layout names itself by such words as well ('right-sidebar' around a page). The
    vetoes above some blocks fall where these blocks hold more evidence for content
    than a veto costs, over twice that of all blocks without one, and an article
    element or paragraphs of one parent among them: a list of teasers or notes has one
    paragraph an entry. Those of a comment section never fall, unless one article
    element, and no second one, starts further inside.
    """
    score = [evidence(b, sentence) for b in blocks]
    talk = [bool(e.talk) or any(e.articles[k] > 1 for k in e.covered) for e in (b.element for b in blocks)]
    held: dict[tuple[int, ...], int] = {}
    prose: dict[tuple[int, ...], dict[int, int]] = {}
    for b, s, t in zip(blocks, score, talk):
        if s > 0 and not t:
            held[b.element.vetoes] = held.get(b.element.vetoes, 0) + s
            found = prose.setdefault(b.element.vetoes, {})
            found[b.parent] = found.get(b.parent, 0) + (2 if b.element.article else b.tag == "p")
    free = held.pop((), 0)
    first = max(held, key=held.get, default=())
    whole = first and max(prose[first].values()) > 1
    lifted = set(first) if whole and held[first] > max(VETO, 2 * free) else set()
    return [s if lifted.issuperset(b.element.vetoes) and not t else NEVER for b, s, t in zip(blocks, score, talk)]


def neighbours(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Adjacent blocks, and the nearest blocks below the same parent element."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT_SAME if blocks[i - 1].parent == b.parent else NEXT_OTHER))
        before = last.get(b.parent)
        if before is not None and before < i - 1:
            edges.append((before, i, max(1, SIBLING * 2 // (i - before))))
        last[b.parent] = i
    return edges


def min_cut(score: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source when the cheapest cut is made (maximum flow by level graphs)."""
    n = len(score)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    arcs: list[list[int]] = [[] for _ in range(n + 2)]

    def add(u: int, v: int, forth: int, back: int):
        arcs[u].append(len(to))
        to.append(v)
        room.append(forth)
        arcs[v].append(len(to))
        to.append(u)
        room.append(back)

    for v, s in enumerate(score):
        if s > 0:
            add(source, v, s, 0)
        elif s < 0:
            add(v, sink, -s, 0)
    for u, v, w in edges:
        add(u, v, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for k in arcs[u]:
                if room[k] and level[to[k]] < 0:
                    level[to[k]] = level[u] + 1
                    queue.append(to[k])
        if level[sink] < 0:
            return [level[v] >= 0 for v in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                push = min(room[k] for k in path)
                for k in path:
                    room[k] -= push
                    room[k ^ 1] += push
                cut = next(i for i, k in enumerate(path) if not room[k])
                at = to[path[cut] ^ 1]
                del path[cut:]
            elif tried[at] < len(arcs[at]):
                k = arcs[at][tried[at]]
                if room[k] and level[to[k]] == level[at] + 1:
                    path.append(k)
                    at = to[k]
                else:
                    tried[at] += 1
            elif path:
                at = to[path.pop() ^ 1]
                tried[at] += 1
            else:
                break


def main_text(page: str | None) -> str:
    """Content blocks of a page, one per line; empty for an empty page."""
    blocks = blocks_of(page or "")
    for sentence in SENTENCE_WORDS:
        score = costs(blocks, sentence)
        if any(s > 0 for s in score):
            break
    if all(s > 0 for s in score):
        kept = [True] * len(blocks)
    elif all(s <= 0 for s in score):
        return ""
    else:
        kept = min_cut(score, neighbours(blocks))
    return "\n".join(b.text for b, k in zip(blocks, kept) if k)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of the html column (and of columns of those names).

    A page is cut into text blocks. Fixed costs per kind of evidence (the elements,
    classes and roles around a block, its length, sentence ends, share of link text)
    are the capacities to source and sink; blocks next to each other on the page or
    below one parent are tied by smoothness edges; the minimum cut separates content
    from the rest. Inside a block white space becomes one space and references are
    decoded; blocks are joined by a line feed.

    A NULL or empty page has the empty text; broken markup is read as far as it goes;
    rows are independent of each other, so repeated pages stay; no rows give no rows.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    kind = T.StructType([*[pages.schema[c] for c in kept], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(p.as_py()) for p in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], kind.names)

    return pages.select(*kept, F.col(html)).mapInArrow(run, kind)


@query("op1_html_extract")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
