"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its leaf blocks: stretches of text that no block-level tag interrupts, each with the
tags, classes and ids of its ancestors. The field has two states, text and rest; its features are ancestors, own tag and
traits of the text. It is trained by stochastic gradient steps on labelled pages and decoded by Viterbi.

Labelled pages are pages of the table whose blocks are labelled by an element that states its meaning (``article``,
``main``), and the same blocks set again in other layouts, so that the field also knows menus, notices, comments and
article bodies that are marked by classes alone.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.batches import slices, typed

#: Labelled pages taken from the table at most, other layouts made of each, weight of its own, rounds of training.
SAMPLE, LAYOUTS, OWN_LAYOUT, ROUNDS = 150, 10, 4, 5
RATE, DECAY, SEED = 0.3, 1e-5, 7

#: Fixed names of HTML. Content of the first is never text; the second end a block; the third have no end tag.
HIDDEN = "script style noscript template iframe svg math select textarea".split()
#: What stands inside these is shown only where they themselves cannot be; they nest, and one without an end tag is empty.
MEDIA = "object canvas audio video".split()
BLOCKS = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end an open tag of the same list.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: A paragraph ends where one of these begins.
ENDS_PARAGRAPH = BLOCKS - {"button", "caption", "legend", "option", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}

#: A hidden name is whole: ``svg-icon`` is another element. ``svg`` and ``math`` that close themselves have no content.
MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?:svg|math)(?=[\s/>])(?:[^>"'/]++|"[^"]*"|'[^']*'|/(?!>))*+/>"""
    r"|<(?P<raw>" + "|".join(HIDDEN) + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*'|["'])*?)>""", re.S | re.I,
)
NAMED = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
WORD = re.compile(r"[^\W\d_]+")
BREAKS = re.compile(r"<br\b[^>]*>", re.I)


class Block:
    """Text, ancestors as (tag, names) from outside in, and the characters inside links."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int) -> None:
        self.text, self.path, self.linked = text, path, linked


def names_of(rest: str) -> tuple[str, ...]:
    """Words of the classes, ids and roles of a tag."""
    if "=" not in rest and "hidden" not in rest.lower():
        return ()
    found = []
    for key, *values in NAMED.findall(rest):
        value = "".join(values).lower()
        if key.lower() in ("hidden", "aria-hidden"):
            found.append("hidden" if value != "false" else "")
        elif key.lower() == "style":
            found.append("hidden" if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else "")
        else:
            found.extend(re.split(r"[^a-z0-9]+", value))
    return tuple(x for x in found if x)


def end_of_media(page: str, tag: str, at: int) -> int:
    """Where an element ends whose start tag ends at ``at``: behind its own end tag, else behind the next one of that name,
    else at once."""
    depth, first = 1, at
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", page[at:], re.I):
        depth += -1 if m[1] else 1
        if m[1] and first == at:
            first = at + m.end()
        if not depth:
            return at + m.end()
    return first


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks of a page in order, character references decoded and white space made single."""
    found: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    pieces: list[tuple[str, bool]] = []
    links, at = 0, 0

    def close() -> None:
        text = " ".join(html.unescape("".join(x for x, _ in pieces)).split())
        if text:
            linked = sum(len(x) for x, inside in pieces if inside)
            found.append(Block(text, tuple(stack), min(linked, len(text))))
        pieces.clear()

    def leave(tags: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    for m in MARKUP.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            pieces.append((page[at:m.start()], links > 0))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in MEDIA and not m["end"]:
            at = end_of_media(page, tag, at)
            continue
        if tag == "a":
            links = 0 if m["end"] else 1
        elif tag == "br":
            pieces.append((" ", False))
        if tag not in BLOCKS:
            continue
        close()
        if m["end"]:
            if any(t == tag for t, _ in stack):
                leave({tag}, set())
        else:
            links = 0
            if tag in ENDS_PARAGRAPH:
                leave({"p"}, BLOCKS - {"p"})
            if tag in CLOSES:
                leave(CLOSES[tag], {"table", "ul", "ol", "dl", "menu", "select", "html"} | ({"tr"} if tag in ("td", "th") else set()))
            if tag not in VOID:
                stack.append((tag, names_of(m["rest"])))
    if at < len(page):
        pieces.append((page[at:], links > 0))
    close()
    return found


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features of each block."""
    known: dict[tuple, list[str]] = {}
    out = []
    for b in blocks:
        above = known.get(b.path)
        if above is None:
            tags = [t for t, _ in b.path if t not in ("html", "body")]
            above = [f"in:{t}" for t in dict.fromkeys(tags)]
            above += [f"name:{n}" for n in dict.fromkeys(n for _, ns in b.path for n in ns)]
            above += [f"own:{x}" for x in tags[-1:]] + ["bias"]
            known[b.path] = above
        text, words = b.text, b.text.count(" ") + 1
        linked = b.linked / len(text)
        mine = [f"words:{min(words.bit_length(), 8)}", f"links:{math.ceil(linked * 4)}"]
        if text[-1] in ".!?…:;\"'”»":
            mine.append("ends")
        if "©" in text or "®" in text:
            mine.append("right")
        out.append(above + mine)
    return out


class Field:
    """Weights of features in the state text (those of the state rest are their negatives) and of neighbours."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = defaultdict(float)
        self.stay, self.change = 0.0, 0.0

    def scores(self, rows: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in row]) for row in rows]

    def decode(self, scores: list[float]) -> list[bool]:
        """Viterbi: the most probable states."""
        best_text = best_rest = 0.0
        back = []
        for i, s in enumerate(scores):
            if not i:
                best_text, best_rest = s, -s
                continue
            text_from, rest_from = best_text + self.stay >= best_rest + self.change, best_rest + self.stay >= best_text + self.change
            back.append((text_from, rest_from))
            best_text, best_rest = (
                s + (best_text + self.stay if text_from else best_rest + self.change),
                -s + (best_rest + self.stay if rest_from else best_text + self.change),
            )
        if not scores:
            return []
        states = [best_text > best_rest]
        for text_from, rest_from in reversed(back):
            states.append(text_from if states[-1] else not rest_from)
        return states[::-1]

    def step(self, rows: list[list[str]], labels: list[bool], rate: float) -> None:
        """One gradient step on the log-likelihood of a page, by the forward-backward rule."""
        n, scores = len(rows), self.scores(rows)
        forward, backward = [(scores[0], -scores[0])], [(0.0, 0.0)] * n
        for s in scores[1:]:
            t, r = forward[-1]
            forward.append((s + log_sum(t + self.stay, r + self.change), -s + log_sum(t + self.change, r + self.stay)))
        for i in range(n - 2, -1, -1):
            t, r = backward[i + 1][0] + scores[i + 1], backward[i + 1][1] - scores[i + 1]
            backward[i] = (log_sum(t + self.stay, r + self.change), log_sum(t + self.change, r + self.stay))
        total = log_sum(*forward[-1])
        for i, row in enumerate(rows):
            chance = math.exp(forward[i][0] + backward[i][0] - total)
            gain = 2 * rate * (labels[i] - chance)
            if abs(gain) > 1e-6:
                for f in row:
                    self.weights[f] += gain - DECAY * self.weights[f]
        stays = expected = 0.0
        for i in range(n - 1):
            t, r = backward[i + 1][0] + scores[i + 1], backward[i + 1][1] - scores[i + 1]
            expected += math.exp(forward[i][0] + self.stay + t - total) + math.exp(forward[i][1] + self.stay + r - total)
            stays += labels[i] == labels[i + 1]
        self.stay += rate / n * (stays - expected)
        self.change -= rate / n * (stays - expected)


def log_sum(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log1p(math.exp(min(a, b) - high))


#: Parts of a page, or of its main element, that are not main text.
REST = {"nav", "aside", "footer", "form"}
#: Without a model: elements whose blocks are left out, and the share of links from which a block is one of a menu.
NEVER, LINKED = REST | {"head", "title", "header", "button", "select", "menu"}, 0.5


def main_element(blocks: list[Block]) -> tuple | None:
    """The element that states a page's main text: the outermost ``main``, else the outermost ``article``; of several, the
    one with most text. An entry of a path is one object for all blocks of its element."""
    for tag in ("main", "article"):
        sizes: dict[int, int] = {}
        elements = {}
        for b in blocks:
            if element := next((x for x in b.path if x[0] == tag), None):
                elements[id(element)] = element
                sizes[id(element)] = sizes.get(id(element), 0) + len(b.text)
        if sizes:
            return elements[max(sizes, key=sizes.get)]
    return None


def labelled(page: str) -> tuple[list[Block], list[bool]] | None:
    """Blocks and labels of a page with an element that states its main text; an article inside an article is a comment."""
    blocks = blocks_of(page)
    own = main_element(blocks)
    if own is None:
        return None
    tags = [[t for t, _ in b.path] for b in blocks]
    return blocks, [any(x is own for x in b.path) and not REST & {*t} and t.count("article") < 2 for b, t in zip(blocks, tags)]


#: Ways to set a page: containers of the main text and of everything else, as (tag, attributes).
BODIES = [("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="content"'), ("div", 'class="post-content"'),
          ("div", 'class="entry-content"'), ("div", 'class="article-body"'), ("section", 'class="story"'),
          ("div", 'class="main-text"'), ("article", 'class="post"'), ("div", 'itemprop="articleBody"'), ("div", 'id="main"'),
          ("div", 'class="post-body"'), ("div", 'class="text"'), ("div", 'role="main"'), ("section", ""), ("div", ""),
          ("td", ""), None]
BEFORE = [("nav", ""), ("header", ""), ("div", 'class="menu"'), ("ul", 'class="navigation"'), ("div", 'class="header"'),
          ("div", 'class="breadcrumb"'), ("div", 'class="cookie-notice"'), ("div", 'id="cookie-banner"'),
          ("div", 'class="notice"'), ("div", 'class="ad"'), ("div", 'class="advert banner"'), ("form", 'class="search"'),
          ("div", 'class="navbar"'), ("div", 'class="topbar"'), ("div", 'class="alert consent"')]
AFTER = [("footer", ""), ("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("div", 'class="related"'),
         ("section", 'class="comments"'), ("div", 'id="comments"'), ("div", 'class="comment"'), ("ol", 'class="comment-list"'),
         ("form", ""), ("div", 'class="newsletter"'), ("div", 'class="social share"'), ("div", 'class="footer"'),
         ("div", 'class="ads sponsored"'), ("div", 'class="promo widget"'), ("div", 'id="disqus_thread"'),
         ("div", 'class="popup modal"'), ("div", 'class="copyright"'), ("div", 'class="author-bio"'), ("div", 'class="tags"')]


def set_again(blocks: list[Block], labels: list[bool], dice: random.Random) -> tuple[list[Block], list[bool]]:
    """The blocks of a labelled page in another layout, labelled."""
    main, rest = [b for b, x in zip(blocks, labels) if x], [b for b, x in zip(blocks, labels) if not x] or blocks[:1]
    out: list[Block] = []
    marks: list[bool] = []

    def put(path, source: Block, label: bool) -> None:
        out.append(Block(source.text, tuple(path), source.linked))
        marks.append(label)

    def boxed(kind, path) -> None:
        tag, attributes = kind
        where = [*path, (tag, names_of(attributes))]
        for _ in range(dice.choice((1, 1, 2, 4))):
            # A comment or teaser reads like a paragraph of the article.
            source = dice.choice(rest if dice.random() < 0.5 else main)
            inner = dice.choice(([("p", ())], [("ul", ()), ("li", ())], [("li", ())], [("div", ())], [], [("h3", ())], [("h1", ())]))
            put([*where, *inner], source, False)

    root = [("html", ()), ("body", ())]
    if dice.random() < 0.7:
        put([("html", ()), ("head", ()), ("title", ())], main[0], False)
    outer = root + dice.choice(([], [], [("div", ("container",))], [("div", ("wrapper",))], [("div", ("page",))]))
    for kind in dice.sample(BEFORE, dice.choice((1, 2, 3))):
        boxed(kind, outer)
    kind = dice.choice(BODIES)
    body = [*outer, (kind[0], names_of(kind[1]))] if kind else outer
    if dice.random() < 0.2:
        body = [*body, (dice.choice(("article", "section", "div")), ())]
    middle = dice.randrange(1, len(main) + 1)
    for i, b in enumerate(main):
        if dice.random() < 0.2:
            b = Block(" ".join(b.text.split()[:dice.choice((1, 2, 3, 6))]), b.path, 0)
        if not i and kind and kind[0] in ("article", "main") and dice.random() < 0.2:
            put([*body, ("header", ()), ("h1", ())], b, True)
            continue
        own = "h1" if not i else dice.choice(("p", "p", "p", "p", "p", "h2", "li", "blockquote", "pre", "td", "figcaption"))
        inner = {"li": [("ul", ())], "td": [("table", ()), ("tr", ())], "figcaption": [("figure", ())]}.get(own, [])
        put([*body, *inner, (own, ())], b, True)
        if i == middle and dice.random() < 0.6:
            boxed(dice.choice(AFTER + BEFORE[5:]), body)
    for kind in dice.sample(AFTER, dice.choice((1, 2, 3, 4))):
        boxed(kind, outer)
    return out, marks


def train(pages: list[str]) -> Field | None:
    """A field from labelled pages and their other layouts; None without any."""
    dice, field = random.Random(SEED), Field()
    given = [x for x in map(labelled, pages) if x and any(x[1])]
    examples = [(features(b), y) for b, y in given] * OWN_LAYOUT
    for blocks, labels in given:
        for _ in range(LAYOUTS):
            again, marks = set_again(blocks, labels, dice)
            examples.append((features(again), marks))
    for turn in range(ROUNDS):
        dice.shuffle(examples)
        for rows, labels in examples:
            field.step(rows, labels, RATE / (1 + turn))
    field.weights = dict(field.weights)
    return field if examples else None


def learn(df: DataFrame, key: str = "page_id", page: str = "html") -> Field | None:
    """A field from at most ``SAMPLE`` labelled pages, drawn by the hash of their id."""
    stated = df.filter(F.lower(F.col(page)).rlike(r"<(article|main)[\s/>]")).select(
        F.xxhash64(F.col(key).cast("long"), F.col(page)).alias("place"), F.col(page).alias("html"))
    # SAMPLE numbers first, so that no task sends pages that are not drawn.
    last = stated.select("place").orderBy("place").limit(SAMPLE).agg(F.max("place")).first()[0]
    if last is None:
        return None
    sample = stated.filter(F.col("place") <= last).orderBy("place").limit(SAMPLE).select("html")
    return train([r[0] for r in sample.collect()])


def main_text(page: str, field: Field | None) -> str:
    """Blocks that the field takes for text, joined by spaces.

    Without a field: the element that states the main text where there is one, else all blocks, but for parts that are never
    main text and for blocks that are mostly links.
    """
    blocks = blocks_of(page)
    if field:
        keep = field.decode(field.scores(features(blocks)))
    else:
        own = main_element(blocks)
        keep = [(own is None or any(x is own for x in b.path)) and not NEVER & {t for t, _ in b.path}
                and b.linked < LINKED * len(b.text) for b in blocks]
    return " ".join(b.text for b, k in zip(blocks, keep) if k)


def extract(df: DataFrame, field: Field | None, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null page or one without main text gives an empty text. Repeated rows give repeated rows; other columns are not
    read; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)
    schema = "page_id long, url string, text string, n_chars long"

    def run(batches):
        field = shared.value
        for part in slices(batches):
            texts = [main_text(x or "", field) for x in part["h"]]
            yield pa.RecordBatch.from_pydict({
                "page_id": part["k"], "url": pa.array(part["u"], pa.string()), "text": texts, "n_chars": [*map(len, texts)],
            })

    columns = df.select(df[key].cast("long").alias("k"), df[url].cast("string").alias("u"), df[page].cast("string").alias("h"))
    return columns.mapInArrow(typed(run, schema), schema)
