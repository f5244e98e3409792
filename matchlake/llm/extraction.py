"""Main text of HTML pages by minimum-cut labelling of their blocks.

1. *Blocks.* A page is read tag by tag into an element tree; its text falls into
   blocks at block-level tags, with white space run together and character
   references decoded. Scripts, styles and other text that is never shown goes.
2. *Classifier.* Elements that say what they hold (``article``, ``main``, ``nav``,
   ``footer``, ``aside``, roles, class and id words) give most blocks a side. Over
   all pages, the looks of the blocks on the two sides (words, share of link text,
   tag, punctuation) are counted into naive Bayes odds, which judge blocks that no
   element speaks for and temper the others. The score is the cost of a label:
   the block's capacity to the content terminal if positive, else to the other.
3. *Minimum cut.* Neighbouring blocks are joined by edges that weaken with their
   distance in the tree, blocks of the same container by another. The maximum flow
   between the terminals gives the cheapest labelling; ties are no content. A block
   whose cost outweighs all its edges keeps its side in every minimum cut, so those
   are settled first and the flow runs over the rest.

Nothing is cut: pages of any length are read whole, in time near to linear unless
most blocks are undecided. Unclosed tags, comments and scripts end with the page.
Null and empty pages give an empty text, as do pages without content. Rows are
independent; repeated rows and extra columns pass through. A page is one task's work.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import text_slices
from matchlake.operators.small import small_rows

TAG = re.compile(r"""<(?:!--(?:-?>|.*?--!?>|.*)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)
                     (?P<more>(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+(?:>|\Z))|[!?/][^>]*+(?:>|\Z))""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*+)(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML: elements by how they lay out and nest.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
    pre search section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
          "tfoot": {"tbody", "thead", "tr", "td", "th"}}
WALLS = frozenset("table ul ol dl td th article section div body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KINDS = {"p": 1, "li": 2, "dt": 2, "dd": 2, "td": 3, "th": 3, "blockquote": 5, "pre": 5} | dict.fromkeys(HEADINGS, 4)

# What an element says about its text: NEVER shown, CHROME around an article (for all it holds), a FORM (chrome,
# but some pages are one form: an article inside overrules it) and WEAK signs of chrome, overruled too, CONTENT.
PLAIN, CONTENT, HEADLINE, WEAK, FORM, CHROME, NEVER = range(7)
TAG_SIDES = dict.fromkeys("noscript template svg canvas object audio video map".split(), NEVER) \
    | dict.fromkeys("nav footer aside menu dialog button select label fieldset legend search".split(), CHROME) \
    | {"form": FORM, "header": WEAK} | dict.fromkeys("article main".split(), CONTENT)
ROLE_SIDES = dict.fromkeys("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                           "toolbar tablist form".split(), CHROME) | dict.fromkeys("main article".split(), CONTENT)
WORD_SIDES = dict.fromkeys("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
    cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup share sharing social sidebar
    widget widgets related recommended recommendations menu nav navbar navigation breadcrumb breadcrumbs footer pagination
    pager comment comments reply replies respond disqus login toolbar copyright disclaimer teaser teasers skip notices
    banners popups alert alerts paywall topnav subnav navlinks menubar aside adsbygoogle feedback""".split(),
    CHROME) | dict.fromkeys("header masthead topbar meta byline tags".split(), WEAK) | dict.fromkeys("form search".split(), FORM) \
    | dict.fromkeys("article post entry content story main maincontent articlebody prose".split(), CONTENT)
LOOSE_WORDS = frozenset("with has no without wrapper container page layout outer".split())

#: Costs of the sides; the learned odds stay within ODDS. A decided block outweighs its edges.
COSTS = {PLAIN: 0.0, CONTENT: 5.0, WEAK: -4.0, FORM: -5.0, CHROME: -7.0}
HEADLINE_COSTS, ODDS = (4.0, -2.0), 2.5
NEAR, SAME = 0.9, 0.4  # edges between neighbours (over 1 + tree distance) and within a container
UNIT = 1000  # capacities are whole thousandths


# -- blocks ----------------------------------------------------------------


@dataclass
class Block:
    parent: int  # the element that holds it
    depth: int
    side: int
    kind: int
    text: str
    linked: int  # characters inside links


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    above: list[int] = field(default_factory=lambda: [-1])  # parent of each element


def side_of_names(value: str) -> int:
    """What class and id names say: the last known word of each name decides; names at odds say nothing."""
    said = set()
    for name in value.split():
        words = [w.lower() for w in NAME_PARTS.findall(name)]
        if not LOOSE_WORDS.intersection(words):
            said.update([WORD_SIDES[w] for w in words if w in WORD_SIDES][-1:])
    return said.pop() if len(said) == 1 else PLAIN


def own_side(name: str, more: str) -> int:
    """What an element's tag and attributes say about its text."""
    side = TAG_SIDES.get(name, PLAIN)
    if "=" not in more and "hidden" not in more or name in ("html", "body"):
        return side
    seen = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(more)}
    if "hidden" in seen or seen.get("aria-hidden", "").lower() == "true" \
            or re.search(r"(?i)display\s*:\s*none", seen.get("style", "")):
        return NEVER
    role = ROLE_SIDES.get(seen.get("role", "").lower(), PLAIN)
    names = side_of_names(f"{seen.get('class', '')} {seen.get('id', '')}")
    if seen.get("itemprop", "").lower() == "articlebody":
        names = CONTENT
    return max((side, role, names), key=lambda s: (s in (CHROME, NEVER), s == CONTENT and side != PLAIN, s))


def inner_side(outer: int, own: int) -> int:
    """The side of an element's text, from that of the element around it."""
    if outer in (CHROME, NEVER) and own != NEVER or own == PLAIN:
        return outer
    if outer in (CONTENT, HEADLINE) and own in (WEAK, FORM):
        return HEADLINE if own == WEAK else CHROME
    return own


def read_page(text: str) -> Page:
    """The blocks of a page, in order."""
    page = Page()
    above, blocks = page.above, page.blocks
    names, numbers, sides = ["#"], [0], [PLAIN]  # open elements
    open_count: Counter[str] = Counter()
    words: list[str] = []
    linked, at, n, low = 0, 0, len(text), None

    def flush() -> None:
        nonlocal linked
        if words:
            whole = " ".join("".join(words).split())
            if whole and sides[-1] != NEVER:
                k = len(names) - 1
                while k and names[k] not in BLOCKS:
                    k -= 1
                blocks.append(Block(numbers[k], k, sides[-1], KINDS.get(names[k], 0), whole, linked))
            words.clear()
        linked = 0

    def shut(k: int) -> None:
        """Closes the open elements from the k-th on."""
        if any(name in BLOCKS or sides[i] == NEVER for i, name in enumerate(names[k:], k)):
            flush()
        for name in names[k:]:
            open_count[name] -= 1
        del names[k:], numbers[k:], sides[k:]

    while at < n:
        tag = TAG.search(text, at)
        begin = tag.start() if tag else n
        if begin > at and sides[-1] != NEVER:
            run = text[at:begin]
            if "&" in run:
                run = html.unescape(run)
            words.append(run)
            if open_count["a"]:
                linked += len(run.strip())
        if tag is None:
            break
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if tag["end"]:
            if name == "br":
                words.append(" ")
            elif open_count[name]:
                k = len(names) - 1
                while names[k] != name:
                    k -= 1
                shut(k)
            continue
        more = tag["more"]
        if not more.endswith(">"):
            break  # a tag cut off by the page's end
        if name in RAW:
            low = text.lower() if low is None else low
            if len(low) != n:  # a letter whose lower case is longer: fold ASCII only
                low = text.translate({c: c + 32 for c in range(65, 91)})
            close = low.find(f"</{name}", at)
            at = n if close < 0 else close
            continue
        if name == "br":
            words.append(" ")
            continue
        if name in BLOCKS:
            flush()
            if open_count["p"]:
                shut(len(names) - 1 - names[::-1].index("p"))
        if name in CLOSES:
            ends, k = CLOSES[name], len(names) - 1
            if any(open_count[e] for e in ends):
                lowest = None
                while k and (names[k] in ends or names[k] not in WALLS):
                    if names[k] in ends:
                        lowest = k
                    k -= 1
                if lowest is not None:
                    shut(lowest)
        if name in VOID or more.endswith("/>") and name not in BLOCKS and name != "a":
            continue
        above.append(numbers[-1])
        side = inner_side(sides[-1], own_side(name, more))
        if side != sides[-1]:
            flush()
        names.append(name)
        numbers.append(len(above) - 1)
        sides.append(side)
        open_count[name] += 1
    flush()
    return page


# -- classifier ------------------------------------------------------------


def looks(block: Block) -> tuple[int, ...]:
    """Binned features that do not depend on what the elements say."""
    text = block.text
    return (min(text.count(" ").bit_length(), 9), 4 * min(block.linked, len(text)) // len(text), block.kind,
            text[-1] in ".!?:;\"'”»…)", min((text.count(",") + text.count(". ")).bit_length(), 4))


def learned(pages: DataFrame, text: str = "html") -> dict[tuple[int, int], float]:
    """Log odds of each (feature, bin), counted over the blocks of all pages
    whose elements say what they hold. A few dozen numbers."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[tuple[int, int, bool]] = Counter()
            for _, _, rows in text_slices(batch.column(0)):
                for raw in rows:
                    for b in read_page(raw.decode("utf-8", "replace")).blocks:
                        if b.side in (CONTENT, CHROME, FORM, WEAK):
                            seen.update((i, int(v), b.side == CONTENT) for i, v in enumerate(looks(b)))
            yield pa.RecordBatch.from_pylist([{"feature": i, "bin": v, "content": c, "n": n} for (i, v, c), n in seen.items()],
                                             pa.schema([("feature", pa.int32()), ("bin", pa.int32()),
                                                        ("content", pa.bool_()), ("n", pa.int64())]))

    parts = pages.select(text).mapInArrow(counted, "feature int, bin int, content boolean, n long")
    rows = small_rows(parts.groupBy("feature", "bin", "content").agg(F.sum("n").alias("n")), 500)
    counts = {(r["feature"], r["bin"], r["content"]): r["n"] for r in rows}
    total = Counter()
    for (i, _, c), n in counts.items():
        total[i, c] += n
    bins = Counter(i for i, _ in {(i, v) for i, v, _ in counts})

    def share(i: int, v: int, c: bool) -> float:
        return math.log((counts.get((i, v, c), 0) + 1.0) / (total[i, c] + bins[i]))

    return {(i, v): share(i, v, True) - share(i, v, False) for i, v, _ in counts if total[i, True] and total[i, False]}


def cost(block: Block, odds: dict[tuple[int, int], float]) -> float:
    """How much more the other label costs: positive for content."""
    like = sum(odds.get((i, int(v)), 0.0) for i, v in enumerate(looks(block)))
    said = HEADLINE_COSTS[block.kind != 4] if block.side == HEADLINE else COSTS[block.side]
    return said + max(-ODDS, min(ODDS, like))


# -- minimum cut -----------------------------------------------------------


def edges_of(page: Page) -> list[tuple[int, int, int]]:
    """(block, later block, capacity): neighbours, and blocks next to each other in one container's container."""
    blocks, above, out = page.blocks, page.above, []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            out.append((i - 1, i, round(UNIT * NEAR / (1 + tree_distance(above, a, b)))))
        outer = above[b.parent]
        if outer in last and last[outer] < i - 1:
            out.append((last[outer], i, round(UNIT * SAME)))
        last[outer] = i
    return out


def tree_distance(above: list[int], a: Block, b: Block, most: int = 8) -> int:
    """Steps between the containers of two blocks over their common ancestor (``most``: that or more)."""
    x, y, steps = a.parent, b.parent, 0
    while x != y and steps < most:  # a later element never lies above an earlier one
        if x > y:
            x = above[x]
        else:
            y = above[y]
        steps += 1
    return steps


def minimum_cut(capacity: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The side of each node in the minimum cut that has the fewest nodes on
    the source's side: ``capacity`` from the source if positive, to the sink if
    negative; undirected edges."""
    n = len(capacity)
    beside: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        if c > 0:
            beside[a].append((b, c))
            beside[b].append((a, c))
    left = list(capacity)  # the cost of a node given its settled neighbours
    slack = [sum(c for _, c in beside[i]) for i in range(n)]
    settled: list[bool | None] = [None] * n
    queue = deque(i for i in range(n) if left[i] > slack[i] or left[i] <= -slack[i])
    while queue:
        i = queue.popleft()
        if settled[i] is not None:
            continue
        settled[i] = left[i] > slack[i]
        for j, c in beside[i]:
            if settled[j] is None:
                left[j] += c if settled[i] else -c
                slack[j] -= c
                if left[j] > slack[j] or left[j] <= -slack[j]:
                    queue.append(j)
    open_nodes = [i for i in range(n) if settled[i] is None]
    if open_nodes:
        for i, side in zip(open_nodes, flow_sides(open_nodes, left, beside, settled), strict=True):
            settled[i] = side
    return [bool(s) for s in settled]


def flow_sides(nodes: list[int], left: list[int], beside: list, settled: list) -> list[bool]:
    """Sides by maximum flow (shortest augmenting layers) among unsettled nodes."""
    place = {i: k for k, i in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(len(nodes) + 2)]

    def join(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i in nodes:
        k = place[i]
        if left[i] > 0:
            join(source, k, left[i], 0)
        elif left[i] < 0:
            join(k, sink, -left[i], 0)
        for j, c in beside[i]:
            if i < j and settled[j] is None:
                join(k, place[j], c, c)
    while True:
        level = layers(out, to, room, source)
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(len(nodes))]
        nxt = [0] * len(out)
        while push(out, to, room, level, nxt, source, sink):
            pass


def layers(out: list[list[int]], to: list[int], room: list[int], source: int) -> list[int]:
    level = [-1] * len(out)
    level[source] = 0
    queue = deque([source])
    while queue:
        a = queue.popleft()
        for e in out[a]:
            if room[e] > 0 and level[to[e]] < 0:
                level[to[e]] = level[a] + 1
                queue.append(to[e])
    return level


def push(out, to, room, level, nxt, source: int, sink: int) -> bool:
    """Sends flow along one path of the layers; false if there is none left."""
    path: list[int] = []
    at = source
    while at != sink:
        while nxt[at] < len(out[at]):
            e = out[at][nxt[at]]
            if room[e] > 0 and level[to[e]] == level[at] + 1:
                break
            nxt[at] += 1
        else:
            if not path:
                return False
            at = to[path.pop() ^ 1]
            nxt[at] += 1
            continue
        path.append(e)
        at = to[e]
    flow = min(room[e] for e in path)
    for e in path:
        room[e] -= flow
        room[e ^ 1] += flow
    return True


# -- the operator ----------------------------------------------------------


def labelled_blocks(text: str, odds: dict[tuple[int, int], float]) -> list[tuple[Block, bool]]:
    """The blocks of a page with their label: content or not."""
    page = read_page(text)
    sides = minimum_cut([round(UNIT * cost(b, odds)) for b in page.blocks], edges_of(page))
    return list(zip(page.blocks, sides, strict=True))


def main_text(text: Column | str, odds: dict[tuple[int, int], float]) -> Column:
    """The content blocks of a page's HTML, one a line."""
    @arrow_udf("string")
    def extracted(texts: pa.Array) -> pa.Array:
        return pa.array(["\n".join(b.text for b, content in labelled_blocks(raw.decode("utf-8", "replace"), odds) if content)
                         for _, _, rows in text_slices(texts) for raw in rows], pa.string())

    return extracted(F.col(text) if isinstance(text, str) else text)
