"""Main text of web pages by consensus of a host's pages."""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch

# Elements whose content is read as it stands, up to their end, and is no text of the page.
_RAW = "script|style|textarea|title"
# Elements whose text is left out, without a break in the text around them; an unclosed one ends with its parent block,
# or where a block begins if no end tag follows at all.
_SILENT = frozenset("noscript template svg iframe canvas select button annotation annotation-xml".split())
# Up to the end of a tag: a quote is read as one of a pair if it has a partner and the tag then ends,
# and else as a character. Nothing is tried twice, so the time does not depend on the quotes.
_TAG_REST = r"""(?:(?:"[^"]*"|'[^']*'|[^>"']+|["'])*+(?=>)|[^>]*+)"""
_MARKUP = re.compile(
    rf"<!--.*?(?P<comment>-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?P<cdata_end>\]\]>|\Z)"
    rf"|<(?P<raw>{_RAW})\b{_TAG_REST}(?:(?<=/)>|>.*?(?P<raw_end></(?P=raw)\s*>|\Z))"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{_TAG_REST})>"
    r"|<[!?/][^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
# A tag or comment that the end of the page cuts off.
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_BLOCKS = frozenset(
    "html body head main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address header footer nav aside form fieldset hr center details summary".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("html body main article section div td center".split())
_SEMANTIC = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that are never part of the main text.
_ASIDES = frozenset("nav footer aside form head dialog menu label".split())
# Elements whose ids and classes name their content, not a part of the page.
_PHRASES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption".split())
# Words in classes, ids and roles that mark what surrounds the main text,
_ASIDE_WORD = re.compile(
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|"
    r"footer|masthead|sidebar|aside|complementary|contentinfo|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"comments?|commentlist|disqus|replies|respond|responses|share|sharing|social|related|recommend\w*|newsletter|"
    r"subscribe|subscription|signup|login|search|pagination|pager|widgets?|toolbar|skiplink|tags|taglist|copyright|"
    r"siteheader|pageheader|topbar|paywall"
)
# and words that say nothing beside them; a name with any other word is of content.
_LAYOUT_WORD = re.compile(
    r"[a-z]?\d*|js|main|site|page|global|primary|secondary|top|bottom|left|right|upper|lower|inner|outer|mini|small|large|"
    r"sticky|fixed|float\w*|mobile|desktop|bar|box(?:es)?|block|area|section|region|wrap|wrapper|container|content|"
    r"holder|panel|pane|row|col|column|grid|group|list|items?|links?|buttons?|btns?|icons?|tools?|form|field|input|slot|"
    r"unit|zone|head|header|title|body|text|posts?|articles?|entry|entries|stor(?:y|ies)|news|media|thread|policy|"
    r"message|dialog|cta|skip|side|tag|badge|label|card|module|component|the|and|for|to|us|you|your|more|view|"
    r"google|facebook|twitter|dfp|gpt|display|native|video|image|img|html|cloud|meta|info|nav|in|up|sign|recent|latest"
)
# A host's path with a smaller share of a page's text is not the one of its main text.
_LEAST_SHARE = 0.2
_SAME_ITEM = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_ITEM_ENDS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


# Longer paths are written by a hash of their beginning, so nesting costs no more than its tags.
_LONGEST_PATH = 400
# Beyond this depth a container is no better for being deeper.
_DEEPEST = 50


@dataclass
class Block:
    """A run of text between block boundaries, with the innermost container around it (or -1)."""

    container: int
    aside: bool
    tag: str = ""
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @cached_property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())

    @property
    def value(self) -> int:
        return 0 if self.aside else max(0, len(self.text) - 2 * self.linked)


@dataclass
class Page:
    """Blocks in order, and of each container its path, tag, depth and the container above it (or -1)."""

    blocks: list[Block]
    paths: list[str]
    tags: list[str]
    depths: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)

    def summed(self, own: list[int]) -> list[int]:
        """Numbers of containers with those of the containers inside; a container comes after the one above it."""
        total = list(own)
        for c in range(len(total) - 1, -1, -1):
            if self.above[c] >= 0:
                total[self.above[c]] += total[c]
        return total


class _Open:
    """The open elements. Where those of a kind are is kept beside them, so that no question searches the stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[list[int], ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks, self.silent, self.asides, self.links, self.semantic = [], [], [], [], []
        self.containers: list[int] = []
        self.container_places: list[int] = []

    def last(self, tag: str) -> int:
        at = self.places.get(tag)
        return at[-1] if at else -1

    def push(self, tag: str, aside: bool, container: int) -> None:
        place = len(self.stack)
        kinds = [self.places.setdefault(tag, [])]
        for wanted, kind in (
            (tag in _BLOCKS, self.blocks),
            (tag in _SILENT, self.silent),
            (aside, self.asides),
            (tag == "a", self.links),
            (tag in _SEMANTIC, self.semantic),
            (container >= 0, self.container_places),
        ):
            if wanted:
                kinds.append(kind)
        for kind in kinds:
            kind.append(place)
        if container >= 0:
            self.containers.append(container)
        self.stack.append((tag, tuple(kinds)))

    def cut(self, depth: int) -> None:
        """End all elements from this one on."""
        while len(self.stack) > depth:
            _, kinds = self.stack.pop()
            for kind in kinds:
                kind.pop()
            if len(self.containers) > len(self.container_places):
                self.containers.pop()


def _step(tag: str, attributes: str) -> str:
    """A path step: the tag and its first class, with numbers generalised."""
    classed = re.search(r"""\bclass\s*=\s*["']?\s*([^\s"'>]+)""", attributes, re.IGNORECASE) if attributes else None
    return f"{tag}.{re.sub(r'[0-9]+', '#', classed[1].lower())}" if classed else tag


def _marks(name: str) -> bool:
    """Whether a class, id or role is made of words of page furniture alone."""
    name = re.sub(r"(side|comment|skip|tag|site|page|top)[_-]+(bar|list|link|header)(?=$|[_-])", r"\1\2", name.lower())
    words = re.split(r"[_-]+", name)
    aside = [bool(_ASIDE_WORD.fullmatch(w)) for w in words]
    return any(aside) and all(a or _LAYOUT_WORD.fullmatch(w) for a, w in zip(aside, words))


@lru_cache(maxsize=50_000)
def _read_attributes(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes hide an element, and whether its class, id or role marks page furniture."""
    values: dict[str, str] = {}
    for name, *value in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), references.unescape("".join(value)))
    hidden = (
        "hidden" in values
        or values.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NOT_SHOWN.search(values.get("style", "")))
    )
    return hidden, any(_marks(n) for key in ("class", "id", "role") for n in values.get(key, "").split())


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _ASIDES or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    hidden, marked = _read_attributes(attributes)
    if hidden or not marked or tag in _SEMANTIC or tag in _HEADINGS:
        return hidden
    return not in_article or (tag in _BLOCKS and tag not in _PHRASES)


def _path(above: str, step: str) -> str:
    if len(above) > _LONGEST_PATH:
        above = f"/#{xxhash.xxh64_hexdigest(above.encode())}"
    return f"{above}/{step}"


def _tokens(document: str) -> Iterator[tuple[str, re.Match | None]]:
    """Text and the markup behind it, in turn; nothing is a tag that has no end."""
    end = document.rfind(">") + 1
    at = 0
    for found in _MARKUP.finditer(document, 0, end):
        yield document[at : found.start()], found
        at = found.end()
        # What is still open where the last tag of the page ends, goes on to the end of the page.
        if "" in (found["comment"], found["cdata_end"], found["raw_end"]):
            if found["cdata"] is not None:
                yield document[end:], None
            return
    rest = document[at:]
    cut = _CUT_OFF.search(rest, end - at if end > at else 0)
    yield rest[: cut.start()] if cut else rest, None


def parse(document: str) -> Page:
    """The page's text blocks in order; unclosed and stray tags are put up with.

    The work grows with the length of the page, however deep its elements nest. A tag that the
    end of the page cuts off is no text.
    """
    opened = _Open()
    page = Page([], [], [])
    block: Block | None = None

    def put(text: str) -> None:
        nonlocal block
        if opened.silent:
            return
        if block is None:
            if not text.strip():
                return
            inner = opened.stack[opened.blocks[-1]][0] if opened.blocks else ""
            block = Block(opened.containers[-1] if opened.containers else -1, bool(opened.asides), inner)
            page.blocks.append(block)
        block.parts.append(text)
        if opened.links:
            block.linked += len(text.strip())

    ends: dict[str, int] = {}
    lowered = ""

    def last_end(tag: str) -> int:
        nonlocal lowered
        if tag not in ends:
            lowered = lowered or document.lower()
            ends[tag] = lowered.rfind(f"</{tag}")
        return ends[tag]

    for text, found in _tokens(document):
        if text:
            put(references.unescape(text))
        if found is None:
            continue
        if (cdata := found["cdata"]) is not None:
            put(cdata)
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        is_block = tag in _BLOCKS
        if is_block:
            block = None
        if tag == "br":
            put(" ")
        if found["close"]:
            depth = opened.last(tag)
            if depth >= 0 and (is_block or not opened.blocks or opened.blocks[-1] < depth):
                if opened.asides and opened.asides[-1] >= depth:
                    block = None
                opened.cut(depth)
            continue
        attributes = found["attributes"] or ""
        if tag in _VOID or attributes.endswith("/") and not is_block:
            continue
        if is_block:
            if opened.silent and found.end() > last_end(opened.stack[opened.silent[0]][0]):
                opened.cut(opened.silent[0])
            if (open_p := opened.last("p")) >= 0:
                opened.cut(open_p)
        if tag in _ITEM_ENDS:
            same = max(opened.last(t) for t in _SAME_ITEM.get(tag, (tag,)))
            if same > max(opened.last(t) for t in _ITEM_ENDS[tag]):
                opened.cut(same)
        container = -1
        if tag in _CONTAINERS:
            above = opened.containers[-1] if opened.containers else -1
            container = len(page.paths)
            page.paths.append(_path(page.paths[above] if above >= 0 else "", _step(tag, attributes)))
            page.tags.append(tag)
            page.depths.append(page.depths[above] + 1 if above >= 0 else 1)
            page.above.append(above)
        aside = _is_aside(tag, attributes, bool(opened.semantic))
        if aside:
            block = None
        opened.push(tag, aside, container)
    return page


def score_containers(page: Page) -> dict[str, float]:
    """A score per generalised path: its share of the page's text, less links, deeper ones first."""
    chars = [0] * len(page.paths)
    total = 0
    for block in page.blocks:
        total += block.value
        if block.container >= 0:
            chars[block.container] += block.value
    scores: dict[str, float] = {}
    for path, tag, depth, n in zip(page.paths, page.tags, page.depths, page.summed(chars)):
        share = n / total if total else 0.0
        if share > 0:
            more = share * share * (1 + 0.01 * min(depth, _DEEPEST)) + (0.5 * share if tag in _SEMANTIC else 0.0)
            scores[path] = scores.get(path, 0.0) + more
    return scores


def _with_headings(page: Page, chosen: set[int]) -> set[int]:
    """The containers, each extended to its parent as long as that has headings or paragraphs beside it.

    What else the parent has comes along, unless most of it is links. The whole page is taken only if the
    rest is headings and paragraphs alone.
    """
    n = len(page.paths)
    blocks, chars, linked, own = [0] * n, [0] * n, [0] * n, [0] * n
    for block in page.blocks:
        if block.aside or block.container < 0:
            continue
        size = len(block.text)
        blocks[block.container] += 1
        chars[block.container] += size
        linked[block.container] += block.linked
        if (block.tag in _HEADINGS or block.tag == "p") and size > 2 * block.linked:
            own[block.container] += 1
    blocks, chars, linked = page.summed(blocks), page.summed(chars), page.summed(linked)
    reached: dict[int, int] = {}
    for start in sorted(chosen):
        c, passed = start, []
        while c not in reached and (parent := page.above[c]) >= 0:
            rest = blocks[parent] - blocks[c]
            if page.tags[parent] in ("html", "body"):
                wanted = own[parent] == rest
            else:
                wanted = own[parent] > 0 and 2 * (linked[parent] - linked[c]) <= chars[parent] - chars[c]
            # A wrapper with nothing of its own is passed, for what is beside it.
            if rest and not wanted:
                break
            passed.append(c)
            c = parent
        for p in (*passed, c):
            reached[p] = reached.get(c, c)
    return {reached[c] for c in chosen}


def _inside(page: Page, chosen: set[int]) -> list[bool]:
    """Whether each container is one of the chosen ones or inside one."""
    inside: list[bool] = []
    for c, above in enumerate(page.above):
        inside.append(c in chosen or (above >= 0 and inside[above]))
    return inside


def extract(page: Page, path: str | None) -> str:
    """The text of the blocks under the containers of ``path`` and the headings that go with them.

    If ``path`` has little of the page's text, the page's own best path is read instead.
    """
    chosen = {c for c, p in enumerate(page.paths) if p == path}
    inside = _inside(page, chosen)
    here = sum(b.value for b in page.blocks if b.container >= 0 and inside[b.container])
    if not here or here < _LEAST_SHARE * sum(b.value for b in page.blocks):
        scores = score_containers(page)
        best = max(scores, key=lambda p: (scores[p], p), default=path)
        chosen = {c for c, p in enumerate(page.paths) if p == best}
    inside = _inside(page, _with_headings(page, chosen))
    everything = not page.paths or not chosen
    wanted = (b for b in page.blocks if not b.aside and (everything or b.container >= 0 and inside[b.container]))
    return "\n".join(t for t in (b.text for b in wanted) if t)


def _decode(value: bytes | None) -> str:
    return (value or b"").decode("utf-8", "replace")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, str], float] = {}
        pages = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
        for host, document in pages:
            for path, score in score_containers(parse(_decode(document))).items():
                sums[host, path] = sums.get((host, path), 0.0) + score
        yield pa.record_batch(
            [
                pa.array([k[0] for k in sums], pa.string()),
                pa.array([k[1] for k in sums], pa.string()),
                # Whole units, so that the order of addition changes no vote.
                pa.array([round(v * 1e6) for v in sums.values()], pa.int64()),
            ],
            names=["host", "path", "score"],
        )


def _extractions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist())
        found = [extract(parse(_decode(document)), path) for document, path in pages]
        yield pa.record_batch(
            [*batch.columns[2:], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
            names=[*batch.schema.names[2:], "text", "n_chars"],
        )


_MAX_HOSTS_SENT = 200_000


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): each host's winning path. Votes are added up per task before they meet."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("document"))
    votes = rows.mapInArrow(_votes, "host string, path string, score long")
    sums = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    return sums.groupBy("host").agg(F.max_by("path", F.struct("score", "path")).alias("path"))


def extract_pages(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", columns: list[str] | None = None
) -> DataFrame:
    """Adds ``text`` and ``n_chars`` to every page.

    The pages of a host vote, with the scores of their containers, for a path of tags
    and classes; each page is then read at the winning path, or where that has
    little of its text, at its own best one, and with the headings and paragraphs beside it. Menus, headers, footers, notices, adverts, forms
    and comments are left out. A NULL or empty page has an empty text; a NULL url
    counts as the host ''; repeated rows are read each; other columns stay (or
    those in ``columns``) unless they have the new names; an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "pages")
    winners = scratch.save(host_paths(pages, url_col, html_col), "hosts")
    if winners.count() <= _MAX_HOSTS_SENT:
        winners = F.broadcast(winners)
    columns = [c for c in (pages.columns if columns is None else columns) if c not in ("text", "n_chars")]
    rows = pages.select(
        host_of(F.col(url_col)).alias("_host"), F.col(html_col).cast("string").alias("_document"), *columns
    )
    rows = rows.join(winners, F.col("_host") == F.col("host"), "left").select("_document", "path", *columns)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[2:])
    return rows.mapInArrow(_extractions, f"{kept}text string, n_chars long")
