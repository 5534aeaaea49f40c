"""Main text of web pages by wrapper induction: what pages of a host share is template, what varies between them is content.

A page becomes a tree of its block elements, with runs of like siblings (of containers: long runs) folded
into one node.  Trees of a host's pages are
aligned by simple tree matching (equal labels; the ordered children that match in most nodes) and merged into the host's
wrapper: one slot per node, with the pages that hold it and its characters inside and outside of links.  Wrappers of parts of a
host merge the same way, so they are built in every task, then by salt, then by host: all pages take part and no task
holds all pages of a host.  From the wrapper follow, for every page of the host,

- slots that are no content by their element or their class, id or role names (menus, headers, footers, sidebars, notices,
  adverts, forms, comments), unless the names cover over half of a host's text, and lists of links;
- the region of the article: ``article`` or ``main`` slots, or else the container that most of the remaining text is in;
- constant texts: a text that stands in the same slot of over CONSTANT of a host's different pages, and at least LEAST of
  them, is template.  They are counted exactly over all pages; pages with the same texts count once.

Character references are decoded, white space within a block becomes one space, blocks are joined in page order.  Scripts,
styles, comments and hidden elements are never text.  Blocks deeper than DEPTH elements belong to their ancestor there.
A wrapper holds every slot of its host's pages, those of a single page as well: it grows with what its pages differ in.

Results: null and empty html gives the empty text; a page whose url has no host shares a wrapper with all such pages;
unclosed, misnested and cut-off markup is read as far as it goes; very long pages are read whole; repeated rows all return;
an empty table gives an empty table.
"""

from __future__ import annotations

import html as references
import json
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import per_slice, slices
from silverlode.llm.linededup import host_of
from silverlode.session import materialize, scratch_path

CONSTANT, LEAST = 0.8, 4
DEPTH, SHAPES, HOSTS, SALTS, LONG_RUN = 100, 2000, 2000, 64, 8
#: Children of two nodes are aligned in full up to so many pairs, beyond it in order of their labels.
PAIRS = 40_000
#: Share of the remaining text that a container holds if the article lies in it; share of links that makes a menu.
REGION, LINKS = 0.7, 0.6

# Elements (fixed values).
_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes|template|noscript|svg"
_BLOCKS = frozenset(
    "html head body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table caption "
    "thead tbody tfoot tr td th form fieldset legend details summary dialog menu address hr center option select button optgroup datalist".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never content, wherever they stand.
_AWAY = frozenset("head nav aside footer form fieldset dialog menu select button datalist option optgroup".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_ALWAYS = frozenset("html body main".split())
#: What an element's start closes: (elements, not beyond these).
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "body": ({"head"}, set()),
}
_FLOW = frozenset("p h2 h3 h4 h5 h6 blockquote pre dl figure".split())
_CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
#: Words of class and id names that stand for no content, alone or anywhere in a name (fixed values).
_WORDS = re.compile(
    r"^(?:ads?|adv|adbox|adslot|adunit|adsense|banner|nav|navigation|foot|masthead|topbar|toolbar|header|side|rail|aside|notice|notices|notification|consent|gdpr|alert|popup|"
    r"modal|overlay|promo|promotion|share|sharing|social|signup|signin|login|search|related|recommended|recommendations|widget|widgets|pager|pagination|skip|copyright|"
    r"disqus|respond|reply|replies|feedback|discussion|responses|hidden)$|advert|comment|cookie|sidebar|footer|navbar|menu|breadcrumb|newsletter|sponsor|subscri"
)
_INLINE_WORDS = re.compile(r"^(?:ads?|adv|adbox|adslot|adunit|adsense|promo)$|advert|sponsor")
_CONTENT_WORDS = frozenset("article post entry content main body story text".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*+>|\Z)|<[!?][^>]*+>?"
    r"|</(?P<end>[a-z][^\s/>]*+)[^>]*+>?|<(?P<start>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?",
    re.I | re.S,
)
_NAMES = re.compile(r"(?i)(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Slot:
    """A node of a page's tree or of a wrapper.  ``hint``: 1 by its names, 2 by its element; ``into``: what it was merged into."""

    __slots__ = ("label", "hint", "pages", "chars", "links", "kids", "into", "key", "keep")

    def __init__(self, label: str, hint: int, pages: int = 1, chars: int = 0, links: int = 0, kids: list[Slot] | None = None):
        self.label, self.hint, self.pages, self.chars, self.links, self.kids = label, hint, pages, chars, links, kids or []
        self.into: Slot | None = None
        self.key, self.keep = 0, True

    @property
    def tag(self) -> str:
        return self.label.partition(".")[0].rstrip("!")

    def final(self) -> Slot:
        slot = self
        while slot.into is not None:
            slot = slot.into
        return slot

    def shape(self) -> str:
        return f"{self.label}{self.hint}({''.join(k.shape() for k in self.kids)})"

    def walk(self) -> Iterator[Slot]:
        yield self
        for kid in self.kids:
            yield from kid.walk()

    def packed(self) -> list:
        return [self.label, self.hint, self.pages, self.chars, self.links, [k.packed() for k in self.kids]]


def unpacked(row: list) -> Slot:
    return Slot(*row[:5], [unpacked(k) for k in row[5]])


def _hint(tag: str, rest: str, in_article: bool, block: bool) -> tuple[str, int]:
    """(name, hint) of an element: its first class without digits; 2 for elements that are never content, 1 for such names.

    Within a line only adverts go by their names.
    """
    words = _WORDS if block else _INLINE_WORDS
    if tag in _AWAY or (tag == "header" and not in_article):
        return "", 2
    name, hint = "", 0
    for key, value in _NAMES.findall(rest) if rest.strip() else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"(?i)display\s*:\s*none", value)):
            return name, 2
        if key == "role" and value.lower() in _ROLES and tag not in _ALWAYS:
            hint = 2
        if key in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in _PARTS.findall(word)]
                if key == "class" and not name:
                    name = "-".join(parts)
                for p in parts:
                    if tag not in _ALWAYS and words.search(p) and not (p in ("header", "banner", "side") and (in_article or _CONTENT_WORDS.intersection(parts))):
                        hint = max(hint, 1)
    return name, hint


def _ordered(a: list[Slot], b: list[Slot], weight) -> list[tuple[int, int]]:
    """The pairs (i, j), both rising, whose weights add up to most."""
    if [x.label for x in a] == [y.label for y in b]:
        return [(k, k) for k in range(len(a))]
    if len(a) * len(b) > PAIRS:
        pairs, start = [], 0
        for j, y in enumerate(b):
            i = next((i for i in range(start, len(a)) if a[i].label == y.label), None)
            if i is not None:
                pairs.append((i, j))
                start = i + 1
        return pairs
    w = [[weight(x, y) if x.label == y.label else 0 for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w[i][j] if w[i][j] else 0)
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if w[i][j] and best[i][j] == best[i + 1][j + 1] + w[i][j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return pairs


def matching(a: Slot, b: Slot) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired in order, each below a pair."""
    if a.label != b.label:
        return 0
    return 1 + sum(matching(a.kids[i], b.kids[j]) for i, j in _ordered(a.kids, b.kids, matching))


def merge(a: Slot, b: Slot, pages: bool = True) -> None:
    """Slot ``b`` becomes part of ``a``; children that do not match are put where they stand in order."""
    b.into = a
    a.hint = max(a.hint, b.hint)
    a.pages = a.pages + b.pages if pages else max(a.pages, b.pages)
    a.chars, a.links = a.chars + b.chars, a.links + b.links
    if not b.kids:
        return
    kids, i, j = [], 0, 0
    for x, y in [*_ordered(a.kids, b.kids, matching), (len(a.kids), len(b.kids))]:
        kids += a.kids[i:x] + b.kids[j:y]
        if x < len(a.kids):
            merge(a.kids[x], b.kids[y], pages)
            kids.append(a.kids[x])
        i, j = x + 1, y + 1
    a.kids = _folded(kids, pages)


def _folded(kids: list[Slot], pages: bool = False) -> list[Slot]:
    """Runs of siblings with one label as one slot, those of containers only if they are long; within a page that counts once."""
    out: list[Slot] = []
    for _, run in groupby(kids, lambda kid: kid.label):
        first, *others = run
        if first.tag in _CONTAINERS and len(others) < LONG_RUN:
            out += [first, *others]
        else:
            for kid in others:
                merge(first, kid, pages)
            out.append(first)
    return out


class Page:
    """A page's folded tree and its blocks of text: (slot, text) in page order."""

    def __init__(self, html: str | None):
        self.root = Slot("page", 0)
        self.blocks: list[tuple[Slot, str]] = []
        self._read(html or "")
        self._fold(self.root)

    def _fold(self, slot: Slot) -> None:
        for kid in slot.kids:
            self._fold(kid)
        slot.kids = _folded(slot.kids)

    def _read(self, html: str) -> None:
        # open elements: (tag, slot or None for an inline one, hidden)
        stack: list[tuple[str, Slot | None, bool]] = [("page", self.root, False)]
        slots, tags = [self.root], ["page"]  # open block elements
        run: list[str] = []
        links = hidden = articles = linked = 0

        def flush() -> None:
            nonlocal linked
            text = " ".join(references.unescape("".join(run)).split()) if run else ""
            if text:
                slot = slots[-1]
                inside = min(len(text), linked)
                slot.chars, slot.links = slot.chars + len(text) - inside, slot.links + inside
                self.blocks.append((slot, text))
            run.clear()
            linked = 0

        def close() -> None:
            nonlocal links, hidden, articles
            tag, slot, away = stack.pop()
            if slot is not None:
                flush()
                slots.pop()
                tags.pop()
            links -= tag == "a"
            articles -= tag in ("article", "main")
            hidden -= away

        def close_to(tags: set[str], limit: set[str]) -> None:
            """Closes the outermost open element of ``tags`` that is not beyond one of ``limit``."""
            found = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in tags:
                    found = k
                elif stack[k][0] in limit:
                    break
            while found is not None and len(stack) > found:
                close()

        def say(text: str) -> None:
            nonlocal linked
            if text and not hidden:
                run.append(text)
                if links:
                    linked += len(text)

        at = 0
        for m in _TOKEN.finditer(html):
            say(html[at : m.start()])
            at = m.end()
            if m["start"]:
                tag = m["start"].lower()
                if tag == "br":
                    say(" ")
                    continue
                block = tag in _BLOCKS
                if block:
                    if tags[-1] == "p":
                        close_to({"p"}, set(_BLOCKS - {"p"}))
                    if tag in _CLOSES:
                        close_to(*_CLOSES[tag])
                    elif tag not in ("html", "head") and any(s[0] == "head" for s in stack[:4]):
                        close_to({"head"}, set())
                    flush()
                if tag in _VOID or m["rest"].endswith("/") and not block:
                    continue
                if not block and not m["rest"].strip() and tag != "a":
                    stack.append((tag, None, False))
                    continue
                name, hint = _hint(tag, m["rest"], articles > 0, block)
                if not block:
                    stack.append((tag, None, hint > 0))
                    hidden += hint > 0
                    links += tag == "a"
                    continue
                slot = slots[-1]
                if len(slots) <= DEPTH:
                    label = ("flow" if tag in _FLOW else "list" if tag in ("ul", "ol") else tag) + (f".{name}" if name else "") + "!" * hint
                    slot = Slot(label, hint)
                    slots[-1].kids.append(slot)
                slots.append(slot)
                tags.append(tag)
                articles += tag in ("article", "main")
                stack.append((tag, slot, False))
            elif m["end"]:
                tag = m["end"].lower()
                if tag == "br":
                    say(" ")
                elif any(s[0] == tag for s in stack[1:]):
                    while stack[-1][0] != tag:
                        close()
                    close()
        say(html[at:])
        while len(stack) > 1:
            close()
        flush()


# ---- wrappers of hosts

_WRAPPER = "host string, wrapper string"


def _packed(wrapper: Slot) -> str:
    return json.dumps(wrapper.packed(), separators=(",", ":"))


class _Host:
    """A wrapper that grows by pages; pages of a known shape only add up."""

    def __init__(self) -> None:
        self.root = Slot("page", 0, 0)
        self.shapes: dict[str, list[Slot]] = {}

    def add(self, page: Slot) -> None:
        shape = page.shape()
        known = self.shapes.get(shape)
        if known is None:
            slots = list(page.walk())
            merge(self.root, page)
            if len(self.shapes) < SHAPES:
                self.shapes[shape] = slots
        else:
            for slot, new in zip(known, page.walk()):
                held = slot.final()
                held.pages, held.chars, held.links = held.pages + 1, held.chars + new.chars, held.links + new.links


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow`` over (host, html): the wrappers of the hosts among a task's pages."""
    hosts: dict[str | None, _Host] = {}

    def out() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array([_packed(h.root) for h in hosts.values()], pa.string())], names=["host", "wrapper"])
        hosts.clear()
        return found

    for batch in slices(batches, "html"):
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            hosts.setdefault(host, _Host()).add(Page(html).root)
        if len(hosts) > HOSTS:
            yield out()
    if hosts:
        yield out()


def _merged(rows: pa.Table) -> pa.Table:
    """For ``applyInArrow``: some wrappers of one host as one."""
    whole = Slot("page", 0, 0)
    for packed in sorted(rows["wrapper"].to_pylist()):
        merge(whole, unpacked(json.loads(packed)))
    return pa.table([rows["host"].slice(0, 1), pa.array([_packed(whole)], pa.string())], names=["host", "wrapper"])


def induced(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of all hosts of ``pages`` (host, html)."""
    parts = materialize(pages.select("host", "html").mapInArrow(_induce, _WRAPPER), "wrappers")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInArrow(_merged, _WRAPPER)
    return materialize(some.groupBy("host").applyInArrow(_merged, _WRAPPER), "wrappers")


# ---- texts by wrapper


def _totals(slot: Slot, sums: dict[int, tuple[int, int]]) -> tuple[int, int]:
    chars, links = slot.chars, slot.links
    for kid in slot.kids:
        c, n = _totals(kid, sums)
        chars, links = chars + c, links + n
    sums[id(slot)] = chars, links
    return chars, links


def _mark(slot: Slot, whole: int, sums: dict, keep: bool = True, in_flow: bool = False) -> int:
    """Sets ``keep`` by hints and links; returns the characters that are kept."""
    chars, links = sums[id(slot)]
    named = slot.hint == 2 or (slot.hint == 1 and 2 * (chars + links) <= whole)
    menu = slot.tag not in ("flow", "page", "html", "body", "article", "main") and not in_flow and links > LINKS * (chars + links)
    slot.keep = keep and not named and not menu
    kept = (slot.chars + slot.links) * slot.keep
    for kid in slot.kids:
        kept += _mark(kid, whole, sums, slot.keep, in_flow or slot.tag == "flow")
    sums[id(slot)] = kept, 0
    return kept


def _regions(root: Slot, kept: dict[int, int]) -> list[Slot]:
    """The slots that hold the article."""
    for tags in (("article",), ("main",)):
        found = [s for s in root.walk() if s.tag in tags and s.keep and kept[id(s)]]
        inner = {id(k) for s in found for k in s.walk() if k is not s}
        found = [s for s in found if id(s) not in inner]
        if found and sum(kept[id(s)] for s in found) >= 0.3 * kept[id(root)]:
            return found
    slot = root
    while True:
        inside = [k for k in slot.kids if k.tag in _CONTAINERS and kept[id(k)] >= REGION * kept[id(root)]]
        if not inside:
            return [slot]
        slot = inside[0]


def decided(wrapper: Slot) -> Slot:
    """``wrapper`` with ``keep`` of its slots (what may be content) and their ``key``s."""
    sums: dict[int, tuple[int, int]] = {}
    whole = sum(_totals(wrapper, sums))
    _mark(wrapper, whole, sums)
    inside = {id(s) for r in _regions(wrapper, {k: v[0] for k, v in sums.items()}) for s in r.walk()}
    for key, slot in enumerate(wrapper.walk()):
        slot.keep, slot.key = slot.keep and id(slot) in inside, key
    return wrapper


def _assigned(slot: Slot, page: Slot, out: list[tuple[bool, int]]) -> None:
    """(keep, key) for the slots of a page's tree, in their order; one without a match goes by its parent and its own hint."""
    out.append((slot.keep, slot.key))
    pairs = {j: i for i, j in _ordered(slot.kids, page.kids, matching)}
    for j, kid in enumerate(page.kids):
        if j in pairs:
            _assigned(slot.kids[pairs[j]], kid, out)
        else:
            _unmatched(kid, slot, slot.keep, out)


def _unmatched(page: Slot, parent: Slot, keep: bool, out: list[tuple[bool, int]]) -> None:
    keep = keep and not page.hint
    out.append((keep, -1 - parent.key))
    for kid in page.kids:
        _unmatched(kid, parent, keep, out)


class _Reader:
    """Reads pages by their host's wrapper; wrappers and shapes met lately are kept."""

    def __init__(self) -> None:
        self.wrappers: dict[str, tuple[Slot, dict[str, list]]] = {}

    def blocks(self, html: str | None, wrapper: str) -> list[tuple[int, str]]:
        """(slot key, text) of the blocks that may be content."""
        if wrapper not in self.wrappers:
            if len(self.wrappers) >= 100:
                self.wrappers.clear()
            self.wrappers[wrapper] = decided(unpacked(json.loads(wrapper))), {}
        root, shapes = self.wrappers[wrapper]
        page = Page(html)
        shape = page.root.shape()
        if shape not in shapes:
            if len(shapes) >= SHAPES:
                shapes.clear()
            shapes[shape] = []
            _assigned(root, page.root, shapes[shape])
        found = {id(slot): place for slot, place in zip(page.root.walk(), shapes[shape])}
        placed = ((found[id(slot.final())], text) for slot, text in page.blocks)
        return [(key, text) for (keep, key), text in placed if keep]


def _read(wanted: list[str]):
    """For ``mapInArrow`` over rows with html, host and wrapper: (``wanted``, host, keys, texts) of the blocks that may be content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            keys, texts = [], []
            for host, html, wrapper in zip(column("host").to_pylist(), column("html").to_pylist(), column("wrapper").to_pylist()):
                found = reader.blocks(html, wrapper)
                keys.append([xxhash.xxh64_intdigest(f"{k}|{t}".encode("utf-8", "surrogatepass")) - (1 << 63) for k, t in found])
                texts.append([t for _, t in found])
            columns = [*map(column, wanted), column("host"), pa.array(keys, pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names=[*wanted, "host", "keys", "texts"])

        yield from per_slice("html", work)(batches)

    return run


def constants(read: DataFrame) -> DataFrame:
    """(host, constant): the keys of (slot, text) that over CONSTANT of the host's different pages hold, and at least LEAST."""
    pages = read.where(F.size("keys") > 0).select("host", F.array_distinct("keys").alias("keys")).withColumn("same", F.xxhash64("keys"))
    pages = pages.dropDuplicates(["host", "same"])
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    often = counts.join(hosts, counts.host.eqNullSafe(hosts.host)).where(F.col("n") > CONSTANT * F.col("pages"))
    # at most (blocks of a page) / CONSTANT a host
    return materialize(often.groupBy(counts.host).agg(F.collect_set("key").alias("constant")), "constants")


def main_texts(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row: the main text of its html."""
    rows = pages.select(F.col(id), F.col(url), host_of(F.col(url)).alias("host"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    wrappers = induced(rows).withColumnRenamed("host", "_host")
    met = rows.join(wrappers, F.col("host").eqNullSafe(F.col("_host")))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (id, url))
    read = met.drop("_host").mapInArrow(_read([id, url]), f"{kinds}, host string, keys array<long>, texts array<string>")
    path = scratch_path(pages.sparkSession, "read")
    read.write.option("compression", "zstd").parquet(path)  # about as large as the visible text
    read = pages.sparkSession.read.schema(read.schema).parquet(path)
    template = constants(read).withColumnRenamed("host", "_host")
    found = read.join(template, F.col("host").eqNullSafe(F.col("_host")), "left")
    left = F.array_compact(F.zip_with("keys", "texts", lambda k, t: F.when(~F.array_contains("constant", k), t)))
    text = F.array_join(F.when(F.col("constant").isNull(), F.col("texts")).otherwise(left), " ")
    return found.select(id, url, text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
