"""Main text of web pages by templates deduced from the pages of each host.

A page is a line of tokens: container tags with their place in the page, opened and
closed, and text blocks. Tokens of a host with one occurrence vector (how often on which
page) form an equivalence class. A class is valid where its tokens come in one order on
its pages and lie in one gap of the more frequent classes; tokens that break either rule
leave it. The valid classes, nested, are the host's template; the gaps between its tokens
are slots. What fills the slots over all pages of the host decides: repeated text is
template, the article lies in the innermost container with nearly all other text.

Vectors are sums of page hashes that combine before the shuffle, as do counts of broken
orders, gaps and slot contents, so a host of any size costs a row per token and task.
Elements that HTML names for the purpose (nav, footer, article ...) and fixed class names
of comments, forms and the like are left out of the comparison of slots, and alone decide
on hosts with one page, which have no template.
"""

from __future__ import annotations

import heapq
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import positional, prepare, stored, table

#: A text is template text if this share of the host's pages has it; on hosts of fewer pages than this, if all have.
LEAST_PAGES, LEAST_SHARE = 5, 0.6
#: Containers on a smaller share of a host's pages stay out of its template.
LEAST_LAYOUT = 0.1
#: Share of a token's pages that must keep to the order and the gap of its class (broken markup breaks some).
HOLDS = 0.9
#: The main container is the innermost one with this share of the text that is neither linked nor template.
MAIN_SHARE = 0.9
#: Template rows up to this number are held by every task; more are joined by host.
HELD_ROWS = 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|select|button|object)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_LETTERS = re.compile(r"[^\W\d_]+")

# Fixed names of HTML.
CONTAINERS = frozenset(
    "html head body div section article main nav header footer aside form ul ol dl table figure details dialog menu fieldset".split()
)
BLOCKS = CONTAINERS | frozenset(
    "title p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody caption blockquote pre hr address figcaption summary legend".split()
)
SIDE_TAGS = frozenset("head nav header footer aside form dialog menu".split())
MAIN_TAGS = frozenset("article main".split())
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert sidebar rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments reply "
    "replies disqus respond share sharing social related recommended newsletter subscribe signup login search popup modal "
    "overlay widget widgets pagination pager toolbar copyright disclaimer complementary contentinfo form".split()
)
PAGE_HEAD_NAMES = frozenset(["header", "head"])


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


@lru_cache(maxsize=10_000)
def _place_hash(place: str) -> int:
    return _hash(place)


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


def _folded(text: str) -> int | None:
    """Token of a text with its numbers made alike, for texts with a number and three words."""
    if _DIGITS.search(text) is None or len(_LETTERS.findall(text)) < 3:
        return None
    return _hash("fold:" + _DIGITS.sub("0", text))


class Block:
    """`node`: number of the innermost open container, `slot` its token; `head`: aside only for lying in a page's header."""

    __slots__ = ("text", "linked", "slot", "side", "head", "main", "title", "node", "at")

    def __init__(self, text: str, linked: int, top: tuple, title: bool, at: int):
        self.text, self.linked, self.title, self.at = text, linked, title, at
        _, self.slot, self.side, self.head, self.main, self.node, _ = top


def read_page(page: str | None) -> tuple[list[Block], list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    """Blocks of a page, its container tokens (token, depth, position) and containers
    (token, number of the one around it or -1, depth, tag), all in page order. A token hashes
    its element's place, so pages may nest to any depth."""
    blocks: list[Block] = []
    tokens: list[tuple[int, int, int]] = []
    nodes: list[tuple[int, int, int, str]] = []
    # tag, token, aside, aside for its header only, in the article, node, children seen
    root = ("", 0, False, False, False, -1, {})
    stack: list[tuple] = []
    is_open: Counter = Counter()
    words: list[str] = []
    linked = link_depth = at = 0
    title = False

    def flush() -> None:
        nonlocal linked, at
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                blocks.append(Block(text, min(linked, len(text)), stack[-1] if stack else root, title, at))
                at += 1
            words.clear()
        linked = 0

    def close(start: int) -> None:
        nonlocal at
        for entry in reversed(stack[start:]):
            tokens.append((_place_hash(f"close:{entry[1]}"), nodes[entry[5]][2], at))
            is_open[entry[0]] -= 1
            at += 1
        del stack[start:]

    for m in _TOKEN.finditer(page or ""):
        kind = m.lastgroup
        if kind == "text":
            text = m[0]
            words.append(text)
            if link_depth:
                linked += len(text)
            continue
        if kind != "attrs":
            continue
        _, closing, tag, attrs, _ = m.groups()
        tag = tag.lower()
        if tag == "a":
            link_depth = 0 if closing else 1
        elif tag == "br":
            words.append(" ")
        elif tag in BLOCKS:
            if words:
                flush()
            title = tag == "h1" and not closing
            if tag not in CONTAINERS:
                continue
            link_depth = 0
            if closing:
                if is_open[tag]:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
                continue
            names = [next((x for x in n[1:] if x), "") for n in _NAME.findall(attrs)] if attrs else ()
            known = {w for n in names for w in _WORDS.findall(n.lower())}
            if tag in MAIN_TAGS and not known & SIDE_NAMES:
                while stack and stack[-1][2] and not stack[-1][4]:  # a menu or advert left open ends here
                    close(len(stack) - 1)
            elif tag == "body":
                close(next((i for i, e in enumerate(stack) if e[0] != "html"), len(stack)))
            _, above, aside, in_head, inside, around, children = stack[-1] if stack else root
            header = not inside and (tag == "header" or bool(known & PAGE_HEAD_NAMES))
            other = (tag in SIDE_TAGS and tag != "header") or bool(known & SIDE_NAMES)
            main = inside or (tag in MAIN_TAGS and not (aside or other or header))
            name = tag + "".join(f".{w}" for w in sorted(known))
            children[name] = children.get(name, 0) + 1
            token = _place_hash(f"{above}/{name}" + (f":{children[name]}" if not known and children[name] > 1 else ""))
            only_head = not other and ((header and not aside) or in_head)
            stack.append((tag, token, aside or other or header, only_head, main, len(nodes), {}))
            is_open[tag] += 1
            nodes.append((token, around, len(stack), tag))
            tokens.append((token, len(stack), at))
            at += 1
    flush()
    return blocks, tokens, nodes


def _within(nodes: list[tuple[int, int, int, str]], chosen) -> list[bool]:
    """Per container, and last for none, whether it or one around it is chosen by its token."""
    out: list[bool] = []
    for token, around, _, _ in nodes:
        out.append(chosen(token) or (around >= 0 and out[around]))
    return [*out, False]


def _text_tokens(block: Block) -> list[tuple[int, int]]:
    """(kind, token) of a block's text: 1 as it is, 2 with its numbers made alike."""
    fold = _folded(block.text)
    return [(1, _hash("text:" + block.text)), *([] if fold is None else [(2, fold)])]


_COUNTED = [("host", "string"), *((c, "long") for c in "token kind depth n_pages low high place lo hi".split())]
_CHECKED = [("host", "string"), *((c, "long") for c in "token gap n_pages broken".split())]
_FILLED = [("host", "string"), *((c, "long") for c in "token depth chars linked fresh".split())]


def _ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{n} {t}" for n, t in columns)


def _batch(seen: dict, columns: list[tuple[str, str]]) -> pa.RecordBatch:
    values = [list(c) for c in zip(*[(*k, *v) for k, v in seen.items()], strict=True)]
    kinds = {"string": pa.string(), "long": pa.int64()}
    seen.clear()
    arrays = [pa.array(c, kinds[t]) for c, (_, t) in zip(values, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in columns])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: pages, hashed occurrence vector (two words), mean place, and the
    least and greatest digest of the two longest texts on pages with it."""
    seen: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            host = host_of(url)
            blocks, tokens, _ = read_page(page)
            longest = heapq.nlargest(2, {b.text for b in blocks}, key=lambda t: (len(t), t))
            content = _hash("\n".join(longest))
            own: dict[int, list[int]] = {0: [0, 0, 1, 0]}  # kind, depth, times, place
            for token, depth, at in tokens:
                own.setdefault(token, [0, depth, 0, at])[2] += 1
            for b in blocks:
                for kind, token in _text_tokens(b):
                    own.setdefault(token, [kind, 0, 0, b.at])[2] += 1
            number = _hash(f"{url}\n{page or ''}")
            for token, (kind, depth, times, place) in own.items():
                page_hash = hash((number, times))
                low, high = page_hash & 0xFFFFFFFF, page_hash >> 32 & 0xFFFFFFFF
                total = seen.get((host, token))
                if total is None:
                    seen[(host, token)] = [kind, depth, 1, low, high, place, content, content]
                    continue
                total[2] += 1
                total[3] += low
                total[4] += high
                total[5] += place
                total[6], total[7] = min(total[6], content), max(total[7], content)
        if len(seen) > 50_000:
            yield _batch(seen, _COUNTED)
    if seen:
        yield _batch(seen, _COUNTED)


def out_of_order(ranks: list[int]) -> set[int]:
    """Positions of `ranks` outside its longest rising subsequence (the first found)."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, r in enumerate(ranks):
        k = bisect_left(ends, r)
        before.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(r)
            at.append(i)
        else:
            ends[k], at[k] = r, i
    kept, i = set(), at[-1] if at else -1
    while i >= 0:
        kept.add(i)
        i = before[i]
    return set(range(len(ranks))) - kept


def _broken(page: str | None, classes: dict[int, tuple[int, int, int, int, int]]) -> dict[int, tuple[int, bool]]:
    """token -> (gap, breaks its class's order) on a page. `classes`: token -> (class, rank, size, pages, kind)."""
    blocks, tokens, _ = read_page(page)
    line = [(at, t) for t, _, at in tokens]
    if any(row[4] for row in classes.values()):
        line += [(b.at, t) for b in blocks for _, t in _text_tokens(b)]
    line = [(at, t) for at, t in sorted(line, key=lambda x: x[0]) if t in classes]
    members: dict[int, list[int]] = {}
    found: dict[int, tuple[int, bool]] = {}
    last: dict[int, tuple[int, int]] = {}  # pages of a class -> its latest token and that token's number on the page
    for i, (_, t) in enumerate(line):
        number, _, _, n_pages, _ = classes[t]
        members.setdefault(number, []).append(t)
        if t not in found:
            larger = [v for n, v in last.items() if n > n_pages]
            found[t] = (max(larger)[1] if larger else 0, False)
        last[n_pages] = (i, t)
    for sequence in members.values():
        size = classes[sequence[0]][2]
        for start in range(0, len(sequence), size):  # one round of the class
            part = sequence[start : start + size]
            for i in _misplaced([classes[t][1] for t in part], [classes[t][4] > 0 for t in part]):
                found[part[i]] = (found[part[i]][0], True)
    return found


def _misplaced(ranks: list[int], is_text: list[bool]) -> set[int]:
    """Positions that break the order: containers against each other, then texts against the
    containers that keep it and against each other."""
    holders = [i for i, x in enumerate(is_text) if not x]
    lost = {holders[k] for k in out_of_order([ranks[i] for i in holders])}
    above, before = 0, []
    for i, r in enumerate(ranks):
        before.append(above)
        if not is_text[i] and i not in lost:
            above = r
    below, texts = len(ranks) + max(ranks, default=0), []
    for i in range(len(ranks) - 1, -1, -1):
        if not is_text[i]:
            below = below if i in lost else ranks[i]
        elif before[i] < ranks[i] < below:
            texts.append(i)
        else:
            lost.add(i)
    texts.reverse()
    return lost | {texts[k] for k in out_of_order([ranks[i] for i in texts])}


def _gaps(blocks: list[Block], tokens: list[tuple[int, int, int]], template: dict) -> list[int]:
    """The slot of each block: the template's container token before it."""
    line = [(at, t) for t, _, at in tokens if t in template]
    out, i, gap = [], 0, 0
    for b in blocks:
        while i < len(line) and line[i][0] < b.at:
            gap = line[i][1]
            i += 1
        out.append(gap)
    return out


def _has_texts(template: dict) -> bool:
    return any(row[0] for row in template.values())


def _repeated(block: Block, gap: int, template: dict) -> bool:
    """Whether the block is template text. Texts told by all pages of a small host, or but for
    their numbers, are so only outside the article and the host's fullest slot."""
    outside = not (block.main or block.title or template.get(gap, _NONE)[4])
    return any((row := template.get(t)) is not None and row[0] and (row[0] == 1 or outside) for _, t in _text_tokens(block))


#: Template row of a token: text (1 everywhere, 2 outside the article), characters, linked characters, main, fullest slot.
_NONE = (0, 0, 0, 0, 0)


def _per_page(pages: DataFrame, url: str, page: str, rows: DataFrame, columns: list[str], work, schema: str) -> DataFrame:
    """`work` (batches and a function giving each page its host's `rows` as {token: values}) over pages.

    Up to HELD_ROWS rows are held by every task, more are joined by host; both give the same."""
    spark = pages.sparkSession
    names = pages.columns
    url_at, page_at = names.index(url), names.index(page)
    if rows.count() <= HELD_ROWS:
        held: dict[str, dict[int, tuple]] = {}
        for r in rows.select("host", "token", *columns).collect():
            held.setdefault(r[0], {})[r[1]] = tuple(r[2:])
        shared = spark.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                for b in batches:
                    urls = b.column(url_at).to_pylist()
                    yield b, urls, b.column(page_at).to_pylist(), [shared.value.get(host_of(u), {}) for u in urls]

            yield from work(each())

        return pages.mapInArrow(run, schema)

    per_host = rows.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct("token", *columns)).alias("_template"))
    url_col = F.coalesce(F.col(url), F.lit(""))
    host = F.lower(F.regexp_extract(url_col, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = pages.withColumn("_host", host).join(per_host, "_host", "left").select(*names, "_template")

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for b in batches:
                found = [{t["token"]: tuple(t[c] for c in columns) for t in r or ()} for r in b.column(len(names)).to_pylist()]
                own = pa.RecordBatch.from_arrays(b.columns[: len(names)], names)
                yield own, b.column(url_at).to_pylist(), b.column(page_at).to_pylist(), found

        yield from work(each())

    return joined.mapInArrow(run_joined, schema)


def _check_work(parts) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int, int], list[int]] = {}
    for _, urls, htmls, found in parts:
        for url, page, classes in zip(urls, htmls, found, strict=True):
            host = host_of(url)
            for token, (gap, broken) in _broken(page, classes).items() if classes else ():
                total = seen.setdefault((host, token, gap), [0, 0])
                total[0] += 1
                total[1] += broken
        if len(seen) > 50_000:
            yield _batch(seen, _CHECKED)
    if seen:
        yield _batch(seen, _CHECKED)


def _fill_work(parts) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int], list[int]] = {}
    for _, urls, htmls, found in parts:
        for url, page, rows in zip(urls, htmls, found, strict=True):
            if not rows:
                continue
            host, template = host_of(url), {t: (kind, 0, 0, 0, 0) for t, (kind,) in rows.items()}
            blocks, tokens, nodes = read_page(page)
            fresh = [0] * (len(nodes) + 1)  # the last is the whole page
            texts = _has_texts(template)
            for b, gap in zip(blocks, _gaps(blocks, tokens, template), strict=True):
                if b.side or texts and any(template.get(t, _NONE)[0] == 1 for _, t in _text_tokens(b)):
                    continue
                slot = seen.setdefault((host, gap), [0, 0, 0, 0])
                slot[1] += len(b.text)
                slot[2] += b.linked
                fresh[b.node] += len(b.text) - b.linked
            for i in range(len(nodes) - 1, -1, -1):
                token, around, depth, _ = nodes[i]
                fresh[around] += fresh[i]
                if fresh[i] and token in template:
                    whole = seen.setdefault((host, token), [0, 0, 0, 0])
                    whole[0] = depth
                    whole[3] += fresh[i]
            seen.setdefault((host, 0), [0, 0, 0, 0])[3] += fresh[-1]
        if len(seen) > 50_000:
            yield _batch(seen, _FILLED)
    if seen:
        yield _batch(seen, _FILLED)


def deduce_classes(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Equivalence classes of hosts with two or more pages and their validity:
    (host, token, kind, depth, n_pages, host_pages, low, high, rank, class_size, kept_order, kept_gap).

    kind 0 is a container's opening or closing, 1 a text, 2 a text with its numbers made alike.
    `low` and `high` hash the occurrence vector, `rank` is the place in the class,
    `kept_order` and `kept_gap` are the shares of the token's pages that keep to the order and
    to one gap of the more frequent classes. Texts always seen with the same two longest texts
    belong to copies of a page and stay out."""
    counted = pages.select(F.col(url).cast("string"), F.col(page).cast("string")).mapInArrow(_occurrences, _ddl(_COUNTED))
    sums = [F.sum(c).alias(c) for c in ("n_pages", "low", "high", "place")]
    tokens = counted.groupBy("host", "token").agg(
        F.max("kind").alias("kind"), F.max("depth").alias("depth"), *sums, F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    tokens = stored(tokens.filter("n_pages > 1"), "page-tokens")
    hosts = tokens.filter("token = 0").select("host", F.col("n_pages").alias("host_pages"))
    share = F.col("n_pages") / F.col("host_pages")
    text = F.when(F.col("host_pages") >= LEAST_PAGES, share >= LEAST_SHARE).otherwise(share == 1) & (F.col("lo") != F.col("hi"))
    frequent = tokens.filter("token != 0").join(hosts, "host").filter(F.when(F.col("kind") == 0, share >= LEAST_LAYOUT).otherwise(text))
    whole = Window.partitionBy("host", "n_pages", "low", "high")
    frequent = frequent.select(
        "host", "token", "kind", "depth", "n_pages", "host_pages", "low", "high",
        F.row_number().over(whole.orderBy(F.col("place") / F.col("n_pages"), "token")).alias("rank"),
        F.count(F.lit(1)).over(whole).alias("class_size"),
        F.min("token").over(whole).alias("class"),
    )
    frequent = stored(frequent, "page-classes")
    checked = _per_page(pages, url, page, frequent, ["class", "rank", "class_size", "n_pages", "kind"], _check_work, _ddl(_CHECKED))
    gaps = checked.groupBy("host", "token", "gap").agg(F.sum("n_pages").alias("n"), F.sum("broken").alias("broken"))
    kept = gaps.groupBy("host", "token").agg(
        (1 - F.sum("broken") / F.sum("n")).alias("kept_order"), (F.max("n") / F.sum("n")).alias("kept_gap")
    )
    return frequent.join(kept, ["host", "token"]).drop("class")


def deduce_templates(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, token, is_text, chars, linked, is_main, is_fullest): tokens of valid classes.

    is_text: 1 template text, 2 template text outside the article only, 0 a container token with
    the characters of its slot over all pages; is_main marks the container of the article, is_fullest
    the slot with most text. Token 0 is the part of pages before any template token."""
    classes = deduce_classes(pages, url, page).filter((F.col("kept_order") >= HOLDS) & (F.col("kept_gap") >= HOLDS))
    kind = F.when(F.col("kind") == 0, 0).when((F.col("kind") == 1) & (F.col("host_pages") >= LEAST_PAGES), 1).otherwise(2)
    valid = stored(classes.select("host", "token", kind.cast("long").alias("is_text")), "page-templates")
    filled = _per_page(pages, url, page, valid, ["is_text"], _fill_work, _ddl(_FILLED))
    sums = [F.sum(c).alias(c) for c in ("chars", "linked", "fresh")]
    filled = stored(filled.groupBy("host", "token").agg(F.max("depth").alias("depth"), *sums), "page-slots")
    totals = filled.groupBy("host").agg(
        F.max(F.when(F.col("token") == 0, F.col("fresh"))).alias("total"),
        F.max_by("token", F.struct(F.col("chars") - F.col("linked"), "token")).alias("fullest"),
    )
    inner = filled.join(totals, "host").filter((F.col("depth") > 0) & (F.col("fresh") > 0) & (F.col("fresh") >= MAIN_SHARE * F.col("total")))
    mains = inner.groupBy("host").agg(F.max_by("token", F.struct("depth", "fresh", "token")).alias("main"))
    return (
        valid.join(filled.select("host", "token", "chars", "linked"), ["host", "token"], "full")
        .join(totals.select("host", "fullest"), "host", "left")
        .join(mains, "host", "left")
        .select(
            "host", "token", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("is_text", "chars", "linked")),
            F.coalesce(F.col("token") == F.col("main"), F.lit(False)).cast("long").alias("is_main"),
            F.coalesce(F.col("token") == F.col("fullest"), F.lit(False)).cast("long").alias("is_fullest"),
        )
    )


def main_text(page: str | None, template: dict[int, tuple[int, int, int, int, int]]) -> list[str]:
    """Blocks of the article. `template`: token -> row of the host's template (see `_NONE`)."""
    blocks, tokens, nodes = read_page(page)
    gaps = _gaps(blocks, tokens, template)
    texts = _has_texts(template)
    kept = [
        (b, g) for b, g in zip(blocks, gaps, strict=True)
        if (not b.side or (b.head and b.title and template)) and not (texts and _repeated(b, g, template))
    ]
    in_main = _within(nodes, lambda t: template.get(t, _NONE)[3] == 1)
    inside = [b.at for b, _ in kept if b.main] or [b.at for b, _ in kept if in_main[b.node] and not b.side]
    if inside:  # the article, from a title before it on
        first = next((b.at for b, _ in kept if b.title and b.at < inside[0]), inside[0])
        chosen = set(inside)
        kept = [(b, g) for b, g in kept if b.at in chosen or first <= b.at < inside[0]]
    if any(b.main for b, _ in kept):
        return [b.text for b, _ in kept]
    # no article element: every remaining slot, but those that hold mostly links
    # (over the host if its template knows the slot) and don't lie in a slot with text
    mass: dict[tuple[int, int], int] = {}
    for b, g in kept:
        _, chars, linked, _, _ = template.get(g, _NONE)
        slot = (b.slot, g)
        mass[slot] = chars - 2 * linked if chars and g else mass.get(slot, 0) + len(b.text) - 2 * b.linked
    plain = {s for s, m in mass.items() if m >= 0}
    whole = {token for token, _, _, tag in nodes if tag in ("html", "body")} | {0}
    holders = {s for s, _ in plain} - whole
    in_holder = _within(nodes, holders.__contains__)
    return [b.text for b, g in kept if (b.slot, g) in plain or in_holder[b.node]]


def extract_text(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """`pages` with `text`, the article's blocks joined by line ends.

    Null and empty pages give an empty text; pages without a host form one host
    of their own; hosts with one page have no template and are read by their
    elements alone. Copies and repeated rows get the same text; a column named
    `text` is replaced.
    """
    prepare(pages.sparkSession)
    carried, columns, new = positional(pages, ("text",))
    names = carried.columns
    template = stored(deduce_templates(carried, new[url], new[page]), "templates")
    schema = ", ".join(f"{n} {t}" for n, t in carried.dtypes) + ", text string"

    def work(parts) -> Iterator[pa.RecordBatch]:
        for b, _, htmls, found in parts:
            out = pa.array(["\n".join(main_text(p, t)) for p, t in zip(htmls, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*names, "text"])

    values = ["is_text", "chars", "linked", "is_main", "is_fullest"]
    return _per_page(carried, new[url], new[page], template, values, work, schema).toDF(*columns, "text")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of `pages`, a row per row; edge cases as in `extract_text` (empty for null and empty
    html, repeated rows alike)."""
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
