"""Main text of web pages by template deduction.

Pages of a host are made from a few templates. A page is a sequence of tokens: its tags, each with
the path of tags above it, and the texts of its blocks. Tokens that occur equally often in every
page of the host (equal occurrence vectors) form an equivalence class. A class is valid if it holds
tags and enough pages share it: these make the template. A text whose class is valid belongs to the
template, whatever the share of pages, unless only copies of a page or two share it: their own texts
and tags also occur together. Texts that nearly all pages share belong to the template too. What the
template leaves open are slots; a slot is named by its path.

Occurrence vectors are never collected. A token's vector is known by two sums of hashes of
(page, count) over the pages that hold it, which are aggregated in parts: a host with a third of all
pages costs no task more than its share. Slots are judged per host: those nested in menus, headers,
footers, sidebars, notices, adverts, forms and comments are left out by their tags' names and
classes, and of the others those that hold mostly links. A class name alone does not leave out what
is or holds the main slot of a page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm import words as W
from tonetide.llm.shared import stored
from tonetide.llm.urls import host

# Names of HTML elements, and class names in common use.
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav noscript ol optgroup option p pre section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
LEFT_OUT = set(
    "nav menu header footer aside form head button select noscript template svg canvas object "
    "dialog audio video math".split()
)
LEFT_OUT_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header "
    "masthead topbar footer colophon copyright sidebar aside widget widgets cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login search share sharing social related recommended comment comments commentlist "
    "reply replies respond disqus discussion skip form".split()
)
# Words that may stand beside one of these in a class name: "site-header", but not "has-header".
PLACES = set(
    "site page global main primary secondary top bottom left right inner outer upper lower mini box "
    "block bar container wrapper wrap area section group list item items links link slot unit post "
    "entry article blog text widget".split()
)
MAIN = {"article", "main"}
MAIN_NAMES = {"article", "articlebody", "main"}
CLOSES = {  # an opening tag that ends an open one, unless a list or table lies between
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"},
}
SCOPE = {"ul", "ol", "dl", "table", "select", "div", "article", "section", "body", "main"}

SUPPORT = 0.05
CONSTANT = 0.9
CONSTANT_PAGES = 10
DIFFERENT = 3  # contents that must differ among the pages of a class before its texts are template
NEAR = 0.8  # share of the main text from which on pages that have it in common are near copies
LINKS = 0.6

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<(/?)([a-z][^\s/>]*)([^>]*)>""",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_LETTERS = re.compile(r"[a-z]+")


# Why a block is left out, from weak to strong: by a name alone, by one below a main tag, by a tag.
KEPT, BY_NAME, WITHIN, BY_TAG = range(4)


def _left_out(names: str, ignored: frozenset[str] = frozenset()) -> bool:
    """True if a whole class name or id means a slot that is left out.

    All its parts must be such names or places: "has-sidebar" and "no-share" are other things.
    """
    for name in names.split():
        parts = set(_LETTERS.findall(name))
        found = (parts & LEFT_OUT_NAMES) - ignored
        if found and parts <= LEFT_OUT_NAMES | PLACES:
            return True
    return False


class _Open:
    """An open element: its name, path, why its text is left out, and whether it is main."""

    __slots__ = ("name", "path", "out", "main")

    def __init__(self, name: str, path: str, out: int, main: bool):
        self.name, self.path, self.out, self.main = name, path, out, main


def parse(html: str) -> tuple[dict[str, list], list[tuple[str, int, bool, str, int]]]:
    """Tags by path, each as [count, left out, main], and blocks in order.

    A block is (path, left out, main, text, characters in links). Left out is one of ``KEPT``,
    ``BY_NAME``, ``WITHIN`` and ``BY_TAG``; what is main may be left out by name. Character references are decoded
    and white space is one space each. Broken nesting is mended as browsers do in the common cases.
    """
    top = _Open("", "", KEPT, False)
    stack, tags, blocks = [top], {}, []
    held: list[str] = []
    linked, link = 0, False

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                at = stack[-1]
                blocks.append((at.path, at.out, at.main, text, linked))
            held.clear()
        linked = 0

    last = 0
    for match in _TAG.finditer(html):
        if match.start() > last:
            piece = html[last : match.start()]
            held.append(piece)
            if link:
                linked += len(piece)
        last = match.end()
        name = match[3] or match[6]
        if not name:
            continue
        name, close = name.lower(), (match[2] or match[5]) == "/"
        if name == "a":
            link = not close
        if name == "br":
            held.append(" ")
        if close:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if name in BLOCK:
                flush()
            if depth:
                if name not in BLOCK:
                    flush()
                del stack[depth:]
            continue
        attributes = match[4] or match[7] or ""
        names = ""
        out = BY_TAG if name in LEFT_OUT else KEPT
        main = name in MAIN
        if "=" in attributes or "hidden" in attributes:
            found = _NAMED.findall(attributes)
            if found:
                names = " ".join(sorted(a or b or c for _, a, b, c in found)).lower().replace("/", "-")
                words = set(_LETTERS.findall(names))
                main = main or not MAIN_NAMES.isdisjoint(words)
                if name not in ("html", "body") and _left_out(names):
                    out = max(out, BY_NAME)
            if _HIDDEN.search(attributes):
                out = BY_TAG
        if name in BLOCK:
            flush()
            ended = CLOSES.get(name)
            if ended:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in ended:
                        del stack[i:]
                        break
                    if stack[i].name in SCOPE:
                        break
        elif not out and not main:
            continue
        at = stack[-1]
        if name == "header" and at.main:  # of an article: it holds its title
            out = BY_NAME if _left_out(names, frozenset({"header"})) else KEPT
        label = name + (f".{re.sub('[0-9]+', '', names)}" if names else "")
        path = f"{at.path}/{label}"
        if out == BY_NAME and at.main:
            out = WITHIN
        out = max(at.out, out)
        main = at.main or (main and out < BY_TAG)
        tags.setdefault(path, [0, out, main])[0] += 1
        if name not in VOID:
            if name not in BLOCK:
                flush()
            stack.append(_Open(name, path, out, main))
    if last < len(html):
        held.append(html[last:])
    flush()
    return tags, blocks


def _hash(texts: list[str]) -> np.ndarray:
    data = "".join(texts).encode("utf-8", "surrogatepass")
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    flat = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    return W.run_hashes(flat, ends - sizes, ends, np.uint64(0xD6E8FEB86659FD93))


_TOKENS = (
    "host string, text boolean, token string, parent string, out boolean, main boolean, low long, "
    "high long, pages long, chars long, linked long, contents long, room long"
)


def _content(blocks: list[tuple]) -> str:
    """What tells a page from others of its template: its main texts, or those that are no links."""
    kept = [b for b in blocks if not b[1]]
    main = [b[3] for b in kept if b[2]]
    return "\n".join(main or [b[3] for b in kept if b[4] < len(b[3]) * LINKS])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrence vectors of a part of the pages, by host and token."""
    for batch in W.chunks(batches, "html"):
        keys, counts, mine = [], [], []
        chars: dict[tuple, list[int]] = {}
        flags: dict[str, tuple[bool, bool]] = {}
        contents, room, main_texts = [], [], {}
        hosts = batch.column("host").to_pylist()
        for i, page in enumerate(W.valid(batch.column("html")).to_pylist()):
            tags, blocks = parse(page or "")
            texts: dict[str, int] = {}
            for path, (_, out, main) in tags.items():
                flags[path] = (bool(out), main and not out)
            for path, _, _, text, linked in blocks:
                sums = chars.setdefault((hosts[i], path), [0, 0])
                sums[0] += len(text)
                sums[1] += min(linked, len(text))
                texts[text] = texts.get(text, 0) + 1
            contents.append(_content(blocks))
            room.append(sum(len(b[3]) for b in blocks if b[2] and not b[1]))
            for _, out, main, text, _ in blocks:
                if main and not out:
                    key = (hosts[i], True, text)
                    main_texts[key] = main_texts.get(key, 0) + len(text)
            tags[""] = [1, False, False]
            own = [(hosts[i], False, t) for t in tags] + [(hosts[i], True, t) for t in texts]
            keys += own
            counts += [*(t[0] for t in tags.values()), *texts.values()]
            mine += [i] * len(own)
        if not keys:
            continue
        page = batch.column("page").to_numpy().view(np.uint64)
        seen = W.mixed(page[np.array(mine)] ^ W.mixed(np.array(counts, dtype=np.uint64)))
        # A bit for each content: the bits of a token are at most as many as its contents.
        bits = (np.int64(1) << (_hash(contents) % np.uint64(63)).astype(np.int64)).tolist()
        vectors: dict[tuple, list[int]] = {}
        halves = seen & np.uint64(0xFFFFFFFF), seen >> np.uint64(32)
        for key, i, low, high in zip(keys, mine, *(x.tolist() for x in halves)):
            entry = vectors.get(key)
            if entry is None:
                vectors[key] = [low, high, 1, bits[i], room[i]]
            else:
                entry[0] += low
                entry[1] += high
                entry[2] += 1
                entry[3] |= bits[i]
                entry[4] += room[i]
        rows = list(vectors)
        hashed = _hash([t if is_text else "" for _, is_text, t in rows]).view(np.int64).tolist()
        stats = [
            (main_texts.get((h, True, t), 0), 0) if is_text else chars.get((h, t), (0, 0))
            for h, is_text, t in rows
        ]
        out_main = [
            (False, (h, True, t) in main_texts) if is_text else flags.get(t, (False, False))
            for h, is_text, t in rows
        ]
        yield pa.RecordBatch.from_pydict(
            {
                "host": pa.array([h for h, _, _ in rows], pa.string()),
                "text": [is_text for _, is_text, _ in rows],
                "token": [str(x) if is_text else t for (_, is_text, t), x in zip(rows, hashed)],
                "parent": ["" if is_text else t.rpartition("/")[0] for _, is_text, t in rows],
                "out": [o for o, _ in out_main],
                "main": [m for _, m in out_main],
                "low": [v[0] for v in vectors.values()],
                "high": [v[1] for v in vectors.values()],
                "pages": [v[2] for v in vectors.values()],
                "chars": [s[0] for s in stats],
                "linked": [s[1] for s in stats],
                "contents": [v[3] for v in vectors.values()],
                "room": [v[4] for v in vectors.values()],
            }
        )


def templates(pages: DataFrame) -> DataFrame:
    """Per host: ``constants``, ``closed`` and ``roots`` of its template.

    These are hashes of the template's texts, its slots of links and its outermost main tags.
    ``pages`` has ``host``, ``page`` (a hash) and ``html``. The lists are bounded by shares of the
    host's pages: at most (tokens of a page / share) entries each.

    A text is a constant if its class holds template tags and ``DIFFERENT`` contents, and in main
    slots less than ``NEAR`` of them (else its pages are copies); or if at least ``CONSTANT`` of
    ``CONSTANT_PAGES`` or more pages share it.
    """
    tokens = (
        pages.mapInArrow(_tokens, _TOKENS)
        .groupBy("host", "text", "token")
        .agg(
            F.max("parent").alias("parent"),
            F.max("out").alias("out"),
            F.max("main").alias("main"),
            F.sum("low").alias("low"),
            F.sum("high").alias("high"),
            F.sum("pages").alias("pages"),
            F.sum("chars").alias("chars"),
            F.sum("linked").alias("linked"),
            F.bit_or("contents").alias("contents"),
            F.sum("room").alias("room"),
        )
    )
    every = stored(tokens)
    sizes = every.where((F.col("token") == "") & ~F.col("text")).select(
        F.col("host").alias("__host"), F.col("pages").alias("all")
    )
    common = every.join(sizes, F.col("host") == F.col("__host")).where(
        F.col("pages") >= F.greatest(F.lit(2), F.col("all") * SUPPORT)
    )
    # Tokens of equal vectors are one class, of at most the tokens of a page.
    mine = Window.partitionBy("host", "low", "high", "pages")
    dealt = common.repartition("host", "low", "high", "pages")  # not by host alone: one may be hot
    common = stored(
        dealt.withColumn("tagged", F.bool_or(~F.col("text")).over(mine)).withColumn(
            "shared", F.sum(F.when(F.col("text"), F.col("chars")).otherwise(0)).over(mine)
        )
    )
    slots = common.where(~F.col("text"))
    above = slots.select(
        F.col("host").alias("__up"), F.col("token").alias("__path"), F.col("main").alias("main_above")
    )
    up = (F.col("host") == F.col("__up")) & (F.col("parent") == F.col("__path"))
    nested = slots.join(above, up, "left")
    roots = nested.where(F.col("main") & ~F.coalesce("main_above", F.lit(False)))
    closed = slots.where(
        ~F.col("out") & (F.col("chars") > 0) & (F.col("linked") >= F.col("chars") * LINKS)
    )
    template = (
        F.col("tagged")
        & (F.bit_count("contents") >= DIFFERENT)
        & (~F.col("main") | (F.col("shared") < F.col("room") * NEAR))
    )
    nearly_all = (F.col("all") >= CONSTANT_PAGES) & (F.col("pages") >= F.col("all") * CONSTANT)
    constant = common.where(F.col("text") & (template | nearly_all))
    found = (
        constant.select("host", F.lit("constants").alias("kind"), "token")
        .unionByName(closed.select("host", F.lit("closed").alias("kind"), "token"))
        .unionByName(roots.select("host", F.lit("roots").alias("kind"), "token"))
    )
    return found.groupBy("host").agg(
        *[
            F.collect_set(F.when(F.col("kind") == kind, F.col("token"))).alias(kind)
            for kind in ("constants", "closed", "roots")
        ]
    )


def main_text(
    html: str, constants: set[str] = frozenset(), closed: set[str] = frozenset(), roots=()
) -> str:
    """Blocks of the main slots of one page, joined by line feeds.

    Blocks below the template's main tags, or if the page has none, below its own; else all that
    are not left out, without slots of links. If these hold less than the main tags left out by a
    class name alone, it was a wrapper's name, and the main tags count. If nothing is left and the
    page has no main tag, what was left out by name is kept. The template's texts go, unless nothing
    else is left.
    """
    tags, blocks = parse(html)
    kept = [b for b in blocks if not b[1]]
    below = tuple(f"{r}/" for r in roots)
    inner = [b for b in kept if b[0] in roots or b[0].startswith(below)] if below else []
    inner = inner or [b for b in kept if b[2]]
    kept = inner or [b for b in kept if b[0] not in closed] or kept
    if not inner:
        named = [b for b in blocks if b[1] == BY_NAME]
        wrapped = [b for b in named if b[2]]
        if sum(len(b[3]) for b in wrapped) > sum(len(b[3]) for b in kept):
            kept = wrapped
        elif not kept and not any(main for _, _, main in tags.values()):
            kept = [b for b in named if b[4] < len(b[3]) * LINKS]
    texts = [b[3] for b in kept]
    if constants and texts:
        known = _hash(texts).view(np.int64).tolist()
        texts = [t for t, h in zip(texts, known) if str(h) not in constants] or texts
    return "\n".join(texts)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict[str, tuple[set, set, set]] = {}
    for batch in W.chunks(batches, "html"):
        hosts = batch.column("host").to_pylist()
        new = {h: i for i, h in enumerate(hosts) if h not in sets}
        if len(sets) + len(new) > 10_000:
            sets, new = {}, {h: i for i, h in enumerate(hosts)}
        for h, i in new.items():
            lists = (batch.column(c)[i].as_py() or () for c in ("constants", "closed", "roots"))
            sets[h] = tuple(set(x) for x in lists)
        pages = W.valid(batch.column("html")).to_pylist()
        texts = [main_text(p or "", *sets[h]) for p, h in zip(pages, hosts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id url text n_chars`` for every row.

    A null or empty page has an empty text. Rows with a null url, or one without host, share the
    empty host. A host of few pages has no template to tell constants by, and every slot is judged
    by its tags. Repeated rows are extracted alike and count as pages of equal content.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
    )
    hashed = rows.select("host", F.xxhash64("page_id", "url").alias("page"), "html")
    known = stored(templates(hashed)).withColumnRenamed("host", "__host")
    return rows.join(known, F.col("host") == F.col("__host"), "left").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
