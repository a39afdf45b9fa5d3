"""Main text of web pages by union-free wrapper inference.

A page becomes a token stream: one token per text block, named by the path of
block elements around it (with their classes), and the text as a slot.
Neighbouring copies of a token, or of a short run of tokens, are folded into
one repeated group. Pages of one host are aligned with each other: where two
streams agree the token stays, where they mismatch the tokens of either side
become optional, and a token repeated on one side becomes repeated. The result
is a union-free expression (tokens, optional and repeated ones, text slots),
the host's wrapper. Each slot keeps whether its text is the same on all pages,
how much text it holds and how much of that is in links.

The wrapper's slots, not single pages, decide what is main text. A slot whose
text is the same on ``CONSTANT`` different pages or is mostly links is frame; the
others vary and are weighed, by their characters on all pages, per container.
Of the containers that hold at least 1 / ``TIE`` of the heaviest one's text,
names choose: an article before main, main before a content container, and
that before any other; a container that the varying text does not lie in is not
taken for its name. The main text is what lies in containers of the chosen
kind (frame slots inside one count if they are headings or it is an article)
or, without a named one, the varying slots in the heaviest container. Varying slots
that are navigation, header, footer, sidebar, notice, advert, form or comments by
name are dropped before the weighing, as adverts and comments vary as well.

Distribution. Streams are folded and counted per task, so a host sends each
distinct stream once per batch however many pages it has; streams of a host
are aligned in groups of about ``GROUP``, and the groups' wrappers again in such
groups, until one is left: however hot a host is, no task holds more than a
group. Wrappers are broadcast if all of them are within ``BROADCAST_BYTES``,
else joined by host.

Defined results: null or empty html has the empty text; a null or odd url has
the host ''; repeated rows are answered row by row; of containers of equal kind
and weight the last path in code-point order is taken; broken markup is read
leniently (unclosed elements end with their parent, a cut-off tag is dropped);
very long pages are read whole, and streams of any length are aligned by the
same longest common subsequence, in linear space (its time is the product of
what differs of two streams); extra columns are ignored, also those named
host, salt or slots; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as _html
import json
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recfold.llm.common import materialize

#: Streams or wrappers of a host that one task merges.
GROUP = 256
#: Cells of an alignment that are held at once.
CELLS = 250_000
#: Containers with at least this part of the heaviest one's text are chosen from by name.
TIE = 8
BROADCAST_BYTES = 16 << 20
#: Longest run of tokens that is folded into a repeated group.
PERIOD = 6
#: A slot whose text is the same on so many different pages is no main text; copies of a page count once.
CONSTANT = 3

# --- fixed values: element kinds and the words that name them ---
BLOCK = set("html body article main section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot "
            "tr td th caption blockquote pre figure figcaption form fieldset address details summary hgroup search dialog menu center".split())
HEADS = set("h1 h2 h3 h4 h5 h6 dt th caption".split())
VOID = set("br hr img input meta link area base col embed source track wbr".split())
#: Elements whose content is never text of the page.
HIDDEN = set("script style noscript template svg math select textarea button iframe object canvas audio video head title datalist option".split())
NOISE_TAGS = set("nav footer aside form dialog menu search fieldset".split())
NOISE = set("ad ads advert adverts advertisement adv banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
            "alert alerts popup modal overlay newsletter subscribe subscription sidebar side rail menu nav navbar navigation navi topnav "
            "breadcrumb breadcrumbs footer foot colophon header masthead topbar comment comments reply replies respond discussion disqus "
            "share sharing social related recommended recommendations widget login signin signup search skip pagination pager toolbar "
            "complementary contentinfo".split())
CONTENT = set("article content main post entry story body text".split())
#: A start tag of the first set ends an open element of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# --- end of fixed values ---

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<[A-Za-z/!?][^>]*\Z", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")


def _name(tag: str, attrs: str) -> tuple[str, bool]:
    """Element name with its classes, and whether it is hidden."""
    words, hidden = [], False
    for m in _ATTR.finditer(attrs) if attrs.strip() else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true":
            hidden = True
        elif key != "aria-hidden":
            words += [re.sub(r"[0-9]+", "0", x) for x in value.split()]
    return ".".join([tag, *sorted(set(words))]).replace("/", "-"), hidden


def blocks(page: str) -> list[tuple[str, str, int]]:
    """Text blocks in page order: path, text, characters inside links."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str]] = []  # (tag, name) of open block elements
    text: list[str] = []
    links = in_link = 0
    at, skip = 0, ""

    def flush():
        nonlocal links
        if text:
            joined = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
            if joined:
                out.append(("/".join(n for _, n in stack), joined, min(links, len(joined))))
            text.clear()
        links = 0

    def add(raw: str):
        nonlocal links
        if raw:
            text.append(raw)
            if in_link:
                links += len(raw.strip())

    n = len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in HIDDEN:
            if not m[1] and not m[3].rstrip().endswith("/"):
                # what it holds is not markup; without an end tag it reaches to the end of the page
                if (end := re.compile(rf"</{tag}\s*>", re.I).search(page, at)) is not None:
                    at = end.end()
                elif tag == "head" and (body := re.compile(r"<body\b", re.I).search(page, at)) is not None:
                    at = body.start()
                else:
                    at = n
            continue
        if tag == "br":
            add(" ")
        elif tag == "a":
            in_link = 0 if m[1] else 1
        elif tag in BLOCK:
            flush()
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        in_link = 0
                        break
                continue
            if stack and stack[-1][0] == "p":
                stack.pop()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ENDS.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table"):
                    break
            name, hidden = _name(tag, m[3])
            stack.append((tag, name + ("/hidden" if hidden else "")))
    flush()
    return out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def fold(paths: list[str]) -> list[tuple[int, int, int]]:
    """Fold neighbouring equal runs: tokens as (first, copies, period); every
    run of ``period`` tokens from ``first`` stands for ``copies`` of itself."""
    out, i, n = [], 0, len(paths)
    while i < n:
        best = (1, 1)
        for p in range(1, min(PERIOD, (n - i) // 2) + 1):
            k = 1
            while paths[i + k * p:i + (k + 1) * p] == paths[i:i + p]:
                k += 1
            if k > 1 and k * p > best[0] * best[1]:
                best = (k, p)
        out.append((i, *best))
        i += best[0] * best[1]
    return out


def stream(found: list[tuple[str, str, int]]):
    """Folded token stream of a page: (path, repeated) of each token and, for
    each, the numbers of the page's blocks that it stands for."""
    paths = [b[0] for b in found]
    tokens, members = [], []
    for first, copies, period in fold(paths):
        for j in range(period):
            tokens.append((paths[first + j], copies > 1))
            members.append([first + j + k * period for k in range(copies)])
    return tokens, members


# --------------------------------------------------------------------------
# wrappers: lists of slots [path, optional, repeated, pages, chars, links, text digest or None,
# digests of up to CONSTANT different pages with that text]
# --------------------------------------------------------------------------

def align(a: list[list], b: list[list], key=lambda t: t[0]) -> list[tuple[int | None, int | None]]:
    """Longest common alignment of two streams by their paths."""
    number: dict[str, int] = {}
    x = np.array([number.setdefault(key(t), len(number)) for t in a], dtype=np.int64)
    y = np.array([number.setdefault(key(t), len(number)) for t in b], dtype=np.int64)
    pairs = list(_common(x, y))
    out: list[tuple[int | None, int | None]] = []
    i = j = 0
    for u, v in [*pairs, (len(a), len(b))]:
        out += [(k, None) for k in range(i, u)] + [(None, k) for k in range(j, v)]
        if u < len(a):
            out.append((u, v))
        i, j = u + 1, v + 1
    return out


def _row(row: np.ndarray, token: int, y: np.ndarray) -> np.ndarray:
    """Next row of the table of longest common subsequences with prefixes of ``y``."""
    new = row.copy()
    new[1:] = np.where(y == token, row[:-1] + 1, row[1:])
    return np.maximum.accumulate(new)


def _common(x: np.ndarray, y: np.ndarray, at: int = 0, to: int = 0):
    """Places of a longest common subsequence, ascending: equal ends are cut
    off, a small rest is read from its table, a large one is halved where the
    lengths of both halves add up to the most."""
    lo = 0
    while lo < min(len(x), len(y)) and x[lo] == y[lo]:
        yield at + lo, to + lo
        lo += 1
    hi = 0
    while hi < min(len(x), len(y)) - lo and x[-1 - hi] == y[-1 - hi]:
        hi += 1
    n, m = len(x) - hi, len(y) - hi
    u, v = x[lo:n], y[lo:m]
    if len(u) and len(v):
        if len(u) == 1 or len(u) * len(v) <= CELLS:
            rows = [np.zeros(len(v) + 1, dtype=np.int64)]  # of the reversed streams: rows[i][j] is for u[-i:], v[-j:]
            for token in u[::-1]:
                rows.append(_row(rows[-1], token, v[::-1]))
            i, j = len(u), len(v)
            while i and j and rows[i][j]:
                if u[-i] == v[-j]:
                    yield at + n - i, to + m - j
                    i, j = i - 1, j - 1
                elif rows[i - 1][j] >= rows[i][j - 1]:
                    i -= 1
                else:
                    j -= 1
        else:
            half = len(u) // 2
            first = second = np.zeros(len(v) + 1, dtype=np.int64)
            for token in u[:half]:
                first = _row(first, token, v)
            for token in u[half:][::-1]:
                second = _row(second, token, v[::-1])
            cut = int(np.argmax(first + second[::-1]))
            yield from _common(u[:half], v[:cut], at + lo, to + lo)
            yield from _common(u[half:], v[cut:], at + lo + half, to + lo + cut)
    for k in range(hi):
        yield at + n + k, to + m + k


def merge(a: list[list], b: list[list]) -> list[list]:
    """The wrapper that matches what either matches."""
    out = []
    for i, j in align(a, b):
        if i is None or j is None:
            s = list(a[i] if j is None else b[j])
            s[1] = True
        else:
            s = [a[i][0], a[i][1] or b[j][1], a[i][2] or b[j][2], *(a[i][k] + b[j][k] for k in (3, 4, 5)),
                 a[i][6] if a[i][6] == b[j][6] else None]
            # the union's least ones: right up to CONSTANT however the pages are merged
            s.append(sorted({*_pages(a[i]), *_pages(b[j])})[:CONSTANT] if s[6] is not None else [])
        out.append(s)
    return refold(out)


def _pages(slot: list) -> list[str]:
    return slot[7] if len(slot) > 7 else []


def refold(slots: list[list]) -> list[list]:
    """Neighbouring slots of one path, such as two optional ones, become one repeated slot."""
    out: list[list] = []
    for s in slots:
        if out and out[-1][0] == s[0]:
            t = out[-1]
            out[-1] = [t[0], t[1] and s[1], True, max(t[3], s[3]), t[4] + s[4], t[5] + s[5], None, []]
        else:
            out.append(s)
    return out


def expression(slots: list[list]) -> str:
    """The wrapper as a union-free regular expression over paths."""
    return " ".join(f"({p} #TEXT)" + ("*" if o and r else "?" if o else "+" if r else "") for p, o, r, *_ in slots)


def _is_noise(path: str) -> bool:
    inside = False
    for name in path.split("/"):
        tag, *classes = name.split(".")
        words = {w.lower() for c in classes for w in _WORDS.findall(c)}
        if tag == "hidden" or tag in NOISE_TAGS or tag == "header" and not inside:
            return True
        if words & NOISE and tag not in ("article", "main", "body", "html") and not words & {"article", "post", "entry"}:
            return True
        if words & NOISE and words & {"article", "post", "entry"} and not words & CONTENT - {"article", "post", "entry"} and tag != "article":
            if words & {"comment", "comments", "ad", "ads", "footer", "sidebar", "related", "nav", "share"}:
                return True
        inside = inside or tag in ("article", "main")
    return False


def _kind(path: str) -> int:
    """3 inside an article, 2 inside main, 1 inside a content container, else 0."""
    best = 0
    for name in path.split("/"):
        tag, *classes = name.split(".")
        words = {w.lower() for c in classes for w in _WORDS.findall(c)}
        best = max(best, 3 if tag == "article" or "articleBody" in classes else 2 if tag == "main" or words == {"main"} else
                   1 if words & CONTENT and tag not in ("body", "html") else 0)
    return best


def _container(path: str, kind: int) -> str:
    """The named container of a slot, else its parent."""
    names = path.split("/")
    if kind:
        return "/".join(names[:next(i for i in range(1, len(names) + 1) if _kind("/".join(names[:i])) == kind)])
    return "/".join(names[:-1])


def _frame(slot: list) -> bool:
    """Whether a slot's text is the same on several pages, or mostly links."""
    return slot[6] is not None and len(_pages(slot)) >= CONSTANT or 2 * slot[5] > slot[4]


def main_slots(slots: list[list]) -> list[bool]:
    """Which slots of a host's wrapper are main text."""
    frame = [_frame(s) for s in slots]
    clean = [not _is_noise(s[0]) for s in slots]
    kinds = [_kind(s[0]) if c else 0 for s, c in zip(slots, clean)]
    weight: dict[tuple[int, str], int] = {}
    for s, f, c, k in zip(slots, frame, clean, kinds):
        if c and not f:
            home = k, _container(s[0], k)
            weight[home] = weight.get(home, 0) + s[4]
    if not weight:  # nothing varies: names alone
        top = max(kinds, default=0)
        return [c and k == top and (top > 0 or not f) for c, k, f in zip(clean, kinds, frame)]
    heaviest = max(weight.values())
    (kind, home), _ = max(weight.items(), key=lambda w: (TIE * w[1] >= heaviest and w[0][0], w[1], w[0][1]))
    if kind:
        heads = [s[0].rpartition("/")[2].partition(".")[0] in HEADS for s in slots]
        return [c and k == kind and (kind == 3 or h or not f) for c, k, f, h in zip(clean, kinds, frame, heads)]
    return [c and not f and (not home or (s[0] + "/").startswith(home + "/")) for s, f, c in zip(slots, frame, clean)]


def _digest(texts: list[str]) -> str:
    return hashlib.blake2b("\n".join(texts).encode(), digest_size=8).hexdigest()


# --------------------------------------------------------------------------
# jobs
# --------------------------------------------------------------------------

def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The wrapper of every host: (host, slots as JSON, expression)."""

    def shapes(batches):
        for b in batches:
            seen: dict[tuple[str, str], list[list]] = {}
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = blocks(page or "")
                tokens, members = stream(found)
                whole = _digest([f"{path}\t{text}" for path, text, _ in found])
                own = [[p, False, r, 1, sum(len(found[i][1]) for i in at), sum(found[i][2] for i in at),
                        _digest([found[i][1] for i in at]), [whole]] for (p, r), at in zip(tokens, members)]
                key = (host_of(url), json.dumps([p for p, _ in tokens]))
                seen[key] = merge(seen[key], own) if key in seen else own
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in seen], pa.string()),
                 pa.array([int(_digest([s]), 16) >> 1 for _, s in seen], pa.int64()),
                 pa.array([json.dumps(v) for v in seen.values()], pa.string())], names=["host", "salt", "slots"])

    def join(table: pa.Table) -> pa.Table:
        streams = [json.loads(x) for x in table.column("slots").to_pylist()]
        whole: list[list] | None = None
        for s in sorted(streams, key=lambda v: (-(v[0][3] if v else 0), json.dumps(v))):
            whole = s if whole is None else merge(whole, s)
        row = table.slice(0, 1)
        return pa.table({"host": row.column("host"), "salt": row.column("salt"), "slots": pa.array([json.dumps(whole)], pa.string())})

    schema = "host string, salt long, slots string"
    parts = materialize(pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(shapes, schema), "streams")
    while True:
        held = materialize(parts.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups")), "groups")
        parts = (parts.join(held, "host").withColumn("salt", F.pmod("salt", "groups")).drop("groups")
                 .groupBy("host", "salt").applyInArrow(join, schema))
        if (held.agg(F.max("groups")).first()[0] or 1) == 1:
            break
        parts = materialize(parts, "wrappers")
    whole = parts.select("host", "slots")

    @F.pandas_udf("string")
    def shown(slots):
        return slots.map(lambda x: expression(json.loads(x)))

    return whole.withColumn("expression", shown("slots"))


def _page_text(page: str | None, slots: list[list], main: list[bool], known: dict) -> str:
    found = blocks(page or "")
    tokens, members = stream(found)
    shape = tuple(p for p, _ in tokens)
    if (keep := known.get(shape)) is None:
        slot = {j: i for i, j in align(slots, [list(t) for t in tokens]) if i is not None and j is not None}
        by_path = {s[0]: m for s, m in zip(slots, main)}
        keep = [main[slot[j]] if j in slot else by_path.get(p, False) for j, (p, _) in enumerate(tokens)]
        if not any(keep) and tokens:  # none of the host's main slots is on this page: its own stream decides
            own = [[p, False, r, 1, sum(len(found[i][1]) for i in at), sum(found[i][2] for i in at), None]
                   for (p, r), at in zip(tokens, members)]
            keep = main_slots(own)
        if len(known) < 10_000:
            known[shape] = keep
    return "\n".join(found[i][1] for i in sorted(i for k, at in zip(keep, members) if k for i in at))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    spark = pages.sparkSession
    wrappers = materialize(infer(pages).select("host", "slots"), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("slots") + F.octet_length("host")), F.lit(0)).alias("b")).first()["b"]
    small = size <= BROADCAST_BYTES
    shared = spark.sparkContext.broadcast(
        {r["host"]: r["slots"] for r in wrappers.collect()} if small else None)
    src = pages.select("page_id", "url", "html")
    if not small:
        host = F.udf(host_of, "string")
        src = src.withColumn("host", host("url")).join(wrappers, "host", "left").select("page_id", "url", "html", "slots")

    def work(batches):
        held: dict[str, tuple] = {}
        for b in batches:
            texts = []
            slots_of = b.column(3).to_pylist() if shared.value is None else None
            for i, (url, page) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                host = host_of(url)
                if host not in held:
                    if len(held) > 1_000:
                        held.clear()
                    raw = shared.value.get(host) if slots_of is None else slots_of[i]
                    slots = json.loads(raw) if raw else []
                    held[host] = (slots, main_slots(slots), {})
                texts.append(_page_text(page, *held[host]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return src.mapInArrow(work, f"page_id {kind}, url string, text string, n_chars long")
