"""The main text of web pages, by structure and by what repeats across a host's pages.

A page is cut into blocks of text. Structure decides where it can: what lies in an article (else
the main part) is text, but for parts of it that are menus, forms, adverts, comments and the
like; everything beside the article is none. Where a page has no such part, its host decides. The token
streams of a host's pages, as far as they are not in an article, form one long text with a border
between pages. Suffixes that begin with the same ``run`` tokens lie side by side in its suffix array; where
they come from enough different pages, the run is boilerplate. What such runs cover is removed, and the other
runs stay. Pages of one text are one page. Enough are two and the square root of the number of the host's
pages, and more than half of them for a block shorter than ``run``, as headings such as "Introduction" are.

The suffix array of a host is never in one place, as a host may have a third of all pages: each
suffix is a row that carries the fingerprint of its host and its first ``run`` tokens, and the rows
of one fingerprint are its neighbours. They are counted once for each page, then by fingerprint, both in part
before they are exchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.functions import quoted
from millrace.llm.shared import stored

# Names of HTML elements by their role.
_RAW = "script|style|textarea|title|xmp|noframes"
#: Elements without text of the page; the last two may hold others of their name.
_SKIPPED = "noscript iframe object canvas audio video select datalist button svg template".split()
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: MathML is text of its line. Its annotations say the same again.
_MATH = frozenset(
    "math maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics annotation annotation-xml".split()
)
_ANNOTATION = frozenset({"annotation", "annotation-xml"})
_INLINE = _MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img picture map area embed input".split()
)
_WALLS = frozenset({"article", "main", "body"})
_BESIDE = frozenset("nav footer aside form menu dialog fieldset search head option optgroup".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_CLOSES |= {"option": {"option"}, "optgroup": {"option", "optgroup"}}
#: Words that name, alone or beside _PLAIN ones, parts that are no text: in classes, ids and roles.
_JUNK = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising alertdialog banner breadcrumb breadcrumbs "
    "comment comments commentlist complementary consent contentinfo cookie cookies dialog disqus "
    "footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter "
    "overlay pager pagination popup promo promoted replies respond sharebar "
    "sidebar signin signup sponsored subscribe toolbar widget widgets".split()
)
#: Words that name text as well: the host's other pages must confirm them.
_ASK = frozenset(
    "alert copyright discussion notice notices notification promotion related search share sharing skip social sponsor "
    "subscription".split()
)
#: Words that say nothing about what a part is.
_PLAIN = frozenset(
    "article area bar block blog body bottom box button buttons container content entry form global google group holder icon "
    "icons inner item items js label link links list main outer page panel placeholder post posts primary secondary section "
    "site slot thread title top unit user wrap wrapper x".split()
)
#: Those that name the head of an article when they are in it.
_HEAD = frozenset({"header", "banner", "masthead"})

_QUOTED = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>]){_QUOTED}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>{_QUOTED})>"
    r"|<[!?/a-zA-Z][^>]*>",
    re.S | re.I,
)
#: The next end tag of a skipped element, or that or the next start tag where one may not hold another.
_EDGE = {
    x: re.compile(rf"<(?:(?P<end>/){x}\s*>" + (")" if x in ("svg", "template") else rf"|{x}(?=[\s/>]))"), re.I) for x in _SKIPPED
}
_ATTR = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/]+)")
_HALF = re.compile("[\ud800-\udfff]")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Whether an element's names say that it is text, may be none, or is none.
_NO, _MAYBE, _YES = 0, 1, 2

#: What a block is: text for sure, no text for sure, or for the host to decide.
TEXT, JUNK, OPEN = 0, 1, 2
_SALTS = 16


def _names(name: str, attrs: str) -> tuple[list[set[str]], bool, bool]:
    """The words of each class, id and role; whether it is hidden; whether it is the main part.

    Ids of headings and sections are made from their titles, so they are no names.
    """
    found: list[set[str]] = []
    ids: list[set[str]] = []
    hidden = main = False
    for m in _ATTR.finditer(attrs):
        key = (m[1] or m[5]).lower()
        value = m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            (ids if key == "id" else found).extend({w.lower() for w in _NAME_WORD.findall(x)} for x in value.split())
            main |= key == "role" and value.strip().lower() in ("main", "article")
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif key == "style":
            hidden |= re.sub(r"\s", "", value.lower()).find("display:none") >= 0
    if name not in _HEADINGS and name != "section" and {"section"} not in found:
        found += ids
    return found, hidden, main


def _junk(names: list[set[str]], inside: bool) -> int:
    """What whole names say. One with a word of another meaning, as in "share-price", says nothing."""
    sure = _JUNK - _HEAD if inside else _JUNK
    told = [n for n in names if n <= sure | _ASK | _PLAIN | (_HEAD if inside else frozenset())]
    return _YES if any(n & sure for n in told) else _MAYBE if any(n & _ASK for n in told) else _NO


def page_blocks(html: str) -> list[tuple[str, int]]:
    """The blocks of a page in order, white space made single, and what each is."""
    stack: list[tuple[str, bool, tuple[int, bool, int]]] = []  # element, whether it makes junk, state outside
    opened: dict[str, list[int]] = {}  # where in the stack elements of a name are
    walls: list[int] = []  # where those are that end tags of inline elements do not reach beyond
    beside = 0  # how many make junk of what is beside the text
    blocks: list[tuple[str, int, int]] = []  # text, junk, part
    parts: list[tuple[str, bool]] = []  # article or main, junk
    pieces: list[str] = []
    junk, muted, part = _NO, False, -1

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append((text, junk, part))
            pieces.clear()

    def push(name: str, makes_junk: bool, outside: tuple[int, bool, int]) -> None:
        nonlocal beside
        opened.setdefault(name, []).append(len(stack))
        if name in _WALLS:
            walls.append(len(stack))
        beside += makes_junk and name in _BESIDE
        stack.append((name, makes_junk, outside))

    def pop(at: int) -> None:
        nonlocal junk, muted, part, beside
        if any(x[0] not in _INLINE for x in stack[at:]):
            flush()
        junk, muted, part = stack[at][2]
        for name, makes_junk, _ in stack[at:]:
            opened[name].pop()
            beside -= makes_junk and name in _BESIDE
        while walls and walls[-1] >= at:
            walls.pop()
        del stack[at:]

    def say(text: str) -> None:
        if text and not muted:
            pieces.append(text)

    unclosed: set[str] = set()

    def behind(name: str, at: int) -> int:
        """Where a skipped element ends. One that is never closed ends at once, and hides no text."""
        edge = None if name in unclosed else _EDGE[name].search(html, at, end)
        if edge is None:
            unclosed.add(name)
        return edge.end() if edge and edge["end"] else at

    # Behind the last tag there is none; a comment that is never closed hides the rest.
    end = html.rfind(">") + 1
    at = 0
    while m := _TAG.search(html, at, end):
        say(html[at : m.start()])
        at = m.end()
        if m["name"] is None:
            if m["raw"]:
                flush()
            continue
        name, attrs = m["name"].lower(), m["attrs"]
        if m["end"]:
            last = opened.get(name)
            if name not in _INLINE:
                if last:
                    pop(last[-1])
                else:
                    flush()
            elif last and (not walls or last[-1] > walls[-1]):
                pop(last[-1])
            continue
        if name in _VOID:
            if name not in _INLINE:
                flush()
            continue
        if name in _EDGE:
            flush()
            if name != "svg" or not attrs.endswith("/"):
                at = behind(name, at)
            continue
        if name in _MATH:
            if name in ("mtr", "mtd"):
                say(" ")
            if attrs.endswith("/"):
                continue
        names, hidden, main = _names(name, attrs) if "=" in attrs or "hidden" in attrs else ([], False, False)
        outside = (junk, muted, part)
        if name in _INLINE:  # does not end the block; what it hides is left out of it
            # Code marks its comments by that name.
            odd = hidden or name in _ANNOTATION or _junk([n for n in names if n != {"comment"}], part >= 0) == _YES
            if odd or opened.get(name):
                muted = muted or odd
                push(name, False, outside)
            continue
        flush()
        if stack and stack[-1][0] == "p":
            pop(len(stack) - 1)
        while stack and stack[-1][0] in _CLOSES.get(name, ()):
            pop(len(stack) - 1)
        outside = (junk, muted, part)
        is_part = name in ("article", "main") or main
        if is_part and part >= 0 and name == "article" and parts[part][0] == "article":
            junk = _YES  # an article in an article is a comment on it
        elif is_part:
            away = junk == _YES and beside > 0
            kind = "article" if name == "article" or any("article" in n for n in names) else "main"
            parts.append((kind, away or hidden or (kind == "article" and _junk(names, True) == _YES)))
            part, junk = len(parts) - 1, _NO
        elif name not in ("html", "body"):
            odd = hidden or name in _BESIDE or (name == "header" and part < 0)
            junk = _YES if odd else max(junk, _junk(names, part >= 0))
        push(name, junk == _YES and outside[0] != _YES, outside)
    say(html[at:].split("<!--", 1)[0])
    flush()

    # The article with the most text, else the main part with the most; without one all is open.
    sizes: dict[int, int] = {}
    for text, bad, p in blocks:
        if p >= 0 and bad != _YES and not parts[p][1]:
            sizes[p] = sizes.get(p, 0) + len(text)
    best = max(sizes, key=lambda p: (parts[p][0] == "article", sizes[p], -p), default=-1)
    if best < 0:
        return [(text, JUNK if bad == _YES else OPEN) for text, bad, _ in blocks]
    return [(text, (TEXT, OPEN, JUNK)[bad] if p == best else JUNK) for text, bad, p in blocks]


def _runs(text: str, run: int, salt: bytes) -> list[int]:
    """Fingerprints of the suffixes of a block: of ``run`` tokens each, or of a shorter block, which are odd."""
    tokens = text.split(" ")
    n = max(1, len(tokens) - run + 1)
    short = int(len(tokens) < run)
    return [
        xxhash.xxh64_intdigest(salt + " ".join(tokens[i : i + run]).encode("utf-8", "replace")) & ~1 | short for i in range(n)
    ]


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def main_text(
    pages: DataFrame,
    run: int = 8,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    Blocks are joined by single blanks, character references decoded. A null or empty page
    has an empty text. Pages of a null url are a host of their own. Repeated rows get the same text
    and count as one page when runs are compared, as do all pages of one text. An empty table gives an empty
    result. Other columns are ignored. A block without article goes if runs that enough pages of its host share
    cover more than half of its tokens.
    """
    host = F.lower(F.regexp_extract(F.coalesce(quoted(url), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    rows = pages.select(
        quoted(page_id).cast("long").alias("page_id"),
        quoted(url).cast("string").alias("url"),
        F.coalesce(quoted(html).cast("string"), F.lit("")).alias("html"),
    )
    keyed = rows.withColumn("page", F.xxhash64("page_id", "url", "html"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What suffixes outside articles begin with, once a page, and the host itself; by digests of the pages' texts."""
        for batch in batches:
            keys, owners, digests = [], [], []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                salt = name.encode() + b"\0"
                blocks = page_blocks(body)
                own = xxhash.xxh64_intdigest(salt)
                found = {own}
                for text, kind in blocks:
                    if kind == OPEN or (kind == JUNK and len(text) > 1):
                        found.update(_runs(text, run, salt))
                keys += found
                owners += [own] * len(found)
                whole = "\n".join(text for text, kind in blocks if kind != JUNK)
                digests += [xxhash.xxh64_intdigest(whole.encode("utf-8", "replace"))] * len(found)
            yield pa.RecordBatch.from_arrays([_signed(keys), _signed(owners), _signed(digests)], names=["key", "owner", "digest"])

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffixes of open blocks: what they begin with, and where they are."""
        for batch in batches:
            hosts, page_keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, owners, numbers, places = [], [], [], []
            for name, page, body in zip(hosts, page_keys, batch.column(2).to_pylist(), strict=True):
                salt = name.encode() + b"\0"
                for number, (text, kind) in enumerate(page_blocks(body)):
                    if kind == OPEN:
                        found = _runs(text, run, salt)
                        # The size of the block is at a place before its first.
                        keys += [*found, 0]
                        owners += [page] * (len(found) + 1)
                        numbers += [number] * (len(found) + 1)
                        places += [*range(len(found)), -1 - text.count(" ")]
            yield pa.RecordBatch.from_arrays(
                [_signed(keys), pa.array(owners, pa.int64()), pa.array(numbers, pa.int32()), pa.array(places, pa.int32())],
                names=["key", "page", "block", "place"],
            )

    pages_of = (
        keyed.select(host.alias("host"), "html").mapInArrow(counted, "key long, owner long, digest long")
        .distinct().groupBy("key", "owner").agg(F.count("*").alias("n")).filter("n > 1")
    )
    repeated = stored(pages_of, "repeated-runs")
    # A host may have a third of all runs: its size is joined to parts of them.
    salts = F.explode(F.array(*(F.lit(i) for i in range(_SALTS)))).alias("salt")
    sizes = repeated.filter("key = owner").select("owner", F.col("n").alias("pages"), salts)
    runs = repeated.filter("key <> owner").withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(_SALTS)).cast("int"))
    enough = F.when(
        F.col("key") % 2 != 0, F.greatest(F.least(F.lit(3), F.col("pages")), F.floor(F.col("pages") / 2) + 1)
    ).otherwise(F.ceil(F.sqrt("pages")))
    shared = runs.join(sizes, ["owner", "salt"]).filter(F.col("n") >= enough).select("key")
    inside = keyed.select(host.alias("host"), "page", "html").mapInArrow(
        suffixes, "key long, page long, block int, place int"
    ).join(shared.withColumn("hit", F.lit(True)), "key", "left")
    covered = inside.groupBy("page", "block").agg(
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("place")))).alias("places"),
        F.max(F.when(F.col("place") < 0, -F.col("place"))).alias("size"),
    )
    n_covered = F.expr(
        f"aggregate(places, named_struct('upto', 0, 'n', 0), (s, p) -> named_struct('upto', least(size, p + {run}),"
        f"'n', s.n + greatest(0, least(size, p + {run}) - greatest(s.upto, p)))).n"
    )
    gone = covered.filter(n_covered * 2 > F.col("size")).groupBy("page").agg(F.collect_set("block").alias("gone"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, dropped in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                skip = set(dropped or ())
                out.append(" ".join(t for i, (t, kind) in enumerate(page_blocks(body)) if kind != JUNK and i not in skip))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([_clean(t) for t in out], pa.string())], names=["page_id", "url", "text"]
            )

    joined = keyed.join(gone, "page", "left").select("page_id", "url", "html", "gone")
    return joined.mapInArrow(extract, "page_id long, url string, text string").withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def _clean(text: str) -> str:
    """Without half characters that a character reference may name and UTF-8 cannot have."""
    return _HALF.sub("\ufffd", text)
