"""Main-text extraction by union-free regular-expression inference.

Pages of one host are token streams of the same templates. A wrapper is a union-free regular expression over
nested tags: an ordered list of parts per element, each part once, optional ``?`` or repeated ``+``, with text slots.
Aligning a stream with a wrapper resolves a mismatch in the stated ways: a part that one side lacks becomes
optional, a part met again becomes repeated, parts that come back in another order make the list a repeated group, and
text that differs becomes a slot. Alignment of two wrappers is the same step, so wrappers are merged inside a task,
then per host and salt, then per host: every page takes part, and a hot host is never gathered whole.

The host's wrapper alone decides what is text; a page read without its decisions keeps all text. It says

* which places hold the article: those marked as article or main, the outermost of them, else the place to which
  one part after the other leads that has most of the text which differs from page to page;
* what goes: elements whose tag, role or attributes make them navigation, forms, asides or hidden; slots with the
  same text on nearly all pages of the host (at least five of which differ in their longest text); outside the article's
  places also slots whose texts come back on other pages, links alone, and repeated groups of records (comments,
  teasers), where the pages show them;
* names of classes and ids only break ties: an element is taken for boilerplate by its name if all words of it
  say so, and not where it holds most of an article's text.

A page is read below the article's places and its own marks if they hold nearly all of its remaining text, and whole
otherwise, so no text is lost to places that other pages chose.

Defined cases: a null page gives an empty text; pages without a host share one wrapper; unclosed and stray tags
are closed or ignored as browsers do, a tag that never ends is text; pages are read in time in proportion to
their length; an empty table gives no rows; repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import join_heavy
from .common import stored

SALTS = 64
#: Rules of all hosts up to this size go to every executor.
RULES_CHARS = 32_000_000
_DEPTH = 150  # the text of deeper elements is read as part of the one at this depth, of boilerplate not at all
_HOSTS_HELD = 5000
_START = re.compile(r"<(?:(/?)([a-zA-Z][\w:-]*)|[!?])")
_QUOTED = re.compile(r"=\s*[\"']|>")
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SILENT = {"script", "style", "template", "iframe", "svg", "textarea", "select", "title", "button", "datalist"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"})}
_DROPPED_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "head"}
_DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
_DROPPED_NAMES = set(
    "ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs masthead topbar footer sidebar aside cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond "
    "widget widgets pagination pager login search searchform toolbar skip copyright paywall disclaimer".split()
)
_NEUTRAL_NAMES = set(
    "box list wrapper wrap container section area bar block inner outer top bottom left right site page global link links icon icons button buttons form item "
    "items thread header title unit slot panel row col column primary secondary mobile desktop post article entry blog js id main and the of".split()
)
_CONTENT_NAMES = {"content", "article", "articlebody", "post", "entry", "story", "text", "body", "maincontent", "main"}
_OWN_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "blockquote", "pre", "dd", "dt", "figcaption", "caption"}


#: How an element's own marks speak against it: not at all, by the words of its name, by its tag, role or attributes.
NONE, NAMED, MARKED = 0, 1, 2


class Node:
    __slots__ = ("tag", "sig", "hint", "kids", "main", "within")

    def __init__(self, tag: str, sig: str, hint: int = NONE, main: bool = False) -> None:
        self.tag, self.sig, self.hint, self.main = tag, sig + "!" * hint, hint, main
        self.within = main  # in an article's mark, its own or an outer one's; set when opened
        self.kids: list[Node | str] = []


def _words(name: str) -> set[str]:
    return {w for w in re.split(r"[^a-z]+", name) if w}


def _says_boilerplate(name: str) -> bool:
    """Whether a name's words are all of boilerplate or neutral, and some are of boilerplate."""
    words = set() if name.startswith(("has-", "with-", "no-", "is-")) else _words(name)
    return bool(words & _DROPPED_NAMES) and words <= _DROPPED_NAMES | _NEUTRAL_NAMES


def _opened(tag: str, attributes: str, in_article: bool) -> Node | None:
    """The element if it counts for the structure: a block, or something whose marks say what it is."""
    classes: list[str] = []
    ids: list[str] = []
    role, hidden, main = "", False, tag in ("article", "main")
    if attributes and "=" in attributes or "hidden" in attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                (classes if key == "class" else ids).extend(value.split())
            elif key == "role":
                role = value.strip()
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
            elif key == "itemprop" and value == "articlebody":
                main = True
    main = main or role == "main"
    header = any({"header"} <= (w := _words(name)) and not w & {"article", "post", "entry"} for name in classes + ids)
    if hidden:
        hint = MARKED
    elif tag in ("html", "body") or main and tag != "article":
        hint = NONE
    elif tag in _DROPPED_TAGS or role in _DROPPED_ROLES or not in_article and tag == "header":
        hint = MARKED
    elif any(map(_says_boilerplate, classes + ids)) or not in_article and header and tag not in _OWN_TEXT:
        hint = NAMED
    else:
        hint = NONE
    if tag not in _BLOCK and not hint and not main:
        return None
    # An id counts as a name only where it says what the element is: ids are often unique, classes are not.
    telling = sorted({word for name in ids for word in _words(name) & _CONTENT_NAMES})
    name = re.sub(r"\d{2,}", "#", (classes + telling)[0]) if classes or telling else ""
    return Node(tag, f"{tag}.{name}" if name else tag, hint, main and not hint)


class _Page:
    """Finds tags one after the other, each character looked at a bounded number of times."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.last_end = text.rfind(">")
        self.last = {q: text.rfind(q) for q in "\"'"}
        self.quotes_until = len(text)  # from here on quotes don't count: a tag that began here had no end with them

    def end_of_tag(self, at: int) -> int:
        """The place of the tag's ``>``, not one inside a quoted value; -1 without any."""
        if at > self.last_end:
            return -1
        if at < self.quotes_until:
            place = at
            while found := _QUOTED.search(self.text, place):
                if found[0] == ">":
                    return found.start()
                quote = found[0][-1]
                if found.end() > self.last[quote]:
                    break
                place = self.text.find(quote, found.end()) + 1
            self.quotes_until = at
        return self.text.find(">", at)

    def tags(self) -> Iterator[tuple[int, int, str, str, str]]:
        """(start, end, slash, name, attributes); name is "" for comments and the like, "<![" for character data."""
        text, at = self.text, 0
        while found := _START.search(text, at):
            start = found.start()
            if found[2]:
                end = self.end_of_tag(found.end())
                if end < 0:
                    at = found.end()
                    continue
                skip = yield start, end + 1, found[1], found[2].lower(), text[found.end() : end]
                at = skip if skip else end + 1
                continue
            for begin, finish in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("", ">")):
                if text.startswith(begin, start) and begin or not begin:
                    end = text.find(finish, start + len(begin)) if finish != ">" or start < self.last_end else -2
                    break
            if end == -2:  # no end anywhere: text
                at = found.end()
                continue
            at = len(text) if end < 0 else end + len(finish)
            inner = text[start + 9 : end if end >= 0 else len(text)] if begin == "<![CDATA[" else ""
            yield start, at, "", "<![" if inner else "", inner


def parse(page: str | None) -> Node:
    """The page's tree of structural elements and text runs; other tags leave no trace but their text."""
    root = Node("", "")
    stack, text, at = [root], page or "", 0
    links = 0  # depth of links: their text is marked by a leading NUL
    ends: dict[str, bool] = {}  # silent tags: whether an end was found the last time

    opened: Counter[str] = Counter()  # open elements by tag, so that stray ends need no look through the stack

    def close(n: int) -> None:
        opened.subtract(node.tag for node in stack[n:])
        parted = n >= _DEPTH and any(node.tag in _BLOCK for node in stack[n:])
        del stack[n:]
        if parted:
            stack[-1].kids.append(Node("br", ""))

    def add(run: str) -> None:
        if run:
            stack[-1].kids.append("\0" + run if links else run)

    tags = _Page(text).tags()
    skip: int | None = None
    while True:
        try:
            start, end, slash, tag, attributes = tags.send(skip)
        except StopIteration:
            break
        skip = None
        if start > at:
            add(text[at:start])
        at = end
        if not tag or tag == "<![":
            add(attributes)
            continue
        if slash:
            if tag == "a":
                links = max(0, links - 1)
            for n in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[n].tag == tag:
                    close(n)
                    break
                if tag not in _BLOCK and stack[n].tag in _BLOCK:
                    break
            else:
                if tag == "p":
                    stack[-1].kids.append(Node("br", ""))
            continue
        if tag in _SILENT:
            if not attributes.rstrip().endswith("/"):
                closing = ends.get(tag)
                found = re.compile(rf"</{tag}\s*>", re.I).search(text, at) if closing is None or closing else None
                ends[tag] = bool(found)
                at = skip = found.end() if found else len(text)
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                stack[-1].kids.append(Node("br", ""))
            continue
        if tag == "a":
            links += 1
        node = _opened(tag, attributes, stack[-1].within)
        if node is None:
            continue
        if tag in _BLOCK:
            links = 0
            if stack[-1].tag == "p":
                close(len(stack) - 1)
            closes, stops = _CLOSES.get(tag, ((), ()))
            for n in range(len(stack) - 1 if any(opened[t] for t in closes) else 0, 0, -1):
                if stack[n].tag in stops:
                    break
                if stack[n].tag in closes:
                    close(n)
                    break
        node.within = node.main or stack[-1].within
        if len(stack) < _DEPTH:
            stack[-1].kids.append(node)
        else:  # stays open so that ends match; what it holds goes to the element at the depth, or with the dropped
            if tag in _BLOCK:
                stack[-1].kids.append(Node("br", ""))
            if not node.hint:
                node.kids = stack[-1].kids
        stack.append(node)
        opened[tag] += 1
    if at < len(text):
        add(text[at:])
    return root


# A wrapper is plain data: n (times seen), pages (that have it), order, kids by signature, in (how many of n have the kid),
# rep, loop, chars and link chars of its own slot, text (the same everywhere, "" none yet, None: a slot), of (marks of up
# to DIFFERENT pages that have this text), seen (of a slot without parts: for the VALUES least hashes of its texts, up to two
# marks of pages that have it), hint, main.

#: A text counts as constant on so many pages that differ in their longest text, and on this share of the host's pages; so
#: much of a page's text is in the article's places where they are used.
DIFFERENT = 5
NEARLY_ALL = 0.9
#: A part leads on to the article if it has this share of the text that differs.
MOST = 0.6
VALUES = 16


def _longest(node: Node) -> str:
    """The longest run of text outside links and boilerplate; copies of a page share it."""
    runs = [kid if isinstance(kid, str) else _longest(kid) for kid in node.kids if isinstance(kid, str) and kid[0] != "\0" or isinstance(kid, Node) and not kid.hint]
    return max(runs, key=len, default="")


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def wrapper_of(node: Node, page: str | None = None) -> dict:
    page = _digest(" ".join(_longest(node).split())) if page is None else page
    out = {"n": 1, "pages": 1, "of": [], "order": [], "kids": {}, "in": {}, "rep": [], "loop": False, "chars": 0, "links": 0, "text": "", "seen": {}, "hint": node.hint, "main": node.main}
    before, own = None, []
    for kid in node.kids:
        if isinstance(kid, str):
            run = kid.lstrip("\0").strip()
            out["chars"] += len(run)
            out["links"] += len(run) if kid[0] == "\0" else 0
            own.append(run)
            continue
        if kid.tag == "br":
            continue
        inner = wrapper_of(kid, page)
        if kid.sig in out["kids"]:
            if kid.sig not in out["rep"]:
                out["rep"].append(kid.sig)
            out["loop"] = out["loop"] or before != kid.sig
            out["kids"][kid.sig] = merged(out["kids"][kid.sig], inner, True)
        else:
            out["order"].append(kid.sig)
            out["kids"][kid.sig], out["in"][kid.sig] = inner, 1
        before = kid.sig
    text = " ".join(filter(None, own))
    out["text"] = text if len(text) <= 500 else f"{text[:500]} #{_digest(text)}"
    if text and not out["kids"]:
        out["of"] = [page]
        if node.tag not in _OWN_TEXT:
            out["seen"] = {_digest(text)[:12]: [page[:12]]}
    return out


def merged(a: dict, b: dict, same_page: bool = False) -> dict:
    """The wrapper that covers both: elements of one page, or of different pages."""
    place = {sig: n for n, sig in enumerate(a["order"])}
    shared = [place[sig] for sig in b["order"] if sig in place]
    order, rest = [], list(a["order"])
    for sig in b["order"]:
        if sig in place:
            if sig in rest:
                cut = rest.index(sig) + 1
                order, rest = order + rest[:cut], rest[cut:]
        else:
            order.append(sig)
    kids = dict(a["kids"])
    for sig, kid in b["kids"].items():
        kids[sig] = merged(kids[sig], kid, same_page) if sig in kids else kid
    constant = bool(a["text"]) and a["text"] == b["text"]
    least = sorted({*a["seen"], *b["seen"]})[:VALUES]
    return {
        "n": a["n"] + b["n"],
        "pages": max(a["pages"], b["pages"]) if same_page else a["pages"] + b["pages"],
        "of": sorted({*a["of"], *b["of"]})[:DIFFERENT] if constant and not kids else [],
        "order": order + rest,
        "kids": kids,
        "in": {sig: a["in"].get(sig, 0) + b["in"].get(sig, 0) for sig in kids},
        "rep": sorted({*a["rep"], *b["rep"]}),
        "loop": a["loop"] or b["loop"] or shared != sorted(shared),
        "chars": a["chars"] + b["chars"],
        "links": a["links"] + b["links"],
        "text": a["text"] if a["text"] == b["text"] else None,
        "seen": {} if kids else {v: sorted({*a["seen"].get(v, ()), *b["seen"].get(v, ())})[:2] for v in least},
        "hint": a["hint"],
        "main": a["main"] or b["main"],
    }


def expression(w: dict, sig: str = "") -> str:
    """The wrapper as text: tags, #text or constant text, ``?`` and ``+``."""
    parts = ["#text" if w["text"] is None else w["text"]] if w["chars"] else []
    for kid in w["order"]:
        body = f"<{kid}>{expression(w['kids'][kid])}</{kid}>"
        mark = ("+" if kid in w["rep"] else "") + ("?" if w["in"][kid] < w["n"] else "")
        parts.append(f"({body}){mark}" if mark else body)
    inner = "".join(parts)
    return f"({inner})+" if w["loop"] else inner


def _weight(w: dict) -> int:
    """Characters outside links and elements marked as boilerplate, at or below an element."""
    return 0 if w["hint"] else w["chars"] - w["links"] + sum(map(_weight, w["kids"].values()))


def _varying(w: dict) -> int:
    """As :func:`_weight`, without text that is the same wherever it is."""
    own = w["chars"] - w["links"] if w["text"] is None or w["pages"] < 2 else 0
    return 0 if w["hint"] else own + sum(map(_varying, w["kids"].values()))


Path = tuple[str, ...]


def _paths(w: dict, path: Path = ()) -> Iterator[tuple[Path, dict]]:
    yield path, w
    for sig in w["order"]:
        if not w["kids"][sig]["hint"]:
            yield from _paths(w["kids"][sig], (*path, sig))


def marked_paths(w: dict) -> list[Path]:
    """The outermost places marked as article or main, as signatures from the root."""
    out: list[Path] = []
    for path, x in _paths(w):
        if x["main"] and path and not any(path[: len(outer)] == outer for outer in out):
            out.append(path)
    return out


def content_path(w: dict) -> Path:
    """The deepest element named as content with half of the text; () for none."""
    total = _weight(w)
    named = [path for path, x in _paths(w) if path and _words(path[-1].partition(".")[2]) & _CONTENT_NAMES and 2 * _weight(x) >= max(total, 1)]
    return max(named, key=len, default=())


def leading_path(w: dict) -> Path:
    """From the root on, one part after the other with most of the text that differs; down to a group of blocks."""
    path: Path = ()
    while True:
        total = _varying(w)
        heavy = [sig for sig in w["order"] if total and _varying(w["kids"][sig]) >= MOST * total]
        if not heavy or heavy[0].partition(".")[0].rstrip("!") in _OWN_TEXT:
            return path
        path, w = (*path, heavy[0]), w["kids"][heavy[0]]


def _own_texts(path: Path) -> bool:
    return bool({s.partition(".")[0].rstrip("!") for s in path} & _OWN_TEXT)


def constant_paths(w: dict) -> list[Path]:
    """Elements with the same text on nearly all pages of the host, beside text that differs."""
    places = list(_paths(w))
    if sum(x["chars"] for _, x in places if x["text"] is None) * 2 < sum(x["chars"] for _, x in places):
        return []
    return [
        path for path, x in places
        if x["text"] and len(x["of"]) >= DIFFERENT and x["pages"] >= NEARLY_ALL * w["pages"] and not x["kids"] and not x["main"] and not _own_texts(path)
    ]


def _holds_records(w: dict) -> bool:
    """Nearly all of its text is in a repeated part that is made of several parts itself."""
    for sig, kid in w["kids"].items():
        parts = (kid["chars"] > 0) + sum(_weight(k) > 0 for k in kid["kids"].values())
        if _weight(kid) >= NEARLY_ALL * max(_weight(w), 1) and (sig in w["rep"] and parts > 1 or _holds_records(kid)):
            return True
    return False


def _returns(w: dict) -> bool:
    """A slot half of whose texts stand on pages that differ."""
    return not w["kids"] and len(w["seen"]) > 1 and 2 * sum(len(marks) > 1 for marks in w["seen"].values()) >= len(w["seen"])


def boilerplate_paths(w: dict, places: list[Path]) -> list[Path]:
    """What the host's pages show as boilerplate beside the article's places; only hosts with pages enough that differ."""
    if not places or w["pages"] < DIFFERENT:
        return []
    out: list[Path] = []

    def look(x: dict, path: Path) -> None:
        for sig in x["order"]:
            kid, below = x["kids"][sig], (*path, sig)
            if kid["hint"] or kid["main"] or below in places:
                continue
            if any(place[: len(below)] == below for place in places):
                look(kid, below)
            elif _returns(kid) or kid["pages"] >= DIFFERENT and (sig in x["rep"] and len(kid["kids"]) > 1 or _holds_records(kid)):
                out.append(below)
            else:
                look(kid, below)

    look(w, ())
    return out


def hinted_paths(w: dict, path: Path = (), inside: bool = False, share: int = 0) -> list[Path]:
    """The elements whose own marks make them boilerplate; one that is only named so stays with most of an article's text."""
    out: list[Path] = []
    for sig in w["order"]:
        kid, below = w["kids"][sig], (*path, sig)
        if kid["hint"] == MARKED or kid["hint"] == NAMED and not (inside and _plain_weight(kid) > share / 2):
            out.append(below)
        else:
            within = inside or kid["main"]
            out += hinted_paths(kid, below, within, _plain_weight(kid) if within and not inside else share)
    return out


def _plain_weight(w: dict) -> int:
    return w["chars"] - w["links"] + sum(_plain_weight(kid) for kid in w["kids"].values())


def rules_of(w: dict) -> dict:
    """What the wrapper says of its pages: places of the article, places whose links are text, and places that go."""
    marked = marked_paths(w)
    places = marked or [leading_path(w)]
    dropped = hinted_paths(w) + constant_paths(w) + boilerplate_paths(w, [path for path in places if path])
    return {"article": [list(path) for path in marked], "content": list(content_path(w)), "drop": [list(path) for path in dropped]}


def blocks(root: Node, rules: dict) -> list[str]:
    """Text blocks in page order without the places that go: those of the article's places if they hold nearly all text, else all."""
    article, dropped = ({tuple(path) for path in rules.get(key, ())} for key in ("article", "drop"))
    content = tuple(rules.get("content", ()))
    out: list[tuple[str, bool]] = []  # block, whether in the article's places
    run: list[str] = []
    chars = {True: 0, False: 0}

    def flush(inside: bool, links: bool) -> None:
        own = sum(len(part.strip()) for part in run if part[0] != "\0")
        chars[inside] += own
        text = " ".join(references.unescape("".join(part.lstrip("\0") for part in run)).split())
        if text and (own or inside or links or not rules):
            out.append((text, inside))
        run.clear()

    def walk(node: Node, path: Path, inside: bool, links: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                run.append(kid)
                continue
            if kid.tag == "br":
                run.append(" ")
                continue
            below = (*path, kid.sig)
            within = inside or kid.main and bool(rules) or below in article
            apart = kid.tag in _BLOCK or within != inside
            if apart:
                flush(inside, links)
            if below in dropped:
                continue
            named = links or below == content
            walk(kid, below, within, named)
            if apart:
                flush(within, named)

    walk(root, (), False, False)
    flush(False, False)
    placed = [text for text, inside in out if inside]
    return placed if placed and chars[True] >= NEARLY_ALL * sum(chars.values()) else [text for text, _ in out]


def extract(page: str | None, rules: dict | None) -> str:
    """The text of a page by the rules of its host, or, where these are None, by those of its own wrapper."""
    root = parse(page)
    return " ".join(blocks(root, rules_of(wrapper_of(root)) if rules is None else rules))


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url.cast("string")), r"^[a-z][a-z0-9+.-]*://([^/?#]+)", 1), F.lit(""))


def _task_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, dict] = {}
    salt = TaskContext.get().partitionId() % SALTS

    def out() -> pa.RecordBatch:
        arrays = [pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()), pa.array([json.dumps(w) for w in held.values()], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["host", "salt", "wrapper"])

    for batch in batches:
        for host, page in zip(batch.column("host"), batch.column("html")):
            own, host = wrapper_of(parse(page.as_py())), host.as_py()
            held[host] = merged(held[host], own) if host in held else own
        if len(held) > _HOSTS_HELD:
            yield out()
            held.clear()
    yield out()


def _merge_group(rows: pd.DataFrame) -> pd.DataFrame:
    total = None
    for text in sorted(rows["wrapper"]):
        total = merged(total, json.loads(text)) if total else json.loads(text)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [json.dumps(total)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """host, pages (seen), expression and rules of every host."""
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    part = rows.mapInArrow(_task_wrappers, "host string, salt int, wrapper string")
    salted = part.groupBy("host", "salt").applyInPandas(_merge_group, "host string, wrapper string")
    whole = salted.groupBy("host").applyInPandas(_merge_group, "host string, wrapper string")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [json.loads(text) for text in batch["wrapper"]]
            yield pd.DataFrame({"host": batch["host"], "pages": [w["n"] for w in own], "expression": [expression(w) for w in own], "rules": [json.dumps(rules_of(w)) for w in own]})

    return whole.mapInPandas(read, "host string, pages long, expression string, rules string")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rules = stored(wrappers(pages), "html-wrappers").select("host", "rules")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for page, rule in zip(part.column("html"), part.column("rules")):
                    rule = rule.as_py()
                    if len(known) > _HOSTS_HELD:
                        known.clear()
                    if rule is not None and rule not in known:
                        known[rule] = json.loads(rule)
                    texts.append(extract(page.as_py(), known.get(rule)))
                arrays = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    small = (rules.agg(F.sum(F.length("host") + F.length("rules"))).first()[0] or 0) <= RULES_CHARS
    # Beyond that size pages meet their host's rules in a join whose heavy hosts are dealt out in pieces.
    joined = rows.join(F.broadcast(rules), "host", "left") if small else join_heavy(rows, rules, "host", "left")
    return joined.select("page_id", "url", "html", "rules").mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
