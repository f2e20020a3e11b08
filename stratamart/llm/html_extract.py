"""Main text of web pages by equivalence-class template deduction.

Pages of one host are dealt to groups of about ``group_pages`` pages and ``GROUP_CHARS`` characters. In a group, every token (a tag or a word, inside the
article too) with its path of open elements has an occurrence vector: how often it occurs on each distinct page. The words
of a text block that repeats on enough pages are told apart from the same words elsewhere on their path. Tags
with equal vectors form a class, and so do words with equal vectors that have one path and stand in one block of each page;
a class is valid if it is large and frequent enough, if its tokens follow each other in the same order on every page, and
if its occurrences nest in the gaps of the classes around it. A class that is not is split by path, then by order, and what
is valid of it stays. The valid classes are the template; what lies between their tokens are the slots. The main text is what the slots hold in the page's content
region: the article (or else main, or else a container named as content, or else the body), without navigation, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles. Text blocks of any region whose words are all
template are left out; a block with other words stays whole. In a content region, a container whose class or id can only be
that of page furniture (reader comments, cookie notices, newsletters, sidebars, related links, sharing, adverts) is left out
for certain: its parts are all names of furniture and containers, so ``related-posts`` goes and ``related-work`` stays. Other names
of furniture are a hint and count only where their tags are template. Headings and text elements are never judged by name, nor
sections and articles by their ids, which are made from titles.

Copies of one article on several pages of a host would look like a template, so pages count as one if their regions share
``COPY`` of their word triples (``COPY_BODY`` where the region is the body, whose template may be longer than its text);
of long texts the share is measured on ``SKETCH`` triples. Site text that makes up that much of a region stays.

A host of any size is split into groups by page, so no group grows with the input. The table of the hosts that need
splitting is broadcast up to ``BROADCAST_HOSTS`` rows, beyond that joined.

Defined results: null html is an empty page with empty text; a url without a host belongs to the host ''; pages alone in
their group have no template and are read by their structure; repeated rows give equal results; an empty table gives an
empty table; other columns are not read. Pages are read whole, malformed ones too, in time that follows their length: a tag
that never ends is text.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from html import unescape
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_HOSTS = 100_000
GROUP_CHARS = 20_000_000
MIN_PAGES, MIN_CLASS = 3, 2
COPY, COPY_BODY, SKETCH = 0.5, 0.9, 64

# Element names of the HTML standard, and names that sites give to page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math object canvas".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
    select summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"caption", "legend", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
FURNITURE = frozenset("nav footer aside form button select menu dialog head label input fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
FURNITURE_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner
    cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup popup modal overlay sidebar
    sidenav menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments commentlist disqus reply replies
    respond share sharing social related recommended recommendations widget widgets toolbar pagination pager search login
    topbar skip""".split())
#: A container is furniture for certain if all parts of a class (or id) are furniture or containers, and one is of these.
CERTAIN = frozenset("""comment comments commentlist disqus replies respond cookie cookies consent gdpr newsletter subscribe
    subscription signup sidebar sidenav related recommended recommendations share sharing breadcrumb breadcrumbs pagination
    popup modal""".split())
CONTAINERS = frozenset("""area bar block box buttons button container content form group inner item items layer left links list main
    message notice panel posts articles stories reads region right row section stack strip thread title top bottom wrap wrapper
    us this post article page site bottom body feed icons tools""".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense adbox".split())
CONTAINER_TAGS = frozenset("div section aside ul ol article table dl".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = frozenset("p pre blockquote li dt dd td th figcaption caption".split())
CONTENT_NAMES = frozenset("article post entry story content main".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]{0,99})")
#: Most tags, without < in a value; what does not match is looked at again, more slowly. Nothing is tried twice (possessive).
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]{0,99}+)((?:[^\"'<>]++|\"[^\"<]*+\"|'[^'<]*+')*+)>")
_END_OR_QUOTE = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


@lru_cache(maxsize=100_000)
def _path_hash(outer: int, element: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{outer}/{element}")


@lru_cache(maxsize=100_000)
def _certain(name: str) -> bool:
    """Whether a class or id can only be that of furniture: related-posts and cookieNotice, but not related-work."""
    parts = [p.lower() for p in _NAME.findall(name)]
    return not CERTAIN.isdisjoint(parts) and all(p in FURNITURE_NAMES or p in CERTAIN or p in CONTAINERS for p in parts)


class Block(NamedTuple):
    """A run of text between block elements; path is that of its first word.

    named holds the containers around it whose name is a hint of furniture, as ((name, path), those further out).
    """
    region: str
    furniture: bool
    named: tuple
    path: int
    text: str

    @property
    def key(self) -> tuple[int, str]:
        return self.path, self.text


class _Numbers(dict):
    """Consecutive numbers for what is asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Template(set):
    """The tokens of the valid classes; the blocks that repeat; those of them whose words are all template; and the number of
    gaps between template tokens on each page that took part (by the page's identity)."""

    def __init__(self, tokens=(), repeated=frozenset(), held=frozenset(), gaps=None):
        super().__init__(tokens)
        self.repeated, self.held, self.gaps = repeated, held, gaps or {}


class _Scanner:
    """Where tags end, in time that follows the length of the page however odd its quotes and brackets are."""

    def __init__(self, html: str):
        self.html, self.size = html, len(html)
        self.last = {c: html.rfind(c) for c in "\"'>"}
        self._from, self._special = 1, 0  # from the first of these on, the next quote or > is at the second
        self._dead: set[int] = set()  # places of quotes from which no tag ends

    def _next(self, at: int) -> int:
        if not self._from <= at <= self._special:
            found = _END_OR_QUOTE.search(self.html, at)
            self._from, self._special = at, found.start() if found else self.size
        return self._special

    def tag_end(self, at: int) -> int:
        """The place of the > that ends a tag whose attributes begin here, quoted ones passed over; -1 if there is none."""
        if at > self.last[">"]:
            return -1
        quotes: list[int] = []
        while True:
            at = self._next(at)
            if at < self.size and self.html[at] == ">":
                return at
            if at == self.size or at in self._dead or at >= self.last[self.html[at]]:
                self._dead.update(quotes)
                if at < self.size:
                    self._dead.add(at)
                return -1
            quotes.append(at)
            at = self.html.find(self.html[at], at + 1) + 1


@lru_cache(maxsize=100)
def _raw_close(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\s*>", re.I)


def _raw_end(html: str, name: str, at: int) -> int:
    """Where an element ends whose content is no markup."""
    found = _raw_close(name).search(html, at)
    return found.end() if found else len(html)


class _Attributes(NamedTuple):
    """What is looked at of the attributes of a tag: names are the words of class and id."""
    classes: str
    id: str
    names: frozenset
    role: str
    hidden: bool


def _attributes(text: str) -> _Attributes:
    a = {k.lower(): x or y or z for k, x, y, z in _ATTRIBUTE.findall(text)}
    names = frozenset(w.lower() for w in _NAME.findall(f"{a.get('class', '')} {a.get('id', '')}"))
    return _Attributes(a.get("class", ""), a.get("id", ""), names, a.get("role", "").lower(), "hidden" in a or a.get("aria-hidden") == "true")


_known_attributes = lru_cache(maxsize=50_000)(_attributes)


class Page:
    """The tokens of a page: (kind, value, path), kind one of open, close, word; words also have their block and place in it.

    A path is a hash of the names of the open elements, so that deeply nested pages take no more room than others.
    """

    def __init__(self, html: str):
        self.tokens: list[tuple] = []
        self.blocks: list[Block] = []
        self._stack: list[tuple] = []  # name, path, furniture, region, named
        self._open_names: Counter = Counter()
        self._current: list[str] = []
        self._first, self._words = 0, 0  # of the current block: path of the first word, number of words
        self._where = ("", False, ())
        self._read(html)
        self._flush()
        self.keys = [b.key for b in self.blocks]

    def _read(self, html: str) -> None:
        at, size, scan, plain_tag = 0, len(html), _Scanner(html), _PLAIN_TAG.match
        while at < size:
            plain = plain_tag(html, at)
            if plain is not None:
                slash, name, attributes = plain.groups()
                at = plain.end()
                name = name.lower()
                if slash:
                    self._close(name)
                elif name in RAW and not attributes.endswith("/"):
                    at = _raw_end(html, name, at)
                else:
                    self._open(name, attributes)
                continue
            begin = html.find("<", at)
            if begin != at:
                self._text(html[at:] if begin < 0 else html[at:begin])
                at = size if begin < 0 else begin
                continue
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                at = size if end < 0 else end + 3
                continue
            if html.startswith("<![CDATA[", at):
                end = html.find("]]>", at + 9)
                self._text(html[at + 9:size if end < 0 else end])
                at = size if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), at) and at < scan.last[">"]:
                at = html.find(">", at) + 1
                continue
            tag = _TAG.match(html, at) if at < scan.last[">"] else None
            end = scan.tag_end(tag.end()) if tag else -1
            if end < 0:  # no tag, or one that never ends
                self._text("<")
                at += 1
                continue
            slash, name, attributes = tag[1], tag[2].lower(), html[tag.end():end]
            at = end + 1
            if slash:
                self._close(name)
            elif name in RAW and not attributes.endswith("/"):
                at = _raw_end(html, name, at)
            else:
                self._open(name, attributes)

    def _path(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _text(self, text: str) -> None:
        where = (self._stack[-1][3], self._stack[-1][2], self._stack[-1][4]) if self._stack else ("", False, ())
        if where[:2] != self._where[:2] or where[2] is not self._where[2]:
            self._flush()
            self._where = where
        text = unescape(text) if "&" in text else text
        self._current.append(text)
        found = text.split()
        if found:
            path, block = self._path(), len(self.blocks)
            if not self._words:
                self._first = path
            self.tokens += [("word", word, path, block, at) for at, word in enumerate(found, self._words)]
            self._words += len(found)

    def _flush(self) -> None:
        if self._words:
            self.blocks.append(Block(*self._where, self._first, " ".join("".join(self._current).split())))
        self._current, self._words = [], 0

    @property
    def region(self) -> str:
        """The best content region that has text."""
        regions = {b.region for b in self.blocks if not b.furniture}
        return next((r for r in ("article", "main", "content") if r in regions), "")

    def roles(self, repeated: set[tuple[int, str]] | frozenset, places: list[int] | None = None) -> list[tuple]:
        """The tokens, or those at some places, with their roles: a word of a repeated block with the block and its place
        there, others by their path."""
        keys = [key if key in repeated else None for key in self.keys]
        tokens = self.tokens if places is None else [self.tokens[j] for j in places]
        return [t if t[0] != "word" else t[:3] if (key := keys[t[3]]) is None else (*t[:3], key, t[4]) for t in tokens]

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self._current.append(" ")
            return
        if name in BLOCK:
            self._flush()
        if name in CLOSES_P:
            self._end({"p"}, "article section div td li blockquote body main nav aside footer header form".split())
        elif name in SIBLINGS:
            self._end(SIBLINGS[name], ["ul", "ol", "dl", "table", "select"])
        outer = self._stack[-1] if self._stack else ("", 0, False, "", ())
        classes, ident, names, role, hidden = (_known_attributes if len(attributes) < 500 else _attributes)(attributes)
        inside = outer[3] == "article"
        furniture = outer[2] or name in FURNITURE or role in FURNITURE_ROLES or hidden
        suspect = False
        if outer[3]:  # in a content region a name is a hint only, and ids of headings and sections are made from titles
            hints = {w.lower() for w in _NAME.findall(classes)} if name in ("section", "article") else names
            furniture = furniture or name not in HEADINGS and bool(ADVERTS & set(classes.lower().split()))
            if not furniture and name in CONTAINER_TAGS:
                given = classes if name in ("section", "article") else f"{classes} {ident}"
                furniture = any(map(_certain, given.split()))
            suspect = name not in HEADINGS and name not in LEAVES and bool(hints & FURNITURE_NAMES or not inside and "header" in hints and name in ("div", "section"))
        elif name not in HEADINGS:
            furniture = furniture or name not in ("html", "body", "article", "main") and bool(names & FURNITURE_NAMES)
            furniture = furniture or name == "article" and bool(names & {"comment", "comments", "reply", "ad", "advert", "related", "promo"})
        furniture = furniture or not inside and (name == "header" or not outer[3] and "header" in names and name in ("div", "section"))
        region = outer[3]
        if name == "article" and not furniture:
            region = "article"
        elif region != "article" and (name == "main" or role == "main"):
            region = "main"
        elif region == "" and name in ("div", "section", "td") and names & CONTENT_NAMES:
            region = "content"
        path = _path_hash(outer[1], f"{name}.{'.'.join(sorted(names))}" if names else name)
        self.tokens.append(("open", name, path))
        if name not in VOID and not attributes.endswith("/"):
            self._stack.append((name, path, furniture, region, ((name, path), outer[4]) if suspect else outer[4]))
            self._open_names[name] += 1

    def _close(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        if self._open_names[name]:
            while True:
                top = self._stack.pop()
                self._open_names[top[0]] -= 1
                if top[0] == name:
                    break
            self.tokens.append(("close", name, top[1]))

    def _end(self, names: set[str], borders: list[str]) -> None:
        """Close an open element of these names whose end tag was left out, up to the next border."""
        for n in names:
            if self._open_names[n]:
                break
        else:
            return
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] in names:
                self._open_names.subtract(e[0] for e in self._stack[i:])
                del self._stack[i:]
                return
            if self._stack[i][0] in borders:
                return


class _WordHashes(dict):
    """Hashes of words, as many as are worth remembering."""

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        self[word] = number = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return number


_word_hashes = _WordHashes()


def without_copies(pages: list[Page]) -> list[Page]:
    """The pages whose content regions are no (near) copies of that of an earlier page."""
    leaders: list[tuple[str, frozenset, Page]] = []
    holders: dict[tuple, list[int]] = defaultdict(list)  # of a region and a number of its sketch
    for page in pages:
        region = page.region
        words = [w for b in page.blocks if b.region == region and not b.furniture for w in b.text.split()]
        h = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
        if len(h) >= 3:
            h = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        sketch = frozenset(np.unique(h)[:SKETCH].tolist())
        limit = COPY if region else COPY_BODY
        # Only leaders that share enough numbers are compared; an empty sketch is that of all pages without words.
        keys = [(region, x) for x in sketch] or [(region, None)]
        shared = Counter(chain.from_iterable(holders[k] for k in keys if k in holders))
        if not any(n >= limit * len(sketch) and _alike(sketch, leaders[i][1], limit) for i, n in shared.items()):
            for k in keys:
                holders[k].append(len(leaders))
            leaders.append((region, sketch, page))
    return [page for _, _, page in leaders]


def _alike(a: frozenset, b: frozenset, limit: float) -> bool:
    common = a & b
    if len(common) < limit * max(len(a), len(b)):
        return False
    least = sorted(a | b)[:SKETCH]
    return a == b or sum(x in common for x in least) > limit * len(least)


def template_of(pages: list[Page]) -> Template:
    """Tokens of the valid equivalence classes of these pages, copies counted once."""
    pages = without_copies(pages)
    if len(pages) < MIN_PAGES:
        return Template()
    enough = max(MIN_PAGES, (len(pages) + 1) // 2)

    def common(sets) -> set:
        return {x for x, n in Counter(x for s in sets for x in s).items() if n >= enough}

    repeated = common(set(page.keys) for page in pages)
    # Most words stand on few pages only; they have no role in the template, whatever their path.
    words = common({t[1] for t in page.tokens if t[0] == "word"} for page in pages)
    kept = [[j for j, t in enumerate(page.tokens) if t[0] != "word" or t[1] in words] for page in pages]
    all_roles = [page.roles(repeated, places) for page, places in zip(pages, kept)]
    numbers = _Numbers()
    ids = [np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)) for tokens in all_roles]
    often = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=len(numbers)) >= enough
    held = [np.flatnonzero(often[x]).tolist() for x in ids]
    roles = [[tokens[j] for j in at] for tokens, at in zip(all_roles, held)]
    held = [[places[j] for j in at] for places, at in zip(kept, held)]
    frequent = {t for t, k in numbers.items() if often[k]}
    vectors: dict[tuple, list[int]] = defaultdict(lambda: [0] * len(pages))
    for i, tokens in enumerate(roles):
        for token, n in Counter(tokens).items():
            vectors[token][i] = n
    places = _places(pages, roles, held)
    element = {t[2]: vector for t, vector in vectors.items() if t[0] == "open"}
    classes: dict[tuple, list[tuple]] = defaultdict(list)
    for token, vector in vectors.items():
        classes[(tuple(vector), *((token[2], places[token]) if token[0] == "word" else ()))].append(token)
    # The words of a repeated block also count the tags of an element that holds nothing else as often.
    found = [(key[0], tokens) for key, tokens in classes.items()
             if len(tokens) + (2 if len(tokens[0]) > 3 and element.get(tokens[0][2]) == [*key[0]] else 0) >= MIN_CLASS]
    for split in (_by_path, _by_order):
        bad = _invalid(found, roles)
        found = ([c for k, c in enumerate(found) if k not in bad]
                 + [(found[k][0], part) for k in bad for part in split(found[k][1], roles) if len(part) >= MIN_CLASS])
    bad = _invalid(found, roles)
    valid = {t for k, (_, tokens) in enumerate(found) if k not in bad for t in tokens}
    inside = np.zeros(len(numbers), bool)
    inside[[numbers[t] for t in valid]] = True
    # Gaps are where the places of template tokens do not follow each other, the ends of the page included.
    gaps = {}
    for page, x, places in zip(pages, ids, kept):
        at = np.array(places, np.int64)[inside[x]]
        gaps[id(page)] = int(np.count_nonzero(np.diff(at, prepend=-1, append=len(page.tokens)) > 1))
    return Template(valid, repeated, repeated - {t[3] for t in frequent if len(t) > 3 and t not in valid}, gaps)


def _places(pages: list[Page], roles: list[list[tuple]], held: list[list[int]]) -> dict[tuple, tuple]:
    """For each frequent word, the block of its first occurrence on each page: words of one class stand in one block."""
    places: dict[tuple, dict[int, int]] = defaultdict(dict)
    for i, (page, mine, at) in enumerate(zip(pages, roles, held)):
        for role, j in zip(mine, at):
            if role[0] == "word":
                places[role].setdefault(i, page.tokens[j][3])
    return {role: tuple(at.items()) for role, at in places.items()}


def _by_path(tokens: list[tuple], roles: list[list[tuple]]) -> list[list[tuple]]:
    parts: dict[str, list] = defaultdict(list)
    for t in tokens:
        parts[t[2]].append(t)
    return list(parts.values())


def _by_order(tokens: list[tuple], roles: list[list[tuple]]) -> list[list[tuple]]:
    """Parts whose tokens first occur in the same order on every page."""
    at: dict[tuple, list[int]] = {t: [] for t in tokens}
    for role in roles:
        first: dict[tuple, int] = {}
        for n, t in enumerate(role):
            if t in at:
                first.setdefault(t, n)
        for t, n in first.items():
            at[t].append(n)
    parts: list[list[tuple]] = []
    for t in sorted(tokens, key=at.__getitem__):
        part = next((p for p in parts if all(x < y for x, y in zip(at[p[-1]], at[t]))), None)
        if part is None:
            parts.append([t])
        else:
            part.append(t)
    return parts


def _invalid(found: list[tuple[tuple, list[tuple]]], roles: list[list[tuple]]) -> set[int]:
    """Numbers of the classes that are not in one order on all pages or do not nest; sorts the classes."""
    # Frequent classes first: the others have to nest in their gaps.
    found.sort(key=lambda c: (-sum(map(bool, c[0])), sum(c[0]), -len(c[1]), min(map(str, c[1]))))
    of = {token: k for k, (_, tokens) in enumerate(found) for token in tokens}
    bad: set[int] = set()
    for tokens in roles:
        bad |= _disordered([(of[t], t) for t in tokens if t in of], bad)
    order: dict[int, tuple] = {}
    for role in roles:
        seen: dict[int, list] = defaultdict(list)
        for t in role:
            if (k := of.get(t)) is not None and k not in bad:
                seen[k].append(t)
        for k, tokens in seen.items():
            first = tuple(tokens[:len(found[k][1])])
            if order.setdefault(k, first) != first:
                bad.add(k)
    return bad


def _disordered(tokens: list[tuple[int, tuple]], known: set[int]) -> set[int]:
    """Classes whose occurrences do not repeat in one order, or that reach across a gap of a class before them."""
    rounds: dict[int, list] = defaultdict(list)
    for k, t in tokens:
        rounds[k].append(t)
    bad = set(known)
    size = {k: len(set(ts)) for k, ts in rounds.items()}
    for k, ts in rounds.items():
        if len(ts) % size[k] or any(ts[i] != ts[i % size[k]] for i in range(len(ts))):
            bad.add(k)
    # Between two tokens of one occurrence of a class, the classes opened inside have to be finished.
    open_rounds: list[int] = []
    count: Counter = Counter()
    for k, _ in tokens:
        if k in bad:
            continue
        if k in open_rounds:
            while open_rounds[-1] != k:
                bad.add(max(open_rounds.pop(), k) if open_rounds[-1] > k else open_rounds.pop())
        count[k] += 1
        at = count[k] % size[k]
        if at == 0:
            if k in open_rounds:
                open_rounds.remove(k)
        elif at == 1:
            open_rounds.append(k)
    return bad


def main_text(page: Page, template: Template) -> str:
    """The slots' text in the best content region of the page, block by block."""
    region = page.region

    def in_template(named: tuple) -> bool:
        chain = []
        while id(named) not in seen and named:
            chain.append(named)
            named = named[1]
        hit = seen.get(id(named), False)
        for inner in reversed(chain):
            hit = seen[id(inner)] = hit or ("open", *inner[0]) in template
        return hit

    seen: dict[int, bool] = {}
    return "\n\n".join(b.text for b, key in zip(page.blocks, page.keys) if b.region == region and not b.furniture
                       and key not in template.held and not in_template(b.named))


def slots_of(page: Page, template: Template) -> int:
    """How many gaps between template tokens hold other tokens."""
    known = template.gaps.get(id(page))
    if known is not None:
        return known
    if not template:
        return int(bool(page.tokens))
    n, before = 0, True
    for token in page.roles(template.repeated):
        now = token in template
        n += before and not now
        before = now
    return n


def extract_pages(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                  group_pages: int = 200) -> DataFrame:
    """key, url, text, n_template (template tokens of the page's group) and n_slots (gaps of this page) of every page."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), HOST, 1), F.lit("")))
    pages = df.select(F.col(key).alias("k"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), host.alias("host"),
                      F.monotonically_increasing_id().alias("row"))
    groups = F.greatest(F.ceil(F.count("*") / group_pages), F.ceil(F.sum(F.length("html")) / GROUP_CHARS))
    large = pages.groupBy("host").agg(groups.alias("groups")).where(F.col("groups") > 1)
    if len(large.take(BROADCAST_HOSTS + 1)) <= BROADCAST_HOSTS:
        large = F.broadcast(large)
    number = F.pmod(F.xxhash64("row"), F.coalesce("groups", F.lit(1)))
    dealt = pages.join(large, "host", "left").select("k", "url", "html", "host", number.alias("part"))
    kind = df.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        gc.disable()  # millions of tuples and no cycles: looking for some takes a third of the time
        try:
            made = {h: Page(h) for h in rows["html"].unique()}
            template = template_of([made[h] for h in sorted(made)])
            found = {h: (main_text(p, template), slots_of(p, template)) for h, p in made.items()}
        finally:
            gc.enable()
        return pd.DataFrame({"k": rows["k"], "url": rows["url"], "text": [found[h][0] for h in rows["html"]],
                             "n_template": len(template), "n_slots": [found[h][1] for h in rows["html"]]})

    out = dealt.groupBy("host", "part").applyInPandas(run, f"k {kind}, url string, text string, n_template long, n_slots long")
    return out.withColumnRenamed("k", key).withColumnRenamed("url", url)
