"""Main text of web pages by consensus of each host's pages.

Every page is read once as a stream of tags: elements that never hold article text
(menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles; by tag,
role or class) are left out, and each block of text gives its length, less that of its links, to the
container it stands in and half of it to the next one out. The best container of a
page votes, by generalised path (tags with classes, digits taken out), for their host. Votes are
added up in Spark, and every page is read again: its text is that of the elements on the
path its host voted for most, among those the page has; where that holds less than
``ENOUGH`` of the best container's score, as on a page of another make, or only a part of the text
of the page's own best one, that one. The own container is widened first to the article around
it: from lists, tables and sections to what holds them and the paragraphs beside them.

White space inside a block becomes one space, blocks are joined in page order by one
space, character references are decoded, nothing else is dropped or cut. A null or empty page has an
empty text. Pages without a host share one. Equal scores prefer the container that opens first,
equal votes the smaller path. Repeated rows are counted and returned each. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keepwell.session import ship_package, written

#: paths of a page that vote
VOTES = 1
ENOUGH = 0.25
#: votes, rows of (host, path), are broadcast up to this number
MOST_HOSTS = 200_000
MOST_BYTES = 16 << 20
#: share of the own container's text that a host's path inside or around it must cover
NEARLY = 0.9
#: elements that are parts of a text, never a whole article for themselves
FLOW = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption "
    "details summary hgroup address".split()
)

# fixed values: the elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr label nobr".split()
)
CLOSED_BY_BLOCK = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
}
SCOPES = frozenset("ul ol dl table tr tbody thead select div article section body main td th".split())
# elements, roles and words of classes and ids that do not hold article text
LEFT_OUT = frozenset(
    "nav header footer aside form button select option script style noscript template iframe svg canvas object "
    "dialog menu head input label fieldset video audio map".split()
)
LEFT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
LEFT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner billboard "
    "nav navbar navigation menu breadcrumb breadcrumbs topbar header masthead footer sidebar aside rail widget widgets "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login paywall comment comments commentlist disqus reply replies respond responses share sharing social "
    "related recommended recommendations trending popular pagination pager tags toolbar search skip disclaimer form".split()
)
# fixed values: words that say nothing of a part's content when they stand beside one of the above
PLAIN_WORDS = frozenset(
    "area bar block body bottom box button buttons card cell col column container content controls count desktop entry fixed global "
    "group head heading holder icon icons id inner inline item items js label left links link list main media mobile module "
    "more nested outer page panel parent part placeholder post posts primary right row secondary section site slot small "
    "sticky story stories text thread title to top tree unit up user view wrap wrapper zone".split()
)

_TAG = re.compile(
    r"<!--(?:.*?-->|>|->)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*+\"|=\s*'[^']*+'|[^>])*+)>",
    re.S,
)
_FIELD = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANK = re.compile(r"\s+")
_BESIDE = frozenset("has with without no".split())
_COMPOUND = re.compile(r"(?:cookie|advert|sidebar|breadcrumb|newsletter|footer|navbar|popup|comment(?!ar))[a-z]{0,7}$")
_FORMS = frozenset("form fieldset label input".split())
_DIGITS = re.compile(r"\d+")


def _names_rest(token: str) -> bool:
    """Whether a class or id says that an element does not hold article text: it names a part that is left out, and
    nothing else, as "comment-list" does and "comment-piece" does not; nor if it tells of a neighbour, as "has-sidebar" does."""
    words = [w.lower() for w in _WORDS.findall(token)]
    if not words or not _BESIDE.isdisjoint(words):
        return False
    known = [w in LEFT_WORDS or bool(_COMPOUND.match(w)) for w in words]
    return any(known) and all(k or w in PLAIN_WORDS for k, w in zip(known, words))


def left_out(tag: str, fields: str, forms: bool = False, named: bool = True) -> tuple[bool, str]:
    """(whether the element is left out, its part of the path); ``forms`` may hold text, and
    without ``named`` classes and ids say nothing."""
    if tag in LEFT_OUT and not (forms and tag in _FORMS):
        return True, tag
    name, out = tag, False
    if fields:
        for m in _FIELD.finditer(fields):
            field, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if field == "role":
                out |= value.lower() in LEFT_ROLES
            elif field == "hidden":
                out = True
            else:
                # a container of everything may be called "has-sidebar" or the like
                if named and tag not in ("html", "body", "article", "main"):
                    out |= any(map(_names_rest, value.split()))
                if field == "class":
                    name += "".join(f".{_DIGITS.sub('#', c)}" for c in sorted(set(value.split())))
    return out, name


class Page:
    """Containers of a page: path, score, and the order in which blocks of text belong to them.

    A path is a number; ``steps`` gives its parent and last part, ``keys`` a digest that is the same on every page. So
    a page's size in memory follows its elements, however deep they are nested.
    """

    def __init__(self, source: str, forms: bool = False, named: bool = True):
        self.forms, self.named = forms, named
        self.steps: list[tuple[int, str]] = [(-1, "")]
        self.keys: list[bytes] = [b""]
        self.number: dict[tuple[int, str], int] = {}
        self.paths: list[int] = [0]  # of each container
        self.parent: list[int] = [-1]
        self.score: list[float] = [0.0]
        self.blocks: list[tuple[int, str]] = []  # (innermost container, text)
        self.worth: list[tuple[float, int]] = []  # of each block: length less that of links twice, length
        self._read(source)

    def path(self, parent: int, name: str) -> int:
        found = self.number.get((parent, name))
        if found is None:
            found = self.number[parent, name] = len(self.steps)
            self.steps.append((parent, name))
            self.keys.append(step_key(self.keys[parent], name))
        return found

    def spelled(self, path: int) -> str:
        parts = []
        while path > 0:
            path, name = self.steps[path]
            parts.append(f"/{name}")
        return "".join(reversed(parts))

    def tag(self, path: int) -> str:
        return self.steps[path][1].partition(".")[0]

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # (tag, container, left out here)
        silent = 0  # open elements that are left out
        here, links = 0, 0
        text: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal text, linked
            if text:
                block = _BLANK.sub(" ", references.unescape("".join(text))).strip()
                if block:
                    self.blocks.append((here, block))
                    worth = max(0.0, len(block) - 2.0 * linked)
                    self.worth.append((worth, len(block)))
                    self.score[here] += worth
                    # a paragraph speaks for what it stands in, and half for the next container out
                    outer = self.parent[here]
                    if outer >= 0:
                        self.score[outer] += worth
                        if self.parent[outer] >= 0:
                            self.score[self.parent[outer]] += worth / 2
                text = []
            linked = 0

        def close(n: int) -> None:
            """Close the innermost ``n`` elements."""
            nonlocal here, silent, links
            for _ in range(n):
                tag, container, out = stack.pop()
                if tag not in INLINE:
                    flush()
                silent -= out
                links -= tag == "a"
                here = container

        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            stop = m.start() if m else end
            if stop > at and not silent:
                piece = source[at:stop]
                text.append(piece)
                if links:
                    linked += len(piece)
            if not m:
                break
            at = m.end()
            tag = m[2]
            if tag is None:
                if m[0].startswith("<![CDATA[") and not silent:
                    text.append(references.escape(m[0][9:-3]))
                continue
            tag = tag.lower()
            if m[1]:
                depth = next((i for i in range(1, len(stack) + 1) if stack[-i][0] == tag), 0)
                if depth and (tag not in INLINE or all(stack[-i][0] in INLINE for i in range(1, depth))):
                    close(depth)
                elif tag in ("br", "p"):
                    flush()
                continue
            if tag in RAW:
                closing = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                if tag == "textarea" or tag != "title":
                    at = closing.end() if closing else end
                else:
                    at = closing.end() if closing else at
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    if tag == "hr":
                        flush()
                    elif not silent:
                        text.append(" ")
                continue
            # elements that end where this one begins
            if tag in CLOSED_BY_BLOCK:
                depth = 0
                for i in range(1, len(stack) + 1):
                    if stack[-i][0] == "p":
                        depth = i
                        break
                    if stack[-i][0] not in INLINE:
                        break
                if depth:
                    close(depth)
            if tag in SIBLINGS:
                depth = 0
                for i in range(1, len(stack) + 1):
                    other = stack[-i][0]
                    if other in SIBLINGS[tag]:
                        depth = i
                    elif other in SCOPES and not (tag in ("tr", "tbody") and other in ("tr", "td", "th", "tbody")):
                        break
                if depth:
                    close(depth)
            if m[0].endswith("/>") and tag not in INLINE and tag in ("path", "circle", "rect", "use"):
                continue
            out, name = left_out(tag, m[3], self.forms, self.named)
            if tag in INLINE:
                if out:
                    silent += 1
                links += tag == "a"
                stack.append((tag, here, out))
                continue
            flush()
            stack.append((tag, here, out))
            silent += out
            if not silent:
                self.paths.append(self.path(self.paths[here], name))
                self.parent.append(here)
                self.score.append(0.0)
                here = len(self.paths) - 1
        flush()

    def ranked(self) -> list[int]:
        """Containers with a score, best first."""
        return sorted((i for i, s in enumerate(self.score) if s > 0), key=lambda i: (-self.score[i], i))

    def by_path(self) -> dict[int, float]:
        """Scores of the paths: elements on one path count together."""
        out: dict[int, float] = {}
        for path, score in zip(self.paths, self.score):
            if score > 0:
                out[path] = out.get(path, 0.0) + score
        return out

    def inside(self, path: int) -> list[bool]:
        """Of each container, whether it is in an element on a path, or is one."""
        inside = [False] * len(self.paths)
        for i, p in enumerate(self.paths):
            inside[i] = p == path or self.parent[i] >= 0 and inside[self.parent[i]]
        return inside

    def holds(self) -> list[int]:
        """The number of blocks inside each path."""
        mine, out = [0] * len(self.paths), [0] * len(self.steps)
        for i, _ in self.blocks:
            mine[i] += 1
        for i in range(len(mine) - 1, -1, -1):  # a container comes after the one around it
            out[self.paths[i]] += mine[i]
            if self.parent[i] >= 0:
                mine[self.parent[i]] += mine[i]
        return out

    def text(self, path: int) -> str:
        """Text of all blocks inside elements on a path, in page order."""
        inside = self.inside(path)
        return " ".join(block for i, block in self.blocks if inside[i])

    def widened(self, path: int) -> int:
        """The path of the whole article that the elements on ``path`` are part of: the widest one
        around them whose further text belongs to it, as in lists, tables and sections beside paragraphs."""
        at, out = path, path
        held, count = self.inside(path), self.holds()
        while at > 0 and self.tag(at) not in ("article", "main", "body", "html"):
            part = self.tag(at) in FLOW
            before, at = at, self.steps[at][0]
            if at <= 0 or self.tag(at) == "html":
                break
            if count[at] == count[before]:
                continue
            now = self.inside(at)
            more = [n for n, (i, _) in enumerate(self.blocks) if now[i] and not held[i]]
            if not more:
                continue
            if sum(self.worth[n][0] for n in more) < sum(self.worth[n][1] for n in more) / 2:
                break  # mostly links
            # a part's own element, or an article, holds one text; elsewhere only what stands in the text's flow
            whole = self.tag(at) in ("article", *FLOW) or part and self.tag(at) not in ("body", "main")
            titled = any(held[i] and self.steps[self.paths[i]][1] == "h1" for i, _ in self.blocks)
            if not whole and (self.tag(at) == "body" and not part or titled or not all(self._flows(self.blocks[n][0], at) for n in more)):
                break
            held, out = now, at
        return out

    def _flows(self, i: int, path: int) -> bool:
        """Whether only parts of a text and sections lie between a container and the path around it."""
        while self.paths[i] != path:
            if self.tag(self.paths[i]) not in FLOW and self.tag(self.paths[i]) != "section":
                return False
            i = self.parent[i]
        return True

    def covers(self, path: int, own: int) -> float:
        """Share of the link-free text inside ``own`` that is inside ``path``, too."""
        a, b = self.inside(path), self.inside(own)
        whole = sum(w for (i, _), (w, _) in zip(self.blocks, self.worth) if b[i])
        return sum(w for (i, _), (w, _) in zip(self.blocks, self.worth) if a[i] and b[i]) / whole if whole else 0.0


def step_key(parent: bytes, name: str) -> bytes:
    """128 bits that name a path: its parent's key and its last part."""
    return blake2b(parent + name.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def path_key(path: str) -> bytes:
    """The key of a path as ``Page.spelled`` gives it."""
    key = b""
    for name in path.split("/")[1:]:
        key = step_key(key, name)
    return key


def read(source: str) -> Page:
    """A page. One whose whole text stands inside a form is read with forms, and one whose whole text stands in
    parts that classes or ids call something else is read without heed to these."""
    page = Page(source)
    for forms, named in ((True, True), (False, False), (True, False)):
        if page.blocks:
            break
        page = Page(source, forms, named)
    return page


def best_paths(page: Page, n: int = VOTES) -> list[tuple[int, float]]:
    """Up to ``n`` (path, share of the best score), best first; of equals the one that opens first."""
    scores = page.by_path()
    top = sorted(scores, key=lambda p: (-scores[p], p))[:n]
    return [(p, scores[p] / scores[top[0]]) for p in top]


def fitting(page: Page) -> list[int]:
    """The page's paths that its host may choose among, its own best one first."""
    scores = page.by_path()
    if not scores:
        return []
    best = best_paths(page, 1)[0][0]
    own = page.widened(best)
    out = [own]
    for path in sorted(p for p in scores if p != own and scores[p] >= ENOUGH * scores[best]):
        # a path elsewhere in the page is the host's choice; one that shares text with the own must not cut it
        share = page.covers(path, own)
        if share == 0 or share >= NEARLY:
            out.append(path)
    return out


def chosen(source: str | None, votes: dict[bytes, int]) -> tuple[str, str]:
    """(text, path) of a page, given the votes of its host's paths; of equals the lower key."""
    page = read(source) if source else None
    paths = fitting(page) if page else []
    if not paths:
        return "", ""
    voted = [p for p in paths if page.keys[p] in votes]
    agreed = min(voted, key=lambda p: (-votes[page.keys[p]], page.keys[p])) if voted else paths[0]
    return page.text(agreed), page.spelled(agreed)


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))


def ballots(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, path, votes): all votes of every host's pages, summed; paths by their keys."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, bytes], float] = {}
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if page:
                    page = read(page)
                    for path, share in best_paths(page):
                        path = page.keys[page.widened(path)]
                        sums[name, path] = sums.get((name, path), 0.0) + share
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _ in sums], pa.string()),
                    pa.array([p for _, p in sums], pa.binary()),
                    pa.array([round(v * 1e6) for v in sums.values()], pa.int64()),
                ],
                ["host", "path", "votes"],
            )

    cast = pages.select(host(url).alias("host"), F.col(source).alias("html")).mapInArrow(
        run, "host string, path binary, votes long"
    )
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def _candidates(rows: DataFrame) -> DataFrame:
    """(host, d, path): the paths that each page's host may choose among; equal pages once in each task's batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[tuple[str, str, bytes], None] = {}
            for name, d, source in zip(*(c.to_pylist() for c in batch.columns)):
                page = read(source)
                out.update(dict.fromkeys((name, d, page.keys[p]) for p in fitting(page)))
            kinds = pa.string(), pa.string(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], ["host", "d", "path"]
            )

    return rows.mapInArrow(run, "host string, d string, path binary")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per page: key, url, main text, its code points, host and the path it was found on."""
    spark = pages.sparkSession
    ship_package(spark)
    summed = written(ballots(pages, url, source))
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), host(url).alias("host"), F.col(source).alias("h"))
    size = summed.agg(F.count("*").alias("n"), F.sum(F.octet_length("host") + F.octet_length("path")).alias("b")).first()
    shared = None
    if size.n <= MOST_HOSTS and (size.b or 0) <= MOST_BYTES:
        by_host: dict[str, dict[bytes, int]] = {}
        for r in summed.toLocalIterator():
            by_host.setdefault(r.host, {})[bytes(r.path)] = r.votes
        shared = spark.sparkContext.broadcast(by_host)
        rows = rows.withColumn("agreed", F.lit(None).cast("binary"))
    else:
        # what a host's page agrees on depends on its source alone, so that equal pages are one row
        digest = F.sha2(F.col("h"), 256)
        places = written(_candidates(rows.where("h <> ''").select("host", digest.alias("d"), "h")))
        best = places.join(summed, ["host", "path"]).groupBy("host", "d").agg(
            F.min_by("path", F.struct((-F.col("votes")).alias("v"), "path")).alias("agreed")
        )
        rows = rows.withColumn("d", digest).join(written(best), ["host", "d"], "left")
    rows = rows.select("k", "u", "host", "agreed", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, agreed, sources = (batch.column(i).to_pylist() for i in (2, 3, 4))
            if shared is not None:
                found = [chosen(h, shared.value.get(name, {})) for name, h in zip(hosts, sources)]
            else:
                found = [chosen(h, {p: 1} if p else {}) for p, h in zip(agreed, sources)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([t for t, _ in found], pa.string()),
                    pa.array([len(t) for t, _ in found], pa.int64()),
                    batch.column(2),
                    pa.array([p for _, p in found], pa.string()),
                ],
                [key, url, "text", "n_chars", "host", "path"],
            )

    types = dict(pages.dtypes)
    schema = f"`{key}` {types[key]}, `{url}` {types[url]}, text string, n_chars long, host string, path string"
    return rows.mapInArrow(run, schema)
