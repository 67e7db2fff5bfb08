"""HTML extraction (operator 3): a template per host, deduced from equivalence classes of tokens, and its open slots.

A token is an element in its role, that is with the elements around it, or a whole block of text in its role. Its occurrence
vector says how often it occurs in each page of the host. Tokens with the same vector are an equivalence class, if there are
several and they are found on most pages. On every page the occurrences of a class must follow one another in the order that
the class has elsewhere, and must lie in one gap of the classes around it, the same on all pages: tokens out of order leave
their class, classes that cross others or change their gap are dropped. What remains, nested, is the template: classes that
occur once per page are its outer parts, classes that occur several times its lists. A page's text that is not a template
token in its place stands in an open slot: it is data.

Slots inside menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are dropped by the names
of the elements around them. The main slots are those within article or main elements; where these hold no text, the innermost
element of the template that holds most of the remaining data. In article and main elements a text belongs to the template
only if its class is on MAIN_SHARE of the distinct pages with such text and on MIN_PAGES at least, so that an article copied to another page
of the host stays data; if no text at all is open there, as on a host whose pages are one article, all of it is kept.

Occurrence vectors are compared by their size and the sum of a hash of (page, count), which is summed on the map side;
no host's pages are gathered, however many there are. Pages of a host with the same main text count as one page. Hosts of
fewer than MIN_PAGES distinct pages share one pooled template.

Defined results: null html counts as empty, and an empty or text-free page gives an empty string. A null or malformed url
belongs to the pooled hosts. Repeated rows are extracted each. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel.llm.common import small, stored, table

MIN_PAGES = 3
#: Of a host's distinct pages with text in article and main elements: how many must hold a class that fixes some of it; and of the pages that
#: hold a class: how many must agree on its order and on its place.
MAIN_SHARE = 0.9
#: Templates of a few hundred hashes each.
BROADCAST_ROWS = 10_000

# Names of elements, and whole classes, ids and roles, that mark what is not main text.
ASIDE_TAGS = frozenset(
    "head title nav header footer aside form script style noscript template button select dialog menu iframe svg".split()
)
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header menu "
    "modal nav navbar navigation newsletter notice notices popup promo promotion related share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget complementary contentinfo search "
    "ad-banner ad-block ad-box ad-container ad-slot ad-unit ad-wrapper adsbygoogle google-ad top-ad side-ad "
    "site-header page-header masthead site-footer page-footer footer-widgets site-nav site-navigation main-nav main-navigation "
    "main-menu nav-menu top-menu top-nav nav-bar post-navigation side-bar left-sidebar right-sidebar sidebar-left sidebar-right "
    "widget-area cookie-banner cookie-bar cookie-consent cookie-notice consent-banner gdpr-banner comment-form comment-list "
    "comments-area comments-section related-articles related-posts share-bar share-buttons sharing-buttons social-links social-media "
    "social-share newsletter-form newsletter-signup search-bar search-box search-form promo-box pop-up bread-crumbs".split()
)
INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
SCOPES = frozenset("html body article main section div td th li table blockquote".split())
MAIN_TAGS = ("article", "main")

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NUMBER = re.compile(r"-?0$")


def _marks(name: str, in_main: bool) -> bool:
    """Whether a whole class, id or role, without a number at its end, is a listed one; a header in main text is part of it."""
    name = _NUMBER.sub("", name.replace("_", "-"))
    return name in ASIDE_WORDS and not (in_main and name == "header")


class Node:
    """One kind of element in its role: the same object wherever the path is the same.

    aside: by the name of an element around it, or by a class, id or role; the latter end at an outermost article or main.
    """

    __slots__ = ("tag", "role", "parent", "aside", "aside_tag", "main", "children")

    def __init__(self, tag: str, names: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, {}
        self.role = f"{parent.role if parent else ''}>{tag}{names}"
        in_main = bool(parent and parent.main)
        self.main = in_main or tag in MAIN_TAGS or "main" in names.split(".")
        opens_main = self.main and not in_main
        self.aside_tag = (tag in ASIDE_TAGS and not (in_main and tag == "header")) or bool(parent and parent.aside_tag)
        marked = tag not in ("html", "body", *MAIN_TAGS) and any(_marks(name, in_main) for name in names.split(".") if name)
        self.aside = self.aside_tag or not opens_main and (marked or bool(parent and parent.aside))

    def child(self, tag: str, names: str) -> Node:
        found = self.children.get((tag, names))
        if found is None:
            found = self.children[tag, names] = Node(tag, names, self)
        return found


def walk(page: str, root: Node) -> Iterator[tuple[Node, str | None]]:
    """Every element as (node, None) and every stretch of text as (node, text); an empty text stands for the end of a block."""
    stack = [root]
    at = 0
    for m in _MARK.finditer(page):
        if m.start() > at:
            yield stack[-1], page[at : m.start()]
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag not in INLINE_TAGS:
            yield stack[-1], ""
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        closes = "p" if tag in ENDS_PARAGRAPH else tag if tag in ("li", "dt", "dd", "tr", "td", "th", "option") else None
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == closes:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES:
                    break
        names = ""
        if m[4] and "=" in m[4]:
            names = "".join(sorted(f".{v.lower()}" for _, a, b, c in _NAMED.findall(m[4]) for v in (a or b or c).split()))
            names = re.sub(r"\d+", "0", names)
        node = stack[-1].child(tag, names)
        yield node, None
        if tag not in VOID_TAGS and not m[4].endswith("/"):
            stack.append(node)
    if at < len(page):
        yield stack[-1], page[at:]


def _hash(token: str) -> int:
    from xxhash import xxh64_intdigest

    value = xxh64_intdigest(token)
    return value - (1 << 64) if value >> 63 else value


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def items(page: str, root: Node) -> Iterator[tuple[Node, str | None, list[tuple[Node, str]]]]:
    """Every element as (node, None, []), every block of text outside of asides as (element around it, its text, its stretches)."""
    held: list[tuple[Node, str]] = []
    for node, text in walk(page, root):
        if text:
            if not node.aside:
                held.append((node, text))
            continue
        if held and (text is not None or node.tag not in INLINE_TAGS):
            yield _block(held)
            held = []
        if text is None:
            yield node, None, []
    if held:
        yield _block(held)


def _block(held: list[tuple[Node, str]]) -> tuple[Node, str, list[tuple[Node, str]]]:
    around = held[0][0]
    while around.tag in INLINE_TAGS and around.parent is not None:
        around = around.parent
    return around, _clean("".join([t for _, t in held])), held


def _token(node: Node, text: str | None) -> str:
    return node.role if text is None else f"{node.role}={text}"


def tokens(page: str, root: Node) -> tuple[list[int], list[bool], int | None]:
    """The tokens of a page in their order, whether each is a text in a main element, and a hash of all such texts, if any."""
    seq, inner, main = [], [], []
    for node, text, _ in items(page, root):
        if text != "":
            seq.append(_hash(_token(node, text)))
            inner.append(text is not None and node.main)
            if inner[-1]:
                main.append(text)
    return seq, inner, _hash("\n".join(main)) if main else None


#: The classes of a group: the class of each token and its place in the order; classes are numbered, outer ones first.
Classes = dict[int, tuple[int, int]]


def _ordered(keys: list[tuple[int, int]]) -> list[int]:
    """Positions of a longest increasing part of keys."""
    ends: list[tuple[int, int]] = []
    at: list[int] = []
    before = [-1] * len(keys)
    for i, key in enumerate(keys):
        n = bisect_left(ends, key)
        before[i] = at[n - 1] if n else -1
        if n == len(ends):
            ends.append(key)
            at.append(i)
        else:
            ends[n], at[n] = key, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def arrange(seq: list[int], classes: Classes) -> tuple[set[int], set[int], dict[int, int | None]]:
    """The positions of seq that the classes explain, tokens out of the order of their class, and the gap that each class lies
    in (a hash of the class around it and the place in its order), null if it crosses another class or lies in several gaps."""
    found: dict[int, list[int]] = defaultdict(list)
    for at, token in enumerate(seq):
        if token in classes:
            found[classes[token][0]].append(at)
    fixed: set[int] = set()
    loose: set[int] = set()
    places: dict[int, int | None] = {}
    cuts: list[int] = []
    gaps = [0]  # gaps[i] lies before cuts[i]
    for cls in sorted(found):
        times: Counter[int] = Counter()
        keys = []
        for at in found[cls]:
            keys.append((times[seq[at]], classes[seq[at]][1]))
            times[seq[at]] += 1
        kept = _ordered(keys)
        loose |= {seq[at] for at in found[cls]} if not kept else {seq[found[cls][i]] for i in set(range(len(keys))).difference(kept)}
        rounds: dict[int, list[int]] = defaultdict(list)
        for i in kept:
            rounds[keys[i][0]].append(found[cls][i])
        lies = [(bisect_left(cuts, r[0]), bisect_left(cuts, r[-1])) for r in rounds.values()]
        own = {gaps[i] for i, _ in lies}
        places[cls] = own.pop() if len(own) == 1 and all(i == j for i, j in lies) else None
        if places[cls] is None:
            continue
        around = places[cls]
        at = 0
        new_cuts, new_gaps = [], []
        for (i, _), r in zip(lies, rounds.values(), strict=True):
            new_cuts += cuts[at:i] + r
            new_gaps += gaps[at : i + 1] + [_hash(f"{cls} {classes[seq[x]][1]}") for x in r[:-1]]
            at = i
            fixed.update(r)
        cuts, gaps = new_cuts + cuts[at:], new_gaps + [around] + gaps[at + 1 :]
    return fixed, loose, places


def extract(page: str, classes: Classes, inner: frozenset[int], root: Node, known: dict[str, int]) -> str:
    """The text of the main slots of a page under its host's template; inner are the classes that may fix main text."""

    def hashed(token: str) -> int:
        found = known.get(token)
        if found is None:
            if len(known) > 200_000:
                known.clear()
            found = known[token] = _hash(token)
        return found

    seq: list[int] = []
    blocks: list[tuple[Node, int, list[tuple[Node, str]]]] = []
    for node, text, held in items(page, root):
        if text is not None:
            blocks.append((node, len(seq) if text else -1, held))
        if text != "":
            seq.append(hashed(node.role) if text is None else _hash(_token(node, text)))
    fixed = arrange(seq, classes)[0]
    mains = [b for b in blocks if b[0].main]
    if any(at >= 0 for _, at, _ in mains):
        free = [b for b in mains if b[1] not in fixed or classes[seq[b[1]]][0] not in inner]
        chosen = free if any(at >= 0 for _, at, _ in free) else mains
    else:
        open_ = [b for b in blocks if b[1] not in fixed]
        size: Counter[Node] = Counter()
        for _, _, held in open_:
            for node, text in held:
                up: Node | None = node
                while up is not None:
                    size[up] += len(text.strip())
                    up = up.parent
        whole = size[root]
        singles = {seq[at] for at in fixed} - {t for t, n in Counter(seq).items() if n > 1}
        within = [n for n in size if n is not root and hashed(n.role) in singles and size[n] * 10 >= whole * 6 and n.tag not in ("p", *_HEADINGS)]
        slot = max(within, key=lambda n: n.role.count(">"), default=root)
        chosen = [b for b in open_ if _within(b[0], slot)]
    return " ".join(html.unescape(" ".join(["".join([t for _, t in held]) for _, _, held in chosen])).split())


_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


def _within(node: Node | None, outer: Node) -> bool:
    while node is not None and node is not outer:
        node = node.parent
    return node is not None


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> tuple[DataFrame, DataFrame]:
    """Of pages (host, page, html): host and its group ('' for the pooled hosts); group and its template: token, class and rank
    (arrays of one length), and inner, the classes that may fix text of main elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            root = Node("", "", None)
            rows = []
            for host, key, page in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                seq, inner, main = tokens(page, root)
                first: dict[int, int] = {}
                for at, token in enumerate(seq):
                    first.setdefault(token, at)
                times = Counter(seq)
                rows.append({"host": host, "main": key if main is None else main, "has_main": main is not None, "page": key, "seq": seq, "each": [
                    {"token": t, "times": times[t], "first": at, "inner": inner[at]} for t, at in first.items()]})
            yield pa.RecordBatch.from_pylist(rows, _arrow)

    _arrow = pa.schema([("host", pa.string()), ("main", pa.int64()), ("has_main", pa.bool_()), ("page", pa.int64()), ("seq", pa.list_(pa.int64())), ("each", pa.list_(pa.struct(
        [("token", pa.int64()), ("times", pa.int64()), ("first", pa.int64()), ("inner", pa.bool_())])))])
    spread = pages.select("host", "page", "html").mapInArrow(
        run, "host string, main bigint, has_main boolean, page bigint, seq array<bigint>, each array<struct<token: bigint, times: bigint, first: bigint, inner: boolean>>")
    distinct = stored(spread.groupBy("host", "main").agg(
        F.min(F.struct("page", "has_main", "seq", "each")).alias("p")).select("host", "p.*"), "tokens")
    sizes = distinct.groupBy("host").agg(F.count("*").alias("size"), F.count_if("has_main").alias("mains"))
    groups = stored(sizes.withColumn("group", F.when(F.col("size") >= min_pages, F.col("host")).otherwise(F.lit(""))), "hosts")
    group_size = groups.groupBy("group").agg(F.sum("size").alias("size"), F.sum("mains").alias("mains"))

    # The order of a class is that of one page, the same for all of its tokens.
    each = distinct.select("host", "page", F.explode("each").alias("t")).select("host", "page", "t.*")
    sums = [F.sum("pages").alias("pages"), F.sum("vector").alias("vector"), F.max("most").alias("most"),
            F.min("one").alias("one"), F.max("inner").alias("inner")]
    by_host = each.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.sum(F.xxhash64("page", "times").cast("decimal(38,0)")).alias("vector"),
        F.max("times").alias("most"), F.min(F.struct("page", "first")).alias("one"), F.max("inner").alias("inner"))
    vectors = by_host.join(small(groups.select("host", "group"), BROADCAST_ROWS), "host").groupBy("group", "token").agg(*sums)
    common = vectors.join(group_size, "group").where((F.col("pages") >= 2) & (F.col("pages") * 2 >= F.col("size")))
    classes = common.groupBy("group", "pages", "vector").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("one.first", "token"))), lambda x: x["token"]).alias("tokens"),
        F.max("most").alias("most"),
        F.first((F.col("pages") >= F.col("mains") * MAIN_SHARE) & (F.col("pages") >= MIN_PAGES)).alias("inner"),
    ).where(F.size("tokens") >= 2)
    # Outer classes come first: on more pages, once a page, longer.
    ordered = classes.groupBy("group").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("pages")).alias("a"), "most", (-F.size("tokens")).alias("b"), "vector", "tokens", "pages", "inner"))).alias("classes"))
    candidates = stored(ordered.select("group", F.expr("transform(classes, c -> struct(c.tokens, c.pages, c.inner))").alias("classes")), "classes")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of = None, {}
        for batch in batches:
            out = []
            for group, seq, held in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if group != last:
                    last, of = group, {t: (i, n) for i, c in enumerate(held) for n, t in enumerate(c)}
                _, loose, places = arrange(seq, of)
                out += [{"group": group, "cls": of[t][0], "token": t, "gap": None} for t in loose]
                out += [{"group": group, "cls": c, "token": None, "gap": g} for c, g in places.items()]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("group", pa.string()), ("cls", pa.int64()), ("token", pa.int64()), ("gap", pa.int64())]))

    paged = distinct.join(small(groups.select("host", "group"), BROADCAST_ROWS), "host").join(
        small(candidates.select("group", F.expr("transform(classes, c -> c.tokens)").alias("held")), BROADCAST_ROWS), "group")
    said = stored(paged.select("group", "seq", "held").mapInArrow(check, "group string, cls bigint, token bigint, gap bigint")
                  .groupBy("group", "cls", "token", "gap").agg(F.count("*").alias("n")), "order")
    loose = said.where("token IS NOT NULL").groupBy("group").agg(F.collect_list(F.struct("token", "n")).alias("loose"))
    gaps = said.where("token IS NULL").groupBy("group", "cls").agg(F.max(F.when(F.col("gap").isNotNull(), F.col("n"))).alias("best"), F.sum("n").alias("n"))
    nested = gaps.where(F.col("best") >= F.col("n") * MAIN_SHARE).groupBy("group").agg(F.collect_list("cls").alias("nested"))
    joined = candidates.join(nested, "group").join(loose, "group", "left")
    rows = joined.select("group", F.posexplode("classes").alias("class", "c"), "nested", "loose").where(F.array_contains("nested", F.col("class").cast("bigint")))
    kept = (
        rows.withColumn("bad", F.coalesce(F.expr(f"transform(filter(loose, x -> x.n > c.pages * {1 - MAIN_SHARE:.3f}), x -> x.token)"), F.array().cast("array<bigint>")))
        .select("group", "class", "c.inner", "bad", F.posexplode("c.tokens").alias("rank", "token")).where(~F.array_contains("bad", F.col("token")))
    )
    found = kept.groupBy("group").agg(
        F.collect_list(F.struct("token", "class", "rank")).alias("template"), F.collect_set(F.when(F.col("inner"), F.col("class"))).alias("inner"))
    return groups.select("host", "group"), found


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text of every row of pages (page_id, url, html)."""
    named = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit("")).alias("host"),
    )
    hosts, found = templates(named.withColumn("page", F.xxhash64("page_id", "url", "html")), min_pages)
    of_host = stored(hosts.withColumnRenamed("host", "of").join(found, "group", "left").select("of", "template", "inner"), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, known, made = Node("", "", None), {}, {}
        for batch in batches:
            texts = []
            for host, page, template, inner in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4, 5)], strict=True):
                if host not in made:
                    if len(made) > 50:
                        made.clear()
                    made[host] = {x["token"]: (x["class"], x["rank"]) for x in template or ()}, frozenset(inner or ())
                texts.append(extract(page, *made[host], root, known))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    joined = named.join(small(of_host, BROADCAST_ROWS), named.host == of_host.of, "left")
    return joined.select("page_id", "url", "host", "html", "template", "inner").mapInArrow(run, "page_id bigint, url string, text string")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))
