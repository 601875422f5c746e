"""Operator 7: main text of web pages, with boilerplate found by a suffix array for each host.

A page is read into blocks of text. Its markup says of most blocks what they are: inside ``article`` or ``main`` (or an
element whose class, id or role says so) they are content; menus, headers, footers, sidebars, notices, adverts, forms
and comments are not. Blocks of which the markup says nothing are settled by the host: the token streams of what lies
outside the content of its pages are laid end to end, their suffix array shows the long runs of tokens that several
pages share, and blocks are cut to the runs that no such boilerplate covers. What is left of them is text, also beside
marked content. Marked content is never cut, also where pages share passages of it.

A class, id or role is read name by name ("post related-open" has two). A name of good words only makes content; one of
bad words drops an element that no good word stands in; words after "has", "with", "no" and the like say nothing.

A host's pages are dealt to groups of bounded size, so one host may hold any share of all pages. Each group's suffix array
counts the pages of every run; the counts of a run are added over all groups of the host, and what is boilerplate in
the whole host goes back to the groups that have it. The groups thus don't change what is found. Hosts without an
unmarked block ask nothing and are not counted.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.suffix_dedup import permuted_prefixes, suffix_array

#: Tokens of a run that counts as boilerplate, pages that must share it, pages of a group on average.
LEAST_TOKENS, LEAST_PAGES, GROUP_PAGES = 5, 3, 256

# Names of elements and words in class, id and role.
_RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|textarea|select|xmp|noembed|noframes|video|audio"
_DROPPED = frozenset("head nav footer aside form button menu dialog fieldset datalist".split())
_CONTENT = frozenset("article main".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = _BLOCKS - {"br"}
_SELF = frozenset("p li dt dd tr td th option".split())
_BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar sidebars nav "
    "navbar navigation menu menus breadcrumb breadcrumbs footer comment comments respond disqus cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended widget pager pagination masthead toolbar skip complementary contentinfo search banner form".split()
)
_HEADERS = frozenset("header masthead topbar".split())
_GOOD_WORDS = frozenset("article main content post entry story articlebody postcontent entrycontent maincontent".split())
#: What follows in a name doesn't say what the element is ("has-sidebar", "no-comments").
_MODIFIERS = frozenset("has have with without no not non hide".split())

_TOKENS = re.compile(
    rf"<!--.*?(?:--\s*>|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_MARKS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NEUTRAL, CONTENT, DROPPED = 0, 1, 2


def _zone(name: str, rest: str, outer: int) -> int:
    """What an element's text is, given what it is in."""
    if outer == DROPPED or name in _DROPPED:
        return DROPPED
    if name in _CONTENT:
        return CONTENT
    if name == "header" and outer != CONTENT:
        return DROPPED
    if rest and name not in ("html", "body"):
        names = [_words_of(n) for m in _MARKS.findall(rest) for n in next(filter(None, m), "").split()]
        words = set().union(*names)
        if any(n & _GOOD_WORDS and not n & _BAD_WORDS for n in names):
            return CONTENT
        if not words & _GOOD_WORDS and (words & _BAD_WORDS or words & _HEADERS and outer != CONTENT):
            return DROPPED
    return outer


def _words_of(name: str) -> set[str]:
    """The words of a name up to a modifier, and the name as one word if it has none."""
    words = [w.lower() for w in _WORDS.findall(name)]
    for i, word in enumerate(words):
        if word in _MODIFIERS:
            return set(words[:i])
    return {*words, re.sub(r"[^a-z]", "", name.lower())}


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of each block in page order; white space is one space, character references are decoded."""
    out: list[tuple[int, str]] = []
    open_: list[tuple[str, int]] = []
    zone, held = NEUTRAL, []

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((zone, text))

    for m in _TOKENS.finditer(page):
        text = m["text"]
        if text is not None:
            held.append(text)
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue  # a comment, a declaration or an element without text of its own
        block = name in _BLOCKS
        if m["close"] or m["close2"]:
            if block:
                flush()
            if any(n == name for n, _ in open_):
                flush()
                while open_.pop()[0] != name:
                    pass
                zone = open_[-1][1] if open_ else NEUTRAL
            continue
        rest = m["rest"] if m["name"] else m["rest2"]
        if block:
            flush()
        if name == "body" or (name in _SELF or name in _CLOSES_P) and open_:
            # elements that end without being closed
            while open_ and (
                (open_[-1][0] == "p" and name in _CLOSES_P)
                or (open_[-1][0] == name and name in _SELF)
                or (name == "body" and open_[-1][0] == "head")
            ):
                open_.pop()
            zone = open_[-1][1] if open_ else NEUTRAL
        if name in _VOID or rest.endswith("/"):
            continue
        if block or rest:
            inner = _zone(name, rest, zone)
            if block or inner != zone:
                if inner != zone:
                    flush()
                open_.append((name, inner))
                zone = inner
    flush()
    return out


class Runs:
    """The runs of ``least_tokens`` tokens in the streams of some pages, by a suffix array.

    ``owners`` has the page of each stream. A block shorter than a run counts as one if it is whole (blocks end with a
    mark of their own).
    """

    def __init__(self, streams: list[list[list[str]]], owners: list[int], least_tokens: int = LEAST_TOKENS):
        self.streams, number = streams, {}
        text: list[int] = []
        page_of: list[int] = []
        for p, page in zip(owners, streams):
            for block in page:
                text += [number.setdefault(token, len(number) + 2) for token in block]
                text.append(1)
                page_of += [p] * (len(block) + 1)
        text.append(0)
        page_of.append(-1)
        array = suffix_array(text, len(number) + 2)
        shared = np.array(permuted_prefixes(text, array))
        array, pages = np.array(array), np.array(page_of)
        self.text, self.tokens = np.array(text), ["", "", *number]
        marks = self.text <= 1
        ends = np.minimum.accumulate(np.where(marks, np.arange(len(text)), len(text))[::-1])[::-1]
        want = np.minimum(least_tokens, ends - np.arange(len(text)) + 1)  # to the block's mark, if that is nearer
        self.at_start = np.concatenate([[True], marks[:-1]])
        #: Of each size of run: size, the runs' starts, the number of each start's run, pages of each run.
        self.found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        # a block's mark belongs to its short run, so that "x" matches a block "x" and not a block "x y"
        for size in range(2, least_tokens + 1):
            new = shared[array] < size
            stretch = np.cumsum(new) - 1
            ask = (want[array] == size) & ~marks[array]
            start = array[ask]
            _, first, run = np.unique(stretch[ask], return_index=True, return_inverse=True)
            order = np.lexsort((pages[start], run))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (run[order][1:] != run[order][:-1]) | (pages[start][order][1:] != pages[start][order][:-1])
            self.found.append((size, start, run, np.bincount(run[order][fresh], minlength=len(first))))

    def keys(self, host: str) -> list[list[bytes]]:
        """128 bits for each run of each size: equal for equal runs of a host, in any group."""
        out = []
        for size, start, run, n_pages in self.found:
            first = np.zeros(len(n_pages), np.int64)
            first[run] = start
            named = ([self.tokens[x] for x in self.text[a : a + size]] for a in first.tolist())
            out.append([blake2b(" ".join([host, *tokens]).encode("utf-8", "surrogatepass"), digest_size=16).digest() for tokens in named])
        return out

    def covered(self, chosen: list[np.ndarray]) -> list[list[np.ndarray]]:
        """For every stream and block, which tokens lie in a chosen run (of each size, a flag for each run)."""
        change = np.zeros(len(self.text) + 1, np.int64)
        for (size, start, run, _n), flags in zip(self.found, chosen):
            # ends of blocks count as a short run's copies, but only whole blocks are cut for one
            start = start[flags[run] & (self.at_start[start] | (size == self.found[-1][0]))]
            np.add.at(change, start, 1)
            np.add.at(change, start + size, -1)
        inside = np.cumsum(change[:-1]) > 0
        out, at = [], 0
        for page in self.streams:
            out.append([])
            for block in page:
                out[-1].append(inside[at : at + len(block)])
                at += len(block) + 1
        return out


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    page: str = "html",
    least_tokens: int = LEAST_TOKENS,
    least_pages: int = LEAST_PAGES,
    group_pages: int = GROUP_PAGES,
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Blocks are joined by one space in page order. Null and empty pages have an empty text; a page without a host
    (null or odd url) belongs to a host without name. Repeated rows are pages of their own for the output and one
    page, by id and url, for what pages share. Other columns are left out.
    """
    kind = pages.schema[id_column].dataType.simpleString()
    host = F.coalesce(F.lower(F.regexp_extract(F.col("_url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(
        pages[id_column].alias("_id"), pages[url].alias("_url"), pages[page].alias("_html")
    ).withColumn("_host", host)
    fields = f"_id {kind}, _url string, _host string"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[int, str]]], list[bool]]]:
        """Some pages, their blocks, and whether there are some without a mark."""
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [blocks(source or "") for source in part.column(2).to_pylist()]
                yield part, found, [any(zone == NEUTRAL for zone, _text in page) for page in found]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages whose markup settles their text."""
        for part, found, asks in parse(batches):
            content = [" ".join(text for zone, text in page if zone == CONTENT) for page in found]
            text = pa.array(content, pa.string())
            columns = [part.column(0), part.column(1), text, pa.array(map(len, content), pa.int64())]
            done = pa.array([not asked for asked in asks], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"]).filter(done)

    def streams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What lies outside the content of pages, for their hosts; with the content of pages that ask them."""
        for part, found, asks in parse(batches):
            found = [[b for b in page if asked or b[0] != CONTENT] for page, asked in zip(found, asks)]
            zones = pa.array([[zone for zone, _text in page] for page in found], pa.list_(pa.int32()))
            texts = pa.array([[text for _zone, text in page] for page in found], pa.list_(pa.string()))
            columns = [part.column(0), part.column(1), part.column(3), zones, texts]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_url", "_host", "zones", "texts"])

    def runs_of(table: pa.Table) -> tuple[list[tuple], Runs]:
        """A group's rows by name, and the runs outside their content."""
        names = list(zip(table["_id"].to_pylist(), table["_url"].to_pylist()))
        number = {name: i for i, name in enumerate(dict.fromkeys(names))}
        made = list(zip(names, table["zones"].to_pylist(), table["texts"].to_pylist()))
        streams = [[t.split() for z, t in zip(zones, texts) if z != CONTENT] for _name, zones, texts in made]
        return made, Runs(streams, [number[name] for name in names], least_tokens)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        """Pages of a group for each of its runs."""
        host, group = (k.as_py() for k in key)
        _made, runs = runs_of(table)
        keys = [k for of_size in runs.keys(host) for k in of_size]
        n_pages = np.concatenate([n for *_, n in runs.found])
        columns = [pa.array([x] * len(keys), kind) for x, kind in ((host, pa.string()), (group, pa.int64()))]
        columns += [pa.array(keys, pa.binary()), pa.array(n_pages, pa.int64())]
        return pa.table(dict(zip(("_host", "_group", "run", "n"), columns)))

    def settle(key: tuple, table: pa.Table, common: pa.Table) -> pa.Table:
        zones, ids, urls, text = table["zones"].to_pylist(), [], [], []
        if any(NEUTRAL in page for page in zones):
            made, runs = runs_of(table)
            known = set(common["run"].to_pylist())
            cover = runs.covered([np.array([k in known for k in keys], bool) for keys in runs.keys(key[0].as_py())])
            for (name, page_zones, page_texts), found in zip(made, cover):
                if NEUTRAL in page_zones:
                    kept, inside = [], iter(found)
                    for zone, block in zip(page_zones, page_texts):
                        covered = [False] * len(block.split()) if zone == CONTENT else next(inside).tolist()
                        if zone != DROPPED:
                            kept += [token for token, out in zip(block.split(), covered) if not out]
                    ids.append(name[0])
                    urls.append(name[1])
                    text.append(" ".join(kept))
        return pa.table(
            {
                "page_id": pa.array(ids, table["_id"].type),
                "url": pa.array(urls, pa.string()),
                "text": pa.array(text, pa.string()),
                "n_chars": pa.array(map(len, text), pa.int64()),
            }
        )

    # texts that markup settles are not shuffled; pages are read again for what their hosts are asked
    schema = f"page_id {kind}, url string, text string, n_chars long"
    asked = rows.mapInArrow(streams_of, f"{fields}, zones array<int>, texts array<string>")
    sizes = asked.groupBy(F.col("_host").alias("_h")).agg(
        F.ceil(F.count("*") / group_pages).alias("_groups"), F.max(F.array_contains("zones", NEUTRAL)).alias("_asks")
    )
    dealt = asked.join(sizes.where("_asks"), F.col("_host") == F.col("_h")).withColumn(
        "_group", F.pmod(F.xxhash64("_id", "_url"), F.col("_groups"))
    )
    grouped = dealt.select("_id", "_url", "_host", "_group", "zones", "texts").groupBy("_host", "_group")
    counts = grouped.applyInArrow(count, "_host string, _group long, run binary, n long")
    total = F.sum("n").over(Window.partitionBy("run"))
    common = counts.withColumn("total", total).where(F.col("total") >= least_pages).select("_host", "_group", "run")
    settled = grouped.cogroup(common.groupBy("_host", "_group")).applyInArrow(settle, schema)
    return rows.mapInArrow(marked, schema).unionByName(settled)
