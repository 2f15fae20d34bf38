"""Main text of web pages: markup scan, then a suffix array per host.

A page is scanned once into blocks of text, each with a zone: inside the article
(``<article>``, ``<main>`` or role main), elsewhere in the body, or boilerplate
by its markup (menus, headers, footers, sidebars, notices, adverts, forms, reader
comments). Scripts, styles, templates and comments give no block at all. An
article inside a wrapper that only looks like boilerplate (a form, a layout's class
name) is the article if it has more words than the articles outside such wrappers and
than half the body's. Without any article the text of such wrappers is body where it
outweighs the body's.

What repeats is counted over all pages of a host. Its different pages are dealt by their
content into groups of about ``group_pages``. In a group the blocks' tokens are
concatenated (with a separator between blocks that equals nothing), and a suffix
array over them, built by prefix doubling to the depth of ``min_tokens``, tells on how
many pages every run of that many tokens occurs; shorter blocks (menu entries, a
copyright line) are counted whole. The groups' counts add up by the run's hash, so the size
and number of groups change no result. In a page without an
article element, what is repeated is removed and the rest kept, along with any block
of markup boilerplate dropped. Many pages are ``min_share`` of the host's, or
``part_pages`` in every ``group_pages`` (boilerplate of a section of the host); the latter removes
nothing from a page that would keep less than half of its words, as that may as well
be one of many near copies. Copies of a page count as one. Hosts whose pages all
are articles are not counted.

In a page that marks its article, the article is the text, with a stricter test: only
a whole block goes that stands at the same place, from the start or the end, in more
than half of the host's different articles, and only while such blocks are at most
half of the article's words (otherwise it is one of many copies). An article with less
than half the words that the body keeps is a teaser: the body is the text too.

On hosts of less than ``min_pages`` pages nothing shows. A page takes part with all of its
blocks.

Defined cases: a null or empty html, or one without text, gives an empty text;
truncated markup counts as far as it goes (an unfinished tag is dropped); a null
or odd url is a host of its own kind; repeated rows are extracted each; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import require, stored, text_batches, window_hashes, word_hashes, word_spans

ARTICLE, BODY, FURNITURE, NOTHING = 0, 1, 2, 3
# while scanning: inside what may only be a layout's wrapper, and an article in there
WRAPPER, WRAPPED = 4, 5

# elements whose content is no markup (up to their end tag) and never text of the page
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
# elements that are dropped with all they hold
DROPPED = frozenset("head noscript template button select option datalist svg math canvas object audio video map".split())
# boilerplate by element
FURNITURE_TAGS = frozenset("nav footer aside form dialog menu search".split())
# boilerplate by a word of class, id or role
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments complementary "
    "contentinfo consent cookie cookies disclaimer discussion disqus footer gdpr masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification pagination popup promo promoted promotion related reply replies "
    "respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# boilerplate for sure, whatever it holds; the others may also be wrappers around an article
FIRM_TAGS = FURNITURE_TAGS - {"form"} | {"header"}
FIRM_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs comment comments complementary discussion disqus "
    "nav navbar navigation pagination promo promoted promotion related reply replies respond sponsor sponsored".split()
)
# an article element that is none
ARTICLE_FURNITURE = frozenset("ad ads advert comment comments promo related reply sponsored teaser".split())
# first words of class names that tell of a layout, not of a part
LAYOUT = frozenset("has no with without".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

MARKUP = re.compile(
    r"""<!--(?:.*?--!?>|.*\Z)            # a comment
    |<!\[CDATA\[(?P<cdata>.*?)\]\]>
    |<[!?][^>]*(?:>|\Z)                  # doctype, processing instruction
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>
    |</?[a-zA-Z][^>]*\Z                  # a tag cut off by the end of the page
    |</[^a-zA-Z>][^>]*>|</>""",
    re.S | re.X,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|aria-hidden|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I | re.S)
WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _furniture(tag: str, value: str, words_of: frozenset = FURNITURE_WORDS) -> bool:
    """Whether a class, id or role names boilerplate (``has-sidebar`` and its like name a layout)."""
    if tag in ("html", "body", "main"):
        return False
    names = ARTICLE_FURNITURE if tag == "article" else words_of
    parts = (WORDS.findall(part) for part in value.split())
    return any(words and words[0] not in LAYOUT and not names.isdisjoint(words) for words in parts)


def _marks(tag: str, attrs: str, zone: int) -> tuple[bool, bool, bool, bool]:
    """(drop it, boilerplate, boilerplate for sure, main) as the attributes say."""
    if not attrs.strip():
        return False, False, False, False
    furniture = firm = main = dropped = False
    for name, value in NAMES.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            dropped = True
        elif name in ("class", "id", "role"):
            main |= name == "role" and value == "main"
            inside = zone in (ARTICLE, WRAPPED)
            furniture |= _furniture(tag, value) or not inside and "header" in WORDS.findall(value) and tag in ("div", "section")
            firm |= _furniture(tag, value, FIRM_WORDS)
    return dropped, furniture and not main, firm and not main, main


def _kind(tag: str, attrs: str, zone: int) -> int | None:
    """The zone that an element opens; None if it changes nothing."""
    if tag in ("html", "body"):
        return None
    dropped, furniture, firm, main = _marks(tag, attrs, zone)
    if tag in DROPPED or dropped:
        return None if zone == NOTHING else NOTHING
    if zone in (NOTHING, FURNITURE):
        return None  # nothing inside is better than what holds it
    if firm or tag in FIRM_TAGS and (tag != "header" or zone not in (ARTICLE, WRAPPED)):
        return FURNITURE
    if tag == "form" and not main or furniture:
        return None if zone == WRAPPER else WRAPPER
    if tag in ("article", "main") or main:
        return WRAPPED if zone in (WRAPPER, WRAPPED) else ARTICLE
    return None


def _settled(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The blocks once it is known what the wrappers hold."""
    if all(zone <= FURNITURE for zone, _ in found):
        return found
    words = [0] * (WRAPPED + 1)
    for zone, text in found:
        words[zone] += len(text.split())
    wrapped = ARTICLE if words[WRAPPED] > max(words[ARTICLE], words[BODY] // 2) else FURNITURE
    marked = words[ARTICLE] or wrapped == ARTICLE
    wrapper = BODY if not marked and words[WRAPPER] > words[BODY] else FURNITURE
    return [({WRAPPED: wrapped, WRAPPER: wrapper}.get(zone, zone), text) for zone, text in found]


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks in page order; white space is one space, none empty."""
    out: list[tuple[int, str]] = []
    pieces: list[str] = []
    scopes: list[list] = []  # open elements that set a zone: tag, zone, open elements of the same tag inside
    zone = BODY

    def close() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            out.append((zone, text))
        pieces.clear()

    def text(raw: str) -> None:
        if zone != NOTHING and raw:
            pieces.append(html.unescape(raw) if "&" in raw else raw)

    def leave(k: int) -> None:
        nonlocal zone
        close()
        del scopes[k:]
        zone = scopes[-1][1] if scopes else BODY

    at, size = 0, len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        text(m["cdata"] or "")
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            text(" ")
        if tag in VOID and tag != "hr":
            continue
        if tag in BLOCKS:
            close()
        if m["end"] or m["end2"]:
            k = next((k for k in reversed(range(len(scopes))) if scopes[k][0] == tag), None)
            if k is not None:
                if scopes[k][2]:
                    scopes[k][2] -= 1
                else:
                    leave(k)  # what was left open inside ends too
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if scopes and (scopes[-1][0] == "p" and tag in BLOCKS or scopes[-1][0] == tag == "li"):
            leave(len(scopes) - 1)  # these end where the next block, or item, begins
        new = _kind(tag, m["attrs"] or m["attrs2"] or "", zone)
        if new is not None:
            close()
            scopes.append([tag, new, 0])
            zone = new
        else:
            same = next((s for s in reversed(scopes) if s[0] == tag), None)
            if same:
                same[2] += 1
    close()
    return _settled(out)


def run_pages(tokens: np.ndarray, pages: np.ndarray, min_tokens: int) -> np.ndarray:
    """On how many distinct pages the run of ``min_tokens`` that starts at each token occurs; 0 where none starts.

    ``tokens`` holds ids, separators negative and all different. Ranks of the
    suffixes' first 1, 2, 4, ... tokens give the order of the suffix array to
    that depth; suffixes of equal rank share the run.
    """
    n = len(tokens)
    if n < min_tokens:
        return np.zeros(n, dtype=np.int64)
    _, rank = np.unique(tokens, return_inverse=True)
    have = 1
    while have < min_tokens:
        step = min(have, min_tokens - have)
        behind = np.full(n, -1, dtype=np.int64)
        behind[: n - step] = rank[step:]
        _, rank = np.unique(rank.astype(np.int64) * (n + 2) + behind + 1, return_inverse=True)
        have += step
    suffixes = np.lexsort((pages, rank))
    r, p = rank[suffixes], pages[suffixes]
    distinct = np.concatenate([[True], (r[1:] != r[:-1]) | (p[1:] != p[:-1])])
    found = np.bincount(r, distinct, minlength=rank.max() + 1).astype(np.int64)[rank]
    separator = np.cumsum(tokens < 0)
    whole = np.zeros(n, dtype=bool)
    whole[: n - min_tokens + 1] = (separator - (tokens < 0))[: n - min_tokens + 1] == separator[min_tokens - 1 :]
    return np.where(whole, found, 0)


def covered_by(starts: np.ndarray, min_tokens: int) -> np.ndarray:
    """Which tokens lie in a run that starts where ``starts`` is true."""
    at = np.flatnonzero(starts)
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + min_tokens, -1)
    return np.cumsum(change[:-1]) > 0


def repeated_runs(tokens: np.ndarray, pages: np.ndarray, min_tokens: int, min_pages: int) -> np.ndarray:
    """Which tokens lie in a run of ``min_tokens`` that occurs on ``min_pages`` distinct pages."""
    return covered_by(run_pages(tokens, pages, min_tokens) >= min_pages, min_tokens)


def _key(*texts: str) -> int:
    """A 64-bit hash of texts without line breaks."""
    return int.from_bytes(hashlib.blake2b("\n".join(texts).encode(), digest_size=8).digest(), "little", signed=True)


def _page_key(page: list[tuple[int, str]]) -> int:
    return _key(*(f"{zone} {text}" for zone, text in page))


def _line(pages: list[list[tuple[int, str]]], min_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (by number) and block of each, first words and hashes of all runs, of the pages' blocks one after the other."""
    ids: dict[str, int] = {}
    texts = [text.split() for page in pages for _, text in page]
    number = np.array([ids.setdefault(w, len(ids)) for words in texts for w in words], np.int64)
    block = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    data = np.frombuffer(" ".join(ids).encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    at, h = window_hashes(word_hashes(data, starts, ends)[number], block, min_tokens)
    return number, block, at, h.view(np.int64)


def repeated_parts(contents: list[list[tuple[int, str]]], min_tokens: int) -> tuple[np.ndarray, np.ndarray, Counter]:
    """Hashes of the runs of different pages, on how many each occurs (by their suffix array), and the same of whole blocks."""
    number, block, at, h = _line(contents, min_tokens)
    sizes = np.array([len(page) for page in contents], np.int64)
    place = np.arange(len(number)) + block  # a separator stands behind each block
    stream = -1 - np.arange(len(number) + int(sizes.sum()), dtype=np.int64)
    stream[place] = number
    lengths = np.bincount(block, minlength=int(sizes.sum())) + 1
    found = run_pages(stream, np.repeat(np.repeat(np.arange(len(contents)), sizes), lengths), min_tokens)
    runs, first = np.unique(h, return_index=True)
    return runs, found[place[at[first]]], Counter(_key(text) for page in contents for text in {text for _, text in page})


def needed(n: int, min_pages: int, min_share: float, part_pages: int, group_pages: int) -> list[int]:
    """On how many of a host's ``n`` different pages boilerplate stands: of the host, and of a section."""
    most = max(min_pages, int(np.ceil(min_share * n)))
    part = max(min_pages, part_pages, -(-n * part_pages // group_pages))
    return [most, *([part] if part < most else [])]


def page_texts(
    pages: list[list[tuple[int, str]]], needs: list[int], runs: tuple[np.ndarray, np.ndarray], holders: dict[int, int], fixed: set[int], min_tokens: int
) -> list[str]:
    """The main text of pages of one host, by what is known of the host.

    ``runs`` are the hashes of repeated runs, in order, and their pages; ``holders`` the pages of
    whole blocks; ``fixed`` the keys of article blocks that stand at one place in most articles.
    """
    opened = [k for k, page in enumerate(pages) if _open(page)]
    spans: dict[int, list[tuple[int, int]]] = {}
    covers: list[np.ndarray] = []
    if needs and opened:
        number, _, at, h = _line([pages[k] for k in opened], min_tokens)
        end = 0
        for k in opened:
            spans[k] = []
            for _, text in pages[k]:
                start, end = end, end + len(text.split())
                spans[k].append((start, end))
        times = np.zeros(len(number), np.int64)
        if len(runs[0]):
            near = np.minimum(np.searchsorted(runs[0], h), len(runs[0]) - 1)
            times[at] = np.where(runs[0][near] == h, runs[1][near], 0)
        covers = [covered_by(times >= need, min_tokens) for need in needs]

    def body(page: list[tuple[int, str]], mine: list[tuple[int, int]]) -> list[str]:
        """The page's body blocks, empty where repeated; other blocks are empty."""
        out: list[str] = []
        for need, covered in zip(needs, covers, strict=True):
            kept = []
            for (zone, text), (a, b) in zip(page, mine, strict=True):
                if zone != BODY or holders.get(_key(text), 0) >= need:
                    kept.append("")
                else:
                    hit = covered[a:b]
                    kept.append(" ".join(w for w, c in zip(text.split(), hit, strict=True) if not c) if hit.any() else text)
            if not out or 2 * _words(kept) >= _words(out):
                out = kept
        return out

    def inside(article: list[str]) -> list[str]:
        """The article's blocks, empty where a block stands there on most pages."""
        if not fixed:
            return article
        kept = ["" if any(_key(str(k), t) in fixed for k, t in at) else text for text, at in zip(article, _places(article), strict=True)]
        return kept if 2 * _words(kept) >= _words(article) else article

    texts = []
    for k, page in enumerate(pages):
        kept = body(page, spans[k]) if k in spans else [text if zone == BODY else "" for zone, text in page]
        if article := [text for zone, text in page if zone == ARTICLE]:
            of_article = iter(inside(article))
            teaser = 2 * _words(article) < _words(kept)
            kept = [next(of_article) if zone == ARTICLE else text if teaser else "" for (zone, _), text in zip(page, kept, strict=True)]
        texts.append("\n".join(t for t in kept if t))
    return texts


def _open(page: list[tuple[int, str]]) -> bool:
    """Whether the page's body may be (part of) its text."""
    return 2 * _words([t for z, t in page if z == ARTICLE]) < _words([t for z, t in page if z == BODY])


def host_texts(
    pages: list[list[tuple[int, str]]], min_tokens: int, min_pages: int, min_share: float, part_pages: int = 16, group_pages: int = 256
) -> list[str]:
    """The main text of each page of one host, all of them given."""
    contents = [list(page) for page in dict.fromkeys(tuple(page) for page in pages)]  # copies of a page count as one
    runs, times, holders = repeated_parts(contents, min_tokens)
    articles = {tuple(text for zone, text in page if zone == ARTICLE) for page in contents} - {()}
    places = Counter(_key(str(k), text) for article in articles for at in _places(article) for k, text in at)
    often = max(min_pages, len(articles) // 2 + 1)
    needs = needed(len(contents), min_pages, min_share, part_pages, group_pages)
    return page_texts(pages, needs, (runs, times), holders, {k for k, n in places.items() if n >= often}, min_tokens)


def _places(article: tuple[str, ...] | list[str]) -> list[tuple[tuple[int, str], tuple[int, str]]]:
    """Each block's text with its place counted from the start, and from the end."""
    return [((k, text), (k - len(article), text)) for k, text in enumerate(article)]


def _words(texts: list[str]) -> int:
    return sum(len(t.split()) for t in texts)


def extract_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_tokens: int = 8,
    min_pages: int = 3,
    min_share: float = 0.5,
    part_pages: int = 16,
    group_pages: int = 256,
) -> DataFrame:
    """(id, url, text, n_chars) of every page.

    A run or a whole block is boilerplate if it occurs on ``min_pages`` different pages
    of a host, and on ``min_share`` of them or, for a section's, on ``part_pages`` of every
    ``group_pages`` (and on ``part_pages`` at least).
    """
    require(pages, id_col, url_col, html_col)
    text_batches(pages)
    kind = pages.schema[id_col].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.col(html_col).alias("html"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("zone", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            column = batch.column(3)
            for lo in range(0, batch.num_rows, 256):
                found = [blocks(v.as_py() or "") for v in column.slice(lo, 256)]
                articles = [[t for z, t in page if z == ARTICLE] for page in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(lo, 256) for i in range(3)), pa.array([[{"zone": z, "text": t} for z, t in page] for page in found], kinds),
                        pa.array([_page_key(page) for page in found], pa.int64()), pa.array([_open(page) for page in found], pa.bool_()),
                        pa.array([_key(*a) if a else None for a in articles], pa.int64()),
                        pa.array([[_key(str(k), t) for at in _places(a) for k, t in at] for a in articles], pa.list_(pa.int64())),
                    ],
                    ["id", "url", "host", "blocks", "page", "open", "article", "places"],
                )

    schema = f"id {kind}, url string, host string, blocks array<struct<zone:int,text:string>>, page long, open boolean, article long, places array<long>"
    scanned = stored(rows.mapInArrow(scan, schema), "pages", compression="zstd")

    # article blocks at one place in most of a host's different articles
    articles = scanned.where("article IS NOT NULL").groupBy("host", "article").agg(F.first("places").alias("places"))
    often = articles.select("host", F.explode("places").alias("place")).groupBy("host", "place").count().where(F.col("count") >= min_pages)
    of_host = articles.groupBy("host").agg(F.count("article").alias("articles"))
    fixed = often.join(of_host, "host").where(2 * F.col("count") > F.col("articles")).groupBy("host").agg(F.collect_list("place").alias("fixed"))
    fixed = stored(fixed, "fixed")

    # runs and blocks repeated on a host, if the body of any page counts there; different pages are dealt by content
    contents = scanned.groupBy("host", "page").agg(F.max("open").alias("open"))
    hosts = contents.groupBy("host").agg(F.count("page").alias("n"), F.max("open").alias("open")).where("open")
    hosts = stored(hosts.select("host", "n", F.ceil(F.col("n") / group_pages).alias("parts")), "hosts")
    part = F.pmod(F.col("page"), F.coalesce("parts", F.lit(1))).alias("part")
    dealt = scanned.join(hosts, "host").select("host", part, "page", "blocks")

    def of_page(rows: pa.Table) -> list[list[tuple[int, str]]]:
        return [[(b["zone"], b["text"]) for b in page] for page in rows.column("blocks").to_pylist()]

    def count(key: tuple, table: pa.Table) -> pa.Table:
        different = [list(page) for page in {k: tuple(p) for k, p in zip(table.column("page").to_pylist(), of_page(table), strict=True)}.values()]
        runs, times, holders = repeated_parts(different, min_tokens)
        n = len(runs) + len(holders)
        return pa.table(
            {
                "host": pa.array([key[0].as_py()] * n, pa.string()), "whole": pa.array([False] * len(runs) + [True] * len(holders), pa.bool_()),
                "hash": pa.array([*runs.tolist(), *holders], pa.int64()), "times": pa.array([*times.tolist(), *holders.values()], pa.int64()),
            }
        )

    parts = dealt.groupBy("host", "part").applyInArrow(count, "host string, whole boolean, hash long, times long")
    most = F.greatest(F.lit(min_pages), F.ceil(F.col("n") * min_share))
    section = F.greatest(F.lit(min_pages), F.lit(part_pages), F.ceil(F.col("n") * part_pages / group_pages))
    repeats = parts.groupBy("host", "whole", "hash").agg(F.sum("times").alias("times")).where(F.col("times") >= min_pages)
    repeats = repeats.join(hosts, "host").where(F.col("times") >= F.least(most, section))
    known = hosts.join(repeats.groupBy("host").agg(F.collect_list(F.struct("whole", "hash", "times")).alias("repeats")), "host", "left")
    known = stored(known.join(fixed, "host", "left"), "known")

    def result(rows: pa.Table, texts: list[str]) -> pa.Table:
        counts = pa.array([len(t) for t in texts], pa.int64())
        return pa.table({"id": rows.column("id"), "url": rows.column("url"), "text": pa.array(texts, pa.string()), "n_chars": counts})

    def of_articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = []
            for page, places in zip(of_page(table), table.column("fixed").to_pylist(), strict=True):
                texts += page_texts([page], [], none, {}, set(places or ()), min_tokens)
            yield from result(table, texts).to_batches()

    def of_bodies(_key: tuple, table: pa.Table, host: pa.Table) -> pa.Table:
        about = host.to_pylist()[0]
        found = about["repeats"] or []
        runs = np.array(sorted((r["hash"], r["times"]) for r in found if not r["whole"]), np.int64).reshape(-1, 2)
        holders = {r["hash"]: r["times"] for r in found if r["whole"]}
        needs = needed(about["n"], min_pages, min_share, part_pages, group_pages)
        return result(table, page_texts(of_page(table), needs, (runs[:, 0], runs[:, 1]), holders, set(about["fixed"] or ()), min_tokens))

    schema = f"id {kind}, url string, text string, n_chars long"
    plain = scanned.where(~F.col("open")).join(fixed, "host", "left").select("id", "url", "blocks", "fixed").mapInArrow(of_articles, schema)
    bodies = scanned.where("open").join(hosts, "host").select("id", "url", "host", part, "blocks").groupBy("host", "part")
    of_part = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).groupBy("host", "part")

    def meet(key: tuple, table: pa.Table, host: pa.Table) -> pa.Table:
        return of_bodies(key, table, host) if table.num_rows else result(table, [])

    out = plain.unionByName(bodies.cogroup(of_part).applyInArrow(meet, schema))
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)


def op5_html(pages: DataFrame) -> DataFrame:
    """The registered query: the main text of every page."""
    return extract_text(pages)
