"""Main text of web pages: markup first, then repeated runs of each host.

1. *Parse.* A page becomes blocks of text (character references decoded, white
   space collapsed). Scripts, styles, forms and the like are dropped. A block
   stands in one of three zones: *main* (inside ``article``, else ``main``),
   *furniture* (navigation, page headers and footers, asides, and elements
   whose class, id or role names a menu, sidebar, notice, advert, comment
   section and so on), or *open* (anything else).
2. *Host suffix array.* The words of all blocks outside the main zone form the
   page's stream. A task concatenates the streams of its pages and sorts all
   their suffixes by rank doubling, as far as ``MIN_RUN`` words (more order is not
   needed to know which runs of ``MIN_RUN`` words recur, and every longer repeat is
   a chain of such runs). Neighbours of equal beginning are a run; its distinct
   pages are counted over all tasks by a digest of host and words, so a host that
   holds a third of all pages is spread like any other. Pages with equal streams
   are copies and count once.
3. *Remove.* Open blocks covered by runs that stand on ``MIN_PAGES`` distinct
   pages or more are removed; of others the words that such runs within the
   block cover, and the unique runs stay. Furniture goes
   entirely. The main zone is the article itself and stays whole, repeated or
   not; if a page has a main zone, open blocks are not part of its article.

So repeated runs decide about pages without an ``article`` or ``main`` element;
for the others the markup does, as menus and footers need not repeat at all and
copied articles must not be taken for boilerplate.

Blocks are joined in page order by a line feed. Defined results: null or empty
html gives an empty text; text of a tag cut off at the end of the page is
dropped; an unclosed element reaches to the end of its parent; a null url is
the host ``''``. Repeated rows give repeated rows; an empty table an empty
result. Only the id, url and html columns are read.
"""

from __future__ import annotations

import hashlib
import html as html_entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .textarrays import SpanHash, mix, signed, slices, utf8, words
from .url_filter import host_and_path

MIN_RUN = 8
MIN_PAGES = 3
MAIN, OPEN, FURNITURE = 0, 1, 2

# Element names of HTML by their role here, in alphabetical order.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead title tr ul""".split())
DROPPED_TAGS = frozenset("""audio button canvas datalist dialog embed form head iframe input map math noscript object option
    progress script select style svg template textarea title video""".split())
FURNITURE_TAGS = frozenset("aside footer header menu nav".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Words in class, id or role attributes that name page furniture, in alphabetical order.
FURNITURE_WORDS = frozenset("""ad ads adsense advert advertisement advertising adverts alert alertdialog author-box banner
    breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright disclaimer disqus
    dropdown feedback flyout foot footer gdpr hamburger header hidden legal login masthead menu menubar modal nav navbar
    navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup promo promotion
    recommended related reply respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe
    subscription taboola tagcloud toc toolbar topbar tracking widget widgets""".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)
    |<(script|style|textarea|title|noscript|iframe|template|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)
    |<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(>|\Z)""", re.S | re.I | re.X)
_NAMING = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")


def _is_furniture(name: str, attributes: str, in_main: bool) -> bool:
    if name in FURNITURE_TAGS and not (name == "header" and in_main):
        return True  # an article's own header holds its headline
    if not attributes or name in ("body", "html", "article", "main"):
        return name == "article" and "comment" in attributes.lower()
    for key, value in _NAMING.findall(attributes):
        value = value.strip("\"'").lower()
        if key.lower() == "hidden" or key.lower() == "aria-hidden" and value == "true":
            return True
        if in_main and key.lower() != "role" and "header" in value:
            continue
        if any(w in FURNITURE_WORDS for w in _WORD.findall(value)):
            return True
    return False


def page_blocks(page: str) -> list[tuple[str, int]]:
    """``(text, zone)`` of every block that has text, in page order."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    skip: list | None = None  # element being dropped and its open count
    # furniture element, its open count, whether it began in the main zone, articles opened in it
    zone_of: list | None = None
    inside = {"article": 0, "main": 0}
    kinds: list[str] = []  # main-zone kind of each block of ``out``

    def flush() -> None:
        if held:
            text = " ".join(html_entities.unescape("".join(held)).split())
            held.clear()
            if text:
                kind = "article" if inside["article"] else "main" if inside["main"] else ""
                out.append((text, FURNITURE if zone_of else OPEN))
                kinds.append("" if zone_of else kind)

    at = 0
    for m in _TOKEN.finditer(page):
        if skip is None and m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        closing = m[2] == "/"
        empty = name in VOID_TAGS or m[4].endswith("/")
        if skip is not None:
            if name == skip[0] and not empty:
                skip[1] += -1 if closing else 1
            if skip[1] == 0 or closing and name in ("body", "html") or not closing and name in ("body", "article", "main"):
                skip = None
            if skip is not None or closing and name in DROPPED_TAGS:
                continue
        if name in BLOCK_TAGS:
            flush()
        elif name == "br":
            held.append(" ")
        if zone_of is not None:
            if name == zone_of[0] and not empty:
                zone_of[1] += -1 if closing else 1
            over = zone_of[1] == 0 or closing and name in ("body", "html")
            if name in inside:
                nested = zone_of[3]
                if not closing:
                    # navigation left open before the article ends there
                    over |= not zone_of[2] and not _is_furniture(name, m[4], False)
                    nested[name] += not over and name != zone_of[0]
                elif nested[name]:
                    nested[name] -= 1
                elif name != zone_of[0]:
                    over = True  # left open up to the end of the article
                    inside[name] = max(inside[name] - 1, 0)
            if over:
                zone_of = None
            if zone_of is not None or closing:
                continue
        if closing:
            if name in inside:
                inside[name] = max(inside[name] - 1, 0)
            continue
        if name in DROPPED_TAGS:
            if not empty:
                skip = [name, 1]
            continue
        in_main = inside["article"] > 0 or inside["main"] > 0
        if not empty and _is_furniture(name, m[4], in_main):
            flush()
            zone_of = [name, 1, in_main, {"article": 0, "main": 0}]
            continue
        if name in inside and not empty:
            inside[name] += 1
    if skip is None and at < len(page):
        # a tag cut off at the end of the page has matched; other text counts
        held.append(page[at:])
    flush()
    chosen = "article" if "article" in kinds else "main" if "main" in kinds else None
    if chosen is None:
        return out
    # an article's surroundings are furniture, however they are marked
    return [(t, MAIN if k == chosen else FURNITURE) for (t, _), k in zip(out, kinds, strict=True)]


def _stream(blocks: list[tuple[str, int]]) -> tuple[str, bool]:
    """The words outside the main zone, and whether any of them is open."""
    return " ".join(t for t, z in blocks if z != MAIN), any(z == OPEN for _, z in blocks)


def _digest(stream: str) -> bytes:
    return hashlib.blake2b(stream.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _stream_words(streams: list[str]):
    """Hash, row and place within its row of every word."""
    data, offsets = utf8(pa.array(streams, pa.string()))
    start, end, row = words(data, offsets)
    count = np.bincount(row, minlength=len(streams))
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    return SpanHash(data)(start, end), row, np.arange(len(row)) - first[row]


def suffix_array(word: np.ndarray, row: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of all streams sorted by their first ``depth`` words, and
    every suffix's rank in that order (equal for equal beginnings; a stream's
    end comes before any word). Ranks of doubling lengths: a suffix's rank by
    2k words is that by k words, and then that of the suffix k words on."""
    n = len(word)

    def paired(rank: np.ndarray, step: int) -> np.ndarray:
        later = np.zeros(n, np.int64)
        if n > step:
            later[:-step] = np.where(row[step:] == row[:-step], rank[step:] + 1, 0)
        return np.unique(rank * (n + 1) + later, return_inverse=True)[1]

    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    known = 1
    while known < depth:
        step = min(known, depth - known)  # the last step overlaps
        rank = paired(rank, step)
        known += step
    return np.argsort(rank, kind="stable"), rank


def _run_keys(word: np.ndarray, host: np.ndarray, at: np.ndarray, min_run: int) -> np.ndarray:
    """Digest of a host's run of words, equal in all tasks."""
    key = host
    for k in range(min_run):
        key = mix(key ^ word[at + k])
    return key


def _host_hashes(hosts: list[str]) -> np.ndarray:
    text, offset = utf8(pa.array(hosts, pa.string()))
    return SpanHash(text)(offset[:-1], offset[1:])


def _whole_runs(row: np.ndarray, place: np.ndarray, n_rows: int, min_run: int) -> np.ndarray:
    """Words that ``min_run`` words of their stream begin with."""
    return place + min_run <= np.bincount(row, minlength=n_rows)[row]


def _run_task(min_run: int):
    """Every run of each stream, once: the suffix array's groups of equal
    beginnings, of each group one member per stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, streams = batch.column("host").to_pylist(), batch.column("words").to_pylist()
            word, row, place = _stream_words(streams)
            order, rank = suffix_array(word, row, min_run)
            order = order[_whole_runs(row, place, len(streams), min_run)[order]]
            order = order[np.lexsort((row[order], rank[order]))]
            new = np.ones(len(order), bool)
            new[1:] = (rank[order][1:] != rank[order][:-1]) | (row[order][1:] != row[order][:-1])
            at = order[new]
            key = _run_keys(word, _host_hashes(hosts)[row[at]], at, min_run)
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), batch.column("stream").take(pa.array(row[at]))], ["run", "stream"])
    return run


def _open_run_task(min_run: int):
    """Every place of every run of the streams with open blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, streams = batch.column("host").to_pylist(), batch.column("words").to_pylist()
            word, row, place = _stream_words(streams)
            at = np.flatnonzero(_whole_runs(row, place, len(streams), min_run))
            again = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([pa.array(signed(_run_keys(word, _host_hashes(hosts)[row[at]], at, min_run))), batch.column("host").take(again),
                                              batch.column("stream").take(again), pa.array(place[at].astype(np.int32))], ["run", "host", "stream", "place"])
    return run


def _parse_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every page's blocks, and the digest of its stream (null: no words outside the main zone)."""
    for batch in batches:
        for part in slices(batch, "html"):
            blocks = [page_blocks(x) if x else [] for x in part.column("html").to_pylist()]
            streams = [_stream(b) for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("id", "url", "host")), pa.array([_digest(s) if s else None for s, _ in streams], pa.binary()),
                 pa.array([is_open for _, is_open in streams]), pa.array([[t for t, _ in b] for b in blocks], pa.list_(pa.string())),
                 pa.array([[z for _, z in b] for b in blocks], pa.list_(pa.int32()))], ["id", "url", "host", "stream", "is_open", "blocks", "zones"])


def _remove_task(min_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_unique_text(b, z, p or [], min_run) for b, z, p in
                     zip(*(batch.column(c).to_pylist() for c in ("blocks", "zones", "places")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])
    return run


def _covered(n: int, starts: np.ndarray, min_run: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + min_run, -1)
    return np.cumsum(change)[:n] > 0


def _unique_text(blocks: list[str], zones: list[int], places: list[int], min_run: int) -> str:
    """The open blocks without what repeated runs cover: blocks covered whole,
    and in others the words of runs that lie within the block (a run that only
    reaches into a block may end in words it shares by chance)."""
    split = [b.split() for b, z in zip(blocks, zones, strict=True) if z != MAIN]
    ends = np.cumsum([len(x) for x in split])
    starts = np.array(places, np.int64)
    n = int(ends[-1])
    anywhere = _covered(n, starts, min_run)
    within = np.searchsorted(ends, starts, side="right") == np.searchsorted(ends, starts + min_run - 1, side="right")
    inside = _covered(n, starts[within], min_run)
    out, at, rest = [], 0, iter(split)
    for block, zone in zip(blocks, zones, strict=True):
        if zone == MAIN:
            out.append(block)
            continue
        own = next(rest)
        span = slice(at, at + len(own))
        at += len(own)
        if zone == OPEN and not anywhere[span].all():
            out.append(" ".join(w for w, gone in zip(own, inside[span], strict=True) if not gone))
    return "\n".join(out)


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> DataFrame:
    """``id_col, url, text`` of every page."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        host_and_path(F.col(f"`{url_col}`"))[0].alias("host"), F.col(f"`{html_col}`").alias("html"))
    id_type = rows.schema["id"].dataType.simpleString()
    parsed = saved(rows.mapInArrow(_parse_task, f"id {id_type}, url string, host string, stream binary, is_open boolean, "
                                                "blocks array<string>, zones array<int>"), "html_extract", "blocks")

    def joined(of_main: bool, separator: str) -> Column:
        return F.array_join(F.filter("blocks", lambda b, i: (F.get("zones", i) == MAIN) == F.lit(of_main)), separator)

    streams = parsed.where("stream is not null").select("host", "stream", "is_open", joined(False, " ").alias("words"))
    # equal streams of a host are copies: a run counts once for them
    repeated = (streams.mapInArrow(_run_task(min_run), "run long, stream binary").distinct()
                .groupBy("run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).select("run"))
    plain = parsed.where("not is_open").select("id", "url", joined(True, "\n").alias("text"))
    # ... and are covered alike: each is judged once
    covered = (streams.where("is_open").dropDuplicates(["host", "stream"])
               .mapInArrow(_open_run_task(min_run), "run long, host string, stream binary, place int")
               .join(repeated, "run", "left_semi")
               .groupBy("host", "stream").agg(F.collect_list("place").alias("places")))  # at most one page's words
    cleaned = (parsed.where("is_open").join(covered, ["host", "stream"], "left").select("id", "url", "blocks", "zones", "places")
               .mapInArrow(_remove_task(min_run), f"id {id_type}, url string, text string"))
    return plain.unionByName(cleaned).withColumnRenamed("id", id_col)
