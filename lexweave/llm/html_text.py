"""Main text of web pages: markup first, and a host-wide suffix array for text that markup says nothing about.

A page is read once into blocks. Blocks inside menus, headers, footers, sidebars, notices, adverts, forms, comments and
the like are left out, blocks inside an article or main element are kept. What lies outside both is open: the words of
all open blocks of a host's pages are joined into one stream with a separator behind every block, a suffix array groups
the places that begin with the same `run` words, and words covered by a run that two different pages hold are removed;
the other runs stay. Large hosts are cut into chunks of pages; each chunk sorts its own suffixes and sends one row per
different run, so that runs shared across chunks are found without gathering a host anywhere.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import materialize, small_batches

#: Words of a repeated run.
RUN = 5
#: Open pages of a host that are sorted together.
CHUNK_PAGES = 2000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea xmp iframe noframes svg math title".split())
LEFT_OUT = frozenset("head nav footer aside form select button dialog menu object canvas audio video label datalist".split())
MAIN = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that the start of another block ends, and by which ones.
ENDED = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"}}
#: Words of class, id or role that name a part outside the article, and parts of it.
OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login sidebar aside menu nav navbar navigation breadcrumb breadcrumbs "
    "toolbar footer header masthead topbar comment comments commentlist disqus reply replies respond share sharing social related "
    "recommended recommendations widget widgets contentinfo complementary search pagination pager skip".split()
)
INSIDE = frozenset("main article articlebody".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b(?!\s*=)|aria-hidden\s*=\s*[\"']?true", re.I)
#: A word of an attribute: hyphens, underscores and changes to upper case divide words.
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def role(tag: str, attributes: str, in_main: bool) -> int:
    """-1 for parts left out, 1 for the article, 0 for others."""
    if tag in LEFT_OUT or tag == "header" and not in_main:
        return -1
    main = tag in MAIN
    if attributes and "=" in attributes or "hidden" in attributes:
        for found in ATTRIBUTE.finditer(attributes):
            if not found[1]:
                return -1
            words = {w.lower() for w in NAME.findall(found[2] or found[3] or found[4] or "")}
            if not main and tag not in ("body", "html") and words & OUTSIDE:
                return -1
            main = main or bool(words & INSIDE) and found[1].lower() in ("role", "itemprop")
    return 1 if main else 0


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, open) of the blocks of a page that markup does not leave out, in page order; open: outside any article."""
    made: list[tuple[str, bool]] = []
    held: list[str] = []
    open_tags: list[tuple[str, int, int]] = []  # tag, parts left out and articles among it and what it is in
    out = main = place = 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                made.append((text, not main))
            held.clear()

    def leave(tag: str, stop: frozenset | set = frozenset()) -> bool:
        nonlocal out, main
        for k in range(len(open_tags) - 1, -1, -1):
            if open_tags[k][0] == tag:
                if tag in BLOCKS:
                    flush()
                del open_tags[k:]
                out, main = open_tags[-1][1:] if open_tags else (0, 0)
                return True
            if open_tags[k][0] in stop:
                return False
        return False

    while True:
        found = TAG.search(page, place)
        if not out:
            held.append(page[place : found.start() if found else len(page)])
        if not found:
            break
        place = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            leave(tag, frozenset() if tag in BLOCKS else BLOCKS)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, place)
            place = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            flush()
            for other, by in ENDED.items():
                if tag in by:
                    leave(other, {"table", "ul", "ol", "dl", "article", "main", "section", "div", "td", "th", "li", "body"} - {other})
        if tag == "br":
            held.append(" ")
        if tag in VOID or found[3].endswith("/"):
            continue
        kind = role(tag, found[3], bool(main))
        if kind < 0:
            flush()
        out, main = out + (kind < 0), main + (kind > 0)
        open_tags.append((tag, out, main))
    flush()
    return made


def suffix_classes(codes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling as far as `run` words, and the class of each place: equal classes, equal run words.

    Each separator is a code of its own, so no two runs that hold one are equal.
    """
    n = len(codes)
    rank, length = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while length < run:
        step = min(length, run - length)
        behind = np.full(n, -1, np.int64)
        behind[: max(0, n - step)] = rank[step:]
        order = np.lexsort((behind, rank))
        new = np.concatenate([[0], np.cumsum((np.diff(rank[order]) != 0) | (np.diff(behind[order]) != 0))]) if n else np.zeros(0, np.int64)
        rank = np.empty(n, np.int64)
        rank[order] = new
        length += step
    return np.argsort(rank, kind="stable"), rank


def chunk_stream(texts: list[list[tuple[str, bool]]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of all open blocks one after another with a separator ("") behind every block; page and code of each."""
    words, pages = [], []
    for page, made in enumerate(texts):
        for text, is_open in made:
            if is_open:
                own = text.split(" ")
                words += [*own, ""]
                pages += [page] * (len(own) + 1)
    seen: dict[str, int] = {}
    codes = np.array([seen.setdefault(w, len(seen)) if w else -1 for w in words], np.int64)
    breaks = np.flatnonzero(codes < 0)
    codes[breaks] = len(seen) + np.arange(len(breaks))
    return words, np.array(pages, np.int64), codes


def whole_runs(words: list[str], run: int) -> np.ndarray:
    """Whether `run` words from each place stay within a block."""
    gaps = np.concatenate([[0], np.cumsum([w == "" for w in words])])
    ends = np.arange(len(words)) + run
    return (ends < len(gaps)) & (gaps[np.minimum(ends, len(words))] == gaps[:-1]) if words else np.zeros(0, bool)


def run_keys(texts: list[list[tuple[str, bool]]], names: list[int], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key of each different run of a chunk, whether two different pages of the chunk hold it, and one page that does.

    names: hash of each page's open text; pages with the same text are one page.
    """
    import xxhash

    words, pages, codes = chunk_stream(texts)
    order, rank = suffix_classes(codes, run)
    order = order[whole_runs(words, run)[order]]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(rank[order]) != 0]))
    named = np.array(names, np.int64)[pages[order]]
    low, high = np.minimum.reduceat(named, starts), np.maximum.reduceat(named, starts)
    keys = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + run])) for i in order[starts]], np.uint64).view(np.int64)
    return keys, low != high, low


def uncovered(made: list[tuple[str, bool]], repeated: set[int], run: int) -> str:
    """Text of a page without the words that repeated runs cover in its open blocks."""
    import xxhash

    out = []
    for text, is_open in made:
        if is_open and repeated:
            words = text.split(" ")
            keep = [True] * len(words)
            for i in range(len(words) - run + 1):
                key = xxhash.xxh64_intdigest(" ".join(words[i : i + run]))
                if (key - (1 << 64) if key >> 63 else key) in repeated:
                    keep[i : i + run] = [False] * run
            text = " ".join(w for w, k in zip(words, keep) if k)
        if text:
            out.append(text)
    return "\n".join(out)


def main_text(pages: DataFrame, run: int = RUN, chunk_pages: int = CHUNK_PAGES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; a null page is empty, repeated rows stay.

    Pages are read twice: once for pages with open blocks, which alone are written, and once for the others.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    made_of = "array<struct<text: string, open: boolean>>"

    def read(batches: Iterator[pa.RecordBatch], want_open: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, texts, kept = [], [], [], []
            for page, url, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                made = blocks(source or "")
                if any(is_open for _, is_open in made) != want_open:
                    continue
                ids.append(page)
                urls.append(url)
                if want_open:
                    kept.append([{"text": t, "open": o} for t, o in made])
                else:
                    texts.append("\n".join(t for t, _ in made))
            last = pa.array(kept, pa.list_(pa.struct([("text", pa.string()), ("open", pa.bool_())]))) if want_open else pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), last], ["page_id", "url", "blocks" if want_open else "text"])

    settled = rows.mapInArrow(lambda batches: read(batches, False), "page_id long, url string, text string")
    unsettled = rows.mapInArrow(lambda batches: read(batches, True), f"page_id long, url string, blocks {made_of}")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    text = F.array_join(F.transform(F.filter("blocks", lambda b: b["open"]), lambda b: b["text"]), "\n")
    unsettled = materialize(unsettled.withColumns({"host": host, "name": F.xxhash64(text)}), "open-pages")
    sizes = materialize(unsettled.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / chunk_pages).alias("chunks")), "open-hosts")
    unsettled = unsettled.withColumn("row", F.monotonically_increasing_id()).join(sizes, "host")
    unsettled = materialize(unsettled.withColumn("chunk", F.pmod(F.xxhash64("row"), "chunks")).drop("row", "chunks"), "open-chunks")

    def keys(frame: pd.DataFrame) -> pd.DataFrame:
        texts = [[(b["text"], b["open"]) for b in made] for made in frame["blocks"]]
        key, twice, page = run_keys(texts, frame["name"].tolist(), run)
        return pd.DataFrame({"host": frame["host"].iloc[0], "chunk": frame["chunk"].iloc[0], "key": key, "twice": twice, "page": page})

    found = unsettled.select("host", "chunk", "name", "blocks").groupBy("host", "chunk").applyInPandas(keys, "host string, chunk long, key long, twice boolean, page long")
    found = materialize(found, "open-runs")
    spread = found.groupBy("host", "key").agg(F.max("twice").alias("twice"), F.min("page").alias("a"), F.max("page").alias("b"))
    spread = materialize(spread.where("twice or a <> b").select("host", "key"), "repeated-runs")
    back = found.select("host", "chunk", "key").join(spread, ["host", "key"], "left_semi")

    def strip(frame: pd.DataFrame, repeated: pd.DataFrame) -> pd.DataFrame:
        known = set(repeated["key"].tolist())
        texts = [uncovered([(b["text"], b["open"]) for b in made], known, run) for made in frame["blocks"]]
        return pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts})

    stripped = unsettled.select("host", "chunk", "page_id", "url", "blocks").groupBy("host", "chunk").cogroup(back.groupBy("host", "chunk")).applyInPandas(strip, "page_id long, url string, text string")
    return settled.unionAll(stripped).withColumn("n_chars", F.length("text").cast("long"))
