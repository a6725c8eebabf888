"""Main text of web pages: structure first, then a suffix array over each host for pages whose structure doesn't say.

A page is read as a stream of tags. What lies in elements that are never main text (navigation, headers and footers of the page, asides, forms, scripts,
styles, adverts, notices, comments, by element, class, id or role) is left out. If the page marks its article (or else its main
part), the blocks inside are its main text, whole: text that copies share on a host is not boilerplate there. Otherwise the blocks of the body are
candidates, and all candidate pages of a host are joined into one token stream; a suffix array finds runs of LONG tokens or more that
distinct pages share, these are taken out, and the unique runs stay. A page with nothing unique is a copy and keeps its blocks.

A host's pages are dealt into shards of about SHARD pages, so a host of any size is spread. Shards of a host exchange the hashes of their runs of
LONG tokens with the least and greatest page that has them, so a run that only pages of different shards share is taken out, too. Defined results: null and empty html give an empty text; a null url is a host of its own; repeated rows are
treated each, and as one page where they are compared; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm.shingles import U64, combine
from atlasmill.llm.workspace import Workspace, table

LONG, SHARD = 6, 1024
#: Fixed values of HTML: elements without an end tag, with raw contents, that don't break a block, that are never main text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
AWAY = {"nav", "aside", "footer", "form", "menu", "button", "select", "dialog", "head", "figure-actions", "object", "canvas", "audio", "video"}
#: Words of a class, id or role that say the same.
AWAY_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side rail footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments reply replies discussion disqus respond widget toolbar pagination pager search contentinfo complementary skip".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/\"']|$)", re.I)
_WORD = re.compile(r"[a-z]+")


def _marks(rest: str) -> tuple[set[str], str]:
    found, kind = set(), ""
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), html.unescape(value.strip("\"'")).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.add("ad")
        elif name == "itemprop":
            kind = "article" if value == "articlebody" else kind
        else:
            found |= set(_WORD.findall(value))
            kind = "main" if name == "role" and value == "main" else "article" if name == "role" and value == "article" else kind
    return found & AWAY_WORDS, kind


def blocks(page: str) -> tuple[list[str], bool]:
    """Blocks of main text in page order; whether the page marks where it is. White space is single, references are decoded."""
    out: dict[str, list[str]] = {"article": [], "main": [], "body": []}
    stack: list[tuple[str, bool, str]] = []  # open elements: name, whether away, kind of root
    run: list[str] = []

    def close_block() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                kinds = {k for _, _, k in stack}
                out["article" if "article" in kinds else "main" if "main" in kinds else "body"].append(text)

    away, at, size = 0, 0, len(page)
    while at < size:
        lt = page.find("<", at)
        m = _TOKEN.match(page, lt) if lt >= 0 else None
        if m is None:
            end = size if lt < 0 else lt + 1
            if not away:
                run.append(page[at:end])
            at = end
            continue
        if not away:
            run.append(page[at:lt])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1] and not away:
                run.append(html.escape(m[1], quote=False))
            continue
        name = name.lower()
        if not m[2]:
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at) if not m[0].endswith("/>") else None
                if name in ("title", "noscript", "svg", "iframe", "textarea") or end:
                    at = end.end() if end else at
                else:
                    at = size
                continue
            if name in VOID:
                if name not in ("wbr", "img") and not away:
                    close_block()
                continue
            words, kind = _marks(m[4]) if "=" in m[4] or "hidden" in m[4] else (set(), "")
            inside = any(k for _, _, k in stack)
            gone = name in AWAY or bool(words) and name not in ("html", "body", "article", "main") or (name == "header" and not inside) or (name == "article" and bool(words & {"comment", "comments", "reply", "replies", "related", "ad", "ads", "promo", "sponsored"}))
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):  # an open one ends where the next begins
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] not in INLINE and stack[i][0] != name:
                        break
                    if stack[i][0] == name:
                        if not away:
                            close_block()
                        away -= sum(g for _, g, _ in stack[i:])
                        del stack[i:]
                        break
            if name not in INLINE and not away:
                close_block()
            kind = kind or ("article" if name == "article" else "main" if name == "main" else "")
            if not m[0].endswith("/>") or name not in INLINE:
                stack.append((name, gone, "" if gone else kind))
                if gone and not away:
                    close_block() if name not in INLINE else None
                away += gone
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if not away and name not in INLINE:
                        close_block()
                    away -= sum(g for _, g, _ in stack[i:])
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE or stack[i][0] in ("article", "main", "body") and name not in ("html", "body", "article", "main"):
                    break
    close_block()
    for kind in ("article", "main"):
        if out[kind]:
            return out[kind], True
    return out["body"], False


def shared_tokens(stream: np.ndarray, page: np.ndarray, long: int = LONG) -> np.ndarray:
    """Which tokens lie in a run of at least long tokens that distinct pages share. Runs don't cross pages.

    Prefix doubling sorts the suffixes by their first long tokens; suffixes of one rank are neighbours in the suffix array.
    """
    n = len(stream)
    if n < long:
        return np.zeros(n, bool)
    rank, width = np.unique(stream, return_inverse=True)[1].astype(np.int64), 1
    while width < long:
        step = min(width, long - width)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        rank = np.unique((rank + 1) * (n + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        width += step
    suffix = np.argsort(rank, kind="stable")
    whole = np.zeros(n, bool)
    whole[: n - long + 1] = page[: n - long + 1] == page[long - 1 :]
    suffix = suffix[whole[suffix]]
    r, p = rank[suffix], page[suffix]
    first = np.flatnonzero(np.diff(r, prepend=-1))
    lo, hi = np.minimum.reduceat(p, first) if len(first) else p, np.maximum.reduceat(p, first) if len(first) else p
    shared = suffix[np.repeat(lo != hi, np.diff(np.append(first, len(r))))] if len(first) else suffix
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, shared, 1)
    np.add.at(cover, shared + long, -1)
    return np.cumsum(cover[:-1]) > 0


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hosts, texts, parts = [], [], []
        for url, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist(), strict=True):
            try:
                hosts.append((urlsplit(url or "").hostname or "").lower())
            except ValueError:
                hosts.append("")
            found, marked = blocks(page) if page else ([], True)
            texts.append(" ".join(found) if marked else None)
            parts.append(None if marked else found)
        yield pa.record_batch({"page_id": b.column("page_id"), "url": b.column("url"), "host": pa.array(hosts, pa.string()), "text": pa.array(texts, pa.string()), "parts": pa.array(parts, pa.list_(pa.string()))})


def _hash(x: str) -> int:
    return int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _streams(group: pa.Table) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each page; of all tokens as one stream their numbers and pages; and of each place the hash of the run of LONG tokens there."""
    tokens = [[w for p in page for w in p.split(" ")] for page in group.column("parts").to_pylist()]
    number: dict[str, int] = {}
    stream = np.array([number.setdefault(w, len(number)) for t in tokens for w in t], np.int64)
    ids: dict[tuple, int] = {}
    page = np.repeat([ids.setdefault((i, tuple(t)), len(ids)) for i, t in zip(group.column("page_id").to_pylist(), tokens, strict=True)], [len(t) for t in tokens]).astype(np.int64)
    return tokens, stream, page, combine(np.array([_hash(w) for w in number], U64)[stream], LONG) if len(stream) else np.empty(0, U64)


def _runs(group: pa.Table) -> pa.Table:
    """Each run of LONG tokens of a shard, with the least and greatest page that has it."""
    tokens, _, page, run = _streams(group)
    key = np.repeat(np.array([_hash(f"{i} {' '.join(t)}") for i, t in zip(group.column("page_id").to_pylist(), tokens, strict=True)], U64).view(np.int64), [len(t) for t in tokens])
    whole = page[: len(run)] == page[LONG - 1 :] if len(run) else np.empty(0, bool)
    run, key = run[whole], key[: len(run)][whole]
    order = np.argsort(run, kind="stable")
    run, key = run[order], key[order]
    first = np.flatnonzero(np.diff(run, prepend=~run[:1]))
    lo, hi = (f.reduceat(key, first) if len(first) else key for f in (np.minimum, np.maximum))
    host, shard = (pa.repeat(group.column(c)[0], len(first)) for c in ("host", "shard"))
    return pa.table({"host": host, "shard": shard, "run": pa.array(run[first].view(np.int64)), "lo": pa.array(lo), "hi": pa.array(hi)})


def _unshared(group: pa.Table, known: pa.Table) -> pa.Table:
    """The texts of a shard's pages without the runs they share, or that are known to be shared across shards."""
    tokens, stream, page, run = _streams(group)
    gone = shared_tokens(stream, page)
    if known.num_rows and len(run):
        at = np.flatnonzero(np.isin(run, known.column("run").to_numpy().view(U64)) & (page[: len(run)] == page[LONG - 1 :]))
        gone[(at[:, None] + np.arange(LONG)).ravel()] = True
    at, texts = 0, []
    for t in tokens:
        keep = [w for w, g in zip(t, gone[at : at + len(t)], strict=True) if not g]
        texts.append(" ".join(keep or t))
        at += len(t)
    return pa.table({"page_id": group.column("page_id"), "url": group.column("url"), "text": pa.array(texts, pa.string())})


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard: int = SHARD) -> DataFrame:
    """(id, url, text, n_chars) for each row of pages."""
    ws = Workspace(spark, "html")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    parsed = ws.save(rows.mapInArrow(_parse, "page_id long, url string, host string, text string, parts array<string>"), "parsed")
    marked, other = parsed.where("parts IS NULL").select("page_id", "url", "text"), parsed.where("parts IS NOT NULL")
    hosts = other.groupBy("host").agg(F.ceil(F.count("*") / shard).alias("shards"))
    other = other.join(hosts, "host").withColumn("shard", F.pmod(F.xxhash64("page_id", "url"), F.col("shards")))
    runs = ws.save(other.where("shards > 1").groupBy("host", "shard").applyInArrow(_runs, "host string, shard long, run long, lo long, hi long"), "runs")
    shared = runs.groupBy("host", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("host", "run")
    known = runs.join(shared, ["host", "run"]).select("host", "shard", "run")
    cut = other.groupBy("host", "shard").cogroup(known.groupBy("host", "shard")).applyInArrow(_unshared, "page_id long, url string, text string")
    out = marked.unionByName(cut)
    return out.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
