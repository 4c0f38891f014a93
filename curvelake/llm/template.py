"""Main text of pages by equivalence-class template deduction.

A token is a start tag, an end tag or a whole run of text, together with the path of open elements around it (``markup``).
Its occurrence vector says how often it stands on each page of its host. Tokens of a host with equal vectors form a class; a
vector is held as sums of hashed (page, number) pairs, so that a host of any size is an aggregation. Large classes (two tokens
or more, on five pages and a tenth of the host's at least) are checked on every page: a class is ordered if its tokens come
in the same order, over and over as often as they occur, and nested if every round lies in the same gap between two
neighbouring tokens of the root, the class of what stands once on each page. The valid classes are the host's template: the root, and
in its gaps the elements that some pages have. Text that is the template's own (a token of the root, or inside an element whose
whole content is one class) is no slot. What remains are the slots; those in the article (or main element, or the whole
page if it has neither) and outside menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments are the text.

A block is dropped only if all its text is the template's; a block with words of its own stays whole. Hosts with fewer than
five different main texts have no template, so copies of one page don't count as one; their pages go by their elements alone.

Null and empty html, and pages without main text, give empty text. A page without a url, or with one that names no host,
belongs to no host. Every row gives one row, repeated rows too. Very long pages are read in one linear pass, one at a time. Other
columns are ignored. An empty table gives no rows.

Memory and network: hashes of the tokens cross the network once, added up per task. A host's template holds no more than ten
times the tokens of its average page. Templates are broadcast up to 8 MB; beyond, pages meet them in a join in which hosts of very many pages
are dealt in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm import markup
from curvelake.llm.common import map_slices, slices, written

#: A class stands on so many pages at least, and on this share of its host's.
PAGES, SHARE = 5, 0.1
#: Templates of this many tokens in all are broadcast (8 bytes each).
BROADCAST = 1 << 20
#: A host of more pages is dealt in parts; at most ten thousand hosts can be that large.
LARGE, LARGEST = 512, 10_000


def host_of(url) -> F.Column:
    """The lower-case host of an absolute url, without user and port; empty if there is none."""
    place = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#\s\\]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":\d*$", ""))


def _streams(piece: pa.RecordBatch) -> dict:
    out: dict[str, list] = {"host": [], "page": [], "main": [], "tokens": []}
    for host, page, text in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True):
        read = markup.read(text)
        top = max((b.main for b in read.blocks), default=0)
        main = [t for b in read.blocks if b.main == top for t in b.tokens]
        out["host"].append(host)
        out["page"].append(page)
        out["main"].append(markup.signed(np.array(main, np.int64).tobytes()))
        out["tokens"].append(read.tokens)
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrence vectors as sums over the pages of a piece."""
    for piece in slices(batches, 4096, 16 << 20):
        lists = piece.column(2)
        sizes = np.diff(lists.offsets.to_numpy())
        flat, of_page = lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
        if not len(flat):
            continue
        hosts = piece.column(0).dictionary_encode()
        names, of_host = hosts.dictionary, hosts.indices.to_numpy()
        order = np.lexsort((flat, of_page))
        flat, of_page = flat[order], of_page[order]
        starts = np.flatnonzero(np.r_[True, (flat[1:] != flat[:-1]) | (of_page[1:] != of_page[:-1])])
        count = np.diff(np.r_[starts, len(flat)])
        token, page = flat[starts], of_page[starts]
        # splitmix64 of page and number
        with np.errstate(over="ignore"):
            mixed = piece.column(1).to_numpy().astype(np.uint64)[page] + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(31)
        host = of_host[page]
        order = np.lexsort((token, host))
        host, token, count, mixed = host[order], token[order], count[order], mixed[order]
        starts = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (host[1:] != host[:-1])])
        add = [np.add.reduceat(x.astype(np.int64), starts) for x in (mixed >> np.uint64(32), mixed & np.uint64(0xFFFFFFFF), np.ones(len(token)), count)]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(host[starts])), pa.array(token[starts]), *map(pa.array, add)], names=["host", "token", "high", "low", "pages", "total"])


def classes(streams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The hosts (``host, all_pages, mains``), and their classes (``host, class, root, tokens``) before any check."""
    hosts = written(streams.filter("host <> ''").groupBy("host", "main").agg(F.count("*").alias("n")).groupBy("host").agg(
        F.sum("n").alias("all_pages"), F.count("*").alias("mains")))
    vectors = streams.filter("host <> ''").select("host", "page", "tokens").mapInArrow(_vectors, "host string, token bigint, high bigint, low bigint, pages bigint, total bigint")
    vectors = vectors.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("high", "low", "pages", "total")]).filter(F.col("pages") >= PAGES)
    large = vectors.join(hosts, "host").filter((F.col("mains") >= PAGES) & (F.col("pages") >= SHARE * F.col("all_pages")))
    found = large.groupBy("host", "high", "low", "pages", "total").agg(F.collect_list("token").alias("tokens"), F.first("all_pages").alias("all_pages")).filter(F.size("tokens") > 1)
    return hosts, found.select("host", F.xxhash64("high", "low", "pages", "total").alias("class"),
                               ((F.col("pages") == F.col("all_pages")) & (F.col("total") == F.col("pages"))).alias("root"), "tokens")


def beside(rows: DataFrame, key: str, templates: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with the columns of their host's template, null where it has none. ``key`` tells rows of a host apart."""
    size = templates.agg(F.sum("size").alias("size")).first()["size"] or 0
    if size <= BROADCAST:
        return rows.join(F.broadcast(templates.drop("size")), "host", "left")
    many = max(LARGE, (hosts.agg(F.sum("all_pages").alias("n")).first()["n"] or 0) // LARGEST)
    parts = hosts.filter(F.col("all_pages") > many).select("host", F.ceil(F.col("all_pages") / many).cast("bigint").alias("parts"))
    one = F.lit(1).cast("bigint")
    rows = rows.join(F.broadcast(parts), "host", "left").withColumn("part", F.pmod(F.xxhash64(key), F.coalesce("parts", one))).drop("parts")
    dealt = templates.drop("size").join(F.broadcast(parts), "host", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", one) - 1))).drop("parts")
    return rows.join(dealt, ["host", "part"], "left").drop("part")


def rounds(tokens: list[int], members: set[int], root: set[int]) -> tuple[list[int] | None, int | None]:
    """One round of a class's tokens and the root's gap it lies in; null where a page has more than one such order or gap."""
    own, gaps, gap = [], [], 0
    for token in tokens:
        if token in members:
            own.append(token)
            gaps.append(gap)
        elif token in root:
            gap += 1
    size = len(members)
    cycle = own[:size]
    if len(own) % size or own != cycle * (len(own) // size):
        return None, None
    return cycle, gaps[0] if len(set(gaps)) == 1 else None


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class, the least and largest round and gap over the pages of a piece; null where a page contradicts."""
    for piece in slices(batches, 1024, 16 << 20):
        found: dict[tuple[str, int], set] = {}
        shapes: dict[tuple[str, int], list[int]] = {}
        for host, tokens, template in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True):
            root = {t for c in template if c["root"] for t in c["tokens"]}
            for c in template:
                members = set(c["tokens"])
                if members.isdisjoint(tokens):
                    continue
                cycle, gap = rounds(tokens, members, set() if c["root"] else root)
                name = host, c["class"]
                seen = found.setdefault(name, set())
                seen.add(None if cycle is None or gap is None else (markup.signed(np.array(cycle, np.int64).tobytes()), gap))
                if cycle:
                    shapes[name] = cycle
        if found:
            rows = [(h, c, None not in seen and len(seen) == 1, *(next(iter(seen)) or (0, 0)), shapes.get((h, c), [])) for (h, c), seen in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (
                pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["host", "class", "fits", "cycle", "gap", "tokens"])


def own_text(cycle: list[int], root: bool) -> list[int]:
    """The text tokens that a valid class makes the template's: all of the root's, and those of an element that is one class."""
    if root or markup.end_of(cycle[0]) == cycle[-1]:
        return [t for t in cycle if t & 3 == markup.TEXT]
    return []


def deduced(streams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The hosts, and for each host with a template its text tokens (``host, template, size``)."""
    hosts, found = classes(streams)
    found = written(found)
    by_host = found.groupBy("host").agg(F.collect_list(F.struct("class", "root", "tokens")).alias("classes"), F.sum(F.size("tokens")).alias("size"))
    on_pages = beside(streams.filter("host <> ''").select("host", "page", "tokens"), "page", written(by_host), hosts).filter("classes is not null")
    checked = on_pages.select("host", "tokens", "classes").mapInArrow(_checks, "host string, class bigint, fits boolean, cycle bigint, gap bigint, tokens array<bigint>")
    valid = checked.groupBy("host", "class").agg(
        (F.min("fits") & (F.min("cycle") == F.max("cycle")) & (F.min("gap") == F.max("gap"))).alias("valid"), F.first("tokens").alias("cycle")).filter("valid")
    named = valid.join(found.select("host", "class", "root"), ["host", "class"]).select("host", "cycle", "root")
    texts = map_slices(named, lambda p: {"host": p.column(0), "texts": [own_text(c, r) for c, r in zip(p.column(1).to_pylist(), p.column(2).to_pylist(), strict=True)]},
                       "host string, texts array<bigint>")
    return hosts, texts.filter(F.size("texts") > 0).groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("template")).withColumn("size", F.size("template"))


def _texts(piece: pa.RecordBatch) -> dict:
    made, sets = [], {}
    for host, text, template in zip(*(piece.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
        if host not in sets:
            sets[host] = frozenset(template or ())
        made.append("\n\n".join(markup.read(text).kept(sets[host])))
    return {"page_id": piece.column(0), "url": piece.column(1), "text": made, "n_chars": [len(t) for t in made]}


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: blocks of the main text, two line ends between them, of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    streams = written(map_slices(rows.select("host", F.xxhash64("page_id", "url", "html"), "html"), _streams,
                                 "host string, page bigint, main bigint, tokens array<bigint>"))
    hosts, templates = deduced(streams)
    given = beside(rows, "html", written(templates), hosts).select("page_id", "url", "host", "html", "template")
    return map_slices(given, _texts, "page_id bigint, url string, text string, n_chars bigint")
