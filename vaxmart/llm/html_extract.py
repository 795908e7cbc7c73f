"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

Every page becomes a token stream whose neighbouring repetitions are folded (``html_wrapper``).  The distinct streams
of a host, with the sums of what their text slots hold (pages, characters, characters inside links, least and greatest
hash of the texts), are aligned one after the other into the host's wrapper.  No task sees more than about FAN streams:
hosts with more are wrapped in rounds, partial wrappers being aligned as streams are.  A slot's label is the wrapper's:

* elements of menus, footers, sidebars, notices, adverts, forms and comments, by tag (ASIDE_TAGS) or by a word of class,
  id or role (ASIDE_WORDS), are no main text; ``header`` and its words only outside the article.  Words do not count on
  an element that holds the article, and forms and words not on one that holds over MAJOR of the host's text;
* the article is what lies in ``article`` elements, else in ``main`` (element or role);
* hosts without either: slots that hold the same text on MIN_PAGES pages or more and on half as many as the most common
  slot, while other slots differ, are the host's template, and slots of links are menus; the rest is main text.  A page without text in its host's article
  keeps what is neither.

Each distinct stream is aligned with its host's wrapper once more, which tells the label of its slots, and pages meet
the labels by host and stream: as a broadcast while there are at most BROADCAST_STREAMS of them with BROADCAST_SLOTS slots
(4 bytes each), else by a shuffle, with
the streams of over one in HOT_SHARE of all pages (hence fewer than that) joined apart.  A page's html is read once.

Cases: a null or empty html, or one without text, gives ''.  Character references are decoded; white space (Unicode's,
so no-break spaces too) inside a block becomes one blank, and ``br`` counts as white space; unclosed tags end where HTML
ends them; a page cut off in a tag loses that tag only.  A null url, or one without ``://``, has the empty host.  Rows
that repeat, and null ids, are pages of their own.  Text that is no HTML is one block.  Extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaxmart.llm import html_wrapper as hw
from vaxmart.llm.common import cut, prepare, whole

FAN = 200  # streams or partial wrappers aligned in one task
MIN_PAGES, MAJOR = 5, 0.7
BROADCAST_STREAMS, BROADCAST_SLOTS, HOT_SHARE = 100_000, 4_000_000, 1024
# Fixed lists: elements beside the main text, and words of class, id and role that name them.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar widget widgets ad ads adv advert adverts advertisement "
    "advertisements advertising adsense sponsor sponsored sponsors promo promotion promoted banner cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments commentlist disqus respond reply replies pagination pager toolbar skip copyright "
    "complementary contentinfo search".split())
HEADER_WORDS = frozenset("header masthead".split())


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.expr("substring(url, instr(url, '://') + 3)"), "/", 1)).otherwise("")
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


_STREAMS = ("page_id long, url string, host string, stream string, skeleton string, blocks array<struct<slot:int, text:string>>, "
            "facts array<struct<chars:long, linked:long, seen:long>>")


def streams(pages: DataFrame) -> DataFrame:
    """One row per page: its stream (an id by content, and the skeleton), blocks of text and facts by slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))
        fact = pa.list_(pa.struct([("chars", pa.int64()), ("linked", pa.int64()), ("seen", pa.int64())]))
        for batch in batches:
            ids, skeletons, blocks, facts = [], [], [], []
            for source in batch.column(3).to_pylist():
                page = hw.Page(source)
                skeletons.append(page.skeleton())
                ids.append(xxhash.xxh3_128_hexdigest(skeletons[-1]))
                blocks.append([(slot.root().at, text) for slot, text in page.blocks])
                facts.append(page.facts())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.string()), pa.array(skeletons, pa.string()), pa.array(blocks, block), pa.array(facts, fact)],
                names=["page_id", "url", "host", "stream", "skeleton", "blocks", "facts"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), whole(F.col("html")).alias("html"))
    return rows.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").mapInArrow(run, _STREAMS)


def distinct_streams(found: DataFrame) -> DataFrame:
    """(host, stream, skeleton, n, facts by slot) over the pages; sums are made before rows move."""
    slots = (found.select("host", "stream", F.posexplode("facts").alias("at", "f"))
             .groupBy("host", "stream", "at").agg(F.count(F.lit(1)).alias("n"), F.sum("f.chars").alias("chars"), F.sum("f.linked").alias("linked"),
                                                  F.min("f.seen").alias("low"), F.max("f.seen").alias("high")))
    slots = slots.groupBy("host", "stream").agg(F.sort_array(F.collect_list(F.struct("at", "n", "chars", "linked", "low", "high"))).alias("facts"))
    kinds = found.groupBy("host", "stream").agg(F.min("skeleton").alias("skeleton"), F.count(F.lit(1)).alias("pages"))
    return kinds.join(slots, ["host", "stream"], "left")


def _tree(skeleton: str, facts) -> list:
    items = hw.load(json.loads(skeleton))
    for slot, f in zip(hw.slots(items), facts or []):
        slot.n, slot.chars, slot.linked, slot.low, slot.high = f["n"], f["chars"], f["linked"], f["low"], f["high"]
    return items


def wrap(trees: list[str]) -> str:
    """Aligns dumped trees, one after the other in a fixed order, into one."""
    result: list = []
    for i, tree in enumerate(sorted(trees, key=lambda t: (-len(t), t))):
        items = hw.load(json.loads(tree))
        result = items if i == 0 else hw.align(result, items)
    return json.dumps(hw.dump(result, stats=True), separators=(",", ":"))


def host_wrappers(kinds: DataFrame) -> DataFrame:
    """(host, wrapper): rounds that align FAN trees of a host at a time, until one is left."""
    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [json.dumps(hw.dump(_tree(s, f), stats=True), separators=(",", ":"))
                     for s, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees, pa.string())], ["host", "wrapper"])

    def run(group: pa.Table) -> pa.Table:
        return pa.table({"host": [group["host"][0].as_py()], "wrapper": [wrap(group["wrapper"].to_pylist())]})

    rows = kinds.select("host", "skeleton", "facts").mapInArrow(start, "host string, wrapper string")
    while True:
        rows = cut(rows, "wrappers")
        sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("size"))
        if (sizes.agg(F.max("size").alias("n")).first()["n"] or 0) <= 1:
            return rows
        part = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("size") / FAN))
        rows = (rows.join(sizes, "host").select("host", "wrapper", part.alias("part"))
                .groupBy("host", "part").applyInArrow(run, "host string, wrapper string"))


def _words(key: str) -> set[str]:
    return set(key.split(".")[1:])


def label(items: list) -> set[int]:
    """Ids of the slots of a wrapper that are main text, and the fallback of pages without text in the article."""
    def visit(x, path):
        if isinstance(x, hw.Slot):
            every.append((x, path))
            return
        for y in x.items:
            visit(y, [*path, x])

    every: list[tuple[hw.Slot, list]] = []
    for x in items:
        visit(x, [])
    total = sum(s.chars for s, _ in every)
    chars: dict[int, int] = {}
    for s, path in every:
        for e in path:
            chars[id(e)] = chars.get(id(e), 0) + s.chars

    def is_main(e, name: str) -> bool:
        named = hw.tag(e.key) == name or name == "main" and "main" in _words(e.key) and hw.tag(e.key) in ("div", "section")
        return named and not _words(e.key) & ASIDE_WORDS

    def region(name: str) -> list[int]:
        """Elements of that kind outside menus and the like, in order."""
        out: list[int] = []
        for s, path in every:
            for i, e in enumerate(path):
                if is_main(e, name) and s.chars and not any(hw.tag(x.key) in ("nav", "footer", "aside") for x in path[:i]):
                    out.append(id(e))
        return list(dict.fromkeys(out))

    mains = region("article") or region("main")
    first = mains[0] if mains else None
    holders = {id(e) for _, path in every for i, e in enumerate(path) if first in map(id, path[i + 1:])}

    def beside(path) -> bool:
        inside = False
        for e in path:
            name, words = hw.tag(e.key), _words(e.key)
            major = not mains and chars.get(id(e), 0) > MAJOR * total
            if name in ("nav", "footer", "aside", "menu", "dialog"):
                return True
            free = id(e) == first or id(e) in holders or major or name in ("html", "body")
            if not free and (name in ASIDE_TAGS or words & ASIDE_WORDS):
                return True
            if not inside and not free and (name == "header" or words & HEADER_WORDS):
                return True
            inside = inside or id(e) in mains
        return False

    varied = any(s.low != s.high for s, _ in every)
    left = [(s, path) for s, path in every if not beside(path)]
    often = max([MIN_PAGES, *(s.n // 2 for s, _ in every)])
    rest = {id(s) for s, _ in left if not (varied and s.n >= often and s.low == s.high) and s.kind != "@"}
    article = {id(s) for s, path in left if any(id(e) in mains for e in path)}
    for s, _ in every:
        s.at = 2 if id(s) in article else 1 if id(s) in rest else 0
    return article or rest


def labels(kinds: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, stream, labels by slot: 2 article, 1 what is left where there is no article, 0 beside the main text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for skeleton, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                items, page = hw.load(json.loads(wrapper)), hw.load(json.loads(skeleton))
                mine = hw.slots(page)
                label(hw.align(items, page))  # the page adds no facts; a slot that found no partner is judged by its place
                out.append([slot.root().at for slot in mine])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["host", "stream", "labels"])

    joined = kinds.select("host", "stream", "skeleton").join(wrappers, "host")
    return joined.mapInArrow(run, "host string, stream string, labels array<int>")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, n_streams, wrapper): the regular expression of each host."""
    prepare(pages.sparkSession)
    kinds = cut(distinct_streams(cut(streams(pages), "streams")), "kinds")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [hw.pattern(hw.load(json.loads(t))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["host", "n_streams", "wrapper"])

    sizes = kinds.groupBy("host").agg(F.count(F.lit(1)).alias("n_streams"))
    return sizes.join(host_wrappers(kinds), "host").mapInArrow(run, "host string, n_streams long, wrapper string")


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    prepare(pages.sparkSession)
    found = cut(streams(pages), "streams")
    kinds = cut(distinct_streams(found), "kinds")
    marked = cut(labels(kinds, host_wrappers(kinds)).join(kinds.select("host", "stream", "pages"), ["host", "stream"]), "labels")
    size = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("pages").alias("pages"), F.coalesce(F.sum(F.size("labels")), F.lit(0)).alias("slots")).first()
    rows = found.select("page_id", "url", "host", "stream", "blocks")
    keys = ["host", "stream"]
    if size["n"] <= BROADCAST_STREAMS and size["slots"] <= BROADCAST_SLOTS:
        joined = rows.join(F.broadcast(marked), keys, "left")
    else:
        hot = F.col("pages") > F.lit(size["pages"] // HOT_SHARE)
        frequent = F.broadcast(marked.where(hot))  # fewer than HOT_SHARE rows
        joined = rows.join(frequent, keys).unionByName(
            rows.join(frequent.select(*keys), keys, "left_anti").join(marked.where(~hot), keys, "left"), allowMissingColumns=True)
    def of(mark: int) -> Column:
        return F.transform(F.filter("blocks", lambda b: F.get("labels", b["slot"]) >= mark), lambda b: b["text"])

    text = F.array_join(F.when(F.size(of(2)) > 0, of(2)).otherwise(of(1)), "\n")
    return joined.select("page_id", "url", F.coalesce(text, F.lit("")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
