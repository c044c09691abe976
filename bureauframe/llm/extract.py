"""Main text of web pages: roles of the markup, and a suffix array over each host's pages.

Elements whose tag, role or class names them as menus, adverts, forms and the like are left out. The token
streams of what is left of a host's pages, in articles and outside, are concatenated; the
intervals of equal prefixes in their suffix array are the long runs repeated on several distinct pages.
Where a page marks its article, the article is the text, without the blocks that repeated runs make a part of
the host's template: as articles are copied and quoted, only runs on half of the host's pages do. Of a
page that marks none, what is not boilerplate is the text: the covered tokens go. Pages of
equal blocks are one page, however many rows or addresses they have. A block that is covered by less
than half only shares phrases with others and stays whole; a long block is prose rather than a menu, and
goes only where its runs stand on half of the host's pages. Large hosts have a suffix array for each
chunk of pages; a run's pages are then added up over the chunks.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import durable, importable, scratch, stored
from bureauframe.llm.sieve import Compressed, hits, shared_keys
from bureauframe.llm.substring import _mix, id_filter

RUN = 6  #: tokens of the shortest repeated run
PAGES = 3  #: distinct pages that make a run boilerplate
COVERED = 0.5  #: share of a block that repeated runs cover at least, where any of it goes
LONG = 32  #: tokens from which a block is long
LONG_PAGES = 8  #: distinct pages a run of a long block or an article stands on at least, and half of the host's
CHUNK_PAGES = 512  #: pages of a host that share one suffix array; larger hosts have several
ROUNDS = 2  #: parts of the chunks that are shuffled one after the other
SLICE = 1024  #: pages whose runs are looked at together

# Fixed values of HTML: elements without content, elements that flow inside a line, and elements
# whose end tag may be missing.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
SELF_ENDING = frozenset("p li dt dd tr td th thead tbody tfoot option".split())

# What is never main text, by tag, by role, and by a word of class or id.
DROP_TAGS = frozenset(
    "head nav aside footer form button select textarea iframe noscript template dialog svg canvas "
    "object menu".split()
)
DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split()
)
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices popup modal newsletter subscribe signup sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer comment comments reply replies responses respond "
    "disqus share sharing social related widget pagination pager toolbar".split()
)
HEADER_WORDS = frozenset("header masthead".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?:/?[a-zA-Z][^<>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

_KEEP, _DROP, _MAIN, _DOUBTFUL = 0, 1, 2, 3
LOOSE, DOUBT, MARKED = 0, 1, 2  #: how a page marks a block


def _role(tag: str, attributes: str, in_main: bool) -> int:
    """What an element is. A word of class or id drops an element, but an outermost article only
    becomes doubtful by it."""
    if tag in DROP_TAGS or tag == "header" and not in_main:
        return _DROP
    article = tag in ("article", "main")
    role, named = _MAIN if article else _KEEP, False
    if attributes and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = next(filter(None, values), "")
            kind = name.lower()
            if kind in ("class", "id"):
                words = {w.lower() for w in _WORDS.findall(value)}
                words.update(re.split(r"[^a-z0-9]+", value.lower()))
                named |= bool(words & DROP_WORDS or words & HEADER_WORDS and not in_main)
            elif kind == "role":
                if value.lower() in DROP_ROLES:
                    return _DROP
                if value.lower() in ("main", "article"):
                    role = _MAIN
            elif kind == "itemprop":
                if value.lower() == "comment":
                    return _DROP
                if value.lower() == "articlebody":
                    role = _MAIN
            elif kind == "hidden" and value.lower() != "until-found":
                return _DROP
    if named:
        return _DOUBTFUL if article and not in_main else _DROP
    return role


def blocks(html: str) -> list[tuple[int, str]]:
    """Text blocks of a page in order: MARKED if a marked article holds it, DOUBT if one that its
    class calls something else does, else LOOSE; and the text with character references decoded and
    white space turned into single spaces."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    open_roles = [0, 0, 0, 0]
    block_level = LOOSE

    def close() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((block_level, text))

    for match in _TOKEN.finditer(html):
        tag = match.group(3)
        if tag is None:
            text = match.group(0)
            if not open_roles[_DROP] and (text[0] != "<" or text == "<"):
                block_level = MARKED if open_roles[_MAIN] else DOUBT if open_roles[_DOUBTFUL] else LOOSE
                parts.append(entities.unescape(text))
            continue
        tag = tag.lower()
        if tag not in INLINE:
            close()
        if match.group(2):
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None:
                for _, role in stack[at:]:
                    open_roles[role] -= 1
                del stack[at:]
            continue
        if tag in VOID:
            if tag == "br":
                parts.append(" ")
            continue
        if tag == "body" or tag not in INLINE and stack and stack[-1][0] in SELF_ENDING and (
            stack[-1][0] == tag or stack[-1][0] == "p"
        ):
            while stack and (tag == "body" and stack[-1][0] != "html" or stack[-1][0] in SELF_ENDING):
                open_roles[stack.pop()[1]] -= 1
                if tag != "body":
                    break
        role = _role(tag, match.group(4), open_roles[_MAIN] + open_roles[_DOUBTFUL] > 0)
        if match.group(4).endswith("/") and role == _KEEP:
            continue
        stack.append((tag, role))
        open_roles[role] += 1
    close()
    return out


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by doubling the length they are ranked by. A suffix whose
    rank no other has stays where it is."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    at, key, width = np.arange(n), rank[order], 1
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])[: len(at)]
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        at = at[~(new & np.append(new[1:], True)[: len(at)])]
        if not len(at):
            return order
        found = order[at]
        after = np.where(found + width < n, rank[np.minimum(found + width, n - 1)] + 1, 0)
        key = rank[found] * (n + 1) + after
        by = np.argsort(key)
        order[at], key = found[by], key[by]
        width *= 2


def common_prefixes(tokens: np.ndarray, order: np.ndarray, most: int | None = None) -> np.ndarray:
    """Tokens that each suffix shares with the one before it in the suffix array: up to `most` of them side by
    side, or all of them in one pass over the text (Kasai): the suffix that starts one token later shares at most one token less."""
    n = len(order)
    if most is not None:
        out, at = np.zeros(n, np.int64), np.arange(1, n)
        for k in range(most):
            at = at[np.maximum(order[at], order[at - 1]) + k < n]
            at = at[tokens[order[at] + k] == tokens[order[at - 1] + k]]
            out[at] += 1
        return out
    text, suffixes = tokens.tolist(), order.tolist()
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    out, same = [0] * n, 0
    for i, r in enumerate(rank.tolist()):
        if not r:
            same = 0
            continue
        j = suffixes[r - 1]
        most = n - max(i, j)
        while same < most and text[i + same] == text[j + same]:
            same += 1
        out[r] = same
        same -= same > 0
    return np.array(out, np.int64)


def _key(words: list[str]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(" ".join(words).encode())).view(np.int64))


def _laid(pages: list[list[list[str]]]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
    """The words of all pages, None after each block; the page of each, where the blocks end, and the
    blocks that ended before each word."""
    words = [t for page in pages for block in page for t in (*block, None)]
    lengths = np.array([len(block) + 1 for page in pages for block in page], np.int64)
    owner = np.repeat(np.repeat(np.arange(len(pages)), [len(page) for page in pages]), lengths)
    ends = np.cumsum(lengths) - 1
    marks = np.zeros(len(words) + 1, np.int64)
    marks[ends + 1] = 1
    return words, owner, ends, np.cumsum(marks)


def _short(pages: list[list[list[str]]], run: int) -> dict[tuple[str, ...], set[int]]:
    """The pages of each block of fewer than `run` tokens."""
    short: dict[tuple[str, ...], set[int]] = {}
    for i, page in enumerate(pages):
        for block in page:
            if len(block) < run:
                short.setdefault(tuple(block), set()).add(i)
    return short


def _runs(pages: list[list[list[str]]], run: int):
    """All runs of `run` tokens inside one block: their starts in the joined token streams in the order
    of the suffix array; the group of each start, which is the interval of suffixes whose common
    prefixes have `run` tokens at least; the distinct pages of each group, the streams' words
    (None after each block). Also the distinct pages of each shorter block."""
    words, owner, ends, marks = _laid(pages)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    tokens = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    tokens[ends] = -1 - np.arange(len(ends))  # a mark of its own ends each block, so no run goes on into the next one
    order = suffix_array(tokens)
    interval = np.cumsum(common_prefixes(tokens, order, run) < run)
    inside = order + run <= len(tokens)
    inside[inside] = marks[order[inside] + run] == marks[order[inside]]
    whole, interval = order[inside], interval[inside]
    group = np.cumsum(np.append(0, interval[1:] != interval[:-1]))[: len(whole)]
    pairs = np.unique(group * len(pages) + owner[whole])
    on = np.bincount(pairs // len(pages)) if len(pairs) else np.zeros(0, np.int64)
    return whole, group, on, words, _short(pages, run)


def _hashes(words: list[str | None]) -> np.ndarray:
    """A hash of each word, 0 for None."""
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words) if w is not None} | {None: 0}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _run_keys(hashes: np.ndarray, at: np.ndarray, run: int) -> np.ndarray:
    """Keys of the runs that start at the given words."""
    keys = np.zeros(len(at), np.uint64)
    for i in range(run):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + hashes[at + i]
    return _mix(keys).view(np.int64)


def _keys(whole: np.ndarray, group: np.ndarray, words: list, run: int) -> np.ndarray:
    first = np.append(True, group[1:] != group[:-1])[: len(whole)]
    return _run_keys(_hashes(words), whole[first], run)


def page_keys(pages: list[list[list[str]]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of `run` tokens and of all shorter blocks, and the page of each; a page's may repeat."""
    words, owner, _, marks = _laid(pages)
    at = np.flatnonzero(marks[run:] == marks[:-run])
    short = [(_key(block), i) for block, own in _short(pages, run).items() for i in own]
    keys = np.concatenate([_run_keys(_hashes(words), at, run), np.array([k for k, _ in short], np.int64)])
    return keys, np.concatenate([owner[at], np.array([i for _, i in short], np.int64)])


def on_host(hosts: list[str], keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The keys for the sieve, told apart by the host of their page."""
    return _mix(keys.view(np.uint64) ^ _hashes(hosts)[owner])


def covered(
    pages: list[list[list[str]]], run: int = RUN, least: int = PAGES, known: set[int] | None = None
) -> list[list[np.ndarray]]:
    """For each block of each page, which tokens lie in a run of at least `run` tokens, inside one
    block, that stands on at least `least` distinct pages. A shorter block counts as a whole. With
    `known`, the runs and short blocks of these keys count instead."""
    whole, group, on, words, short = _runs(pages, run)
    if known is None:
        common = on >= least
        brief = {block for block, own in short.items() if len(own) >= least}
    else:
        common = np.array([key in known for key in _keys(whole, group, words, run).tolist()], bool)
        brief = {block for block in short if _key(block) in known}
    return _by_block(pages, _marked(pages, run, whole[common[group]], len(words), brief))


def _marked(pages: list[list[list[str]]], run: int, starts: np.ndarray, size: int, brief: set) -> np.ndarray:
    """The words that runs from `starts` cover, or that make up a `brief` block."""
    edge = np.bincount(starts, minlength=size + 1) - np.bincount(starts + run, minlength=size + 1)
    hit = np.cumsum(edge)[:-1] > 0
    if brief:
        at = 0
        for page in pages:
            for block in page:
                if len(block) < run and tuple(block) in brief:
                    hit[at : at + len(block)] = True
                at += len(block) + 1
    return hit


def _by_block(pages: list[list[list[str]]], flat: np.ndarray) -> list[list[np.ndarray]]:
    out, at = [], 0
    for page in pages:
        out.append([])
        for block in page:
            out[-1].append(flat[at : at + len(block)])
            at += len(block) + 1
    return out


def boilerplate(
    pages: list[list[list[str]]],
    host_pages: int,
    known: dict[int, int] | None = None,
    run: int = RUN,
    marked: list[bool] | None = None,
) -> list[list[np.ndarray]]:
    """For each block of each of the distinct `pages`, which tokens are boilerplate of the host with
    `host_pages` of them. `known` has the pages of runs and short blocks over the whole host where
    `pages` are a part of it. Short blocks of `marked` pages go by the bound of long ones too."""
    whole, group, on, words, short = _runs(pages, run)
    if known is not None:
        keys, names = _keys(whole, group, words, run), np.array(sorted(known), np.int64)
        met = np.flatnonzero(np.isin(keys, names))
        on = np.zeros(len(keys), np.int64)
        on[met] = [known[key] for key in keys[met].tolist()]
    times = {b: len(own) if known is None else known.get(_key(b), 0) for b, own in short.items()}

    def least(bound: float) -> np.ndarray:
        brief = {block for block, n in times.items() if n >= bound}
        return _marked(pages, run, whole[(on >= bound)[group]], len(words), brief)

    sizes = np.array([len(block) for page in pages for block in page], np.int64)
    article = np.repeat(marked or [False] * len(pages), [len(page) for page in pages])
    hard = np.repeat((sizes >= LONG) | article, sizes + 1)
    lost = np.where(hard, least(max(LONG_PAGES, host_pages / 2)), least(PAGES))
    if len(sizes):
        share = np.add.reduceat(lost.astype(np.int64), np.cumsum(sizes + 1) - sizes - 1) / np.maximum(sizes, 1)
        lost &= np.repeat(share >= COVERED, sizes + 1)
    return _by_block(pages, lost)


def packed(found: list[tuple[int, str]]) -> bytes | None:
    """Blocks of a page as they are kept, None if there are none."""
    if not found:
        return None
    raw = "\n".join(f"{level}{text}" for level, text in found).encode()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes | None) -> list[tuple[int, str]]:
    if data is None:
        return []
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return [(int(block[0]), block[1:]) for block in raw.decode().split("\n")]


def _main(found: list[tuple[int, str]]) -> list[int]:
    """Which blocks are the text of a page, but for boilerplate."""
    best = max((level for level, _ in found), default=LOOSE)
    return [i for i, (level, _) in enumerate(found) if level == best]


PARSED = "uid long, page_id long, url string, host string, digest binary, lead boolean, packed binary"


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) of every row of `pages`.

    NULL or empty html, or a page of nothing but markup, has an empty text. Every row has its result,
    repeated rows and rows with repeated or NULL page_ids too; pages of equal blocks count
    as one distinct page of their host and have the same text.
    """
    spark = pages.sparkSession

    def parse(batches):
        for batch in batches:
            made, digest, lead, seen = [], [], [], set()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                made.append(packed(blocks(page or "")))
                digest.append(made[-1] and xxhash.xxh3_128_digest(made[-1]))
                lead.append(made[-1] is not None and (host, digest[-1]) not in seen)  # the first of its kind in the batch
                seen.add((host, digest[-1]))
            columns = [batch.column(c) for c in ("uid", "page_id", "url", "host")]
            columns += [pa.array(digest, pa.binary()), pa.array(lead, pa.bool_()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PARSED.split(", ")])

    def streams(group) -> list[list[list[str]]]:
        return [[t.split(" ") for _, t in unpacked(p)] for p in group.column("packed").to_pylist()]

    def sliced(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield batch.slice(at, SLICE)

    def keys_of(batch):
        found = []
        for i, part in enumerate(sliced([batch])):
            keys, owner = page_keys(streams(part))
            found.append((on_host(part.column("host").to_pylist(), keys, owner), owner + i * SLICE))
        if found:  # together: the more keys, the better they pack
            yield tuple(map(np.concatenate, zip(*found, strict=True)))

    def left(group: pa.Table, known: dict[int, int] | None = None) -> pa.Table:
        """The text of each page that loses any."""
        found = [unpacked(p) for p in group.column("packed").to_pylist()]
        pages = [[t.split(" ") for _, t in page] for page in found]
        host_pages = group.column("host_pages")[0].as_py() if len(group) else 0
        marked = [max(level for level, _ in page) > LOOSE for page in found]
        common = boilerplate(pages, host_pages or len(group), known, marked=marked)
        rows = []
        names = zip(*(group.column(c).to_pylist() for c in ("host", "digest")), strict=True)
        for name, page, words, lost in zip(names, found, pages, common, strict=True):
            kept = _main(page)
            if any(lost[i].any() for i in kept):
                rest = (" ".join(t for t, h in zip(words[i], lost[i], strict=True) if not h) for i in kept)
                rows.append((*name, " ".join(filter(None, rest))))
        kinds = {"host": pa.string(), "digest": pa.binary(), "rest": pa.string()}
        return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(kinds.items())})

    def alone(group: pa.Table) -> pa.Table:
        return left(group)

    def among(group: pa.Table, common: pa.Table) -> pa.Table:
        return left(group, dict(zip(*(common.column(c).to_pylist() for c in ("run", "on")), strict=True)))

    def write(batches):
        for batch in batches:
            texts = []
            for rest, data in zip(batch.column("rest").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if rest is None:
                    found = unpacked(data)
                    rest = " ".join(found[i][1] for i in _main(found))
                texts.append(rest)
            columns = [batch.column(c) for c in ("page_id", "url")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], ["page_id", "url", "text"])

    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    slim = importable(pages).select(
        F.monotonically_increasing_id().alias("uid"), "page_id", "url", F.coalesce(host, F.lit("")).alias("host"), "html"
    )
    at, changed = scratch(spark, "parsed"), scratch(spark, "changed")
    stored(slim.mapInArrow(parse, PARSED), at)
    parsed = spark.read.schema(PARSED).parquet(at)
    # Of pages of equal blocks one goes on; only their names are shuffled for that.
    rows = parsed.filter("lead").select("uid", "host", "digest", "packed")
    firsts = rows.groupBy("host", "digest").agg(F.min("uid").alias("uid"))
    sizes = firsts.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    sizes = durable(sizes.filter(F.col("host_pages") > CHUNK_PAGES))
    copies = durable(rows.select("host", "digest", "uid").join(firsts.withColumnRenamed("uid", "first"), ["host", "digest"])
                     .filter("uid > first").select(F.col("uid").alias("id")))
    rows = id_filter(rows, "uid", copies, "maybe")
    doubtful = rows.filter("maybe").join(copies.withColumnRenamed("id", "uid"), "uid", "left_anti")
    rows = rows.filter(~F.col("maybe")).unionByName(doubtful.select(rows.columns)).drop("maybe", "uid")
    # Hosts with very many pages are cut into chunks, the unit of work. There is counted on
    # how many pages a run stands, if two pages of the host have it by the sieve, and each chunk gets
    # which of its runs are common on the host. Large hosts are few beside their pages.
    rows = rows.join(F.broadcast(sizes), "host", "left")
    chunk = F.pmod(F.xxhash64("digest"), F.ceil(F.col("host_pages") / CHUNK_PAGES))
    rows = rows.withColumn("chunk", F.when(F.col("host_pages").isNotNull(), chunk))
    output = "host string, digest binary, rest string"
    stored(rows.filter("chunk IS NULL").groupBy("host").applyInArrow(alone, output), changed)
    if not sizes.isEmpty():
        large = rows.filter("chunk IS NOT NULL")
        n_bytes = large.agg(F.sum(F.length("packed").cast("long"))).first()[0]
        found = shared_keys(large.select("host", "packed"), keys_of, max(1, n_bytes // 3))
        shared = spark.sparkContext.broadcast(Compressed(found))

        def count(batches):
            for batch in sliced(batches):
                hosts, chunks = (batch.column(c).to_pylist() for c in ("host", "chunk"))
                keys, owner = page_keys(streams(batch))
                kept = hits(shared.value, on_host(hosts, keys, owner))
                keys, owner = np.unique(np.stack([keys[kept], owner[kept]]), axis=1)
                names = [*dict.fromkeys(zip(hosts, chunks, strict=True))]
                number = {name: i for i, name in enumerate(names)}
                part = np.array([number[name] for name in zip(hosts, chunks, strict=True)], np.int64)[owner]
                (part, keys), n = np.unique(np.stack([part, keys]), axis=1, return_counts=True)
                found = [names[p] for p in part.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in found], pa.string()), pa.array([c for _, c in found], pa.int64()),
                     pa.array(keys), pa.array(n.astype(np.int64))],
                    ["host", "chunk", "run", "pages"],
                )

        kinds = "host string, chunk long, run long, pages long"
        counts, path = large.select("host", "chunk", "packed").mapInArrow(count, kinds), scratch(spark, "runs")
        stored(counts.groupBy("host", "chunk", "run").agg(F.sum("pages").alias("pages")), path)
        counts = spark.read.schema(kinds).parquet(path)
        common = counts.groupBy("host", "run").agg(F.sum("pages").alias("on")).filter(F.col("on") >= PAGES)
        known = counts.join(common, ["host", "run"]).select("host", "chunk", "run", "on")
        for i in range(ROUNDS):
            own, common = (x.filter(F.pmod("chunk", F.lit(ROUNDS)) == i).groupBy("host", "chunk") for x in (large, known))
            stored(own.cogroup(common).applyInArrow(among, output), changed)
    lost = spark.read.schema(output).parquet(changed).withColumn("id", F.xxhash64("host", "digest"))
    # Only pages that may have lost something are shuffled.
    done = parsed.select("page_id", "url", "host", "digest", "packed", F.xxhash64("host", "digest").alias("id"))
    done = id_filter(done, "id", lost.select("id"), "maybe")
    touched = done.filter("maybe").join(lost.drop("id"), ["host", "digest"], "left")
    same = done.filter(~F.col("maybe")).withColumn("rest", F.lit(None).cast("string"))
    both = same.select("page_id", "url", "rest", "packed").unionByName(touched.select("page_id", "url", "rest", "packed"))
    both = both.mapInArrow(write, "page_id long, url string, text string")
    return both.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
