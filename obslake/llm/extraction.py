"""Main text of web pages: page structure, and substrings that repeat within a host.

A page is cut into blocks at block-level tags. Each block has a zone: article (inside an
article or a main element or one named so), chrome (menus, headers, footers, sidebars,
notices, adverts, forms, comments, by tag or by the words of class, id and role), or
neither. Words in names of html, body, main and article make no chrome, and what a form or
an element with such a name holds is the text if the page has no other: its articles, or
else its paragraphs.

The blocks of every page are judged by its host's suffix array. The token streams of all
pages are concatenated by host and their suffixes brought into the order of their first
DEPTH tokens: suffixes that agree that far stand side by side, and those of different
pages mark a repeated substring. The order is kept to that depth and by 48 bits of hash,
since only agreement matters, so the suffixes of one large host spread over all tasks:
chunks of pages send their distinct prefixes to ranges of hashes, shortened first and whole
where another chunk may have them, and get back those that several pages have with the
number of these pages. A block that is mostly covered by
repeated substrings is boilerplate, the others are kept.

Near copies of a page on a host, found by SKETCH least hashes of their paragraphs, count as
one page, so they do not remove each other's text. Short blocks are boilerplate if their
substrings are on some pages of the host, in the same kind of zone, and paragraphs only if
they are on half of its pages.

Page structure is a check after it. If a page has an article zone, blocks outside of its
innermost kind are dropped, and inside it repeated paragraphs come back, as do short blocks
that less than half of the host's pages have: pages do share passages. Without one, blocks
in chrome are dropped; if none is left, paragraphs of some length are the text.

A null or empty page has an empty text. Pages with a null url have no host and share
one. Pages of the same stream count once, so copies of a page do not remove each other.
Repeated rows are extracted alike. Extra columns are ignored. An empty table gives an
empty result. Cut-off pages end where they end.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.chunks import (
    Numbers,
    bucketed,
    packed,
    squeeze,
    squeezed,
    unpacked,
    unsqueeze,
    word_list,
)
from obslake.llm.common import SLICE, as_bytes, map_batches, map_groups

#: Tokens of a substring that is long enough to be boilerplate, and the covered share of a block.
DEPTH, COVERED = 6, 0.6
#: Words of a paragraph that is text when nothing else is.
PARAGRAPH = 15
#: Bits of a prefix's hash, and of a shortened one beyond those that number all tokens.
HASH_BITS, SPARE = 48, 4
#: Tokens of a chunk of pages, before the page that exceeds them, and of a range of hashes.
CHUNK_TOKENS, RANGE_TOKENS = 500_000, 2_000_000
#: Pages, and share of a host's pages, that have what is usual there.
USUAL_PAGES, USUAL_SHARE = 3, 0.5
#: Pages, or if these are fewer the share of a host's pages, that have what some do; 2 at least.
SOME_PAGES, SOME_SHARE = 20, 0.1
#: Least hashes of a page, and how many of them near copies share.
SKETCH, ALIKE = 8, 5

CHROME, OTHER, MAIN, ARTICLE = 0, 1, 2, 3
#: In a form or an element named like chrome: anything, and articles. Settled for the whole page.
SOFT, HELD = -1, -2

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none")
_WORD = re.compile(r"[a-z]+")

# Elements of HTML by what they do to text.
_RAW = frozenset("script style textarea title noscript template svg math iframe object".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol optgroup option p pre search section select summary table tbody tfoot thead tr"
    " ul".split()
)
_SPACES = frozenset("br td th button label input img".split())
_CHROME_TAGS = frozenset(
    "nav footer aside menu dialog button select head search fieldset".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
# Words in names of elements that are not the text, and of those that hold it.
_CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead topbar"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter"
    " subscribe subscription signup login search share sharing social related recommended"
    " recommendations comment comments disqus respond reply replies widget toolbar pagination pager"
    " copyright legal skip".split()
)
_OUTER_WORDS = frozenset("header complementary contentinfo".split())
_MAIN_WORDS = frozenset("main content article articlebody post entry story".split())


def _zone(tag: str, attributes: str, around: int) -> int:
    if around == CHROME or tag in _CHROME_TAGS:
        return CHROME
    words: set[str] = set()
    lowered = attributes.lower()
    root, article = tag in ("html", "body"), tag in ("main", "article")
    if "=" in lowered and not root:
        for names in _NAMES.findall(lowered):
            words.update(_WORD.findall("".join(names)))
    if lowered and not root and _HIDDEN.search(lowered):
        return CHROME
    inside = around >= MAIN or around == HELD
    named_main = bool(words & _MAIN_WORDS)
    if tag == "form" or words & _CHROME_WORDS:
        if not article:
            return CHROME if inside else SOFT
        if around in (ARTICLE, HELD):
            return CHROME
        if tag == "article" and not named_main:
            return HELD  # perhaps a comment
    if not inside and not article and (tag == "header" or words & _OUTER_WORDS):
        return CHROME
    if around == SOFT:
        return HELD if article or named_main else SOFT
    if around == HELD:
        return HELD
    if tag == "article":
        return ARTICLE
    return max(around, MAIN) if tag == "main" or named_main else around


def _settled(blocks: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Blocks with the zones of a page: held articles are the text if there is no other."""
    zones = {zone for zone, _ in blocks}
    if not zones & {SOFT, HELD}:
        return blocks
    free = ARTICLE not in zones and not any(
        zone in (OTHER, MAIN) and len(text.split()) >= PARAGRAPH for zone, text in blocks
    )
    became = {HELD: ARTICLE if free else CHROME}
    became[SOFT] = SOFT if free and not zones & {HELD, MAIN} else CHROME
    return [(became.get(zone, zone), text) for zone, text in blocks]


def page_blocks(html: str) -> list[tuple[int, str]]:
    """Zone and text of each block of a page, in page order."""
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    zone, pieces, at = OTHER, [], 0
    skip_to: str | None = None

    def close() -> None:
        if pieces:
            text = "".join(pieces)
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            if text:
                blocks.append((zone, text))
            pieces.clear()

    for match in _TAG.finditer(html):
        start = match.start()
        if start < at:
            continue
        if skip_to is None and start > at:
            pieces.append(html[at:start])
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        name = name.lower()
        closing = bool(match.group(1))
        if skip_to is not None:
            if closing and name == skip_to:
                skip_to = None
            continue
        if not closing and name in _RAW:
            # Markup inside is text of the element, so its end is looked for by name alone.
            if name in ("script", "style", "textarea", "title"):
                end = re.compile(f"</{name}", re.IGNORECASE).search(html, at)
                at = len(html) if end is None else end.start()
                pieces.append(" ")
            elif not match.group(3).endswith("/"):
                skip_to = name
            continue
        if name in _BLOCKS:
            close()
        elif name in _SPACES:
            pieces.append(" ")
        if name in _VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if stack[i][1] != zone or (i and stack[i - 1][1] != zone):
                        close()
                    del stack[i:]
                    zone = stack[-1][1] if stack else OTHER
                    break
            continue
        if name in _BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()
            zone = stack[-1][1] if stack else OTHER
        elif stack and stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            stack.pop()
            zone = stack[-1][1] if stack else OTHER
        inner = _zone(name, match.group(3), zone)
        if name in _INLINE and inner == zone:
            continue
        if inner != zone:
            close()
            zone = inner
        stack.append((name, zone))
    if skip_to is None and at < len(html):
        rest = html[at:]
        cut = rest.rfind("<")
        if cut >= 0 and re.match(r"</?[a-zA-Z!?]", rest[cut:]):
            rest = rest[:cut]  # a tag that is cut off
        pieces.append(rest)
    close()
    return _settled(blocks)


def _host(url: str) -> str:
    rest = url.split("//", 1)[-1]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def _whole_host(host: str) -> np.uint64:
    """What stands for all pages of a host among the prefixes."""
    return np.uint64(xxhash.xxh3_64_intdigest(host.encode(), seed=1) >> (64 - HASH_BITS))


@dataclass
class Chunk:
    """Pages one after the other, as numbers of words."""

    #: page_id, url and host of each page.
    pages: list[list]
    #: Blocks of each page, zone and words of each block, and all words by their place in ``words``.
    blocks: np.ndarray
    zones: np.ndarray
    sizes: np.ndarray
    numbers: np.ndarray
    words: list[bytes]

    @staticmethod
    def of(pages: list[list], blocks: list[int], zones: list[int], sizes: list[int], numbers, words):
        whole = (np.array(x, np.int64) for x in (blocks, zones, sizes))
        return Chunk(pages, *whole, np.concatenate([np.zeros(0, np.int32), *numbers]), list(words))

    @staticmethod
    def read(pages: bytes, shape: bytes, numbers: bytes, words: bytes) -> Chunk:
        about = json.loads(unsqueeze(pages))
        flat = np.frombuffer(unsqueeze(shape), "<i4").astype(np.int64)
        blocks, rest = flat[: len(about)], flat[len(about) :].reshape(2, -1)
        planes = np.frombuffer(unsqueeze(numbers), np.uint8).reshape(4, -1).T
        places = np.ascontiguousarray(planes).view("<i4").ravel()
        return Chunk(about, blocks, *rest, places, word_list(words))

    def stored(self) -> list[bytes]:
        """What ``read`` takes."""
        shape = np.concatenate([self.blocks, self.zones, self.sizes]).astype("<i4")
        planes = self.numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T
        about = json.dumps(self.pages, ensure_ascii=False).encode()
        raw = (about, shape.tobytes(), planes.tobytes(), b" ".join(self.words))
        return [squeeze(x) for x in raw]

    @cached_property
    def page_of_block(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.pages)), self.blocks)

    @cached_property
    def owner(self) -> np.ndarray:
        """The block of each word."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @cached_property
    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the host, zone and first DEPTH words of each suffix, and where it begins.

        Substrings run across blocks, so that short blocks in the same order agree too.
        """
        known = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        words = known[self.numbers]
        page = self.page_of_block[self.owner]
        ends = np.cumsum(np.bincount(page, minlength=len(self.pages)))
        at = np.flatnonzero(ends[page] - np.arange(len(page)) >= DEPTH)
        hosts = [xxhash.xxh3_64_intdigest(host.encode()) for _, _, host in self.pages]
        found = np.array(hosts, np.uint64)[page[at]] + self.zones.astype(np.uint64)[self.owner[at]]
        for step in range(DEPTH):
            found = (found ^ words[at + step]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        return found >> np.uint64(64 - HASH_BITS), at

    @cached_property
    def with_hosts(self) -> np.ndarray:
        """The prefixes of all suffixes, then what stands for the host of each page."""
        hosts = [_whole_host(host) for _, _, host in self.pages]
        return np.concatenate([self.prefixes[0], np.array(hosts, np.uint64)])

    def counted(self, copies: list[int] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct values of ``with_hosts``, on how many pages but copies, and the place of each one."""
        every = self.with_hosts
        counts = ~np.isin(np.arange(len(self.pages)), copies or [])
        page = np.concatenate([self.page_of_block[self.owner[self.prefixes[1]]], np.arange(len(counts))])
        order = np.argsort(every, kind="stable")
        ordered, page = every[order], page[order]
        first = np.diff(ordered, prepend=~ordered[:1]) != 0
        fresh = first | (np.diff(page, prepend=-1) != 0)  # a page counts once
        rank = np.cumsum(first) - 1
        pages = np.bincount(rank[fresh], counts[page[fresh]], rank[-1] + 1).astype("<i8")
        place = np.empty(len(order), np.int64)
        place[order] = rank
        return ordered[first], pages, place

    def sketches(self) -> np.ndarray:
        """Least hashes of each page's prefixes in paragraphs outside of chrome, or of its whole stream."""
        prefixes, at = self.prefixes
        content = (self.sizes >= PARAGRAPH) & (self.zones != CHROME)
        inside = content[self.owner[at]]
        values, page = prefixes[inside], self.page_of_block[self.owner[at[inside]]]
        without = np.setdiff1d(np.arange(len(self.pages)), page)
        if len(without):
            first = np.concatenate([[0], np.cumsum(self.blocks)])
            streams = [
                b"\0".join([self.pages[i][2].encode(), *self.texts(range(first[i], first[i + 1]))])
                for i in without.tolist()
            ]
            whole = [xxhash.xxh3_64_intdigest(stream) for stream in streams]
            values, page = np.append(values, np.array(whole, np.uint64)), np.append(page, without)
            order = np.argsort(page, kind="stable")
            values, page = values[order], page[order]
        starts = np.searchsorted(page, np.arange(len(self.pages)))
        least = np.zeros((len(self.pages), SKETCH), np.int64)
        for i in range(SKETCH):
            mixed = (values ^ np.uint64(i * 0xD6E8FEB86659FD93 & 2**64 - 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            lowest = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
            least[:, i] = (lowest >> np.uint64(1)).astype(np.int64)
        return least

    @cached_property
    def _places(self) -> tuple[list[int], np.ndarray]:
        return np.concatenate([[0], np.cumsum(self.sizes)]).tolist(), np.array(self.words, object)

    def texts(self, blocks: Iterable[int]) -> list[bytes]:
        ends, words = self._places
        return [b" ".join(words[self.numbers[ends[i] : ends[i + 1]]].tolist()) for i in blocks]


_CHUNKS = "pages binary, shape binary, numbers binary, words binary, sketches array<long>, tokens long"
_CHUNK = ["pages", "shape", "numbers", "words"]


def _parse(pages: DataFrame) -> DataFrame:
    """Chunks of pages, stored in buckets: ids, urls, hosts, zones and blocks, and the pages' sketches."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbers()
        about, blocks, zones, sizes, numbers, size = [], [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            chunk = Chunk.of(about, blocks, zones, sizes, numbers, known)
            columns = [*chunk.stored(), chunk.sketches().ravel(), size]
            kinds = [pa.binary()] * 4 + [pa.list_(pa.int64()), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(columns, kinds)], [*_CHUNK, "sketches", "tokens"]
            )

        for batch in batches:
            for page_id, url, html in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))
            ):
                if size > CHUNK_TOKENS:
                    yield flush()
                    known = Numbers()
                    about, blocks, zones, sizes, numbers, size = [], [], [], [], [], 0
                found = page_blocks(html.decode("utf-8", "replace"))
                about.append([page_id, url, _host(url or "")])
                blocks.append(len(found))
                zones += [zone for zone, _ in found]
                sizes += [text.count(" ") + 1 for _, text in found]
                words = " ".join([text for _, text in found]).encode().split()
                numbers.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                size += len(words) + 1
        if about:
            yield flush()

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    chunks = map_batches(rows, parse, _CHUNKS)
    return bucketed(chunks.withColumn("chunk", F.monotonically_increasing_id()), "pages")


def _copies(chunks: DataFrame) -> DataFrame:
    """(chunk, copies): the places of pages that are near copies of an earlier one."""
    least = chunks.select("chunk", F.posexplode("sketches").alias("place", "sketch")).select(
        F.struct("chunk", F.floor(F.col("place") / SKETCH).cast("int").alias("at")).alias("page"),
        "sketch",
    )
    firsts = least.groupBy("sketch").agg(F.min("page").alias("first"))
    alike = least.join(firsts, "sketch").where("first < page").groupBy("page", "first").count()
    copies = alike.where(F.col("count") >= ALIKE)
    return copies.groupBy("page.chunk").agg(F.collect_set("page.at").alias("copies"))


def _by_range(values: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Ranges of hashes that ascending values lie in, and where."""
    cuts = np.searchsorted(values, bounds).tolist()
    for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(values)])):
        if low < high:
            yield i, slice(low, high)


def _in_order(parts: DataFrame, name: str, *columns: str) -> DataFrame:
    """(chunk, name): what the ranges of hashes know of a chunk, from the lowest on."""
    found = F.sort_array(F.collect_list(F.struct("range", *columns)))
    return parts.groupBy("chunk").agg(found.alias(name))


def _shared(chunks: DataFrame, bounds: np.ndarray, shift: np.uint64) -> DataFrame:
    """(chunk, range, shared): which of a chunk's shortened prefixes in a range another chunk has, too."""

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, *stored = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                values = np.unique(Chunk.read(*stored).with_hosts)
                for i, some in _by_range(values, bounds):
                    short = values[some] >> shift
                    short = short[np.diff(short, prepend=~short[:1]) != 0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i], pa.int32()),
                            pa.array([number], pa.int64()),
                            pa.array([packed(short)], pa.binary()),
                        ],
                        ["range", "chunk", "prefixes"],
                    )

    def several(table: pa.Table) -> pa.Table:
        each = [unpacked(raw) for raw in table["prefixes"].to_pylist()]
        _, place, n = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        found = np.split(n[place] > 1, np.cumsum([len(x) for x in each])[:-1])
        marks = [squeeze(np.packbits(x).tobytes()) for x in found]
        return table.select(["chunk", "range"]).append_column("shared", pa.array(marks, pa.binary()))

    sent = map_batches(
        chunks.select("chunk", *_CHUNK), shortened, "range int, chunk long, prefixes binary"
    )
    return map_groups(sent, ["range"], several, "chunk long, range int, shared binary")


def _repeated(chunks: DataFrame, copies: DataFrame) -> DataFrame:
    """(chunk, found): on how many pages the prefixes are that a chunk may share with others.

    Most prefixes are in one chunk only. So they travel shortened first, to SPARE bits more
    than would tell all of them apart if they were dealt evenly, and whole only where the
    shortened ones agree.
    """
    spark = chunks.sparkSession
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // RANGE_TOKENS))
    bounds = np.array([i * 2**HASH_BITS // ranges for i in range(1, ranges)], np.uint64)
    shift = np.uint64(max(HASH_BITS - tokens.bit_length() - SPARE, 0))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                number, shared, copies, *stored = (
                    batch.column(i)[row].as_py() for i in range(batch.num_columns)
                )
                values, pages, _ = Chunk.read(*stored).counted(copies)
                marks = {part["range"]: part["shared"] for part in shared}
                for i, some in _by_range(values, bounds):
                    short = values[some] >> shift
                    rank = np.cumsum(np.diff(short, prepend=short[:1]) != 0)
                    bits = np.unpackbits(np.frombuffer(unsqueeze(marks[i]), np.uint8))
                    sent = bits[rank].astype(bool)
                    if sent.any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([i], pa.int32()),
                                pa.array([number], pa.int64()),
                                pa.array([packed(values[some][sent])], pa.binary()),
                                pa.array([squeeze(pages[some][sent].tobytes())], pa.binary()),
                            ],
                            ["range", "chunk", "prefixes", "pages"],
                        )

    def summed(table: pa.Table) -> pa.Table:
        each = [unpacked(raw) for raw in table["prefixes"].to_pylist()]
        pages = [np.frombuffer(unsqueeze(raw), "<i8") for raw in table["pages"].to_pylist()]
        values, place = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(place, np.concatenate(pages), len(values)).astype("<i8")[place]
        ends = np.cumsum([len(x) for x in each])
        rows = []
        for chunk, i, found, end in zip(
            table["chunk"].to_pylist(), table["range"].to_pylist(), each, ends
        ):
            here = total[end - len(found) : end]
            several = here > 1
            rows.append((chunk, i, packed(found[several]), squeeze(here[several].tobytes())))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)],
            ["chunk", "range", "prefixes", "pages"],
        )

    shared = _in_order(_shared(chunks, bounds, shift), "shared", "shared")
    known = chunks.join(shared, "chunk").join(copies, "chunk", "left")
    sent = map_batches(
        known.select("chunk", "shared", "copies", *_CHUNK),
        whole,
        "range int, chunk long, prefixes binary, pages binary",
    )
    sums = map_groups(sent, ["range"], summed, "chunk long, range int, prefixes binary, pages binary")
    return _in_order(sums, "found", "prefixes", "pages")


def chosen(
    zones: list[int], words: np.ndarray, repeated: np.ndarray, usual: np.ndarray
) -> list[int]:
    """The blocks that are text: those that do not repeat, checked by the page's structure.

    ``repeated`` are the blocks that some pages of the host repeat, ``usual`` those that half do.
    """
    level = max(zones, default=CHROME)
    long = words >= PARAGRAPH
    if level >= MAIN:
        inside = np.array(zones) == level
        kept = inside & (~usual | long)
        return np.flatnonzero(kept if kept.any() else inside).tolist()
    other = np.array(zones, np.int64) == OTHER
    kept = other & ~np.where(long, usual, repeated)
    if not kept.any():
        kept = other & long
    if not kept.any():
        kept = (np.array(zones, np.int64) == SOFT) & long & ~usual
    return np.flatnonzero(kept).tolist()


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text for each row of (page_id, url, html)."""
    chunks = _parse(pages)
    copies = squeezed(_copies(chunks), "copies")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                copies, found, *stored = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                chunk = Chunk.read(*stored)
                values, pages, place = chunk.counted(copies)
                for part in found or []:
                    at = np.searchsorted(values, unpacked(part["prefixes"]))
                    pages[at] = np.frombuffer(unsqueeze(part["pages"]), "<i8")
                at, owner = chunk.prefixes[1], chunk.owner
                n = np.maximum(pages, 1)[place]
                n, on_host = n[: len(at)], n[len(at) :][chunk.page_of_block[owner[at]]]

                def mostly(hits: np.ndarray) -> np.ndarray:
                    under = np.zeros(len(owner), bool)
                    for step in range(DEPTH):
                        under[at[hits] + step] = True
                    return np.bincount(owner, under, len(chunk.sizes)) / chunk.sizes >= COVERED

                usual = mostly((n >= USUAL_PAGES) & (n >= USUAL_SHARE * on_host))
                some = mostly(n >= np.maximum(2, np.minimum(SOME_PAGES, SOME_SHARE * on_host)))
                first = np.concatenate([[0], np.cumsum(chunk.blocks)]).tolist()
                for low in range(0, len(chunk.pages), SLICE):
                    ids, urls, texts = [], [], []
                    for i, (page_id, url, _) in enumerate(chunk.pages[low : low + SLICE], low):
                        of = slice(first[i], first[i + 1])
                        kept = chosen(chunk.zones[of].tolist(), chunk.sizes[of], some[of], usual[of])
                        ids.append(page_id)
                        urls.append(url)
                        texts.append(b"\n\n".join(chunk.texts(first[i] + k for k in kept)).decode())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids, pa.int64()),
                            pa.array(urls, pa.string()),
                            pa.array(texts, pa.string()),
                        ],
                        ["page_id", "url", "text"],
                    )

    joined = chunks.join(_repeated(chunks, copies), "chunk", "left").join(copies, "chunk", "left")
    return map_batches(
        joined.select("copies", "found", *_CHUNK), judge, "page_id long, url string, text string"
    )
