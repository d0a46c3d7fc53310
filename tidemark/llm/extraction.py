"""Main text of web pages: tag rules find articles; what the suffix array of a host finds repeated is taken out, in articles too."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_group, materialise, texts

DEPTH = 12
"""Words of the shortest repeat; longer ones show as overlapping ones."""
CONTENTS = 3
"""Distinct contents of a host on which a repeat stands at least."""
NEARLY = 0.95
"""Share of a page's words; where repeats cover more, the page is a near copy and stays as it is."""
OUT_ROWS = 65536
"""Suffixes in one batch that a task passes on; a long page gives several."""
PIECE = 1 << 20
"""Characters of html whose articles are sorted at once; a larger host is several pieces."""
PIECE_PAGES = 8
"""Pages of a piece at least, on average, however long."""

# a quote counts only after an equals sign; what never ends runs to the end of the page, so each character is read once
_ATTRIBUTES = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(script|style|template|noscript|textarea|svg|iframe|object|select)(?=[\s/>]){_ATTRIBUTES}(?:>|\Z).*?(?:</\1\s*+>|\Z)"
    rf"|</?([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRIBUTES})(?:>|\Z)|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# fixed values: names of HTML elements
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form button dialog head menu".split())
MAIN = frozenset("article main".split())
# fixed values: what may stand in a head; anything else ends one that was left open
IN_HEAD = frozenset("title meta link base basefont bgsound noframes style script noscript template".split())
# fixed values: elements whose start ends an open paragraph
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li dd dt main menu nav ol p pre search section table ul".split()
)
_APART = frozenset("article aside body html main nav section table td th".split())
# start tag: the elements that it ends where they were left open, and those that it doesn't look beyond
ENDED = {name: (frozenset(["p"]), frozenset("table td th caption".split())) for name in ENDS_P}
AFTER_ITEM = {
    "li": (frozenset(["li"]), _APART | {"ul", "ol", "menu"}),
    **{name: (frozenset("dt dd".split()), _APART | {"dl"}) for name in ("dt", "dd")},
    **{name: (frozenset("td th".split()), frozenset(["table"])) for name in ("td", "th")},
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    **{name: (frozenset("thead tbody tfoot".split()), frozenset(["table"])) for name in ("thead", "tbody", "tfoot")},
    "option": (frozenset(["option"]), _APART),
}
# fixed values: words by which class, id and role name what is not the article
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "alert menu nav navbar navigation breadcrumb breadcrumbs sidebar comment comments reply replies share sharing social "
    "related recommended newsletter subscribe subscription popup modal overlay footer header masthead toolbar pagination "
    "widget login signup search complementary contentinfo".split()
)


def _foreign(attributes: str) -> bool:
    """Whether class, id or role names something beside the article."""
    if "=" not in attributes:
        return False
    for groups in _NAMED.findall(attributes):
        for name in re.split(r"[\s_-]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(groups))):
            if name.lower() in NAMES:
                return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """Blocks of text in page order as ``(place, text)``: 2 in an article, 1 elsewhere, 0 in parts that are never main text.

    Block elements end a block, inline ones don't; a line break is white space.
    Unclosed elements end with the one around them, and where the start of another
    one ends them: a head with what can't stand in it, a paragraph with the next
    block, items, cells and rows with the next of their kind. A stray end tag
    only ends a block. A tag that never ends runs to the end of the page. Linear in the page.
    """
    found: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    held: Counter[str] = Counter()
    parts: list[str] = []
    place, at = 1, 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                found.append((place, text))

    def leave(depth: int) -> int:
        """Ends the elements from ``depth`` on; the place around them."""
        around = stack[depth][1]
        held.subtract(name for name, _ in stack[depth:])
        del stack[depth:]
        return around

    def end_before(ended: frozenset, beyond: frozenset) -> int:
        """Ends the innermost of ``ended`` that no element of ``beyond`` hides."""
        for i in range(len(stack) - 1, -1, -1) if any(held[x] > 0 for x in ended) else ():
            if stack[i][0] in ended:
                return leave(i)
            if stack[i][0] in beyond:
                break
        return place

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, ends = m[2].lower(), page[m.start() + 1] == "/"
        if name in INLINE and not (name not in VOID and not ends and _foreign(m[3])):
            if name == "br":
                parts.append(" ")
            if not ends or held[name] <= 0:
                if held["head"] > 0 and not ends:
                    flush()
                    place = end_before(frozenset(["head"]), frozenset())
                continue
        flush()
        if ends:
            if held[name] > 0:
                place = leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if held["head"] > 0 and name not in IN_HEAD:
            place = end_before(frozenset(["head"]), frozenset())
        for rules in (AFTER_ITEM, ENDED):
            if name in rules:
                place = end_before(*rules[name])
        if name not in VOID and not m[3].rstrip().endswith("/"):
            stack.append((name, place))
            held[name] += 1
            if place and (name in DROPPED or name == "header" and place == 1 or name not in ("html", "body", *MAIN) and _foreign(m[3])):
                place = 0
            elif place and name in MAIN:
                place = 2
    if at < len(page):
        parts.append(page[at:])
    flush()
    return found


def _streams(found: list[tuple[int, str]]) -> tuple[list[str], list[str]]:
    """The words of a page outside articles and in them, in page order, across blocks."""
    return tuple([word for place, text in found if (place == 2) == inside for word in text.split()] for inside in (False, True))


def _digest(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)


def _shared(articles: list[str]) -> list[int]:
    """Digests of the runs of ``DEPTH`` words that stand in more than half of the texts, by a suffix array.

    The array holds the suffixes that begin with ``DEPTH`` words of which each
    stands in more than half; others can't. It is made by doubling: the ranks of
    all prefixes of 1, 2, 4 ... words, each from two of half the length, until
    ``DEPTH`` words are ranked.
    """
    split = [text.split() for text in articles]
    held: Counter[str] = Counter()
    for words in split:
        held.update(set(words))
    common = sorted(word for word, n in held.items() if 2 * n > len(articles))
    places = {word: i for i, word in enumerate(common, 1)}
    # 0 is any other word and the end of a text
    codes: list[int] = []
    for words in split:
        codes.extend(map(places.get, words, repeat(0)))
        codes.append(0)
    flat = np.array(codes, np.int64)
    owners = np.repeat(np.arange(len(articles)), [len(words) + 1 for words in split])
    before = np.r_[0, np.cumsum(flat > 0)]
    at = np.flatnonzero(before[DEPTH:] - before[:-DEPTH] == DEPTH)
    if not len(at):
        return []
    # only the stretches that these cover, each with a 0 after it
    inside = np.zeros(len(flat) + 1, np.int64)
    np.add.at(inside, at, 1)
    np.add.at(inside, at + DEPTH, -1)
    covered = np.cumsum(inside[:-1]) > 0
    kept = covered | np.r_[False, covered[:-1]]
    at = (np.cumsum(kept) - 1)[at]
    flat, owners = np.where(covered, flat, 0)[kept], owners[kept]

    def joined(first: np.ndarray, second: np.ndarray, by: int) -> np.ndarray:
        """Ranks of prefixes that go on after ``by`` words."""
        after = np.zeros_like(second)
        after[: max(len(second) - by, 0)] = second[by:]
        return np.unique(first * (second.max() + 1) + after, return_inverse=True)[1]

    ranks, prefix, depth, length = flat, None, 0, 1
    while length <= DEPTH:
        if DEPTH & length:
            prefix, depth = ranks if prefix is None else joined(prefix, ranks, depth), depth + length
        if 2 * length <= DEPTH:
            ranks = joined(ranks, ranks, length)
        length *= 2
    array = at[np.argsort(prefix[at], kind="stable")]
    fresh = np.r_[True, prefix[array[1:]] != prefix[array[:-1]]]
    runs = np.flatnonzero(fresh)
    contents = np.add.reduceat((fresh | np.r_[True, owners[array[1:]] != owners[array[:-1]]]).astype(np.int64), runs)
    starts = array[runs[2 * contents > len(articles)]]
    return [_digest([common[x - 1] for x in flat[i : i + DEPTH].tolist()]) for i in starts.tolist()]


def _likely(pages: DataFrame) -> DataFrame:
    """``host, likely, needed``: digests of all runs that may stand in so many articles of a host that they aren't their own text.

    Such a run stands on more than half of the host's contents with an article,
    hence on more than half of those of some piece, however these are dealt.
    The arrays of the pieces give these runs, and a few more on hosts of several
    pieces. Between tasks the articles are compressed.
    """
    sizes = pages.groupBy("host").agg(F.sum(F.char_length("html")).alias("size"), F.count("*").alias("pages"))
    pieces = F.least(F.ceil(F.col("size") / PIECE), F.ceil(F.col("pages") / PIECE_PAGES))
    # at most one host for each PIECE of the input
    dealt = pages.join(F.broadcast(sizes.where(F.col("size") > PIECE).select("host", pieces.alias("pieces"))), "host", "left")
    dealt = dealt.withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    dealt = dealt.withColumn("key", F.xxhash64("host", F.pmod("content", "pieces"))).withColumn("whole", F.col("pieces") == 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one row of many copies, so these make no large piece
            rows = {x: i for i, x in enumerate(zip(batch.column("key").to_pylist(), batch.column("content").to_pylist(), strict=True))}
            batch = batch.take(pa.array(rows.values(), pa.int64()))
            found = [blocks(page) for page in texts(batch.column("html"))]
            own = pa.array([any(place == 2 for place, _ in f) for f in found], pa.bool_())
            raw = [" ".join(_streams(f)[1]).encode() for f, x in zip(found, own.to_pylist(), strict=True) if x]
            columns = [batch.column(c).filter(own) for c in ("key", "host", "content", "whole")]
            columns += [pa.array([len(x) for x in raw], pa.int32()), pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "host", "content", "whole", "size", "article"])

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            held: dict[tuple[str, bool], dict[int, str]] = {}
            some = table.slice(first, end - first)
            for host, content, whole, size, article in zip(*(some[c] for c in ("host", "content", "whole", "size", "article")), strict=True):
                text = pa.decompress(article.as_buffer(), size.as_py(), "zstd", asbytes=True).decode()
                held.setdefault((host.as_py(), whole.as_py()), {})[content.as_py()] = text
            out = []
            for (host, whole), articles in held.items():
                likely = [] if whole and len(articles) < CONTENTS else _shared(list(articles.values()))
                if likely or not whole:
                    out.append((host, len(articles), likely))
            columns = zip(*out, strict=True) if out else ((), (), ())
            made = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays(made, ["host", "articles", "likely"])

    articles = dealt.select("key", "host", "content", "whole", "html").mapInArrow(
        run, "key long, host string, content long, whole boolean, size int, article binary"
    )
    found = materialise(by_group(articles, "key", work, "host string, articles long, likely array<long>"), "pieces")
    runs = found.select("host", F.explode("likely").alias("run")).distinct().groupBy("host").agg(F.collect_list("run").alias("likely"))
    held = found.groupBy("host").agg(F.sum("articles").alias("articles")).where(F.col("articles") >= CONTENTS)
    needed = F.greatest(F.floor(F.col("articles") / 2) + 1, F.lit(CONTENTS))
    return runs.join(held, "host").select("host", "likely", needed.cast("int").alias("needed"))


def _suffixes(pages: DataFrame) -> DataFrame:
    """``content, host, word, suffix, inside, needed, open`` of the suffixes that have ``DEPTH`` words, cut after these.

    Every suffix outside articles, and of those in articles the ones that the
    columns of ``_likely`` name, where ``pages`` has these. ``needed`` contents
    make a repeat; where a suffix is not ``open``, it's evidence only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {
            "content": pa.int64(), "host": pa.string(), "word": pa.int32(), "suffix": pa.string(), "inside": pa.bool_(),
            "needed": pa.int32(), "open": pa.bool_(),
        }
        out: list[list] = [[] for _ in kinds]
        for batch in batches:
            for row in batch.to_pylist():
                found = blocks(row["html"] or "")
                is_open, named = all(p != 2 for p, _ in found), set(row.get("likely") or ())
                outside, own = _streams(found)
                for inside, words in ((False, outside), (True, own if named else [])):
                    needed = row.get("needed") if inside else CONTENTS
                    for word in range(len(words) - DEPTH + 1):
                        start = words[word : word + DEPTH]
                        if inside and _digest(start) not in named:
                            continue
                        fields = (row["content"], row["host"], word, " ".join(start), inside, needed, inside or is_open)
                        for column, x in zip(out, fields, strict=True):
                            column.append(x)
                        if len(out[0]) == OUT_ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds.values(), strict=True)], [*kinds])
                            out = [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds.values(), strict=True)], [*kinds])

    return pages.mapInArrow(run, "content long, host string, word int, suffix string, inside boolean, needed int, open boolean")


def suffix_array(suffixes: DataFrame) -> DataFrame:
    """The suffixes of every host in order: ranges of host and suffix, each sorted, equal suffixes in one range.

    Suffixes are ordered by their first ``DEPTH`` words, those with the same by
    content and place, outside articles first; the order beyond doesn't matter
    for repeats of that length. A large host is many ranges.
    """
    return suffixes.repartitionByRange("host", "suffix").sortWithinPartitions("host", "suffix", "inside", "content", "word")


def _repeated(array: DataFrame) -> DataFrame:
    """``content, host, word`` of the open suffixes whose first ``DEPTH`` words stand on as many contents as they need.

    Neighbours in the array with a common prefix of ``DEPTH`` words form a run,
    apart for suffixes outside articles and in them. Its contents come in
    order, so they are counted where they change. Runs are windows over the
    ranges as they are sorted; long ones spill.
    """
    same = Window.partitionBy("host", "suffix", "inside")
    last = F.lag(F.struct("content", "word")).over(same.orderBy("content", "word"))
    rows = array.withColumn("last", last).withColumn("fresh", F.coalesce(F.col("last.content") != F.col("content"), F.lit(True)))
    rows = rows.withColumn("contents", F.sum(F.col("fresh").cast("int")).over(same))
    # a page of equal html has the same content and word
    first = F.col("fresh") | (F.col("last.word") != F.col("word"))
    return rows.where(F.col("open") & first & (F.col("contents") >= F.col("needed"))).select("content", "host", "word")


def _without(found: list[tuple[int, str]], starts: list[int]) -> list[str]:
    """The article's blocks, or the open ones where there is none, without the words that the repeats from ``starts`` cover.

    Whole where they cover nearly all. A block of an article loses all of its
    words or ``DEPTH`` together: fewer beside a repeat are the article's own,
    though most others have the same ones there.
    """
    inside = any(place == 2 for place, _ in found)
    own = 2 if inside else 1
    if not starts:
        return [text for place, text in found if place == own]
    gone = {i for x in starts for i in range(x, x + DEPTH)}
    kept, at, size, lost = [], 0, 0, 0
    for place, text in found:
        if inside and place != 2:
            continue
        words = text.split()
        if place == own:
            cut = [i in gone for i in range(at, at + len(words))]
            if inside and not all(cut):
                runs = [(hit, len(list(same))) for hit, same in groupby(cut)]
                cut = [hit and length >= DEPTH for hit, length in runs for _ in range(length)]
            left = [w for w, x in zip(words, cut, strict=True) if not x]
            size, lost = size + len(words), lost + len(words) - len(left)
            kept.append(text if len(left) == len(words) else " ".join(left))
        at += len(words)
    return [text for place, text in found if place == own] if lost > NEARLY * size else [x for x in kept if x]


def _host(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text`` for every row of ``pages``: the main text, blocks in page order joined by a line feed.

    Markup first sorts blocks into the article, parts that are never main text
    (menus, footers, sidebars, forms, what a class or role names so), and the
    rest. Then repeats decide, within the article where a page has one, and in
    the rest where it has none.

    The words outside articles are one stream a page, across blocks, those in
    articles another, and the suffixes of all streams of a host are sorted into
    its suffix array. What a page with an article holds outside it is evidence
    against pages without. A repeat is a common prefix of at least ``DEPTH``
    words of neighbours in the array, on ``CONTENTS`` distinct contents of the
    host, so a short paragraph or quoted clause amid a text is none. Longer
    repeats show at each of their words. Articles quote each other, so within
    them a repeat must also stand in more than half of the host's distinct
    contents with an article: a notice of the site does, a quotation doesn't.
    Suffixes that can't reach this don't enter the array of the host; the
    arrays of its pieces, ``PIECE`` characters each, name all others.

    Pieces and ranges of the array are tasks, so a host with a third of all
    pages is no single task. Covered words are taken out of the article or the
    page, unless they are more than ``NEARLY`` of it, or few in a block of an
    article that has others.

    Null and empty pages, and pages without main text, have an empty text.
    Pages without a host share one. Pages of equal html count as one content,
    whatever their urls: a page doesn't repeat itself. Null ids are kept; other
    columns are not read; an empty table gives no rows.
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    keyed = base.withColumn("content", F.xxhash64("html")).withColumn("host", _host(F.col("url")))
    read = keyed.select("content", "host", "html")
    # its true size is known at the join, so pages aren't moved for few hosts
    named = read.join(materialise(_likely(read), "likely"), "host", "left").select("content", "host", "html", "likely", "needed")
    # read twice: for the ranges and for the sort
    suffixes = materialise(_suffixes(named), "suffixes")
    covered = _repeated(suffix_array(suffixes))
    # its true size is known at the join, so pages aren't moved for few rows
    removed = materialise(covered.groupBy("content", "host").agg(F.collect_list("word").alias("covered")), "covered")
    joined = keyed.join(removed, ["content", "host"], "left").select("id", "url", "html", "covered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, starts in zip(texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                out.append("\n".join(_without(blocks(page), starts or [])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["id", "url", "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    found = joined.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
