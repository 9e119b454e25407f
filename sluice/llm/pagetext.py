"""Main text of web pages, with boilerplate found by a suffix array per host.

Each page is scanned once into blocks. Blocks under navigation, header, footer,
aside, form, script, style, or an element whose class, id or role is such a
part's name, are chrome; an element that is an article or main, or contains main,
is not, nor one that contains the page's only articles and with them most text. A name
that adds a word of layout (comment-list, ad-slot) hides its element unless hardly
any text would be left beside it. If the page marks its
article (article, main, role=main, itemprop=articleBody), the article's blocks are
its text; text of main outside its articles, if it is longer than they are.

The token streams of all the host's distinct pages (outside articles; equal streams
count once) are concatenated and their suffixes sorted by their first `DEPTH` tokens;
each is compared with the one before it, and where the common prefix is shorter than
`RUN` tokens an interval of the array ends. The distinct streams of an interval hold the
same substring; neighbouring starts with as many holders make up a maximal repeat. A
block that repeats cover whole is boilerplate if it is short or on many pages; everything
else, phrases that sentences share and mirrored paragraphs included, is text, and
so is the whole page if nearly all of it is covered. Windows of `RUN` tokens are counted by
hash first, so that only suffixes with a partner are sorted; they are distributed
by host and prefix, so a host with a third of all pages is spread over its suffixes.

Articles that a page marks have an array of their own, of the blocks that may be notices:
short ones whose first tokens start a short block in most of the host's articles. One that
repeats cover whole on so many is a notice and goes, unless more than `NOTICES` of the article
would go. Articles whose longest block begins alike count once: mirrored
and slightly changed articles repeat on a host as well, and they are text, as are
paragraphs that some articles (or adverts) share.

Defined results: NULL or empty html gives empty text; unclosed elements reach
to the end of their parent; an unfinished tag at the end of the page is text;
pages of a host with equal streams count as one; a NULL url is a host of its
own; an empty table gives no rows. Only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialize
from sluice.session import ship_package

RUN = 6  # tokens of a repeated substring
SHORT = 30  # tokens of a block that is boilerplate if one other page of the host has it
MANY = 5  # pages of a host that make a longer block boilerplate
NEARLY_ALL = 0.9  # share of a page's tokens that is not removed
NOTICES = 0.2  # share of a marked article's tokens that repeats may take from it
MOST = 0.5  # share of the host's marked articles that have a notice
DEPTH = 30  # tokens by which suffixes are sorted; longer repeats are put together from several starts
LITTLE = 0.05  # text beside an element with a layout name, for its own text, that lets it go

# HTML's own element names by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes template noscript".split())
BLOCK = set("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
SPACED = {"br", "td", "th", "option"}
CHROME = set("nav header footer aside form button select dialog menu svg canvas audio video object head".split())
NAMED = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice "
            "notices popup modal sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments respond replies "
            "disqus share sharing social related newsletter subscribe signup footer header masthead toolbar widget pagination "
            "copyright".split())

# Words that only place or frame such a part.
LAYOUT = set("area bar block body bottom box col column container content form group inner item label left list main meta outer "
             "page panel region right row section site slot text thread title top unit wrap wrapper zone".split())

_PIECE = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>|<[!?][^<>]*+>|[^<]++|<""")
_NAMES = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
_MAIN = re.compile(r"""(?i)\b(?:role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articlebody\b)""")
_HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none")
_WORD = re.compile(r"[a-z]+")


_HARD, _SOFT = 1, 2


def _chrome(tag: str, attributes: str, level: int) -> int:
    """Is the element chrome: surely, or by a name with words of layout (_SOFT)?"""
    if tag in CHROME and not (tag == "header" and level):
        return _HARD
    if not attributes or tag in ("html", "body", "main"):
        return 0
    if _HIDDEN.search(attributes):
        return _HARD
    if tag == "article" or _MAIN.search(attributes):
        return 0
    # A whole name, or one put together from such names only: cookie-notice, but not has-sidebar.
    known = NAMED - {"header"} if level else NAMED
    names = [set(_WORD.findall(name)) for value in _NAMES.findall(attributes) for name in value.lower().split()]
    if any(parts and parts <= known for parts in names):
        return _HARD
    return _SOFT if any(parts & known and parts <= known | LAYOUT for parts in names) else 0


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(level, text) of every block that is not chrome, in page order; level 0 is
    outside, 1 in a main area, 2 in an article."""
    html = html or ""
    out: list[tuple[int, str, tuple]] = []
    parts: list[str] = []
    stack: list[tuple[str, tuple, int]] = []  # open elements: tag, chrome, level
    chrome: tuple[dict, ...] = ()  # the open elements that hide what is below them
    level, at = 0, 0

    def close_block():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((level, text, chrome))

    while at < len(html):
        piece = _PIECE.match(html, at)
        at = piece.end()
        first = piece[0]
        if first[0] != "<" or first == "<":
            parts.append(entities.unescape(first))
            continue
        if first == "<!--":
            end = html.find("-->", at)
            at = len(html) if end < 0 else end + 3
            continue
        if piece[2] is None:  # doctype or processing instruction
            continue
        tag = piece[2].lower()
        if tag in SPACED:
            parts.append(" ")
        if piece[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            outer = ("", (), 0) if not depth else stack[depth - 1]
            if tag in BLOCK or depth is not None and len(outer[1]) != len(chrome):
                close_block()
            if depth is not None:
                del stack[depth:]
                _, chrome, level = outer
            continue
        if tag in BLOCK:
            close_block()
            if stack and stack[-1][0] == "p":
                stack.pop()
                _, chrome, level = stack[-1] if stack else ("", (), 0)
        if tag in RAW:
            end = re.compile(rf"(?i)</{re.escape(tag)}(?=[\s/>]|$)").search(html, at)
            at = len(html) if end is None else end.start()
            continue
        if tag in VOID or piece[3].endswith("/"):
            continue
        hides = _chrome(tag, piece[3], level)
        if hides:
            close_block()
            chrome = (*chrome, {"main": False, "article": False, "soft": hides == _SOFT})
        is_main = tag == "main" or bool(piece[3] and _MAIN.search(piece[3]))
        if is_main or tag == "article":
            for element in chrome:
                element["main" if is_main else "article"] = True
        if tag == "article":
            level = 2
        elif tag == "main" or piece[3] and _MAIN.search(piece[3]):
            level = max(level, 1 if tag == "main" else 2)
        stack.append((tag, chrome, level))
    close_block()
    _excuse_layout(out)
    shown = [(level, text) for level, text, hiding in out if all(e["main"] for e in hiding)]
    if any(level for level, _ in shown):
        return shown
    more = [(level, text) for level, text, hiding in out if all(e["main"] or e["article"] for e in hiding)]
    size = lambda found, least: sum(len(text) for level, text in found if level >= least)
    return more if size(more, 1) > size(shown, 0) else shown


def _excuse_layout(found: list[tuple[int, str, tuple]]) -> None:
    """An element with a layout name shows its text if it holds nearly all there is."""
    beside, under = 0, {}
    for _, text, hiding in found:
        if all(e["soft"] or e["main"] for e in hiding):
            for element in hiding:
                under.setdefault(id(element), [element, 0])[1] += len(text)
            beside += 0 if hiding else len(text)
    for element, size in under.values():
        if beside < LITTLE * size:
            element["main"] = True


def text_level(found: list[tuple[int, str]]) -> int:
    """The level that holds a page's text: articles, or main if more of its text is outside them."""
    held = {n: sum(len(t) for level, t in found if level == n) for n in (1, 2)}
    return 0 if not any(held.values()) else 1 if held[1] > held[2] else 2


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html) -> (page_id, url, marked, article, rest, short, size, opening):
    the article's blocks, or none; `rest` has all blocks outside articles. Of the article: the
    places of the blocks that may be notices, its tokens, and how its longest block begins."""
    for batch in batches:
        marked, article, rest, short, sizes, opening = [], [], [], [], [], []
        for page in batch.column(2):
            found = blocks(page.as_py())
            best = text_level(found)
            own = [t for level, t in found if level == best] if best else []
            counts = [t.count(" ") + 1 for t in own]
            marked.append(best > 0)
            article.append(own)
            rest.append([t for level, t in found if level < max(best, 1)])
            short.append([i for i, n in enumerate(counts) if RUN <= n <= SHORT])
            sizes.append(sum(counts))
            opening.append(" ".join(max(own, key=len, default="").split(" ", RUN)[:RUN]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(marked, pa.bool_()), pa.array(article, pa.list_(pa.string())),
             pa.array(rest, pa.list_(pa.string())), pa.array(short, pa.list_(pa.int32())), pa.array(sizes, pa.int64()),
             pa.array(opening, pa.string())], ["page_id", "url", "marked", "article", "rest", "short", "size", "opening"])


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _streams(scanned: DataFrame) -> DataFrame:
    """(host, stream, tokens): the distinct token streams of every host."""
    host = F.col("host") if "host" in scanned.columns else host_of(F.col("url"))
    return (scanned.select(host.alias("host"), "stream", F.split(F.array_join("rest", " "), " ").alias("tokens"))
            .dropDuplicates(["host", "stream"]))


def suffixes(scanned: DataFrame, run: int = RUN) -> DataFrame:
    """(host, prefix, stream, at): every suffix of the pages' distinct streams by its first `run` tokens."""
    starts = F.when(F.size("tokens") >= run, F.sequence(F.lit(0), F.size("tokens") - run))
    return (_streams(scanned).select("host", "stream", "tokens", F.explode(starts).alias("at"))
            .select("host", "stream", "at", F.xxhash64(F.array_join(F.slice("tokens", F.col("at") + 1, run), " ")).alias("prefix")))


def repeated_suffixes(found: DataFrame) -> DataFrame:
    """(host, prefix, holders) of the substrings on two or more distinct streams of a host."""
    return (found.groupBy("host", "prefix", "stream").agg(F.count("*").alias("times"))
            .groupBy("host", "prefix").agg(F.count("*").alias("holders")).where("holders > 1"))


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(b)).cast("int")


def suffix_array(scanned: DataFrame, run: int = RUN, depth: int = DEPTH) -> DataFrame:
    """(host, prefix, tail, stream, at, common, interval): the suffixes that share `run` tokens
    with another stream of their host, in order of their first `depth` tokens (`tail`); `common`
    is the length of the prefix shared with the suffix before, and an interval ends where it is below `run`."""
    found = suffixes(scanned, run)
    paired = found.join(repeated_suffixes(found).select("host", "prefix"), ["host", "prefix"], "left_semi")
    tails = paired.join(_streams(scanned), ["host", "stream"]).select(
        "host", "prefix", "stream", "at", F.slice("tokens", F.col("at") + 1, depth).alias("tail"))
    order = Window.partitionBy("host", "prefix").orderBy("tail", "stream", "at")
    before = F.lag("tail").over(order)
    common = F.when(before.isNull(), 0).otherwise(_common(before, F.col("tail")))
    return (tails.withColumn("common", common)
            .withColumn("interval", F.sum(F.when(F.col("common") < run, 1).otherwise(0)).over(order)))


def maximal_repeats(array: DataFrame, voices: DataFrame | None = None, run: int = RUN) -> DataFrame:
    """(host, stream, at, length, holders): the stretches of a stream whose every `run` tokens
    are in as many streams, two or more. With `voices` (host, stream, voice), streams
    of one voice count once."""
    interval = ["host", "prefix", "interval"]
    array = materialize(array.select(*interval, "stream", "at"), "suffixes")
    members = array.select(*interval, "stream") if voices is None else array.join(voices, ["host", "stream"]).select(
        *interval, F.col("voice").alias("stream"))
    held = members.distinct().groupBy(*interval).agg(F.count("*").alias("holders")).where("holders > 1")
    starts = array.select(*interval, "stream", "at").join(held, interval)
    place = F.row_number().over(Window.partitionBy("host", "stream", "holders").orderBy("at"))
    return (starts.select("host", "stream", "at", "holders", (F.col("at") - place).alias("stretch"))
            .groupBy("host", "stream", "holders", "stretch")
            .agg(F.min("at").alias("at"), (F.max("at") - F.min("at") + run).alias("length"))
            .select("host", "stream", "at", "length", "holders"))


def _holders(split: list[list[str]], hits: list[tuple[int, int, int]]) -> list[int]:
    """For each block the fewest holders of a token, given (at, length, holders) of the maximal repeats."""
    held = [0] * sum(map(len, split))  # the most streams that share a substring over the token
    for at, length, holders in hits:
        for i in range(at, at + length):
            held[i] = max(held[i], holders)
    out, at = [], 0
    for words in split:
        out.append(min(held[at:at + len(words)]))
        at += len(words)
    return out


def unique_blocks(rest: list[str] | None, hits: list[tuple[int, int, int]]) -> str:
    """The blocks of an unmarked page that are not boilerplate, given its maximal repeats."""
    split = [block.split(" ") for block in rest or ()]
    kept, gone = [], 0
    for words, least in zip(split, _holders(split, hits)):
        if least >= MANY or least > 1 and len(words) <= SHORT:
            gone += len(words)
        else:
            kept.append(" ".join(words))
    return "\n".join(kept if gone <= NEARLY_ALL * sum(map(len, split)) else rest)


def _hits(repeats: DataFrame) -> DataFrame:
    return (repeats.groupBy("host", "stream").agg(F.collect_list(F.struct("at", "length", "holders")).alias("hits"))
            .toDF("hit_host", "hit_stream", "hits"))


def _triples(hits: list[dict] | None) -> list[tuple[int, int, int]]:
    return [(h["at"], h["length"], h["holders"]) for h in hits or ()]


def unique_runs(pages: DataFrame, repeats: DataFrame) -> DataFrame:
    """Pages without a marked article: their blocks less those that the host repeats."""
    joined = pages.join(_hits(repeats), (host_of(F.col("url")) == F.col("hit_host")) & (F.col("stream") == F.col("hit_stream")), "left").select(
        "page_id", "url", "rest", "hits")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [unique_blocks(rest, _triples(hits))
                   for rest, hits in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return joined.mapInArrow(keep, f"page_id {id_type}, url {url_type}, text string")


def notices(marked: DataFrame, run: int = RUN) -> DataFrame:
    """(host, stream, gone): places of the blocks of marked articles that most of the host's
    articles have. `marked` has url, stream, article, short, size, voice."""
    pages = marked.withColumn("host", host_of(F.col("url")))
    least = (pages.select("host", "voice").distinct().groupBy("host").agg(F.count("*").alias("voices"))
             .select("host", F.greatest(F.lit(MANY), F.ceil(F.col("voices") * MOST)).alias("least")))
    blocks = (pages.select("host", "stream", "voice", "size", "article", F.explode("short").alias("place"))
              .select("host", "stream", "voice", "size", "place", F.get("article", "place").alias("block"))
              .withColumn("prefix", F.xxhash64(F.substring_index("block", " ", run))))
    starts = (blocks.select("host", "prefix", "voice").distinct().groupBy("host", "prefix").agg(F.count("*").alias("n"))
              .join(least, "host").where("n >= least").select("host", "prefix", "least"))
    likely = materialize(blocks.join(materialize(starts, "starts"), ["host", "prefix"]).drop("prefix")
                         .dropDuplicates(["host", "stream", "place"])
                         .groupBy("host", "stream", "voice", "size", "least")
                         .agg(F.sort_array(F.collect_list(F.struct("place", "block"))).alias("found"))
                         .select("host", "stream", "voice", "size", "least", F.col("found.place").alias("places"),
                                 F.col("found.block").alias("rest")), "likely")
    repeats = maximal_repeats(suffix_array(likely, run), likely.select("host", "stream", "voice"), run)
    joined = likely.join(_hits(repeats), (F.col("host") == F.col("hit_host")) & (F.col("stream") == F.col("hit_stream")))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for row in batch.select(["places", "rest", "hits", "least", "size"]).to_pylist():
                split = [block.split(" ") for block in row["rest"]]
                found = [i for i, n in enumerate(_holders(split, _triples(row["hits"]))) if n >= row["least"]]
                few = sum(len(split[i]) for i in found) <= NOTICES * row["size"]
                gone.append([row["places"][i] for i in found] if few else [])
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("stream"), pa.array(gone, pa.list_(pa.int32()))],
                                             ["host", "stream", "gone"])

    return (joined.select("host", "stream", "places", "rest", "hits", "least", "size")
            .mapInArrow(choose, "host string, stream long, gone array<int>").where("size(gone) > 0"))


def extract_pages(pages: DataFrame, run: int = RUN) -> DataFrame:
    """One row per page: its main text and length in code points."""
    ship_package(pages.sparkSession)
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    scanned = materialize(pages.select("page_id", "url", "html").mapInArrow(
        _scan, f"page_id {id_type}, url {url_type}, marked boolean, article array<string>, rest array<string>, "
               "short array<int>, size long, opening string")
        .withColumn("stream", F.xxhash64(F.array_join("rest", " "))).withColumn("own", F.xxhash64(F.array_join("article", "\n")))
        .withColumn("voice", F.xxhash64("opening")).drop("opening"), "pages")
    repeats = maximal_repeats(suffix_array(scanned, run), run=run)
    marked = scanned.where("marked").drop("stream").withColumnRenamed("own", "stream")
    gone = materialize(notices(marked, run).toDF("gone_host", "gone_stream", "gone"), "notices")
    stays = F.filter("article", lambda block, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    text = (marked.join(gone, (host_of(F.col("url")) == F.col("gone_host")) & (F.col("stream") == F.col("gone_stream")), "left")
            .select("page_id", "url", F.array_join(stays, "\n").alias("text"))
            .unionByName(unique_runs(scanned.where("NOT marked"), repeats)))
    return text.withColumn("n_chars", F.length("text").cast("long"))
