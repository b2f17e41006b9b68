"""Main text of web pages by a maximum-scoring subsequence.

A page is a row of tokens: words score positive, tags negative, and one scan finds the
contiguous stretch with the highest sum. The weights of tags come from labelled pages, a
bounded sample of those with one `article` or `main` element: a tag that mostly stands
outside of it costs much, one that belongs to running text costs little. Words within
menus, forms, adverts and the like count against a stretch, and are left out of its text. Such boxes count
nothing, with their tags, where they stand inside the main element or between running text of one parent. Outside of the
main element a word in a class, id or role names such a box; inside of it headings are text whatever their name, and other
elements are such boxes only if their whole name says so. Only elements of HTML have learned weights.

The text: character references decoded, white space inside a block turned to one space,
blocks joined by a blank line. A line break inside a block is white space.

Cases: a null or empty page, or one without words, has the empty text. Markup may be cut
off or unbalanced: an end tag closes the nearest open element of its name, what has no
end tag ends with its parent, and a `<` that opens no tag is text. Pages of any
length are scanned whole. Of equally good stretches the first and longest counts. Rows are neither
dropped nor merged; other columns stay, but columns `text` and `n_chars` are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import Aside, named

#: Labelled pages that weights are learned from, at most; longer ones than this are not used.
LABELLED_PAGES = 2_000
LABELLED_CHARS = 200_000

WORD = 1.0
#: Weights of tags that no labelled page has: those of running text, and others.
UNSEEN_TEXT, UNSEEN_TAG = -0.1, -1.0
LEAST_TAG, MOST_TAG = -12.0, -0.1

#: Words of running text that one parent must have before and after a box for the box to stand within text.
BESIDE_BOX = 20

#: Elements of HTML by the part they play.
_RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|select|title|canvas|audio|video"
_BOILERPLATE = frozenset("nav header footer aside form menu dialog button label fieldset head".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_RUNNING = frozenset("a abbr b blockquote br cite code em h1 h2 h3 h4 h5 h6 i li mark ol p pre q s small span strong sub sup u ul".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words in a class, id or role that name what is not main text.
_WORDS = (
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus "
    "footer header masthead menu modal nav navbar navigation newsletter notice outbrain pagination popup promo related replies "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo"
).split()
#: Words that may stand beside them in the name of such a box, and those of them that head a text.
_BESIDE = (
    "area bar block body bottom box button buttons container content footer form group icon icons inline inner item items label left "
    "link links list main mobile module outer page panel post right row section site slot text title top unit wrap wrapper"
).split()
_HEADS = ("header", "masthead", "banner")
_NAMED = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(_WORDS)})(?:$|[\s_-])", re.IGNORECASE)
_NAMES = frozenset(_WORDS) - set(_HEADS)
_BY_NAME = _NAMES | set(_BESIDE)
#: Names that say what a wrapper has or lacks, not what it is.
_HAVING = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]\S*", re.IGNORECASE)
_PARTS = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)

#: Tags that weights are learned for; others have those of unseen tags, whatever else a table holds.
_KNOWN = _BOILERPLATE | _MAIN | _VOID | _BLOCK | _RUNNING

#: A token is (tag key or None, text, within boilerplate, within main, ends a block, of a box within text).
Token = tuple[str | None, str, bool, bool, bool, bool]


def _is_boilerplate(tag: str, rest: str, in_main: bool) -> bool:
    """Whether an element is no main text. In the main element headings never are by their name, and others
    only if all words of their class, id or role are those of such boxes: `ad-slot`, not `share price`."""
    if tag in _BOILERPLATE and not (in_main and tag == "header"):
        return True
    if not rest or tag in _MAIN or tag in ("html", "body") or (in_main and tag in _HEADINGS):
        return False
    names = [_HAVING.sub("", a or b or c) for a, b, c in _ATTRIBUTE.findall(rest)]
    if not in_main:
        return any(map(_NAMED.search, names))
    parts = [{word.lower() for word in _PARTS.findall(name)} for name in names]
    return any(own & _NAMES and own <= _BY_NAME for own in parts)


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page, each with the parts of the page that it stands in."""
    found: list[tuple[str | None, str, bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool, int]] = []  # (tag, boilerplate, main, parent of its running text)
    boiler = main = count = 0
    words: Counter[int] = Counter()  # of running text, by parent
    open_tags: Counter[str] = Counter()
    boxes: list[tuple[int, int, bool, int, int]] = []  # (first token, token after, within main, parent, words before)
    box = (0, False, 0, 0)

    def close(at: int, end: int) -> None:
        nonlocal boiler, main
        was = boiler
        for name, was_boiler, was_main, _ in stack[at:]:
            open_tags[name] -= 1
            boiler -= was_boiler
            main -= was_main
        del stack[at:]
        if was and not boiler:
            boxes.append((box[0], end, *box[1:]))

    for match in _TOKEN.finditer(page):
        text = match["text"]
        if text is not None:
            found.append((None, text, boiler > 0, main > 0, False))
            if not boiler:
                words[stack[-1][3] if stack else 0] += len(text.split())
            continue
        if match["tag"] is None:
            continue
        tag, rest = match["tag"].lower(), match["rest"]
        if match["end"]:
            at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag) if open_tags[tag] else None
            if at is not None:
                own_box = stack[at][1]
                close(at, len(found) + own_box)
            found.append(("/" + tag, "", boiler > 0, main > 0, tag in _BLOCK))
            continue
        if tag in _MAIN and boiler and stack[-1][0] not in _BOILERPLATE:
            stack = [(t, False, m, p) for t, _, m, p in stack]  # a box that was never closed
            boiler = 0
        found.append((tag, "", boiler > 0, main > 0, tag in _BLOCK))
        if tag in _VOID or rest.endswith("/"):
            continue
        if tag == "p" and stack and stack[-1][0] == "p":
            close(len(stack) - 1, len(found) - 1)
        count += 1
        parent = stack[-1][3] if stack else 0
        own = (tag, _is_boilerplate(tag, rest, main > 0), tag in _MAIN, parent if tag in _RUNNING else count)
        if own[1] and not boiler:
            box = (len(found) - 1, main > 0, parent, words[parent])
        stack.append(own)
        open_tags[tag] += 1
        boiler += own[1]
        main += own[2]
    free = bytearray(len(found))
    for first, end, inside, parent, before in boxes:
        if inside or min(before, words[parent] - before) >= BESIDE_BOX:
            free[first:end] = b"\1" * (end - first)
    return [(*token, bool(held)) for token, held in zip(found, free, strict=True)]


def count_tags(page: str | None) -> list[tuple[str, int, int]]:
    """(tag, inside, outside) of a page with one main element; none of other pages."""
    found = tokens(page or "")
    if sum(key in _MAIN for key, *_ in found if key) != 1:
        return []
    inside, outside = Counter(), Counter()
    for key, _, boiler, main, *_ in found:
        if key and not boiler:
            (inside if main and key.lstrip("/") not in _MAIN else outside)[key] += 1
    return [(key, inside[key], outside[key]) for key in inside.keys() | outside.keys()]


def learn_weights(pages: DataFrame, html: str = "html", page_id: str = "page_id", limit: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights of tags: log odds of standing inside the main element, always negative."""

    @F.pandas_udf("array<struct<tag:string,inside:long,outside:long>>")
    def counted(batch: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("tag", "inside", "outside"), row, strict=True)) for row in count_tags(page)] for page in batch])

    rows = pages.select(named(page_id).alias("page_id"), named(html).alias("html"))
    labelled = rows.where(F.lower("html").rlike("<(article|main)[ >]") & (F.length("html") <= LABELLED_CHARS))
    ids = labelled.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(limit).distinct()
    sample = labelled.join(F.broadcast(ids), "page_id", "left_semi").select(F.explode(counted("html")).alias("c")).select("c.*")
    known = F.regexp_replace("tag", "^/", "").isin(*sorted(_KNOWN))
    rows = sample.where(known).groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return {
        row["tag"]: min(MOST_TAG, max(LEAST_TAG, 2 * math.log((row["inside"] + 0.5) / (row["outside"] + 0.5)))) for row in rows
    }


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """(start, end) of the contiguous stretch with the highest sum; (0, 0) if none is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0.0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, span = total, (start, at + 1)
    return span


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of the page's best stretch."""
    found = tokens(page or "")
    scores = []
    for key, text, boiler, _, _, free in found:
        if free:
            scores.append(0.0)
        elif key is not None:
            scores.append(weights.get(key, UNSEEN_TEXT if key.lstrip("/") in _RUNNING else UNSEEN_TAG))
        else:
            words = len(text.split())
            scores.append(-WORD * words if boiler else WORD * words)
    start, end = best_stretch(scores)
    blocks, block = [], []
    for key, text, boiler, _, ends, _ in found[start:end]:
        if key is None:
            if not boiler:
                block.append(text)
        elif ends:
            blocks.append(block)
            block = []
        elif key.lstrip("/") in ("br", "td", "th"):
            block.append(" ")
    blocks.append(block)
    cleaned = (" ".join(entities.unescape("".join(parts)).split()) for parts in blocks)
    return "\n\n".join(part for part in cleaned if part)


def extract(pages: DataFrame, weights: dict[str, float], html: str = "html") -> DataFrame:
    """`pages` with the main `text` and its length `n_chars` in code points."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, weights) for page in batch], dtype=object)

    aside = Aside(pages)
    rows = aside.frame.withColumn("text", text_of(aside[html]))
    return aside.back(rows.withColumn("n_chars", F.length("text").cast("long")), ("text", "n_chars"))
