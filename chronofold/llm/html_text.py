"""Main text of web pages, from flat text blocks and a decision tree.

A page is cut at its block-level tags into flat blocks of text. Each block is
described by its number of words and link density, those of the block before
and after it, whether it is a heading, where it stands (inside an article or
main element; outside though the page has one; no such element at all), and
how many of the elements around it mark boilerplate by tag, role, class or id
(those of html, body, article and main, or around the main element, don't).
A decision tree trained on the labelled table below, and on blocks generated
by the kinds listed after it, says which blocks belong to the main text: long
text beside long text does wherever it stands, links beside links don't.

Pages are independent, so this is a map without a shuffle; markup is read in
one pass of linear time, however broken it is.

Defined results: null and empty html give an empty text; nothing is dropped
for its length or cut; repeated rows are extracted alike; an empty table stays
empty; an input column with the name of an added one gives way to it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, small_batches
from .trees import Tree

# Element names of HTML.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style title textarea iframe template svg object video audio canvas noframes xmp".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)") for tag in RAW}
#: Raw elements that are taken as empty if they never end.
EMPTY = frozenset("svg object video audio canvas template iframe textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNCLOSED = frozenset("p li dt dd option tr td th tbody thead tfoot".split())  # often without an end tag
MAIN = frozenset("article main".split())
#: Elements whose classes describe the page ("has-sidebar"), not their own text.
WHOLE = MAIN | {"html", "body"}
HIDDEN = 3
BOILERPLATE_TAGS = frozenset("nav aside footer form menu dialog select button fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Parts of class and id names.
BOILERPLATE_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc topbar header masthead footer sidebar side aside widget widgets rail related recommended recommendations share sharing social "
    "comment comments commentlist reply replies respond disqus discussion form search toolbar copyright legal disclaimer tags skip".split()
)

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    heading: bool
    inside: bool
    marks: int


def _marks(tag: str, attributes: str) -> int:
    """Whether an element marks boilerplate by its tag, role, class or id (1) or is hidden (HIDDEN)."""
    if attributes:
        lower = attributes.lower()
        if re.search(r"\bhidden\b(?!-)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", lower):
            return HIDDEN
    if tag in BOILERPLATE_TAGS:
        return 1
    if attributes:
        for name, a, b, c in ATTRIBUTE.findall(lower):
            value = a or b or c
            if name == "role" and BOILERPLATE_ROLES & set(value.split()):
                return 1
            if name in ("class", "id") and BOILERPLATE_NAMES & set(NAME_PART.findall(value)):
                return 1
    return 0


def blocks_of(html: str) -> list[Block]:
    """The page's text in flat blocks, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, int]] = []  # open elements that hold blocks: tag, marks up to here, inside the main element, boilerplate tags up to here
    is_open: Counter[str] = Counter()
    text: list[str] = []
    link_words = 0
    in_link = heading = False
    lower = None
    unended: set[str] = set()  # raw elements without a further end tag

    def end_block() -> None:
        nonlocal link_words
        joined = " ".join("".join(text).split())
        if joined:
            marks, inside = stack[-1][1:3] if stack else (0, False)
            out.append(Block(joined, joined.count(" ") + 1, link_words, heading, inside, marks))
        text.clear()
        link_words = 0

    def add(piece: str) -> None:
        nonlocal link_words
        piece = unescape(piece) if "&" in piece else piece
        text.append(piece)
        if in_link:
            link_words += len(piece.split())

    def close(k: int) -> None:
        is_open.subtract(name for name, *_ in stack[k:])
        del stack[k:]

    at, n = 0, len(html)
    while at < n:
        to = html.find("<", at)
        if to < 0:
            add(html[at:])
            break
        if to > at:
            add(html[at:to])
        if html.startswith("<!--", to):
            end = html.find("-->", to + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), to):
            end = html.find(">", to)
            at = n if end < 0 else end + 1
            continue
        match = TAG.match(html, to) or LOOSE_TAG.match(html, to)
        if not match:
            add("<")
            at = to + 1
            continue
        at = match.end()
        closing, tag, attributes = match[1], match[2].lower(), match[3]
        if tag in RAW and not closing:
            if attributes.endswith("/") and tag not in ("script", "style"):
                continue
            if lower is None:
                lower = html.lower()
                if len(lower) != n:  # some capitals lower to two characters
                    lower = re.sub("[A-Z]", lambda m: m[0].lower(), html)
            found = None if tag in unended else RAW_END[tag].search(lower, at)
            if not found:
                if tag in EMPTY:
                    unended.add(tag)
                    continue
                at = n
                continue
            end = html.find(">", found.end())
            at = n if end < 0 else end + 1
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCKS:
            if tag in ("img", "input", "wbr") or tag in VOID:
                text.append("" if tag == "wbr" else " ")
            continue
        end_block()
        in_link = False
        if tag in HEADINGS:
            heading = not closing
        if closing:
            if is_open[tag]:  # else the search would go through all that is open, again and again
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
        elif tag not in VOID:
            if tag in UNCLOSED:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)  # the one before ends here
                        break
                    if stack[k][0] not in UNCLOSED:
                        break
            marks, inside, plain = stack[-1][1:] if stack else (0, False, 0)
            own = _marks(tag, attributes)
            if tag == "header" and not inside:
                own = max(1, own)
            if tag in WHOLE and not inside:
                own = HIDDEN if own == HIDDEN else 0
                if tag in MAIN and marks < HIDDEN:  # what encloses all of the main text says nothing about its parts
                    marks = plain
            stack.append((tag, marks + own, inside or tag in MAIN or "itemprop=\"articleBody\"" in attributes, plain + (tag in BOILERPLATE_TAGS)))
            is_open[tag] += 1
    end_block()
    return out


FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "heading", "place", "marks")


def features_of(blocks: list[Block]) -> np.ndarray:
    words = np.array([0, *(b.words for b in blocks), 0], dtype=np.float64)
    links = np.array([0, *(min(1.0, b.link_words / b.words) for b in blocks), 0])
    has_main = any(b.inside for b in blocks)
    place = np.array([1 if b.inside else -1 if has_main else 0 for b in blocks], dtype=np.float64)
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], [b.heading for b in blocks], place, [min(3, b.marks) for b in blocks]]).astype(np.float64)


#: Labelled blocks: words, link density, both of the block before, both of the block after, heading, place, marks; 1: main text.
LABELLED = """
  9 0.00   0 0.00  80 0.00 1  1 0   1
 50 0.60  20 0.00  20 1.00 0  1 0   1
 12 0.00  10 0.00   6 1.00 0  1 0   1
 25 0.00  12 0.00   1 1.00 0  1 0   1
  7 0.65  20 0.00  30 0.70 0  1 0   1
 35 0.80   5 0.00   5 0.00 0  1 0   1
120 0.00  30 0.00   3 1.00 0  1 0   1
 18 0.00   6 1.00   6 1.00 0  1 0   1
  3 0.00   2 0.00   2 1.00 0  1 0   1
  8 0.80   2 1.00   2 1.00 0  1 0   0
  2 0.60   1 1.00   4 0.60 0  1 0   0
  2 0.00   3 0.00   4 0.00 0  1 0   1
  1 0.00   2 0.00   3 0.00 0  1 0   1
  1 0.00   9 0.00   1 0.00 0  1 0   1
  2 1.00   5 0.00   2 1.00 0  1 0   0
  4 0.00   2 1.00   2 1.00 0  1 0   0
  5 0.90   1 1.00   1 1.00 0  1 0   0
  3 0.00   0 0.00   0 0.00 0  1 0   1
  1 1.00   1 1.00   1 1.00 0  1 0   0
  6 0.70   8 0.00  12 0.00 0  1 0   1
 10 0.00  40 0.00   2 1.00 0  1 0   1
 30 0.30  60 0.40  80 0.50 0  1 0   1
 16 0.00   2 1.00  50 0.00 0  1 0   1
 14 0.00   1 1.00   9 0.00 0  1 0   1
 12 0.00  30 0.00   0 0.00 0  1 0   1
 45 0.00  30 0.00   0 0.00 0  1 0   1
  3 0.00 200 0.00   2 0.00 1  1 0   1
 80 0.00   9 0.00  65 0.00 0  1 0   1
 65 0.00  80 0.00   4 0.00 0  1 0   1
  4 0.00  65 0.00 120 0.00 0  1 0   1
  1 0.00 120 0.00  30 0.00 0  1 0   1
  2 0.00  12 0.00   0 0.00 0  1 0   1
  6 0.00  70 0.00  40 0.00 1  1 0   1
 40 0.05   6 0.00  25 0.20 0  1 0   1
 25 0.20  40 0.05  33 0.00 0  1 0   1
300 0.01  25 0.20  90 0.00 0  1 0   1
  3 1.00  90 0.00  50 0.00 0  1 0   1
 12 0.50  50 0.00  60 0.00 0  1 0   1
  8 0.00   1 1.00  20 0.00 0  1 0   1
 15 0.00  10 0.00   5 0.00 0  1 0   1
  1 1.00   0 0.00   1 1.00 0 -1 1   0
  1 1.00   1 1.00   1 1.00 0 -1 1   0
  2 1.00   1 1.00  14 0.00 0 -1 2   0
 14 0.00   2 1.00   9 0.00 0 -1 1   0
 60 0.00   2 1.00   9 0.00 0 -1 1   0
 12 0.00  30 0.00   0 0.00 0 -1 1   0
 45 0.00  30 0.00   0 0.00 0 -1 1   0
  3 0.00   0 0.00   9 0.00 0 -1 0   0
 20 0.10   3 0.00   9 0.00 0 -1 0   0
  8 0.00   0 0.00  90 0.00 1 -1 0   0
 70 0.00   3 0.00   4 1.00 0 -1 0   0
  5 0.00  40 0.00  22 0.00 1  1 1   0
 22 0.00   5 0.00  18 0.00 0  1 1   0
 18 0.00  22 0.00   0 0.00 0  1 1   0
 90 0.00  60 0.00  18 0.00 0  1 1   1
  2 0.50  60 0.00   2 1.00 0  1 2   0
  4 1.00  80 0.00   4 1.00 0  1 1   0
 50 0.00   4 1.00   7 0.00 0  1 2   0
  1 1.00   0 0.00   1 1.00 0  0 1   0
  2 1.00   1 1.00  10 0.00 0  0 1   0
 16 0.00   2 1.00  50 0.00 0  0 1   0
 55 0.00  16 0.00  50 0.00 0  0 1   1
120 0.00  40 0.00   0 0.00 0  0 2   1
  1 1.00   2 1.00   1 1.00 0  0 0   0
  3 1.00   1 1.00   2 1.00 0  0 0   0
  2 0.00   1 1.00   1 1.00 0  0 0   0
  5 0.80   3 1.00   6 0.70 0  0 0   0
  4 0.00   0 0.00   2 1.00 0  0 0   0
  5 1.00  30 0.00  40 0.00 0  0 0   0
  8 0.90  60 0.00  50 0.00 0  0 0   0
 14 0.80   5 0.00   2 0.00 0  0 0   0
 30 0.90  10 0.00  12 0.00 0  0 0   0
  3 1.00   0 0.00  90 0.00 0  0 0   0
 22 0.75  12 0.00  40 0.00 0  0 0   0
  2 1.00  80 0.00  80 0.00 0  0 0   0
 60 0.70   3 0.00   3 0.00 0  0 0   0
  9 0.60   0 0.00   8 0.00 0  0 0   0
  6 0.60  30 0.00   0 0.00 0  0 0   0
 10 0.00   0 0.00  85 0.00 1  0 0   1
  7 0.00   2 1.00  60 0.00 1  0 0   1
 85 0.00  10 0.00  44 0.00 0  0 0   1
 44 0.02  85 0.00   6 0.00 0  0 0   1
  6 0.00  44 0.02  70 0.00 0  0 0   1
  2 0.00  50 0.00  90 0.00 0  0 0   1
 70 0.00   6 0.00  20 0.10 0  0 0   1
 20 0.10  70 0.00  11 0.00 0  0 0   1
 11 0.00  20 0.10  35 0.00 0  0 0   1
 35 0.25  11 0.00  18 0.00 0  0 0   1
 18 0.00  35 0.25   3 1.00 0  0 0   1
150 0.00   2 1.00   3 1.00 0  0 0   1
 30 0.00   0 0.00   0 0.00 0  0 0   1
  8 0.00   0 0.00   0 0.00 0  0 0   1
"""


#: Kinds of blocks that text features tell apart, whatever encloses them. Least and most: words, link density, both of the block before, both of the block after, heading, place, marks; 1: main text.
KINDS = (
    # long text beside long text, also under marks or outside the article
    ((40, 300), (0, 0.2), (40, 300), (0, 0.2), (0, 300), (0, 1), (0, 0), (-1, 1), (0, 2), 1),
    ((40, 300), (0, 0.2), (0, 300), (0, 1), (40, 300), (0, 0.2), (0, 0), (-1, 1), (0, 2), 1),
    # hidden, or text under marks or outside the article that isn't long, or stands alone
    ((1, 300), (0, 1), (0, 300), (0, 1), (0, 300), (0, 1), (0, 0), (-1, 1), (3, 3), 0),
    ((1, 38), (0, 1), (0, 300), (0, 1), (0, 300), (0, 1), (0, 1), (-1, 1), (1, 2), 0),
    ((1, 38), (0, 1), (0, 300), (0, 1), (0, 300), (0, 1), (0, 1), (-1, -1), (0, 0), 0),
    ((1, 38), (0, 0.3), (20, 300), (0, 0.3), (0, 300), (0, 1), (0, 0), (-1, 1), (1, 2), 0),
    ((1, 38), (0, 0.3), (20, 300), (0, 0.3), (0, 300), (0, 1), (0, 0), (-1, -1), (0, 0), 0),
    ((1, 38), (0, 0.3), (0, 300), (0, 1), (20, 300), (0, 0.3), (0, 0), (-1, 1), (1, 2), 0),
    ((1, 38), (0, 0.3), (0, 300), (0, 1), (20, 300), (0, 0.3), (0, 0), (-1, -1), (0, 0), 0),
    ((40, 300), (0, 0.2), (40, 300), (0, 0.2), (0, 300), (0, 1), (0, 0), (-1, 1), (3, 3), 0),
    ((40, 300), (0, 0.2), (0, 300), (0, 1), (40, 300), (0, 0.2), (0, 0), (-1, 1), (3, 3), 0),
    ((40, 150), (0, 1), (0, 38), (0, 1), (0, 38), (0, 1), (0, 0), (-1, 1), (1, 2), 0),
    ((40, 150), (0, 1), (0, 38), (0, 1), (0, 38), (0, 1), (0, 0), (-1, -1), (0, 0), 0),
    # links beside links, and the short text among them, also inside the article
    ((1, 12), (0.75, 1), (1, 12), (0.75, 1), (0, 300), (0, 1), (0, 0), (-1, 1), (0, 2), 0),
    ((1, 12), (0.75, 1), (0, 300), (0, 1), (1, 12), (0.75, 1), (0, 0), (-1, 1), (0, 2), 0),
    ((1, 5), (0, 0.3), (1, 12), (0.75, 1), (1, 12), (0.75, 1), (0, 1), (-1, 1), (0, 2), 0),
    # text inside the article, short or with a link, beside text
    ((1, 300), (0, 0.5), (0, 300), (0, 0.4), (0, 300), (0, 0.4), (0, 1), (1, 1), (0, 0), 1),
    ((7, 300), (0, 0.5), (0, 300), (0, 0.4), (0, 300), (0, 0.4), (0, 1), (0, 0), (0, 0), 1),
    ((1, 60), (0.5, 1), (6, 300), (0, 0.4), (6, 300), (0, 0.4), (0, 0), (1, 1), (0, 0), 1),
    ((7, 300), (0, 0.5), (0, 300), (0, 1), (0, 300), (0, 1), (0, 1), (1, 1), (0, 0), 1),
)


def labelled_blocks(each: int = 400, seed: int = 9) -> np.ndarray:
    """The labelled table and, from a seed, as many rows of each kind."""
    random = np.random.default_rng(seed)
    rows = [np.array([line.split() for line in LABELLED.strip().splitlines()], dtype=np.float64)]
    for *ranges, label in KINDS:
        columns = []
        for k, (least, most) in enumerate(ranges):
            if k in (0, 2, 4):  # words: spread over their powers
                columns.append(np.clip(np.round(np.exp(random.uniform(np.log(least + 0.6), np.log(most + 0.6), each))), least, most))
            elif k in (1, 3, 5):  # link density: often none or all
                columns.append(np.clip(random.uniform(least - 0.3, most + 0.3, each), least, most))
            else:
                columns.append(random.integers(least, most + 1, each))
        rows.append(np.column_stack([*columns, np.full(each, label)]))
    return np.concatenate(rows)


def train_tree(depth: int = 10) -> Tree:
    rows = labelled_blocks()
    return Tree.grow(rows[:, :-1], rows[:, -1], depth)


def main_text(html: str | None, tree: Tree) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    keep = tree.predict(features_of(blocks)) >= 0.5
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_main_text(pages: DataFrame, html_column: str = "html", text_column: str = "text", columns: list[str] | None = None) -> DataFrame:
    """`columns` (all but the html by default), the main text and its number of code points, n_chars."""
    columns = [c for c in pages.columns if c != html_column] if columns is None else columns
    columns = [c for c in columns if c.lower() not in (text_column.lower(), "n_chars")]
    tree = train_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, tree) for h in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*columns, text_column, "n_chars"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*[F.col(f"`{c}`") for c in columns]).schema)
    return small_batches(pages).select(html_column, *[F.col(f"`{c}`") for c in columns]).mapInArrow(frugal(run), f"{kept}`{text_column}` string, n_chars bigint")
