"""Positioned spans from web pages. The tags of a page are walked by a stack automaton that yields its blocks, lines and
spans: a block-level tag or a break ends a line, inline elements stay on the line of their block, list items begin with a
marker, and the cells of a table's row stand side by side as columns. What is in nav or aside runs down a side column, all
else down the main one. All text is read but that of scripts, styles, the title and comments.

Elements end as in a browser where their end tag is left out: a paragraph at the next block, a list item at the next item
of its list, a cell or row at the next one of its table; an element that ends takes along all that is open within it. Blanks
between inline elements are spans of their own, as lines join spans without a separator."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNREAD = (r"(?is)<script[^>]*>.*?</script\s*>", r"(?is)<style[^>]*>.*?</style\s*>", r"(?is)<title[^>]*>.*?</title\s*>", r"(?s)<!--.*?-->", r"<[!?][^>]*>")
TOKEN = r"<(/?[A-Za-z][A-Za-z0-9]*)[^>]*>|(<?[^<]+)"
BLANKS = r"[ \t\r\n\f]+"
BLOCKS = "address article aside blockquote body caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
VOID = "area base br col embed hr img input link meta source track wbr".split()
SIDE, CELLS, BOLD = ["aside", "nav"], ["td", "th"], ["b", "strong", "th"]
#: What a block ends when it starts, and the elements that keep it from those further out. Every block ends a paragraph.
ENDS = {"li": (["li"], ["ol", "ul"]), "dt": (["dt", "dd"], ["dl"]), "dd": (["dt", "dd"], ["dl"]), "td": (CELLS, ["table"]), "th": (CELLS, ["table"]), "tr": (["tr"], ["table"])}
#: End tags that reach out of a cell.
OUTER = ["body", "html", "table", "tbody", "td", "tfoot", "th", "thead", "tr"]
MARKER = "\u2022 "
#: Font size by the innermost of these elements.
SIZES = {"h1": 20.0, "h2": 16.0, "h3": 14.0, "h4": 13.0, "h5": 12.0, "h6": 11.5, "p": 11.0, "li": 10.0, "td": 10.0, "th": 10.0, "footer": 8.0}
SIZE = 9.0
#: Blocks that keep a distance from what is above and below. Heights count in quarters of a line.
SPACED = "blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split()
STEP, SPACE, PAGE_STEPS, TOP, QUARTER = 4, 3, 180, 40.0, 4.0
SIDE_EDGE, MAIN_EDGE, CELL, CELLS_APART, RIGHT = 36.0, 160.0, 100.0, 4, 576.0
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
SCHEMA = "document_id string, page int, ord int, text string, x double, y double, width double, height double, font_size double, bold boolean, block int, tag string"
_TYPES = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}


Stack = tuple[str, ...]


def _last(stack: Stack, names) -> int:
    """The place after the last of some elements; 0 if none is open."""
    return next((i for i in range(len(stack), 0, -1) if stack[i - 1] in names), 0)


def _ended(stack: Stack, names, within) -> Stack:
    """The stack without the last of some elements and what is in it, unless one of `within` is open inside it."""
    at = _last(stack, names)
    return stack[: at - 1] if at > _last(stack, within) else stack


@lru_cache(1 << 14)
def _started(stack: Stack, tag: str) -> Stack:
    if tag in BLOCKS:
        stack = _ended(stack, ["p"], CELLS)
        if tag in ENDS:
            stack = _ended(stack, *ENDS[tag])
    return stack if tag in VOID else (*stack, tag)


@lru_cache(1 << 14)
def _closed(stack: Stack, tag: str) -> Stack:
    return _ended(stack, [tag], BLOCKS if tag not in BLOCKS else [] if tag in OUTER else CELLS)


@lru_cache(1 << 14)
def _style(stack: Stack) -> tuple[bool, bool, str, float, bool]:
    """Whether text is in the side column and in a cell, its block's element, font size and weight."""
    block, sized = _last(stack, BLOCKS), _last(stack, SIZES)
    return _last(stack, SIDE) > 0, _last(stack, CELLS) > 0, stack[block - 1] if block else "", SIZES[stack[sized - 1]] if sized else SIZE, _last(stack, BOLD) > 0


def walk(tokens: list[tuple[str, str]]) -> Iterator[tuple]:
    """tokens: tag ("/p" ends one) or text. text, block, tag, height, column (None in the side column, else 0 or the cell's
    number), font size and weight of each span."""
    stack: Stack = ()
    block, line, cell, row = 0, 0, -1, 0
    ends, spaced, marked, opened, in_side = True, False, False, False, False  # a line is to start, at a distance; it has only a marker; a cell began
    used = {False: -STEP, True: -STEP}  # the last line's height, by whether it is in the side column
    for tag, text in tokens:
        tag = tag.lower()
        spaced = spaced or tag.removeprefix("/") in SPACED
        if tag.startswith("/"):
            stack = _closed(stack, tag[1:])
            if tag[1:] in BLOCKS:
                ends, marked, block = True, False, block + 1
            continue
        if tag:
            stack = _started(stack, tag)
            if tag in ("table", "tr"):
                row, cell = used[False] + STEP, -1
            if tag in CELLS:
                cell, opened = cell + 1, True
            if tag == "br":
                ends, marked = True, False
            if tag not in BLOCKS or (marked and tag != "li"):
                continue
            ends, marked, block = True, False, block + 1
            if tag != "li":
                continue
            text = MARKER
        else:
            text = re.sub(BLANKS, " ", text)
            if ends or marked:
                text = text.lstrip(" ")
            if not text:
                continue
        side, in_cell, element, size, bold = _style(stack)
        in_cell = in_cell and not side
        if ends:
            above = line if in_cell and not in_side else used[side]
            line = row if in_cell and opened else above + STEP + SPACE * (spaced and above >= 0)
            used[side] = max(used[side], line)
        ends, spaced, opened, in_side, marked = False, False, False, side, bool(tag)
        yield text, block, element, line, None if side else cell if in_cell else 0, size, bold


def _placed(document_id: str, tokens: list[tuple[str, str]]) -> Iterator[tuple]:
    """Rows of SCHEMA: spans of a line from the left, lines downwards over pages."""
    at, x = None, 0.0
    for ord_, (text, block, tag, line, column, size, bold) in enumerate(walk(tokens)):
        for entity, sign in ENTITIES:
            text = text.replace(entity, sign)
        if at != (line, column):
            at, x = (line, column), SIDE_EDGE if column is None else MAIN_EDGE + CELL * min(column, CELLS_APART)
        width = len(text) * size * 0.5
        yield document_id, 1 + line // PAGE_STEPS, ord_, text, min(x, RIGHT), TOP + QUARTER * (line % PAGE_STEPS), min(width, RIGHT - min(x, RIGHT)), size, size, bold, block, tag
        x += width


def spans(pages: DataFrame) -> DataFrame:
    """document_id, page, ord, text, x, y, width, height, font_size, bold, block (its number), tag (its block's element),
    font_name, modality, page_width, page_height. A page without text has no spans."""
    html = F.coalesce("html", F.lit(""))
    for pattern in UNREAD:
        html = F.regexp_replace(html, pattern, " ")

    def read(batches):
        names = [c.split(" ") for c in SCHEMA.split(", ")]
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64).to_pydict()
                rows = [r for i, h in zip(part["document_id"], part["html"], strict=True) for r in _placed(i, re.findall(TOKEN, h))]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, names, strict=True)], names=[n for n, _ in names])

    rows = pages.select(F.col("page_id").cast("string").alias("document_id"), html.alias("html")).mapInArrow(read, SCHEMA)
    return rows.select("*", F.lit("Web").alias("font_name"), F.lit("native").alias("modality"), F.lit(612.0).alias("page_width"), F.lit(792.0).alias("page_height"))


def titles(pages: DataFrame) -> DataFrame:
    """document_id, title: the title element, if it could name a document."""
    raw = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    for entity, sign in ENTITIES:
        raw = F.replace(raw, F.lit(entity), F.lit(sign))
    title = F.trim(F.regexp_replace(raw, r"\s+", " "))
    rows = pages.select(F.col("page_id").cast("string").alias("document_id"), title.alias("title"))
    return rows.where(usable(F.col("title")))


def usable(title: F.Column) -> F.Column:
    """Whether a title could name a document."""
    return (F.length(title) >= 12) & (F.size(F.split(title, " ")) >= 2) & ~is_junk(title)


#: Names that tools give, not authors.
JUNK = (r"(?i)^(untitled|no title|document\s*\d*|slide\s*\d+|print job|chapter\s*\d+)", r"(?i)^microsoft\s+(word|powerpoint|excel)\b", r"\.[A-Za-z0-9]{2,6}\s*$", r"(?i)text_all|final[_ ]?draft|^copy of", r"(?i)^[a-z0-9_\-]{1,20}$")


def is_junk(title: F.Column) -> F.Column:
    out = F.lit(False)
    for pattern in JUNK:
        out |= title.rlike(pattern)
    return out
