"""Splitting oversized texts at natural boundaries by packing the tree of their structure."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT, OVERLAP = 4000, 200

_LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n|$)")
_HEADINGS = (  # (pattern, how deep): the deeper, the later a text is cut there
    (re.compile(r"\s{0,3}(#{1,6})[ \t]+\S"), lambda m: len(m[1])),
    (re.compile(r"\s*<h([1-6])\b", re.I), lambda m: int(m[1])),
    (re.compile(r"\s{0,3}(={1,6})[^=\s].*?={1,6}\s*$|\s{0,3}(={2,6})\s"), lambda m: max(1, len(m[1] or m[2]) - 1)),
    (re.compile(r"\s*\\(part|chapter|section|subsection|subsubsection|paragraph)\*?\{"), lambda m: ("part", "chapter", "section", "subsection", "subsubsection", "paragraph").index(m[1]) + 1),
    (re.compile(r"(\d{1,3}(?:\.\d{1,3}){1,4})\.?[ \t]+\w[^.?!]{0,80}\s*$"), lambda m: m[1].count(".") + 1),
    (re.compile(r"(?=[^a-z\r\n]*[A-Z]{3})[A-Z][A-Z0-9 ,:/&()-]{2,80}\s*$"), lambda m: 1),
)
_OPEN = re.compile(r"\s*(?:(```+|~~~+)|<(pre|table|ul|ol|syntaxhighlight|nowiki|math)\b|(\{\|)|(\{\{\{)|\\begin\{(\w+\*?)\})", re.I)
_ITEM = re.compile(r"\s*(?:[-•+]|\*{1,4}|#{1,4}|\d{1,3}[.)]|<li\b|\\item\b)\s*\S", re.I)
_SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+(?=\S)|(?<=[。！？])")
_WORD = re.compile(r"\s+")
_BLANK = re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)[ \t]*$")
#: Depths of the tree below the six of headings.
_BLOCK, _ENTRY, _ROW, _SAYING, _GAP, _ANY = 7, 8, 9, 10, 11, 12


def _closer(m: re.Match) -> str:
    if m[1]:
        return m[1][:3]
    if m[2]:
        return f"</{m[2].lower()}"
    return "|}" if m[3] else "}}}" if m[4] else f"\\end{{{m[5]}}}"


def boundaries(text: str) -> list[tuple[int, int]]:
    """(where, depth) of the boundaries at line starts, in one pass: headings, blocks, entries of lists, rows.

    Inside fenced code, tables, lists and environments that are closed again only rows (and entries) are boundaries.
    """
    out: list[tuple[int, int]] = []
    blank, closer, opened, start = True, "", 0, 0
    for m in _LINE.finditer(text):
        if m.start() == m.end():
            break
        start, line = m.start(), m[0]
        if not line.strip():
            blank = True
            continue
        if closer:
            out.append((start, _ENTRY if _ITEM.match(line) else _ROW))
            if closer in line.lower():
                closer = ""
        else:
            depth = next((how(h) for p, how in _HEADINGS if (h := p.match(line))), 0)
            o = _OPEN.match(line)
            entry = _ITEM.match(line)
            out.append((start, min(depth, 6) or (_BLOCK if blank or o else _ENTRY if entry else _ROW)))
            if o and (end := _closer(o).lower()) not in line[o.end() :].lower():
                closer, opened = end, len(out)
        blank = False
    if closer:  # never closed: what follows is text as any other
        first = out[opened - 1][0]
        out[opened:] = [(at, _BLOCK if _BLANK.search(text[max(first, at - 200) : at]) else d) for at, d in out[opened:]]
    return out


def _glued(marks: Sequence[tuple[int, int]], end: int, limit: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(the boundaries without those directly after a heading, the spans of headings in which nothing may be cut: start, where their text begins).

    Headings that follow each other are one, as high as the highest of them, as long as they fit the limit."""
    out: list[tuple[int, int]] = []
    whole: list[tuple[int, int]] = []
    after = False  # whether the boundary before is a heading
    for at, depth in marks:
        heading = depth < _BLOCK
        if after and at - whole[-1][0] <= limit:
            whole[-1] = (whole[-1][0], at)
            out[-1] = (out[-1][0], min(out[-1][1], depth))
        else:
            if after and whole[-1][0] == out[-1][0] and whole[-1][1] == end:
                whole.pop()  # too long by itself
            out.append((at, depth))
            if heading:
                whole.append((at, end))
        after = heading
    if after and end - whole[-1][0] > limit:
        whole.pop()
    return out, whole


def _within(text: str, a: int, b: int, depth: int, marks: Sequence[tuple[int, int]], whole: Sequence[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """The packed spans of the node [a, b) at `depth`; marks: its boundaries, whole: spans that hold no cut.

    Neighbouring children are merged while they stay within the limit; the pieces of a child that does not fit are its own and merged with none
    of its siblings."""
    if b - a <= limit:
        return [(a, b)]
    if depth <= _ROW:
        here = [at for at, d in marks if d <= depth and at > a]
    elif depth == _SAYING:
        here = [m.end() for m in _SENTENCE.finditer(text, a, b) if m.end() > a]
    elif depth == _GAP:
        here = [m.end() for m in _WORD.finditer(text, a, b) if a < m.end() < b]
    else:
        here, at = [], a
        while b - at > limit:  # nothing natural: as long as possible, not between a letter and its accents or in a line end
            at += limit
            back = at
            while at - back < 20 and (0x300 <= ord(text[back]) <= 0x36F or text[back] in "‍️" or text[back - 1 : back + 1] == "\r\n"):
                back -= 1
            at = back if at - back < 20 else at
            here.append(at)
        return list(zip([a, *here], [*here, b], strict=True))
    here = sorted({x for x in here if a < x < b})
    if depth > _ROW and whole:
        kept, i = [], bisect_left(whole, (a, 0))
        for x in here:
            while i < len(whole) and whole[i][1] < x:
                i += 1
            if i == len(whole) or x <= whole[i][0]:
                kept.append(x)
        here = kept
    if not here:
        return _within(text, a, b, depth + 1, marks, whole, limit)
    spans: list[tuple[int, int]] = []
    open_, i = False, 0  # whether the last span may grow
    for lo, hi in zip([a, *here], [*here, b], strict=True):
        if hi - lo > limit:
            own: Sequence[tuple[int, int]] = ()
            if depth < _ROW:
                while i < len(marks) and marks[i][0] < lo:
                    i += 1
                j = i
                while j < len(marks) and marks[j][0] < hi:
                    j += 1
                own, i = marks[i:j], j
            spans += _within(text, lo, hi, depth + 1, own, whole, limit)
            open_ = False
        elif open_ and hi - spans[-1][0] <= limit:
            spans[-1] = (spans[-1][0], hi)
        else:
            spans.append((lo, hi))
            open_ = True
    return spans


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text longer than `limit`; each starts `overlap` before the end of the one before.

    The text's headings, blocks, entries and rows make a tree, with sentences, words and characters below; siblings are merged bottom-up
    while they fit, and only nodes that do not fit are entered. A heading stays with the text after it: a piece ends in one only if the text
    does, or if the heading alone is longer than the limit. Characters are code points.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    if len(text) <= limit:
        return [(0, len(text))]
    spans = _within(text, 0, len(text), 1, *_glued(boundaries(text), len(text), limit - overlap), limit - overlap)
    return [(max(0, a - overlap), b) for a, b in spans]


def split_oversized(df: DataFrame, text: str = "content", keep: Sequence[str] = ("chunk_id", "document_id"), limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of all rows whose `text` is longer than `limit` code points.

    Result: the columns `keep` of the row, chunk_index INT (0, 1, ... within the row), char_start and char_end INT (0-based, end
    exclusive, in the text as stored, whatever columns of that name said), and `text`, which is text[char_start:char_end]. A piece has at
    most `limit` characters and shares exactly `overlap` with the one before; without the shared ones the pieces give the whole text
    again. Rows with a NULL, empty or short text give no pieces; repeated rows give theirs again (see `dedup.last_wins`); columns
    not in `keep` are not read. Each row is cut by itself in time linear in its length; nothing is shuffled.
    """
    long = df.where(F.length(text) > limit).select(*keep, text)
    schema = T.StructType(
        [long.schema[c] for c in keep]
        + [T.StructField("chunk_index", T.IntegerType()), T.StructField("char_start", T.IntegerType()), T.StructField("char_end", T.IntegerType()), T.StructField(text, T.StringType())]
    )
    n = len(keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, index, starts, ends, out = [], [], [], [], []
            for r, value in enumerate(batch.column(n)):
                whole = value.as_py()
                for i, (a, b) in enumerate(pieces(whole, limit, overlap)):
                    rows.append(r), index.append(i), starts.append(a), ends.append(b), out.append(whole[a:b])
            kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in range(n)]
            ints = [pa.array(x, pa.int32()) for x in (index, starts, ends)]
            yield pa.RecordBatch.from_arrays([*kept, *ints, pa.array(out, pa.string())], names=schema.names)

    return long.mapInArrow(cut, schema)
