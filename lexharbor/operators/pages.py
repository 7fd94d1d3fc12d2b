"""Pages of extracted manuals: which are read, their code lines, and the repair of code whose blanks were lost."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: parts of the names of fonts in which code is set.
CODE_FONT = "Mono|Courier|(?i:mono)|Code"


class PdfReader(Protocol):
    """What a reader of PDF files gives; none is part of this library."""

    def pages(self, path: str) -> list[tuple[int, str]]:
        """(page from 1, Markdown) of each page."""

    def words(self, path: str) -> list[tuple[int, str, float, float, str]]:
        """(page, text, x0, top, fontname) of each word."""


def kept_pages(pages: DataFrame, skip: list[int], page: str = "page") -> DataFrame:
    """The pages that are not skipped; a NULL page number is not in the list and stays."""
    return pages.where(F.coalesce(~F.col(page).isin(*skip), F.lit(True))) if skip else pages


def code_lines(words: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, page, y, line: the words of each line from left to right, of lines whose first word is in a font for code. A line is what has the
    same top rounded half to even; words at the same place are ordered by their text."""
    line = F.array_sort(F.collect_list(F.struct("x0", "text", "fontname")))
    rows = words.groupBy(doc, "page", F.bround("top").cast("int").alias("y")).agg(line.alias("w"))
    return rows.where(F.col("w")[0]["fontname"].rlike(CODE_FONT)).select(doc, "page", "y", F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("line"))


_BLOCK = re.compile(r"```\n(.*?)\n```", re.S)


class CodeLines:
    """The code lines of a page, found by what they are without white space: sorted, so that a line and the lines that go on from it are
    neighbours."""

    def __init__(self, lines: list[str]):
        keyed = sorted(("".join(x.split()), at) for at, x in enumerate(lines))
        keyed = keyed[bisect_left(keyed, ("", len(lines))) :]  # blank lines stand first
        self.lines, self.keys, self.order = lines, [k for k, _ in keyed], [at for _, at in keyed]

    def mended(self, line: str) -> str:
        """The line as it stands on the page: the last that is the same but for white space, else the first that goes on from it, cut where it
        ends; characters other than the blank are counted for that. A line that is on no page stays."""
        key = "".join(line.split())
        lo, same = bisect_left(self.keys, key), bisect_right(self.keys, key)
        if not key:
            return line
        if same > lo:
            return self.lines[self.order[same - 1]]
        longer = self.order[lo : bisect_right(self.keys, key + chr(0x10FFFF))]
        if not longer:
            return line
        full = self.lines[min(longer)]
        return full[: list(accumulate(x != " " for x in full)).index(len(key)) + 1]


def mend_code(md: str, lines: list[str]) -> str:
    """The Markdown with the lines of its plain code blocks as they stand among `lines`; other blocks stay."""
    page = CodeLines(lines)
    if not page.keys:
        return md
    out, at = [], 0
    for block in _BLOCK.finditer(md):
        inner = block.span(1)
        out += [md[at : inner[0]], "\n".join(page.mended(x) for x in block[1].splitlines())]
        at = inner[1]
    return "".join([*out, md[at:]])


def mended_pages(pages: DataFrame, lines: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, page, md: each page, the code in it mended by the page's `code_lines` (doc, page, y, line). Both are grouped by page, so what a task
    holds is a page at a time."""
    of_page = lines.groupBy(doc, "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "line"))), lambda x: x["line"]).alias("lines"))

    @F.arrow_udf(StringType())
    def fix(md: pa.Array, known: pa.Array) -> pa.Array:
        return pa.array([None if m is None else mend_code(m, k or []) for m, k in zip(md.to_pylist(), known.to_pylist(), strict=True)], pa.string())

    return pages.join(of_page, [doc, "page"], "left").select(doc, "page", fix("md", "lines").alias("md"))


def join_pages(pages: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, md: the pages of each document in their order, joined by a blank line."""
    return pages.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "md"))), lambda x: x["md"]), "\n\n").alias("md"))


def extract(pages: DataFrame, words: DataFrame, skip: list[int] = [], doc: str = "doc") -> DataFrame:  # noqa: B006
    """doc, md: the Markdown of each document from its pages (doc, page, md) and their words: pages to skip left out, code mended, pages joined."""
    return join_pages(mended_pages(kept_pages(pages, skip), code_lines(kept_pages(words, skip), doc), doc), doc)
