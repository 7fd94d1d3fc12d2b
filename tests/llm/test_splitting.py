import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.llm.splitting import _BLOCK, boundaries, pieces, split_oversized

PART = st.sampled_from(["# Head\n", "2.4 Merge key table\n\n", "A sentence here. ", "• item one\n", "\n\n", "\r\n", "word ", "x" * 70, "```\ncode a\n\ncode b\n```\n", "é" * 3, "```\n", "日本。", "\\section{A}\n", "<ul>\n<li>a</li>\n</ul>\n", "\r"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PART, max_size=120), st.integers(20, 300), st.integers(0, 15))
def test_limit_overlap_and_round_trip(parts, limit, overlap):
    text = "".join(parts)
    got = pieces(text, limit, overlap)
    if len(text) <= limit:
        assert got == [(0, len(text))]
        return
    assert got[0][0] == 0 and got[-1][1] == len(text) and len(got) > 1
    assert all(0 < b - a <= limit for a, b in got)
    assert all(nxt[0] == max(0, prev[1] - overlap) and nxt[1] > prev[1] for prev, nxt in zip(got, got[1:]))
    assert "".join(text[max(a, prev): b] for (a, b), prev in zip(got, [0, *[b for _, b in got]])) == text


def test_cuts_at_headings_then_blocks_then_sentences():
    section = lambda n: f"## Part {n}\n\n" + "\n\n".join(f"Sentence {i} of it is here. And one more follows it." for i in range(12)) + "\n\n"
    text = "".join(section(n) for n in range(6))
    ends = [b for _, b in pieces(text, 900, 50)][:-1]
    assert all(text[b:].startswith("## Part") for b in ends)
    long = "One sentence stands here. " * 100
    assert all(long[b - 2 : b] == ". " for _, b in pieces(long, 300, 20)[:-1])
    fence = "```\n" + "\n\n".join(f"code {i}" for i in range(20)) + "\n```\n"
    text = ("Some words of prose. " * 5 + "\n\n" + fence + "\n") * 5
    assert all(text[:b].count("```") % 2 == 0 for _, b in pieces(text, 450, 20))


def test_no_boundary_at_all_and_very_long():
    got = pieces("x" * 100_000, 4000, 200)
    assert len(got) == 27 and all(b - a <= 4000 for a, b in got)
    words = "word " * 400_000
    assert all(words[b - 1] == " " for _, b in pieces(words))
    unclosed = "```\n" + "line of code\n\n" * 50_000
    assert all(unclosed[b - 1] == "\n" for _, b in pieces(unclosed))


def test_rows(spark):
    text = "\n\n".join(f"Paragraph {i} has words. " * 9 for i in range(60))
    rows = [("a", "d", text, "x"), ("a", "d", text, "x"), ("b", "d", "short", "x"), ("n", None, None, "x"), ("e", "d", "", "x"), ("f", "d", "y" * 4000, "x"), ("g", "d", "𝔘" * 4001, "x")]
    df = spark.createDataFrame(rows, "chunk_id string, document_id string, content string, char_start string")
    got = split_oversized(df).collect()
    assert {r.chunk_id for r in got} == {"a", "g"}
    for r in got:
        whole = text if r.chunk_id == "a" else "𝔘" * 4001
        assert r.content == whole[r.char_start : r.char_end] and len(r.content) <= 4000
    assert [r.chunk_index for r in got if r.chunk_id == "g"] == [0, 1]
    assert sum(r.chunk_id == "a" and r.chunk_index == 0 for r in got) == 2
    assert split_oversized(df.limit(0)).count() == 0
    assert re.search(r"words\. $|\n$", next(r.content for r in got if r.chunk_id == "a"))


def _last_line_is_heading(text, start, end):
    """Whether the last line of text[start:end] that is not blank is a heading of the text, and text follows it."""
    marks = [m for m in boundaries(text) if m[0] < end]
    return bool(marks) and marks[-1][1] < _BLOCK and bool(text[end:].strip())


@settings(max_examples=300, deadline=None)
@given(st.lists(PART | st.sampled_from(["## Which one is it?\n", "<h2>Head</h2>\n", "=== Head ===\n", "Many words. " * 9, "many words " * 9 + "\n\n"]), min_size=20, max_size=120))
def test_no_piece_ends_in_a_heading(parts):
    text = "".join(parts)
    runs = [len(run) for run in re.findall(r"(?:[^\S\r\n]*(?:#+ Head|## Which one is it\?|2\.4 Merge key table|\\\\section\{A\}|<h2>Head</h2>|=== Head ===)\s*)+", text)]
    if len(text) > 300 and max(runs, default=0) < 150:
        assert not any(_last_line_is_heading(text, a, b) for a, b in pieces(text, 300, 10)[:-1])


def test_heading_goes_with_its_text():
    body = "Some words of it stand here. " * 30
    text = f"# Title one\n\n{body}\n\n# Title two\n\n{body}\n\n# Title three\n\n## Which?\n\n{body}"
    got = [text[a:b] for a, b in pieces(text, 600, 0)]
    assert [p.split("\n")[0] for p in got if p.startswith("# ")] == ["# Title one", "# Title two", "# Title three"]
    assert not any(re.search(r"(?:# Title \w+|## Which\?)\s*$", p) for p in got)


@pytest.mark.parametrize("unit", ["```\n\n", "<pre>\nx\n\n", "# Head\n", "= a ", " ", "\n", "A B", "word. ", "1.1 ", "\\begin{x}\n"])
def test_time_is_linear(unit):
    def seconds(n):
        took = []
        for _ in range(2):
            start = time.perf_counter()
            pieces("```x\n" + "line of code\n" * (n // 13) if unit == "```\n\n" else unit * (n // len(unit)))
            took.append(time.perf_counter() - start)
        return min(took)

    short = seconds(200_000)
    assert seconds(800_000) < 9 * short + 0.3
