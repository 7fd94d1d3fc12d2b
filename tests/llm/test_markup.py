import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.llm.markup import FEATURES, KINDS, SHALLOW, clean, clean_markup, features, grow, labelled, train
from tests.llm.markup_held_out import HELD_OUT


@pytest.fixture(scope="module")
def trees():
    return train()


def _right(trees, documents):
    """(blocks, those whose markup is told right, those whose kind is)."""
    n = marks = kinds = 0
    for lines, mark, kind in documents:
        m, k = trees(lines)
        n, marks, kinds = n + len(mark), marks + int((m == mark).sum()), kinds + int((k == kind).sum())
    return n, marks, kinds


def test_trees_know_their_table(trees):
    n, marks, kinds = _right(trees, labelled())
    assert marks > 0.98 * n and kinds > 0.97 * n


def test_held_out_text_in_other_words(trees):
    n, marks, kinds = _right(trees, labelled(HELD_OUT))
    assert n > 80 and marks >= 0.97 * n and kinds >= 0.9 * n


def test_documents_left_out():
    documents = labelled()
    n = marks = 0
    for i in range(6):
        got = _right(train([d for j, d in enumerate(documents) if j % 6 != i], rounds=6), documents[i::6])
        n, marks = n + got[0], marks + got[1]
    assert marks > 0.95 * n


def test_verdicts_hang_on_link_density_and_on_the_neighbours(trees):
    assert not any(w in name for name in FEATURES[:SHALLOW] for w in ("mark", "hash", "star", "equals", "rule", "row", "pieces"))
    x = np.concatenate([features(d[0]) for d in labelled()])
    was, rng = trees.verdicts(x)[0], np.random.default_rng(1)
    changed = {}
    for i, name in enumerate(FEATURES[:SHALLOW]):
        y = x.copy()
        y[:, i] = rng.permutation(y[:, i])
        changed[name] = int((trees.verdicts(y)[0] != was).sum())
    assert changed["link"] > 0.2 * len(x) and changed["lead"] > 0.05 * len(x)
    assert sum(changed[n] for n in ("words_before", "words_after", "code_before", "code_after", "link_before", "link_after", "lead_before", "lead_after")) > 20


@pytest.mark.parametrize("heading", ["== Merge cell range ==", "=== Merge cell range ===", "## Merge cell range", "#### Merge cell range"])
@pytest.mark.parametrize("after", ["    Loop nRow = 1 to nLast step 3", "Return aList[aRow[4]]", "", " The range is merged at once, whatever it holds."])
def test_heading_before_code_or_text(trees, heading, after):
    found, got, blocks = clean(f"{heading}\n\n{after}", trees)
    assert found and blocks[0] == ("heading", "Merge cell range")


def test_neighbours_are_in_the_features():
    x = features(["one two three", "", "<b>four</b> five", "six"])
    get = lambda row, name: x[row, FEATURES.index(name)]
    assert [get(1, n) for n in ("words", "words_before", "words_after")] == [2, 3, 1]
    assert get(0, "link_after") == get(1, "link") > 0.4 and get(1, "link_before") == 0 and get(1, "blank_before") == 1 and get(2, "blank_before") == 0
    assert features([]).shape == (0, len(FEATURES)) == features(["", " "]).shape


@pytest.mark.parametrize("at", [0, 50, 95, 100])
def test_long_line_counts_wherever_its_signs_stand(at):
    words = ["word"] * 300
    words[3 * at : 3 * at] = ["nRow", ":=", "f(aList[7])", "×", "12"] * 6
    got = dict(zip(FEATURES, features([" ".join(words)])[0].tolist(), strict=True))
    assert got["words"] == 330 and got["code"] == pytest.approx(18 / 330) and got["math"] == 6
    n = len(" ".join(words))
    assert [got[k] * n for k in ("signs", "letters", "digits")] == pytest.approx([24, 1260, 18], rel=1e-5)


def test_comment_of_a_long_line_whose_code_stands_in_the_middle(trees):
    code = "echo " + "the names that follow are read " * 10 + "nRow = f(aList[nRow], 1); if (a == b) { x = y; } " * 30 + "and so are the last ones " * 8
    text = "# sums of all rows that are kept in the list\n" + code
    assert clean(text, trees)[:2] == (False, text)


WORDS = "one two three " * 400 + "four"


@pytest.mark.parametrize(
    ("piece", "want"),
    [
        (f"**{WORDS}**", WORDS), (f"*{WORDS}*", WORDS), (f"_{WORDS}_", WORDS), (f"__{WORDS}__", WORDS), (f"~~{WORDS}~~", WORDS), (f"`{WORDS}`", WORDS), (f"'''{WORDS}'''", WORDS),
        (f"<img src='data:{WORDS}' alt='plan'>", "plan"), (f"<a title='{WORDS}'>page</a>", "page"), (f"<!-- {WORDS} -->page", "page"), (f"<!DOCTYPE {WORDS}>page", "page"),
        (f"[page](http://x/{'a' * 2000})", "page"), (f"[[Help:{WORDS}|page]]", "page"), (f"{{{{term|{WORDS}}}}}", WORDS), (f"\\verb|{WORDS}|", WORDS), (f"${WORDS} n^2$", f"{WORDS} n^2"),
    ],
)
def test_long_piece_counts_whole_and_is_cleaned(trees, piece, want):
    text = f"See {piece} here."
    link = features([text])[0, FEATURES.index("link")]
    assert link > 0.95 and clean(text, trees)[:2] == (True, f"See {want} here.")


@pytest.mark.parametrize(
    ("piece", "want"),
    [(f"It is.<ref name='x'>{WORDS}</ref>", "It is."), (f"It is \\emph{{{WORDS}}}.", f"It is {WORDS}."), (f"<math>{WORDS} \\times n^2</math>", f"{WORDS} × n^2"), (f"\\[{WORDS} \\times n^2\\]", f"{WORDS} × n^2")],
)
def test_what_long_pieces_hold_is_cleaned(trees, piece, want):
    assert clean(piece, trees)[1].strip() == want


def test_tree_against_all_splits():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.1)).astype(int)
    assert (grow(x, y).predict(x) == y).all()


@pytest.mark.parametrize(
    ("text", "want", "kinds"),
    [
        ("<h2 class='x'>Head</h2>\n<p>One &amp; <b>two</b>.<br>Three&nbsp;four</p>", "Head\n\nOne & two.\nThree four", ["heading", "prose"]),
        ("<ul>\n<li>one is read.</li>\n<li>two is <em>read</em>.</li>\n</ul>", "- one is read.\n- two is read.", ["list", "list"]),
        ("<pre>\nIf a &lt; b\nCall f(a, b)\n</pre>", "    If a < b\n    Call f(a, b)", ["code"]),
        ("<table border=1><tr><th>A</th><th>B</th></tr>\n<tr><td>1</td><td>2</td></tr></table>", "A\tB\n1\t2", ["table"]),
        ("## **Head**\n\nSee [the page](x.md) and `nCount`, **so** it is.", "Head\n\nSee the page and nCount, so it is.", ["heading", "prose"]),
        ("```text\nif a < b: *x*\n\nreturn a[b]\n```\nThe code stands before this sentence.", "    if a < b: *x*\n\n    return a[b]\nThe code stands before this sentence.", None),
        ("|A|B|\n|---|---:|\n|one|two|", "A\tB\none\ttwo", ["table"]),
        ("== Head ==\n\nThe '''valve''' of [[Help:x|the page]] {{term|nLamp}} is on.", "Head\n\nThe valve of the page nLamp is on.", ["heading", "prose"]),
        ("{| class=\"grid\"\n! A !! B\n|-\n| one || two\n|}", "A\tB\none\ttwo", ["table"]),
        ("\\subsection*{Head}\\label{s:1}\n\nThe \\textbf{valve} is \\emph{open}.\\footnote{As above.} See~\\ref{t:1}.", "Head\n\nThe valve is open. (As above.) See.", ["heading", "prose"]),
        ("\\begin{itemize}\n  \\item one is read.\n  \\item two is read.\n\\end{itemize}", "- one is read.\n- two is read.", ["list", "list"]),
        ("\\begin{tabular}{ll}\nA & B \\\\ \\hline\none & two \\\\ \\hline\n\\end{tabular}", "A\tB\none\ttwo", ["table"]),
        ("$n = \\frac{m+1}{2}$", "n = (m+1)/(2)", ["formula"]),
        ("<math>n = (m + 1) \\times n^2</math>", "n = (m + 1) × n^2", ["formula"]),
    ],
)
def test_clean_text_and_structure(trees, text, want, kinds):
    found, got, blocks = clean(text, trees)
    assert found and got == want
    assert kinds is None or [k for k, _ in blocks] == kinds


PLAIN = """2.4 Merge key table

If a < b and c > d the value is kept; R&D; note 7 in _7_list -> 8. Costs are $ 57.50 and $ 66; {nCount} is replaced.
Syntax: Open <name> [, nCount [, <number>]]
Files lie in D:\\sections\\begin_5\\item5.lib and the # of rows is 5.
Call oPump.$line_count or oPump.$sort_key, never both; #ERR7 is kept.
Compare a == b first, then a[b[4]] = 9 ** 2.

• one
- two
12. three^2 - four
13. three ~ four

    Assign #S4 := nState & 'date part' & #E
    Quit nState {nMode} /* 271 */
    Call f(a, b) // 166
Group\tClient\tPlatform
x = (y + 1) × x² / 2"""


def test_plain_notation_is_no_markup_and_stays(trees):
    assert clean(PLAIN, trees)[:2] == (False, PLAIN)


@pytest.mark.parametrize("piece", ["<b>", "</p>", "&nbsp;", "**x**", "`x`", "[x](y", "'''x'''", "[[x]]", "{{x|y}}", "__NOTOC__", "\\textbf{x}", "$\\alpha$", "<!-- x -->", "~~x~~", "\\emph{x"])
def test_one_piece_in_a_long_plain_text(trees, piece):
    text = PLAIN + "\n\n" + "Some words of prose stand here. " * 60 + piece + " and more of it."
    found, got, _ = clean(text, trees)
    assert found and piece not in got and got.startswith("2.4 Merge key table")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["```", "<pre>", "</pre>", "{|", "|}", "\\begin{verbatim}", "\\end{verbatim}", "\n", "\r\n", "\r", " ", "**", "x", "[[", "]]", "$", "\\", "{", "}", "&lt;", "<", ">", "| a | b |", "# ", "* ", "word", "\x00", "ﷺ", "'''", "\\frac{a}{", "\\item "]), max_size=50).map("".join))
def test_any_text(trees, text):
    found, got, blocks = clean(text, trees)
    assert isinstance(got, str) and all(k in ("heading", "prose", "list", "code", "table", "formula") for k, _ in blocks)


LONG = (
    "[[", "<", "```\n", "**", "\\begin{tabular}\n", "$\\", "{{", "word ", "`a", "__a", "\\x{", "<!--", "<ref>", "[x](", "<a b='", "a&", " ", "| ", "= ", "<img alt='x' ", "\\verb|", "[[File:a|", "# ", "*", "\\\\ ", "-", "<td ", "a\n",
    "&lt", "\\[", "{|\n", "''x", "~~a", "_a", "<a ",
)


@pytest.mark.parametrize("unit", LONG)
def test_time_is_linear(trees, unit):
    def seconds(n):
        took = []
        for _ in range(2):
            start = time.perf_counter()
            clean(unit * (n // len(unit)) + "x*", trees)
            took.append(time.perf_counter() - start)
        return min(took)

    short = seconds(40_000)
    assert seconds(160_000) < 10 * short + 0.3  # four times as long; of quadratic time it would be sixteen


@pytest.mark.parametrize(
    ("first", "unit"),
    [("", x) for x in (" __a", "__a__ ", "\\(", "<math>", "\\begin{math}", "<!-- x --> <!--", "-->", "<ref a>", "<!DOCTYPE <", "<p a=b", "$a^ ", "\\x[a")]
    + [("<img ", "alt='x' "), ("<img ", "alt='"), ("<!--", "-- "), ("$", "a^ "), ("__", "a_ "), ("\\x", "[a]"), ("[x](", "a ")],
)
def test_time_of_long_pieces_is_linear(trees, first, unit):
    seconds = lambda n: min(_seconds(first + unit * (n // len(unit)) + "x*", trees) for _ in range(2))
    assert seconds(160_000) < 10 * seconds(40_000) + 0.3


def _seconds(text, trees):
    start = time.perf_counter()
    clean(text, trees)
    return time.perf_counter() - start


def test_rows(spark):
    rows = [("a", "<b>x</b> y", "t"), ("a", "<b>x</b> y", "t"), ("b", PLAIN, "t"), ("c", None, "t"), ("d", "", "t"), (None, "## x", "t"), ("e", " \n", "t"), ("f", "plain words.\r\n<p>two", "t")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "chunk_id string, content string, clean_text string")
    got = clean_markup(df).collect()
    assert [(r.chunk_id, r.has_markup, r.clean_text) for r in got] == [(i, i in ("a", "f", None), {"a": "x y", None: "x", "f": "plain words.\ntwo"}.get(i, t)) for i, t, _ in rows]
    assert [b.kind for r in got if r.chunk_id is None for b in r.blocks] == ["heading"]
    assert clean_markup(df.limit(0)).count() == 0
