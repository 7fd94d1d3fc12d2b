"""Markup residue in text documents: found, and turned into clean text with its structure.

A text is cut into flat blocks, its lines. Each block has shallow features: the number of words and the link density (the part of it that is
tags, targets, commands and delimiters, whatever the dialect) of itself and of its two neighbours, and the densities of letters, digits, signs
and code. Two decision trees, trained on a small table of labelled blocks, say whether it holds markup - by these features alone - and what it
is: heading, prose, list entry, code, table, formula or nothing but marks - by these and the marks it begins with. Blocks with markup are then
written in the plain notation of manuals.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexharbor.llm.markup_labels import LABELLED

# Element names of HTML, and those wikis add.
TAGS = "a abbr b big blockquote body br button caption center cite code col dd del div dl dt em font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav ol option p pre q s samp script section select small span strike strong style sub sup table tbody td tfoot th thead title tr tt u ul var gallery math nowiki ref references source syntaxhighlight"
# LaTeX commands that stand for a sign.
SIGNS = {"times": "×", "cdot": "·", "div": "÷", "pm": "±", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "approx": "≈", "infty": "∞", "sum": "∑", "prod": "∏", "int": "∫", "sqrt": "√", "in": "∈", "to": "→", "rightarrow": "→", "leftarrow": "←", "ldots": "…", "dots": "…", "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "lambda": "λ", "mu": "μ", "pi": "π", "sigma": "σ", "omega": "ω", "quad": " ", "textbackslash": "\\"}

_TAG = r"</?(?:" + "|".join(TAGS.split()) + r")\b"
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]\w{1,30});")
_NAMED = {k[:-1].lower() for k in html.entities.html5 if k.endswith(";")}
# What a block's link density counts: tags, entities, targets, delimiters and commands of any dialect, by the signs they begin with.
# Pieces are found whole however long they are. In time linear in the line, as what is within a piece cannot hold the sign it opens with, or by
# `_pairs` where it can.
_HTML = re.compile(rf"{_TAG}(?:\s[^<>]*+)?/?>|{_TAG}(?=\s[\s\w-]{{0,60}}=|\s*$)|<!DOCTYPE(?:[^<>]*+>|[^>]{{0,200}}>)", re.I)
_COMMENT = re.compile("<!--"), re.compile("-->")
_COMMENT_SIGN = re.compile("<!--|-->")
_UNDERLINED = re.compile(r"(?<!\w)__(?=[^\s_])"), re.compile(r"(?<=[^\s_])__(?!\w)")
_PAIRS = re.compile(
    r"\*{2,3}(?=[^\s*])[^*\n]++(?<=[^\s*])\*{2,3}|~~(?=\S)[^~\n]++~~|((?<!\w)__(?=[^\s_]))|`{1,2}[^`\n]++`{1,2}"
    r"|(?<![\w*/])\*(?=[^\s*])[^*\n]++(?<=[^\s*])\*(?![\w*/])|(?<![\w_/])_(?=[^\s_])[^_\n]++(?<=[^\s_])_(?![\w/])"
)
_LINKS = re.compile(r"!?\[[^\[\]\n]*+\]\([^()\s][^()\n]*+\)?|\[\[[^\[\]\n]*+\]\]|\[\[(?=[^\W\d]|:)|^\[[^\]\n]{1,60}\]:\s\s{0,9}\S.*")
_BRACES = re.compile(r"\{\{\{|\}\}\}|\{\{[^{}\n]*+\}\}|\{\{(?=[^\W\d])|^\{\|.*|^\|\}.*|\{\\[a-z]+\b")
_QUOTES = re.compile(r"'{2,5}(?=[^'\s])[^'\n]++'{2,5}")
_TEX = re.compile(
    r"\\(?:begin|end)\s{0,9}\{[^{}\n]{0,60}\}?|\\verb\*?([|!+])[^\n]*?\1|\\[A-Za-z]+\*?(?:\s?\[[^\[\]\n]*+\])?\s?[\[{]|(?<![\w:\\/.])\\[A-Za-z]{2,}(?![\w\\.])|\\\\(?=\s|$)"
    r"|(?<!\\)\\[()\[\]](?![\w.]*\\)|(?<![\w:\\])\\[$&#%_{}](?!\w)"
)
_DOLLARS = re.compile(r"\$\$|(?<![\w.\\$])\$(?=[^\s$])(?=[^$\n\\^_{]*+[\\^_{])[^$\n]++(?<=[^\s$\\])\$(?!\w)")
_LEAD = re.compile(r"#{1,6}(?=\s)|[#*]{1,6}(?=\s)|\+(?=\s)|={1,6}(?=[^=])")
_LINE = re.compile(r"(?:={3,}|-{3,}|```+[\w+-]*|~~~+[\w+-]*)$|(?=[^|]*\|)\|?\s?:?-{2,}[-:|\s]*$|\|-[^|]*$")
_SURE = ("`", "~", "|", ":")  # what a line of nothing but marks begins with, if it is no rule
_BARS = re.compile(r"\|{1,2}|!!|^!")
_ANY_SIGN = re.compile(r"[<&*_`~#=|\[{}\\$'+!]|--")
_DASH = re.compile(r"(?:[-–•·]|\d{1,4}[.)])\s")
_NUMBERED = re.compile(r"\d{1,3}(?:\.\d{1,3})+\.?\s+\w")
_CODE_SIGN = re.compile(r":=|(?<=[\w)\]]) ?==\s?(?=[\w(\"'-])|<>|!=|<=|>=|/\*|\*/|//|->|\w\(|\)\s?[;{]|\w\[|[;{]$|\w\.\$?\w+\(|\$\w|&&|\w:\\|\s[=<>]\s|\{\w*\}|\\\w+\\")
_CODE_ANY = re.compile(r"[=<>/*(\[;{&$\\|]")
_MATH_SIGN = re.compile(r"[×÷·±≤≥≠≈∞∑∏∫√²³^]|\\(?:frac|sqrt|sum|times|leq|geq|neq|begin\{(?:equation|align|math))|</?math|&times;|<su[pb]>")
_SIGN = re.compile(r"[^\w\s.,:()-]")
_HEAD = re.compile(r"<h[1-6]\b|^\\(?:part|chapter|(?:sub)*section|(?:sub)?paragraph)\b", re.I)
_ENTRY = re.compile(r"<li\b|^\\item\b|^(?:\*[#*]{0,5}|\+|#+\*[#*]{0,5})\s", re.I)
_CELL = re.compile(r"<t[dhr]\b|</table", re.I)
_MATHS = re.compile(r"(?:\$|\\\[|\\\(|<math|\\begin\{(?:equation|align|math)|(?:<i>)?\w+(?:</i>)?\s?=\s?\(?(?:<i>)?\w+|`\w+ = )", re.I)
_CODE_TAG = re.compile(r"</?(?:pre|code|syntaxhighlight|nowiki|source)\b[^<>]*+>", re.I)
_FENCE = re.compile(r"(?:```|~~~)")
_OPENERS = (  # (opens, closes, what is within), of lines without outer blanks
    (re.compile(r"(```+|~~~+)[\w+-]*$"), lambda m: re.compile(re.escape(m[1][:3])), "c"),
    (re.compile(r"<(pre|syntaxhighlight|nowiki|source)\b[^>]*>", re.I), lambda m: re.compile(rf"</{m[1]}\s{{0,9}}>", re.I), "c"),
    (re.compile(r"\{\{\{$"), lambda m: re.compile(r"^\}\}\}"), "c"),
    (re.compile(r"\\begin\{(verbatim|lstlisting|alltt|minted)\*?\}"), lambda m: re.compile(rf"\\end\{{{m[1]}\*?\}}"), "c"),
    (re.compile(r"\\begin\{(equation|align|displaymath|math|gather|eqnarray)\*?\}"), lambda m: re.compile(rf"\\end\{{{m[1]}\*?\}}"), "f"),
    (re.compile(r"\\begin\{(tabular|array|longtable)\*?\}"), lambda m: re.compile(rf"\\end\{{{m[1]}\*?\}}"), "t"),
    (re.compile(r"\{\|"), lambda m: re.compile(r"^\|\}"), "t"),
)
_OPEN_SIGN = ("`", "~", "<", "{", "\\")
_BREAK = re.compile(r"\r\n|[\r\n\x0b\x0c\x85\u2028\u2029]")
#: Columns of the blocks' features; of equally good splits that of the first is taken. The tree that says whether a block holds markup has the
#: first SHALLOW ones only: sizes and densities of the block and its neighbours, no pattern of any dialect.
FEATURES = (
    "words link words_before words_after link_before link_after lead lead_before lead_after code code_before code_after within signs letters sentence upper digits indent tabs numbered dash math blank_before blank_after "
    "head_mark entry_mark cell_mark formula_mark code_mark only_marks hash star equals rule row"
).split()
SHALLOW = FEATURES.index("signs")
_FORM = FEATURES.index("head_mark")
_BLANK_AFTER = FEATURES.index("blank_after")


def _named(m: re.Match) -> bool:
    return m[0][1] == "#" or m[0][1:-1].lower() in _NAMED


def _pairs(s: str, signs: tuple[re.Pattern, re.Pattern]) -> list[tuple[int, int, int, int]]:
    """Pieces from an opening sign to the first closing one after it: (start, its end, end's start, end). What nothing closes is looked for once."""
    opens, closes = signs
    out, at = [], 0
    while (m := opens.search(s, at)) and (end := closes.search(s, m.end())):
        out.append((*m.span(), *end.span()))
        at = end.end()
    return out


def _delimited(s: str) -> list[tuple[int, int]]:
    """The matches of `_PAIRS`, in which an opening "__" reaches to the first that closes it."""
    out, at, end = [], 0, True
    while m := _PAIRS.search(s, at):
        at = m.end()
        if not m[1]:
            out.append(m.span())
        elif end and (end := _UNDERLINED[1].search(s, at)):
            at = end.end()
            out.append((m.start(), at))
    return out


def marks(s: str) -> list[tuple[int, int]]:
    """Where a line without outer blanks holds tags, entities, targets, commands or pairs of delimiters of some dialect: (start, end), overlaps
    and all. The link density is the part of the line that lies in them."""
    out = []
    for signs, pattern in (("<", _HTML), ("[", _LINKS), ("'", _QUOTES), ("\\", _TEX), ("$", _DOLLARS)):
        if signs in s:
            out += [m.span() for m in pattern.finditer(s)]
    if "<!--" in s or "-->" in s:
        out += [m.span() for m in _COMMENT_SIGN.finditer(s)] + [(a, b) for a, _, _, b in _pairs(s, _COMMENT)]
    if "&" in s:
        out += [m.span() for m in _ENTITY.finditer(s) if _named(m)]
    if "*" in s or "_" in s or "`" in s or "~" in s:
        out += _delimited(s) if "__" in s else [m.span() for m in _PAIRS.finditer(s)]
    if "{" in s or "}" in s:
        out += [m.span() for m in _BRACES.finditer(s)]
    if (s[0] in _SURE or "|" in s) and _LINE.match(s):
        out.append((0, len(s)))
    elif s[0] == "|" == s[-1] and s.count("|") > 2:
        out += [m.span() for m in _BARS.finditer(s)]
    return out


def leads(s: str) -> list[tuple[int, int]]:
    """Where a line without outer blanks holds signs that mark it as a whole, if it is not code, a rule or a comment: (start, end)."""
    first = s[0]
    if first in "#*+=-`~|!:":
        if _LINE.match(s):
            return [(0, len(s))]
        if m := _LEAD.match(s):
            return [m.span()] if first != "=" else [m.span(), (len(s.rstrip("=")), len(s))] if s[-1] == "=" else []
    if first in "|!" or s[-1] == "|":
        return [m.span() for m in _BARS.finditer(s)]
    return []


def covered(spans: list[tuple[int, int]]) -> int:
    """How many characters are in one of the spans."""
    n = last = 0
    for a, b in sorted(spans):
        if b > last:
            n += b - max(a, last)
            last = b
    return n


def within(lines: list[str]) -> list[str]:
    """For each line what it is within (c code, f formula, t table, "" nothing), from an opening mark to the one that closes it again."""
    out, at = [""] * len(lines), 0
    bare = [x.strip() for x in lines]
    closes: dict[str, list[int]] = {}  # where such closing marks are, so that openers that are never closed are looked for once
    while at < len(lines):
        if bare[at].startswith(_OPEN_SIGN):
            for opens, closing, kind in _OPENERS:
                if m := opens.match(bare[at]):
                    closer = closing(m)
                    if closer.search(bare[at][m.end() :]):
                        break
                    if closer.pattern not in closes:
                        closes[closer.pattern] = [i for i, x in enumerate(bare) if (closer.match(x) if kind == "c" and closer.pattern[0] in "`~" else closer.search(x))]
                    later = closes[closer.pattern]
                    i = bisect_right(later, at)
                    if i < len(later):
                        out[at + 1 : later[i]] = kind * (later[i] - at - 1)
                        at = later[i]
                    break
        at += 1
    return out


def _flags(s: str, n: int) -> list[float]:
    """The columns of FEATURES from the first mark on, of a line without outer blanks and the number of its characters in marks."""
    lead = _LEAD.match(s)
    first = s[0]
    equals = first == "=" and s[-1] == "=" and lead is not None and s.strip("= \t") != ""
    hashes = lead.end() if lead and first == "#" else 0
    line = _LINE.match(s)
    rule = ("=" in s) + 1 if line and first in "=-" and "|" not in s else 0
    bars = first in "|!" and not s.startswith(("|-", "|}"))
    cell = bool(_CELL.search(s)) or (bars and (s.endswith("|") or "||" in s or "!!" in s or first == "!")) or 0 < s.find("&", 1) < s.rfind("\\\\")
    return [
        bool(_HEAD.search(s)) or equals or hashes > 0, bool(_ENTRY.search(s)), cell, bool(_MATHS.match(s)), bool(_CODE_TAG.search(s)), n >= 0.95 * len(s), hashes,
        bool(lead and first in "*+"), equals, rule, bars,
    ]


_NO_FLAGS = [0.0] * (len(FEATURES) - _FORM)


def features(lines: list[str], inside: list[str] | None = None) -> np.ndarray:
    """A row of FEATURES for each line that is not blank, in order; inside: what `within` says of the lines."""
    inside = within(lines) if inside is None else inside
    rows, blanks = [], []
    blank = True
    for line, env in zip(lines, inside, strict=True):
        s = line.strip()
        if not s:
            blank = True
            continue
        words = s.count(" ") + 1 if "  " not in s and "\t" not in s else len(s.split())
        link = lead = 0
        flags = _NO_FLAGS
        if _ANY_SIGN.search(s):
            spans, signs = marks(s), leads(s)
            link, lead = covered(spans), covered(signs)
            if spans or signs or env:
                flags = _flags(s, covered(spans + signs))
            elif "=" in s:
                flags = [*_NO_FLAGS]
                flags[3] = bool(_MATHS.match(s))
        code = len(_CODE_SIGN.findall(s)) / words if _CODE_ANY.search(s) and link < 0.95 * len(s) else 0
        maths = len(_MATH_SIGN.findall(s)) if link or not s.isascii() or "^" in s else 0
        rows.append([
            words, link / len(s), 0, 0, 0, 0, lead / len(s), 0, 0, code, 0, 0, "cft".find(env) + 1 if env else 0, len(_SIGN.findall(s)) / len(s), sum(map(str.isalpha, s)) / len(s), s[-1] in ".!?:…" or s[-2:-1] in (".", "!", "?"), s.isupper(),
            sum(map(str.isdigit, s)) / len(s), line.startswith(("    ", "\t")), line.count("\t"), bool(_NUMBERED.match(s)), bool(_DASH.match(s)), maths, blank, True, *flags,
        ])
        if len(rows) > 1:
            rows[-2][_BLANK_AFTER] = blank
        blank = False
    x = np.array(rows, np.float32).reshape(len(rows), len(FEATURES))
    for what in ("words", "link", "lead", "code"):
        own, before, after = (FEATURES.index(what + end) for end in ("", "_before", "_after"))
        x[1:, before], x[:-1, after] = x[:-1, own], x[1:, own]
        if what == "code":  # a comment stands at its code, not a blank line away
            x[x[:, _BLANK_AFTER - 1] > 0, before] = 0
            x[x[:, _BLANK_AFTER] > 0, after] = 0
    return x


@dataclass
class Tree:
    """A decision tree: at node i, rows with feature[i] > limit[i] go right; leaves have feature -1."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            f = self.feature[node]
            go = np.flatnonzero(f >= 0)
            if not len(go):
                return self.label[node]
            right = x[go, f[go]] > self.limit[node[go]]
            node[go] = np.where(right, self.right[node[go]], self.left[node[go]])


def grow(x: np.ndarray, y: np.ndarray, least: int = 1, depth: int = 14) -> Tree:
    """The tree of least Gini impurity, split by split; ties go to the first feature."""
    out: list[list] = []
    classes = int(y.max()) + 1 if len(y) else 1

    def add(rows: np.ndarray, deep: int) -> int:
        at = len(out)
        n = np.bincount(y[rows], minlength=classes)
        out.append([-1, 0.0, -1, -1, int(n.argmax())])
        if n.max() == len(rows) or deep == depth:
            return at
        best = (float((n * n).sum()) / len(rows) + 1e-9, -1, 0.0)
        for f in range(x.shape[1]):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v = x[order, f]
            left = np.cumsum(np.eye(classes)[y[order]], axis=0)[:-1]
            size = np.arange(1, len(rows))
            can = (v[1:] > v[:-1]) & (size >= least) & (len(rows) - size >= least)
            if can.any():
                gain = np.where(can, (left**2).sum(axis=1) / size + ((n - left) ** 2).sum(axis=1) / (len(rows) - size), -1)
                i = int(gain.argmax())
                if gain[i] > best[0] + 1e-9:
                    best = (float(gain[i]), f, float(v[i]))  # a value that occurs, so that no share is too small to count
        if best[1] >= 0:
            right = x[rows, best[1]] > best[2]
            out[at][:4] = [best[1], best[2], add(rows[~right], deep + 1), add(rows[right], deep + 1)]
        return at

    add(np.arange(len(y)), 0)
    cols = list(zip(*out, strict=True))
    return Tree(np.array(cols[0]), np.array(cols[1], np.float32), np.array(cols[2]), np.array(cols[3]), np.array(cols[4]))


KINDS = "hplctfn"


def labelled(table: str = LABELLED) -> list[tuple[list[str], list[int], list[int]]]:
    """(lines, whether markup, kind) of each labelled document; markup and kind of its lines that are not blank."""
    out = []
    for part in table.strip("\n").split("\n===\n"):
        lines, mark, kind = [], [], []
        for row in part.split("\n"):
            if row == "b":
                lines.append("")
            else:
                kind.append(KINDS.index(row[0])), mark.append(int(row[1])), lines.append(row[3:])
        out.append((lines, mark, kind))
    return out


@dataclass
class Classifier:
    mark: Tree
    kind: Tree

    def __call__(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.verdicts(features(lines))

    def verdicts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether markup, kind) of each row of `features`."""
        return self.mark.predict(x[:, :SHALLOW]), self.kind.predict(x)


def _groups(documents: list[tuple[list[str], list[int], list[int]]]) -> list[tuple[list[str], list[int], list[int]]]:
    """The runs of labelled lines between blank ones."""
    out = []
    for lines, mark, kind in documents:
        at = 0
        for full, run in groupby(lines, bool):
            some = list(run)
            if full:
                out.append((some, mark[at : at + len(some)], kind[at : at + len(some)]))
                at += len(some)
    return out


def train(documents: list[tuple[list[str], list[int], list[int]]] | None = None, rounds: int = 12, seed: int = 3) -> Classifier:
    """The two trees of the labelled table: its documents as they are, and `rounds` times its groups of lines in an order drawn anew, so that
    what stands before or after a block by chance decides nothing."""
    documents = labelled() if documents is None else documents
    parts = [(features(d[0]), d[1], d[2]) for d in documents]
    groups = _groups(documents)
    inside = [within(g[0]) for g in groups]
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        lines, env, mark, kind = [], [], [], []
        for i in rng.permutation(len(groups)):
            own = groups[i]
            lines.append(""), env.append("")
            lines += own[0]
            env += inside[i]
            mark += own[1]
            kind += own[2]
        parts.append((features(lines, env), mark, kind))
    x, mark, kind = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return Classifier(grow(x[:, :SHALLOW], mark, 3 * rounds), grow(x, kind, rounds // 2))


# ---- clean text

_DOLLAR_FORMULA = r"(?<![\w.\\$])\$(?=[^\s$])(?=[^$\\^_{]*+[\\^_{])([^$]++)\$(?!\w)"
_FORMULA_OPENS = re.compile(rf"(\$\$)|{_DOLLAR_FORMULA}|(\\\[)|(\\\()|(<math[^<>]*+>)|(\\begin\{{(?:equation|align|displaymath|math)\*?\}})", re.I)
_FORMULA_CLOSES = [re.compile(x, re.I) for x in (r"\$\$", "", r"\\\]", r"\\\)", "</math>", r"\\end\{\w+\*?\}")]  # by the group that opens; the second is whole
_REF = re.compile(r"<ref\b[^<>]*+(?<!/)>", re.I), re.compile("</ref>", re.I)
_IMG = re.compile(r"<img\b[^<>]*+>", re.I)
_ALT = re.compile(r"\balt\s?=\s?[\"']([^\"'<>]*+)[\"']", re.I)
_ARG = re.compile(r"\\([A-Za-z]+)\*?\s*((?:\[[^\[\]]*+\])*)\{([^{}]*+)\}(?:\{([^{}]*+)\})?")
_GONE = {"label", "ref", "cite", "pageref", "eqref", "index", "begin", "end", "vspace", "hspace", "includegraphics", "usepackage", "documentclass"}
_BARE = re.compile(r"(?<![\w:\\/.])\\([A-Za-z]{2,})\*?(?![\w\\.]) ?")


def formula(text: str) -> str:
    """LaTeX mathematics in plain signs."""
    for _ in range(6):
        new = re.sub(r"\\[dt]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", text)
        new = re.sub(r"\\sqrt\s*\{([^{}]*)\}", r"√(\1)", new)
        new = re.sub(r"\\(?:math\w+|text\w*|operatorname|left|right|boldsymbol)\*?\s*\{([^{}]*)\}", r"\1", new)
        if new == text:
            break
        text = new
    text = re.sub(r"\\([A-Za-z]+)", lambda m: SIGNS.get(m[1], m[1]), text)
    text = re.sub(r"([\^_])\{([^{}]+)\}", lambda m: m[1] + (m[2] if len(m[2]) == 1 else f"({m[2]})"), text)
    return re.sub(r"\s+", " ", text.replace("{", "").replace("}", "").replace("\\", "")).strip()


def _formulas(line: str) -> str:
    """The line with its formulas in plain signs. What nothing closes stays, and is looked for once a kind."""
    out, at, look, open_for_good = [], 0, 0, set()
    while m := _FORMULA_OPENS.search(line, look):
        kind, end = m.lastindex, m.end()
        inner = m[2]
        if inner is None:
            close = None if kind in open_for_good else _FORMULA_CLOSES[kind - 1].search(line, end + 1)
            if close is None:
                open_for_good.add(kind)
                look = m.start() + 1
                continue
            inner, end = line[end : close.start()], close.end()
        out += [line[at : m.start()], formula(inner)]
        at = look = end
    return "".join(out) + line[at:]


def _without(line: str, signs: tuple[re.Pattern, re.Pattern], kept: bool = False) -> list[str]:
    """The line cut where such pieces are; kept: what they hold stays."""
    out, at = [], 0
    for a, b, c, d in _pairs(line, signs):
        out += [line[at:a], line[b:c]] if kept else [line[at:a]]
        at = d
    return [*out, line[at:]]


def _command(m: re.Match) -> str:
    name, first, second = m[1], m[3], m[4]
    if name in _GONE:
        return ""
    if name == "footnote":
        return f" ({first})" + (second or "")
    if name == "href":
        return second if second is not None else first
    return first + (second or "")


def _template(m: re.Match) -> str:
    return m[1].split("|")[-1].strip()


def inline(line: str) -> str:
    """The line without its pieces of markup; what they mark stays."""
    if "--" in line:
        line = "".join(_COMMENT_SIGN.sub("", x) for x in _without(line, _COMMENT))
    if "$" in line or "\\" in line or "<" in line:
        line = _formulas(line)
    if "\\verb" in line:
        line = re.sub(r"\\verb\*?([|!+])(.*?)\1", r"\2", line)
    # HTML
    if "<" in line:
        line = "".join(_without(re.sub(r"<ref\b[^<>]*/>", "", line, flags=re.I), _REF))
        line = _IMG.sub(lambda m: alt[1] if (alt := _ALT.search(m[0])) else m[0], line)
        line = re.sub(r"</t[dh]>\s*<t[dh]\b[^<>]*>", "\t", line, flags=re.I)
        line = re.sub(r"</tr>\s*<tr\b[^<>]*>|<br\s*/?>(?=.*\S)", "\n", line, flags=re.I)
        line = re.sub(r"<sup\b[^<>]*>([^<>]*)</sup>", r"^\1", line, flags=re.I)
        line = re.sub(r"<sub\b[^<>]*>([^<>]*)</sub>", r"_\1", line, flags=re.I)
        line = re.sub(rf"{_TAG}(?:\s[^<>]*+)?/?>|{_TAG}(?:\s[\s\w-]{{0,60}}=[^<>]*$|\s*$)|<!DOCTYPE(?:[^<>]*+>|[^>]{{0,200}}>)", "", line, flags=re.I)
    # Wiki
    if "[[" in line or "{{" in line or "}}}" in line or "''" in line or "__" in line:
        line = re.sub(r"\[\[(?:File|Image|Datei|Bild):[^\[\]|]*\|?(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", r"\1", line)
        line = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", line)
        line = re.sub(r"\{\{([^{}]*)\}\}", _template, line)
        line = re.sub(r"'{2,5}(?=[^'\s])([^']++)'{2,5}", r"\1", line)
        line = re.sub(r"__[A-Z]{3,}__", "", line)
        line = re.sub(r"\[\[(?=[^\W\d]|:)|\{\{+(?=[^\W\d]|\s*$)|\}\}\}", "", line)
    # Markdown
    if "*" in line or "_" in line or "~~" in line or "`" in line or "](" in line:
        line = re.sub(r"!?\[([^\[\]]*)\]\((?:[^()\s][^()]*)?\)?", r"\1", line)
        for _ in range(3):
            line = re.sub(r"(\*{2,3})(?=[^\s*])([^*]++)(?<=[^\s*])\*{2,3}", r"\2", line)
            line = "".join(_without(line, _UNDERLINED, kept=True)) if "__" in line else line
            line = re.sub(r"~~(?=\S)([^~]++)~~", r"\1", line)
        line = re.sub(r"(?<![\w*/])\*(?=[^\s*])([^*]++)(?<=[^\s*])\*(?![\w*/])|(?<![\w_/])_(?=[^\s_])([^_]++)(?<=[^\s_])_(?![\w/])", lambda m: m[1] or m[2], line)
        line = re.sub(r"`{1,2}([^`]++)`{1,2}", r"\1", line)
    # LaTeX
    if "\\" in line or "{" in line or "$$" in line:
        line = re.sub(r"~(?=\\(?:ref|cite|eqref|pageref|autoref)\b)", "", line)
        for _ in range(8):
            new = _ARG.sub(_command, line)
            if new == line:
                break
            line = new
        line = re.sub(r"~?\\(?:ref|cite|label)\b", "", line)
        line = re.sub(r"\{\\[a-z]+\s+([^{}]*)\}", r"\1", line)
        line = re.sub(r"\{\\[a-z]+\s+", "", line)
        line = re.sub(r"\\\\(?:\s*\\hline)?\s*$|\\hline", "", line)
        line = re.sub(r"(?<=\s)\\\\(?=\s)", "\n" if line.strip() else "", line)
        line = re.sub(r"\\[A-Za-z]+\*?\s*[\[{]", "", line)
        line = _BARE.sub(lambda m: SIGNS.get(m[1], "- " if m[1] == "item" else ""), line)
        line = re.sub(r"(?<!\\)\\[()\[\]](?![\w.]*\\)|\$\$", "", line)
        line = re.sub(r"(?<![\w:\\])\\([$&#%_{}])(?!\w)", r"\1", line)
    if "&" in line:
        line = _ENTITY.sub(lambda m: html.unescape(m[0]) if _named(m) else m[0], line)
    return line.replace("\xa0", " ")


def _table_row(s: str) -> str:
    """The cells of a row, given without outer blanks, divided by tabs."""
    if _LINE.match(s) or s.startswith(("{|", "|}", "|-")):
        return ""
    if s[0] in "|!":
        return "\t".join(inline(c).strip() for c in re.split(r"\|\||!!" if "||" in s or "!!" in s else r"\|", s.strip("|").lstrip("!")))
    if "&" in s and s.endswith(("\\\\", "\\hline")):
        return "\t".join(inline(c).strip() for c in re.split(r"(?<!\\)&", s.removesuffix("\\hline").rstrip().removesuffix("\\\\")))
    return inline(s).strip()


_NAMES = {"h": "heading", "p": "prose", "l": "list", "c": "code", "t": "table", "f": "formula", "n": "prose"}


def clean(text: str, classifier: Classifier) -> tuple[bool, str, list[tuple[str, str]]]:
    """(whether the text holds markup, its clean text, (kind, text) of its blocks)."""
    return clean_all([text], classifier)[0]


def clean_all(texts: list[str], classifier: Classifier) -> list[tuple[bool, str, list[tuple[str, str]]]]:
    """`clean` of many texts, whose blocks are classified at once."""
    lines = [_BREAK.split(t) for t in texts]
    inside = [within(x) for x in lines]
    each = [features(x, env) for x, env in zip(lines, inside, strict=True)]
    if not each:
        return []
    mark, kind = (v.tolist() for v in classifier.verdicts(np.concatenate(each)))
    out, at = [], 0
    for own, env, rows in zip(lines, inside, each, strict=True):
        end = at + len(rows)
        out.append(_written(own, env, mark[at:end], kind[at:end]))
        at = end
    return out


def _unmarked(line: str, kind: str, number: int) -> str:
    """A line with markup, outside of code and tables, in plain notation."""
    s = line.strip()
    if _LINE.match(s) or s.startswith(("{|", "|}", "|-")) or s in ("{{{", "}}}"):
        return ""
    if kind == "t" or s[0] in "|!":
        return _table_row(s)
    lead = _LEAD.match(s)
    if not lead or kind == "c":
        entry = kind == "l" and not _DASH.match(s)
        body = inline(s).strip()
        if entry and body:
            return body if _DASH.match(body) else f"- {body}"
        return line[: len(line) - len(line.lstrip())] + body if kind == "c" else body
    body = s[lead.end() :].strip()
    if s[0] == "=":
        return inline(body.rstrip("=")).strip()
    if s[0] == "#" and kind != "l":
        return inline(body.rstrip("#") if body.endswith("#") else body).strip()
    body = inline(body).strip()
    return body if not body or kind == "h" else f"{number}. {body}" if s[0] == "#" else f"- {body}"


def _written(lines: list[str], env: list[str], mark: list[int], kind: list[int]) -> tuple[bool, str, list[tuple[str, str]]]:
    out: list[tuple[str, str]] = []
    i, number, blank = 0, 0, False
    for line, where in zip(lines, env, strict=True):
        if not line or line.isspace():
            blank = True
            number = number if where else 0
            continue
        k, m = KINDS[kind[i]], bool(mark[i])
        i += 1
        if where == "c":
            k, value = "c", html.unescape(re.sub(rf"{_TAG}[^<>]*+>", "", line, flags=re.I)) if m else line
        elif where == "t":
            k, value = "t", _table_row(line.strip())
        elif not m:
            k, value = "p" if k == "n" else k, line
        else:
            number += k == "l" and line.lstrip()[0] == "#"
            value = _unmarked(line, k, number)
            k = "p" if k == "n" and value else k
        if not value or value.isspace():
            blank = blank or line.lstrip()[0] == "=" or not (k in "nt" or where)
            continue
        if k == "c" and m | (where == "c") and not value.startswith((" ", "\t")):
            value = "    " + value
        for part in value.split("\n") if m else [value]:
            if part.strip():
                out.append((("\n" if blank or (out and k == "h" and m) else "") + _NAMES[k], part))
                blank = False
        if k == "h" and m:
            blank = True
    lines_out, blocks = [], []
    for name, value in out:
        apart = name.startswith("\n")
        name = name.lstrip("\n")
        if apart and lines_out:
            lines_out.append("")
        lines_out.append(value)
        if blocks and not apart and blocks[-1][0] == name and name in ("code", "table", "prose"):
            blocks[-1][1].append(value)
        else:
            blocks.append((name, [value]))
    return any(mark), "\n".join(lines_out), [(name, "\n".join(x) if name == "code" else "\n".join(x).strip()) for name, x in blocks]


def clean_markup(df: DataFrame, text: str = "content", keep: tuple[str, ...] = ("chunk_id",), classifier: Classifier | None = None) -> DataFrame:
    """`keep`, has_markup BOOLEAN, clean_text STRING, blocks ARRAY<STRUCT<kind, text>>: each row's text without markup, and its structure.

    has_markup says that the tree found a block with markup. In clean_text headings stand on lines of their
    own, entries of lists begin with "- " or a number, code is indented, cells of a table are divided by tabs and formulas are in plain signs;
    blocks says of each block what it is (heading, prose, list, code, table, formula). A text without markup stays as it is. NULL gives
    NULL and no blocks, an empty text an empty one. One row for every row of `df`; columns not in `keep` are not read. Texts are read whole, each
    by itself, in time linear in its length; nothing is shuffled.
    """
    trees = classifier or train()
    rows = df.select(*keep, text)
    n = len(keep)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", has_markup boolean, clean_text string, blocks array<struct<kind:string,text:string>>"
    block = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has, texts, blocks = [], [], []
            for lo in range(0, batch.num_rows, 500):
                some = batch.column(n).slice(lo, 500).to_pylist()
                cleaned = iter(clean_all([t for t in some if t is not None], trees))
                for t in some:
                    found, new, parts = (False, None, []) if t is None else next(cleaned)
                    has.append(found), texts.append(new if found else t), blocks.append([{"kind": k, "text": x} for k, x in parts])
            arrays = [pa.array(has, pa.bool_()), pa.array(texts, pa.string()), pa.array(blocks, block)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in range(n)], *arrays], names=[*keep, "has_markup", "clean_text", "blocks"])

    return rows.mapInArrow(run, schema)
