"""Search queries: their language, presets, and how their text is read."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that make a query look German, each between blanks or first.
GERMAN_HINTS = (
    "wie", "welche", "welcher", "wodurch", "warum", "und", "oder", "mit", "ohne", "liste", "listen", "fehler", "beispiel", "parameter", "unterschied",
    "syntax", "robust", "aufbau", "rekursion", "bedingungen", "fallstricke", "konzept",
)
# German words and what they are replaced by, in the order in which they are replaced.
GERMAN_WORDS = (
    ("wie", "how"), ("welche", "which"), ("welcher", "which"), ("welches", "which"), ("was", "what"), ("unterschied", "difference"), ("zwischen", "between"),
    ("und", "and"), ("oder", "or"), ("mit", "with"), ("ohne", "without"), ("inklusive", "including"), ("parametern", "parameters"), ("parameter", "parameters"),
    ("syntax", "syntax"), ("befehle", "commands"), ("listen", "lists"), ("liste", "list"), ("iteration", "iteration"), ("fehlerbehandlung", "error handling"),
    ("fehler", "error"), ("konzept", "concept"), ("konzepte", "concepts"), ("rekursion", "recursion"), ("bedingungen", "conditions"), ("fallstricke", "pitfalls"),
    ("beispiele", "examples"), ("beispiel", "example"),
)
# Results per kind of corpus of each preset, and the kind a preset searches (all: each).
DEFAULT_K = {"commands": 4, "functions": 4, "programming": 10}
PRESETS = {
    "syntax": ("all", {"commands": 8, "functions": 8, "programming": 4}),
    "concept": ("programming", {"commands": 2, "functions": 4, "programming": 12}),
    "deep": ("programming", {"commands": 2, "functions": 2, "programming": 20}),
}
MAX_K = 30
KINDS = ("commands", "functions", "programming", "code")
LANGUAGES = ("auto", "de", "en")


def corpus_kind(name: Column) -> Column:
    """commands, functions, programming or code: the last part of a corpus name."""
    return F.regexp_extract(F.lower(name), r"([^-]*)$", 1)


def asked(query: Column) -> Column:
    """Whether there is a query: text other than white space; FALSE for NULL."""
    return F.coalesce(F.regexp_replace(query, r"(?U)\s+", "") != "", F.lit(False))


def flag(value: Column, default: bool = False) -> Column:
    """1, true, yes and on are true, in any case and with outer blanks; NULL is the default."""
    return F.coalesce(F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+\z", "")).isin("1", "true", "yes", "on"), F.lit(default))


def normalize_k(value: object, fallback: int) -> int:
    """1 to 30, rounded half up; None counts as 0 and so gives 1, what is no finite number the fallback."""
    if value is None or value == "":
        number = 0.0
    else:
        try:
            number = float(value)  # type: ignore[arg-type]
        except (TypeError, ValueError):
            return fallback
    return min(MAX_K, max(1, math.floor(number + 0.5))) if math.isfinite(number) else fallback


def clamped_k(value: Column, fallback: int | Column) -> Column:
    """`normalize_k` over a numeric column, where NULL means not given and takes the fallback."""
    fall = F.lit(fallback) if isinstance(fallback, int) else fallback
    number = value.cast("double")
    ok = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return F.when(ok, F.least(F.lit(MAX_K), F.greatest(F.lit(1), F.floor(number + 0.5))).cast("int")).otherwise(fall)


def choice(value: Column, allowed: tuple[str, ...], fallback: str) -> Column:
    """`normalize_choice` over a column."""
    text = F.lower(F.regexp_replace(F.coalesce(value, F.lit(fallback)), r"(?U)^\s+|\s+\z", ""))
    return F.when(text.isin(*allowed), text).otherwise(F.lit(fallback))


def resolved(mode: Column, corpus: Column, k: dict[str, Column]) -> Column:
    """STRUCT<mode, corpus, k_commands, k_functions, k_programming>: `resolve` for the tool "docs" over columns, where NULL means not given.

    An unknown mode is none; a mode's preset gives what is not given, the corpus too."""
    name = choice(mode, tuple(PRESETS), "")
    kind = F.coalesce(*[F.when(name == m, F.lit(kind)) for m, (kind, _) in PRESETS.items()], F.lit("all"))
    preset = lambda n: F.coalesce(*[F.when(name == m, F.lit(given[n])) for m, (_, given) in PRESETS.items()], F.lit(DEFAULT_K[n]))
    return F.struct(
        F.nullif(name, F.lit("")).alias("mode"), F.when(corpus.isNull(), kind).otherwise(choice(corpus, ("all", *KINDS), "all")).alias("corpus"),
        *[clamped_k(k[n], preset(n)).alias(f"k_{n}") for n in DEFAULT_K],
    )


def normalize_choice(value: object, allowed: tuple[str, ...] | set[str], fallback: str) -> str:
    """The trimmed, lower-case value if it is allowed."""
    text = str(fallback if value is None else value).strip().lower()
    return text if text in allowed else fallback


def looks_german(query: Column) -> Column:
    """Whether the query has an umlaut or ß, or one of the hint words before a blank, at its start or after a blank."""
    low = F.lower(query)
    hints = "|".join(GERMAN_HINTS)
    return low.rlike("[äöüß]") | low.rlike(f"(?:^| )(?:{hints}) ")


def rewrite_german(query: Column) -> Column:
    """German words replaced by English ones, one after the other, and white space collapsed. Only ASCII letters, digits and _ make words."""
    for german, english in GERMAN_WORDS:
        query = F.regexp_replace(query, rf"(?i)(?<![A-Za-z0-9_]){german}(?![A-Za-z0-9_])", english)
    return F.trim(F.regexp_replace(query, r"(?U)\s+", " "))


def normalized_query(query: Column, language: Column | None = None, english: Column | None = None) -> Column:
    """STRUCT query_effective, query_language, rewrite_applied, rewrite_reason.

    An English version, if given and not blank, holds. Else a query that looks German (language auto or unknown) or is said to be (de) is
    rewritten."""
    lang = F.lower(F.trim(language)) if language is not None else F.lit("auto")
    lang = F.when(lang.isin(*LANGUAGES), lang).otherwise("auto")
    forced = F.nullif(F.trim(english), F.lit("")) if english is not None else F.lit(None).cast("string")
    german = F.when(lang == "auto", F.coalesce(looks_german(query), F.lit(False))).otherwise(lang == "de")
    new = rewrite_german(query)
    changed = ~new.eqNullSafe(query)
    reason = F.when(forced.isNotNull(), "query_en override").when(~german, None).when(changed, "de-to-en normalization").otherwise("de-detected-no-change")
    return F.struct(
        F.coalesce(forced, F.when(german, new).otherwise(query)).alias("query_effective"),
        F.when(forced.isNotNull(), "en").when(german, "de").when(lang == "auto", "en").otherwise(lang).alias("query_language"),
        F.when(forced.isNotNull(), ~forced.eqNullSafe(query)).otherwise(german & changed).alias("rewrite_applied"),
        reason.alias("rewrite_reason"),
    )


@dataclass(frozen=True)
class TextQuery:
    """What a text must hold: all of `terms`, one phrase of each of `either`, each of `phrases`, none of `without`."""

    terms: tuple[str, ...] = ()
    either: tuple[tuple[tuple[str, ...], ...], ...] = ()
    phrases: tuple[tuple[str, ...], ...] = ()
    without: tuple[str, ...] = ()

    @property
    def empty(self) -> bool:
        return not (self.terms or self.either or self.phrases)


_TOKEN = re.compile(r"[^\W_]+")


def term_list(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def parse_all(text: str | None, strict: bool = False) -> TextQuery | None:
    """All words of the query, joined by "and". None, so that only vectors are searched, if a word has signs of the query language that make
    it none; with `strict` these are an error, as they are where a text query stands alone."""
    terms: list[str] = []
    for word in (text or "").strip().split(" "):
        if not word:
            continue
        if re.search(r"[()!&|<:]", word) or word.count("'") % 2:
            if strict:
                raise ValueError(f"no text query: {word!r}")
            return None
        terms += term_list(word)
    return TextQuery(tuple(dict.fromkeys(terms))) if terms else None


def parse_web(text: str | None) -> TextQuery | None:
    """The query as written for a web search: words, "phrases", or between two of them, -without. Never an error; None if nothing is asked.

    An "or" that does not stand between two words or phrases is passed over."""
    groups: list[list[tuple[str, ...]]] = []  # of each what may be there
    without: list[str] = []
    joins = after_positive = False
    for minus, quoted, word in re.findall(r'(-?)"([^"]*)"|(\S+)', text or ""):
        if word.lower() == "or":
            joins = after_positive
            continue
        negative = minus == "-" or (word.startswith("-") and len(word) > 1)
        found = term_list(quoted or word)
        if negative:
            without += found
        for item in [] if negative or not found else [tuple(found)] if quoted else [(t,) for t in found]:
            if joins:
                groups[-1].append(item)
            else:
                groups.append([item])
            joins = False
        after_positive, joins = bool(found) and not negative, False
    single = [g[0] for g in groups if len(g) == 1]
    query = TextQuery(
        tuple(dict.fromkeys(g[0] for g in single if len(g) == 1)), tuple(tuple(dict.fromkeys(g)) for g in groups if len(g) > 1),
        tuple(dict.fromkeys(g for g in single if len(g) > 1)), tuple(dict.fromkeys(without)),
    )
    return None if query.empty else query


@dataclass(frozen=True)
class Resolved:
    """A search request with everything filled in."""

    query: str
    kind: str
    k: dict[str, int] = field(default_factory=dict)
    mode: str | None = None


def resolve(tool: str, args: dict) -> Resolved:
    """What a call of a tool (syntax, concepts, docs) searches: given values, else those of its preset, else the defaults. Raises ValueError
    for a blank query or an unknown tool."""
    query = str(args.get("query") or "").strip()
    if not query:
        raise ValueError("query must not be empty")
    if tool == "syntax":
        mode = "syntax"
    elif tool == "concepts":
        mode = "deep" if args.get("deep") else "concept"
    elif tool == "docs":
        mode = normalize_choice(args.get("mode"), set(PRESETS), "")
    else:
        raise ValueError(f"unknown tool: {tool}")
    kind, preset = PRESETS.get(mode, ("all", DEFAULT_K))
    chosen = normalize_choice(args.get("corpus", kind) or "all", {"all", *KINDS}, "all") if "corpus" in args else kind
    k = {name: normalize_k(args[f"k_{name}"], preset[name]) if f"k_{name}" in args else preset[name] for name in DEFAULT_K}
    return Resolved(query, chosen, k, mode or None)
