"""From Markdown manuals to chunks with metadata. All windows are over one document, so a corpus of many documents has as many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.functions import metadata
from lexharbor.functions.text import clean, heading, slug, strip, word_count, word_windows, words
from lexharbor.operators.ranking import row_numbers

# Second-level headings that begin no entry; those a publisher adds are given by parameter.
SUBSECTIONS = ("Syntax", "Description", "Options", "Example", "Examples", "Parameters", "Notes", "Note", "Commands", "Functions", "About This Manual", "Copyright info")
# Signs of an entry's table, and the form of a chapter's heading.
MARKERS = ("|Command group|", "|Function group|")
CHAPTER = r"^## \*\*Chapter (\d+)—([^\n]+?)\*\*\s*$"
MAX_WORDS, SIZE, OVERLAP, LOOK_AHEAD, LEAST_WORDS = 700, 500, 50, 9, 30


def lines(docs: DataFrame, doc: str = "doc", text: str = "md") -> DataFrame:
    """doc, line_no INT from 0, line: the lines of each text, which end at \\n only. A NULL text has none, an empty one an empty line."""
    return docs.select(doc, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def has_marker(line: Column, markers: Sequence[str] = MARKERS) -> Column:
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(line, F.lit(m))
    return found


def with_boundaries(numbered: DataFrame, markers: Sequence[str] = MARKERS, subsections: Sequence[str] = SUBSECTIONS, look_ahead: int = LOOK_AHEAD, doc: str = "doc") -> DataFrame:
    """The lines with heading (of second-level heading lines, else NULL) and boundary BOOLEAN: whether an entry begins there.

    It does if the heading is no subsection and no bullet and one of the next `look_ahead` lines holds a marker before or as another heading
    line comes. Repeated (doc, line_no) are not expected."""
    w = Window.partitionBy(doc).orderBy("line_no")
    ahead = w.rowsBetween(1, look_ahead)
    named = numbered.withColumn("heading", heading(F.col("line")))
    table = F.min(F.when(has_marker(F.col("line"), markers), F.col("line_no"))).over(ahead)
    other = F.min(F.when(F.startswith(strip(F.col("line")), F.lit("##")), F.col("line_no"))).over(ahead)
    named = named.withColumn("_table", table).withColumn("_other", other)
    begins = F.col("heading").isNotNull() & ~F.col("heading").isin(*subsections) & ~F.startswith("heading", F.lit("•")) & (F.col("_table") <= F.coalesce("_other", "_table"))
    return named.withColumn("boundary", F.coalesce(begins, F.lit(False))).drop("_table", "_other")


def sections(bounded: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, section INT, heading, text: the lines from one boundary to the next, joined and stripped. Section 0, without a heading, is what
    stands before the first boundary."""
    w = Window.partitionBy(doc).orderBy("line_no")
    numbered = bounded.withColumn("section", F.sum(F.col("boundary").cast("int")).over(w))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    return numbered.groupBy(doc, "section").agg(F.max(F.when(F.col("boundary"), F.col("heading"))).alias("heading"), strip(body).alias("text"))


def split_words(df: DataFrame, text: str = "text", max_words: int = MAX_WORDS, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """`df` with part INT and n_parts INT: rows of more than `max_words` words become overlapping windows of words (white space then is one
    blank), numbered from 0; the others stay, with a NULL part. ceil(words / (size - overlap)) parts, so the last may lie within the one before."""
    others = [c for c in df.columns if c != text]
    df = df.withColumn("_words", words(F.col(text)))
    large = F.coalesce(F.size("_words"), F.lit(0)) > max_words
    parts = F.when(large, word_windows(F.col("_words"), size, overlap)).otherwise(F.array(F.col(text)))
    out = df.select(*others, large.alias("_large"), F.ceil(F.size("_words") / (size - overlap)).cast("int").alias("n_parts"), F.posexplode(parts).alias("_part", text))
    return out.select(*others, F.col(text), F.when(F.col("_large"), F.col("_part")).cast("int").alias("part"), F.when(F.col("_large"), F.col("n_parts")).otherwise(1).alias("n_parts"))


def dedup_ids(df: DataFrame, id_: str = "id", order: Sequence[str] = ("pos",), scope: Sequence[str] = ()) -> DataFrame:
    """`df` with the n-th row of an id, in `order`, getting the suffix _n from the second on. A suffixed id may meet one that was there; the
    counter is that of the id before the suffix."""
    return row_numbers(df, [*scope, id_], list(order), "_n").withColumn(id_, F.when(F.col("_n") > 1, F.concat(F.col(id_), F.lit("_"), F.col("_n").cast("string"))).otherwise(F.col(id_))).drop("_n")


def chunk_stats(df: DataFrame, by: str = "corpus", text: str = "text", total: bool = False) -> DataFrame:
    """by, n_chunks, avg_words (rounded down), min_words, max_words; no rows for an empty table. total: one more row, of all, whose `by` is
    "total". Words are counted where the texts lie."""
    n = F.col("_n")
    df = df.select(F.explode(F.array(F.col(by), F.lit("total"))).alias(by) if total else F.col(by), word_count(F.col(text)).alias("_n"))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.floor(F.sum(n) / F.count(F.lit(1))).alias("avg_words"), F.min(n).cast("long").alias("min_words"), F.max(n).cast("long").alias("max_words")
    )


def _with_part(meta: Column) -> Column:
    return meta.withField("part", F.col("part"))


def chunk_reference(docs: DataFrame, kind: str, subsections: Sequence[str] = SUBSECTIONS) -> DataFrame:
    """id, text, metadata, pos of the entries of a reference manual; docs: doc, md; kind: "commands" or "functions".

    Text is cleaned and cut at entry boundaries; sections without the word of their table are left out; entries of over 700 words are split;
    the summary goes before each part. Functions keep what stands before the first boundary, if there is one, as an entry named by the first
    `name()` in it (else abs()), never split.
    """
    functions = kind == "functions"
    word = "Function group" if functions else "Command group"
    bounded = with_boundaries(lines(docs.select("doc", clean(F.col("md")).alias("md"))), subsections=subsections)
    own = sections(bounded).where(F.contains("text", F.lit(word)))
    entries = split_words(own.where("section > 0"))
    if functions:
        some = bounded.where("boundary").select("doc").distinct()
        first = own.where("section = 0").join(some, "doc", "left_semi")
        name = F.regexp_extract("text", r"(?U)(\w+\(\))", 1)
        first = first.withColumn("heading", F.when(name == "", "abs()").otherwise(name))
        entries = entries.unionByName(first.withColumn("part", F.lit(None).cast("int")).withColumn("n_parts", F.lit(1)))
    make, prefix, short = (metadata.function_meta, metadata.function_prefix, "fn_") if functions else (metadata.command_meta, metadata.command_prefix, "cmd_")
    whole = own.select("doc", "section", F.col("text").alias("_whole"))  # the metadata is that of the entry, not of its part
    out = entries.join(whole, ["doc", "section"]).withColumn("metadata", make(F.col("_whole"), F.col("heading")))
    id_ = F.concat(F.lit(short), slug(F.col("heading")), F.when(F.col("part").isNotNull(), F.concat(F.lit("_p"), F.col("part").cast("string"))).otherwise(""))
    out = out.select(
        "doc", id_.alias("id"), F.concat(prefix(F.col("metadata")), F.lit("\n\n"), F.col("text")).alias("text"), _with_part(F.col("metadata")).alias("metadata"),
        F.struct("section", F.coalesce("part", F.lit(0)).alias("part")).alias("pos"),
    )
    return dedup_ids(out, "id", ("pos",), ("doc",))


def chunk_guide(docs: DataFrame, start: int = 2, exclude: Sequence[int] = (1, 4), source: str = "Programming", subsections: Sequence[str] = SUBSECTIONS) -> DataFrame:
    """id, text, metadata, pos of the sections of a guide; docs: doc, md.

    What stands before the heading of chapter `start` is left out (nothing, if there is none). Each second-level heading begins a section;
    chapter headings set chapter number and title for what follows. Bullet headings, subsections and sections of excluded chapters are left
    out; a chapter's own text stays if it has 30 words besides its heading, even of an excluded chapter. Sections of under 30 words are left out,
    of over 700 split.
    """
    w = Window.partitionBy("doc")
    numbered = lines(docs.select("doc", clean(F.col("md")).alias("md"))).withColumn("heading", heading(F.col("line"))).withColumn("raw", strip(F.col("line")))
    number = F.nullif(F.regexp_extract("raw", CHAPTER, 1), F.lit("")).cast("int")
    numbered = numbered.withColumn("number", number).withColumn("_from", F.coalesce(F.min(F.when(number == start, F.col("line_no"))).over(w), F.lit(0)))
    own = numbered.where("line_no >= _from").withColumn("boundary", F.col("heading").isNotNull())
    ordered = w.orderBy("line_no")
    own = own.withColumn("section", F.sum(F.col("boundary").cast("int")).over(ordered))
    own = own.withColumn("chapter", F.last("number", True).over(ordered)).withColumn("chapter_title", F.last(F.when(F.col("number").isNotNull(), strip(F.regexp_extract("raw", CHAPTER, 2))), True).over(ordered))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    parts = own.where("section > 0").groupBy("doc", "section").agg(
        F.max(F.when(F.col("boundary"), F.col("heading"))).alias("heading"), F.max(F.when(F.col("boundary"), F.col("number"))).alias("number"),
        F.coalesce(F.max("chapter"), F.lit(0)).alias("chapter"), F.coalesce(F.max("chapter_title"), F.lit("")).alias("chapter_title"), strip(body).alias("whole"),
    )
    no_bullets = lambda c: strip(F.regexp_replace(c, r"(?md)^## •.*$", ""))
    intro = no_bullets(strip(F.regexp_replace("whole", r"^##[^\n]*\n", "")))
    is_chapter = F.col("number").isNotNull()
    kept = F.when(is_chapter, word_count(intro) >= LEAST_WORDS).otherwise(~F.col("chapter").isin(*exclude) & ~F.startswith("heading", F.lit("•")) & ~F.col("heading").isin(*subsections))
    parts = parts.where(kept).withColumn("text", no_bullets(F.col("whole"))).withColumn("word_count", word_count(F.col("text"))).where(F.col("word_count") >= LEAST_WORDS)
    split = split_words(parts.drop("whole"))
    words_here = F.when(F.col("part").isNull(), F.col("word_count")).otherwise(word_count(F.col("text")))
    meta = F.struct(F.lit(source).alias("source"), F.col("chapter").alias("chapter_number"), F.col("chapter_title"), F.col("heading").alias("section"), words_here.alias("word_count"), F.col("part"))
    id_ = F.concat(F.format_string("prog_ch%02d_", "chapter"), slug(F.col("heading")), F.when(F.col("part").isNotNull(), F.concat(F.lit("_p"), F.col("part").cast("string"))).otherwise(""))
    out = split.withColumn("metadata", meta).select(
        "doc", id_.alias("id"), F.concat(metadata.guide_prefix(F.col("metadata")), F.lit("\n\n"), F.col("text")).alias("text"), "metadata",
        F.struct("section", F.coalesce("part", F.lit(0)).alias("part")).alias("pos"),
    )
    return dedup_ids(out, "id", ("pos",), ("doc",))
