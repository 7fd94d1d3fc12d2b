"""Metadata of reference entries, read from their tables, and the one-line summaries that go before their text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexharbor.functions.text import strip

# The tables' first lines, what stands below them, and the words looked for.
COMMAND_TABLE = r"(?s)\|Command group\|Flag affected\|Reversible\|Execute on client.*?\n\|[-|]+\|\n\|([^|]+)\|([^|]+)\|([^|]+)\|([^|]+)\|"
FUNCTION_TABLE = r"(?s)\|Function group\|Execute on client\|Platform.*?\n\|[-|]+\|\n\|([^|]+)\|([^|]+)\|([^|]+)\|"
PLATFORMS = "(All|Windows|macOS)"
DEPRECATED = "(?i)deprecated|obsolete"
OPTIONS = r"\*\*Options\*\*|\n## .*Option"
EXAMPLES = ("## **Example", "## **Examples")


def _yes(cell: Column) -> Column:
    return F.contains(F.upper(cell), F.lit("YES"))


def _platform(cell: Column) -> Column:
    found = F.regexp_extract(cell, PLATFORMS, 1)
    return F.when(found == "", "All").otherwise(found)


def command_meta(text: Column, name: Column) -> Column:
    """STRUCT of a command's entry: source, command_name, command_group, flag_affected, reversible, execute_on_client, platform,
    deprecated, has_options. Without a table the group is empty, the flags are false and the platform is All. The platform is looked for
    in the client's cell."""
    cell = lambda i: F.regexp_extract(text, COMMAND_TABLE, i)
    return F.struct(
        F.lit("CommandRef").alias("source"), name.alias("command_name"), strip(cell(1)).alias("command_group"), _yes(cell(2)).alias("flag_affected"),
        _yes(cell(3)).alias("reversible"), _yes(cell(4)).alias("execute_on_client"), _platform(cell(4)).alias("platform"),
        text.rlike(DEPRECATED).alias("deprecated"), text.rlike(OPTIONS).alias("has_options"),
    )


def function_meta(text: Column, signature: Column) -> Column:
    """STRUCT of a function's entry: source, function_name, function_signature, function_group, execute_on_client, platform, has_example."""
    cell = lambda i: F.regexp_extract(text, FUNCTION_TABLE, i)
    return F.struct(
        F.lit("FunctionRef").alias("source"), strip(F.regexp_replace(signature, r"[()]+$", "")).alias("function_name"), signature.alias("function_signature"),
        strip(F.translate(cell(1), "_*", "")).alias("function_group"), _yes(cell(2)).alias("execute_on_client"), _platform(cell(3)).alias("platform"),
        (F.contains(text, F.lit(EXAMPLES[0])) | F.contains(text, F.lit(EXAMPLES[1]))).alias("has_example"),
    )


def _yes_no(flag: Column) -> Column:
    return F.when(flag, "YES").otherwise("NO")


def command_prefix(meta: Column) -> Column:
    """The one-line summary of a command."""
    m = meta.getField
    end = F.when(m("deprecated"), " | DEPRECATED").otherwise("")
    return F.concat(
        F.lit("Command: "), m("command_name"), F.lit(" | Group: "), m("command_group"), F.lit(" | Flag: "), _yes_no(m("flag_affected")), F.lit(" | Reversible: "),
        _yes_no(m("reversible")), F.lit(" | Client: "), _yes_no(m("execute_on_client")), F.lit(" | Platform: "), m("platform"), end,
    )


def function_prefix(meta: Column) -> Column:
    """The one-line summary of a function."""
    m = meta.getField
    return F.concat(F.lit("Function: "), m("function_signature"), F.lit(" | Group: "), m("function_group"), F.lit(" | Client: "), _yes_no(m("execute_on_client")), F.lit(" | Platform: "), m("platform"))


def guide_prefix(meta: Column) -> Column:
    """The one-line summary of a section of a guide."""
    m = meta.getField
    return F.concat(m("source"), F.lit(" | Chapter "), m("chapter_number").cast("string"), F.lit(": "), m("chapter_title"), F.lit(" | Section: "), m("section"))


def title(meta: Column, external_id: Column) -> Column:
    """The first of command name, function signature, section that is not empty, else the id; meta is a JSON text."""
    field = lambda name: F.nullif(F.get_json_object(meta, f"$.{name}"), F.lit(""))
    return F.coalesce(field("command_name"), field("function_signature"), field("section"), external_id)


def source_label(meta: Column, corpus: Column) -> Column:
    """The first of command name, function signature, section that is there, even if empty, else the corpus; meta is a JSON text."""
    field = lambda name: F.get_json_object(meta, f"$.{name}")
    return F.coalesce(field("command_name"), field("function_signature"), field("section"), corpus)


def merged(old: Column, new: Column) -> Column:
    """Two JSON objects as one text: keys of both, the new one's value where both have it, keys in order. NULL counts as no keys."""
    of = lambda c: F.from_json(F.coalesce(c, F.lit("{}")), "map<string,variant>")
    return F.to_json(_by_key(of(old), of(new)))


def _by_key(old: Column, new: Column) -> Column:
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    entries = F.array_sort(F.concat(F.map_keys(kept), F.map_keys(new)))
    both = F.map_concat(kept, new)
    return F.map_from_arrays(entries, F.transform(entries, lambda k: F.element_at(both, k)))
