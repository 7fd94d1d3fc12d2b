from pyspark.sql import functions as F

from lexharbor.functions import metadata, vectors
from lexharbor.functions.text import clean, heading, preview, slug, strip, tokens, word_count, words, words_only


def one(spark, text, *columns):
    return tuple(spark.createDataFrame([(text,)], "t string").select(*columns).first())


def test_headings(spark):
    t = F.col("t")
    for line, want in {"## **# Note**": "# Note", "##  `Begin` block ": "Begin block", "## a()": "a()", "### x": None, "##x": None, "## ``": None, "# x": None, "": None, " ## x": "x", "## x": "x"}.items():
        assert one(spark, line, heading(t)) == (want,), line
    assert one(spark, None, heading(t)) == (None,)


def test_clean_in_order(spark):
    text = "\n 1\n12 \n\n\nText\nFigure 3: valve\n==> picture [1 x 2] intentionally omitted <==\n----- Start of picture text -----\nx\n12\ny\n----- End of picture text -----\nEnd\n\n\n\nlast 5\n"
    assert one(spark, text, clean(F.col("t"))) == ("1\n\nText\n\nEnd\n\nlast 5",)
    assert one(spark, None, clean(F.col("t"))) == (None,) and one(spark, "  \n", clean(F.col("t"))) == ("",)


def test_words_and_tokens(spark):
    text = " a b c\td\n\n e\x85f "
    assert one(spark, text, words(F.col("t")), word_count(F.col("t"))) == (text.split(), 6)
    assert one(spark, "", words(F.col("t")), word_count(F.col("t"))) == ([], 0) and one(spark, None, word_count(F.col("t"))) == (0,)
    assert one(spark, "Über-Maß, 3x_y; É!", tokens(F.col("t"))) == (["über", "maß", "3x", "y", "é"],)
    assert one(spark, "a\nb" + "c" * 300, preview(F.col("t")), strip(F.col("t"))) == ("a b" + "c" * 157, "a\nb" + "c" * 300)


def test_slugs(spark):
    cases = spark.createDataFrame([(x,) for x in ("Größe -- der Liste!", "日本", "a_b c", "x" * 90, "", " \t!a\u00a0 b- ", None)], "t string")
    assert [r[0] for r in cases.select(slug(F.col("t"))).collect()] == ["groe_der_liste", "", "a_b_c", "x" * 80, "", "a_b_", None]
    assert one(spark, "É b", slug(F.col("t"))) == ("e_b",) and one(spark, None, slug(F.col("t"))) == (None,)


def test_metadata(spark):
    command = "## **X**\n|Command group|Flag affected|Reversible|Execute on client|Platform(s)|\n|---|---|---|---|---|\n|Files|YES|NO|YES<br>macOS|Windows|\nObsolete"
    got = one(spark, command, metadata.command_meta(F.col("t"), F.lit("X")))[0].asDict()
    assert got == {"source": "CommandRef", "command_name": "X", "command_group": "Files", "flag_affected": True, "reversible": False, "execute_on_client": True, "platform": "macOS", "deprecated": True, "has_options": False}
    for cell, want in {"Linux, macOS": "macOS", "Windows,Linux": "Windows", "none": "All", "All, Windows": "All"}.items():
        text = f"|Function group|Execute on client|Platform(s)|\n|---|---|---|\n|_*Text*_|no|{cell}|"
        got = one(spark, text, metadata.function_meta(F.col("t"), F.lit("f()")))[0]
        assert (got.function_group, got.platform, got.function_name, got.execute_on_client) == ("Text", want, "f", False)
    assert one(spark, "no table", metadata.command_prefix(metadata.command_meta(F.col("t"), F.lit("X")))) == ("Command: X | Group:  | Flag: NO | Reversible: NO | Client: NO | Platform: All",)


def test_titles_and_labels(spark):
    for meta, title, label in [('{"command_name": "", "section": "S"}', "S", ""), ('{"function_signature": "f()"}', "f()", "f()"), ("{}", "id", "c"), (None, "id", "c"), ('{"command_name": null, "section": "S"}', "S", "S")]:
        assert one(spark, meta, metadata.title(F.col("t"), F.lit("id")), metadata.source_label(F.col("t"), F.lit("c"))) == (title, label)


def test_json_merge_keeps_types_and_order_of_keys(spark):
    rows = [('{"b": 1, "a": {"x": [1]}}', '{"b": "two", "c": true}', '{"a":{"x":[1]},"b":"two","c":true}'), (None, '{"a": 1}', '{"a":1}'), ('{"a": 1}', None, '{"a":1}'), ("{}", "{}", "{}")]
    got = spark.createDataFrame([r[:2] for r in rows], "a string, b string").select(metadata.merged(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [r[2] for r in rows]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1.0],), (None,), ([-3.0, -4.0],)], "v array<float>")
    got = [r[0] for r in df.select(vectors.distance(F.col("v"), [6.0, 8.0])).collect()]
    assert got == [0.0, None, None, None, 2.0]
    assert [r[0] for r in df.select(vectors.normalized(F.col("v"))).limit(2).collect()] == [[0.6000000238418579, 0.800000011920929], [0.0, 0.0]]
    assert df.where("size(v) = 1").select(vectors.checked(F.col("v"), 1)).first()[0] == [1.0]


def test_words_only_are_the_tokens(spark):
    for text in ("", "  ", "--a.B_c\n ÄÖ\u0301x 9² İstanbul", "x", "\tx\xa0y, ", None):
        got, found = one(spark, text, words_only(F.col("t")), tokens(F.col("t")))
        assert got == (None if found is None else " ".join(found)), text
