import random

from pyspark.sql import functions as F

from lexharbor.operators.chunking import chunk_guide, chunk_reference, chunk_stats, dedup_ids, lines, sections, split_words, with_boundaries
from lexharbor.operators.pages import code_lines, extract, mend_code
from lexharbor.operators.ranking import row_numbers

TABLE = "|Command group|Flag affected|Reversible|Execute on client|\n|---|---|---|---|\n|Valves|YES|NO|YES|"


def brute_boundaries(text, ahead=9):
    rows, out = text.split("\n"), []
    for i, line in enumerate(rows):
        s = line.strip()
        name = s[2:].strip().translate(str.maketrans("", "", "`*_")).strip() if s.startswith("##") and s[2:3].isspace() else ""
        if not name or name == "Syntax" or name.startswith("•"):
            continue
        for after in rows[i + 1 : i + 1 + ahead]:
            if "|Command group|" in after:
                out.append((i, name))
                break
            if after.strip().startswith("##"):
                break
    return out


def test_boundaries_against_brute_force(spark):
    rnd = random.Random(1)
    texts = {f"d{n}": "\n".join(rnd.choice(["## A", "## **B**", "## Syntax", "### C", "## • x", "text", "", "|Command group|x|", "## D |Command group|", "##"]) for _ in range(60)) for n in range(8)}
    df = spark.createDataFrame(list(texts.items()), "doc string, md string")
    got = {}
    for r in with_boundaries(lines(df)).where("boundary").orderBy("line_no").collect():
        got.setdefault(r.doc, []).append((r.line_no, r.heading))
    assert got == {d: b for d, t in texts.items() if (b := brute_boundaries(t))}


def test_sections_keep_all_lines(spark):
    text = f"before\n## A\n{TABLE}\nx\n\n## B\ny\n## C\n{TABLE}"
    df = spark.createDataFrame([("m", text), ("e", ""), ("n", None)], "doc string, md string")
    got = {(r.doc, r.section): (r.heading, r.text) for r in sections(with_boundaries(lines(df))).collect()}
    assert got == {("m", 0): (None, "before"), ("m", 1): ("A", f"## A\n{TABLE}\nx\n\n## B\ny"), ("m", 2): ("C", f"## C\n{TABLE}"), ("e", 0): (None, "")}


def test_split_words(spark):
    cases = {"a": "w " * 700, "b": " ".join(f"w{i}" for i in range(701)), "c": "", "d": " \n", "e": " ".join(f"w{i}" for i in range(1350))}
    df = spark.createDataFrame([*cases.items(), ("n", None)], "id string, text string").withColumn("part_of", F.lit("clash"))
    got = {}
    for r in split_words(df).collect():
        got.setdefault(r.id, []).append((r.part, r.n_parts, r.text))
    assert got["a"] == [(None, 1, cases["a"])] and got["c"] == [(None, 1, "")] and got["d"] == [(None, 1, " \n")] and got["n"] == [(None, 1, None)]
    for key, n in (("b", 2), ("e", 3)):
        words = cases[key].split()
        assert sorted(got[key]) == [(i, n, " ".join(words[i * 450 : i * 450 + 500])) for i in range(n)]


def test_ids_and_stats(spark):
    df = spark.createDataFrame([("x", 1, "a b"), ("x", 2, "c"), ("y", 3, None), ("x", 4, "d e f"), (None, 5, ""), (None, 6, "")], "id string, pos int, text string")
    assert [(r.pos, r.id) for r in dedup_ids(df).orderBy("pos").collect()] == [(1, "x"), (2, "x_2"), (3, "y"), (4, "x_3"), (5, None), (6, None)]
    assert [tuple(r) for r in chunk_stats(df.withColumn("corpus", F.lit("c"))).collect()] == [("c", 6, 1, 0, 3)]
    assert chunk_stats(df.withColumn("corpus", F.lit("c")).limit(0)).count() == 0


def test_row_numbers_of_a_hot_key(spark):
    df = spark.range(2000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 'a', cast(id as string))) AS k", "id")
    plain = {(r.k, r.id, r.n) for r in row_numbers(df, ["k"], ["id"]).collect()}
    assert {(r.k, r.id, r.n) for r in row_numbers(df, ["k"], ["id"], hot=100).collect()} == plain and len(plain) == 2000


def test_reference_chunks(spark):
    long = "word " * 900
    text = f"intro f() and\n|Function group|Execute on client|Platform(s)|\n|---|---|---|\n|Num|YES|All|\n\n## **g(**)\n|Function group|Execute on client|Platform(s)|\n|---|---|---|\n|Num|NO|macOS|\n{long}\n## h\nno table here"
    df = spark.createDataFrame([("m", text)], "doc string, md string")
    got = {r.id: r for r in chunk_reference(df, "functions").collect()}
    assert set(got) == {"fn_f", "fn_g_p0", "fn_g_p1", "fn_g_p2"}
    assert got["fn_f"].text.startswith("Function: f() | Group: Num | Client: YES | Platform: All\n\nintro f()") and got["fn_f"].metadata.part is None
    assert got["fn_g_p1"].metadata.part == 1 and got["fn_g_p1"].text.startswith("Function: g() | Group: Num | Client: NO | Platform: macOS\n\nword word")
    commands = spark.createDataFrame([("m", f"lost\n## **Open**\n{TABLE}\nx\n## **Open**\n{TABLE}\ny"), ("n", None)], "doc string, md string")
    assert [r.id for r in chunk_reference(commands, "commands").orderBy("pos").collect()] == ["cmd_open", "cmd_open_2"]
    assert chunk_reference(commands.limit(0), "commands").count() == 0


def test_guide_chunks(spark):
    many = lambda w, n=40: " ".join([w] * n)
    text = "\n".join(["## Early", many("e"), "## **Chapter 2—Lists**", "## • bullet", many("b"), "## First", many("f"), "## Notes", many("n"), "## Small", "few", "## **Chapter 4—Tools**", many("t"), "## Hidden", many("h"), "## **Chapter 5—Files **", "x", "## Große", many("g", 800)])
    got = {r.id: r for r in chunk_guide(spark.createDataFrame([("m", text)], "doc string, md string")).collect()}
    assert set(got) == {"prog_ch02_first", "prog_ch04_chapter_4tools", "prog_ch05_groe_p0", "prog_ch05_groe_p1"}
    m = got["prog_ch05_groe_p1"].metadata
    assert (m.chapter_number, m.chapter_title, m.section, m.word_count, m.part) == (5, "Files", "Große", 352, 1)
    assert got["prog_ch02_first"].text.startswith("Programming | Chapter 2: Lists | Section: First\n\n## First\nf f")


def test_code_repair(spark):
    assert mend_code("a\n```\nx=1\nfo r\n\nif ab\nother\n```\n", ["x = 1", "x =  1", "if a b then", "fo rever"]) == "a\n```\nx =  1\nfo r\n\nif a b\nother\n```\n"
    assert mend_code("```\nx\n```", []) == "```\nx\n```" and mend_code("```text\nx\n```", ["x y"]) == "```text\nx\n```"
    words = spark.createDataFrame([("d", 1, "b", 2.0, 7.4, "X"), ("d", 1, "a", 1.0, 6.6, "MonoX"), ("d", 2, "p", 1.0, 1.0, "Serif"), ("d", 2, "q", 2.0, 1.0, "Mono")], "doc string, page int, text string, x0 double, top double, fontname string")
    assert [tuple(r) for r in code_lines(words).collect()] == [("d", 1, 7, "a b")]
    pages = spark.createDataFrame([("d", 2, "two"), ("d", 1, "```\nab\n```"), ("d", 3, "skipped")], "doc string, page int, md string")
    assert [tuple(r) for r in extract(pages, words, [3]).collect()] == [("d", "```\na b\n```\n\ntwo")]


def brute_mended(line, lines):
    key = "".join(line.split())
    same = [x for x in lines if "".join(x.split()) == key]
    longer = [x for x in lines if "".join(x.split()).startswith(key)]
    if not key or not longer:
        return line
    if same:
        return same[-1]
    return next(longer[0][:n] for n in range(len(longer[0]) + 1) if sum(x != " " for x in longer[0][:n]) == len(key))


def test_mended_lines_against_brute_force():
    rnd = random.Random(4)
    make = lambda: "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 6)))
    for _ in range(300):
        lines = [make() for _ in range(rnd.randint(0, 8))]
        for line in [make() for _ in range(6)]:
            assert mend_code(f"```\n{line}x\n```".replace("x", ""), lines) == f"```\n{brute_mended(line, lines)}\n```" or not line
