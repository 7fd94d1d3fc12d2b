import numpy as np
import pytest
from pyspark.sql import functions as F

from lexharbor.llm.languages import CODES, Setting, label_code, languages, mislabelled, passages, sentences, train

SAY = {
    "en": ["The window is closed before the report has been printed.", "You can read the value again when the list is empty.", "Nothing is sent until all of the other users have finished.", "We found that this button has no effect on slow machines."],
    "de": ["Das Fenster wird geschlossen, bevor der Bericht gedruckt ist.", "Sie können den Wert noch einmal lesen, wenn die Liste leer ist.", "Es wird nichts gesendet, bis alle anderen Benutzer fertig sind.", "Wir haben gesehen, dass dieser Knopf auf langsamen Rechnern nichts bewirkt."],
    "fr": ["La fenêtre est fermée avant que le rapport soit imprimé.", "Vous pouvez relire la valeur quand la liste est vide.", "Rien n'est envoyé avant que tous les autres utilisateurs aient fini.", "Nous avons vu que ce bouton n'a aucun effet sur les machines lentes."],
    "ru": ["Окно закрывается раньше, чем напечатан отчёт.", "Вы можете снова прочитать значение, когда список пуст.", "Ничего не отправляется, пока все остальные не закончили работу.", "Мы заметили, что эта кнопка не работает на медленных машинах."],
}
CODE = "    Assign #S1 := iMenuValue & 'file path' & #F\n    Until iItemName == kTaskPos or iItemName <> 201\n    Call lockPrice(lPriceIndex, lDateFlag) // 476\n"
SCHEMA = "doc_id long, text string, lang string, segment string"


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for code, said in SAY.items():
        for i in range(40):
            text = " ".join(rng.choice(said, 3)) + ("\n\n" + CODE if i % 3 == 0 else "")
            wrong = i % 10 == 0
            rows.append((n, text, {"en": "de", "de": "en", "fr": "en", "ru": "fr"}[code] if wrong else code, code))
            n += 1
    return rows


@pytest.fixture(scope="module")
def model(spark, corpus):
    return train(spark.createDataFrame([(*r[:3], "clash") for r in corpus], SCHEMA))


def test_wrong_labels_do_not_spoil_the_centroids(spark, corpus, model):
    assert model.languages == ["de", "en", "fr", "ru"]
    df = spark.createDataFrame([(*r[:3], "clash") for r in corpus], SCHEMA)
    got = {tuple(r) for r in mislabelled(df, model).collect()}
    assert got == {(n, code) for n, _, label, code in corpus if label != code}


def test_labels_passages_code_and_empty(spark, model):
    en, de, fr = (" ".join(SAY[c][:2]) for c in ("en", "de", "fr"))
    rows = [(1, en, "EN-us"), (2, en, None), (3, en, "n/a"), (4, en, "Deutsch"), (5, f"{en}\n\n{CODE}\n{de} {en}", "en"), (6, CODE, None), (7, "", "en"), (8, None, None), (9, " \n ", "de"), (10, en + " Bonjour!", "english"), (11, de.upper(), "ger"), (12, fr, "xx"), (13, en, "de"), (13, en, "German"), (14, f"{fr} " * 3000, "fre")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    assert {tuple(r) for r in mislabelled(df, model).collect()} == {(2, "en"), (3, "en"), (4, "en"), (5, "en"), (5, "de"), (12, "fr"), (13, "en")}
    found = passages(df.where("doc_id <> 13"), model).collect()
    of = {}
    for r in found:
        of.setdefault(r.doc_id, []).append(r)
    text = dict((r[0], r[1]) for r in rows)
    assert [r.lang for r in of[5]] == ["en", "de", "en"] and [r.segment for r in of[5]] == [0, 1, 2]
    assert [text[5][r.char_start : r.char_end].strip() for r in of[5]] == [en, de, en]
    for d in (6, 7, 8, 9):
        assert [(r.segment, r.lang, r.sentences, r.confidence) for r in of[d]] == [(None, None, 0, 0.0)]
    assert [(r.lang, r.sentences) for r in of[14]] == [("fr", 6000)]
    assert all(0.5 < r.confidence <= 1 for r in found if r.lang)
    each = {(r.doc_id, r.lang): r.sentences for r in languages(passages(df, model)).collect()}
    assert each[5, "en"] == 4 and each[5, "de"] == 2 and each[8, None] == 0


def test_unknown_language_is_rejected(spark, model):
    df = spark.createDataFrame([(1, "Ikkuna suljetaan ennen kuin raportti on tulostettu kokonaan. Lista oli tyhjä koko yön ajan.", "fi", "x"), (2, "ウィンドウはレポートが印刷される前に閉じられます。リストが空の場合は値をもう一度読むことができます。", None, "x")], SCHEMA)
    assert [r.lang for r in passages(df, model).collect()] == [None, None]


def test_spellings(spark):
    want = {"en": "en", "EN": "en", " en_GB ": "en", "eng": "en", "German": "de", "de-DE": "de", "Português": "pt", "pt-BR": "pt", "und": None, "": None, "-": None, "n/a": None, "zxx": None, "unknown": None, "(fr)": "fr", None: None}
    got = spark.createDataFrame([(k,) for k in want], "l string").select("l", label_code(F.col("l")).alias("c")).collect()
    assert {r.l: r.c for r in got} == want
    assert len(set(CODES.values())) > 40


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    model = train(df)
    assert model.languages == [] and mislabelled(df, model).count() == 0 and passages(df, model).count() == 0
    one = spark.createDataFrame([(1, SAY["en"][0], "en", "x")], SCHEMA)
    assert [r.lang for r in passages(one, train(one)).collect()] == [None]  # too few labelled documents


def test_sentences_keep_offsets():
    text = "First of all, this is a sentence. Then: another one stands here!\r\nkNodeSize = 4\nHi."
    assert [text[a:b].strip() for a, b, _ in sentences(text, Setting())] == ["First of all, this is a sentence.", "Then: another one stands here!"]


def test_repeated_documents_leave_the_model_as_it_is(spark):
    from lexharbor.llm.languages import fit

    rows = [(i, ("The pump is opened before the tank is filled with water again. " if i % 2 else "Die Pumpe wird geöffnet, bevor der Behälter wieder mit Wasser gefüllt wird. ") * 3, "en" if i % 2 else "German") for i in range(40)]
    one = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    again = spark.createDataFrame([*rows, *rows[:7] * 50], "doc_id long, text string, lang string").repartition(5)
    a, b = (train(df) for df in (one, again))
    assert a.languages == b.languages == ["de", "en"]
    drawn = [fit([(t, {"German": "de"}.get(c, c)) for _, t, c in sorted(rows, key=lambda r: str(r[0]))], b.weights)]
    assert np.allclose(b.centroids, drawn[0].centroids, atol=1e-5) and np.array_equal(*(train(again.orderBy(o)).centroids for o in ("doc_id", "text")))
