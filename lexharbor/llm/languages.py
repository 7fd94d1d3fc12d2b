"""The language of each document and of each passage: nearest of several centroids per language, with rejection by distance.

Sentences become normalised TF-IDF vectors of hashed letter bigrams and trigrams. Several centroids per language are fitted on a bounded
sample of labelled documents whose labels may be wrong: sentences nearer to another language's centroid than to their label's are left
out before the centroids are clustered. A sentence takes the language of the nearest centroid by cosine, unless it is farther from it
than sentences of that language are; then it has none.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ISO 639-1 code, then the other codes and names by which a label may name the language.
NAMES = {
    "en": "eng english englisch anglais inglés", "de": "deu ger german deutsch allemand alemán", "fr": "fra fre french français francais französisch",
    "es": "spa spanish español espanol spanisch castellano", "it": "ita italian italiano italienisch", "pt": "por portuguese português portugues portugiesisch",
    "nl": "nld dut dutch nederlands niederländisch", "ru": "rus russian русский russisch", "pl": "pol polish polski", "cs": "ces cze czech čeština",
    "sk": "slk slo slovak slovenčina", "sl": "slv slovenian slovenščina", "hr": "hrv croatian hrvatski", "sr": "srp serbian српски", "bg": "bul bulgarian български",
    "uk": "ukr ukrainian українська", "be": "bel belarusian", "ro": "ron rum romanian română", "hu": "hun hungarian magyar", "el": "ell gre greek ελληνικά",
    "tr": "tur turkish türkçe", "sv": "swe swedish svenska", "da": "dan danish dansk", "no": "nor nob nno nb nn norwegian norsk", "fi": "fin finnish suomi",
    "et": "est estonian eesti", "lv": "lav latvian", "lt": "lit lithuanian", "ca": "cat catalan català", "gl": "glg galician galego", "eu": "eus baq basque euskara",
    "ar": "ara arabic العربية", "he": "heb hebrew iw עברית", "fa": "fas per persian farsi", "hi": "hin hindi हिन्दी", "bn": "ben bengali", "th": "tha thai ไทย",
    "vi": "vie vietnamese", "id": "ind indonesian in", "ms": "msa may malay", "ja": "jpn japanese 日本語", "ko": "kor korean 한국어", "zh": "zho chi chinese 中文",
}
CODES = {name: code for code, names in NAMES.items() for name in [code, *names.split()]}


#: Sentences whose n-grams are held at a time; so many that they stay in a core's cache.
BLOCK = 500


@dataclass(frozen=True)
class Setting:
    """How the classifier is fitted. The sample is bounded by per_label x labels documents of at most sample_chars characters."""

    per_label: int = 200  # labelled documents of each language the centroids are fitted on, at most
    sample_chars: int = 6000  # longer documents are not in the sample (they are classified whole as all others)
    centroids: int = 4  # of each language
    least_documents: int = 5  # labelled documents without which a language is not known
    buckets: int = 1 << 15  # hashed n-grams
    quantile: float = 0.002  # of a centroid's own sentences that may be farther from it than its limit, before slack
    slack: float = 0.8  # the limit as a part of that cosine
    words: int = 4  # least words of a sentence
    letters: int = 14  # least letters of a sentence
    heat: float = 0.03  # of the confidence


def label_code(label: Column) -> Column:
    """The two-letter code a label names, however spelled (EN, en-US, eng, English, Deutsch, ...); NULL if it names no language."""
    name = F.lower(F.regexp_replace(label, r"(?U)^[\s\p{P}]+|[\s\p{P}]+$", ""))
    table = F.create_map(*[F.lit(x) for pair in sorted(CODES.items()) for x in pair])
    return F.coalesce(F.try_element_at(table, name), F.try_element_at(table, F.regexp_extract(name, r"^([^-_@. ]+)[-_@. ]", 1)))


_LINES = re.compile(r"[^\r\n\x0b\x0c\x85  ]+")
_END = re.compile(r"(?<=[.!?…。！？])[\"'”’»)\]]*\s+")
_NAME = re.compile(r"[\d_$#\\/=<>{}|@~^*+\[\]]|\w\.\w|[a-zß-ÿ][A-Z]|\w\(|\)\w")
_NO_LETTER = re.compile(r"[^\w]|[\d_]")
_CODE = re.compile(r":=|==|<>|<=|>=|/\*|\*/|//|->|::|\{\w*\}|\w\[|\w\(|;\s*$|^\s*[#@]\w|\s[=&<>|*+]\s")
_OUTER = ".,;:!?\"'()«»“”„…¿¡-–—"
#: Single signs that stand for whole Arabic phrases.
_PHRASE = re.compile("[\ufdf0-\ufdff]")
#: Scripts from here on are written without blanks between words.
_WIDE = "\u0e3a"


_CODE_SIGN = re.compile(r"[=<>*/:{\[(;#@&|+]")
#: What tokens come to, remembered up to this many of them.
_MOST_TOKENS = 200_000
_TOKENS: dict[str, tuple[str, ...]] = {}


def _token(token: str) -> tuple[str, ...]:
    word = token.strip(_OUTER)
    if word.isalpha():
        return (word.lower(),) if word[1:].islower() or word.islower() or word.isupper() or not _NAME.search(word) else ()
    return tuple(_NO_LETTER.sub(" ", word.lower()).split()) if word and not _NAME.search(word) else ()


def _words(raw: str) -> list[str]:
    """The lower-case words of a text that look like no name of code and no number."""
    if not raw.isascii():
        raw = unicodedata.normalize("NFKC", _PHRASE.sub(" ", raw))
    out: list[str] = []
    for token in raw.split():
        known = _TOKENS.get(token)
        if known is None:
            if len(_TOKENS) >= _MOST_TOKENS:
                _TOKENS.clear()
            known = _TOKENS[token] = _token(token)
        out += known
    return out


def sentences(text: str, s: Setting) -> list[tuple[int, int, str]]:
    """(start, end, plain) of what may be a sentence of a natural language: lower-case words without names of code, numbers and signs."""
    out = []
    for line in _LINES.finditer(text):
        a, end = line.span()
        for b in [*[m.end() for m in _END.finditer(text, a, end)], end]:
            raw = text[a:b]
            words = _words(raw)
            plain = " ".join(words)
            if len(plain) - len(words) + 1 >= s.letters:
                wide = 0 if raw.isascii() else sum(x > _WIDE for x in plain)
                if (len(words) >= s.words or 2 * wide >= s.letters) and (not _CODE_SIGN.search(raw) or 4 * len(_CODE.findall(raw)) <= len(words)):
                    out.append((a, b, f" {plain} "))
            a = b
    return out


def grams(plains: list[str], s: Setting) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, bucket, count) of the letter bigrams and trigrams, each once per sentence, in the order of the sentences."""
    codes = np.frombuffer("\n".join([*plains, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    end = codes == 10
    of = (np.cumsum(end) - end).astype(np.uint64)
    if len(codes) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    of *= np.uint64(s.buckets)
    pair = (codes[:-1].astype(np.uint64) << np.uint64(21)) | codes[1:]
    kind = np.uint32 if len(plains) * s.buckets < 1 << 32 else np.uint64
    keys = [_hashed(pair, of, ~(end[:-1] | end[1:]), s, kind)]
    if len(codes) > 2:
        keys.append(_hashed((pair[:-1] << np.uint64(21)) | codes[2:], of, ~(end[:-2] | end[1:-1] | end[2:]), s, kind))
    both = np.concatenate(keys)
    both.sort()
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(both)])
    both = both[first].astype(np.int64)
    return both // s.buckets, both % s.buckets, count


def _hashed(gram: np.ndarray, of: np.ndarray, within: np.ndarray, s: Setting, kind: type) -> np.ndarray:
    """sentence x buckets + bucket of the n-grams, given as one number each, that lie within a sentence."""
    h = gram[within] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (of[: len(within)][within] + (h >> np.uint64(40)) % np.uint64(s.buckets)).astype(kind)


@dataclass
class Model:
    """Centroids, a column each, with the language and the least cosine of each."""

    languages: list[str]
    weights: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    least: np.ndarray
    setting: Setting

    def cosines(self, plains: list[str]) -> np.ndarray:
        """The cosine of each sentence with each centroid."""
        out = np.zeros((len(plains), self.centroids.shape[1]), np.float32)
        for lo in range(0, len(plains), BLOCK):
            row, bucket, count = grams(plains[lo : lo + BLOCK], self.setting)
            if len(row):
                w = self.weights[bucket]
                many = count > 1
                w[many] *= (1 + np.log(count[many])).astype(np.float32)
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                norm = np.sqrt(np.add.reduceat(w * w, first))
                w /= np.where(norm > 0, norm, 1).repeat(np.diff(np.r_[first, len(row)]))
                one = np.empty(len(row), np.float32)
                dots = np.empty((self.centroids.shape[1], len(first)), np.float32)
                for j, c in enumerate(self.centroids.T):  # one after the other: several times as fast as all at once
                    np.take(c, bucket, out=one, mode="clip")
                    one *= w
                    np.add.reduceat(one, first, out=dots[j])
                out[lo + row[first]] = dots.T
        return out

    def classify(self, plains: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(language, confidence): the index of each sentence's language, -1 where it is too far from all centroids."""
        if not plains or not self.languages:
            return np.full(len(plains), -1), np.zeros(len(plains))
        cos = self.cosines(plains)
        best = np.stack([cos[:, self.of == i].max(axis=1) for i in range(len(self.languages))], axis=1)
        lang = best.argmax(axis=1)
        near = cos.argmax(axis=1)
        odds = np.exp((best - best.max(axis=1, keepdims=True)) / self.setting.heat)
        sure = odds.max(axis=1) / odds.sum(axis=1)
        far = cos[np.arange(len(cos)), near] < self.least[near]
        return np.where(far, -1, lang), np.where(far, 0, sure)


def _unit(c: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(c, axis=0)
    return (c / np.where(norm > 0, norm, 1)).astype(np.float32)


def fit(labelled: list[tuple[str, str]], weights: np.ndarray, s: Setting = Setting(), seed: int = 5) -> Model:
    """The model of (text, code) pairs; weights: the inverse document frequency of each bucket."""
    number: dict[str, int] = {}
    for _, code in labelled:
        number[code] = number.get(code, 0) + 1
    languages = sorted(c for c, n in number.items() if n >= s.least_documents)
    plains, label = [], []
    for text, code in labelled:
        if code in languages:
            for _, _, plain in sentences(text, s):
                plains.append(plain)
                label.append(languages.index(code))
    if not plains:
        return Model([], weights, np.zeros((s.buckets, 0), np.float32), np.zeros(0, int), np.zeros(0, np.float32), s)
    label, n = np.array(label), len(languages)
    parts = [grams(plains[lo : lo + 4000], s) for lo in range(0, len(plains), 4000)]
    row = np.concatenate([r + 4000 * i for i, (r, _, _) in enumerate(parts)])
    bucket = np.concatenate([b for _, b, _ in parts])
    value = ((1 + np.log(np.concatenate([c for _, _, c in parts]))) * weights[bucket]).astype(np.float32)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])  # a sentence has letters, and so n-grams
    value /= np.sqrt(np.add.reduceat(value * value, first))[row]

    def means(group: np.ndarray, k: int) -> np.ndarray:
        of = group[row]
        there = of >= 0
        return _unit(np.bincount(bucket[there] * k + of[there], value[there], s.buckets * k).reshape(s.buckets, k))

    def over(c: np.ndarray, own: int = 0) -> Iterator[tuple[slice, np.ndarray]]:
        """The cosines with all columns of c, or with the `own` columns of each sentence's label."""
        for lo in range(0, len(first), 4000):
            a, b = first[lo], first[lo + 4000] if lo + 4000 < len(first) else len(row)
            at, mine = first[lo : lo + 4000] - a, label[row[a:b]] * own
            columns = [c[bucket[a:b], mine + j] for j in range(own)] if own else [c[bucket[a:b], j] for j in range(c.shape[1])]
            yield slice(lo, lo + 4000), np.stack([np.add.reduceat(value[a:b] * x, at) for x in columns], axis=1)

    keep = np.ones(len(plains), bool)
    for _ in range(3):  # wrong labels: sentences that are nearer to another language do not count for their label's
        c = means(np.where(keep, label, -1), n)
        nearest = np.concatenate([cos.argmax(axis=1) for _, cos in over(c)])
        keep = nearest == label
    rng = np.random.default_rng(seed)
    k = s.centroids
    of = np.repeat(np.arange(n), k)
    group = np.where(keep, label * k + rng.integers(0, k, len(plains)), -1)
    for _ in range(6):
        c = means(group, n * k)
        group_of, best = np.zeros(len(plains), int), np.zeros(len(plains))
        for at, cos in over(c, k):
            group_of[at], best[at] = label[at] * k + cos.argmax(axis=1), cos.max(axis=1)
        group = np.where(keep, group_of, -1)
    used = np.array([(group == i).any() for i in range(n * k)])
    own = [best[group == i] for i in np.flatnonzero(used)]
    language_low = {i: np.quantile(best[(label == i) & keep], s.quantile) for i in range(n) if ((label == i) & keep).any()}
    least = np.array([s.slack * min(np.quantile(o, s.quantile), language_low[of[i]]) for i, o in zip(np.flatnonzero(used), own, strict=True)], np.float32)
    there = sorted({int(i) for i in of[used]})
    return Model([languages[i] for i in there], weights, np.asfortranarray(c[:, used]), np.array([there.index(i) for i in of[used]]), least, s)


def bucket_weights(docs: DataFrame, text: str, s: Setting) -> np.ndarray:
    """ln((1 + sentences) / (1 + sentences with the n-gram)) + 1 of each bucket, counted over all sentences of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(s.buckets, np.int64), 0
        for batch in batches:
            plains = [p for t in batch.column(0).to_pylist() if t for _, _, p in sentences(t, s)]
            n += len(plains)
            for lo in range(0, len(plains), BLOCK):
                seen += np.bincount(grams(plains[lo : lo + BLOCK], s)[1], minlength=s.buckets)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[used, -1]), pa.array(np.r_[seen[used], n])], names=["bucket", "n"])

    rows = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most buckets + 1 rows
    n = np.zeros(s.buckets + 1)
    for r in rows:
        n[r.bucket] = r.n
    return (np.log((1 + n[-1]) / (1 + n[:-1])) + 1).astype(np.float32)


def train(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", s: Setting = Setting()) -> Model:
    """The model of the labelled documents of `docs`: inverse document frequencies of all of them, centroids of the bounded sample."""
    code = label_code(F.col(lang))
    w = Window.partitionBy("code").orderBy("draw", doc)  # its limit is applied before the shuffle too
    short = docs.where((F.length(text) <= s.sample_chars) & (F.length(text) > 0)).select(doc, F.xxhash64(F.lit(1), F.col(doc).cast("string")).alias("draw"), code.alias("code"))
    drawn = short.where(F.col("code").isNotNull()).distinct().withColumn("n", F.row_number().over(w)).where(F.col("n") <= s.per_label)
    picked = drawn.select(F.col(doc).alias("_doc"), F.col("code").alias("_code"))  # per_label of each language at most
    of = docs.where(F.length(text) <= s.sample_chars).join(F.broadcast(picked), (F.col(doc) == F.col("_doc")) & (code == F.col("_code")))
    rows = of.groupBy("_doc", "_code").agg(F.min(text).alias("text")).collect()  # of rows of one document and label the least text: as many as were picked
    rows.sort(key=lambda r: (str(r["_doc"]), r["_code"]))
    return fit([(r["text"], r["_code"]) for r in rows], bucket_weights(docs, text, s), s)


_KEPT: dict[int, Model] = {}


def _model(key: int, sent) -> Model:
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = sent.value
    return _KEPT[key]


def passages(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc, `keep`, segment INT, char_start INT, char_end INT, lang STRING, sentences INT, confidence DOUBLE: the passages of each document in one language.

    A passage is a run of sentences of one language; what is no sentence of a natural language (code, names, numbers) neither ends it
    nor counts. Offsets are code points of the text as stored. confidence is the mean of its sentences' share of the best language among all
    known ones. A document without a sentence, with an empty or with a NULL text has one row with segment, offsets and lang NULL, 0 sentences
    and confidence 0. Repeated rows are documents of their own. Each text is read whole, by itself; nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets x centroids numbers, whatever the corpus
    key = sent._jbroadcast.id()
    rows = docs.select(doc, *keep, text)
    last = len(rows.columns) - 1
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns[:last])
    schema += ", segment int, char_start int, char_end int, lang string, sentences int, confidence double"
    names = [*rows.columns[:last], "segment", "char_start", "char_end", "lang", "sentences", "confidence"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(key, sent)
        for batch in batches:
            said, owner = [], []
            for r, t in enumerate(batch.column(last).to_pylist()):
                if t:
                    own = sentences(t, m.setting)
                    said += own
                    owner += [r] * len(own)
            lang, sure = m.classify([p for _, _, p in said])
            out: list[list] = []
            at = 0
            for r in range(batch.num_rows):
                n, before = 0, None
                while at < len(owner) and owner[at] == r:
                    if lang[at] >= 0:
                        if before is not None and before[4] == m.languages[lang[at]]:
                            before[3] = said[at][1]
                            before[5] += 1
                            before[6] += sure[at]
                        else:
                            before = [r, n, said[at][0], said[at][1], m.languages[lang[at]], 1, float(sure[at])]
                            out.append(before)
                            n += 1
                    at += 1
                if not n:
                    out.append([r, None, None, None, None, 0, 0.0])
            take = pa.array([o[0] for o in out], pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32()]
            found = [pa.array([o[i + 1] for o in out], kind) for i, kind in enumerate(kinds)]
            sure_of = pa.array([float(o[6] / o[5]) if o[5] else 0.0 for o in out], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in range(last)], *found, sure_of], names=names)

    return rows.mapInArrow(find, schema)


def languages(segments: DataFrame, doc: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc, `keep`, lang, sentences, confidence: a row per document and language really written in it, or one with NULL lang if there is none."""
    return segments.groupBy(doc, *keep, "lang").agg(F.sum("sentences").alias("sentences"), (F.sum(F.col("confidence") * F.col("sentences")) / F.greatest(F.sum("sentences"), F.lit(1))).alias("confidence"))


def mislabelled(docs: DataFrame, model: Model, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc, lang: the languages of each document whose label is missing, names another language than the text, or whose text has several.

    One row per document and language. Documents without a sentence of a natural language give none, whatever their label. Repeated rows of a
    document with labels of one meaning count once. What is shuffled are the document's id, label and languages, not its text.
    """
    labelled = docs.select(doc, text, label_code(F.col(lang)).alias("label"))
    written = passages(labelled, model, doc, text, ("label",)).where("lang IS NOT NULL")
    each = written.groupBy(doc, "label").agg(F.array_sort(F.collect_set("lang")).alias("langs"))  # no more than there are languages
    odd = (F.size("langs") > 1) | F.col("label").isNull() | (F.col("langs")[0] != F.col("label"))
    return each.where(odd).select(doc, F.explode("langs").alias("lang"))
