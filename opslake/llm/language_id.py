"""Language identification in two levels: one linear model for each language
family picks the family, then one-versus-one linear support vector machines
separate the languages within it by votes.

A text's features are its byte bigrams and trigrams (A-Z lower-cased, other
ASCII characters than letters as one blank), counted by hash over the whole
text; a feature is the square root of its share, so every text has length one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from opslake.llm.graph import cut
from opslake.llm.textkit import Texts, lower_ascii, slices, texts_of

#: hashed features
DIMS = 4096
#: the bounded sample that is learned from: documents for each language, documents of all
#: (with more languages each gives fewer), and languages, the most frequent ones
SAMPLE_PER_LANGUAGE, SAMPLE, LANGUAGES = 1500, 12_000, 512
#: family models that are fitted one after the other in one task, from the same examples
TOGETHER = 16
#: steps, rows a step and regularisation of the stochastic subgradient training
STEPS, ROWS, LAMBDA = 3000, 64, 1e-4
#: bytes of text whose features are computed at once
SLICE = 2 << 20
#: steepness of the logistic curve that turns a margin into a score
STEEP = 3.0

# fixed values: ISO 639-1 codes by language family; any other code is a family of its own
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "celtic": "ga cy br gd".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "iranian": "fa ku tg ps".split(),
    "indic": "hi bn ur pa gu mr ne si or as".split(),
    "dravidian": "ta te kn ml".split(),
    "semitic": "ar he am mt".split(),
    "sinitic": "zh yue".split(),
    "malayic": "id ms jv su tl".split(),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[:128] = 32
_CLASS[97:123] = np.arange(97, 123)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), lang)


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bigram and trigram that begin at each byte (the last ones reach into nothing)."""
    c = _CLASS[lower_ascii(data)].astype(np.uint32)
    two = c.copy()
    two[:-1] += c[1:] * np.uint32(257)
    three = two.copy()
    three[:-2] += c[2:] * np.uint32(66049)
    mul, shift = np.uint32(2654435761), np.uint32(32 - (DIMS.bit_length() - 1))
    return ((two * mul) >> shift).astype(np.int32), ((three * np.uint32(2246822519)) >> shift).astype(np.int32)


def _features(two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Of the n - 1 bigrams and n - 2 trigrams of one text."""
    x = np.bincount(two, minlength=DIMS) + np.bincount(three, minlength=DIMS)
    total = x.sum()
    return np.sqrt(x / total) if total else x.astype(float)


def _lettered(texts: Texts) -> Iterator[tuple[int, int, int]]:
    """(row, begin, end) of the texts that have letters."""
    letter = _ASCII_LETTER[texts.data]
    for i in range(len(texts)):
        a, b = int(texts.starts[i]), int(texts.starts[i + 1])
        if a < b and (letter[a:b].any() or _odd_letter(texts.data[a:b])):
            yield i, a, b


def _each(batch: pa.RecordBatch, column: int):
    """(row, features) of the rows whose text has letters."""
    texts = texts_of(batch.column(column))
    two, three = _grams(texts.data) if len(texts.data) else (None, None)
    for i, a, b in _lettered(texts):
        yield i, _features(two[a:max(a, b - 1)], three[a:max(a, b - 2)])


def _odd_letter(data: np.ndarray) -> bool:
    return bool((data >= 128).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """text, lang: at most ``per_language`` documents of each of the LANGUAGES most
    frequent languages (and not more than SAMPLE of all, spread evenly), by hash of
    doc_id, from rows with doc_id, text and a lang that is not empty, of which
    crc32(doc_id) mod 4 is not 2."""
    may = docs.where("text is not null and lang is not null and lang <> '' and doc_id is not null "
                     "and crc32(cast(doc_id as string)) % 4 <> 2")
    counts = {r["lang"]: r["n"] for r in may.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return may.select("lang", "text").limit(0)
    per_language = min(per_language, max(2, SAMPLE // len(counts)))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # a prior cut, so that the window gets a bounded number of rows
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * per_language / n + 0.0001))])
    some = may.select("lang", h.alias("h"), "doc_id", "text").where(F.col("h") < F.try_element_at(share, F.col("lang")) * (1 << 30))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    return some.withColumn("nth", first).where(F.col("nth") <= per_language).select("lang", "text")


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> dict:
    """The models: languages, families, and weights for each family and each pair
    of languages within one. Languages are those of the examples: labelled texts with a
    letter. Models are fitted by tasks of their own on the bounded sample; only
    the weights, DIMS + 1 numbers a model, come to the driver."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE):
            lang = batch.column(0).to_pylist()
            rows = [(lang[i], x.astype("<f2").tobytes()) for i, x in _each(batch, 1)]
            for at in range(0, len(rows), 512):
                some = list(zip(*rows[at:at + 512]))
                yield pa.RecordBatch.from_arrays([pa.array(some[0], pa.string()), pa.array(some[1], pa.binary())], ["lang", "x"])

    examples = cut(labelled_sample(docs, per_language).mapInArrow(features, "lang string, x binary"))
    langs = sorted(r["lang"] for r in examples.select("lang").distinct().collect())  # at most LANGUAGES
    families = {f: sorted(v) for f, v in itertools.groupby(sorted(langs, key=family), key=family)}
    names = sorted(families)
    # the models of a group, each with its side +1 and its side -1 (none: all others)
    groups = {f"f{i}": [(f"f:{f}", families[f], None) for f in names[i:i + TOGETHER]]
              for i in range(0, len(names), TOGETHER) if len(names) > 1}
    groups |= {f"p:{a}:{b}": [(f"p:{a}:{b}", [a], [b])] for f in names for a, b in itertools.combinations(families[f], 2)}
    if not groups:
        return {"families": families, "weights": {}}
    uses = {lang: [g for g, models in groups.items() if models[0][2] is None or lang in models[0][1] + models[0][2]] for lang in langs}
    used = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.array(*[F.lit(g) for g in uses[lang]]))])

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["x", "lang"])  # the same order whichever task sent them
        x = np.frombuffer(b"".join(rows["x"]), "<f2").reshape(-1, DIMS).astype(np.float32)
        out = [(m, _svm(x, np.where(rows["lang"].isin(plus), 1, -1)).astype("<f8").tobytes()) for m, plus, _ in groups[key[0]]]
        return pd.DataFrame(out, columns=["model", "w"])

    fitted = (examples.withColumn("g", F.explode(F.try_element_at(used, F.col("lang"))))
              .groupBy("g").applyInPandas(fit, "model string, w binary").collect())
    return {"families": families, "weights": {r["model"]: np.frombuffer(r["w"], "<f8") for r in fitted}}


def _svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hinge loss with L2 penalty, by averaged stochastic subgradient steps; each
    step takes as many rows of either side. Weights and, last, the bias."""
    rng = np.random.default_rng(7)
    plus, minus = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
    w = np.zeros(DIMS + 1)
    if not len(plus) or not len(minus):
        w[-1] = 1.0 if len(plus) else -1.0
        return w
    mean = np.zeros_like(w)
    for t in range(1, STEPS + 1):
        pick = np.concatenate((rng.choice(plus, ROWS // 2), rng.choice(minus, ROWS // 2)))
        xs, ys = x[pick], y[pick]
        wrong = ys * (xs @ w[:-1] + w[-1]) < 1
        rate = 1.0 / (LAMBDA * (t + 2000))
        w[:-1] *= 1 - rate * LAMBDA
        if wrong.any():
            w[:-1] += rate / ROWS * (ys[wrong] @ xs[wrong])
            w[-1] += rate / ROWS * ys[wrong].sum() * 0.1
        if t > STEPS // 2:
            mean += w
    return mean / (STEPS - STEPS // 2)


def classify(docs: DataFrame, models: dict, names: tuple[str, str, str] = ("lang_pred", "score", "lettered")) -> DataFrame:
    """All columns of ``docs`` and, by these names, lang_pred, score and whether the
    text has a letter. A score is the product of both levels' logistic margins: of
    the family over the next, and of the language over the rival it beats least.
    ``und`` (score 0) where the text is null or has no letter, or nothing could be
    learned."""
    families = models["families"]
    groups = sorted(families)
    langs = [lang for f in groups for lang in families[f]]
    wanted = list(models["weights"])
    matrix = np.stack([models["weights"][m] for m in wanted], 1) if wanted else np.zeros((DIMS + 1, 0))
    column = {m: i for i, m in enumerate(wanted)}
    schema = StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType()),
                         StructField(names[2], BooleanType())])
    at = docs.columns.index("text")

    def logistic(v: float) -> float:
        return float(1 / (1 + np.exp(-STEEP * min(max(v, -50.0), 50.0))))

    def decide(x: np.ndarray) -> tuple[str, float]:
        m = x @ matrix[:-1] + matrix[-1]
        f, sure = groups[0], 1.0
        if len(groups) > 1:
            margins = [m[column[f"f:{n}"]] for n in groups]
            best = int(np.argmax(margins))
            f = groups[best]
            sure = logistic((margins[best] - max(v for i, v in enumerate(margins) if i != best)) / 2)
        votes = {a: [] for a in families[f]}
        for a, b in itertools.combinations(families[f], 2):
            v = m[column[f"p:{a}:{b}"]]
            votes[a].append(v)
            votes[b].append(-v)
        best_lang = max(families[f], key=lambda a: (sum(v > 0 for v in votes[a]), sum(votes[a])))
        return best_lang, sure * logistic(min(votes[best_lang], default=50.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, SLICE):
            pred, score, lettered = ["und"] * batch.num_rows, [0.0] * batch.num_rows, [False] * batch.num_rows
            if langs:
                for i, x in _each(batch, at):
                    (pred[i], score[i]), lettered[i] = decide(x), True
            else:
                for i, _, _ in _lettered(texts_of(batch.column(at))):
                    lettered[i] = True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(lettered, pa.bool_())], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``.

    Learned from text and non-null lang of rows whose crc32(doc_id as text)
    mod 4 is not 2 (held_out: it is 2; false for a null doc_id, whose row is not
    learned from either), and of which the lang is not empty: an empty one names no
    language. A prediction sees the text alone. Null texts and texts without a letter
    are ``und`` with score 0, and so is every row where no text with a letter has a
    language. Of more than LANGUAGES languages the most frequent are learned. Repeated rows each get a row; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    models = train(docs, per_language)
    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    return classify(docs.select("doc_id", held.alias("held_out"), "text"), models).select(
        "doc_id", "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs``, all columns, but those whose text is null or has no letter,
    also where no language could be learned."""
    cols = docs.columns
    taken = {c.lower() for c in cols}
    free = next(n for i in range(3 * len(cols) + 1) if not {n := f"_lang{i}", f"{n}_score", f"{n}_lettered"} & taken)
    models = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(lang).alias("lang")), per_language)
    return classify(docs, models, (free, f"{free}_score", f"{free}_lettered")).where(f"{free}_lettered").select(
        *[F.col(f"`{c}`") for c in cols])
