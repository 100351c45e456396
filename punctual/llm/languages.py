"""Language identification by hyperdimensional profiles.

Each letter has a random vector of `DIMENSION` signs, drawn from its code point. An n-gram of
letters is bound: the product of its letters' vectors, each rotated by its distance from the
end. A text's profile is the bundle (sum) of its n-grams; a language's prototype is the bundle
of the n-grams of its training texts. A text gets the language whose prototype has the highest
cosine with its profile.

Letters are Unicode letters in lower case; a run of anything else counts as one blank, and so
do the ends of a text. N-gram vectors are made as they are needed, by blocks, so memory does
not follow the number of distinct n-grams. Sums are of whole numbers, so they do not depend on
the order of rows. Prototypes are summed per task, then by language and dimension; they are
broadcast, `DIMENSION` numbers for each of at most `LANGUAGES` languages.

Defined cases. Null text, empty text and text without a letter: `und` with score 0. Null
language: not learned from. No learned language: `und` with score 0 for all. Ties between
languages: the least name. Repeated rows: each is learned from, all are judged alike. More than
`LANGUAGES` languages: an error. Other columns are kept; columns with the names of the results
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BATCH, setting, text_or_empty

DIMENSION, GRAM, SEED = 2048, 3, 11
#: N-gram vectors that are made at a time; characters whose n-grams are counted at a time.
BLOCK, CHARACTERS = 4096, 1 << 20
#: Languages that may be learned: 16 KB each are held and broadcast.
LANGUAGES = 4096
FOLDS, HELD_OUT = 3, 1
#: Texts that a Python worker is given at a time.
TEXTS = 512
UNKNOWN = "und"
RESULT = "lang_pred string, score double"


def held_out(row_id: Column) -> Column:
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng((SEED, code)).integers(0, 2, DIMENSION, dtype=np.int8) * np.int8(2) - np.int8(1)


def letters_of(texts: list[str]) -> list[np.ndarray]:
    """Of each text the code points in lower case, blanks (0) for runs of others, one at each
    end; empty without a letter."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    met = np.zeros(0x110000, bool)
    for own in codes:
        met[own] = True
    letter = np.zeros(0x110000, bool)
    letter[[c for c in np.flatnonzero(met).tolist() if chr(c).isalpha()]] = True
    out = []
    for own in codes:
        known = np.concatenate([[0], np.where(letter[own], own, 0), [0]]).astype(np.uint32)
        kept = known[np.append(True, (known[1:] != 0) | (known[:-1] != 0))]
        out.append(kept if len(kept) > 1 else kept[:0])
    return out


def profiles(texts: list[np.ndarray], owner: np.ndarray, owners: int) -> np.ndarray:
    """Sums of the n-gram vectors of `texts` (letters) by the number of their owner."""
    out = np.zeros((owners, DIMENSION), np.float64)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return out
    alphabet, letter = np.unique(np.concatenate(texts), return_inverse=True)
    row, end = np.repeat(owner, sizes), np.repeat(np.cumsum(sizes), sizes)
    grams = max(0, len(letter) - GRAM + 1)
    key = np.zeros(grams, np.int64)
    for at in range(GRAM):
        key = key * len(alphabet) + letter[at : at + grams]
    # not across the border of two texts
    whole = np.arange(grams) + GRAM <= end[:grams]
    key, count = np.unique((key * owners + row[:grams])[whole], return_counts=True)
    row, (gram, place) = key % owners, np.unique(key // owners, return_inverse=True)
    vectors = np.stack([letter_vector(int(code)) for code in alphabet])
    turned = [np.roll(vectors, GRAM - 1 - at, axis=1) for at in range(GRAM)]
    for first in range(0, len(gram), BLOCK):
        own = gram[first : first + BLOCK]
        bound = np.ones((len(own), DIMENSION), np.int8)
        for at in reversed(range(GRAM)):
            bound *= turned[at][own % len(alphabet)]
            own = own // len(alphabet)
        a, b = np.searchsorted(place, [first, first + BLOCK])
        counts = np.zeros((owners, len(bound)), np.float32)
        counts[row[a:b], place[a:b] - first] = count[a:b]
        out += counts @ bound.astype(np.float32)
    return out


def _parts(texts: list[np.ndarray]) -> Iterator[slice]:
    """Texts of about `CHARACTERS` letters together."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        if at > first and held + len(text) > CHARACTERS:
            yield slice(first, at)
            first, held = at, 0
        held += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task the sum of each language, one row for each dimension."""
    sums: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, values in sums.items():
            columns = [pa.array([lang] * DIMENSION), pa.array(np.arange(DIMENSION), pa.int32()), pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "dimension", "value"])
        sums.clear()

    for batch in batches:
        texts = letters_of(batch.column("text").to_pylist())
        langs, owner = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        for part in _parts(texts):
            own, at = np.unique(owner[part], return_inverse=True)
            for lang, values in zip(langs[own], profiles(texts[part], at, len(own)), strict=True):
                sums[lang] = sums.get(lang, 0) + values.astype(np.int64)
        if len(sums) >= LANGUAGES:
            yield from rows()
    yield from rows()


def prototypes(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in ascending order and the prototype of each, from rows of `text` and `lang`."""
    texts = documents.where("lang IS NOT NULL").select(F.col("lang"), text_or_empty().alias("text"))
    found = texts.select("lang").distinct().limit(LANGUAGES + 1).count()
    if found > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    with setting(documents.sparkSession, BATCH, str(TEXTS)):
        sums = texts.mapInArrow(_bundled, "lang string, dimension int, value long")
        rows = sums.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).toPandas()
    langs = sorted(rows["lang"].unique())
    out = np.zeros((len(langs), DIMENSION), np.float64)
    out[np.searchsorted(langs, rows["lang"].to_numpy(object)), rows["dimension"]] = rows["value"]
    known = out.any(axis=1)  # a language of texts without letters has no profile
    return [lang for lang, k in zip(langs, known, strict=True) if k], out[known]


def compare(texts: list[np.ndarray], langs: list[str], directions: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The best language of each text and the cosine with it (0 to 1); `directions` are
    prototypes of length one."""
    own = profiles(texts, np.arange(len(texts)), len(texts))
    length = np.linalg.norm(own, axis=1)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cosine = np.round(own @ directions.T / np.maximum(length, 1e-9)[:, None], 12)
    best = cosine.argmax(axis=1)
    score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
    return [langs[b] if n else UNKNOWN for b, n in zip(best, length, strict=True)], score


def identified(documents: DataFrame, langs: list[str], sums: np.ndarray) -> DataFrame:
    """`documents` with `lang_pred` and `score`."""
    directions = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    shared = documents.sparkSession.sparkContext.broadcast((langs, directions))

    @F.pandas_udf(RESULT)
    def best(values: pd.Series) -> pd.DataFrame:
        texts, names, scores = letters_of(values.fillna("").tolist()), [], []
        for part in _parts(texts):
            name, score = compare(texts[part], *shared.value)
            names += name
            scores.append(score)
        return pd.DataFrame({"lang_pred": names, "score": np.concatenate([np.zeros(0), *scores])})

    kept = documents.drop("lang_pred", "score")
    return kept.withColumn("_best", best(F.col("text"))).select(*kept.columns, "_best.*")


def predicted(documents: DataFrame) -> DataFrame:
    """`documents` with `held_out`, `lang_pred` and `score`, learned from rows not held out."""
    documents = documents.drop("held_out")
    rows = documents.withColumn("held_out", held_out(F.col("doc_id")))
    return identified(rows, *prototypes(rows.where("NOT held_out").select("lang", "text")))
