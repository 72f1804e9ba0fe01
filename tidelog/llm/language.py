"""Language identification as inference of a mixture.

Every learned language is a distribution over hashed byte trigrams of lowered text. Expectation-maximisation estimates the
proportions in which a document draws its trigrams from the languages. The set of languages starts from the best single one
and grows while a language more raises the log-likelihood by more than a penalty, as for a criterion that charges for each
parameter. The prediction is the language with the largest proportion in the set, which is the score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import slices, table

#: Documents learned from per language, about; they are chosen by the hash of their identifier.
LEARN_DOCS = 2_000
#: Languages that may be told apart; more labels are refused.
MOST_LANGUAGES = 500
BITS = 15
#: Added to every count.
ALPHA = 0.1
ROUNDS = 20
#: Charged for each language beyond the first, times the logarithm of the number of trigrams. Trigrams overlap threefold.
PENALTY = 1.5

_WORDLIKE = re.compile(r"[^\W\d_]")
#: ASCII other than letters becomes blank.
_BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of a whole text, those of blanks alone left out."""
    data = np.frombuffer(b" " + text.lower().encode().translate(_BLANK) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64)
    joined = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    joined = joined[joined != 0x202020]
    return ((joined * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def has_letter(text: str) -> bool:
    # the class also has numbers such as superscripts, which are no letters
    return any(found[0].isalpha() for found in _WORDLIKE.finditer(text))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the identifier as text divides by five; a null identifier counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


class Model:
    """``languages`` in order and the logarithm-free ``shares``: a row per trigram, a column per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smoothed = counts.astype(np.float64) + ALPHA
        self.shares = np.ascontiguousarray((smoothed / smoothed.sum(axis=1, keepdims=True)).T, np.float64)

    def mixture(self, text: str | None) -> dict[str, float]:
        """Selected languages and their proportions; empty if there is nothing to tell from."""
        if not text or not self.languages or not has_letter(text):
            return {}
        grams = trigrams(text)
        if not len(grams):
            return {}
        counts = np.bincount(grams, minlength=1 << BITS)
        seen = np.flatnonzero(counts)
        weight = counts[seen].astype(np.float64)
        shares = self.shares[seen]
        charge = PENALTY * np.log(len(grams) + 1.0)
        every, best_of_all = _proportions(shares, weight)
        alone = weight @ np.log(shares)
        chosen = [int(np.argmax(alone))]
        found, likelihood = np.ones(1), float(alone[chosen[0]])
        # all languages together are as likely as any set of them can be
        while len(chosen) < len(self.languages) and best_of_all - likelihood > charge:
            rest = [i for i in np.argsort(-every, kind="stable") if i not in chosen]
            trial = [*chosen, int(rest[0])]
            proportions, likely = _proportions(shares[:, trial], weight)
            if likely - likelihood <= charge:
                break
            chosen, found, likelihood = trial, proportions, likely
        return {self.languages[i]: float(p) for i, p in zip(chosen, found, strict=True)}


def _proportions(shares: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``shares`` after expectation-maximisation, and the log-likelihood."""
    part = np.full(shares.shape[1], 1.0 / shares.shape[1])
    total = weight.sum()
    for _ in range(ROUNDS):
        by = weight / (shares @ part)
        fresh = part * (by @ shares) / total
        done = np.abs(fresh - part).max() < 1e-3
        part = fresh
        if done:
            break
    return part, float(weight @ np.log(shares @ part))


def learn(labelled: DataFrame, learn_docs: int = LEARN_DOCS) -> Model:
    """A model from ``doc_id``, ``text``, ``lang``; rows without a text or a language are passed over.

    Labelled rows of all languages are counted; of each about ``learn_docs`` are learned from. Trigram counts are added up
    in tasks and by the shuffle; what reaches the driver is at most 2**BITS counts per language.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1 << BITS)))
    odds = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, learn_docs / sizes[k]))])
    spread = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    sample = rows.filter(spread < odds[F.col("lang")]).select("lang", "text")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = np.bincount(trigrams(text), minlength=1 << BITS)
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(found[at], pa.int64())], names=["lang", "gram", "n"])

    added = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = added.toArrow()
    counts = np.zeros((len(languages), 1 << BITS))
    place = {k: i for i, k in enumerate(languages)}
    rows_at = np.array([place[k] for k in got.column("lang").to_pylist()], np.int64)
    counts[rows_at, got.column("gram").to_numpy().astype(np.int64)] = got.column("n").to_numpy()
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` as column ``row`` (a struct) with ``lang_pred``, ``score`` and ``mixture`` (language to proportion).

    A null text, or one without a letter, is ``und`` with score 0 and an empty mixture, and so is all if nothing was learned.
    Whole texts are read, one at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql import types as T

    def infer(batches):
        own = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                mixtures = [own.mixture(t) for t in part.column("text").to_pylist()]
                tops = [max(m.items(), key=lambda x: x[1]) if m else ("und", 0.0) for m in mixtures]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array([t[0] for t in tops], pa.string()),
                     pa.array([min(1.0, t[1]) for t in tops], pa.float64()),
                     pa.array([list(m.items()) for m in mixtures], pa.map_(pa.string(), pa.float64()))],
                    names=["row", "lang_pred", "score", "mixture"],
                )

    rows = docs.select(F.struct("*").alias("row"), "text")
    out = T.StructType([rows.schema["row"]]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return rows.mapInArrow(infer, out.add("mixture", T.MapType(T.StringType(), T.DoubleType())))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that are not held out; a prediction sees the text alone."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")
