"""Language identification of texts that may mix languages.

A language is a distribution over hashed byte trigrams, learned from labelled
texts. A document is a mixture of languages: expectation maximisation estimates
its proportions, and a language joins the document's set only if the likelihood
gains more than a penalty for it. All documents of a piece of the table are
worked on at once, as arrays; texts never leave their rows.

Null texts, and texts without a letter, are ``und`` with score 0, as is every
text if nothing was learned. Texts of one or two letters are taken for the most
common language, with an even score. Ties go to the first language in alphabetical
order. Extra columns are kept; result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm.words import slices, text_bytes

FEATURES = 1 << 13
SMOOTHING = 0.1
PENALTY = 6.0  # nats for each unit of log(number of trigrams)
ROUNDS = 10
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")

# Bytes as the model sees them: letters in lower case, other ASCII as one gap.
_SEEN = np.full(256, 0x20, np.uint32)
_SEEN[0x61:0x7B] = np.arange(0x61, 0x7B)
_SEEN[0x41:0x5B] = np.arange(0x61, 0x7B)
_SEEN[0x80:] = np.arange(0x80, 0x100)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of the trigrams of each text, in order of text, then feature."""
    seen = _SEEN[data]
    if len(seen) < 3:
        return (np.zeros(0, np.int64),) * 3
    code = seen[:-2] << 16 | seen[1:-1] << 8 | seen[2:]
    feature = (code * np.uint32(2654435761)) >> np.uint32(32 - 13)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = (text[:-2] == text[2:]) & (code != 0x202020)
    key = text[:-2][inside] * FEATURES + feature[inside]
    n = len(offsets) - 1
    if n * FEATURES <= 16 * len(key):
        count = np.bincount(key, minlength=n * FEATURES)
        key = np.flatnonzero(count)
        count = count[key]
    else:
        key, count = np.unique(key, return_counts=True)
    return key // FEATURES, key % FEATURES, count


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    probability: np.ndarray  # [languages, FEATURES]
    common: int = 0  # the language with most trigrams, for texts too short to have any


def learn(labelled: DataFrame) -> Model:
    """Learn from all of labelled(text, lang); rows without a language are passed over.

    The driver gets languages * FEATURES counts, whatever the number of texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                text, feature, n = trigrams(*text_bytes(part.column("text")))
                for lang in set(langs):
                    own = np.flatnonzero(langs[text] == lang)
                    made = np.bincount(feature[own], weights=n[own], minlength=FEATURES)
                    sums[lang] = sums.get(lang, 0) + made
        for lang, made in sums.items():
            at = np.flatnonzero(made)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(made[at].astype(np.int64))],
                names=["lang", "feature", "n"],
            )

    rows = (
        labelled.select("text", "lang")
        .where("lang IS NOT NULL")
        .mapInArrow(count, "lang string, feature int, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(set(rows["lang"])))
    counts = np.full((len(languages), FEATURES), SMOOTHING)
    place = {lang: k for k, lang in enumerate(languages)}
    counts[[place[x] for x in rows["lang"]], rows["feature"].to_numpy(int)] += rows["n"].to_numpy(float)
    if not languages:
        return Model(languages, counts)
    total = counts.sum(axis=1)
    return Model(languages, counts / total[:, None], int(total.argmax()))


def mixtures(
    text: np.ndarray, feature: np.ndarray, count: np.ndarray, n: int, probability: np.ndarray
) -> np.ndarray:
    """Proportions [n, languages] of texts given as sorted (text, feature, count)."""
    many = len(probability)
    share = np.zeros((n, many))
    if not len(text) or not many:
        return share
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    ids = text[first]
    size = np.diff(np.r_[first, len(text)])
    total = np.add.reduceat(count, first).astype(float)
    p = probability[:, feature].T  # [entries, languages]

    def best_fit(which: np.ndarray, sets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the languages in ``sets`` for the texts ``which``: (shares, log-likelihood)."""
        sizes = size[which]
        starts = np.cumsum(sizes) - sizes
        own = np.repeat(np.arange(len(which)), sizes)
        x, c = p[rows], count[rows][:, None].astype(float)
        pi = sets / sets.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            part = pi[own] * x
            part *= c / part.sum(axis=1, keepdims=True)
            pi = np.add.reduceat(part, starts) / total[which, None]
        mix = (pi[own] * x).sum(axis=1)
        return pi, np.add.reduceat(c[:, 0] * np.log(mix), starts)

    single = np.add.reduceat(count[:, None] * np.log(p), first)
    chosen = single.argmax(axis=1)
    likelihood = single[np.arange(len(ids)), chosen]
    pi = np.zeros((len(ids), many))
    pi[np.arange(len(ids)), chosen] = 1.0
    active = np.arange(len(ids))
    for _ in range(many - 1):
        rows = np.flatnonzero(np.repeat(np.isin(np.arange(len(ids)), active), size))
        own = np.repeat(np.arange(len(active)), size[active])
        starts = np.cumsum(size[active]) - size[active]
        mix = (pi[active][own] * p[rows]).sum(axis=1)
        slope = np.add.reduceat((count[rows] / mix)[:, None] * p[rows], starts) / total[active, None]
        slope[pi[active] > 0] = 0
        extra = slope.argmax(axis=1)
        # the likelihood is concave in the shares: no slope above 1, no gain
        able = slope[np.arange(len(active)), extra] > 1
        if not able.any():
            break
        rows = rows[np.repeat(able, size[active])]
        active, extra = active[able], extra[able]
        sets = (pi[active] > 0).astype(float)
        sets[np.arange(len(active)), extra] = 1
        tried, value = best_fit(active, sets, rows)
        better = value - likelihood[active] > PENALTY * np.log(total[active] + 1)
        active = active[better]
        if not len(active):
            break
        pi[active], likelihood[active] = tried[better], value[better]
    share[ids] = pi
    return share


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs(text, ...) with lang_pred, score (its share of the text) and lang_shares."""
    new = ("lang_pred", "score", "lang_shares")
    rest = [c for c in docs.columns if c not in new]
    shares_type = T.MapType(T.StringType(), T.DoubleType())
    schema = T.StructType([f for f in docs.schema.fields if f.name not in new])
    schema = schema.add("lang_pred", "string").add("score", "double").add("lang_shares", shares_type)
    names = [*model.languages, UNKNOWN]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column("text")
                share = mixtures(*trigrams(*text_bytes(column)), part.num_rows, model.probability)
                letters = [t is not None and _LETTER.search(t) is not None for t in column.to_pylist()]
                if model.languages:
                    top = share.argmax(axis=1)
                    score = share.max(axis=1)
                    known = np.array(letters, bool)
                    short = score == 0
                    top[short], score[short] = model.common, 1 / len(model.languages)
                    pred = np.where(known, top, len(names) - 1)
                    score = np.where(known, np.clip(score, 0.0, 1.0), 0.0)
                else:
                    known = np.zeros(part.num_rows, bool)
                    pred, score = np.zeros(part.num_rows, int), np.zeros(part.num_rows)
                shares = [
                    [(names[k], float(row[k])) for k in np.flatnonzero(row > 0)] if ok else []
                    for row, ok in zip(share, known)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([names[k] for k in pred], pa.string()),
                        pa.array(score),
                        pa.array(shares, pa.map_(pa.string(), pa.float64())),
                    ],
                    names=[*rest, *new],
                )

    return docs.select(*rest).mapInArrow(add, schema)
