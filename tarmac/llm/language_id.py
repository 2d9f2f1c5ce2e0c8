"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over byte n-grams says how
strongly a text looks like the languages whose bit is one; its weight for an n-gram is the log
ratio of the n-gram's smoothed frequency in the two sets of languages. Decoding adds up, for each
language, the loss of every bit's margin against its codeword, weighted by how well that bit's
classifier did in training, and takes the least. A text whose two best losses are close is flagged.

Training reads a bounded, documented sample: at most about ``per_language`` rows of a language,
chosen by a hash of the id. Every label is learned; more than ``LANGUAGES`` of them are no languages, and training
fails. Prediction reads the whole text of every row, long ones in blocks of ``BLOCK`` bytes.

Results for odd input: null text or text without a letter (a character of a category L) is ``und`` with score 0. Without training
rows everything is ``und``. Training rows with null label, null text or no letter are
not used. Repeated rows get equal results; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import byte_slices

UNKNOWN = "und"
BUCKETS = 1 << 13
SIZES = (1, 2, 3)
PER_LANGUAGE = 2000
LANGUAGES = 2000
#: Below this distance between the best and the second-best language a text is ambiguous.
MARGIN = 0.05

#: Positions whose n-grams are counted at once, and bytes of texts in a slice.
BLOCK = 1 << 20
SLICE_BYTES = 4 << 20

_PLAIN_LETTER = re.compile("[A-Za-z]")
# Bytes that are not letters become spaces; bytes of non-ASCII characters stay.
_FOLD = bytes(
    b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_ROWS = 64


def gram_counts(texts: list[str]) -> np.ndarray:
    """Rows of hashed n-gram counts, one per text."""
    gap = b"  "
    parts = [t.encode().translate(_FOLD) + gap for t in texts]
    ends = np.cumsum([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts) + gap, np.uint8)
    counts = np.zeros(len(parts) * BUCKETS, np.int64)
    for low in range(0, len(data) - 2, BLOCK):
        part = data[low : low + BLOCK + 2].astype(np.uint32)
        n = len(part) - 2
        places = np.arange(low, low + n)
        text = np.searchsorted(ends, places, "right")
        inside = places < ends[text] - 2  # others would reach into the next text
        row, code = text * BUCKETS, np.zeros(n, np.uint32)
        for size in range(1, max(SIZES) + 1):
            code = code * np.uint32(257) + part[size - 1 : size - 1 + n] + np.uint32(1)
            if size in SIZES:
                slot = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
                counts += np.bincount((row + slot)[inside], minlength=len(counts))
    return counts.reshape(len(parts), BUCKETS)


def has_letter(text: str) -> bool:
    return bool(_PLAIN_LETTER.search(text)) or any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1.

    Up to six languages get all two-way splits. More get random splits from a fixed seed, with so
    many bits that any two codewords stay far apart.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([[1 if (s >> i) & 1 else -1 for s in splits] for i in range(n)])
    rng = np.random.default_rng(n)
    bits, best, distance = 12 * math.ceil(math.log2(n)), None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], size=(n, bits))
        apart = (bits - (code @ code.T - 2 * bits * np.eye(n)).max()) / 2
        if apart > distance and (np.abs(code.sum(0)) < n).all():
            best, distance = code, apart
    return best


@dataclass
class Model:
    """Languages, their codewords, n-gram weights per bit, and per bit a scale and a trust."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        return counts.astype(np.float32) @ self.weights / total * self.scale

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Per text and language: mean loss over the bits, weighted by their trust.

        A bit's loss has two values only, one for each side, so the sums are two products of matrices.
        """
        margins = np.clip(margins, -4, 4)
        sides = ((self.code == sign) * self.trust for sign in (1, -1))
        return sum(np.exp(-sign * margins) @ side.T for sign, side in zip((1, -1), sides)) / self.trust.sum()


def crc(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary"))


def training_sample(rows: DataFrame, per_language: int) -> DataFrame:
    """(text, lang): about ``per_language`` rows of each language, by a hash of the id."""
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different labels")
    if not counts:
        return rows.limit(0).select("text", "lang")
    shares = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], per_language / r["n"])))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    return rows.where(draw < shares[F.col("lang")]).select("text", "lang")


def _sum_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        sums: dict[str, np.ndarray] = {}
        for i in range(0, len(texts), _ROWS):
            counts = gram_counts(texts[i : i + _ROWS])
            for lang in set(langs[i : i + _ROWS]):
                mine = np.array([x == lang for x in langs[i : i + _ROWS]])
                sums[lang] = sums.get(lang, 0) + counts[mine].sum(0)
        for lang, total in sums.items():
            slot = np.flatnonzero(total)
            yield pa.record_batch(
                {"lang": [lang] * len(slot), "slot": pa.array(slot, pa.int32()), "n": total[slot]}
            )


def _bit_scores(weights, code, languages):
    """For each training text and bit: the mean weight of its n-grams, and whether its sign is right."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            index = [languages.index(x) for x in batch.column("lang").to_pylist()]
            for i in range(0, len(texts), _ROWS):
                counts = gram_counts(texts[i : i + _ROWS])
                mean = counts @ weights / np.maximum(counts.sum(1, keepdims=True), 1)
                want = code[index[i : i + _ROWS]]
                n, bits = mean.shape
                yield pa.record_batch(
                    {
                        "bit": pa.array(np.tile(np.arange(bits), n), pa.int32()),
                        "size": np.abs(mean).ravel().astype(np.float64),
                        "right": ((mean * want) > 0).ravel().astype(np.float64),
                    }
                )

    return score


def train(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Fit the bit classifiers on the rows whose crc32(id) mod 4 is not 2.

    Spark counts the n-grams; the driver gets their sums, at most ``LANGUAGES * BUCKETS`` numbers.
    """
    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where(F.coalesce(crc(F.col("doc_id")) % 4, F.lit(0)) != 2)
    rows = rows.where(r"lang is not null and text is not null and text rlike '\\p{L}'")
    sample = training_sample(rows, per_language)
    sums = sample.mapInArrow(_sum_grams, "lang string, slot int, n long")
    found = sums.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pandas()

    languages = sorted(found["lang"].unique())
    code = codewords(len(languages))
    bits = code.shape[1]
    if not languages:
        return Model([], code, np.zeros((BUCKETS, bits), np.float32), np.ones(bits), np.ones(bits))
    counts = np.zeros((len(languages), BUCKETS))
    counts[[languages.index(x) for x in found["lang"]], found["slot"]] = found["n"]
    shares = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
    side = lambda sign: ((code == sign).T @ shares) / np.maximum((code == sign).sum(0), 1)[:, None]
    low = side(-1) if (code == -1).any() else np.full((bits, BUCKETS), 1 / BUCKETS)
    weights = (np.log(side(1)) - np.log(low)).T.astype(np.float32)
    scored = (
        sample.mapInArrow(_bit_scores(weights, code, languages), "bit int, size double, right double")
        .groupBy("bit")
        .agg(F.avg("size").alias("size"), F.avg("right").alias("right"))
        .orderBy("bit")
        .toPandas()
    )
    right = np.clip(scored["right"].to_numpy(), 0.5, 0.999)
    trust = np.log(right / (1 - right)) + 0.1
    return Model(languages, code, weights, 2 / np.maximum(scored["size"].to_numpy(), 1e-6), trust)


def predict_texts(model: Model, texts: list[str | None]):
    """Language, score in 0..1 and ambiguity of each text."""
    langs, scores, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    known = [i for i, t in enumerate(texts) if t and model.languages and has_letter(t)]
    for at in range(0, len(known), _ROWS):
        rows = known[at : at + _ROWS]
        losses = model.losses(model.margins(gram_counts([texts[i] for i in rows])))
        chance = np.exp(losses.min(1, keepdims=True) - losses)
        chance /= chance.sum(1, keepdims=True)
        order = np.sort(losses, 1)
        for k, i in enumerate(rows):
            langs[i] = model.languages[int(losses[k].argmin())]
            scores[i] = chance[k].max()
            unsure[i] = losses.shape[1] > 1 and order[k, 1] - order[k, 0] < MARGIN
    return langs, scores, unsure


def identify(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score, ambiguous): ``row`` is the whole input row as a struct."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_slices(batch, text_col, SLICE_BYTES):
                texts = [None if t is None else t.decode() for t in texts]
                langs, scores, unsure = predict_texts(shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array(langs, pa.string()),
                        pa.array(scores),
                        pa.array(unsure),
                    ],
                    ["row", "lang_pred", "score", "ambiguous"],
                )

    rows = documents.select(F.struct("*").alias("row"))
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(predict, schema)
