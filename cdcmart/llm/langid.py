"""Language identification: averaged hashed subword embeddings and a linear softmax.

``train`` fits the model by stochastic gradient descent in numpy on a bounded
sample of labelled rows; ``identify`` applies it to every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_chunks, slices, utf8

SIZES = (2, 3, 4)          # bytes of a subword
BUCKETS = 1 << 15
DIMENSIONS = 16
#: the bound of the sample: rows per language, and languages
ROWS_PER_LANGUAGE = 600
LANGUAGES = 200
UNDETERMINED = "und"
#: running sums held at once: bytes of a run times languages
SCORE_CELLS = 1 << 21
#: share of held-back sample rows that calibration may reject
REJECTED_SHARE = 0.002

_FOLD = np.full(256, 32, np.uint8)      # ASCII other than letters separates words
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_STEP = np.uint32(0x9E3779B1)


def subwords(data: np.ndarray) -> list[np.ndarray]:
    """Bucket of the subword that starts at each byte, for each size. Bytes are
    folded to lower case, everything but letters to blanks."""
    own = _FOLD[data].astype(np.uint32)
    out, code = [], own.copy()
    for n in range(2, max(SIZES) + 1):
        code = code[:-1] * np.uint32(257) + own[n - 1:] if len(code) else code
        if n in SIZES:
            out.append(((code + np.uint32(n)) * _STEP) >> np.uint32(17))
    return out


@dataclass(frozen=True)
class LanguageModel:
    """Languages, per-bucket logits (embedding times weights), bias, calibration."""
    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of each row's languages."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        most = max(1 << 12, SCORE_CELLS // len(self.languages))
        for lo, hi in row_chunks(offsets, most):
            part, edges = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            length = np.diff(edges)
            sums, counts = np.zeros((hi - lo, len(self.languages))), np.zeros(hi - lo)
            for begin in range(0, len(part), most):
                # a row longer than a run is scored in runs that share their last bytes
                run = part[begin:begin + most + max(SIZES) - 1]
                for n, codes in zip(SIZES, subwords(run)):
                    codes = codes[:most]
                    if not len(codes):
                        continue
                    whole = length >= n  # a subword never reaches into the next row
                    running = np.zeros((len(codes) + 1, len(self.languages)))
                    np.cumsum(self.logits[codes], axis=0, dtype=np.float64, out=running[1:])
                    ends = np.clip(edges[1:][whole] - n + 1 - begin, 0, len(codes))
                    starts = np.clip(edges[:-1][whole] - begin, 0, len(codes))
                    sums[whole] += running[ends] - running[starts]
                    counts[whole] += ends - starts
            out[lo:hi] = sums / np.maximum(counts, 1)[:, None] + self.bias
        return softmax(out / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    data = np.frombuffer(text.encode(), np.uint8)
    codes = [c for c in subwords(data) if len(c)]
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    idx, n = np.unique(np.concatenate(codes), return_counts=True)
    return idx.astype(np.int64), (n / n.sum()).astype(np.float32)


def _dealt(labelled: DataFrame, counts: dict[str, int], rows: int) -> list:
    """Of each label in ``counts`` the ``rows`` rows with the smallest (deal, text).

    A label with many rows is first cut at a deal below which about twice as
    many lie, so a window sees a bounded number of rows of a label, however hot;
    a label of which too few lie below it (many rows of one id) is ranked whole."""
    def ranked(part: DataFrame) -> list:
        order = Window.partitionBy("lang").orderBy("deal", "text")
        return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows).drop("rank").collect()

    low, span = -(1 << 63), 1 << 64
    cut = {lang: low + span * 2 * rows // n for lang, n in counts.items() if n > 4 * rows}
    below = F.lit(True)
    for lang, most in cut.items():
        below = below & ((F.col("lang") != lang) | (F.col("deal") < most))
    sample = ranked(labelled.where(F.col("lang").isin(list(counts)) & below))
    found = Counter(r["lang"] for r in sample)
    short = [lang for lang in cut if found[lang] < rows]
    if short:
        sample = [r for r in sample if r["lang"] not in short] + ranked(labelled.where(F.col("lang").isin(short)))
    return sample


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = ROWS_PER_LANGUAGE, languages: int = LANGUAGES, epochs: int = 6,
          rate: float = 0.4, seed: int = 0) -> LanguageModel | None:
    """Fit on the rows where ``usable`` holds and the text has a letter and a label.

    The sample is bounded: of the ``languages`` most frequent labels, the
    ``rows_per_language`` rows with the smallest hash of the id. A fifth of it is held
    back to fit the temperature (by negative log likelihood) and the rejection
    threshold. None if no such row exists.
    """
    labelled = (docs.where(usable & docs[lang_col].isNotNull() & docs[text_col].rlike("\\p{L}"))
                .select(docs[lang_col].alias("lang"), docs[text_col].alias("text"),
                        F.xxhash64(docs[id_col].cast("string"), F.lit(seed)).alias("deal")))
    counts = (labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect())
    names = [r["lang"] for r in counts]
    sample = _dealt(labelled, {r["lang"]: r["n"] for r in counts}, rows_per_language) if names else []
    if not sample:
        return None
    sample.sort(key=lambda r: (r["deal"], r["lang"], r["text"]))
    names.sort()
    target = np.array([names.index(r["lang"]) for r in sample])
    feats = [_features(r["text"]) for r in sample]
    held = np.arange(len(sample)) % 5 == 4
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(names)), np.float32)
    weights += rng.normal(0, 0.1, weights.shape).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    order = np.flatnonzero(~held) if (~held).any() else np.arange(len(sample))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(order):
            idx, share = feats[i]
            hidden = share @ embed[idx]
            p = softmax((hidden @ weights + bias)[None].astype(np.float64))[0]
            p[target[i]] -= 1
            p = p.astype(np.float32)
            back = weights @ p
            weights -= step * np.outer(hidden, p)
            bias -= step * p * 0.1
            embed[idx] -= (step * 20 * share)[:, None] * back
    logits = (embed @ weights).astype(np.float32)
    check = np.flatnonzero(held) if held.any() else order
    raw = np.array([feats[i][1] @ logits[feats[i][0]] + bias for i in check], np.float64)
    best = min((-np.log(np.maximum(softmax(raw / t)[np.arange(len(check)), target[check]], 1e-12)).mean(), t)
               for t in np.geomspace(0.1, 10, 41))[1]
    top = np.sort(softmax(raw / best).max(axis=1))
    threshold = min(0.5, float(top[int(REJECTED_SHARE * len(top))]))
    return LanguageModel(names, logits, bias, float(best), threshold)


def _judge(model: LanguageModel | None, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and rejection of each text of an Arrow column."""
    data, offsets = utf8(texts)
    has, filled = np.zeros(len(offsets) - 1, bool), np.flatnonzero(np.diff(offsets) > 0)
    if len(filled):
        folded = _FOLD[data]
        has[filled] = np.logical_or.reduceat((folded >= 97) & (folded <= 122), offsets[filled])
    for i in np.flatnonzero(~has & (np.diff(offsets) > 0)):
        has[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    if model is None or not len(has):
        return np.full(len(has), UNDETERMINED, object), np.zeros(len(has)), np.ones(len(has), bool)
    p = model.scores(data, offsets)
    best = p.argmax(axis=1)
    score = np.where(has, p[np.arange(len(p)), best], 0.0)
    names = np.where(has, np.array(model.languages, object)[best], UNDETERMINED)
    return names, score, ~has | (score < model.threshold)


def keep_identified(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``identify`` does not
    reject. Without a model every row goes."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(~_judge(model, batch.column(at))[2]))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected per row of ``docs``, from the text alone.

    A null text, or one without a letter, gives ``und`` with score 0; without a
    model every row does. ``rejected`` marks those and the rows whose
    calibrated score is under the model's threshold. Ties go to the
    language first by name. Whole texts are read; repeated rows and null ids are answered
    each; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, score, rejected = _judge(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")
