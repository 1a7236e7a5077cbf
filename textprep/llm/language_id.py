"""Language identification with string kernels.

A text is the set of its byte strings of one to three bytes (the blended
spectrum, by presence). The kernel of two texts is the number of strings they
share over the geometric mean of their set sizes. Nyström landmarks make it a
finite feature map, on which one ridge regression per language is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textprep.llm.labelled import in_fold, window

FOLDS, HELD = 5, 0
PER_LANGUAGE = 300
LANDMARKS = 32
# With many languages each has fewer texts and landmarks, so that the fit stays bounded.
MAX_SAMPLE, MAX_LANDMARKS, LEAST = 30_000, 1_600, 4
MAX_LANGUAGES = MAX_LANDMARKS // LEAST
MIN_CHARS, MAX_CHARS = 50, 4_000
RIDGE = 1e-2
SHARPNESS = 8.0
LONGEST = 3
# Codes of strings of 1, 2 and 3 bytes share one numbering.
OFFSETS = (0, 1 << 8, (1 << 8) + (1 << 16))
CODES = (1 << 8) + (1 << 16) + (1 << 24)
BATCH = 256


def string_codes(text: str) -> np.ndarray:
    """Codes of all byte strings up to three bytes of the lower-cased text, with repeats."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.int32)
    found, code = [], np.zeros(len(data) + 1, np.int32)
    for n, offset in enumerate(OFFSETS):
        if len(data) <= n:
            break
        code = (code[:-1] << 8) | data[n:]
        found.append(code + np.int32(offset))
    return np.concatenate(found) if found else np.empty(0, np.int32)


class Model:
    """Landmarks, their strings and the regressions, in arrays that travel to tasks.

    ``held`` lists, string by string, the landmarks that have it: the string at place
    i of ``codes`` is in those from ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, sample: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.languages = sorted({lang for _, lang in sample})
        landmarks = max(LEAST, min(landmarks, MAX_LANDMARKS // max(1, len(self.languages))))
        taken = {lang: 0 for lang in self.languages}
        sets, marks = [], []
        for text, lang in sample:
            codes = np.unique(string_codes(text))
            sets.append(codes)
            if taken[lang] < landmarks:
                taken[lang] += 1
                marks.append(codes)
        every = np.concatenate(marks) if marks else np.empty(0, np.int32)
        owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
        order = np.argsort(every, kind="stable")
        self.codes, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every)).astype(np.int64)
        self.held = owner[order].astype(np.int32)
        self.sizes = np.array([len(m) for m in marks], np.float32)
        between = self._kernel_of_sets(marks)
        values, vectors = np.linalg.eigh(between.astype(np.float64))
        keep = values > 1e-6 * max(1.0, values.max(initial=0.0))
        self.map = vectors[:, keep] / np.sqrt(values[keep])
        features = self._kernel_of_sets(sets) @ self.map
        y = np.array([[1.0 if lang == known else -1.0 for known in self.languages] for _, lang in sample])
        y = y.reshape(len(sample), len(self.languages))
        x = np.column_stack([features, np.ones(len(features))])
        gram = x.T @ x + ridge * max(1, len(sample)) * np.diag([1.0] * features.shape[1] + [0.0]) / 100
        self.weights = np.linalg.lstsq(gram, x.T @ y, rcond=None)[0] if len(sample) else np.zeros((1, 0))

    def shared(self, places: np.ndarray) -> np.ndarray:
        """With how many of the strings at these places each landmark agrees."""
        starts, counts = self.first[places], self.first[places + 1] - self.first[places]
        at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.bincount(self.held[at], minlength=len(self.sizes))

    def _kernel_of_sets(self, sets: list[np.ndarray]) -> np.ndarray:
        shared = np.zeros((len(sets), len(self.sizes)), np.float32)
        for i, codes in enumerate(sets):
            place = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
            if len(codes):
                shared[i] = self.shared(place[self.codes[place] == codes])
        return self.kernel(shared, np.array([len(s) for s in sets], np.float32))

    def kernel(self, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return shared / np.sqrt(np.maximum(np.outer(sizes, self.sizes), 1.0))

    def decide(self, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probabilities, one row per text and one column per language."""
        features = self.kernel(shared, sizes) @ self.map
        values = SHARPNESS * (features @ self.weights[:-1] + self.weights[-1])
        values = np.exp(values - values.max(axis=1, keepdims=True))
        return values / values.sum(axis=1, keepdims=True)


class Scorer:
    """Scores texts in batches; two address tables stand for sorting their strings."""

    def __init__(self, model: Model):
        self.model = model
        self.column = np.full(CODES, -1, np.int32)
        self.column[model.codes] = np.arange(len(model.codes), dtype=np.int32)
        self.last = np.zeros(CODES, np.int32)

    def __call__(self, texts: list[str]) -> np.ndarray:
        shared = np.zeros((len(texts), len(self.model.sizes)), np.float32)
        sizes = np.zeros(len(texts), np.float32)
        for i, text in enumerate(texts):
            codes = string_codes(text)
            # Each string keeps the place written last, so one place per string agrees.
            places = np.arange(len(codes), dtype=np.int32)
            self.last[codes] = places
            distinct = codes[self.last[codes] == places]
            sizes[i] = len(distinct)
            columns = self.column[distinct]
            shared[i] = self.model.shared(columns[columns >= 0])
        return self.model.decide(shared, sizes)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def training_sample(docs: DataFrame, folds: int, held: int, per_language: int) -> list[tuple[str, str]]:
    """(text, lang) of about ``per_language`` documents of every language.

    Texts of MIN_CHARS characters and more come first; where a language has too few of
    them, its shorter ones are drawn as well. Of a text longer than MAX_CHARS a window
    of that length is learned. Rows are drawn by the hash of their id at rates that
    follow from the counts of languages, then cut to the bound on the driver. With many
    languages each has fewer rows; with more than MAX_LANGUAGES the job fails.
    """
    usable = docs.select(
        "doc_id", window("text", "doc_id", MAX_CHARS).alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter(
        F.col("lang").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~in_fold(F.col("doc_id"), folds, held)
        & (F.length("text") > 0)
    )
    fit = F.length("text") >= MIN_CHARS
    sizes = usable.groupBy("lang").agg(F.count_if(fit).alias("fit"), F.count_if(~fit).alias("short"))
    counts = sizes.limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not counts:
        return []
    most = max(LEAST, min(per_language, MAX_SAMPLE // len(counts)))
    rates = [
        (r["lang"], 1.5 * most / max(1, r["fit"]), 1.5 * max(0, most - r["fit"]) / max(1, r["short"])) for r in counts
    ]
    rated = usable.join(F.broadcast(docs.sparkSession.createDataFrame(rates, "lang string, fit double, short double")), "lang")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rated.filter(draw < F.when(fit, F.col("fit")).otherwise(F.col("short")))
    rows = drawn.select("doc_id", "lang", "text", draw.alias("draw"), fit.alias("fit")).collect()
    taken: dict[str, int] = {}
    sample = []
    for r in sorted(rows, key=lambda r: (not r["fit"], r["draw"], r["doc_id"], r["text"])):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= most:
            sample.append((r["text"], r["lang"]))
    return sample


def identify_languages(
    docs: DataFrame, folds: int = FOLDS, held: int = HELD, per_language: int = PER_LANGUAGE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``score`` is the share of the predicted language among all, from 0 to 1. A
    null text and one without a letter is ``und`` with score 0, and so is every
    text if there is nothing to learn from. Ties go to the language that sorts
    first. Whole texts count. Repeated rows are predicted alike; extra columns
    are ignored; an empty table gives an empty result.
    """
    model = Model(training_sample(docs, folds, held, per_language))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model.languages else None
        names = np.array(model.languages, object)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                texts = part.column("text").to_pylist()
                found = np.full(len(texts), "und", object)
                scores = np.zeros(len(texts))
                rows = [i for i, t in enumerate(texts) if scorer and _has_letter(t)]
                if rows:
                    shares = scorer([texts[i] for i in rows])
                    found[rows] = names[shares.argmax(axis=1)]
                    scores[rows] = shares.max(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(found, pa.string()), pa.array(scores)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select("doc_id", in_fold(F.col("doc_id"), folds, held).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
