"""Toxicity by compression distance: two zstandard dictionaries, one per kind of text.

Both dictionaries are trained, one on passages that are typical of toxic texts and one on
ordinary text, and both end with the same ordinary base, so that ordinary words compress alike
under either. A window is a word (a long word gives several, overlapping), followed by a
carrier phrase of the base that lets even short words be matched. The difference of its
compressed lengths, ordinary less toxic, says how much better the toxic dictionary knows
it. A text is described by how many windows reach each of a few thresholds and by its largest
differences; a logistic curve, fitted on labelled texts that trained no dictionary, turns
this into a score.

The fit reads a bounded sample of labelled rows with their whole texts: at most ``SAMPLE`` rows and
``SAMPLE_BYTES`` bytes of either label, in the order of a hash of their doc_id. Scoring reads all
texts whole, and needs nothing but the fitted model, about 60 KB.

Defined results: a null or empty text has no windows and score 0. Labels that
are null, or of no document, are not used; a doc_id with several labels counts as toxic if one
says so. Without a toxic or without an ordinary label in the sample, all scores are 0 or 1
accordingly, and 0 without any label. Other columns are ignored or carried.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.common import small_batches
from mercatura.llm.word_hash import chunks

SAMPLE = {1: 1_500, 0: 4_500}
SAMPLE_BYTES = {1: 12_000_000, 0: 30_000_000}
"""Bytes of the sampled texts of a label; a row that does not fit any more is not sampled."""
TOXIC_BYTES, BASE_BYTES = 1_536, 24_576
TRAINING_WORDS = 400_000
"""Words of the sample that train one part of a dictionary."""
SUPPORT, LIFT = 0.003, 25
"""A passage is typical of toxic texts from this share of their lines, this many times as frequent as in others."""
LEAST_LINES = 3
GRAMS = (5, 6, 7, 8)
SEGMENT = 24
"""Bytes of the segments a dictionary is put together from: a word or two."""
THRESHOLDS = (2, 3, 4, 5)
WINDOW, OVERLAP = 48, 16
KEPT_WORDS = 100_000
CARRIER_WORDS = 12

_PARAMETERS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_BTLAZY2,
    min_match=4,
    window_log=17,
    hash_log=15,
    chain_log=16,
    search_log=6,
    target_length=64,
    write_content_size=False,
    write_checksum=False,
    write_dict_id=False,
)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: CRC-32 of doc_id as text divisible by 5."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5)) == 0


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def _spaced(word: bytes) -> bytes:
    return b" " + word + b" "


def _grams(word: bytes) -> set[bytes]:
    text = _spaced(word)
    return {text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1)}


def _trained(size: int, samples: list[bytes]) -> bytes:
    """The content of a dictionary trained on ``samples``, in random order, as the trainer takes
    segments from all along them; all of it where they are few."""
    samples = [samples[i] for i in np.random.default_rng(7).permutation(len(samples))]
    try:
        made = zstandard.train_dictionary(size + 1024, samples, k=SEGMENT, d=6).as_bytes()
    except zstandard.ZstdError:
        made = b"".join(dict.fromkeys(samples))
    return made[-size:]


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the carrier phrase, and the curve from features to a score."""

    toxic: bytes
    ordinary: bytes
    carrier: bytes
    weights: tuple[float, ...]
    constant: float | None = None

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; keeps the differences of words it has seen, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.kept: dict[bytes, int] = {}
        self.lengths = [self._compressor(d) for d in (model.ordinary, model.toxic)]

    @staticmethod
    def _compressor(content: bytes):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=_PARAMETERS)
        return zstandard.ZstdCompressor(
            dict_data=dictionary, compression_params=_PARAMETERS
        ).compress

    def difference(self, word: bytes) -> int:
        """The largest difference of the word's windows, ordinary less toxic length."""
        found = self.kept.get(word)
        if found is None:
            ordinary, toxic = self.lengths
            step = WINDOW - OVERLAP
            windows = (word[i : i + WINDOW] for i in range(0, max(1, len(word) - OVERLAP), step))
            carried = [_spaced(w) + self.model.carrier for w in windows]
            found = max(len(ordinary(w)) - len(toxic(w)) for w in carried)
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            if len(word) <= WINDOW:
                self.kept[word] = found
        return found

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row per text: counts of windows by threshold, largest differences, length."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        words = split.flatten().dictionary_encode()
        listed = words.dictionary.cast(pa.binary()).to_pylist()
        known = np.array([self.difference(w) if w else -99 for w in listed] or [-99])
        values = known[words.indices.to_numpy()] if len(listed) else known[:0]
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        rows = np.zeros((len(texts), len(THRESHOLDS) + 3))
        for row, (start, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
            found = values[start:end]
            found = found[found > -99]
            if len(found):
                top = np.sort(found[found >= np.partition(found, -2)[-2]])[-2:] if len(found) > 1 else found
                counts = [np.log1p(np.count_nonzero(found >= t)) for t in THRESHOLDS]
                rows[row] = [*counts, top[-1], top.mean(), np.log1p(len(found))]
        return rows

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        features = self.features(texts)
        return np.where(features[:, -1] > 0, curve(features, np.array(self.model.weights)), 0.0)


def curve(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + features @ weights[1:], -40, 40)))


def _fit_curve(features: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge, on scaled features."""
    mean, scale = features.mean(0), features.std(0) + 1e-9
    x = np.column_stack([np.ones(len(features)), (features - mean) / scale])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (x * (p * (1 - p))[:, None]) + ridge
        w -= np.linalg.solve(slope, x.T @ (p - labels) + ridge @ w)
    plain = w[1:] / scale
    return (float(w[0] - plain @ mean), *map(float, plain))


def _lines(texts: list[str]) -> list[list[bytes]]:
    """Words of the distinct lines, so that copies of a text count once."""
    lines = dict.fromkeys(line for text in texts for line in text.split("\n"))
    return [words_of(line) for line in lines]


def _gram_counts(lines: list[list[bytes]], among: set[bytes] | None = None) -> Counter:
    per_word: Counter = Counter(word for line in lines for word in set(line))
    counts: Counter = Counter()
    for word, n in per_word.items():
        for gram in _grams(word):
            if among is None or gram in among:
                counts[gram] += n
    return counts


def _dictionaries(toxic: list[str], ordinary: list[str]) -> Model | None:
    """Dictionaries from texts of both labels, or None where nothing tells them apart."""
    ordinary_lines = _lines(ordinary)
    seen = {tuple(line) for line in ordinary_lines}
    toxic_lines = [line for line in _lines(toxic) if tuple(line) not in seen]
    counts = _gram_counts(toxic_lines)
    least = max(LEAST_LINES, SUPPORT * len(toxic_lines))
    counts = Counter({gram: n for gram, n in counts.items() if n >= least})
    others = _gram_counts(ordinary_lines, set(counts))
    per_line = LIFT * len(toxic_lines) / max(1, len(ordinary_lines))
    typical = {gram for gram, n in counts.items() if n > per_line * (others[gram] + 0.5)}
    marked = {w for line in toxic_lines for w in line if not typical.isdisjoint(_grams(w))}
    passages = [_spaced(w) for line in toxic_lines for w in line if w in marked]
    plain = [_spaced(w) for line in ordinary_lines for w in line if w not in marked]
    plain = [plain[i] for i in np.random.default_rng(7).permutation(len(plain))]
    if not passages or not plain:
        return None
    carrier = b"".join(plain[:CARRIER_WORDS])
    base = _trained(BASE_BYTES, plain[:TRAINING_WORDS]) + carrier
    others = plain[TRAINING_WORDS : 2 * TRAINING_WORDS] or plain
    neutral = _trained(TOXIC_BYTES, others)
    toxic_part = _trained(TOXIC_BYTES, passages)
    return Model(toxic_part + base, neutral + base, carrier, ())


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """A model from texts of both labels: two thirds train the dictionaries, the rest the curve.

    The curve is fitted on differences under the very dictionaries that will score; other
    dictionaries, of other texts, would not have the same thresholds.
    """
    trains = [[t for i, t in enumerate(x) if i % 3] for x in (toxic, ordinary)]
    made = _dictionaries(*trains) if all(trains) else None
    if made is None:
        return Model(b"", b"", b"", (), constant=float(bool(toxic) and not ordinary))
    held = toxic[::3] + ordinary[::3]
    labels = np.array([1.0] * len(toxic[::3]) + [0.0] * len(ordinary[::3]))
    return replace(made, weights=_fit_curve(made.scorer().features(pa.array(held)), labels))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents outside the held-out fold."""
    small_batches(docs.sparkSession)
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    place = F.md5(F.col("doc_id").cast("string"))
    texts = {}
    for label, most in SAMPLE.items():
        sample = known.where(F.col("toxic") == label).orderBy(place, "doc_id").limit(most)
        named = F.broadcast(sample.select(F.col("doc_id").alias("label_id")))
        text = F.coalesce("text", F.lit(""))
        sizes = docs.join(named, F.col("doc_id") == F.col("label_id")).select(
            place.alias("place"), "doc_id", F.xxhash64(text).alias("mark"), F.octet_length(text).alias("bytes")
        )
        # At most SAMPLE rows: the running total of their sizes is one task's work.
        sizes = sizes.where(F.col("bytes") <= SAMPLE_BYTES[label]).orderBy("place", "doc_id", "mark").limit(most)
        so_far = Window.orderBy("place", "doc_id", "mark")
        fits = sizes.withColumn("total", F.sum("bytes").over(so_far)).where(F.col("total") <= SAMPLE_BYTES[label])
        fits = fits.select(F.col("doc_id").alias("label_id"), F.col("mark").alias("of_mark")).distinct()
        wanted = (F.col("doc_id") == F.col("label_id")) & (F.xxhash64(text) == F.col("of_mark"))
        rows = (
            docs.join(F.broadcast(fits), wanted, "left_semi")
            .select(place.alias("place"), "doc_id", text.alias("text"))
            .orderBy("place", "doc_id", "text")
            .limit(most)
        )
        texts[label] = [r.text for r in rows.collect()]
    return fit(texts[1], texts[0])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            scores = [scorer.scores(part) for part in chunks(batch.column(1))]
            values = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_clean(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score is ``most`` or more."""
    position = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            scores = [scorer.scores(part) for part in chunks(batch.column(position))]
            values = np.concatenate(scores) if scores else np.empty(0)
            yield batch.filter(pa.array(values < most))

    return docs.mapInArrow(run, docs.schema)
