"""Language of a text by known words, then by ever shorter character n-grams (operator 10)."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymill.llm.tables import received, shipped, stored

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"

# Bounds of the sample that a model is fitted on: rows of each label, about, and characters of their texts.
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 1_000_000
LONGEST_GRAM = 5
SENT_LABELS = 1 << 14
# Posterior odds are those of this many average words at most, so that long texts do not all score 1.
WEIGHED_WORDS = 20
_MEMO_ENTRIES = 1 << 19


def letters_of(text: str) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter."""
    words = LETTERS.findall(text.lower())
    return words if any(char.isalpha() for word in words for char in word) else []


def grams_of(word: str, length: int) -> list[str]:
    """Character n-grams of a word, whose ends are marked."""
    marked = f"^{word}$" if length > 1 else word
    return [marked[at : at + length] for at in range(len(marked) - length + 1)]


class Model:
    """Log frequencies per language: of words, and of the n-grams of each length."""

    def __init__(self, counts: list[tuple[str, int, str, int]]):
        self.labels = sorted({label for label, *_ in counts})
        place = {label: at for at, label in enumerate(self.labels)}
        totals = np.zeros((LONGEST_GRAM + 1, len(self.labels)))
        raw: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST_GRAM + 1)]
        for label, kind, gram, count in counts:
            raw[kind].setdefault(gram, np.zeros(len(self.labels)))[place[label]] += count
            totals[kind, place[label]] += count
        self.tables: list[dict[str, int]] = []
        rows = [np.zeros(len(self.labels))]
        for kind, table in enumerate(raw):
            self.tables.append({gram: len(rows) + at for at, gram in enumerate(table)})
            rows += [np.log((found + 0.5) / (totals[kind] + 0.5 * (len(table) + 1))) for found in table.values()]
        # Row 0 is for words of which nothing is known.
        self.rows = np.array(rows)

    def places_of(self, word: str) -> list[int]:
        """Rows whose mean scores a word: its own if it is known, else those of its longest known n-grams."""
        own = self.tables[0].get(word)
        if own is not None:
            return [own]
        marked = f"^{word}$"
        for length in range(LONGEST_GRAM, 1, -1):
            known = self.tables[length].get
            found = [at for i in range(len(marked) - length + 1) if (at := known(marked[i : i + length])) is not None]
            if found:
                return found
        return [at for char in word if (at := self.tables[1].get(char)) is not None] or [0]

    def scores_of(self, words: list[str]) -> np.ndarray:
        places = [self.places_of(word) for word in words]
        sizes = np.array([len(own) for own in places])
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(self.rows[[at for own in places for at in own]], starts) / sizes[:, None]


class Predictor:
    """Applies a model. Remembers the scores of a bounded number of words, also for later tasks of the same worker."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.scores = np.empty((1024, len(self.model.labels)))

    def _learn(self, words: list[str]) -> None:
        done = len(self.places)
        while done + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
        self.scores[done : done + len(words)] = self.model.scores_of(words)
        self.places.update(zip(words, range(done, done + len(words)), strict=True))

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = letters_of(text) if text else []
        if not words or not self.model.labels:
            return UNKNOWN, 0.0
        if len(self.places) > _MEMO_ENTRIES:
            self._forget()
        counted, places = Counter(words), self.places
        fresh = [word for word in counted if word not in places]
        if fresh:
            self._learn(fresh)
        total = np.fromiter(counted.values(), np.float64, len(counted)) @ self.scores[[places[word] for word in counted]]
        odds = total / len(words) * min(len(words), WEIGHED_WORDS)
        shares = np.exp(odds - odds.max())
        best = int(shares.argmax())
        return self.model.labels[best], float(shares[best] / shares.sum())


def _counted(batches):
    """Words (kind 0) and n-grams (kind 1 to 5) of labelled texts, counted within each batch."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist(), strict=True):
            counts.setdefault(label, Counter()).update(letters_of(text))
        rows = Counter()
        for label, words in counts.items():
            for word, count in words.items():
                rows[label, 0, word] += count
                for length in range(1, LONGEST_GRAM + 1):
                    for gram in grams_of(word, length):
                        rows[label, length, gram] += count
        if rows:
            labels, kinds, grams = zip(*rows, strict=True)
            yield pa.record_batch(
                [pa.array(labels), pa.array(kinds, pa.int32()), pa.array(grams), pa.array(rows.values(), pa.int64())],
                ["label", "kind", "gram", "n"],
            )


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """A model of the labelled rows whose text and label are not null.

    It is fitted on a bounded sample: of each label about ``rows`` rows, chosen by a hash of ``key`` and the text, and of these as many
    as make ``chars`` characters together, texts that are longer than that by themselves last; one at least. All words and
    n-grams of the sample are kept, so the model is bounded by the sample, whatever the input; it grows with the number of labels. The words are
    counted in tasks. No usable row gives a model that answers ``und`` to everything.
    """
    usable = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")).where(
        "text IS NOT NULL AND label IS NOT NULL"
    )
    steps = 1 << 30
    usable = usable.withColumn("place", F.pmod(F.xxhash64(F.lit("language"), "key", "text"), F.lit(steps)))
    # A row for each label: sent to the tasks if it is few, so that texts are drawn where they are read.
    sizes = stored(usable.groupBy("label").count(), "labels")
    drawn = usable.join(F.broadcast(sizes) if sizes.count() <= SENT_LABELS else sizes, "label").where(F.col("place") < F.ceil(F.lit(rows).cast("double") * steps / F.col("count")))
    # The window sees about ``rows`` rows of a label.
    order = Window.partitionBy("label").orderBy(F.length("text") > chars, "place", "key", "text")
    before = F.coalesce(F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sample = drawn.withColumn("before", before).where(F.col("before") < chars)
    counts = sample.select("label", "text").mapInArrow(_counted, "label string, kind int, gram string, n long")
    summed = counts.groupBy("label", "kind", "gram").agg(F.sum("n").alias("n")).orderBy("kind", "gram", "label").toArrow()
    return Model(list(zip(*(summed[name].to_pylist() for name in ("label", "kind", "gram", "n")), strict=True)))


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents``, then ``lang_pred`` and ``score``, the posterior from 0 to 1.

    The text alone is looked at, in whole. Null texts and those without a letter are ``und`` with score 0. Columns of
    the input by these two names are replaced.
    """
    spark = documents.sparkSession
    shared = shipped(spark, Predictor(model))
    own = [name for name in documents.columns if name not in ("lang_pred", "score")]
    frame = documents.select(*own)
    at = own.index("text")

    def predict(batches):
        predictor = received(shared)
        for batch in batches:
            found = [predictor(text) for text in batch.column(at).to_pylist()]
            labels, scores = [x for x, _ in found], [y for _, y in found]
            columns = [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, [*batch.schema.names, "lang_pred", "score"])

    schema = StructType(list(frame.schema.fields)).add("lang_pred", "string").add("score", "double")
    return frame.mapInArrow(predict, schema)
