"""Remove long passages that earlier documents hold already (operator 8)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymill.llm.tables import discard, stored
from tallymill.llm.text import mixed, word_hasher

WINDOW_WORDS = 50
# Words of an automaton at most; later documents that are streamed through one copy of it.
PIECE_WORDS = 1 << 16
STREAMED = 64

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Rolling:
    """Hashes of all runs of a length in linear time, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, count: int) -> None:
        while len(self.up) < count:
            size = len(self.up)
            up, down = np.uint64(pow(_BASE, size, 1 << 64)), np.uint64(pow(_INVERSE, size, 1 << 64))
            self.up = np.concatenate([self.up, self.up * up])
            self.down = np.concatenate([self.down, self.down * down])

    def __call__(self, words: np.ndarray, length: int) -> np.ndarray:
        count = len(words) - length + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        self._powers(len(words))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[: len(words)], dtype=np.uint64)])
        return mixed((sums[length:] - sums[:-length]) * self.down[:count])


class Automaton:
    """Suffix automaton of a sequence of words. Passages are kept apart by marks that equal no word."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0
        self.marks = 0

    def _extend(self, word) -> None:
        state = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        at = self.last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            if self.length[at] + 1 == self.length[target]:
                self.link[state] = target
            else:
                clone = len(self.next)
                self.next.append(dict(self.next[target]))
                self.length.append(self.length[at] + 1)
                self.link.append(self.link[target])
                while at >= 0 and self.next[at].get(word) == target:
                    self.next[at][word] = clone
                    at = self.link[at]
                self.link[target] = self.link[state] = clone
        self.last = state

    def add(self, passage: list[bytes]) -> None:
        for word in passage:
            self._extend(word)
        self.marks += 1
        self._extend(self.marks)

    def spans(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal spans covered by matches of ``least`` words or more, from the matching statistics."""
        found: list[list[int]] = []
        state = matched = 0
        following, link, length = self.next, self.link, self.length
        for at, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            if matched >= least:
                begin = at + 1 - matched
                if found and begin <= found[-1][1]:
                    found[-1][1] = at + 1
                else:
                    found.append([begin, at + 1])
        return [tuple(span) for span in found]


def _anchors(grams: np.ndarray, reach: int) -> np.ndarray:
    """Of each window the place of its gram with the smallest hash: the same wherever the window stands."""
    views = np.lib.stride_tricks.sliding_window_view(grams, reach)
    return np.arange(len(views)) + views.argmin(axis=1)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *arrays]), pa.int64()))


def _described(window: int):
    """Of each text: its words, its class among equal word sequences, the hashes of its anchors."""
    gram = (window + 1) // 2

    def run(batches):
        hashes, rolling = word_hasher(), _Rolling()
        for batch in batches:
            sizes, classes, anchors = [], [], []
            for text in batch["text"].to_pylist():
                words = (text or b"").split()
                sizes.append(len(words))
                if len(words) < window:
                    classes.append(None)
                    anchors.append(np.empty(0, np.int64))
                    continue
                digest = hashlib.blake2b(b" ".join(words), digest_size=16).hexdigest()
                classes.append(digest)
                grams = rolling(hashes(words), gram)
                anchors.append(np.unique(grams[_anchors(grams, window - gram + 1)]).view(np.int64))
            yield pa.record_batch(
                [batch["doc"], batch["copy"], pa.array(sizes, pa.int64()), pa.array(classes, pa.string()), _lists(anchors)],
                ["doc", "copy", "n", "class", "anchors"],
            )

    return run


def _windows(window: int):
    """``hash, doc, copy, at`` of the windows whose anchor is in the list of the document."""
    gram = (window + 1) // 2

    def run(batches):
        hashes, rolling = word_hasher(), _Rolling()
        for batch in batches:
            columns = [[], [], [], []]
            rows = zip(*(batch[name].to_pylist() for name in ("doc", "copy", "text")), strict=True)
            hits = batch["hits"]
            for (doc, copy, text), listed in zip(rows, hits, strict=True):
                words = hashes(text.split())
                grams = rolling(words, gram)
                anchors = grams[_anchors(grams, window - gram + 1)].view(np.int64)
                wanted = np.flatnonzero(np.isin(anchors, listed.values.to_numpy()))
                for column, values in zip(
                    columns,
                    (
                        rolling(words, window)[wanted].view(np.int64),
                        np.full(len(wanted), doc, np.int64),
                        np.full(len(wanted), copy, np.int64),
                        wanted.astype(np.int32),
                    ),
                    strict=True,
                ):
                    column.append(values)
            if columns[0]:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in columns], ["hash", "doc", "copy", "at"])

    return run


def _passages(window: int):
    """``shard, kind, piece, doc, copy, at, words``: the passages of each document, by the document that held them first.

    Kind 0 is the reference itself, kind 1 a later document. References are cut into pieces of ``PIECE_WORDS`` words together
    at most, such that each window is in one of them as a whole.
    """

    def pieces(found):
        piece = held = 0
        for begin, words in found:
            while True:
                room = PIECE_WORDS - held
                if room < window:
                    piece, held = piece + 1, 0
                    continue
                yield piece, begin, words[:room]
                held += min(room, len(words))
                if len(words) <= room:
                    break
                begin, words = begin + room - window + 1, words[room - window + 1 :]

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], [], []]
            rows = zip(*(batch[name].to_pylist() for name in ("doc", "copy", "text", "places")), strict=True)
            for doc, copy, text, places in rows:
                words = text.split()
                of = np.array([[place["first"], place["at"]] for place in places], np.int64)
                of = of[np.lexsort((of[:, 1], of[:, 0]))]
                # A passage goes on while the next window begins within it.
                new = np.r_[True, (of[1:, 0] != of[:-1, 0]) | (of[1:, 1] > of[:-1, 1] + window)]
                begins = np.flatnonzero(new)
                ends = np.r_[begins[1:], len(of)]
                own = []
                for begin, end in zip(begins, ends, strict=True):
                    first, start, stop = int(of[begin, 0]), int(of[begin, 1]), int(of[end - 1, 1]) + window
                    if first == doc:
                        own.append((start, words[start:stop]))
                        continue
                    row = (first, 1, None, doc, copy, start, b" ".join(words[start:stop]))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                for piece, start, part in pieces(own):
                    row = (doc, 0, piece, doc, copy, start, b" ".join(part))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            if out[0]:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["shard", "kind", "piece", "doc", "copy", "at", "words"]
                )

    return run


def _streamed(window: int):
    """Spans that an automaton finds in the rows behind its reference, which come first for each shard."""

    def run(batches):
        shard, automaton = None, None
        for batch in batches:
            out = [[], [], [], []]
            names = ("shard", "piece", "part", "kind", "doc", "copy", "at", "words")
            for *key, kind, doc, copy, at, words in zip(*(batch[name].to_pylist() for name in names), strict=True):
                if key != shard:
                    shard, automaton = key, Automaton()
                if kind == 0:
                    automaton.add(words.split())
                    continue
                for start, end in automaton.spans(words.split(), window):
                    for column, value in zip(out, (doc, copy, at + start, at + end), strict=True):
                        column.append(value)
            if out[0]:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["doc", "copy", "start", "end"]
                )

    return run


_SPANS = "array<struct<start:int,end:int>>"


def _keyed(documents: DataFrame, *more: str) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("copy"),
        F.col("text").cast("binary").alias("text"),
        *more,
    )


def _sets(texts: DataFrame, window: int) -> DataFrame:
    """Each document with whether a smaller id has exactly its words."""
    described = stored(
        texts.mapInArrow(_described(window), "doc bigint, copy bigint, n bigint, class string, anchors array<bigint>"), "described"
    )
    lowest = described.where("class IS NOT NULL").groupBy("class").agg(F.min("doc").alias("lowest"))
    sets = stored(described.join(lowest, "class", "left").withColumn("again", F.col("doc") > F.col("lowest")).drop("lowest"), "sets")
    discard(described)
    return sets


def _candidates(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc, copy, hits, text`` of the documents with an anchor that another one has too."""
    anchors = sets.where("NOT again").select("doc", "copy", F.explode("anchors").alias("anchor"))
    repeated = anchors.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    hits = anchors.join(repeated.select("anchor"), "anchor").groupBy("doc", "copy").agg(F.collect_set("anchor").alias("hits"))
    found = texts.join(hits, ["doc", "copy"]).dropDuplicates(["doc", "copy"])
    return stored(found.select("doc", "copy", "hits", "text"), "candidates")


def _places(candidates: DataFrame, window: int) -> DataFrame:
    """``doc, copy, first, at`` of every window that starts in several documents; ``first`` is the smallest."""
    windows = stored(candidates.mapInArrow(_windows(window), "hash bigint, doc bigint, copy bigint, at int"), "windows")
    repeated = windows.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("high")).where("first < high")
    # Stored, so that the join reads plain tables and splits the windows of a passage that is in many documents.
    repeated = stored(repeated.select("hash", "first"), "repeated")
    of = windows.join(repeated, "hash")
    places = stored(
        of.groupBy("doc", "copy").agg(F.collect_list(F.struct("first", "at")).alias("places")), "places"
    )
    discard(windows, repeated)
    return places


def _found(candidates: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """``doc, copy, spans``: what automata of the reference shards find in later documents."""
    passages = stored(
        candidates.select("doc", "copy", "text")
        .join(places, ["doc", "copy"])
        .mapInArrow(_passages(window), "shard bigint, kind int, piece int, doc bigint, copy bigint, at int, words binary"),
        "passages",
    )
    # Each piece of a reference meets each portion of the later documents.
    sizes = passages.groupBy("shard").agg(
        F.ceil(F.count_if(F.col("kind") == 1) / STREAMED).cast("int").alias("parts"), (F.max("piece") + 1).alias("pieces")
    )
    every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    reference = F.col("kind") == 0
    one = F.array(F.pmod(F.xxhash64("doc", "copy", "at"), F.col("parts")).cast("int"))
    dealt = (
        passages.join(sizes.where("parts > 0"), "shard")
        .withColumn("part", F.explode(F.when(reference, every("parts")).otherwise(one)))
        .withColumn("piece", F.explode(F.when(reference, F.array("piece")).otherwise(every("pieces"))))
    )
    spans = (
        dealt.drop("parts", "pieces")
        .repartition("shard", "piece", "part")
        .sortWithinPartitions("shard", "piece", "part", "kind", "doc", "at")
        .mapInArrow(_streamed(window), "doc bigint, copy bigint, start int, end int")
    )
    found = stored(spans.groupBy("doc", "copy").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")), "spans")
    discard(passages)
    return found


def repeated_spans(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``doc, copy, spans``: word positions (end exclusive, may overlap) that earlier documents hold already.

    A window is ``window`` consecutive words of one document. A span is covered by windows whose words also start in a document
    with a smaller id. Windows are judged on the input. Only documents with a span have a row; ``doc`` is
    the id (a null id counts as the smallest) and ``copy`` a hash of the text.

    1. Documents with exactly the words of a smaller id are covered whole.
    2. Of every window the run of half its length with the smallest hash is its anchor: equal windows have
       equal anchors, and neighbouring windows mostly share one. Only windows with an anchor that occurs in several documents can
       repeat. These are hashed, and the smallest document of each hash is its reference.
    3. The passages of a reference document are a shard, for which a suffix automaton is built. It goes along with each portion
       of the later documents that were found to repeat it; they are streamed through, and the matching statistics give the
       maximal spans of equal words.

    An automaton of all documents, sent to all tasks, would grow with the corpus. These hold only what repeats of one document, and
    ``PIECE_WORDS`` of its words at most: a longer reference has several. Counting and joining by hash is combined before the shuffle and split by the joins where one
    passage is in a great part of all documents.
    """
    texts = _keyed(documents)
    sets = _sets(texts, window)
    candidates = _candidates(sets, texts)
    places = _places(candidates, window)
    found = _found(candidates, places, window)
    discard(candidates, places)
    whole = sets.where("again").select(
        "doc", "copy", F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))).cast(_SPANS).alias("spans")
    )
    return found.select("doc", "copy", F.col("spans").cast(_SPANS)).unionAll(whole.distinct())


def without_repeats(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """All columns of ``documents`` with ``text`` cleaned, and ``n_words`` and ``n_removed``.

    The words of :func:`repeated_spans` go; the text of a document that loses some is the kept words joined by one space,
    any other text is as it was. Null text has no words and stays null. Each row gives a row; rows that repeat id and
    text get the same result.
    """
    own = [name for name in documents.columns if name not in ("n_words", "n_removed")]
    row = documents.select(*own)
    packed = _keyed(documents, F.struct(*own).alias("row")).drop("text")
    at = own.index("text")
    joined = packed.join(repeated_spans(documents, window), ["doc", "copy"], "left").select("row.*", F.col("spans").alias("\0spans"))

    def cut(batches):
        for batch in batches:
            texts, sizes, gone = [], [], []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(len(own)).to_pylist(), strict=True):
                words = text.encode().split() if text else []
                keep = np.ones(len(words), bool)
                for span in spans or ():
                    keep[span["start"] : span["end"]] = False
                lost = int(len(words) - keep.sum())
                sizes.append(len(words))
                gone.append(lost)
                texts.append(b" ".join(w for w, k in zip(words, keep, strict=True) if k).decode() if lost else text)
            columns = list(batch.columns[: len(own)])
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.record_batch(columns, [*own, "n_words", "n_removed"])

    return joined.mapInArrow(cut, StructType(list(row.schema.fields)).add("n_words", "long").add("n_removed", "long"))
