"""Toxicity classifier whose score hardly changes when identity terms are swapped."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playline.llm.spans import (
    LOWER,
    U64,
    chunks,
    id_and_text,
    in_rows,
    owner,
    span_hashes,
)
from playline.session import stage

#: Labelled keys that a fit takes at most, chosen by a hash of their key.
TRAIN_ROWS = 20_000
#: Bytes that their texts have together at most; the driver gets about as many, or fewer.
TRAIN_BYTES = 1 << 27
#: Words a model weighs at most: those whose presence differs most between the labels.
FEATURES = 20_000
#: A word must occur in so many labelled texts.
FEWEST_TEXTS = 3
#: Weight of the penalty on score changes, of the squared weights, and the steps of the fit.
COUNTERFACTUAL, RIDGE, STEPS = 5.0, 3e-5, 250

#: Neutral mentions of groups; a swap puts a term of the same line in place.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("femmes", "hommes", "filles"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer", "mädchen"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres", "niñas"),
    ("musulmanes", "cristianos", "judíos"),
)

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?\n")] = True


def tokens(data, offsets):
    """Hashes, rows and starts of the words: digits, lower-cased letters and all above ASCII."""
    data = LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2] | edge[1:-1]
    ends = inside[:-1] & (~inside[1:] | edge[1:])
    starts = np.flatnonzero(begins)
    hashes = span_hashes(data, starts, np.flatnonzero(ends) + 1)
    return hashes, owner(offsets, starts), starts


def word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(tokens(data, np.array([0, len(data)]))[0][0])


def distinct(hashes, rows, count):
    """Distinct words of each row, and where each row's begin."""
    _, first = np.unique(in_rows(hashes, rows), return_index=True)
    first = first[np.argsort(rows[first], kind="stable")]
    return hashes[first], np.searchsorted(rows[first], np.arange(count + 1))


def sentences(hashes, rows, starts, data, terms):
    """Rows and distinct words of the sentences with an identity term, and the terms of each."""
    breaks = np.cumsum(STOP[data])
    place = breaks[starts] if len(starts) else starts
    begins = np.ones(len(hashes), bool)
    begins[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    borders = np.append(np.flatnonzero(begins), len(hashes))
    of_word = np.cumsum(begins) - 1
    for sentence in np.unique(of_word[np.isin(hashes, terms)]).tolist():
        low, high = borders[sentence], borders[sentence + 1]
        own = np.unique(hashes[low:high])
        yield rows[low], own, own[np.isin(own, terms)]


def identity_groups() -> dict[int, list[int]]:
    out = {}
    for terms in IDENTITY_TERMS:
        hashed = [word_hash(t) for t in terms]
        for term in hashed:
            out[term] = [x for x in hashed if x != term]
    return out


@dataclass
class Model:
    """Weights of words, by ascending hash, and the constant."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, data, offsets) -> np.ndarray:
        count = len(offsets) - 1
        hashes, rows, _ = tokens(data, offsets)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        known = self.words[at] == hashes if len(self.words) else np.zeros(len(hashes), bool)
        own, places = distinct(hashes[known], rows[known], count)
        weights = self.weights[np.searchsorted(self.words, own)]
        total = np.concatenate([[0.0], np.cumsum(weights)])
        margin = total[places[1:]] - total[places[:-1]] + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class Sparse:
    """Rows of 0/1 features, as places in the list of words; sums go over blocks of rows."""

    BLOCK = 1 << 20

    def __init__(self, lists: list[np.ndarray], width: int):
        self.count, self.width = len(lists), width
        self.at = np.concatenate([np.empty(0, np.int32), *lists]).astype(np.int32, copy=False)
        self.places = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])

    def blocks(self):
        first = 0
        while first < self.count:
            most = self.places[first] + self.BLOCK
            stop = max(int(np.searchsorted(self.places, most, "right")) - 1, first + 1)
            stop = min(stop, self.count)
            own = self.places[first : stop + 1]
            yield first, stop, self.at[own[0] : own[-1]], own - own[0]
            first = stop

    def times(self, weights):
        out = np.empty(self.count)
        for first, stop, at, places in self.blocks():
            total = np.concatenate([[0.0], np.cumsum(weights[at])])
            out[first:stop] = total[places[1:]] - total[places[:-1]]
        return out

    def back(self, values):
        out = np.zeros(self.width)
        for first, stop, at, places in self.blocks():
            out += np.bincount(at, np.repeat(values[first:stop], np.diff(places)), self.width)
        return out


@dataclass
class Swaps:
    """Sentences, and for each swap its sentence, the word that goes and the one that comes (the
    place behind all words where the sentence has that one already)."""

    sentences: Sparse
    of: np.ndarray
    gone: np.ndarray
    new: np.ndarray


def places_of(hashes, words) -> np.ndarray:
    """Places of those hashes that are among the ascending ``words``."""
    at = np.searchsorted(words, hashes)
    at[at == len(words)] = 0
    return at[words[at] == hashes].astype(np.int32) if len(words) else np.empty(0, np.int32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(lists, labels, pairs, penalty=COUNTERFACTUAL, ridge=RIDGE, steps=STEPS) -> Model:
    """Fit on texts as arrays of distinct word hashes, and on swaps as pairs of such arrays."""
    labels = np.asarray(labels, float)
    if constant := only_label(len(labels), labels.sum()):
        return constant
    flat = np.concatenate([np.empty(0, U64), *lists])
    words, which, seen = np.unique(flat, return_inverse=True, return_counts=True)
    toxic = np.bincount(which, np.repeat(labels, [len(x) for x in lists]), len(words))
    share = labels.mean()
    strength = np.abs(toxic - seen * share) / np.sqrt(seen * share * (1 - share) + 1e-9)
    strength[seen < FEWEST_TEXTS] = -1
    best = np.argsort(-strength, kind="stable")[:FEATURES]
    words = with_terms(words[best[strength[best] >= 0]])

    def place(hashes, other):
        found = places_of(np.setdiff1d(hashes, other), words)
        return int(found[0]) if len(found) else len(words)

    swaps = Swaps(
        Sparse([places_of(a, words) for a, _ in pairs], len(words)),
        np.arange(len(pairs)),
        np.array([place(a, b) for a, b in pairs], np.int64),
        np.array([place(b, a) for a, b in pairs], np.int64),
    )
    x = Sparse([places_of(own, words) for own in lists], len(words))
    return solve(words, x, labels, swaps, penalty, ridge, steps)


def only_label(count, toxic) -> Model | None:
    """The constant for texts of one label or none."""
    if 0 < toxic < count:
        return None
    return Model(np.empty(0, U64), np.empty(0), 5.0 if toxic else -5.0)


def with_terms(words) -> np.ndarray:
    return np.union1d(words, np.array(sorted(identity_groups()), U64))


def solve(words, x, labels, swaps, penalty=COUNTERFACTUAL, ridge=RIDGE, steps=STEPS) -> Model:
    """Logistic loss, squared weights, and the mean squared change of the score by swaps."""
    count = len(swaps.of)
    weights, bias = np.zeros(len(words)), float(np.log(labels.mean() / (1 - labels.mean())))
    speed, change, bias_speed, bias_change = np.zeros(len(words)), np.zeros(len(words)), 0.0, 0.0
    for step in range(1, steps + 1):
        p = sigmoid(x.times(weights) + bias)
        error = (p - labels) / x.count
        slope, bias_slope = x.back(error) + ridge * weights, error.sum()
        if count:
            # The place behind all words weighs nothing.
            known = np.append(weights, 0.0)
            before = (swaps.sentences.times(weights) + bias)[swaps.of]
            a, b = sigmoid(before), sigmoid(before - known[swaps.gone] + known[swaps.new])
            gap = 2 * penalty * (a - b) / count
            up, down = gap * a * (1 - a), gap * b * (1 - b)
            both = np.bincount(swaps.of, up - down, swaps.sentences.count)
            slope += swaps.sentences.back(both)
            slope += np.bincount(swaps.gone, down, len(words) + 1)[:-1]
            slope -= np.bincount(swaps.new, down, len(words) + 1)[:-1]
            bias_slope += (up - down).sum()
        # Adam, with its usual constants.
        change = 0.9 * change + 0.1 * slope
        speed = 0.999 * speed + 0.001 * slope**2
        bias_change = 0.9 * bias_change + 0.1 * bias_slope
        bias_speed = 0.999 * bias_speed + 0.001 * bias_slope**2
        low, high = 1 - 0.9**step, 1 - 0.999**step
        weights -= 0.05 * (change / low) / (np.sqrt(speed / high) + 1e-8)
        bias -= 0.05 * (bias_change / low) / (np.sqrt(bias_speed / high) + 1e-8)
    margin = x.times(weights) + bias
    return Model(words, weights, bias - best_cut(margin, labels))


def best_cut(margin, labels) -> float:
    """The margin from which on "toxic" has the best balance of precision and recall."""
    order = np.argsort(-margin, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    at = int(np.argmax(f1))
    below = margin[order[at + 1]] if at + 1 < len(order) else margin[order[at]] - 1
    return float(margin[order[at]] + below) / 2


def labelled(docs, labels, key, text, label, rows) -> DataFrame:
    """Texts of the bounded sample of labelled keys outside the held-out fold; one label a key, the
    larger of several."""
    marks = (
        labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` marks of two numbers, so their size is known.
    joined = id_and_text(docs, key, text).join(F.broadcast(marks), "doc_id")
    return joined.where(F.col("utf8").isNotNull()).select(
        "doc_id", F.col("label").cast("long").alias("label"), "utf8"
    )


def within(sample: DataFrame, most: int) -> DataFrame:
    """The rows of those keys, in the sample's order, whose texts have ``most`` bytes together; a
    key that has more alone is passed over."""
    sizes = sample.groupBy("doc_id").agg(F.sum("bytes").alias("own")).where(F.col("own") <= most)
    # One row a key of the sample, so the window has few.
    running = F.sum("own").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    keys = sizes.select("doc_id", running.alias("sum")).where(F.col("sum") <= most)
    return sample.join(F.broadcast(keys.select("doc_id")), "doc_id", "left_semi")


def held_out():
    return F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = TRAIN_ROWS,
    most: int = TRAIN_BYTES,
) -> Model:
    """Fit on the texts of at most ``rows`` labelled keys, of ``most`` bytes together, whose crc32, as
    text, is no multiple of 5.

    Features are the distinct words of a whole text. They are counted by label in Spark; the driver gets
    the best of them and, of each text and each sentence with an identity term, their places, at four
    bytes each. A sentence counts once for each of its terms and each other term of that line. Rows without
    a key, text or label are left out of the fit (an empty text has no words and stays in); all rows of a
    key that stands more than once are fitted. Without labelled rows, or with only one kind of label, the
    score is a constant. A text may be of any length below ``most``, as one sentence too.
    """
    groups = identity_groups()
    terms = np.array(sorted(groups), U64)

    def split(batches):
        for batch in batches:
            for first, stop, data, offsets in chunks(batch.column(2)):
                hashes, found, starts = tokens(data, offsets)
                own, places = distinct(hashes, found, stop - first)
                said = [[] for _ in range(stop - first)]
                for row, words, hit in sentences(hashes, found, starts, data, terms):
                    said[row].append({"words": words.tobytes(), "terms": hit.tobytes()})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, stop - first),
                        batch.column(1).slice(first, stop - first),
                        pa.array(np.diff(offsets)),
                        pa.array([own[a:b].tobytes() for a, b in zip(places, places[1:])], pa.binary()),
                        pa.array(
                            said, pa.list_(pa.struct([("words", pa.binary()), ("terms", pa.binary())]))
                        ),
                    ],
                    ["doc_id", "label", "bytes", "words", "sentences"],
                )

    def count(batches):
        for batch in batches:
            own = [np.frombuffer(w, U64) for w in batch.column(1).to_pylist()]
            flat = np.concatenate([np.empty(0, U64), *own])
            marks = np.repeat(np.asarray(batch.column(0)), [len(x) for x in own])
            words, which, seen = np.unique(flat, return_inverse=True, return_counts=True)
            toxic = np.bincount(which, marks, len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(seen), pa.array(toxic)],
                ["word", "seen", "toxic"],
            )

    spark = docs.sparkSession
    sample = labelled(docs, labels, key, text, label, rows).mapInArrow(
        split,
        "doc_id long, label long, bytes long, words binary, "
        "sentences array<struct<words: binary, terms: binary>>",
    )
    sample = within(stage(sample, "toxicity-sample"), most)
    total = sample.agg(F.count("label").alias("count"), F.sum("label").alias("toxic")).first()
    if constant := only_label(total["count"], total["toxic"] or 0):
        return constant
    share = total["toxic"] / total["count"]
    expected = F.col("seen") * share
    best = (
        sample.select("label", "words")
        .mapInArrow(count, "word long, seen long, toxic long")
        .groupBy("word")
        .agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic"))
        .where(F.col("seen") >= FEWEST_TEXTS)
        # Ties go to the smaller hash, without sign.
        .orderBy(
            F.desc(F.abs(F.col("toxic") - expected) / F.sqrt(expected * (1 - share) + 1e-9)),
            F.col("word") < 0,
            "word",
        )
        .limit(FEATURES)
        .select("word")
        .toArrow()
    )
    words = with_terms(best.column("word").to_numpy().astype(np.int64).view(U64))
    shared = spark.sparkContext.broadcast(words)

    def place(batches):
        for batch in batches:
            own = [
                places_of(np.frombuffer(w, U64), shared.value).tobytes()
                for w in batch.column(1).to_pylist()
            ]
            said = [
                [
                    {
                        part: places_of(np.frombuffer(s[part], U64), shared.value).tobytes()
                        for part in ("words", "terms")
                    }
                    for s in row
                ]
                for row in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(own, pa.binary()),
                    pa.array(said, pa.list_(pa.struct([("words", pa.binary()), ("terms", pa.binary())]))),
                ],
                ["label", "words", "sentences"],
            )

    got = (
        sample.select("label", "words", "sentences")
        .mapInArrow(
            place, "label long, words binary, sentences array<struct<words: binary, terms: binary>>"
        )
        .toArrow()
    )
    shared.destroy()
    x = Sparse([np.frombuffer(w, np.int32) for w in got.column("words").to_pylist()], len(words))
    said = [s for row in got.column("sentences").to_pylist() for s in row]
    own = [np.frombuffer(s["words"], np.int32) for s in said]
    others = {
        int(places_of(np.array([term], U64), words)[0]): places_of(np.array(sorted(rest), U64), words)
        for term, rest in groups.items()
    }
    of, gone, new = [], [], []
    for at, sentence in enumerate(said):
        for term in np.frombuffer(sentence["terms"], np.int32).tolist():
            come = others[term]
            of.append(np.full(len(come), at))
            gone.append(np.full(len(come), term))
            new.append(np.where(np.isin(come, own[at]), len(words), come))
    joined = [np.concatenate([np.empty(0, np.int64), *part]).astype(np.int64) for part in (of, gone, new)]
    labels_of = np.asarray(got.column("label").to_pylist(), float)
    return solve(words, x, labels_of, Swaps(Sparse(own, len(words)), *joined))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text; a null text is an empty one.

    Only the text enters the score. A null key stays null and is not held out; repeated rows are
    each scored; other columns are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, stop - first),
                        pa.array(shared.value.scores(data, offsets)),
                    ],
                    ["doc_id", "score"],
                )

    scored = id_and_text(docs, key, text).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below 0.5; a null text is an empty one.

    Repeated rows stay or go together; an empty table stays empty. Columns may have any names. Texts are
    read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            scores = [
                shared.value.scores(data, offsets)
                for _, _, data, offsets in chunks(batch.column(place))
            ]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < 0.5))

    # A call by Arrow takes plain names only.
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
