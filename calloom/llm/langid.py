"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent.

A text's words give features: the word itself and its 2- and 3-letter pieces, hashed to ``BUCKETS`` rows of an
embedding table. The mean of the rows of all features of the whole text goes through a linear layer and a softmax.
As the layer is linear, a word's share of the result is fixed: workers keep it per word, and a document costs one look-up
per distinct word.

Fitting takes a bounded sample of the labelled rows (``PER_LANG`` of each language, ``MAX_DOCS`` in all, those with the
smallest hashes of their ids): features are made on the executors, one task trains, and the driver sees the model, whose
size is fixed. A fifth of the sample sets the temperature, so that scores are probabilities, and the score below which a
prediction is rejected. Prediction is one scan of whole texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and rejected; without labelled rows all
are; repeated rows give repeated results; equal scores go to the first language in alphabetical order; input columns
named like a result are replaced.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from calloom.llm.common import first_of_each, text_batches

BUCKETS = 1 << 14
DIM = 16
PER_LANG = 256
MAX_DOCS = 2048
EPOCHS = 12
RATE = 2.0
#: Words in the short pieces that a sampled text also gives, and how many of them.
PIECE_WORDS, PIECES = 6, 4
#: Share of rightly predicted calibration texts that rejection may cost.
REJECTED_SHARE = 0.002
UNDETERMINED = "und"
KEPT_WORDS = 200_000

LETTERS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Buckets of a lower-case word."""
    framed = f"<{word}>"
    pieces = [framed, *(framed[i : i + n] for n in (2, 3) for i in range(len(framed) - n + 1))]
    return [crc32(piece.encode()) % BUCKETS for piece in pieces]


def _bag(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's words and the share of each."""
    totals: Counter = Counter()
    for word, n in counts.items():
        for bucket in word_features(word):
            totals[bucket] += n
    buckets = np.fromiter(totals.keys(), np.int32, len(totals))
    shares = np.fromiter(totals.values(), np.float32, len(totals))
    return buckets, shares / shares.sum()


def _examples(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """The whole text, and short pieces spread over it, so that short texts are learned too."""
    found = LETTERS.findall(text.lower())
    if not found:
        return []
    step = max(1, len(found) // PIECES)
    pieces = [found[i : i + PIECE_WORDS] for i in range(0, len(found), step)][:PIECES]
    return [_bag(Counter(words)) for words in [found, *pieces]]


class Model:
    """Weights of each bucket for each language, intercepts, temperature, and the least score that is accepted."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray):
        self.langs, self.weights, self.bias = langs, weights, bias
        self.temperature, self.least = 1.0, 0.0

    def logits(self, bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return bag[1] @ self.weights[bag[0]] + self.bias


def _softmax(logits: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    shifted = np.exp((logits - logits.max(axis=-1, keepdims=True)) / temperature)
    return shifted / shifted.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, bool, list]]) -> Model | None:
    """The model of (language, whether it calibrates, bags) rows; None without any."""
    langs = sorted({lang for lang, _, _ in rows})
    if not langs:
        return None
    index = {lang: i for i, lang in enumerate(langs)}
    fit = [(bag, index[lang]) for lang, held, bags in rows if not held for bag in bags]
    check = [(bag, index[lang]) for lang, held, bags in rows if held for bag in bags] or fit
    fit = fit or check
    random = np.random.default_rng(0)
    table = random.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((DIM, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    layer += random.normal(0, 0.1, layer.shape).astype(np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for at in random.permutation(len(fit)):
            (buckets, shares), right = fit[at]
            mean = shares @ table[buckets]
            error = _softmax(mean @ layer + bias)
            error[right] -= 1
            back = layer @ error
            layer -= rate * 0.1 * np.outer(mean, error)
            bias -= rate * 0.01 * error
            table[buckets] -= rate * shares[:, None] * back
    model = Model(langs, table @ layer, bias)
    logits = np.array([model.logits(bag) for bag, _ in check])
    right = np.array([lang for _, lang in check])
    loss = lambda t: -np.log(_softmax(logits, t)[np.arange(len(right)), right] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    scores = _softmax(logits, model.temperature)
    won = scores.max(axis=1)[scores.argmax(axis=1) == right]
    # below 1 / languages nothing can score; one half at most, where no other language can win
    model.least = float(min(np.quantile(won, REJECTED_SHARE), 0.5)) if len(won) else 0.0
    return model


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> bytes:
    """A model of the labelled rows of ``docs`` (null languages say nothing), serialised."""
    labelled = docs.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    labelled = labelled.filter("_lang is not null and _text is not null").withColumn("_order", F.xxhash64("_key"))
    # ids first, without texts; the texts of those few rows come with a join
    chosen = (
        first_of_each(labelled.select("_lang", "_order", "_key"), "_lang", ["_order", "_key"], PER_LANG)
        .orderBy("__rank", "_lang").limit(MAX_DOCS).select("_key", "_lang").distinct()
    )
    held = F.crc32(F.concat(F.col("_key").cast("string"), F.lit("calibrate"))) % 5 == 0
    sample = labelled.join(chosen, ["_key", "_lang"], "left_semi").select("_order", "_lang", held.alias("_held"), "_text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "_text"):
            made = pa.array([pickle.dumps(_examples(t)) for t in texts], pa.binary())
            columns = [batch.column(name) for name in ("_order", "_lang", "_held")]
            yield pa.RecordBatch.from_arrays([*columns, made], names=["_order", "_lang", "_held", "bags"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for row in batch.to_pylist():
                rows.append((row["_lang"], bool(row["_held"]), pickle.loads(row["bags"])))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())], names=["model"])

    # repeated ids could bring more rows than were chosen: the bound holds for rows
    made = sample.mapInArrow(bags, "_order long, _lang string, _held boolean, bags binary")
    made = made.orderBy("_order", "_lang", "bags").limit(MAX_DOCS)
    row = made.coalesce(1).mapInArrow(learn, "model binary").first()
    return row["model"] if row else pickle.dumps(None)


class _Words(dict):
    """A word's row in a table of its summed weights and its number of features; fills itself."""

    def __init__(self, model: Model):
        super().__init__()
        self.weights = model.weights.astype(np.float64)
        self.sums = np.zeros((KEPT_WORDS, len(model.langs) + 1))

    def __missing__(self, word: str) -> int:
        row = len(self)
        buckets = word_features(word)
        self.sums[row, :-1] = self.weights[buckets].sum(axis=0)
        self.sums[row, -1] = len(buckets)
        self[word] = row
        return row

    def totals(self, counts: Counter) -> np.ndarray:
        """Sums over a text's words, in parts that fit the table."""
        whole, words = np.zeros(self.sums.shape[1]), list(counts)
        for at in range(0, len(words), KEPT_WORDS // 2):
            part = words[at : at + KEPT_WORDS // 2]
            if len(self) + len(part) > KEPT_WORDS:
                self.clear()
            times = np.fromiter(map(counts.__getitem__, part), np.float64, len(part))
            whole += times @ self.sums[[self[word] for word in part]]
        return whole


def predict(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (the calibrated probability) and accepted (whether the score is high enough)."""
    docs = docs.drop("lang_pred", "score", "accepted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [
        T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
        T.StructField("accepted", T.BooleanType(), False),
    ]
    schema = T.StructType([*docs.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = pickle.loads(shared.value)
        words = _Words(fitted) if fitted else None
        for batch, texts in text_batches(batches, text):
            langs, scores, accepted = [], [], []
            for t in texts:
                found = LETTERS.findall(t.lower()) if fitted else []
                if not found:
                    langs.append(UNDETERMINED), scores.append(0.0), accepted.append(False)
                    continue
                sums = words.totals(Counter(found))
                chances = _softmax(sums[:-1] / sums[-1] + fitted.bias, fitted.temperature)
                best = int(chances.argmax())
                langs.append(fitted.langs[best]), scores.append(float(chances[best]))
                accepted.append(scores[-1] >= fitted.least)
            added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return docs.mapInArrow(run, schema)
