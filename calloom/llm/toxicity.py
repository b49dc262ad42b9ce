"""Toxicity by nearest labelled examples: exact TF-IDF cosine from a block-max inverted index, and weighted votes.

Fitting takes a bounded sample of labelled rows (``PER_CLASS`` of each label, those with the smallest hashes of their
ids). Terms are all words of a text. To them come beginnings of 4 to 8 letters of longer words, so that compounds and
inflections count as what they begin with; a beginning found twice, or three times, in a text is a term of its own, as
some are rare only in such number. Of the beginnings those are terms that the sample's toxic texts hold more often
(chi-squared of at least ``MIN_CHI2``, at most ``MAX_LEANING``). Words and beginnings that lean so weigh the root of their
chi-squared more; no word is left out. Document frequencies are counted over all documents given. An example is its
weighted TF-IDF vector over all its terms, of length one.

The inverted index holds, by term, the examples' weights. What the ``DENSE`` most frequent terms add to a cosine comes from
one product of a matrix in single precision for a batch of queries, and terms of up to ``SHORT`` examples are read whole.
Of the terms between, which have most of the postings, the index keeps the largest weight in each block of ``BLOCK``
examples. What a query has summed so far is a floor for its k-th best cosine; with the maxima it bounds each block's best
cosine, and the query reads the postings of the blocks that can reach the floor. All that can be among the best within the
error of single precision is summed again over its whole vector in double precision: the ``NEIGHBOURS`` nearest are exact.
Examples stand in the order of the direction in which the weights of frequent terms differ most, as those of languages
do, so that a block holds like texts. The nearest vote with the square of their cosine, against a prior of fixed weight; a
logistic curve fitted to the votes that examples get from all others, with classes weighed as in the labels, makes that a
calibrated score.

The index over the sample's terms and the frequencies of the most frequent words are broadcast. All other words of a
text touch only the length of its vector: their frequencies are joined by word and summed per document.

Defined cases: null, empty and wordless texts have no neighbours and get the score that such examples deserve; a word
that no document of the fit holds counts as held by one; without labels, or with labels of one kind, the score is the
share of toxic labels (0 without any); a doc_id with several labels is toxic if one says so; labels other than 0 and 1
say nothing; repeated texts among the examples count once; equal cosines go to the smaller doc_id; repeated rows give
repeated results.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from calloom.llm.common import add_rest, first_of_each, hottest, row_keys, text_batches
from calloom.session import stage

PER_CLASS = 8192
MIN_CHI2 = 25.0
#: Terms that weigh more because they lean toxic, at most.
MAX_LEANING = 4096
BEGINNINGS = (4, 5, 6, 7, 8)
#: Times that a beginning has to occur for its terms.
TIMES = (1, 2, 3)
#: Examples in a block, neighbouring ones of which the best makes a floor, and examples of a term that is read whole.
BLOCK, STRIPE, SHORT = 512, 64, 64
#: A posting: eight bytes, which are read in one piece.
POSTING = np.dtype([("example", np.int32), ("weight", np.float32)])
#: Terms kept as rows of a matrix, the error that single precision can add to a cosine, and queries to a product.
DENSE, ERROR, BATCH = 256, 2e-5, 64
NEIGHBOURS = 10
PRIOR_WEIGHT = 0.5
#: Words that a worker keeps, and counts that a task gathers before it passes them on.
KEPT_WORDS, KEPT_COUNTS = 300_000, 300_000

LETTERS = re.compile(r"[^\W\d_]+")
#: Bytes of lower-case ASCII texts: all but letters become spaces.
ASCII_LETTERS = bytes(c if chr(c).isalpha() else 32 for c in range(128)) + bytes(128)


def letter_words(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    text = text.lower()
    if text.isascii():
        return text.encode().translate(ASCII_LETTERS).decode().split()
    return LETTERS.findall(text)


def word_bases(word: str) -> list[str]:
    """A lower-case word, and its beginnings marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def base_terms(base: str) -> list[tuple[int, str]]:
    """The terms of a word or beginning, each with the times it has to occur."""
    return [(n, base + str(n)) for n in TIMES] if base.endswith("-") else [(1, base)]


class HeldTerms:
    """How many texts hold each term, of all terms that texts can have."""

    def __init__(self):
        self.bases: dict[str, list[str]] = {}
        self.words, self.held = Counter(), [Counter() for _ in TIMES]

    def add(self, text: str) -> None:
        counts: dict[str, int] = {}
        words = Counter(letter_words(text))
        for word, n in words.items():
            bases = self.bases.get(word)
            if bases is None:
                if len(self.bases) >= KEPT_WORDS:
                    self.bases.clear()
                bases = self.bases[word] = word_bases(word)[1:]
            for base in bases:
                counts[base] = counts.get(base, 0) + n
        self.words.update(words.keys())
        for least, held in zip(TIMES, self.held):
            held.update(counts.keys() if least == 1 else [base for base, n in counts.items() if n >= least])

    def totals(self) -> dict[str, int]:
        """Texts by term."""
        made = dict(self.words)
        for n, held in zip(TIMES, self.held):
            made.update(zip([base + str(n) for base in held], held.values()))
        return made


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(_key, _label, _hash, _text): the bounded sample of labelled texts, each text and hash once."""
    known = labels.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label")).filter("_label in (0, 1)")
    known = known.withColumn("_order", F.xxhash64("_key"))
    chosen = first_of_each(known, "_label", ["_order", "_key"], PER_CLASS).select("_key", "_label")
    # at most 2 * PER_CLASS pairs of numbers
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter("_text is not null")
    rows = texts.join(F.broadcast(chosen), "_key").withColumn("_hash", F.xxhash64("_text"))
    own = Window.partitionBy("_hash").orderBy("_key")
    rows = rows.withColumn("_copy", F.row_number().over(own)).filter("_copy = 1")
    return rows.orderBy("_hash").limit(2 * PER_CLASS).select("_key", "_label", "_hash", "_text")


def leaning_terms(examples: DataFrame) -> dict[str, float] | None:
    """How much more the terms weigh that lean toxic; None without examples of both labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "_text"):
            found = (HeldTerms(), HeldTerms())
            for t, label in zip(texts, batch.column("_label").to_pylist()):
                found[label].add(t)
            totals = [held.totals() for held in found]
            terms = list(totals[0] | totals[1])
            clean, toxic = ([counts.get(term, 0) for term in terms] for counts in totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())],
                names=["term", "clean", "toxic"],
            )

    sizes = {row["_label"]: row["count"] for row in examples.groupBy("_label").count().collect()}
    n0, n1 = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    if not n0 or not n1:
        return None
    counted = examples.select("_label", "_text").mapInArrow(run, "term string, clean long, toxic long").groupBy("term")
    counted = counted.agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    a, b = F.col("a"), F.col("b")
    both = (a + b) * (F.lit(n0 + n1) - a - b)
    chi2 = F.when(both > 0, (n0 + n1) * F.pow(b * (n0 - a) - a * (n1 - b), 2) / (both * n0 * n1)).otherwise(F.lit(0.0))
    kept = counted.withColumn("chi2", chi2).filter((F.col("chi2") >= MIN_CHI2) & (b * n0 > a * n1))
    return {row["term"]: math.sqrt(row["chi2"]) for row in kept.orderBy(F.desc("chi2"), "term").limit(MAX_LEANING).collect()}


class Terms:
    """The terms of texts, with a bounded memory of words."""

    def __init__(self, leaning: dict[str, float]):
        self.words, self.levels = {}, {}
        for term in leaning:
            if "-" in term:
                base = term[: term.index("-") + 1]
                self.levels[base] = [(n, t) for n, t in base_terms(base) if t in leaning]

    def of(self, text: str) -> dict[str, int]:
        """All words of a text with their number, and its leaning beginnings, once each."""
        held, known, levels, counts = Counter(letter_words(text)), self.words, self.levels, {}
        for word, found in zip(held, list(map(known.get, held))):
            if found is None:
                if len(known) >= KEPT_WORDS:
                    known.clear()
                found = known[word] = tuple([base for n in BEGINNINGS if len(word) > n and (base := word[:n] + "-") in levels])
            if found:
                n = held[word]
                for base in found:
                    counts[base] = counts.get(base, 0) + n
        for base, n in counts.items():
            for least, term in self.levels[base]:
                if n >= least:
                    held[term] = 1
        return held


def document_frequencies(docs: DataFrame, leaning: dict[str, float], text: str = "text") -> DataFrame:
    """(term, c) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = Terms(leaning), Counter()

        def passed_on() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(made, names=["term", "n"])

        for _, texts in text_batches(batches, text):
            for t in texts:
                counts.update(terms.of(t).keys())
                if len(counts) >= KEPT_COUNTS:
                    yield passed_on()
        yield passed_on()

    return docs.select(text).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("c"))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each start up to its end, and how many each has."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes), sizes


class BlockMaxIndex:
    """Postings by term in blocks of examples, with the largest weight of each block."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        spans = np.cumsum([0, *(len(terms) for terms, _ in vectors)])
        terms = np.concatenate([np.zeros(0, np.int64), *(terms for terms, _ in vectors)])
        weights = np.concatenate([np.zeros(0), *(weights for _, weights in vectors)])
        self._fill(keys, labels, spans, terms, weights, n_terms)

    @classmethod
    def laid_out(
        cls, keys: np.ndarray, labels: np.ndarray, spans: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int
    ) -> BlockMaxIndex:
        """Of vectors that lie end to end, each from one span to the next; no vector is copied by itself."""
        made = cls.__new__(cls)
        made._fill(keys, labels, spans, terms, weights, n_terms)
        return made

    def _fill(self, keys, labels, spans, terms, weights, n_terms) -> None:
        self.keys, self.labels, self.n_blocks = keys, labels, -(-len(keys) // BLOCK)
        # the whole vectors, one after another, and a query's weights by term while it is asked
        self.spans, self.terms, self.whole, self.query = spans, terms, weights, np.zeros(n_terms)
        examples = np.repeat(np.arange(len(keys), dtype=np.int32), np.diff(spans))
        often = np.bincount(terms, minlength=n_terms)
        frequent = np.argsort(-often, kind="stable")[:DENSE]
        self.rows = np.full(n_terms, -1, np.int32)
        self.rows[frequent] = np.arange(len(frequent))
        row = self.rows[terms]
        high, low = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        self.dense = np.zeros((len(frequent), len(keys)), np.float32)
        self.dense[row[high], examples[high]] = weights[high]
        del row, high
        terms, examples, weights = terms[low], examples[low], weights[low]
        del low
        order = np.argsort(terms, kind="stable")
        terms, self.postings = terms[order], np.empty(len(terms), POSTING)
        self.postings["example"], self.postings["weight"] = examples[order], weights[order]
        del order, examples, weights
        self.entries = np.searchsorted(terms, np.arange(n_terms + 1, dtype=terms.dtype))
        # terms of many postings: where each block's begin, and the largest weight there
        sizes = np.diff(self.entries)
        blocked = np.flatnonzero(sizes > SHORT)
        self.long = np.full(n_terms, -1, np.int32)
        self.long[blocked] = np.arange(len(blocked))
        self.blocks = np.arange(0, len(keys), BLOCK)
        row = self.long[terms]
        at = np.flatnonzero(row >= 0)
        place = row[at].astype(np.int64) * self.n_blocks + self.examples[at] // BLOCK
        del terms, row
        counts = np.bincount(place, minlength=len(blocked) * self.n_blocks).reshape(len(blocked), self.n_blocks)
        self.starts = self.entries[blocked][:, None] + np.cumsum(np.pad(counts, ((0, 0), (1, 0))), axis=1)
        self.maxima = np.zeros((len(blocked), self.n_blocks), np.float32)
        new = np.flatnonzero(np.diff(place, prepend=-1))
        if len(new):
            self.maxima.flat[place[new]] = np.maximum.reduceat(self.weights[at], new)

    @property
    def examples(self) -> np.ndarray:
        """Of the postings."""
        return self.postings["example"]

    @property
    def weights(self) -> np.ndarray:
        """Of the postings."""
        return self.postings["weight"]

    @property
    def single(self) -> np.ndarray:
        """The matrix of the most frequent terms, which is kept in single precision alone."""
        return self.dense

    def frequent(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the most frequent terms add to each query's cosine with each example, in single precision."""
        made = np.zeros((len(queries), len(self.dense)), np.float32)
        for query, (terms, weights) in zip(made, queries):
            rows = self.rows[terms]
            query[rows[rows >= 0]] = weights[rows >= 0]
        return made @ self.dense

    def _exact(self, examples: np.ndarray) -> np.ndarray:
        """Cosines of the query with whole examples in double precision."""
        at, sizes = _ranges(self.spans[examples], self.spans[examples + 1])
        return np.bincount(np.repeat(np.arange(len(examples)), sizes), self.query[self.terms[at]] * self.whole[at], len(examples))

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1, frequent: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0, ties to the smaller key, and their cosines."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0)
        if frequent is None:
            frequent = self.frequent([(terms, weights)])[0]
        sums = self._sums(terms, weights, frequent, k, without)
        least = np.partition(sums, -k)[-k] - 2 * ERROR if len(sums) > k else 0.0
        found = np.flatnonzero((sums >= least) & (sums > 0))
        self.query[terms] = weights
        cosines = np.minimum(np.round(self._exact(found), 12), 1.0)
        self.query[terms] = 0
        best = np.lexsort((self.keys[found], -cosines))[:k]
        return found[best], cosines[best]

    def _sums(self, terms: np.ndarray, weights: np.ndarray, frequent: np.ndarray, k: int, without: int) -> np.ndarray:
        """Sums for all examples, whole ones in the blocks that can hold one of the k best."""
        sums, n, low = frequent, len(self.keys), weights.astype(np.float32)
        rows = self.long[terms]
        short = np.flatnonzero((rows < 0) & (self.rows[terms] < 0))
        at, sizes = _ranges(self.entries[terms[short]], self.entries[terms[short] + 1])
        if len(at):
            read = self.postings[at]
            sums = sums + np.bincount(read["example"], read["weight"] * np.repeat(low[short], sizes), n)
        if without >= 0:
            sums[without] = 0
        rows, low = rows[rows >= 0], low[rows >= 0]
        if len(rows):
            stripes = np.maximum.reduceat(sums, np.arange(0, n, STRIPE))
            floor = np.partition(stripes, -k)[-k] - ERROR if len(stripes) > k else 0.0
            bounds = np.maximum.reduceat(sums, self.blocks) + low @ self.maxima[rows]
            reached = np.flatnonzero(np.diff(np.r_[False, bounds >= floor, False]))
            spans = [self.starts[rows[:, None], reached[i::2]].ravel() for i in (0, 1)]
            weights, sizes = np.repeat(low, len(reached) // 2), spans[1] - spans[0]
            if len(sizes):
                whole = self.postings.view(np.int64)  # quicker to cut up than a structure
                read = np.concatenate([whole[a:b] for a, b in zip(spans[0].tolist(), spans[1].tolist())]).view(POSTING)
                sums = sums + np.bincount(read["example"], read["weight"] * np.repeat(weights, sizes), n)
            if without >= 0:
                sums[without] = 0
        return sums


class Model:
    """The index with what turns votes into scores; without an index the score is the share of toxic labels."""

    def __init__(self, share: float):
        self.share, self.made, self.frequencies, self.terms = share, None, None, Terms({})
        self.named, self.packed = {}, []

    def known_terms(self, leaning: dict[str, float], n_docs: int, indexed: pa.Table, frequent: tuple[list, list]) -> None:
        """Number the terms: those indexed first, then the frequent words that no example has."""
        self.terms, self.n_docs, self.n_terms = Terms(leaning), n_docs, indexed.num_rows
        self.named = {term: i for i, term in enumerate(indexed.column("term").to_pylist())}
        counts = indexed.column("c").to_pylist()
        for term, c in zip(*frequent):
            if term not in self.numbers:
                self.numbers[term] = len(self.numbers)
                counts.append(c)
        factors = np.array([leaning.get(term, 1.0) for term in self.numbers])
        self.idf = factors * np.log1p(n_docs / np.array(counts, np.float64))

    @property
    def numbers(self) -> dict[str, int]:
        """Of terms; they travel as one text, and only workers that read texts number them."""
        if isinstance(self.named, str):
            self.named = {term: i for i, term in enumerate(self.named.split("\n"))} if self.named else {}
        return self.named

    def counts(self, text: str) -> tuple[list[int], list[int]]:
        """Numbers of a text's terms, all of them known, and how often it holds them."""
        held = self.terms.of(text)
        return [self.numbers[term] for term in held], list(held.values())

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray, float, list[tuple[str, int]]]:
        """Indexed terms and their weights, the square of the vector's length so far, and the words not broadcast."""
        held = self.terms.of(text)
        numbers = np.array(list(map(self.numbers.get, held, repeat(-1))), np.int64)
        weights = 1 + np.log(np.array(list(held.values()), np.float64))
        rest = [(term, n) for (term, n), i in zip(held.items(), numbers.tolist()) if i < 0] if numbers.min(initial=0) < 0 else []
        numbers, weights = numbers[numbers >= 0], weights[numbers >= 0]
        weights = weights * self.idf[numbers]
        own = numbers < self.n_terms
        return numbers[own], weights[own], float(weights @ weights), rest

    def pack(self, *parts: np.ndarray) -> None:
        """Keep the examples' keys, labels, first terms, terms, and how often they hold them; only these travel to workers."""
        self.packed = [(zlib.compress(part.tobytes(), 1), part.dtype) for part in parts]

    def part(self, i: int) -> np.ndarray:
        """One of what ``pack`` keeps."""
        return np.frombuffer(zlib.decompress(self.packed[i][0]), self.packed[i][1])

    @property
    def index(self) -> BlockMaxIndex:
        """Made where it is first asked for, so not on the driver."""
        if self.made is None:
            spans, terms = self.part(2), self.part(3)
            weights = (1 + np.log(self.part(4))) * self.idf[terms]
            for a, b in zip(spans[:-1].tolist(), spans[1:].tolist()):
                weights[a:b] /= math.sqrt(weights[a:b] @ weights[a:b]) or 1.0
            self.made = BlockMaxIndex.laid_out(self.part(0), self.part(1), spans, terms, weights, self.n_terms)
        return self.made

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": None, "frequencies": None, "named": "\n".join(self.numbers)}

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None) -> list[tuple]:
        """For each vector the nearest examples, their cosines with these terms alone, and the square of the terms' length."""
        found = []
        for at in range(0, len(vectors), BATCH):
            squares = [float(weights @ weights) for _, weights in vectors[at : at + BATCH]]
            queries = [(t, w / (math.sqrt(square) or 1.0)) for (t, w), square in zip(vectors[at : at + BATCH], squares)]
            for i, (query, part) in enumerate(zip(queries, self.index.frequent(queries))):
                near = self.index.nearest(*query, NEIGHBOURS, without[at + i] if without else -1, part)
                found.append((*near, squares[i]))
        return found

    def vote(self, labels: np.ndarray, cosines: np.ndarray) -> float:
        power = cosines**2
        vote = (power @ labels + PRIOR_WEIGHT * self.share) / (power.sum() + PRIOR_WEIGHT)
        return math.log(max(vote, 1e-6) / max(1 - vote, 1e-6))

    def calibrate(self, labels: np.ndarray, votes: np.ndarray) -> None:
        """Logistic regression of label on vote."""
        n1 = int(labels.sum())
        n0 = len(labels) - n1
        weights = np.where(labels == 1, self.share / n1, (1 - self.share) / n0) * len(labels)
        goals = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        design = np.c_[votes, np.ones(len(votes))]
        fitted = np.array([1.0, 0.0])
        for _ in range(50):
            chances = 1 / (1 + np.exp(-np.clip(design @ fitted, -30, 30)))
            slope = design.T @ (weights * (chances - goals)) + 1e-3 * (fitted - [1.0, 0.0])
            curve = (design * (weights * chances * (1 - chances))[:, None]).T @ design + 1e-3 * np.eye(2)
            move = np.linalg.solve(curve, slope)
            fitted = fitted - np.clip(move, -1, 1)
            if np.abs(move).max() < 1e-9:
                break
        self.slope, self.offset = max(float(fitted[0]), 0.0), float(fitted[1])

    def judged(self, labels: np.ndarray, cosines: np.ndarray) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * self.vote(labels, cosines) + self.offset, -30), 30)))

    def score(self, text: str) -> tuple[float, list[int], list[float]]:
        """Score, doc_ids of the nearest examples, and their cosines; words not broadcast count as held by one document."""
        if not self.packed:
            return self.share, [], []
        terms, weights, square, rest = self.vector(text)
        square += sum(((1 + math.log(n)) * math.log1p(self.n_docs)) ** 2 for _, n in rest)
        examples, cosines, own = self.nearest([(terms, weights)])[0]
        cosines = np.minimum(np.round(cosines * math.sqrt(own / (square or 1.0)), 12), 1.0)
        return self.judged(self.index.labels[examples], cosines), self.index.keys[examples].tolist(), cosines.tolist()


def principal(spans: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Where each example lies in the direction in which the weights of the frequent terms, those numbered first, differ most."""
    squares = np.add.reduceat(np.append(weights**2, 0), spans[:-1]) * (np.diff(spans) > 0)
    examples, own = np.repeat(np.arange(len(spans) - 1, dtype=np.int32), np.diff(spans)), terms < DENSE
    held = np.zeros((len(spans) - 1, DENSE), np.float32)
    held[examples[own], terms[own]] = weights[own]
    held /= np.sqrt(np.maximum(squares, 1e-9))[:, None]
    held -= held.mean(0)
    return held @ np.linalg.eigh(held.T @ held)[1][:, -1]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labels given; the driver sees the sample's vectors and the frequent words."""
    sparkContext = docs.sparkSession.sparkContext
    examples = stage(sample(docs, labels, key, text, label).repartition(2 * sparkContext.defaultParallelism))
    known = labels.groupBy(key).agg(F.max(label).alias("_label")).filter("_label in (0, 1)")
    model = Model(float(known.agg(F.avg("_label")).first()[0] or 0.0))
    leaning = leaning_terms(examples)
    if leaning is None:
        return model
    model.frequencies = stage(document_frequencies(docs, leaning, text))
    words = document_frequencies(examples, leaning, "_text").select("term")
    indexed = model.frequencies.join(words, "term").toArrow().sort_by([("c", "descending")])
    model.known_terms(leaning, docs.count(), indexed, hottest(model.frequencies, "term", "c", "c"))
    shared = sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "_text"):
            made = [shared.value.counts(t) for t in texts]
            lists = [pa.array([v[i] for v in made], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_key", "_label", "_hash")), *lists], names=list("klhtn"))

    schema = "k long, l long, h long, t array<int>, n array<int>"
    plain = examples.select(F.col("_key").cast("long"), F.col("_label").cast("long"), "_hash", "_text")
    rows = plain.mapInArrow(run, schema).toArrow()
    shared.destroy()
    # like examples stand together, which keeps the blocks' maxima apart; the terms of small numbers are the frequent ones
    rows = rows.sort_by([("k", "ascending"), ("h", "ascending")]).combine_chunks()
    terms, times = (pa.concat_arrays(rows.column(c).chunks) for c in "tn")
    weights = (1 + np.log(times.values.to_numpy().astype(np.float32))) * model.idf.astype(np.float32)[terms.values.to_numpy()]
    order = np.argsort(principal(terms.offsets.to_numpy(), terms.values.to_numpy(), weights), kind="stable")
    del weights
    rows = rows.take(pa.array(order)).combine_chunks()
    terms, times = (pa.concat_arrays(rows.column(c).chunks) for c in "tn")
    spans = terms.offsets.to_numpy()
    keys, kinds, hashes = (rows.column(c).to_numpy() for c in "klh")
    model.pack(keys, kinds, spans, terms.values.to_numpy(), times.values.to_numpy())
    places = {h: i for i, h in enumerate(hashes.tolist())}
    fitted = sparkContext.broadcast(model)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each example's vote by all others."""
        own = fitted.value
        spans, terms, times, own_labels = own.part(2), own.part(3), own.part(4), own.part(1)
        for batch in batches:
            at = [places[h] for h in batch.column("_hash").to_pylist()]
            held = [slice(spans[i], spans[i + 1]) for i in at]
            near = own.nearest([(terms[h].astype(np.int64), (1 + np.log(times[h])) * own.idf[terms[h]]) for h in held], at)
            made = [own.vote(own_labels[found], cosines) for found, cosines, _ in near]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(made, pa.float64())], names=["i", "vote"])

    found = examples.select("_hash").mapInArrow(votes, "i long, vote double").toArrow()
    fitted.destroy()
    model.calibrate(kinds[found.column("i").to_numpy()], found.column("vote").to_numpy())
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """score, predicted, and as evidence the nearest examples' ids and cosines, in place of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ["score", "predicted", "neighbours", "cosines"]
    kept = [f for f in docs.schema.fields if f.name not in (text, *added)]
    if model.frequencies is None:
        nothing = [F.lit(model.share), F.lit(int(model.share >= 0.5)), F.array().cast("array<long>"), F.array().cast("array<double>")]
        return docs.select(*(f.name for f in kept), *(c.alias(name) for c, name in zip(nothing, added)))
    entry = T.StructType([T.StructField("item", T.StringType()), T.StructField("n", T.LongType())])
    searched = [
        T.StructField("__examples", T.ArrayType(T.IntegerType())), T.StructField("__found", T.ArrayType(T.DoubleType())),
        T.StructField("__own", T.DoubleType()), T.StructField("__square", T.DoubleType()),
        T.StructField("__key", T.LongType()), T.StructField("__rest", T.ArrayType(entry)),
    ]
    schema = T.StructType([*kept, *searched])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0
        for batch, texts in text_batches(batches, text):
            vectors = [shared.value.vector(t) for t in texts]
            found = shared.value.nearest([v[:2] for v in vectors])
            others = [pair for v in vectors for pair in v[3]]
            pairs = pa.StructArray.from_arrays(
                [pa.array([word for word, _ in others], pa.string()), pa.array([n for _, n in others], pa.int64())], names=["item", "n"]
            )
            rests = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(v[3]) for v in vectors)]), pa.int32()), pairs)
            made = [
                pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float64())),
                pa.array([f[2] for f in found], pa.float64()), pa.array([v[2] for v in vectors], pa.float64()),
                pa.array(row_keys(len(texts), first), pa.int64()), rests,
            ]
            first += len(texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *made], names=schema.names)

    rows = stage(docs.select(*(f.name for f in kept), text).mapInArrow(search, schema))
    idf = F.log1p(F.lit(float(model.n_docs)) / F.coalesce("c", F.lit(1)))
    whole = add_rest(rows, model.frequencies, "term", {"__square": F.pow((1 + F.log(F.col("n"))) * idf, F.lit(2.0))})
    types = [T.DoubleType(), T.IntegerType(), T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())]
    result = T.StructType([*kept, *map(T.StructField, added, types)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        keys, labels = fitted.part(0), fitted.part(1)
        for batch in batches:
            found, near, cosines = [], [], []
            read = zip(*(batch.column(c).to_pylist() for c in ("__examples", "__found", "__own", "__square")))
            for examples, values, part, square in read:
                at = np.array(examples, np.int64)
                values = np.minimum(np.round(np.array(values) * math.sqrt(part / (square or 1.0)), 12), 1.0)
                found.append(fitted.judged(labels[at], values))
                near.append(keys[at]), cosines.append(values)
            made = [
                pa.array(found, pa.float64()), pa.array([int(f >= 0.5) for f in found], pa.int32()),
                pa.array(near, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *made], names=result.names)

    return whole.mapInArrow(judge, result)
