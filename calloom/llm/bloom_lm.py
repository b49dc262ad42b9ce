"""LM scoring with a log-frequency Bloom filter of quantised n-gram counts.

Training counts words and word pairs on the executors and adds the counts up after a shuffle by hash. A count c becomes
level 1 + floor(log2 c); the filter holds (n-gram, j) for each j up to the level. A count is read back by probing
j = 1, 2, .. until one is missing: errors of the filter can only raise a count, by one level with the filter's small
error rate. All pairs are stored, those seen once as level 1. The probability of a word is mixed from its pair's and its own count:

    p(w | v) = MIX * min(1, c(v w) / c(v)) + (1 - MIX) * (c(w) + 1) / (C + V + 1)      (MIX = 0 where v is unknown)

with C the sum of the words' counts as they are read back. Texts begin and end with the same mark.

The filter is cut into segments by the hash of the n-gram. The task that adds up a segment's n-grams also sets its bits,
so counts pass one shuffle and no bit does. The number of segments follows the training tokens, which keeps a task's
share the same at any size. A segment has ``ENTRY_BITS`` bits at least for each of its entries, so the error rate is
the same at any size too, about one in a hundred at most. A filter of up to ``BROADCAST_BYTES`` is collected and
broadcast. A larger one stays in its segments: texts are gathered into parts of about ``PART_TOKENS`` tokens, the distinct
keys of each part go to the segments they probe, and their levels go back to the part. ``score()``, whose training texts are
among those it scores, always does that, and lets the keys carry what they count: the task that has built a segment answers
the parts at once, so pairs pass one shuffle for counting and probing together, at any size. Keys go sorted, as differences
without the bits that are always 0; ``KEY_BITS`` bits of a key stay below its segment, at any number of segments.

The base score needs exact counts: those of the most frequent words are a broadcast table of fixed size, all others are
joined by word and summed per document.

Defined cases: null and blank texts have one token, the end; with no training rows all counts are 0; repeated rows and
ids each give a row; a pair or word that fills a third of the corpus is counted within tasks before the shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from calloom.llm.common import add_rest, hottest, row_keys, text_batches
from calloom.session import stage

#: The mark of a text's end; no word holds a line feed.
END = "\n"
MIX = 0.5
PROBES = 3
#: Bits of a segment for each (n-gram, level) in it, rounded up to a power of two, and the fewest.
ENTRY_BITS, MIN_BITS = 12, 1 << 12
#: The largest filter that is collected and broadcast.
BROADCAST_BYTES = 1 << 25
#: Training tokens to a segment, about, and the most segments.
SEGMENT_TOKENS, MAX_SEGMENTS = 1 << 20, 1 << 20
#: Bits of a key that tell the n-grams of a segment apart: one not there meets one of its two million in 2 ** 15 cases.
KEY_BITS = 36
#: Tokens to a part of the texts that are scored by a join, about, and the part of keys that are only counted.
PART_TOKENS, NO_PART = 1 << 21, -1
#: Counts that a task gathers before it passes them on, and words that a worker keeps.
KEPT_PAIRS, KEPT_COUNTS, KEPT_WORDS = 2_000_000, 600_000, 400_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * _A + _mix(right + _C))


def word_keys(words: np.ndarray) -> np.ndarray:
    return _mix(words * _A)


def level_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(count)).astype(np.int64)


#: What a level stands for: the geometric middle of its counts; level 0 and 1 are exact.
LEVEL_COUNT = np.array([0.0, 1.0, *(2.0 ** (q - 0.5) for q in range(2, 65))])


class Filter:
    """The layout of the filter: a segment for the top bits of a key, ``PROBES`` bits in it for a key and level."""

    def __init__(self, segments: int):
        self.shift = np.uint64(64 - (segments.bit_length() - 1))
        self.unused = np.uint64(max(int(self.shift) - KEY_BITS, 0))
        self.segments = segments
        self.sizes = np.full(segments, 8, np.uint64)  # bits of each segment; one without n-grams has none set

    def segment(self, keys: np.ndarray) -> np.ndarray:
        if self.segments == 1:
            return np.zeros(len(keys), np.int64)
        return (keys >> self.shift).astype(np.int64)

    def kept(self, keys: np.ndarray) -> np.ndarray:
        """Keys by the bits that are kept of them."""
        return keys >> self.unused << self.unused

    @staticmethod
    def places(keys: np.ndarray, level: int, probe: int, size: np.ndarray | np.uint64) -> np.ndarray:
        """The bit's place within a segment of that size."""
        mixed = _mix(keys + np.uint64(level * int(_C) & (1 << 64) - 1))
        step = (mixed >> np.uint64(32)) | np.uint64(1)
        return ((mixed + np.uint64(probe) * step) & (size - np.uint64(1))).astype(np.int64)

    def levels(self, bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The level of each key. ``bits``: the filter as bytes."""
        keys = self.kept(keys)
        own = self.segment(keys)
        return read_levels(bits, keys, self.sizes[own], (np.cumsum(self.sizes) - self.sizes).astype(np.int64)[own])


def read_levels(bits: np.ndarray, keys: np.ndarray, sizes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The level of each key, by probing its segment, of that size and offset in bits, until a level is missing."""
    found = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    for level in range(1, len(LEVEL_COUNT)):
        for probe in range(PROBES):
            place = offsets[alive] + Filter.places(keys[alive], level, probe, sizes[alive])
            alive = alive[(bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
        if not len(alive):
            break
        found[alive] = level
    return found


class _Index(dict):
    """Numbers words as they come and keeps their hashes."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


END_HASH = np.uint64(xxhash.xxh64_intdigest(END))


def split(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case; bytes know only ASCII white space and case."""
    return text.encode().lower().split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all texts, the end mark among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            names = pa.array([word.decode() for word in counts], pa.string())
            batch = pa.RecordBatch.from_arrays([names, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for _, texts in text_batches(batches, text):
            counts[END.encode()] += len(texts)
            for t in texts:
                counts.update(split(t))
                if len(counts) >= KEPT_COUNTS:
                    yield passed_on()
        yield passed_on()

    return docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, the lowest bytes of all first, each compressed; high bytes that are all 0 are left out."""
    values = np.ascontiguousarray(values, np.uint64)
    width = -(-int(values.max(initial=0)).bit_length() // 8)
    planes = [np.ascontiguousarray(plane) for plane in values.view(np.uint8).reshape(-1, 8).T[:width]]
    packed = [pa.compress(plane, codec="zstd", asbytes=True) for plane in planes]
    return np.array([len(values), width, *map(len, packed)], np.uint32).tobytes() + b"".join(packed)


def unsqueezed(packed: bytes) -> np.ndarray:
    n, width = np.frombuffer(packed, np.uint32, 2).tolist()
    values, at = np.zeros((n, 8), np.uint8), 4 * (2 + width)
    for i, size in enumerate(np.frombuffer(packed, np.uint32, width, 8).tolist()):
        values[:, i] = np.frombuffer(pa.decompress(packed[at : at + size], n, codec="zstd"), np.uint8)
        at += size
    return values.view(np.uint64).ravel()


def _groups(keys: np.ndarray) -> np.ndarray:
    """Where each new key starts in sorted keys."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _rows(keys: np.ndarray, counts: np.ndarray | None, part: int, layout: Filter) -> Iterator[pa.RecordBatch]:
    """Sorted keys as kept, with their counts, if any, and the part that asks for them: a row for each segment."""
    starts = _groups(layout.segment(keys))
    ends = [*starts[1:].tolist(), len(keys)]
    for at in range(0, len(starts), 256):
        spans = list(zip(starts[at : at + 256].tolist(), ends[at : at + 256]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(layout.segment(keys[starts[at : at + 256]]), pa.int64()), pa.array([part] * len(spans), pa.int64()),
                pa.array([squeezed(np.diff(keys[s:e] >> layout.unused, prepend=np.uint64(0))) for s, e in spans], pa.binary()),
                pa.array([None if counts is None else squeezed(counts[s:e]) for s, e in spans], pa.binary()),
            ],
            names=["segment", "part", "keys", "counts"],
        )


ROWS = "segment long, part long, keys binary, counts binary"


def _keys(row: bytes, layout: Filter) -> np.ndarray:
    return np.cumsum(unsqueezed(row), dtype=np.uint64) << layout.unused


def _pairs(docs: DataFrame, text: str, layout: Filter) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, gathered, size = _Index(), [], 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            yield from _rows(*np.unique(layout.kept(np.concatenate(gathered)), return_counts=True), NO_PART, layout)

        for _, texts in text_batches(batches, text):
            if len(index) > KEPT_WORDS:
                index = _Index()
            numbered = [np.fromiter(map(index.__getitem__, words), np.int64, len(words)) for words in map(split, texts)]
            hashes = np.array(index.hashes, np.uint64)
            for numbers in numbered:
                sequence = np.concatenate([[END_HASH], hashes[numbers], [END_HASH]]).astype(np.uint64)
                gathered.append(pair_keys(sequence[:-1], sequence[1:]))
                size += len(numbers) + 1
            if size >= KEPT_PAIRS:
                yield from passed_on()
                gathered, size = [], 0
        if gathered:
            yield from passed_on()

    return docs.select(text).mapInArrow(run, ROWS)


def _words(vocabulary: DataFrame, layout: Filter) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in batch.column("word").to_pylist()], np.uint64)
            keys, counts = layout.kept(word_keys(hashes)), batch.column("c").to_numpy()
            order = np.argsort(keys)
            yield from _rows(keys[order], counts[order], NO_PART, layout)

    return vocabulary.mapInArrow(run, ROWS)


def _bits(group: pd.DataFrame, layout: Filter) -> np.ndarray:
    """One segment of the filter as bytes, from all counts of its n-grams."""
    group = group[group["counts"].notna()]
    keys = np.concatenate([np.zeros(0, np.uint64), *(_keys(row, layout) for row in group["keys"])])
    counts = np.concatenate([np.zeros(0, np.uint64), *map(unsqueezed, group["counts"])]).astype(np.int64)
    keys, counts = keys[counts > 0], counts[counts > 0]
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = _groups(keys)
    keys, levels = keys[starts], level_of(np.add.reduceat(counts, starts)) if len(starts) else counts
    size = np.uint64(max(_power_of_two(ENTRY_BITS * int(levels.sum())), MIN_BITS))
    bits = np.zeros(int(size), np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for probe in range(PROBES):
            bits[Filter.places(keys, level, probe, size)] = 1
    return np.packbits(bits, bitorder="little")


def _answers(asked: pd.DataFrame, bits: np.ndarray, layout: Filter) -> pd.DataFrame:
    """The levels of the keys that each part asks one segment for."""
    found = []
    for row in asked["keys"]:
        keys = _keys(row, layout)
        sizes = np.full(len(keys), 8 * len(bits), np.uint64)
        found.append(squeezed(read_levels(bits, keys, sizes, np.zeros(len(keys), np.int64))))
    return pd.DataFrame({"part": asked["part"], "segment": asked["segment"], "levels": found})


LEVELS = "part long, segment long, levels binary"


def _pack(tokens: np.ndarray, hashes: np.ndarray) -> tuple[bytes, bytes]:
    """Tokens by numbers of their own, small ones for frequent words, and the words' hashes."""
    times = np.bincount(tokens, minlength=len(hashes))
    order = np.flatnonzero(times)
    order = order[np.argsort(-times[order], kind="stable")]
    rank = np.empty(len(hashes), np.int64)
    rank[order] = np.arange(len(order))
    return squeezed(rank[tokens]), hashes[order].tobytes()


class _Part:
    """A part as ``_pack`` leaves it: its words' hashes, its tokens by their numbers, the pairs' first words likewise."""

    def __init__(self, words: bytes, names: bytes, layout: Filter):
        self.names, self.tokens = np.frombuffer(names, np.uint64), unsqueezed(words).astype(np.int64)
        end = int(np.flatnonzero(self.names == END_HASH)[0])
        self.ends = np.flatnonzero(self.tokens == end)
        self.before = np.r_[end, self.tokens[:-1]]
        pairs = pair_keys(self.names[self.before], self.names[self.tokens])
        #: of its tokens' pairs, then of its words
        self.keys = layout.kept(np.concatenate([pairs, word_keys(self.names)]))


def _chance(pairs: np.ndarray, before: np.ndarray, own: np.ndarray, total: float) -> np.ndarray:
    """p(w | v) from the counts of v w, v and w."""
    mix = np.where(before > 0, MIX, 0.0)
    return mix * np.minimum(1, pairs / np.maximum(before, 1)) + (1 - mix) * (own + 1) / total


def _power_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(x, 1)))))


class Model:
    """What scoring needs: exact word counts as a table, totals, and the filter with its layout.

    With ``whole``, no filter is made here: that is left to ``score()``, which then needs to know the training texts.
    """

    def __init__(self, docs: DataFrame, text: str = "text", whole: bool = False):
        self.vocabulary = stage(word_counts(docs, text))
        read_back = F.when(F.col("c") > 1, F.pow(F.lit(2.0), F.floor(F.log2("c")) + 0.5)).otherwise(F.lit(1.0))
        totals = self.vocabulary.agg(F.sum("c"), F.count("*"), F.sum(read_back)).first()
        self.tokens, self.distinct, self.read_back = totals[0] or 0, totals[1], totals[2] or 0.0
        if not docs.take(1):  # the end mark of no text
            self.tokens = self.distinct = 0
        self.layout = Filter(min(_power_of_two(self.tokens / SEGMENT_TOKENS), MAX_SEGMENTS))
        self.bits = self.segments = None
        if whole:
            return
        layout = self.layout

        def made(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"segment": [int(group["segment"].iloc[0])], "bits": [_bits(group, layout).tobytes()]})

        rows = _pairs(docs, text, layout).union(_words(self.vocabulary.filter("c > 0"), layout))
        self.segments = stage(rows.groupBy("segment").applyInPandas(made, "segment long, bits binary"))
        if (self.segments.agg(F.sum(F.octet_length("bits").cast("long"))).first()[0] or 0) <= BROADCAST_BYTES:
            found = {row.segment: np.frombuffer(row.bits, np.uint8) for row in self.segments.toPandas().itertuples()}
            for segment, own in found.items():
                self.layout.sizes[segment] = 8 * len(own)
            empty = np.zeros(1, np.uint8)
            self.bits = np.concatenate([found.get(segment, empty) for segment in range(self.layout.segments)])

    def chances(self, parts: DataFrame) -> DataFrame:
        """(__key, __score) of texts in parts, the filter left in its segments or made of those texts that are flagged."""
        layout, read_total, made_here = self.layout, self.read_back + self.distinct + 1, self.segments is None

        def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The keys of a part by segment."""
            for batch in batches:
                for number, words, names, flags in zip(*(column.to_pylist() for column in batch.columns)):
                    part = _Part(words, names, layout)
                    if not made_here:
                        keys = np.sort(part.keys)
                        yield from _rows(keys[_groups(keys)], None, number, layout)
                        continue
                    counted = np.zeros(len(part.keys), np.int64)  # words are counted in the vocabulary
                    counted[: len(part.tokens)] = np.repeat(np.frombuffer(flags, np.uint8), np.diff(part.ends, prepend=-1))
                    order = np.argsort(part.keys)
                    keys, counted = part.keys[order], counted[order]
                    starts = _groups(keys)
                    yield from _rows(keys[starts], np.add.reduceat(counted, starts), number, layout)

        def built(group: pd.DataFrame) -> pd.DataFrame:
            return _answers(group[group["part"] != NO_PART], _bits(group, layout), layout)

        def read(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            return _answers(asked, np.frombuffer(held["bits"].iloc[0], np.uint8) if len(held) else np.zeros(1, np.uint8), layout)

        def mixed(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            row = texts.iloc[0]
            part = _Part(row["__words"], row["__names"], layout)
            # segments are the keys' top bits, so in their order the levels are those of the sorted keys
            found = np.concatenate([unsqueezed(v).astype(np.uint8) for v in found.sort_values("segment")["levels"]])
            order = np.argsort(part.keys)
            levels = np.empty(len(order), np.uint8)
            levels[order] = np.repeat(found, np.diff(_groups(part.keys[order]), append=len(order)))
            n = len(part.tokens)
            own = LEVEL_COUNT[levels[n:]]
            logs = np.log10(_chance(LEVEL_COUNT[levels[:n]], own[part.before], own[part.tokens], read_total))
            scores = np.add.reduceat(logs, np.r_[0, part.ends[:-1] + 1])
            return pd.DataFrame({"__key": row["__part"] + np.arange(len(scores)), "__score": scores})

        asked = parts.select("__part", "__words", "__names", "__flags").mapInArrow(probes, ROWS)
        if made_here:
            asked = asked.union(_words(self.vocabulary.filter("c > 0"), layout))
            levels = asked.groupBy("segment").applyInPandas(built, LEVELS)
        else:
            levels = asked.groupBy("segment").cogroup(self.segments.groupBy("segment")).applyInPandas(read, LEVELS)
        texts = parts.select("__part", "__words", "__names").groupBy("__part")
        return texts.cogroup(levels.groupBy("part")).applyInPandas(mixed, "__key long, __score double")

    def score(self, docs: DataFrame, text: str = "text", training: Column | None = None) -> DataFrame:
        """n_tokens, n_known, train_tokens, base_score and score in place of the text.

        ``training`` tells the model's own texts, where it has been made without a filter.
        """
        sparkContext = docs.sparkSession.sparkContext
        hot = sparkContext.broadcast(dict(zip(*hottest(self.vocabulary.filter("c > 0"), "word", "c", "c"))))
        joined = self.bits is None
        bits, layout = sparkContext.broadcast(self.bits), self.layout
        train_tokens = np.int64(self.tokens)
        exact_total, read_total = self.tokens + self.distinct + 1, self.read_back + self.distinct + 1
        added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
        kept = [f for f in docs.schema.fields if f.name not in (text, *added)]
        entry = T.StructType([T.StructField("item", T.StringType()), T.StructField("n", T.LongType())])
        types = [T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.LongType(), T.ArrayType(entry)]
        schema = T.StructType([*kept, *map(T.StructField, [*added, "__key", "__rest"], types)])
        packed = ["__words", "__names", "__flags"]
        if joined:
            schema = T.StructType([*schema, T.StructField("__part", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in packed)])
        flag = F.lit(False) if training is None else F.coalesce(training, F.lit(False))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {word.encode(): c for word, c in hot.value.items()}
            index, first = _Index(), 0
            counts, logs, read = np.zeros(0), np.zeros(0), np.zeros(0)
            held, gathered, flags, begun = None, [], [], 0

            def ended(*of: bytes | None) -> pa.RecordBatch:
                """The batch held back, its last row with the part that ends there, if one does."""
                blank = [None] * (len(held[0]) - 1)
                last = [pa.array([*blank, row_keys(1, begun)[0] if of else None], pa.int64())]
                last += [pa.array([*blank, value], pa.binary()) for value in of or [None] * len(packed)]
                return pa.RecordBatch.from_arrays([*held, *last], names=schema.names)

            for batch, texts in text_batches(batches, text):
                if not texts:
                    continue
                if len(index) > KEPT_WORDS:
                    index = _Index()
                    counts, logs, read = np.zeros(0), np.zeros(0), np.zeros(0)
                end = index[END.encode()]
                numbered = [np.fromiter(map(index.__getitem__, words), np.int64, len(words)) for words in map(split, texts)]
                hashes = np.array(index.hashes, np.uint64)
                if len(counts) < len(hashes):  # words not met before
                    names = list(index)
                    new = np.array([known.get(w, -1) for w in names[len(counts) :]], np.float64)
                    counts = np.r_[counts, new]
                    logs = np.r_[logs, np.where(new >= 0, np.log10(np.maximum(new, 0) + 1) - np.log10(exact_total), 0.0)]
                    if not joined:
                        read = np.r_[read, LEVEL_COUNT[layout.levels(bits.value, word_keys(hashes[len(read) :]))]]
                sizes = np.array([len(numbers) + 1 for numbers in numbered], np.int64)
                mark = np.array([end])
                tokens = np.concatenate([part for numbers in numbered for part in (numbers, mark)])
                before = np.concatenate([part for numbers in numbered for part in (mark, numbers)])
                if joined:
                    chance = np.ones(len(tokens))  # its logarithm is added after the join
                else:
                    pairs = LEVEL_COUNT[layout.levels(bits.value, pair_keys(hashes[before], hashes[tokens]))]
                    chance = _chance(pairs, read[before], read[tokens], read_total)
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                names, rare = list(index), counts[tokens] < 0
                owner = np.repeat(np.arange(len(sizes)), sizes)[rare]
                rare, times = np.unique(owner * len(names) + tokens[rare], return_counts=True)
                ends = np.searchsorted(rare, np.arange(len(sizes) + 1) * len(names))
                items = pa.array([names[i].decode() for i in (rare % len(names)).tolist()], pa.string())
                entries = pa.StructArray.from_arrays([items, pa.array(times, pa.int64())], names=["item", "n"])
                made = [
                    pa.array(sizes), pa.array(np.add.reduceat((counts[tokens] > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(texts), train_tokens)), pa.array(np.add.reduceat(logs[tokens], starts)),
                    pa.array(np.add.reduceat(np.log10(chance), starts)), pa.array(row_keys(len(texts), first), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ]
                first += len(texts)
                made = [*(batch.column(f.name) for f in kept), *made]
                if not joined:
                    yield pa.RecordBatch.from_arrays(made, names=schema.names)
                    continue
                if held is not None:
                    yield ended()
                held = made
                gathered.append(tokens.astype(np.int32))
                flags.append(batch.column("__training").to_numpy(zero_copy_only=False).astype(np.uint8))
                if sum(map(len, gathered)) >= PART_TOKENS or len(index) > KEPT_WORDS:
                    yield ended(*_pack(np.concatenate(gathered), hashes), np.concatenate(flags).tobytes())
                    held, gathered, flags, begun = None, [], [], first
            if held is not None:
                yield ended(*_pack(np.concatenate(gathered), np.array(index.hashes, np.uint64)), np.concatenate(flags).tobytes())

        rows = stage(docs.select(*(f.name for f in kept), text, flag.alias("__training")).mapInArrow(run, schema))
        count = F.coalesce("c", F.lit(0))
        sums = {
            "n_known": F.when(count > 0, F.col("n")).otherwise(F.lit(0)),
            "base_score": F.col("n") * (F.log10(count + 1.0) - F.log10(F.lit(float(exact_total)))),
        }
        if not joined:
            return add_rest(rows, self.vocabulary, "word", sums)
        scores = stage(self.chances(rows.filter("__words is not null").select("__part", *packed)))
        # the base score first: its rare words are not shuffled by row
        found = add_rest(rows.drop("__part", *packed).withColumn("__row", F.col("__key")), self.vocabulary, "word", sums)
        found = found.join(scores.withColumnRenamed("__key", "__row"), "__row").withColumn("score", F.col("__score"))
        return found.drop("__row", "__score")


def score(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """Scores of all documents by a model of those for which ``training`` holds."""
    return Model(docs.filter(training), text, whole=True).score(docs, text, training)
