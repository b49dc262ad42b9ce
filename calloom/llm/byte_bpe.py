"""Byte-level BPE by Spark's higher-order functions: ranked merges are folded over the bytes of distinct words.

1. Executors split texts into words by the vocabulary's pattern and count them; Spark adds the counts up.
2. The ``FREQUENT`` most frequent words are encoded once each, by the fold; their ids are broadcast, a table of fixed size.
3. Documents are split again. Frequent words take their ids from that table; a document's other distinct words go through
   the same fold where the document is, so nothing of a document is shuffled and no word is a hot key. Their ids are put
   between the runs of ids around them.

The fold (``encoded``) is plain column code. A word is its bytes, each written as the Latin-1 character of its value and
set between two marks. A round looks up the ranks of all neighbouring pairs in a literal map, takes the least, and merges
all pairs of that rank from left to right; a word of n bytes takes at most n - 1 rounds. Where every entry of a vocabulary is
reached by its own merges, as in one that was trained, a merge never makes a pair of lesser rank, and this is the same as
merging one pair at a time. The literal is an array of small maps by the checksum of the pair, as a look-up in one map of
50,000 entries would read it from the start.

Decoding concatenates the bytes of the ids from a literal array, in Latin-1 until the end.

Defined cases: null and empty texts have no ids and decode to no bytes; special tokens are plain text; repeated rows and
ids each give a row; null ids decode to no bytes, unknown ones to a null; other columns stay, but for one named like a result.
Long words take rounds by the number of different pairs they merge, each in proportion to what is left of the word.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from calloom.llm.bpe_automaton import WHITE_SPACE, _read
from calloom.llm.common import fresh, hot_rows, text_batches
from calloom.session import stage

#: Words whose ids are broadcast, at most; and words that a task counts before it passes them on.
FREQUENT, KEPT = 1 << 19, 300_000
#: Maps in the literal of ranks: few, as every task reads the literal anew, and each with a dozen pieces to look through.
SLOTS = 1 << 12
#: Marks before and after a piece: not Latin-1, so in no word.
OPEN, CLOSE = "Ā", "ā"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are their ids."""
    return {base64.b64decode(token): int(rank) for token, rank in map(str.split, _read(path).splitlines())}


def word_pattern(pattern: str) -> str:
    """A splitting pattern with white space spelled out, so that every regex library reads it alike."""
    return pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"(?!\S)", f"(?![^{WHITE_SPACE}])").replace(r"\s", f"[{WHITE_SPACE}]")


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The literal: arrays of maps from a piece, in Latin-1, to its rank, at the place of the piece's checksum."""
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for token, rank in ranks.items():
        piece = token.decode("latin-1")
        slots[zlib.crc32(piece.encode()) % SLOTS][piece] = rank
    return F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<map<string,int>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def latin(word: Column) -> Column:
    """The UTF-8 bytes of a text as Latin-1 characters."""
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


def encoded(words: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of each word of an array; words are bytes in Latin-1."""

    def of(table: Column) -> Column:
        def rank(piece: Column) -> Column:
            return F.try_element_at(F.get(table, (F.crc32(piece) % SLOTS).cast("int")), piece)

        def pieces(marked: Column) -> Column:
            # at a single character, which needs no regular expression
            return F.split(F.replace(F.substring(marked, F.lit(1), F.length(marked) - 1), F.lit(OPEN), F.lit("")), CLOSE)

        def merge(marked: Column, parts: Column, found: Column) -> Column:
            def joined(at: Column) -> Column:
                left, right = F.get(parts, at - 1), F.get(parts, at)
                pair = F.concat(F.lit(OPEN), left, F.lit(CLOSE + OPEN), right, F.lit(CLOSE))
                whole = F.replace(marked, pair, F.concat(F.lit(OPEN), left, right, F.lit(CLOSE)))
                return F.struct(whole.alias("marked"), F.lit(True).alias("going"))

            least = F.array_min(found)
            return F.when(least.isNull(), F.struct(marked.alias("marked"), F.lit(False).alias("going"))).otherwise(
                _let(F.array_position(found, least).cast("int"), joined)
            )

        def step(state: Column, _: Column) -> Column:
            following = _let(
                pieces(state.marked),
                lambda p: _let(
                    F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: rank(F.concat(a, b))),
                    lambda found: merge(state.marked, p, found),
                ),
            )
            return F.when(state.going, following).otherwise(state)

        def fold(word: Column) -> Column:
            marked = F.concat(F.lit(OPEN), F.array_join(F.split(word, ""), CLOSE + OPEN), F.lit(CLOSE))
            start = F.struct(marked.alias("marked"), F.lit(True).alias("going"))
            rounds = F.sequence(F.lit(1), F.length(word))
            return F.aggregate(rounds, start, step, lambda end: F.transform(pieces(end.marked), rank))

        return F.transform(words, lambda word: _let(word, fold))

    return _let(rank_map(ranks), of)


def word_totals(docs: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """(piece, total) of the words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = regex.compile(pattern).findall, Counter()

        def counted() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["piece", "n"])

        for _, texts in text_batches(batches, text):
            for t in texts:
                counts.update(split(t))
                if len(counts) >= KEPT:
                    yield counted()
                    counts.clear()
        yield counted()

    return docs.select(text).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("total"))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``ids``, an array of int, to documents."""
    docs = docs.drop("ids")
    pattern, ranks = word_pattern(pattern), read_ranks(path)
    totals = stage(word_totals(docs, pattern, text))
    code = F.array_join(encoded(F.array(latin(F.col("piece"))), ranks)[0], " ").alias("codes")
    # as Arrow columns: no object for each word on the driver
    frequent = hot_rows(totals, "piece", "total", FREQUENT).select("piece", code).toArrow().combine_chunks()
    known = docs.sparkSession.sparkContext.broadcast((frequent.column(0), frequent.column(1)))
    runs, places, rest = fresh(docs, "runs"), fresh(docs, "places"), fresh(docs, "rest")
    schema = T.StructType([
        *docs.schema.fields, T.StructField(runs, T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField(places, T.ArrayType(T.IntegerType())), T.StructField(rest, T.ArrayType(T.StringType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, (words, codes) = regex.compile(pattern).findall, (column.to_pylist() for column in known.value)
        number = dict(zip(words, range(len(words))))
        sizes = np.array([c.count(" ") + 1 for c in codes], np.int64)
        starts, flat = np.cumsum(sizes) - sizes, np.array(" ".join(codes).split(), np.int32)
        for batch, texts in text_batches(batches, text):
            parts, ends, doc_ends, own_places, place_ends, others, other_ends = [], [np.zeros(1, np.int64)], [0], [], [0], [], [0]
            size = 0
            for t in texts:
                found, own = split(t), {}
                # a frequent word by its number, another as -1, -2, .. in the order of the document
                at = np.array(list(map(number.get, found, repeat(-1))), np.int64)
                others_at = np.flatnonzero(at < 0)
                at[others_at] = [-1 - own.setdefault(found[i], len(own)) for i in others_at.tolist()]
                ids, breaks = _spread(at, starts, sizes, flat)
                parts.append(ids)
                ends.append(size + np.append(breaks, len(ids)))
                own_places.append(-1 - at[at < 0])
                size += len(ids)
                doc_ends.append(doc_ends[-1] + len(breaks) + 1)
                place_ends.append(place_ends[-1] + len(breaks))
                others += [w.encode().decode("latin-1") for w in own]
                other_ends.append(len(others))
            ids = pa.array(np.concatenate([np.zeros(0, np.int32), *parts]), pa.int32())
            between = pa.array(np.concatenate([np.zeros(0, np.int64), *own_places]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, _lists(doc_ends, _lists(np.concatenate(ends), ids)), _lists(place_ends, between),
                    _lists(other_ends, pa.array(others, pa.string())),
                ],
                names=schema.names,
            )

    rows = docs.mapInArrow(run, schema)
    done = _let(
        encoded(F.col(rest), ranks),
        lambda own: F.flatten(
            F.zip_with(runs, places, lambda run, place: F.when(place.isNull(), run).otherwise(F.concat(run, F.get(own, place))))
        ),
    )
    return rows.withColumn("ids", done).drop(runs, places, rest)


def _lists(ends: list[int] | np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _spread(at: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words by number, one after another, and where among them each negative number stands."""
    own, words = np.flatnonzero(at < 0), at[at >= 0]
    n = sizes[words]
    ends = np.cumsum(n)
    ids = flat[np.arange(n.sum()) + np.repeat(starts[words] - ends + n, n)]
    return ids, np.append(0, ends)[own - np.arange(len(own))]


def decode(coded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for."""
    ranks = read_ranks(path)
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    table = F.from_json(F.lit(json.dumps(pieces, separators=(",", ":"))), "array<string>")
    # what is no id becomes a mark that no piece has
    text = _let(table, lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "", OPEN))
    known = _let(text, lambda whole: F.when(~F.contains(whole, F.lit(OPEN)), F.encode(whole, "ISO-8859-1")))
    return coded.withColumn("decoded", F.when(F.col(ids).isNull(), F.lit(b"")).otherwise(known))
