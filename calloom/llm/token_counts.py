"""Token counts of a byte-level BPE without ids: pieces are counted once per distinct pre-token.

1. Executors split texts into pre-tokens and count them; Spark adds the counts up.
2. Each distinct pre-token's pieces are counted once, wherever its row is.
3. Documents are split again into pre-token frequencies. The ``HOT`` most frequent pre-tokens are a broadcast table of
   fixed size; frequencies of all others are joined to the table of step 2 and summed per document.

Frequent pre-tokens never pass the join, so it has no hot key; what is broadcast does not grow with the data.

Defined cases: null and empty texts have 0 bytes and 0 tokens; special tokens inside a text count one each; repeated rows
and ids each give a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from calloom.llm.bpe_automaton import WHITE_SPACE, _read, byte_symbols
from calloom.llm.common import add_rest, hottest, row_keys, text_batches
from calloom.session import stage

#: How the vocabulary splits text.
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
#: Distinct pre-tokens that a task counts before it passes them on.
KEPT = 300_000


def _splitter(source: str):
    """A function from a text to its pre-tokens and the number of special tokens in it."""
    special = [t.content for t in Tokenizer.from_str(source).get_added_tokens_decoder().values()]
    found = regex.compile("|".join(map(regex.escape, special))) if special else None

    def split(text: str) -> tuple[list[str], int]:
        if found is None or "<" not in text:
            return PATTERN.findall(text), 0
        parts = found.split(text)
        return [piece for part in parts for piece in PATTERN.findall(part)], len(parts) - 1

    return split


def pretoken_totals(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(piece, total) over all texts."""
    source = docs.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = _splitter(source.value), Counter()
        for _, texts in text_batches(batches, text):
            for t in texts:
                counts.update(split(t)[0])
                if len(counts) >= KEPT:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    partial = docs.select(text).mapInArrow(run, "piece string, n long")
    return partial.groupBy("piece").agg(F.sum("n").alias("total"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["piece", "n"]
    )


def count_pieces(pretokens: DataFrame, path: str) -> DataFrame:
    """Adds n_pieces, the pieces of each distinct pre-token."""
    source = pretokens.sparkSession.sparkContext.broadcast(_read(path))
    schema = T.StructType([*pretokens.schema.fields, T.StructField("n_pieces", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, symbols = Tokenizer.from_str(source.value).model, byte_symbols()
        for batch, texts in text_batches(batches, "piece"):
            pieces = [len(model.tokenize("".join([symbols[b] for b in t.encode()]))) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], names=schema.names)

    return pretokens.mapInArrow(run, schema)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """n_bytes, n_tokens and over_limit in place of the text."""
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    pieces = stage(count_pieces(pretoken_totals(docs, path, text), path))
    sparkContext = docs.sparkSession.sparkContext
    hot = sparkContext.broadcast(dict(zip(*hottest(pieces, "piece", "total", "n_pieces"))))
    source = sparkContext.broadcast(_read(path))
    kept = [f for f in docs.schema.fields if f.name != text]
    entry = T.StructType([T.StructField("item", T.StringType()), T.StructField("n", T.LongType())])
    schema = T.StructType([
        *kept, T.StructField("__key", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("__rest", T.ArrayType(entry)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known, first = _splitter(source.value), hot.value, 0
        for batch, texts in text_batches(batches, text):
            totals, items, times, ends = [], [], [], [0]
            for t in texts:
                found, total = split(t)
                for piece, n in Counter(found).items():
                    count = known.get(piece)
                    if count is None:
                        items.append(piece), times.append(n)
                    else:
                        total += n * count
                totals.append(total), ends.append(len(items))
            entries = pa.StructArray.from_arrays([pa.array(items, pa.string()), pa.array(times, pa.int64())], names=["item", "n"])
            rest = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), entries)
            added = [
                pa.array(row_keys(len(texts), first), pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(totals, pa.int64()), rest,
            ]
            first += len(texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *added], names=schema.names)

    rows = stage(docs.select(*(f.name for f in kept), text).mapInArrow(run, schema))
    counted = add_rest(rows, pieces.select("piece", "n_pieces"), "piece", {"n_tokens": F.col("n") * F.col("n_pieces")})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
