"""SimHash near-duplicates: 64-bit fingerprints, linked where few bits differ, and the groups that links make.

Fingerprints of 4-word shingles are made in Arrow batches, one scan, no shuffle. From then on only distinct
fingerprints matter, so thousands of exact copies are one. To link two fingerprints that differ in at most ``d`` bits,
the 64 bits are cut into d + 2 blocks: at least two blocks are equal, so the two meet under one of the
(d + 2)(d + 1)/2 keys made of two blocks. Within a key the distance is verified.

Groups of near copies meet under the same keys, where listing all pairs would grow with the square. So keys with more
than ``SMALL`` fingerprints give links that span what is connected, not each pair: such a key is cut into blocks of
``CHUNK`` fingerprints, each pair of blocks is its own task group, and the work in it is a search that visits each
fingerprint once. No link between different components is lost, and no group has to fit in one task.

Defined cases: texts null or blank have fingerprint zero and are linked like any other; texts of one to three words
have one shingle, the words; repeated rows and ids each give a row; a null doc_id is no component's smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from calloom.llm.common import text_batches
from calloom.llm.components import components
from calloom.session import stage

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
#: Fingerprints under a key whose pairs are verified one by one.
SMALL = 32
#: Fingerprints of one key in a block.
CHUNK = 2048


def fingerprint(text: str) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    words = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    width = min(SHINGLE, len(words))
    spans = zip(begins[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, (joined[b:e] for b, e in spans), repeat(SEED)), np.uint64, len(words) - width + 1
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint of each whole text, in place of the text."""
    kept = [f for f in docs.schema.fields if f.name not in (text, out)]
    schema = T.StructType([*kept, T.StructField(out, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, text):
            values = pa.array([fingerprint(t) for t in texts], pa.int64())
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, values], names=schema.names)

    return docs.select(*(f.name for f in kept), text).mapInArrow(run, schema)


def _keys(max_distance: int) -> list:
    """Expressions of ``fp``: one 64-bit key for each pair of blocks, with the pair's number on top."""
    blocks = max_distance + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(edges, edges[1:])
    ]
    width = max(high - low for low, high in zip(edges, edges[1:]))
    return [
        (F.lit(k << 2 * width) + F.shiftleft(parts[i], width) + parts[j]).alias("key")
        for k, (i, j) in enumerate(combinations(range(blocks), 2))
    ]


def _spanning(max_distance: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Links that connect all that is connected within the group; each fingerprint is visited once."""
        fps = np.unique(group["fp"].to_numpy()).view(np.uint64)
        unseen, found = np.ones(len(fps), bool), []
        for first in range(len(fps)):
            if unseen[first]:
                unseen[first] = False
                queue = [first]
                while queue:
                    at = queue.pop()
                    left = np.flatnonzero(unseen)
                    near = left[np.bitwise_count(fps[left] ^ fps[at]) <= max_distance]
                    unseen[near] = False
                    queue += near.tolist()
                    found += [(at, other) for other in near.tolist()]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[pairs[:, 0]], "b": signed[pairs[:, 1]]})

    return run


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of column ``fp`` that connect all within ``max_distance``."""
    keyed = fps.select("fp", F.explode(F.array(*_keys(max_distance))).alias("key"))
    keyed = stage(keyed.join(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key"))

    small = keyed.filter(F.col("n") <= SMALL).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    near = lambda a: lambda b: F.bit_count(a.bitwiseXOR(b)) <= max_distance
    pairs = F.flatten(
        F.transform(
            "fps",
            lambda a, i: F.transform(
                F.filter(F.slice("fps", i + 2, SMALL), near(a)), lambda b: F.struct(a.alias("a"), b.alias("b"))
            ),
        )
    )
    few = small.select(F.explode(pairs).alias("pair")).select("pair.a", "pair.b")

    large = keyed.filter(F.col("n") > SMALL)
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    large = large.withColumn("own", F.pmod(F.hash("fp"), chunks))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    large = large.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    many = large.groupBy("key", "i", "j").applyInPandas(_spanning(max_distance), "a long, b long")
    return few.union(many).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """One row per document: its key, fingerprint (16 hexadecimal digits) and component_id, the smallest key reachable."""
    printed = stage(fingerprints(docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))))
    firsts = stage(printed.groupBy("fp").agg(F.min("__key").alias("first")))
    labels = components(links(firsts.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    classes = stage(firsts.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = stage(classes.join(smallest, "component").select("fp", "component_id"))
    return printed.join(by_print, "fp").select(
        F.col("__key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Of each group of near copies the document with the smallest key; all columns as they were.

    Documents are told apart by key and text: of repeated rows one stays. Documents without a key come after all others.
    """
    stand_in = F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61))
    named = docs.withColumn("__key", F.coalesce(F.col(key).cast("long"), stand_in))
    classes = near_duplicates(named, "__key", text, max_distance)
    first = classes.filter("__key = component_id").select("__key").distinct()
    own = Window.partitionBy("__key", "__hash").orderBy("__key")
    kept = named.join(first, "__key", "left_semi").withColumn("__hash", F.xxhash64(text))
    return kept.withColumn("__copy", F.row_number().over(own)).filter("__copy = 1").select(*docs.columns)
