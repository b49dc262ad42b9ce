"""Hard negatives by slots: positives' upper limits split scores into disjoint slots, whose best rows answer all windows.

Rows and anchors are packed into blocks where they are read, so no block is larger than ``ROWS`` whatever values repeat. Each
block of anchors meets each block of rows once, in two passes, each an exact integer product of two matrices in one task:

1. Positives: per anchor and block the best rows of the anchor's label, then the best of these over all blocks.
2. Negatives: the scores of an anchor's positives are upper limits of windows. They cut the scores into disjoint slots: from
   a limit down to the next one. Per anchor, slot and block the best ``k`` rows of other labels are kept, and the best ``k`` of
   these over all blocks. What a window holds below its upper limit is its own slot, then the next one down, and so on: its
   answer is the first ``k`` rows of its slot and all lower ones, cut off at the window's lower limit.

A block keeps ``k`` rows of a slot however many share a score, ties by smaller id, so a vector that fills a third of the
table costs no more than any other. Blocks meet in lanes by equality; the number of lanes, and so of tasks, follows the number of blocks.

Defined cases: rows with a null id, label, vector or component take no part; vectors meet vectors of their own length;
rows of the anchor's own id are neither positives nor negatives of it; repeated rows are rows of their own, so an id can
stand on two ranks, and each repeated anchor gives its results; an empty table gives an empty result. Scores are computed in
doubles where no product can be inexact, else in unbounded integers; one beyond a long is returned as the nearest long.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from calloom.llm.common import row_keys
from calloom.session import stage

#: Rows and anchors of a block.
ROWS, ANCHORS = 4096, 512
#: The least and the greatest long.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _pack(rows: DataFrame, numbers: list[str], size: int) -> DataFrame:
    """Blocks of up to ``size`` rows of one vector length, by id: ``numbers`` and vectors as bytes of longs, one row a block."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("dims", T.IntegerType()),
        *(T.StructField(n, T.BinaryType()) for n in [*numbers, "vector"]),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[list[np.ndarray]]] = defaultdict(list)
        made = 0

        def packed(dims: int, parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            nonlocal made
            columns = [np.concatenate(column) for column in zip(*parts)]
            order = np.argsort(columns[numbers.index("id")], kind="stable")
            key = row_keys(1, made)[0]
            made += 1
            values = [[key], [dims], *([column[order].tobytes()] for column in columns)]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, fields)], schema=fields)

        for batch in batches:
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in numbers]
            vectors = batch.column("vector")
            flat, lengths = vectors.flatten().to_numpy(), vectors.value_lengths().to_numpy()
            ends = np.cumsum(lengths)
            for dims in np.unique(lengths).tolist():
                for at in np.split(rows_of := np.flatnonzero(lengths == dims), range(size, len(rows_of), size)):
                    if sum(len(part[0]) for part in waiting[dims]) + len(at) > size:
                        yield packed(dims, waiting.pop(dims))
                    waiting[dims].append([*(c[at] for c in columns), flat[(ends[at] - dims)[:, None] + np.arange(dims)]])
        for dims, parts in waiting.items():
            yield packed(dims, parts)

    fields = pa.schema([("block", pa.int64()), ("dims", pa.int32()), *((n, pa.binary()) for n in [*numbers, "vector"])])
    return rows.select(*numbers, "vector").mapInArrow(run, schema)


def _meet(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Each block of anchors beside each block of rows of its vector length, joined by equality of length and lane."""
    spark = rows.sparkSession
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lanes = max(1, min(rows.count(), 4 * slots))
    left = anchors.select("dims", *(F.col(n).alias(f"a_{n}") for n in anchors.columns if n != "dims"))
    left = left.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    right = rows.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int"))
    # the numbers are given: by their bytes these few rows would be merged into one task, and each is much work
    deal = lambda side: side.repartition(2 * lanes, "dims", "lane")
    return deal(left).join(deal(right).hint("merge"), ["dims", "lane"])


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of longs, held to the range of a long."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = np.abs(a.astype(float)).max() * np.abs(b.astype(float)).max() * a.shape[1]
    if bound < 2.0**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound < 2.0**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k greatest allowed scores of each row; of equal ones the first columns."""
    if scores.shape[1] > k:
        held = np.where(allowed, scores, LEAST)
        limit = np.partition(held, held.shape[1] - k, axis=1)[:, -k][:, None]
        above, level = allowed & (scores > limit), allowed & (scores == limit)
        allowed = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1)[:, None]))
    return np.nonzero(allowed)


def _search(pairs: DataFrame, slots: int, k: int) -> DataFrame:
    """The best k rows for each anchor: of its label if ``slots`` is 0, else of other labels in each of its slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                longs = {n: np.frombuffer(v, np.int64) for n, v in row.items() if isinstance(v, bytes)}
                a, b = longs["a_vector"].reshape(len(longs["a_id"]), -1), longs["vector"].reshape(len(longs["id"]), -1)
                scores = _scores(a, b)
                alike = longs["a_label"][:, None] == longs["label"]
                others = longs["a_id"][:, None] != longs["id"]
                for slot in range(max(slots, 1)):
                    if slots:
                        inside = others & ~alike & (scores <= longs[f"a_limit{slot}"][:, None])
                        # the last slot goes down to the lowest window's end; one that repeats the next limit is empty
                        under = longs[f"a_limit{slot + 1}"] if slot + 1 < slots else longs["a_lowest"]
                        inside &= (scores > under[:, None]) if slot + 1 < slots else (scores >= under[:, None])
                    else:
                        inside = others & alike
                    at, column = _best(scores, inside, k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(longs["a_anchor"][at]), pa.array(np.full(len(at), slot, np.int32)),
                            pa.array(longs["id"][column]), pa.array(scores[at, column]),
                        ],
                        names=["anchor", "slot", "id", "score"],
                    )

    found = pairs.mapInArrow(run, "anchor long, slot int, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """Per anchor and positive the first negatives whose score is ``low`` to ``high`` hundredths of the positive's.

    ``rows`` have id, label and vector (an array of longs). Result: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.
    """

    def wide(score: str) -> Column:
        return F.col(score).cast("decimal(20,0)")

    def long(value: Column) -> Column:
        return F.least(F.greatest(value, F.lit(LEAST)), F.lit(MOST)).cast("long")

    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    whole &= ~F.exists("vector", lambda x: x.isNull())
    plain = [F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector")]
    rows = rows.filter(whole)
    blocks = stage(_pack(rows.select(*plain), ["id", "label"], ROWS))
    anchors = stage(rows.filter(is_anchor).select(*plain)).withColumn("anchor", F.monotonically_increasing_id())
    anchors = stage(anchors)

    def packed(frame: DataFrame, numbers: list[str]) -> DataFrame:
        tasks = -(-anchors.count() // ANCHORS)
        return stage(_pack(frame.repartition(max(1, tasks), "anchor"), ["id", "anchor", *numbers], ANCHORS))

    chosen = stage(_search(_meet(packed(anchors, ["label"]), blocks), 0, positives))
    # limits downwards, whole numbers; an anchor with fewer positives repeats its last one
    upper = F.floor(wide("score") * high / 100)
    lower = F.ceil(wide("score") * low / 100)
    limits = chosen.groupBy("anchor").agg(
        F.sort_array(F.collect_set(long(upper)), asc=False).alias("limits"), F.min(long(lower)).alias("lowest")
    )
    names = [f"limit{i}" for i in range(positives)]
    limits = limits.select(
        "anchor", "lowest", *(F.coalesce(F.get("limits", F.lit(i)), F.element_at("limits", -1)).alias(n) for i, n in enumerate(names))
    )
    limited = packed(anchors.join(limits, "anchor"), ["label", "lowest", *names])
    kept = _search(_meet(limited, blocks), positives, negatives)

    # slots of an anchor one below the other: a window is its first rows from its own slot downwards
    merged = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "id", "score"))).alias("slots"))

    def inside(row: Column) -> Column:
        score = row["score"].cast("decimal(20,0)") * 100
        return (score >= wide("positive_score") * low) & (score <= wide("positive_score") * high)

    windows = chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    answers = windows.join(merged, "anchor").join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    answers = answers.select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(F.filter("slots", inside), 1, negatives)).alias("at", "row")
    )
    return answers.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("row.id").alias("negative_id"), "positive_score",
        F.col("row.score").alias("negative_score"),
    )


def oracle_sql() -> str:
    """The query over embeddings in DuckDB: every anchor beside every row."""
    return """
        with r as (
            select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(x::double * 256)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        s as (
            select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as alike,
                   cast(list_dot_product(a.v, b.v) as bigint) as score
            from r a join r b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 100 = 0
        ),
        p as (
            select anchor_id, id as positive_id, score as positive_score from s where alike
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
        )
        select anchor_id, positive_id,
               cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) as rank,
               id as negative_id, positive_score, score as negative_score
        from p join s using (anchor_id)
        where not alike and 80 * positive_score <= 100 * score and score <= positive_score
        qualify rank <= 5
    """
