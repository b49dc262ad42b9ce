"""How far the sources of a language differ in their words: term counts by a sort of word-start pointers.

1. Counting. A task lays texts of one shard (``SHARD_BYTES``) end to end, by language and source, as they lie in their Arrow
   buffer, and builds one pointer for each word start; no word is copied. The pointers are sorted by multikey quicksort:
   all slices of equal beginnings are cut by the next eight bytes of their words at once, and slices of one word are done.
   Pointers keep the order of their documents in a slice, so a run of equal words holds each (language, source) group as one
   piece: its length is the group's count, its changes of document the document frequency. Spark adds the shards up.
2. Terms in enough documents of their language stay, one row each with its counts by source.
3. A source's probability of a term, p, is smoothed and scaled to whole numbers; f(p, q) = floor((p - q)^2 / q) is the term's part
   of the divergence. Sums of f over all terms of two sources take the terms that both have from step 2, added up inside the
   tasks, and all others from histograms: a term that only one of two sources has depends on its p alone.

No pair of documents or words is formed. A word that is a third of all words is one run of a shard; a source that is a third of
all rows is spread over all tasks, its top terms are taken per task before they meet.

Defined cases: null text, language and source count as empty ones; a group without terms is compared over the terms of its
language; a language without terms has pairs of value 0; repeated rows are documents of their own; an empty table gives an
empty result. Counts are longs, products of them decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from calloom.session import stage

#: Bytes of text in a shard, whose pointers and their keys take some twenty times that; rows of a batch of counts.
SHARD_BYTES, BATCH_ROWS = 1 << 22, 1 << 16
SCALE = 1_000_000_000
#: Bytes that end a word: all of ASCII but its letters.
BREAKS = np.array([i < 128 and not chr(i).isalpha() for i in range(256)])
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)


def word_starts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each word in texts laid end to end, each with a break byte after it."""
    inside = ~BREAKS[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    return starts, stops, np.searchsorted(ends, starts, side="right")


def pointer_sort(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): pointers by their words, equal words in the order given; and the number of each word's run.

    Multikey quicksort over keys of eight bytes: a depth sorts all slices that are still open by (slice, key).
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    order, slices = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    # where slices that are still open lie in the order
    places = np.arange(len(starts))
    depth = 0
    while len(places):
        pointers = order[places]
        first = starts[pointers] + depth
        key = np.lib.stride_tricks.sliding_window_view(padded, 8)[np.minimum(first, len(data))]
        key = np.ascontiguousarray(key).view(">u8").ravel().astype(np.uint64)
        left = stops[pointers] - first
        key &= np.where(left >= 8, ~np.uint64(0), ~(~np.uint64(0) >> (8 * np.clip(left, 0, 7)).astype(np.uint64)))
        sort = np.lexsort((key, slices[places])) if depth else np.argsort(key, kind="stable")
        order[places], key = pointers[sort], key[sort]
        # a slice falls apart where its key changes; it is done where its words end inside the key or it holds one pointer
        cut = np.concatenate([[True], (key[1:] != key[:-1]) | (slices[places][1:] != slices[places][:-1])])
        slices[places] = places[np.maximum.accumulate(np.where(cut, np.arange(len(cut)), 0))]
        sizes = np.diff(np.append(np.flatnonzero(cut), len(cut)))
        going = (left[sort] >= 8) & np.repeat(sizes > 1, sizes)
        places = places[going]
        depth += 8
    return order, np.cumsum(np.concatenate([[False], slices[1:] != slices[:-1]])) if len(slices) else slices


def _counted(texts: list[bytes], groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) of a shard, in batches."""
    by_group = sorted(range(len(texts)), key=groups.__getitem__)
    names = sorted(set(groups))
    numbers = {g: i for i, g in enumerate(names)}
    data = LOWER[np.frombuffer(b"\n".join([texts[i] for i in by_group] + [b""]), np.uint8)]
    ends = np.cumsum([len(texts[i]) + 1 for i in by_group])
    group_of = np.array([numbers[groups[i]] for i in by_group])
    starts, stops, doc = word_starts(data, ends)
    order, run = pointer_sort(data, starts, stops)
    doc = doc[order]
    group = group_of[doc]
    new = np.ones(len(order), bool)
    new[1:] = (run[1:] != run[:-1]) | (group[1:] != group[:-1])
    heads = np.flatnonzero(new)
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    n = np.diff(np.append(heads, len(order)))
    df = np.add.reduceat(other.astype(np.int64), heads) if len(heads) else n
    raw, first = data.tobytes(), order[heads]
    at = group[heads]
    langs, sources = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))
    for i in range(0, len(heads), BATCH_ROWS):
        own = slice(i, i + BATCH_ROWS)
        terms = [raw[a:b].decode() for a, b in zip(starts[first[own]].tolist(), stops[first[own]].tolist())]
        where = pa.array(at[own])
        yield pa.RecordBatch.from_arrays(
            [langs.take(where), sources.take(where), pa.array(terms, pa.string()), pa.array(n[own], pa.int64()), pa.array(df[own], pa.int64())],
            names=["lang", "source", "term", "n", "df"],
        )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, groups, size = [], [], 0
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("text", "lang", "source"))
            for text, lang, source in zip(*columns):
                texts.append(text), groups.append((lang, source))
                size += len(text)
                if size >= SHARD_BYTES:
                    yield from _counted(texts, groups)
                    texts, groups, size = [], [], 0
        if texts:
            yield from _counted(texts, groups)

    plain = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), "lang", "source")
    counts = plain.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _difference(p: str, q: str) -> Column:
    """floor((p - q)^2 / q) of whole numbers up to a thousand million and one."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _probability(count: Column, total: str, terms: str) -> Column:
    share = (count + 1).cast("decimal(28,0)") * F.lit(SCALE)
    whole = share - share % (F.col(total) + F.col(terms)).cast("decimal(28,0)")
    return (F.lit(1) + (whole / (F.col(total) + F.col(terms)).cast("decimal(28,0)"))).cast("long")


def _shared(rows: DataFrame) -> DataFrame:
    """(lang, source, other, value): what terms that both sources have add to f over the values if each lacked the other."""
    schema = "lang string, source string, other string, value long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = {}
        for batch in batches:
            entries = batch.column("entries")
            flat = entries.flatten()
            source, inverse = np.unique(flat.field("source").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
            langs, lang_of = np.unique(batch.column("lang").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
            sizes = entries.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            first = np.cumsum(sizes) - sizes
            p, p0 = flat.field("p").to_numpy(), flat.field("p0").to_numpy()
            lang = lang_of[row]
            # a step takes from each term the entry a places on: sizes of terms, not pairs of them, bound what is held
            for a in range(int(sizes.max(initial=0))):
                held = np.flatnonzero(sizes[row] > a)
                mate = first[row[held]] + a
                keep = mate != held
                g, h = held[keep], mate[keep]
                value = _f(p[g], p[h]) - _f(p[g], p0[h]) - _f(p0[g], p[h]) + _f(p0[g], p0[h])
                key = (lang[g] * len(source) + inverse[g]) * len(source) + inverse[h]
                sort = np.argsort(key, kind="stable")
                key, value = key[sort], value[sort]
                heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
                for k, total in zip(key[heads].tolist(), np.add.reduceat(value, heads).tolist() if len(heads) else []):
                    names = (langs[k // len(source) ** 2], source[k // len(source) % len(source)], source[k % len(source)])
                    sums[names] = sums.get(names, 0) + total
        langs, sources, others = zip(*sums) if sums else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.string()) for c in (langs, sources, others)), pa.array(sums.values(), pa.int64())],
            names=["lang", "source", "other", "value"],
        )

    return rows.mapInArrow(run, schema)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of sources, and the terms by which a source stands out."""
    docs = docs.select("text", *(F.coalesce(n, F.lit("")).alias(n) for n in ("lang", "source")))
    counts = stage(term_counts(docs))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("entries")
    )
    terms = stage(terms.filter(F.col("df") >= least_docs).drop("df"))
    entries = terms.select("lang", "term", F.col("n").alias("lang_n"), F.inline("entries"))

    # one row for each group of the documents, with its tokens and its language's tokens and terms
    in_lang = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    in_group = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.groupBy("lang", "source").agg(F.count("*").alias("docs")).drop("docs")
    groups = groups.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
    groups = stage(groups.na.fill(0, ["total", "terms", "lang_total"]))
    floor = F.when(F.col("terms") > 0, _probability(F.lit(0), "total", "terms")).otherwise(F.lit(1))
    groups = stage(groups.withColumn("p0", floor))

    known = entries.join(groups, ["lang", "source"]).withColumn("p", _probability(F.col("n"), "total", "terms"))
    known = stage(known.select("lang", "source", "term", "p", "p0", _probability(F.col("lang_n"), "lang_total", "terms").alias("q")))
    return _pairs(known, groups).unionByName(_terms(known, top))


def _terms(known: DataFrame, top: int) -> DataFrame:
    over = known.filter("p > q").withColumn("value", _difference("p", "q"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    ranked = over.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(known: DataFrame, groups: DataFrame) -> DataFrame:
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    pairs = groups.select("lang", "source", "terms", "p0").join(other, "lang").filter("source <> other")
    # over all terms as if no source had them
    none = pairs.select("lang", "source", "other", (F.col("terms") * _difference("p0", "q0")).alias("value"))
    # what changes for the terms of one of the two
    levels = stage(known.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n")))
    met = levels.join(other, "lang").filter("source <> other")
    own = met.select("lang", "source", "other", (F.col("n") * (_difference("p", "q0") - _difference("p0", "q0"))).alias("value"))
    theirs = met.select(
        "lang", F.col("other").alias("source"), F.col("source").alias("other"),
        (F.col("n") * (_difference("q0", "p") - _difference("q0", "p0"))).alias("value"),
    )
    # and for the terms of both
    both = _shared(known.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("entries")).drop("term"))
    sums = none.unionByName(own).unionByName(theirs).unionByName(both).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other"))
    return sums.withColumn("rank", rank).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank"
    )


def oracle_sql() -> str:
    """The same in DuckDB: every term of a language beside every group of it."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
        with d as (
            select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   translate(coalesce(text, ''), '{upper}', '{upper.lower()}') as text
            from documents
        ),
        w as (
            select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
        ),
        kept as (select lang, term, count(*) as n from w group by lang, term having count(distinct id) >= 3),
        c as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by lang, source, term),
        v as (select lang, count(*) as terms, sum(n) as total from kept group by lang),
        g as (
            select lang, source, coalesce(sum(c.n), 0) as total
            from (select distinct lang, source from d) left join c using (lang, source) group by lang, source
        ),
        p as (
            select g.lang, g.source, kept.term, coalesce(c.n, 0) as n,
                   1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.total + v.terms)::hugeint as p,
                   1 + (1000000000::hugeint * (kept.n + 1)) // (v.total + v.terms)::hugeint as q
            from g join kept using (lang) join v using (lang) left join c using (lang, source, term)
        ),
        pairs as (
            select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
            from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ),
        every as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pairs.value, 0) as value
            from g a join g b on a.lang = b.lang and a.source <> b.source
            left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
            union all
            select lang, source, 'term', term, (p - q) * (p - q) // q from p where n > 0 and p > q
        )
        select lang, source, part, item, cast(value as bigint) as value,
               cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
        from every
        qualify part = 'pair' or rank <= 200
    """
