"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too much go.

All of it is DataFrame functions on one row at a time: one scan, no shuffle, no Python on the executors. A very long
text costs n log n in its own row; nothing is gathered across rows.

Defined cases: a null text has no words and fails the base rules; a text without any line that has a word likewise.
Rows are judged one by one, so repeated rows and ids give repeated results. Input columns named like a result are
replaced; all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from calloom.llm.common import BLANKS, words

#: Phrases of footers, licence notes and page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "licensed under", "log in to", "privacy policy",
    "released under the", "sign up for", "subscribe to our", "terms of service", "terms of use", "this work is licensed",
)
#: Marks that separate the entries of navigation bars and tables.
SEPARATORS = "|›»•·"
#: Marks that stand for noise where there are many.
NOISE = "#*$%&<>!"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_PERCENT = 50


def _count_repeats(frame: DataFrame) -> DataFrame:
    """Replace ``_hashes``, one per 3-word window, by ``n_repeat_words``: words in windows found twice or more.

    Windows are compared by 64-bit hashes within one text; only texts with an equal pair of hashes are sorted.
    """
    own = [name for name in frame.columns if name != "__hashes"]
    frame = frame.select(
        *own,
        F.when(
            F.size(F.array_distinct("__hashes")) < F.size("__hashes"),
            F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("__windows"),
    )
    same = lambda window, i: F.coalesce(F.get("__windows", i)["h"] == window["h"], F.lit(False))
    repeated = F.filter("__windows", lambda window, i: same(window, i - 1) | same(window, i + 1))
    covered = F.flatten(F.transform(repeated, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    count = F.when(F.col("__windows").isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered)))
    # A filter on the verdict must not move below this step: it would carry the sorting of windows into each of its own
    # look-ups. The optimizer moves no filter through a column that is not deterministic.
    here = F.monotonically_increasing_id() >= 0
    return frame.select(*own, F.when(here, count.cast("long")).otherwise(F.lit(0)).alias("n_repeat_words"))


def _count_words(line: Column) -> Column:
    """Pieces between single spaces, which is what the shares of a line are taken of."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1


def _count_marks(line: Column, marks: str) -> Column:
    return F.length(F.regexp_replace(line, f"[^{marks}]+", ""))


def ends_well(line: Column) -> Column:
    """Punctuation: the line ends as a sentence does, or has 20 words or more and a sentence end within."""
    return line.rlike(r"[.!?…:;][\"'”’»)\]]*[\x20\x09-\x0D]*\z") | (
        (_count_words(line) >= 20) & line.rlike(r"[.!?…]([\x20\x09-\x0D]|\z)")
    )


def is_clear(line: Column) -> Column:
    """Neither noise (over three symbols or exclamation marks to five words) nor navigation (two separators or more,
    over one to ten words)."""
    noise = _count_marks(line, NOISE) * 5 > _count_words(line) * 3
    separators = _count_marks(line, SEPARATORS)
    return ~noise & ~((separators >= 2) & (separators * 10 > _count_words(line)))


def is_own_text(line: Column) -> Column:
    """Boilerplate: the line holds none of the known phrases."""
    return ~F.lower(line).rlike("|".join(BOILERPLATE))


def _holds_phrase(lower: Column) -> Column:
    held = F.lit(False)
    for phrase in BOILERPLATE:
        held = held | F.contains(lower, F.lit(phrase))
    return held


def judge(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_kept_percent: int = MIN_KEPT_PERCENT,
) -> DataFrame:
    """Counts and verdict next to each document.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, cleaned (the text without its
    failing lines), kept_percent (characters in passing lines, of those in lines with a word) and kept.
    """
    added = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned", "kept_percent",
        "kept",
    ]
    frame = docs.drop(*(name for name in added if name != text))
    own = frame.columns
    content = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda n, line: n + F.length(line))
    # Each select keeps only what later ones need: wide arrays are not carried along.
    frame = frame.select(*own, F.split(content, "\n", -1).alias("__lines"), F.lower(content).alias("__lower"))
    frame = frame.select(
        *own, "__lines", content.rlike(f"[{NOISE}{SEPARATORS}]").alias("__marks"), _holds_phrase(F.col("__lower")).alias("__phrase")
    )
    # The last two rules only run on texts that hold what they look for.
    frame = frame.select(
        *own, "__marks", "__phrase",
        F.filter("__lines", has_word).alias("__full"),
        F.filter("__lines", lambda line: ends_well(line) | ~has_word(line)).alias("__good"),
    )
    clear = F.filter("__good", lambda line: is_clear(line) | ~has_word(line))
    frame = frame.select(*own, "__phrase", "__full", F.when(F.col("__marks"), clear).otherwise(F.col("__good")).alias("__good"))
    own_text = F.filter("__good", is_own_text)
    frame = frame.select(*own, "__full", F.when(F.col("__phrase"), own_text).otherwise(F.col("__good")).alias("__good"))
    frame = frame.select(
        *own,
        (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long").alias("n_dup_lines"),
        F.array_join("__good", "\n").alias("cleaned"),
        chars(F.col("__full")).alias("__chars"),
        chars(F.filter("__good", has_word)).alias("__kept_chars"),
    )
    done = [*own, "n_dup_lines", "cleaned"]
    percent = F.when(F.col("__chars") > 0, F.col("__kept_chars") * 100.0 / F.col("__chars")).otherwise(F.lit(0.0))
    frame = frame.select(*done, percent.alias("kept_percent"), words(content).alias("__words"))
    done += ["kept_percent", "n_words", "word_chars", "n_symbols"]
    frame = frame.select(
        *done[:-3],
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(content, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.when(
            F.size("__words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("__words") - 3),
                lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("__hashes"),
    )
    frame = _count_repeats(frame)
    frame = frame.withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent),
    )
    return frame.withColumn("kept", ~F.col("base_failed") & (F.col("kept_percent") >= min_kept_percent))


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, without their failing lines; n_chars follows the new text where there is one."""
    judged = judge(docs, **limits).filter("kept")
    column = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return judged.select(*(column.get(name, F.col(name)).alias(name) for name in docs.columns))


def oracle_sql(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, min_kept_percent: int = MIN_KEPT_PERCENT) -> str:
    """Counts and verdict in SQL: windows and lines as rows, grouped per document."""
    blanks, word = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)", r"[^\x20\x09-\x0D]"
    n_words = "(length(bare) - length(replace(bare, ' ', '')) + 1)"
    phrases = " or ".join(f"contains(lower(line), '{phrase}')" for phrase in BOILERPLATE)
    return rf"""
    with d as (
        select row_number() over () as rid, doc_id, coalesce(text, '') as t,
               regexp_extract_all(coalesce(text, ''), '{word}+') as ws from documents
    ),
    g as (select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
          from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from d)),
    r as (select rid, i from (select *, count(*) over (partition by rid, g) as c from g) where c > 1),
    c as (select rid, count(distinct i + k) as n_repeat_words from r cross join (values (0), (1), (2)) v(k) group by rid),
    l as (select rid, line, trim(line, {blanks}) as bare from (select rid, unnest(string_split(t, chr(10))) as line from d)
          where regexp_matches(line, '{word}')),
    v as (
        select *, (regexp_matches(line, '[.!?…:;]["''”’»)\]]*[\x20\x09-\x0D]*\z')
                   or ({n_words} >= 20 and regexp_matches(line, '[.!?…]([\x20\x09-\x0D]|\z)')))
               and length(regexp_replace(line, '[^{NOISE}]+', '', 'g')) * 5 <= {n_words} * 3
               and not (length(regexp_replace(line, '[^{SEPARATORS}]+', '', 'g')) >= 2
                        and length(regexp_replace(line, '[^{SEPARATORS}]+', '', 'g')) * 10 > {n_words})
               and not ({phrases}) as good
        from l
    ),
    k as (select rid, count(*) - count(distinct line) as n_dup_lines, sum(length(line)) as chars,
                 coalesce(sum(length(line)) filter (good), 0) as kept_chars from v group by rid),
    b as (
        select doc_id, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
               cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
               cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
               cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, kept_chars, chars
        from d left join c using (rid) left join k using (rid)
    ),
    f as (select *, n_words < {min_words} or n_repeat_words * 100 > n_words * {max_repeat_percent} as base_failed from b)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and coalesce(kept_chars * 100 >= chars * {min_kept_percent}, false) as kept
    from f
    """
