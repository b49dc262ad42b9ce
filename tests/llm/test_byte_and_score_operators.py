"""Byte-level encoding, source divergence and hard negatives against libraries and brute force, with the defined hard cases."""

import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from calloom.llm import byte_bpe, hard_negatives, source_divergence

from tests.llm.conftest import HARD


# --- byte-level BPE ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks_path():
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library(ranks_path):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(ranks_path), special_tokens={}
    )


def coded(docs, path):
    return byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path)


@pytest.mark.parametrize("frequent", [0, 1 << 19])
def test_texts_encode_as_the_library_and_decode_to_themselves(spark, docs, ranks_path, library, monkeypatch, frequent):
    monkeypatch.setattr(byte_bpe, "FREQUENT", frequent)
    random.seed(5)
    marks = ["a", "aaa", " the", "'s", "!!", "é", "日本", "\U0001f600", "12", "  ", "\n\n", "\x1c", "　", "\x85", "<|endoftext|>", "ab" * 40]
    texts = ["".join(random.choices(marks, k=random.randint(0, 12))) for _ in range(300)]
    texts += [row.text for row in docs.select("text").limit(60).collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = coded(frame, ranks_path).select("text", "ids", "decoded").collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == library.encode_ordinary(row.text or ""), row.text
        assert bytes(row.decoded) == (row.text or "").encode()


def test_the_fold_equals_the_library_on_every_entry_and_on_long_words(spark, ranks_path, library):
    ranks = byte_bpe.read_ranks(ranks_path)
    random.seed(6)
    words = ["a" * 5000, "acgt" * 1500, "".join(random.choices("etaoin", k=700)), "x", "ÿ", "\x00\x01", "aab" * 99]
    some = [token.decode("latin-1") for token in ranks][::97]
    frame = spark.createDataFrame([(words, some)], "words array<string>, some array<string>")
    latin = F.transform("words", byte_bpe.latin)
    row = frame.select(byte_bpe.encoded(latin, ranks).alias("ids"), byte_bpe.encoded(F.col("some"), ranks).alias("own")).first()
    assert row.ids == [library._encode_single_piece(w) for w in words]
    # what merging all pairs of a rank at once needs: an entry's own bytes merge to it
    assert row.own == [[ranks[t.encode("latin-1")]] for t in some]


def test_frequent_words_go_in_runs_between_the_others(spark, ranks_path):
    starts, sizes, flat = np.array([0, 2]), np.array([2, 1]), np.array([5, 6, 7], np.int32)
    for at, ids, breaks in (
        ([], [], []), ([-1], [], [0]), ([0, 1], [5, 6, 7], []), ([-1, 0, -2, -1, 1, -1], [5, 6, 7], [0, 2, 2, 3]),
    ):
        found = byte_bpe._spread(np.array(at, np.int64), starts, sizes, flat)
        assert [f.tolist() for f in found] == [ids, breaks]
    none = np.zeros(0, np.int64)
    assert [f.tolist() for f in byte_bpe._spread(np.array([-1, -2]), none, none, np.zeros(0, np.int32))] == [[], [0, 0]]
    # no predicate is asked for each id
    odd = spark.createDataFrame([([0, None],)], "ids array<int>")
    assert "exists(" not in byte_bpe.decode(odd, ranks_path)._jdf.queryExecution().analyzed().toString()


def test_pieces_are_split_at_one_character(spark):
    """Java splits at one character without a regular expression; at two it compiles one each time."""
    frame = spark.createDataFrame([(["aab", "c", "abcab"],)], "words array<string>")
    ids = frame.select(byte_bpe.encoded(F.col("words"), {b"a": 0, b"b": 1, b"c": 2, b"ab": 3}).alias("ids"))
    plan = ids._jdf.queryExecution().analyzed().toString()
    assert f", {byte_bpe.CLOSE}, -1)" in plan and f", {byte_bpe.CLOSE}{byte_bpe.OPEN}, -1)" not in plan
    assert ids.first().ids == [[0, 3], [2], [3, 2, 3]]


def test_equal_pairs_merge_from_the_left(spark):
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")} | {b"aa": 3, b"aab": 4, b"bc": 5}
    frame = spark.createDataFrame([(["aaa", "aaab", "aabc", ""],)], "words array<string>")
    ids = frame.select(byte_bpe.encoded(F.col("words"), ranks).alias("ids")).first().ids
    assert ids[:3] == [[3, 0], [3, 0, 1], [4, 2]]


def test_byte_bpe_hard_cases(hard, none, spark, ranks_path, library):
    rows = coded(hard, ranks_path).select("text", "ids", "decoded", "score").collect()
    assert len(rows) == len(HARD)
    for row in rows:
        assert row.ids == library.encode_ordinary(row.text or "") and bytes(row.decoded) == (row.text or "").encode()
        assert row.score == "own"
    assert coded(none, ranks_path).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([60000],), ([-1, 5],), ([None],)], "ids array<int>")
    assert [r.decoded and bytes(r.decoded) for r in byte_bpe.decode(odd, ranks_path).collect()] == [b"", b"", None, None, None]


# --- source divergence -------------------------------------------------------------------------------------------------


def plain_audit(rows, least_docs=3, top=200):
    """The contract, word by word: rows of (text, lang, source)."""
    rows = [tuple(v or "" for v in row) for row in rows]
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    count, df = Counter(), Counter()
    for text, lang, source in rows:
        split = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in text.translate(lower))
        terms = [t for t in split.split(" ") if t]
        count.update((lang, source, t) for t in terms)
        df.update({(lang, t) for t in terms})
    kept = defaultdict(list)
    for lang, term in df:
        if df[lang, term] >= least_docs:
            kept[lang].append(term)
    sources = defaultdict(set)
    for _, lang, source in rows:
        sources[lang].add(source)
    out = []
    for lang in sources:
        total = {s: sum(count[lang, s, t] for t in kept[lang]) for s in sources[lang]}
        size = len(kept[lang])

        def p(source, term):
            return 1 + 10**9 * (count[lang, source, term] + 1) // (total[source] + size)

        def q(term):
            return 1 + 10**9 * (sum(count[lang, s, term] for s in sources[lang]) + 1) // (sum(total.values()) + size)

        def f(a, b):
            return (a - b) ** 2 // b

        for s in sources[lang]:
            pairs = [(-sum(f(p(s, t), p(o, t)) for t in kept[lang]), o.encode()) for o in sources[lang] - {s}]
            terms = [(-f(p(s, t), q(t)), t.encode()) for t in kept[lang] if count[lang, s, t] and p(s, t) > q(t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def audited(frame, **options):
    rows = source_divergence.audit(frame, **options).select("lang", "source", "part", "item", "value", "rank").collect()
    return sorted(map(tuple, rows))


def test_audit_equals_the_plain_rule(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "SHARD_BYTES", 300)
    random.seed(7)
    words = ["a", "Ab", "tiontion", "tiontions", "übermäßig", "langeswortganzlang", "langeswortganzlanger", "日本", "z" * 30, "z" * 40, "x9y"]
    texts = [" ".join(random.choices(words, k=random.randint(0, 12))) + random.choice(["", "!", "\n", "9"]) for _ in range(120)]
    rows = [(t, random.choice(["en", "de", None]), random.choice(["s1", "s2", "s3", None, "S"])) for t in texts]
    # a source with a third of all rows, one without terms, a language without terms, null and empty texts
    rows += [("a a Ab tiontion", "en", "hot")] * 60 + [("123", "en", "mute"), (None, "de", "s1"), ("", "fr", "s1"), ("once", "fr", "s2")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert audited(frame) == plain_audit(rows)
    assert audited(frame, top=2) == plain_audit(rows, top=2)


def test_audit_hard_cases(hard, none):
    rows = [tuple(r) for r in hard.select("text", "lang", "source").collect()]
    assert audited(hard, least_docs=1) == plain_audit(rows, least_docs=1)
    assert audited(none) == []


def test_a_shard_takes_little_memory():
    size = source_divergence.SHARD_BYTES
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)).encode() for _ in range(size // 6)]
    texts = [b" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    groups = [("en", f"s{i % 3}") for i in range(len(texts))]
    tracemalloc.start()
    batches = [(b.num_rows, sum(b.column("n").to_pylist())) for b in source_divergence._counted(texts, groups)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for _, n in batches) == len(words) and max(rows for rows, _ in batches) <= 1 << 16
    assert peak < 128 << 20, peak


def test_pointers_sort_by_words_and_keep_the_order_of_equal_ones():
    random.seed(8)
    words = ["".join(random.choices("ab", k=random.randint(1, 40))).encode() for _ in range(400)] + [b"abababab", b"abababab" * 2] * 5
    data = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, stops, doc = source_divergence.word_starts(data, ends)
    order, run = source_divergence.pointer_sort(data, starts, stops)
    assert doc.tolist() == list(range(len(words)))
    assert order.tolist() == sorted(range(len(words)), key=lambda i: (words[i], i))
    ordered = [words[i] for i in order]
    assert [int(r) for r in run] == np.cumsum([0, *(a != b for a, b in zip(ordered, ordered[1:]))]).tolist()


# --- hard negatives ----------------------------------------------------------------------------------------------------


def plain_mine(rows, every, positives=5, negatives=5, low=80, high=100):
    rows = [r for r in rows if None not in r[:3] and None not in r[2]]
    out = []
    for a_id, a_label, a in rows:
        if a_id % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in rows if i != a_id and len(v) == len(a)]
        for s, p_id, _ in sorted(x for x in scored if x[2] == a_label)[:positives]:
            window = sorted(x for x in scored if x[2] != a_label and low * -s <= 100 * -x[0] <= high * -s)
            out += [(a_id, p_id, i + 1, n, -s, -t) for i, (t, n, _) in enumerate(window[:negatives])]
    return sorted(out)


def mined(spark, rows, every, **options):
    frame = spark.createDataFrame(rows, "id long, label int, vector array<long>").withColumn("score", F.lit("own")).repartition(3)
    found = hard_negatives.mine(frame, F.col("id") % every == 0, **options)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.select(*columns).collect()))


@pytest.mark.parametrize("sizes", [(4096, 512), (7, 3)])
def test_windows_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(hard_negatives, "ROWS", sizes[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", sizes[1])
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(4, 8)) * 60
    rows = [(i, int(label), [int(x) for x in centres[rng.integers(4)] + rng.normal(size=8) * 15]) for i, label in enumerate(rng.integers(0, 3, 260))]
    # ties: one vector for a third of all rows; two lengths; what takes no part
    rows += [(1000 + i, i % 2, [50] * 8) for i in range(130)]
    rows += [(2000 + i, i % 3, [3, i % 5]) for i in range(12)]
    rows += [(None, 1, [1] * 8), (3000, None, [1] * 8), (3010, 1, None), (3020, 1, [None] * 8), (3030, 0, [0] * 8)]
    want = plain_mine(rows, 10)
    assert want and mined(spark, rows, 10) == want
    assert mined(spark, rows, 10, positives=2, negatives=3, low=50, high=90) == plain_mine(rows, 10, 2, 3, 50, 90)


def test_repeated_rows_wide_numbers_and_empty_tables(spark):
    rows = [(0, 0, [3, 1]), (1, 0, [9, 9]), (2, 1, [9, 8]), (2, 1, [9, 8]), (3, 1, [8, 9]), (4, 0, [9, 9])]
    assert mined(spark, rows, 10) == plain_mine(rows, 10)
    wide = [(0, 0, [1 << 40, 1]), (1, 0, [1 << 21, 7]), (2, 1, [1 << 21, 6]), (3, 1, [1 << 21, 8]), (4, 1, [1 << 20, 8])]
    assert mined(spark, wide, 10) == plain_mine(wide, 10)
    huge = [(0, 0, [1 << 62, 1]), (1, 0, [1 << 62, 7]), (2, 1, [1 << 61, 6])]
    most = (1 << 63) - 1
    assert mined(spark, huge, 10) == [(0, 1, 1, 2, most, most)]
    assert mined(spark, [(0, 0, [1])], 10) == [] and mined(spark, [(5, 0, [1]), (6, 1, [1])], 10) == []
    empty = spark.createDataFrame([], "id long, label int, vector array<long>")
    assert hard_negatives.mine(empty, F.col("id") % 10 == 0).count() == 0
