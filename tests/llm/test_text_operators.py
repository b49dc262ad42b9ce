"""Encoding, counting, scoring, language and toxicity against brute force, with the defined hard cases."""

import math
import pickle
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from calloom.llm import bloom_lm, bpe_automaton, common, langid, token_counts, toxicity
from calloom.llm.queries import token_digests

from tests.llm.conftest import HARD, LONG


# --- BPE ---------------------------------------------------------------------------------------------------------------


def test_automaton_encodes_as_the_library(word_vocabulary):
    own, library = bpe_automaton.Tokenizer(open(word_vocabulary).read()), Tokenizer.from_file(word_vocabulary)
    random.seed(3)
    labels = [label.removesuffix("</w>") for label in own.labels.values()]
    marks = ["a", "aa", "aaa", "th", "'s", "!", "é", "日本", "\U0001f600", "1", "Σ", "İ", "ß", "́", " ", "\n", "\x1c",
             "　", "<|endoftext|>", "<|start", "'ll"]
    for i in range(4000):
        text = "".join(random.choice(marks if i % 2 else labels) for _ in range(random.randint(0, 10)))
        ids = np.frombuffer(own.packed(text), np.int32).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_merges_of_equal_symbols_go_from_the_left():
    merges = [("a", "a"), ("aa", "aa"), ("aa", "a</w>"), ("a", "a</w>")]
    vocab = {s: i for i, s in enumerate(["a", "a</w>", "aa", "aaaa", "aaa</w>", "aa</w>"])}
    automaton = bpe_automaton.MergeAutomaton(vocab, merges)
    names = {i: s for s, i in vocab.items()}
    assert [names[t] for t in automaton.encode("aaa")] == ["aaa</w>"]
    assert [names[t] for t in automaton.encode("aaaaa")] == ["aaaa", "a</w>"]
    assert not automaton.arc(vocab["a"], vocab["aa"]) and automaton.arc(vocab["aa"], vocab["a"])


def test_automaton_keeps_its_tables_bounded(word_vocabulary, monkeypatch):
    monkeypatch.setattr(bpe_automaton, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe_automaton, "KEPT_ARCS", 5)
    own, library = bpe_automaton.Tokenizer(open(word_vocabulary).read()), Tokenizer.from_file(word_vocabulary)
    text = " ".join(f"wordling{i} the" for i in range(40))
    assert np.frombuffer(own.packed(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.table) <= 5 and len(own.table.automaton.arcs) <= 5


def test_encode_and_decode_hard_cases(hard, none, word_vocabulary):
    library = Tokenizer.from_file(word_vocabulary)
    coded = bpe_automaton.decode(bpe_automaton.encode(hard, word_vocabulary), word_vocabulary)
    rows = coded.select("text", "ids", "decoded", "score").collect()
    assert len(rows) == len(HARD)
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False) and row.score == "own"
    assert bpe_automaton.encode(none, word_vocabulary).count() == 0


def test_a_word_is_encoded_once_whatever_stands_beside_it(word_vocabulary, monkeypatch):
    own, library = bpe_automaton.Tokenizer(open(word_vocabulary).read()), Tokenizer.from_file(word_vocabulary)
    encoded, encode = [], own.table.automaton.encode
    monkeypatch.setattr(own.table.automaton, "encode", lambda word: encoded.append(word) or encode(word))
    text = "wordling, (wordling) wordling's wordling!"
    assert np.frombuffer(own.packed(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoded.count("wordling") == 1


def test_round_trip_is_one_python_stage(spark, hard, none, word_vocabulary):
    library = Tokenizer.from_file(word_vocabulary)
    rows = bpe_automaton.round_trip(hard.withColumn("own_text", F.col("text")), word_vocabulary).collect()
    assert len(rows) == len(HARD)
    for row in rows:
        ids = library.encode(row.own_text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False) and row.score == "own"
    assert bpe_automaton.round_trip(none, word_vocabulary).count() == 0
    plan = token_digests(hard)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1, plan


# --- token counts ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [3, 1 << 17])
def test_token_counts(hard, none, docs, byte_vocabulary, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)
    library = Tokenizer.from_file(byte_vocabulary)
    count = lambda text: len(library.encode(text or "", add_special_tokens=False).ids)
    got = token_counts.count_tokens(hard.withColumn("copy", F.col("text")), byte_vocabulary)
    rows = got.select("copy", "n_tokens", "n_bytes", "over_limit", "rest").collect()
    assert len(rows) == len(HARD)
    for row in rows:
        assert row.n_tokens == count(row.copy) and row.over_limit == (row.n_tokens > 512) and row.rest == "own"
        assert row.n_bytes == len((row.copy or "").encode())
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in token_counts.count_tokens(docs.select("doc_id", "text"), byte_vocabulary).collect():
        assert row.n_tokens == count(texts[row.doc_id])
    assert token_counts.count_tokens(none, byte_vocabulary).count() == 0


def test_pretokens_split_as_the_library(byte_vocabulary):
    library = Tokenizer.from_file(byte_vocabulary).pre_tokenizer
    random.seed(4)
    marks = ["a", "é", "日本", "1", " ", "  ", "\n", "\t", "\x85", "\xa0", " ", "\x1c", "'s", "'ll", "!", "..", "Ⅷ", "́"]
    for _ in range(3000):
        text = "".join(random.choice(marks) for _ in range(random.randint(0, 12)))
        assert token_counts.PATTERN.findall(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


# --- LM ----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [3, 1 << 17])
def test_base_score_is_exact(hard, docs, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)
    every = docs.select("doc_id", "text").union(hard.select("doc_id", "text"))
    training = common.crc_bucket(F.col("doc_id"), 7) != 2
    rows = bloom_lm.score(every.withColumn("copy", F.col("text")), training).collect()
    words = lambda text: [*(text or "").encode().lower().split(), b"\n"]
    counts = Counter()
    for row in every.collect():
        if zlib.crc32(str("" if row.doc_id is None else row.doc_id).encode()) % 7 != 2:
            counts.update(words(row.text))
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == every.count()
    for row in rows:
        own = words(row.copy)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert math.isclose(row.base_score, base, rel_tol=1e-9) and row.score < 0


def test_filter_reads_counts_back(docs):
    model = bloom_lm.Model(docs)
    rows = model.vocabulary.collect()
    hashes = np.array([bloom_lm.xxhash.xxh64_intdigest(row.word) for row in rows], np.uint64)
    read = model.layout.levels(model.bits, bloom_lm.word_keys(hashes))
    true = bloom_lm.level_of(np.array([row.c for row in rows]))
    assert (read >= true).all() and (read == true).mean() > 0.97
    unseen = np.array([bloom_lm.xxhash.xxh64_intdigest(f"unseen {i}") for i in range(5000)], np.uint64)
    assert (model.layout.levels(model.bits, bloom_lm.word_keys(unseen)) > 0).mean() < 0.03


def test_model_predicts_better_than_its_base(docs):
    rows = bloom_lm.score(docs.select("doc_id", "text"), common.crc_bucket(F.col("doc_id"), 7) != 2).collect()
    assert sum(row.score for row in rows) > sum(row.base_score for row in rows)


def test_lm_without_training_rows(hard, none):
    assert {row.n_known for row in bloom_lm.score(hard, F.lit(False)).collect()} == {0}
    assert bloom_lm.score(none, F.lit(True)).count() == 0


def test_lm_with_many_segments(docs, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SEGMENT_TOKENS", 1 << 10)
    model = bloom_lm.Model(docs)
    assert model.layout.segments >= 32
    top = model.vocabulary.orderBy(F.desc("c")).limit(50).collect()
    hashes = np.array([bloom_lm.xxhash.xxh64_intdigest(row.word) for row in top], np.uint64)
    read = model.layout.levels(model.bits, bloom_lm.word_keys(hashes))
    assert (read >= bloom_lm.level_of(np.array([row.c for row in top]))).all()


# --- language ID -------------------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = common.crc_bucket(F.col("doc_id"), 4) == 2
    rows = langid.predict(docs.filter(held), langid.fit(docs.filter(~held))).collect()
    assert np.mean([row.lang == row.lang_pred for row in rows]) > 0.97
    assert np.mean([row.accepted for row in rows]) > 0.97


def test_language_hard_cases(hard, none, docs):
    model = langid.fit(docs)
    rows = langid.predict(hard, model).collect()
    assert len(rows) == len(HARD)
    for row in rows:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
        assert letters or not row.accepted
    assert next(row for row in rows if row.text == LONG).lang_pred == "de"
    assert {row.lang_pred for row in langid.predict(hard, langid.fit(none)).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0
    one = langid.predict(hard, langid.fit(docs.filter("lang = 'en'"))).collect()
    assert {row.lang_pred for row in one} == {"und", "en"}


def test_repeated_ids_do_not_widen_the_sample(docs, monkeypatch):
    monkeypatch.setattr(langid, "MAX_DOCS", 8)
    langid.fit(docs.withColumn("doc_id", F.lit(1)))


def test_pairs_seen_once_are_known(spark):
    docs = spark.createDataFrame([(i, f"w{i} x{i}") for i in range(300)], "doc_id long, text string")
    model = bloom_lm.Model(docs)
    hashes = lambda mark: np.array([bloom_lm.xxhash.xxh64_intdigest(f"{mark}{i}") for i in range(300)], np.uint64)
    seen = model.layout.levels(model.bits, bloom_lm.pair_keys(hashes("w"), hashes("x")))
    unseen = model.layout.levels(model.bits, bloom_lm.pair_keys(hashes("x"), hashes("w")))
    assert (seen >= 1).all() and (seen == 1).mean() > 0.95 and (unseen > 0).mean() < 0.05


def test_filter_left_in_segments_scores_the_same(spark, docs, hard, none, monkeypatch):
    """A filter too large for a broadcast is probed by joins; the results are those of the broadcast one."""
    training = common.crc_bucket(F.col("doc_id"), 7) != 2
    monkeypatch.setattr(bloom_lm, "SEGMENT_TOKENS", 1 << 10)
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens"]
    for given in (docs.select("doc_id", "text"), hard):
        made = []
        for limit in (1 << 25, 0):
            monkeypatch.setattr(bloom_lm, "BROADCAST_BYTES", limit)
            model = bloom_lm.Model(given.filter(training))
            assert (model.bits is None) == (limit == 0)
            rows = model.score(given).collect()
            made.append(sorted(([str(row[c]) for c in columns], row.base_score, row.score) for row in rows))
        assert [row[0] for row in made[0]] == [row[0] for row in made[1]]
        for i in (1, 2):
            assert np.allclose([row[i] for row in made[0]], [row[i] for row in made[1]], atol=1e-9)
    assert bloom_lm.score(none, F.lit(True)).count() == 0


def test_parts_count_and_probe_in_one_shuffle(spark, docs, hard, monkeypatch):
    """Scores of texts that carry their own counts are those of a model made apart; keys are neither staged nor sent whole."""
    training = common.crc_bucket(F.col("doc_id"), 7) != 2
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    monkeypatch.setattr(bloom_lm, "SEGMENT_TOKENS", 1 << 10)
    for given, tokens in ((docs.select("doc_id", "text").repartition(3), 1 << 8), (docs.select("doc_id", "text"), 1 << 21), (hard, 1)):
        monkeypatch.setattr(bloom_lm, "PART_TOKENS", tokens)
        rows = [
            sorted((str(r.doc_id), *map(float, r[1:])) for r in made.select(columns).collect())
            for made in (bloom_lm.score(given, training), bloom_lm.Model(given.filter(training)).score(given))
        ]
        assert [r[:4] for r in rows[0]] == [r[:4] for r in rows[1]]
        assert np.allclose([r[4:] for r in rows[0]], [r[4:] for r in rows[1]], atol=1e-9)
    monkeypatch.setattr(bloom_lm, "PART_TOKENS", 1 << 21)
    staged = []
    monkeypatch.setattr(bloom_lm, "stage", lambda df: staged.append(df.persist()) or staged[-1])
    total = bloom_lm.score(docs.select("doc_id", "text"), training).agg(F.sum("n_tokens")).first()[0]
    texts = next(df for df in staged if "__words" in df.columns)
    packed = sum(F.octet_length(c) for c in ("__words", "__names", "__flags"))
    assert "__keys" not in texts.columns and texts.agg(F.sum(packed)).first()[0] < 6 * total
    for df in staged:
        df.unpersist()


def test_scores_equal_brute_force(spark):
    random.seed(11)
    texts = [" ".join(random.choices([f"w{i}" for i in range(60)], range(1, 61), k=i % 12)) for i in range(300)]
    docs = spark.createDataFrame([*enumerate(texts), (300, "unseen w1 w2")], "doc_id long, text string").repartition(4)
    words, pairs = Counter(), Counter()
    sequence = lambda text: ["\n", *text.split(), "\n"]
    for i, text in enumerate(texts):
        if i % 5:
            own = sequence(text)
            words.update(own[1:])
            pairs.update(zip(own, own[1:]))
    read = lambda c: 2.0 ** (c.bit_length() - 0.5) if c > 1 else float(c)
    total = sum(map(read, words.values())) + len(words) + 1
    equal = 0
    rows = bloom_lm.score(docs.withColumn("own", F.col("text")), F.expr("doc_id % 5 > 0 and doc_id < 300")).collect()
    for row in rows:
        own, expected = sequence(row.own), 0.0
        for v, w in zip(own, own[1:]):
            mix = bloom_lm.MIX if words[v] else 0.0
            expected += math.log10(mix * min(1.0, read(pairs[v, w]) / max(read(words[v]), 1)) + (1 - mix) * (read(words[w]) + 1) / total)
        equal += math.isclose(row.score, expected, rel_tol=1e-9)
    assert len(rows) == 301 and equal > 0.9 * len(rows)


def test_numbers_are_squeezed_and_read_back():
    for values in ([], [0, 0], [1, 255, 256, 3], [2**64 - 1, 0], list(range(5000))):
        values = np.array(values, np.uint64)
        assert (bloom_lm.unsqueezed(bloom_lm.squeezed(values)) == values).all()
    layout = bloom_lm.Filter(16)
    keys = np.unique(layout.kept(np.random.default_rng(3).integers(0, 2**64, 50_000, np.uint64)))
    rows = [row for batch in bloom_lm._rows(keys, np.ones(len(keys), np.int64), 7, layout) for row in batch.to_pylist()]
    assert (np.concatenate([bloom_lm._keys(row["keys"], layout) for row in rows]) == keys).all() and len(rows) == 16
    assert sum(len(row["keys"]) + len(row["counts"]) for row in rows) < 4.5 * len(keys)


# --- toxicity ----------------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = common.crc_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs.filter(~held), labels.filter(~held))
    rows = toxicity.predict(docs.filter(held), model).join(labels, "doc_id").collect()
    assert np.mean([row.predicted == row.toxic for row in rows]) > 0.93
    assert not any(row.predicted for row in rows if not row.toxic)


def test_nearest_examples_are_exact():
    random = np.random.default_rng(5)
    vectors = []
    for _ in range(700):
        terms = np.sort(random.choice(40, random.integers(0, 6), replace=False))
        weights = random.random(len(terms)).round(1) + 0.1
        vectors.append((terms, weights / (np.linalg.norm(weights) or 1)))
    keys = random.permutation(700)
    index = toxicity.BlockMaxIndex(keys, np.zeros(700, np.int64), vectors, 40)
    dense = np.zeros((700, 40))
    for row, (terms, weights) in enumerate(vectors):
        dense[row, terms] = weights
    for terms, weights in vectors[:60]:
        query = np.zeros(40)
        query[terms] = weights
        cosines = np.minimum(np.round(dense @ query, 12), 1)
        order = [i for i in np.lexsort((keys, -cosines)) if cosines[i] > 0][:10]
        found, values = index.nearest(terms, weights, 10)
        assert np.allclose(values, cosines[order], atol=1e-11)
        assert [round(cosines[i], 10) for i in found] == [round(cosines[i], 10) for i in order]


def test_votes_need_neither_the_words_nor_copies_of_the_vectors():
    random, n, size, n_terms = np.random.default_rng(6), 4000, 100, 50_000
    model = toxicity.Model(0.1)
    model.named = {f"term{i}": i for i in range(n_terms)}
    model.n_docs, model.n_terms, model.idf = 9000, n_terms, random.random(n_terms) + 1
    terms = np.concatenate([random.choice(n_terms, size, replace=False) for _ in range(n)]).astype(np.int32)
    spans, times = np.arange(n + 1, dtype=np.int32) * size, random.integers(1, 5, n * size).astype(np.int32)
    model.pack(np.arange(n), np.zeros(n, np.int64), spans, terms, times)
    own = pickle.loads(pickle.dumps(model))
    tracemalloc.start()
    index = own.index
    peak = tracemalloc.get_traced_memory()[1] - index.dense.nbytes - index.single.nbytes
    tracemalloc.stop()
    assert isinstance(own.named, str) and peak < 70 * n * size, peak / n / size
    weights = (1 + np.log(times)) * model.idf[terms]
    vectors = [(terms[a : a + size].astype(np.int64), w / np.linalg.norm(w)) for a in range(0, n * size, size) for w in [weights[a : a + size]]]
    plain = toxicity.BlockMaxIndex(np.arange(n), np.zeros(n, np.int64), vectors, n_terms)
    for name in ("examples", "weights", "blocks", "starts", "maxima", "entries", "dense", "rows"):
        assert np.array_equal(getattr(index, name), getattr(plain, name)), name
    assert own.numbers == model.numbers


def test_search_reads_only_blocks_that_can_hold_the_nearest(monkeypatch):
    monkeypatch.setattr(toxicity, "DENSE", 80)
    monkeypatch.setattr(toxicity, "BLOCK", 32)
    monkeypatch.setattr(toxicity, "STRIPE", 16)
    monkeypatch.setattr(toxicity, "SHORT", 20)
    random, n, n_terms = np.random.default_rng(8), 640, 300
    vectors = []
    for i in range(n):
        # two languages that share few terms, in one half of the examples each
        first = 0 if i < n // 2 else 150
        terms = np.unique(np.r_[first + random.integers(0, 60, 25), first + random.integers(60, 150, 6), random.integers(0, n_terms, 4)])
        weights = random.random(len(terms)).round(1) + 0.1
        vectors.append((terms, weights / np.linalg.norm(weights)))
    keys = random.permutation(n)
    index = toxicity.BlockMaxIndex(keys, np.zeros(n, np.int64), vectors, n_terms)
    assert len(index.maxima) and (np.diff(index.entries)[index.rows < 0] <= 20).any()
    dense = np.zeros((n, n_terms))
    for row, (terms, weights) in enumerate(vectors):
        dense[row, terms] = weights
    whole = 0
    for without in (-1, 3, 500):
        for i, (terms, weights) in enumerate(vectors[::7]):
            cosines = np.minimum(np.round(dense @ dense[i * 7], 12), 1)
            cosines[np.arange(n) == without] = 0
            order = [j for j in np.lexsort((keys, -cosines)) if cosines[j] > 0][:10]
            found, values = index.nearest(terms, weights, 10, without)
            assert np.allclose(values, cosines[order], atol=1e-11) and np.allclose(cosines[found], cosines[order], atol=1e-11)
            sums = index._sums(terms, weights, index.frequent([(terms, weights)])[0], 10, without)
            whole += np.mean(np.abs(sums - cosines) < 1e-4)
    # an example whose block was not read lacks what its long terms add
    assert whole < 3 * len(vectors[::7]) - 5
    assert not index.query.any()


def test_words_and_held_terms_are_those_of_the_plain_rules():
    for text in ("", "Ab-c_d 9x\x00Y\x1fz 'tis", "Größe, İstanbul ΑΣ und Ab", "日本 a1b\u0301c \x85x", "K\u212a"):
        assert toxicity.letter_words(text) == toxicity.LETTERS.findall(text.lower())
    held, plain = toxicity.HeldTerms(), Counter()
    for text in ("idiotic idiots and idiotically", "an idiot, idiotic", "", "andante and and"):
        held.add(text)
        counts = Counter()
        for word in toxicity.LETTERS.findall(text):
            counts.update(toxicity.word_bases(word))
        plain.update({term for base, n in counts.items() for least, term in toxicity.base_terms(base) if n >= least})
    assert held.totals() == plain


def test_toxicity_hard_cases(spark, hard, none):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    for given, share in (([], 0.0), ([(4, 0), (5, 0)], 0.0), ([(4, 1), (5, None), (None, None)], 1.0)):
        rows = toxicity.predict(hard, toxicity.fit(hard, labels(given))).collect()
        assert len(rows) == len(HARD) and {row.score for row in rows} == {share}
    texts = [(i, f"you idiotic one, go away {i}" if i % 2 else f"a fine day {i}") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.fit(docs, labels([(i, i % 2) for i in range(200)]))
    assert model.score("what idiotnd is this")[0] > 0.5 > model.score("a fine day")[0]
    rows = toxicity.predict(hard, model).collect()
    assert len(rows) == len(HARD) and all(0 <= row.score <= 1 and row.rest == "own" for row in rows)
    assert toxicity.predict(none, model).count() == 0


def test_toxicity_of_whole_texts(spark):
    """Every text with words finds its nearest example by all its words, whether or not any of them leans toxic."""
    texts = [(i, f"you idiotic one, {'abcdefghij'[i // 20]}x {'klmnopqrst'[i % 20 // 2]}y" if i % 2 else f"a day {i} alpha {chr(97 + i % 26) * 3}") for i in range(200)]
    texts += [(500, "seven quiet rivers"), (501, "Seven quiet rivers"), (502, "quiet unseen words in here")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([*((i, i % 2) for i in range(200)), (500, 0)], "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.predict(docs, toxicity.fit(docs, labels)).collect()}
    for i in (500, 501):
        assert (rows[i].neighbours, rows[i].cosines) == ([500], [1.0])
    # frequencies over all 203 documents, those outside the sample among them
    idf = {w: math.log1p(203 / n) for w, n in (("seven", 2), ("quiet", 3), ("rivers", 2), ("unseen", 1))}
    lengths = [math.sqrt(idf["seven"] ** 2 + idf["quiet"] ** 2 + idf["rivers"] ** 2), math.sqrt(idf["quiet"] ** 2 + 4 * idf["unseen"] ** 2)]
    assert rows[502].neighbours == [500]
    assert rows[502].cosines[0] == pytest.approx(idf["quiet"] ** 2 / (lengths[0] * lengths[1]), abs=1e-9)
