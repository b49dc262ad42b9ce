"""Line rules, near-duplicates, components, graphs, archives and mixing against brute force, with the hard cases."""

import gzip
import hashlib
import io
import random
import re
import zipfile
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from calloom.llm import components, line_quality, mixing, queries, simhash, vamana, warc_zip

from tests.llm.conftest import HARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_queries_equal_their_sql(spark, name, sf):
    got = queries.QUERIES[name](spark, f"/root/testdata/{sf}")
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '/root/testdata/{sf}/{table}.parquet'")
    expected = con.sql(f"select {', '.join(got.columns)} from ({queries.ORACLES[name]})").fetchall()
    assert expected and plain(got.collect()) == plain(expected)


# --- line rules --------------------------------------------------------------------------------------------------------


def test_line_counts(hard, none):
    rows = line_quality.judge(hard).collect()
    assert len(rows) == len(HARD)
    for row in rows:
        text = row.text or ""
        found, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
        windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        times = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        counts = (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines) == counts
        assert row.n_repeat_words == len(covered) and row.rest == "own" and not row.kept
    assert line_quality.judge(none).count() == 0 and line_quality.clean(none).count() == 0


def test_line_rules(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    nav = "Home | News | Sport | Shop | Help |"
    texts = {
        1: good, 2: good + "\n" + nav, 3: nav * 20, 4: good + "\nAll rights reserved.", 5: good.replace(" ", "*** "),
        6: good[:-1].replace(" word9 ", " word9. "), 7: good[:-1], 8: good + "\r", 9: "\n\n" + good + "\n\n", 10: good.upper().replace(" ", "!! "),
    }
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    cleaned = {row.doc_id: row for row in line_quality.clean(docs).collect()}
    assert sorted(cleaned) == [1, 2, 4, 6, 8, 9]
    assert cleaned[2].text == good and cleaned[4].text == good and cleaned[2].n_chars == len(good)
    assert cleaned[9].text == texts[9]


# --- near-duplicates ---------------------------------------------------------------------------------------------------


def groups_of(prints, distance=4):
    fps = np.unique(np.array(prints, np.uint64))
    label = np.arange(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= distance):
            low, high = sorted((label[i], label[j]))
            label[label == high] = low
    return {int(fp): int(l) for fp, l in zip(fps, label)}


@pytest.mark.parametrize("small, chunk", [(32, 2048), (2, 4)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, small, chunk):
    monkeypatch.setattr(simhash, "SMALL", small)
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    random.seed(6)
    fps = []
    for _ in range(40):
        fp = random.getrandbits(64)
        for _ in range(random.choice([1, 2, 30])):
            fps.append(fp)
            for bit in random.sample(range(64), random.randint(0, 5)):
                fp ^= 1 << bit
    fps = sorted(set(fps))
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    linked = components.components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")))
    got = {row.node % (1 << 64): row.component for row in linked.collect()}
    label = groups_of(fps)
    mine = {}
    for fp in fps:
        mine.setdefault(label[fp], set()).add(got.get(fp, f"alone {fp}"))
    assert all(len(found) == 1 for found in mine.values()) and len(set().union(*mine.values())) == len(mine)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(205, 203), (203, 204), (204, 205)]
    edges += [(300, 300), (None, 5), (1, 2)]
    rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {row.component for row in rows if row.node < 100} == {1}
    assert {row.component for row in rows if 100 <= row.node < 200} == {100}
    assert {row.component for row in rows if row.node >= 200} == {203}
    assert len(rows) == len({row.node for row in rows}) == 60 + 60 + 3
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_hard_cases(hard, none, docs):
    rows = simhash.near_duplicates(hard).collect()
    assert len(rows) == len(HARD)
    assert {(row.fingerprint, row.component_id) for row in rows if row.doc_id in (1, 2, 3)} == {("0" * 16, 1)}
    assert sum(row.doc_id == 4 for row in rows) == 2
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(hard)
    assert kept.columns == hard.columns
    ids = sorted((row.doc_id for row in kept.collect()), key=repr)
    assert ids == sorted([1, 4, None, 5, 6, 7], key=repr)
    for row in simhash.near_duplicates(docs).join(docs, "doc_id").limit(40).collect():
        found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in row.text))
        hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + 4]), 42) for i in range(max(1, len(found) - 3))]
        bits = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
        assert row.fingerprint == f"{bits:016x}"


# --- nearest neighbours ------------------------------------------------------------------------------------------------


def brute(rows, query, k):
    vector = next(v for i, v in rows if i == query)
    others = [(float(np.sqrt(((np.array(v, float) - vector) ** 2).sum())), i) for i, v in rows if i != query]
    return sorted(others)[:k]


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    found: dict = {}
    for r in queries.op4_vamana(spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    hits = total = 0
    for query, got in found.items():
        best = brute(rows, query, 10)
        hits += len({i for _, i in best} & {i for *_, i in got})
        total += 10
        assert [r for r, *_ in sorted(got)] == list(range(1, 11)) and sorted(got) == sorted(got, key=lambda x: x[1:])
    assert len(found) == len(rows) // 100 and hits / total >= 0.9


def test_neighbours_hard_cases(spark):
    queries.prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(40 + i, [0.0, 1.0 + i]) for i in range(5)]
    bad = [(50, None), (51, [0.0, 0.0]), (52, [nan, 1.0]), (53, [inf, 1.0]), (54, [None, 1.0]), (55, []), (None, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "own") for r in [*rows, *bad]], "vec_id long, embedding array<float>, rank string")
    got = vamana.neighbours(frame, F.col("vec_id") % 10 == 0, 10)
    assert got.filter("query_id >= 50").count() == 0
    rows = [(i, np.array(v)) for i, v in rows]
    for query in (0, 10, 40):
        mine = [(r.score, r.vec_id) for r in got.filter(F.col("query_id") == query).orderBy("rank").collect()]
        assert mine == brute(rows, query, 10)
    assert vamana.neighbours(frame.limit(0), F.lit(True)).count() == 0
    few = vamana.neighbours(frame.filter("vec_id in (0, 40)"), F.lit(True)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(0, 1, 40), (40, 1, 0)]


def test_many_shards_find_what_one_finds(spark):
    random = np.random.default_rng(8)
    rows = [(i, random.normal(size=8).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = frame.filter("id < 20")
    got = vamana.search(vamana.build_index(frame, 11, shard_rows=100), asked, 10, block=4).collect()
    arrays = [(i, np.array(v)) for i, v in rows]
    hits = sum(r.vec_id in {i for _, i in brute(arrays, r.query_id, 10)} for r in got if r.vec_id != r.query_id)
    assert hits >= 0.9 * 20 * 9


def test_shards_and_ranges_are_dealt_to_tasks(spark):
    rows = spark.range(600).select("id", F.expr("transform(sequence(1, 4), x -> double(hash(id, x) % 1000))").alias("vector"))
    index = vamana.build_index(rows, 1, shard_rows=50)
    assert index.count() == 12 and len(index.inputFiles()) > 3
    page = spark.range(40).select(F.col("id").alias("key"), F.lit("u").alias("url"), F.expr("repeat(uuid(), 2000)").alias("html"))
    folder = f"{warc_zip.stage_folder(spark)}/packages-test"
    ranges = warc_zip.record_ranges(warc_zip.write_packages(page, folder, key="key"))
    for limit in (1, 1 << 20):  # every record by itself, and neighbours together
        read = warc_zip.Package(ranges.first()["package"])
        spans = list(read.record_ranges())
        old, warc_zip.REQUEST_BYTES = warc_zip.REQUEST_BYTES, limit
        assert list(read.ranges(spans)) == [read.range(*span) for span in spans]
        warc_zip.REQUEST_BYTES = old
        read.close()
    assert warc_zip.read_records(ranges, 5).select("key").distinct().count() == 40


# --- archives ----------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/", "x" * 200), (2, "http://b/?q=ü\n", "x" * 200), (3, None, "short"), (4, "http://c/", "short"),
    (5, "http://d/", None), (6, "http://e/", ""), (7, "http://f/", "é\r\n\r\nü" * 50), (7, "http://f/", "é\r\n\r\nü" * 50),
    (8, "http://g/", "é\r\n\r\nü" * 50), (None, "http://h/", "x" * 200), (9, "http://i/", "long " * 400_000),
]


def read_back(pages):
    columns = ("key", "url", "record_type", "refers_to", "declared_digest", "declared_bytes", "payload")
    return [tuple(row) for row in warc_zip.round_trip(pages).select(*columns).collect()]


@pytest.mark.parametrize("package_bytes", [1, 64 << 20])
def test_round_trip(spark, monkeypatch, package_bytes):
    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", package_bytes)
    pages = spark.createDataFrame([(*p, "own") for p in PAGES], "page_id long, url string, html string, record_type string")
    expected = []
    for key, url, html in PAGES:
        data = (html or "").encode()
        first = min(k for k, _, h in PAGES if k is not None and h == html)
        refers = first if key is not None and len(data) >= 100 and key > first else None
        kind = "response" if refers is None else "revisit"
        expected.append((key, url, kind, refers, hashlib.sha256(data).hexdigest(), len(data), None if refers else data))
    assert sorted(read_back(pages.repartition(3)), key=repr) == sorted(expected, key=repr)
    assert read_back(pages.limit(0)) == []


@pytest.mark.parametrize("limit", [None, 10])
@pytest.mark.parametrize("index", ["plain", "deflated", "none"])
def test_packages_of_another_writer(tmp_path, monkeypatch, limit, index):
    """ZIP64 fields (forced by a low limit), comments, bytes before the package, deflated and missing indexes."""
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 0)
    payloads = [f"page {i} ".encode() * 40_000 for i in range(3)]
    records = [gzip.compress(warc_zip.warc_record(i, "http://x/", p, hashlib.sha256(p).hexdigest())) for i, p in enumerate(payloads)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        package.writestr("datapackage.json", "{}")
        package.writestr("archive/data.warc.gz", b"".join(records), zipfile.ZIP_STORED)
        if index != "none":
            at = [sum(map(len, records[:i])) for i in range(3)]
            lines = "".join(f'k 1 {{"filename": "data.warc.gz", "offset": "{at[i]}", "length": "{len(r)}"}}\n' for i, r in enumerate(records))
            package.writestr("indexes/index.cdxj", lines, zipfile.ZIP_DEFLATED if index == "deflated" else zipfile.ZIP_STORED)
        package.comment = b"PK\x05\x06 in a comment" if not limit else b""
    path = tmp_path / "a.wacz"
    path.write_bytes((b"" if limit else b"before") + out.getvalue())
    read = warc_zip.Package(str(path))
    found = [warc_zip.parse_record(gzip.decompress(read.range(*span))) for span in read.record_ranges()]
    assert [(f["key"], f["payload"]) for f in found] == list(enumerate(payloads))


def test_what_is_no_package(tmp_path):
    path = tmp_path / "b.wacz"
    path.write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        warc_zip.Package(str(path))


# --- mixing ------------------------------------------------------------------------------------------------------------


def test_raking_meets_given_marginals(spark):
    rows = [("a", "en", "t", 900), ("a", "de", "u", 50), ("b", "en", "u", 30), ("b", "de", "t", 20), (None, "en", "t", 10)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.5, "absent": 3.0}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"t": 0.5, "u": 0.5}}
    raked = mixing.rake(cells, targets, sweeps=60)
    for name in mixing.DIMENSIONS:
        for row in raked.groupBy(name).agg(F.sum("weight").alias("w")).collect():
            assert row.w == pytest.approx(targets[name].get(row[0], 0.0), abs=1e-6)


def test_chances_spend_the_budget(spark):
    rows = [("a", "en", "t", 1000, 0.2), ("b", "en", "t", 10, 0.5), ("c", "en", "t", 90, 0.3), ("d", "en", "t", 0, 0.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long, weight double")
    got = {r.source: r.probability for r in mixing.calibrate(cells, 0.5).collect()}
    assert got["b"] == got["c"] == 1.0 and got["d"] == 0.0
    assert sum(t * got[s] for s, _, _, t, _ in rows) == pytest.approx(550)


def test_mixing_hard_cases(hard, none):
    rows = mixing.mix(mixing.measure(hard)).collect()
    assert len(rows) == len(HARD) and all(0 <= row.probability <= 1 and row.rest == "own" for row in rows)
    assert len({row.kept for row in rows if row.doc_id == 4}) == 1
    assert {row.n_tokens for row in rows if row.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(mixing.measure(none)).count() == 0


def test_native_plans_have_no_python(spark):
    for name in ("op3_line_quality", "op9_mixing"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_every_vector_length_is_indexed_and_searched(spark):
    rows = spark.range(1, 4200).select("id", F.expr("array_repeat(1.0D, int(id))").alias("vector"))
    assert vamana.build_index(rows, 1).count() == 4199
    pairs = spark.range(80).select("id", F.expr("array_repeat(1.0D + id % 2, int(id / 2) + 1)").alias("vector"))
    found = vamana.search(vamana.build_index(pairs, 2), pairs, 1).collect()
    assert sorted((row.query_id, row.vec_id) for row in found) == [(i, i ^ 1) for i in range(80)]
