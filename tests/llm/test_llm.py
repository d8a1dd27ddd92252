"""Corpus operators against brute force, and their edge cases."""

import base64
import hashlib
import io
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from granary.llm import components, langid, mixing, packing, quality_rules, queries, simhash, suffix_dedup, topk, toxicity, url_filter, warc

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
SENTENCE = "the cat of the house sat with a hat on the mat and was in no way amused by that"
LONG = " ".join(f"w{i % 977} the" for i in range(30_000))
#: Nulls, empty and long texts, ties, repeated rows, and columns whose names the
#: operators also use.
ROWS = [
    (1, SENTENCE * 4, "en", "a", 1), (2, SENTENCE * 4, "en", "a", 2), (2, SENTENCE * 4, "en", "a", 2), (3, None, None, None, None), (4, "", "en", "b", 0), (None, "no id here, " + SENTENCE, "en", None, 9),
    (5, LONG, "en", "b", 5), (6, " \n\t ", "de", "a", 3), (7, "der die das und ist von mit zu den ein " * 8, "de", "b", 7), (8, "x\u0000y \u00e9\u00e8 \U0001f600 ###", None, "c", 8), (9, SENTENCE * 4 + " but", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, size long"
CLASH = ["h", "rid", "row", "fp", "key", "batch", "n", "w", "t", "score", "target", "held_out", "whole", "cut", "rest", "node", "u"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *(F.lit(1).alias(c) for c in CLASH)).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def folder(spark, tmp_path, docs, labels=None):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = labels if labels is not None else [(1, 0, 0), (7, 0, 1), (None, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["op1_simhash", "op3_quality_rules", "op4_packing", "op6_langid", "op7_toxicity", "op8_suffix_dedup", "op10_mixing"])
def test_document_queries_on_hard_and_empty_tables(spark, docs, empty, tmp_path, name):
    got = queries.QUERIES[name](spark, folder(spark, tmp_path / "a", docs)).collect()
    if name == "op4_packing":
        assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r[0] for r in ROWS)
    else:
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ROWS)
    assert queries.QUERIES[name](spark, folder(spark, tmp_path / "b", empty, [])).count() == 0


def test_pipeline_on_hard_and_empty_tables(spark, docs, empty, tmp_path):
    import corpus_pipeline

    for i, d in enumerate((docs, empty)):
        sf = folder(spark, tmp_path / str(i), d)
        held = spark.read.parquet(f"{sf}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, held, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == held.columns
            out.write.parquet(f"{sf}/{name}")
            held = spark.read.parquet(f"{sf}/{name}")
        assert (held.count() > 0) == (i == 0)


@needs_data
def test_pipeline_against_brute_force(spark):
    """Every stage of a whole run, on what the stage before it kept."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    held = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        held.append(spark.createDataFrame(stage(spark, held[-1], DATA).collect(), stage(spark, held[-1], DATA).schema))
    start, clean, single, cut, mixed, packed = (h.collect() for h in held)
    flagged = {r.doc_id for r in toxicity.query(spark, DATA).collect() if r.predicted}
    assert flagged and {r.doc_id for r in clean} == {r.doc_id for r in start} - flagged
    clean.sort(key=lambda r: r.doc_id)
    sets = [word_shingles(r.text) for r in clean]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert pairs and {r.doc_id for r in single} == {clean[i].doc_id for i in roots(len(clean), pairs)}
    left = {r[0]: r[1] - r[2] for r in brute_removed([(r.doc_id, (r.text or "").encode()) for r in single])}
    got = {r.doc_id: len(r.text.encode()) for r in cut}
    # Bytes of characters that are cut apart go, too: at most three at either side.
    assert got.keys() == left.keys() and all(0 <= left[i] - n <= 6 * (left[i] != len(next(r.text for r in single if r.doc_id == i).encode())) * 50 for i, n in got.items())
    words = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in cut}
    times, size, taken = Counter(r.doc_id for r in mixed), Counter(), Counter()
    for i, (source, n) in words.items():
        size[source] += n
        taken[source] += n * times[i]
    assert max(times.values()) <= 2 and {r.doc_id: r.text for r in mixed}.items() <= {r.doc_id: r.text for r in cut}.items()
    order = sorted(size, key=lambda x: (x is None, x or ""))
    want = brute_targets([size[x] for x in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(size.values()))
    assert all(abs(taken[x] - t) <= max(n for _, n in words.values()) for x, t in zip(order, want))
    tk = Tokenizer.from_file(packing.tokenizer_path())
    ids = {r.doc_id: len(tk.encode(r.text, add_special_tokens=False).ids) + 1 for r in cut}
    assert sum(r.length for r in packed) == sum(ids[i] * n for i, n in times.items())
    whole_sequences(packed)


def whole_sequences(rows):
    """Offsets are gapless from 0 and no sequence is above 1,024; returns how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto and length > 0
            upto += length
        assert upto <= 1024
    return len(by)


def test_scratch_tables_go(spark, docs):
    from granary.llm import common

    def names():
        return {x.split("-")[1] for x in os.listdir(common.shared_dir(spark).removeprefix("file:")) if x.startswith("granary-")}

    folder = common.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = simhash.deduplicated(docs)
    assert {x.split("-")[1] for x in set(os.listdir(folder)) - before} == {"texts", "gone"} and out.count() > 0
    before = set(os.listdir(folder))
    with pytest.raises(ZeroDivisionError), common.scratch():
        common.written(spark.range(3), "x")
        1 / 0
    assert set(os.listdir(folder)) == before and names()


# ---- 1 simhash --------------------------------------------------------------


def brute_fp(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def word_shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def roots(n, pairs):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint():
    for text in [None, "", "a", "A b C", "a b c d", "a b c d e " * 50, LONG[:3000], "ÀB \x0b x", "x\x85y z q r"]:
        assert simhash.fingerprint(text) == brute_fp(text)


@pytest.mark.parametrize("tree,deep", [(3, 16), (3, 1), (1024, 16)])
def test_links_find_every_component(spark, monkeypatch, tree, deep):
    monkeypatch.setattr(simhash, "DEEP", deep)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flip = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(6)]
    fps = list(dict.fromkeys(flip))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    got = components.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tree=tree)).collect()
    group = {r.node: r.root for r in got}
    want = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    mine = [group.get(x, x) for x in signed]
    assert len(set(zip(want, mine))) == len(set(want)) == len(set(mine))


def test_no_group_holds_a_hot_shard(spark):
    """8,000 fingerprints that agree in one half of their bits, and 3,000 within
    four bits of one another: no group of more than two trees."""
    rng = np.random.default_rng(3)
    near = {sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(9000)}
    half = {int(x) << 32 for x in rng.integers(0, 1 << 31, 8000)}
    df = spark.createDataFrame([(x,) for x in np.array(sorted(near | half), np.uint64).view(np.int64).tolist()], "fp long")
    sizes = simhash.groups(df, tree=256).groupBy("key", "chunk").agg(F.count("*").alias("n"), F.count_if("node").alias("nodes")).agg(F.max("n"), F.max("nodes")).head()
    assert sizes[0] <= 512 and sizes[1] <= 256


def test_query_against_brute_force(spark, tmp_path):
    """Fingerprints, links and the smallest doc_id reachable, of a whole table."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()] if os.path.isdir(DATA) else []
    rows += [(1000 + i, t) for i, t in enumerate([None, "", " ", "a b", "A  B", SENTENCE, SENTENCE.upper() + " ", LONG])] + [(5000, SENTENCE), (4999, SENTENCE), (4999, SENTENCE)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.query(spark, str(tmp_path)).collect())
    fps = [brute_fp(t) for _, t in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(i, least.get(r, i))
    assert got == Counter((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fps, root))


def test_bk_tree_search():
    rng = np.random.default_rng(2)
    values = [int(x) for x in rng.integers(0, 1 << 16, 300, dtype=np.uint64)]
    tree = simhash.BKTree(values)
    for at, edges in enumerate(tree.children):
        for d, child in edges.items():
            assert (tree.values[at] ^ tree.values[child]).bit_count() == d
    queries_ = np.array(values[:50], np.uint64)
    got = sorted((n, q) for n, rows in tree.search(queries_, 3) for q in rows.tolist())
    assert got == sorted((n, q) for n in range(300) for q in range(50) if (values[n] ^ values[q]).bit_count() <= 3)


@needs_data
def test_near_copies_are_the_similar_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    sets = [word_shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = {rows[r][0] for r in roots(len(rows), pairs)}
    assert {r.doc_id for r in simhash.deduplicated(docs).collect()} == want


def test_near_copies_that_only_the_first_text_links(spark, monkeypatch):
    """Copies that are at 0.8 with one text but not with each other, in small blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(8)
    texts = []
    for group in range(2):
        first = [f"g{group}w{i}" for i in range(200)]
        for copy in range(25):
            words = list(first)
            for at in rng.choice(np.arange(5, 195, 10), 4, replace=False) if copy != 12 else ():
                words[at] = f"x{group}c{copy}a{at}"
            texts.append(" ".join(words))
    sets = [word_shingles(t) for t in texts]
    pairs = [(i, j) for i in range(50) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = set(roots(50, pairs))
    assert len(want) == 2 and len(pairs) < 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.deduplicated(docs).collect()} == want


def test_near_copies_of_short_and_long_texts(spark):
    """Pairs at just over and just under 0.8, of which few share a sketch's bands
    where texts are short, against all pairs."""
    rng = np.random.default_rng(9)
    texts = ["", " ", "a b", "a B ", "a c"]
    for n in [5, 6, 9, 10, 14, 20, 31, 40, 60, 100, 250]:
        for copy in range(12):
            words = [f"v{i}" for i in rng.integers(0, 4000, n + 4)]
            cut = int(n * 0.2 + 1e-9) + copy % 4 // 3
            texts += [" ".join(words), " ".join(words[: len(words) - cut] if copy % 2 else words[cut:])]
    sets = [word_shingles(t) for t in texts]
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = set(roots(len(texts), alike))
    assert 20 < len(texts) - len(want) < len(texts) // 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in simhash.deduplicated(docs).collect()} == want


def test_near_copies_do_not_hang_on_fingerprint_links(spark, monkeypatch):
    """Of fingerprints only a forest's links are tested at 0.8; texts at 0.8 link
    without any of them."""
    monkeypatch.setattr(simhash, "links", lambda fps, radius: fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0))
    rng = np.random.default_rng(11)
    texts = []
    for _ in range(60):
        words = [f"v{i}" for i in rng.integers(0, 4000, 9)]
        texts += [" ".join(words), " ".join(words[:8]), " ".join(words[1:])]
    sets = [word_shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.deduplicated(docs).collect()} == set(roots(len(texts), pairs))


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_prefixes_and_ranks_lose_no_similar_pair(similarity):
    rng = np.random.default_rng(10)
    kinds = np.sort(rng.choice(1 << 62, 900, replace=False).astype(np.uint64))
    often = np.where(np.arange(900) % 3, rng.integers(8, 60, 900), 0).astype(np.uint8)
    hits = 0
    for _ in range(2000):
        x = np.unique(rng.choice(900, int(rng.integers(1, 90))))
        y = np.unique(np.concatenate([rng.permutation(x)[int(rng.integers(0, 2 + len(x) // 3)) :], rng.choice(900, int(rng.integers(0, 2 + len(x) // 5)))]))
        seen = np.where(np.isin(np.arange(900), np.intersect1d(x, y)), np.maximum(often, 8), often)
        at, doc, rank = simhash.prefixes(np.concatenate([x, y]), np.array([len(x), len(y)]), seen, kinds, similarity)
        common = len(np.intersect1d(x, y))
        if common >= similarity * (len(x) + len(y) - common):
            hits += 1
            of = np.concatenate([x, y])[at]
            shared = np.intersect1d(of[doc == 0], of[doc == 1])
            assert len(shared)
            # At the first shared key the ranks leave room for all common hashes.
            room = [min(len(x) - rank[doc == 0][of[doc == 0] == k][0], len(y) - rank[doc == 1][of[doc == 1] == k][0]) for k in shared]
            assert max(room) >= common >= simhash.overlap_needed(len(x) + len(y), similarity)
    assert hits > 20


def test_shingles_of_joined_texts(monkeypatch):
    """Equal words have equal hashes wherever they stand, whatever the slices."""
    monkeypatch.setattr(simhash, "_SLICE", 7)
    texts = ["a b c d e f", "", "  ", "A b\tc d e\u00e9 f", "f", "longer-than-a-slice x", "f longer-than-a-slice", "b c d e f a", "x" * 40]
    raw = [t.encode() for t in texts]
    lens = np.array([len(r) for r in raw])
    text = np.frombuffer(b"".join(raw), np.uint8)
    h, doc = simhash.word_hashes(text, lens)
    words = [w for t in texts for w in t.lower().split()]
    assert len(words) == len(h) and [texts[d].lower().split() for d in sorted(set(doc.tolist()))] == [t.lower().split() for t in texts if t.split()]
    assert len({(w, x) for w, x in zip(words, h.tolist())}) == len(set(words)) == len(set(h.tolist()))
    kinds, of, size = simhash.token_sets(text, lens, 2)
    want = [word_shingles(t, 2) for t in texts]
    assert size.tolist() == [len(w) for w in want] and len(kinds) == len(set().union(*want))
    ends = np.cumsum(size)
    got = [set(of[b - n : b].tolist()) for b, n in zip(ends.tolist(), size.tolist())]
    assert all(len(got[i] & got[j]) == len(want[i] & want[j]) for i in range(len(texts)) for j in range(len(texts)))


def test_components_of_a_chain(spark):
    got = components.components(spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 3)], "a long, b long")).collect()
    assert {r.node: r.root for r in got} == dict.fromkeys(range(61), 0)


# ---- 2 warc -----------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nv", None), (4, "b", ""), (None, "q", "<p>x</p>"), (5, "c", "é" * 300_000), (5, "c", "other"), (9, "z", "\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(3)
    archives = warc.write_archives(df)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(archives).collect())
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        b, revisit = (h or "").encode(), i != first[h or ""]
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None] += 1
    assert got == want
    for name in warc.export(archives, str(tmp_path)):
        data = (tmp_path / name).read_bytes()
        assert [h["WARC-Type"] for h, _ in warc.Reader(io.BytesIO(data))]
        with pytest.raises(ValueError):
            list(warc.Reader(io.BytesIO(data[:-9])))
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_warc_reader_rejects_a_wrong_digest():
    good = warc.record(1, "u", b"payload", None)
    raw = zlib.decompress(good, 31)
    bad = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError, match="digest"):
        list(warc.Reader(io.BytesIO(bad.compress(raw.replace(b"\r\n\r\npayload", b"\r\n\r\npayloaX")) + bad.flush())))


def foreign(*records):
    """A gzip member for each (headers, block), written as others write them."""
    out = b""
    for headers, block in records:
        z = zlib.compressobj(9, zlib.DEFLATED, 31)
        out += z.compress(b"WARC/1.0\r\n" + headers + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()
    return out


def test_warc_reader_reads_other_writers_archives(spark):
    """Optional digests, any case of names, folded and unknown fields, records
    without HTTP, hex digests, other identifiers."""
    body = "\u00e9".encode() * 200_000
    http = b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n" + body
    data = foreign(
        (b"warc-type: warcinfo\r\nCONTENT-LENGTH:  5\r\nContent-Type: application/warc-fields", b"a: b\n"),
        (b"WARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nX-Long: one\r\n\t two\r\nContent-Type: Application/HTTP;msgtype=response\r\nWARC-Payload-Digest: sha256:" + hashlib.sha256(body).hexdigest().encode() + b"\r\nContent-Length: %d" % len(http), http),
        (b"WARC-Type: revisit\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:ABC\r\nWARC-Refers-To: <urn:uuid:1>\r\nContent-Length: 19", b"HTTP/1.0 200 OK\r\n\r\n"),
        (b"WARC-Type: resource\r\nWARC-Block-Digest: blake3:xyz\r\nContent-Length: 0", b""),
    )
    got = list(warc.Reader(io.BytesIO(data)))
    assert [h["WARC-TYPE"] for h, _ in got] == ["warcinfo", "response", "revisit", "resource"]
    assert [p for _, p in got] == [b"a: b\n", body, b"", b""] and got[1][0]["x-long"] == "one two"
    rows = warc.read_archives(spark.createDataFrame([(data,), (b"",)], "data binary")).collect()
    assert [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows] == [(None, 5, "warcinfo", None), (None, len(body), "response", None), (None, None, "revisit", None), (None, 0, "resource", None)]


@pytest.mark.parametrize("headers,block", [(b"WARC-Type: a", b""), (b"Content-Length: x", b""), (b"Content-Length: -1", b""), (b"Content-Length: 3", b"four"), (b"Content-Length: 9", b"four"), (b"no colon\r\nContent-Length: 0", b""), (b"Content-Length: 1\r\nWARC-Block-Digest: sha1:AAAA", b"x"), (b"X: " + b"y" * (3 << 20), b"")])
def test_warc_reader_raises_only_value_errors(headers, block):
    data = foreign((headers, block))
    with pytest.raises(ValueError):
        list(warc.Reader(io.BytesIO(data)))


def test_warc_reader_on_damaged_bytes():
    data = warc.record(1, "u", b"payload" * 99, None) + warc.record(2, "u", b"", 1)
    rng = np.random.default_rng(6)
    for _ in range(300):
        raw = bytearray(data[: int(rng.integers(1, len(data)))] if rng.random() < 0.5 else data)
        for at in rng.integers(0, len(raw), int(rng.integers(0, 4))):
            raw[at] ^= int(rng.integers(1, 256))
        try:
            list(warc.Reader(io.BytesIO(bytes(raw))))
        except ValueError:
            pass
    for junk in (b"junk", b"\x1f\x8b\x08", data + b"tail"):
        with pytest.raises(ValueError):
            list(warc.Reader(io.BytesIO(junk)))


def test_revisits_are_held_against_their_response(spark):
    good = [(1, 5, "D", "response", None, "u"), (2, 5, "D", "revisit", 1, "u"), (2, 5, "D", "revisit", 1, "u")]
    assert warc.verified(spark.createDataFrame(good, warc.RECORDS)).count() == 3
    for bad in ((3, 6, "D", "revisit", 1, "u"), (3, 5, "E", "revisit", 1, "u"), (3, 5, "D", "revisit", 2, "u")):
        with pytest.raises(ValueError, match="refers to page"):
            warc.verified(spark.createDataFrame([*good, bad], warc.RECORDS))


# ---- 3 quality --------------------------------------------------------------


def test_quality_of_very_many_words(spark):
    """One rule of equality whatever the number of words: above 2^20 of them."""
    n = (1 << 20) + 5000
    rows = [(1, " ".join(f"{i:x}" for i in range(n))), (2, " ".join(f"{i % 700_000:x}" for i in range(n))), (3, "a b a b a b"), (4, "a b c a b d a b c")]
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in quality_rules.judge_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (n, 0), 2: (n, 2 * (n - 700_000)), 3: (6, 6), 4: (9, 6)}


def test_measures_that_rules_may_name(spark):
    df = spark.createDataFrame([(1, SENTENCE * 4), (2, "")], "doc_id long, text string")
    for measure in quality_rules.MEASURES:
        assert {r.kept for r in quality_rules.judge_quality(df, [(measure, -1.0, 1e9)]).where("doc_id = 1").collect()} <= {True, False}
        assert not any(r.kept for r in quality_rules.judge_quality(df, [(measure, 1e9, None)]).collect())


def test_quality_counts(spark, docs):
    for r in quality_rules.judge_quality(docs).collect():
        text = next((t for i, t, *_ in ROWS if i == r.doc_id), None) or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        tri = Counter(zip(w, w[1:], w[2:]))
        hit = {k for i, g in enumerate(zip(w, w[1:], w[2:])) if tri[g] > 1 for k in range(i, i + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = c.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, df.select(*cols).collect())) == Counter(want)


# ---- 4 packing --------------------------------------------------------------


def test_best_two_fit():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 3000):
        sizes = rng.integers(1, 1025, n)
        bins = packing.best_two_fit(sizes)
        assert sorted(x for b in bins for x in b) == list(range(n)) and all(sizes[b].sum() <= 1024 for b in bins)
    assert len(bins) <= 1.03 * sizes.sum() / 1024
    # 60 is filled greedily with 30; two 20s fit the gap more tightly.
    assert sorted(sorted(np.array([60, 30, 20, 20])[b].tolist()) for b in packing.best_two_fit([60, 30, 20, 20], 100)) == [[20, 20, 60], [30]]


def test_ids_equal_the_other_encoder(spark, docs):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack_documents(docs).where("doc_id is not null").collect()
    for i, text, *_ in ROWS:
        ids = np.array([*tk.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        parts = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i})
        if i is not None:
            assert [p[3] for p in parts] == [zlib.crc32(ids[a : a + n].tobytes()) for _, a, n, _ in parts] and sum(p[2] for p in parts) == len(ids)
    for text in ["<|endoftext|> a", "  \n\n x's 12345 ünï\u0300 漢字\U0001f600", " " * 300]:
        assert packing.encoder(packing.tokenizer_path()).encode(text, allowed_special="all") == tk.encode(text, add_special_tokens=False).ids


@needs_data
def test_packing_of_a_whole_table(spark):
    """Every piece once, ids as the other library has them, few sequences."""
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(packing.tokenizer_path())
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    want = Counter()
    for r in docs.collect():
        ids = np.array([*tk.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = packing.query(spark, DATA).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert whole_sequences(got) <= 1.02 * sum(r.length for r in got) / 1024 + 2


def test_packing_of_rows_alike(spark):
    """Rows alike in all columns are dealt out over the groups and packed all."""
    from granary.llm.common import written

    table = written(spark.range(6000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(300).cast("long").alias("length"), F.lit(5).cast("long").alias("ids_crc32")), "alike")
    got = packing.pack(table, group=500).collect()
    # A group may end with one sequence that is not full.
    assert len(got) == 6000 and whole_sequences(got) <= 2000 + 12
    assert max(Counter(r.sequence_id >> 20 for r in got).values()) < 1500


# ---- 5 top-k ----------------------------------------------------------------


def test_topk_ties_and_bad_vectors(spark, tmp_path):
    v = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (8, []), (9, [-0.001, 0.5]), (None, [1.0, 1.0]), (1, [1.0, 1.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df, F.col("vec_id") % 50 == 0, 3).collect())
    s = 256 * 256
    assert got == [(0, 1, 1, s), (0, 2, 1, s), (0, 3, 2, s), (50, 1, 1, s), (50, 2, 1, s), (50, 3, 2, s)]
    assert topk.search(df.limit(0), F.lit(True)).count() == 0


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(700, 9)).astype("f4")
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<float>").repartition(5)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect()}
    z = np.floor(256 * m.astype("f8")).astype("i8")
    for q in range(0, 700, 50):
        order = sorted((-int(z[q] @ z[i]), i) for i in range(700) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -x) for x, i in order]


def sent_rows(monkeypatch):
    """From now on a search returns how many rows the slices of a pair of blocks sent."""
    import pandas as pd

    def counting(k):
        def run(frames):
            for f in frames:
                for i in range(len(f)):
                    n = len(np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in f["sent"][i]])))
                    yield pd.DataFrame({"query_row": [0], "query_id": [int(f["rblock"][i]) ^ int(f["block"][i])], "id": [0], "score": [n]})

        return run

    monkeypatch.setattr(topk, "_phase3", counting)


def test_topk_of_equal_vectors(spark, monkeypatch):
    """20,000 equal vectors: the k smallest ids, and no slice sends the rest."""
    rows = spark.range(20_000).select(F.col("id").alias("vec_id"), F.array(*(F.lit(0.5) for _ in range(64))).alias("embedding"))
    is_query = F.col("vec_id") % 5000 == 0
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(rows, is_query).collect())
    score = 64 * 128 * 128
    want = {q: [i for i in range(7) if i != q][:5] for q in range(0, 20_000, 5000)}
    assert got == [(q, k + 1, i, score) for q in sorted(want) for k, i in enumerate(want[q])]
    sent_rows(monkeypatch)
    assert sum(r.score for r in topk.search(rows, is_query).collect()) == 4 * 5


def test_topk_prunes(spark, monkeypatch):
    """Of random vectors, few rows get exact scores."""
    rng = np.random.default_rng(8)
    m = rng.normal(size=(6000, 32)).astype("f4")
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<float>")
    is_query = F.col("vec_id") % 1000 == 0
    assert topk.search(df, is_query).count() == 30
    sent_rows(monkeypatch)
    assert 30 <= sum(r.score for r in topk.search(df, is_query).collect()) < 6 * 6000 / 10


def test_topk_broadcasts_no_blocks(spark, monkeypatch):
    """blocks are small in files and come once for every shard, so the driver never holds them."""
    plans, plain = [], topk.written
    monkeypatch.setattr(topk, "written", lambda df, *a: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or plain(df, *a))
    df = spark.range(200).select(F.col("id").alias("vec_id"), F.array(*(F.lit(float(i)) for i in range(4))).alias("embedding"))
    assert topk.search(df, F.col("vec_id") % 50 == 0).count() == 4 * 5
    by = {k for p in plans for k in re.findall(r"BroadcastHashJoin \[(\w+)#", p)}
    assert by <= {"query_row"}, by


def test_topk_matrices_of_every_size():
    """a block is stored in 2, 4 or 8 bytes a cell."""
    for most, size in ((300, 2), (32767, 2), (32768, 4), (1 << 31, 8), (1 << 60, 8)):
        m = np.array([[most, -most, 0], [1, -1, 2]], "<i8")
        assert len(topk._packed(m)) == 8 + 6 * size
        assert topk._matrix(topk._packed(m), 2).tolist() == m.tolist()
        assert topk._matrix(topk._packed(m[:, :0]), 2).shape == (2, 0)


def test_topk_best_of_a_strip():
    """By parts, with ties, without enough places and at either end."""
    rng = np.random.default_rng(3)
    for width, high in ((3, 9), (70, 4), (700, 1 << 20), (4096, 1 << 20), (4096, 1), (4099, 3)):
        for kind in (np.float32, np.float64, np.int64):
            scores = rng.integers(-high, high, (7, width)).astype(kind)
            q, r = topk._best(scores, 5)
            for i in range(7):
                assert sorted(r[q == i].tolist()) == sorted(np.lexsort((np.arange(width), -scores[i]))[:5].tolist())


def test_topk_of_large_and_short_vectors(spark):
    """Sums beyond 2^53, and vectors with fewer components than slices."""
    v = [(i, [float(1 << 30) + i, -float(1 << 30) - i, 3.0]) for i in range(40)] + [(50 + i, [float(i - 5)]) for i in range(20)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    z = {i: [int(np.floor(x)) for x in e] for i, e in v}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.search(df, F.col("vec_id").isin(3, 55), 4, scale=1.0).collect()}
    for q in (3, 55):
        order = sorted((-sum(a * b for a, b in zip(z[q], z[i])), i) for i in z if i != q and len(z[i]) == len(z[q]))[:4]
        assert [got[q, k + 1] for k in range(4)] == [(i, -x) for x, i in order]


def test_topk_repeated_queries(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 4)).astype("f4")
    rows = [(i, x.tolist()) for i, x in enumerate(m)] + [(0, m[0].tolist()), (50, (-m[50]).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    z = [(i, np.floor(256 * np.array(x)).astype("i8")) for i, x in rows]

    def best(q):
        return tuple((i, -x) for x, i in sorted((-int(z[q][1] @ v), i) for i, v in z if i != z[q][0])[:5])

    lists = {}
    for r in topk.search(df, F.col("vec_id") % 50 == 0, per_row=True).orderBy("query_row", "rank").collect():
        lists.setdefault((r.query_row, r.query_id), []).append((r.vec_id, r.score))
    assert Counter((q, tuple(x)) for (_, q), x in lists.items()) == Counter((z[q][0], best(q)) for q in (0, 50, 60, 61))
    # As the SQL: one list of a query_id, of both rows' candidates.
    got = {}
    for r in topk.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: sorted(best(q) + best(p), key=lambda x: (-x[1], x[0]))[:5] for q, p in ((0, 60), (50, 61))}


# ---- 6 language -------------------------------------------------------------


def test_code_lengths_are_ppm():
    samples = {"aa": [b"abababab", b"abc"], "bb": [b"bcbcbc"]}
    m = langid.Model(samples, order=2)

    def bits(text, lang):
        padded = [None, None]
        stat = [Counter(), {}, {}]
        for t in samples[lang]:
            s = padded + list(t)
            for i in range(2, len(s)):
                stat[0][s[i]] += 1
                for k in (1, 2):
                    stat[k].setdefault(tuple(s[i - k : i]), Counter())[s[i]] += 1
        every = Counter()
        for x in samples:
            for t in samples[x]:
                s = padded + list(t)
                every.update((k, tuple(s[i - k : i])) for i in range(2, len(s)) for k in (1, 2))
        total, s = 0.0, padded + list(text)
        for i in range(2, len(s)):
            for k in (2, 1, 0):
                ctx = tuple(s[i - k : i])
                c = stat[0] if k == 0 else stat[k].get(ctx) if every[k, ctx] >= 2 else None
                if not c:
                    continue
                n, d = sum(c.values()), len(c)
                if s[i] in c:
                    total -= np.log2(c[s[i]] / (n + d))
                    break
                total -= np.log2(d / (n + d))
            else:
                total += np.log2(m.size)
        return total

    for text in (b"abc", b"bcb", b"cab", b"bbbb"):
        assert m.code_lengths(text) == pytest.approx([bits(text, x) for x in ("aa", "bb")], rel=1e-5)


@needs_data
def test_language_accuracy(spark):
    got = langid.query(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    assert langid.Model({"x": [b"abc"]}).predict("123 !") == ("und", 0.0)


def test_letters_are_of_category_l():
    m = langid.Model({"en": [b"one and two"], "el": ["\u03b1\u03b2\u03b3 \u03b4".encode()]})
    for text in ("\u00bd \u2461 \u2167", "12 \u0663", "_ - !", "\U0001f600", "\u0301", "", None):
        assert m.predict(text) == ("und", 0.0), text
    assert m.predict("\u4e2d")[0] != "und" and m.predict("\u03b1\u03b2")[0] == "el" and m.predict("\u02b0")[0] != "und"


def test_every_byte_has_its_own_code():
    """More than 127 different bytes; bytes never seen are spelled out alike."""
    seen = bytes(range(1, 201))
    m = langid.Model({"a": [seen * 3], "b": [seen]}, order=1)
    assert m.size == 201 and len(set(m.code.tolist())) == 201
    plain = langid.Model({"a": [b"ab"], "b": [b"bc"]}, order=1)
    one, two = plain.code_lengths(b"a"), plain.code_lengths(b"a\xff")
    assert (two - one > np.log2(253)).all()


def test_samples_of_repeated_and_null_ids(spark):
    """Rows that share an id, or have none, are sampled like others; a value that
    one text fills is not lost; no number of values is an error."""
    rows = [(None, f"text {i}", "en") for i in range(3000)] + [(7, f"texte {i}", "fr") for i in range(3000)] + [(9, "same", "de")] * 3000 + [(i, f"t{i}", f"x{i}") for i in range(250)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = Counter(r.lang for r in langid.bounded_sample(df, "lang", 20, F.struct("doc_id", "text")).collect())
    assert got["en"] == got["fr"] == 20 and got["de"] == 1 and len(got) == 253
    model = langid.fit(df.where("lang in ('en', 'fr')"), 20)
    assert model.languages == ["en", "fr"] and langid.fit(df.limit(0)) is None


# ---- 7 toxicity -------------------------------------------------------------


def naive_hits(weights, exceptions, folded):
    """Weight by place, by looking at every place of a folded text."""
    spared = [range(i, i + len(p) + 1) for p in exceptions for i in range(len(folded)) if folded.startswith(f" {p} ", i)]
    best = {}
    for i in range(len(folded)):
        fits = [w for s, w in weights.items() if folded.startswith(f" {s}", i)]
        if fits and not any(i in r for r in spared):
            best[i] = max(fits)
    return best


def test_hits_against_every_place():
    rng = np.random.default_rng(12)
    words = ["a", "ab", "aba", "b", "ba", "bab", "no", "noa"]
    for _ in range(300):
        weights = {w: float(rng.integers(1, 9)) for w in rng.choice(words, 3, replace=False)}
        exceptions = [" ".join(rng.choice(words, 2)) for _ in range(2)]
        folded = " " + " ".join(rng.choice(words, int(rng.integers(0, 14)))) + " "
        assert toxicity.Lexicon.hits(toxicity.Lexicon(weights, exceptions).automaton(), folded) == naive_hits(weights, exceptions, folded)


def test_long_texts_and_signs():
    import time

    lex = toxicity.Lexicon({"idiot": 2.0, "ass": 2.0}, ["no idiot"], (-3.0, 2.0, 1.0))
    a, table = lex.automaton(), toxicity._Fold()
    assert lex.score(a, toxicity.fold("no idiot!", table)) < 0.3 < 0.7 < lex.score(a, toxicity.fold("a$$hole! 1d!ot", table))
    began = time.perf_counter()
    for text in ("no idiot! " * 1_000_000, "!1" * 2_000_000, "idiot " * 1_000_000):
        lex.score(a, toxicity.fold(text, table))
    assert time.perf_counter() - began < 60
    # Clean words around a hit lower the score however long the text gets.
    scores = [lex.score(a, toxicity.fold("an idiot " + "fine words here " * n, table)) for n in (1, 10, 100, 1000)]
    assert scores == sorted(scores, reverse=True)


# ---- 7 toxicity, learned ----------------------------------------------------


def test_folding_and_exceptions():
    lex = toxicity.Lexicon({"idiot": 2.0, "idiotic": 3.0}, ["no idiot"], (-3.0, 2.0, 1.0))
    a, table = lex.automaton(), {}
    table = toxicity._Fold()
    for text in ("an IDIOT", "an 1d10t!", "an \u0456di\u043et", "an i\u200bdiot", "\uff49diot", "idi\u00f6t"):
        assert lex.score(a, toxicity.fold(text, table)) > 0.7, text
    for text in ("", "a nonidiot", "no idiot"):
        assert lex.score(a, toxicity.fold(text, table)) < 0.3, text
    assert toxicity.Lexicon.hits(a, " idiotic ") == {0: 3.0}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    pos, neg = ([r.score for r in got if r.toxic == k] for k in (1, 0))
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.85
    assert np.mean([r.predicted for r in got if r.toxic == 0]) < 0.05


# ---- 8 suffix array ---------------------------------------------------------


def brute_removed(rows):
    first = {}
    for i, t in sorted(rows):
        for a in range(len(t) - 49):
            first.setdefault(t[a : a + 50], i)
    out = Counter()
    for i, t in rows:
        c = np.zeros(len(t), bool)
        for a in range(len(t) - 49):
            if first[t[a : a + 50]] < i:
                c[a : a + 50] = True
        spans = len(re.findall(b"\x01+", c.tobytes()))
        out[i, len(t), int(c.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~c])).hexdigest()] += 1
    return out


def passages(seed):
    rng = np.random.default_rng(seed)
    line = lambda n: bytes(rng.integers(97, 100, n, dtype=np.uint8)).decode()
    shared = [line(n) for n in (49, 50, 51, 90, 200)] + ["\x00" * 120, "ab" * 60, "é" * 40]
    rows = [(i, line(int(rng.integers(0, 80))) + "".join(shared[k] + line(int(rng.integers(0, 9))) for k in rng.integers(0, 8, rng.integers(0, 5)))) for i in range(60)]
    return rows + [(61, rows[5][1]), (61, rows[5][1]), (62, rows[61 % 60][1][:77])]


@pytest.mark.parametrize("hot,batch", [(1 << 14, 2 << 20), (1, 700)])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, hot, batch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    monkeypatch.setattr(suffix_dedup, "SHARD", 300)
    rows = passages(hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("batch", F.lit(1)).repartition(4)
    got = Counter(tuple(r) for r in suffix_dedup.dedup(df).collect())
    assert got == brute_removed([(i, t.encode()) for i, t in rows])
    left = {r.doc_id: len(r.text.encode()) for r in suffix_dedup.cleaned(df).collect()}
    assert all(left[k[0]] <= k[1] - k[2] for k in got)


def dedup_here(docs, per_batch, buckets):
    """The steps of suffix_dedup.dedup in this process, where its sizes can be set."""
    import pyarrow as pa

    def table(rows):
        kinds = {"batch": pa.int64(), "bucket": pa.int32(), "kind": pa.int32(), "answers": pa.list_(pa.struct([("kind", pa.int32()), ("data", pa.binary())])), "found": pa.list_(pa.binary())}
        return [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds.get(k, pa.binary())) for k in rows[0]], list(rows[0]))]

    def rows(batches):
        return [r for b in batches for r in b.to_pylist()]

    sets = [docs[a : a + per_batch] for a in range(0, len(docs), per_batch)]
    ints = [(np.array([i for i, _ in c], "<i8"), np.array([len(t) for _, t in c], "<i8")) for c in sets]
    stored = [{"batch": i, "docs": suffix_dedup.pack(k, np.zeros(len(k), bool), n), "texts": suffix_dedup.squeeze(b"".join(t for _, t in c))} for i, (c, (k, n)) in enumerate(zip(sets, ints))]
    asked = sorted(rows(suffix_dedup._ask(buckets)(table(stored))), key=lambda r: r["bucket"])
    told = rows(suffix_dedup._answer(iter(table(asked))))
    armed = [b | {"answers": [{k: r[k] for k in ("kind", "data")} for r in told if r["batch"] == b["batch"]]} for b in stored]
    sent = sorted(rows(suffix_dedup._segments(buckets)(table(armed))), key=lambda r: r["bucket"])
    found = rows(suffix_dedup._search(iter(table(sent))))
    where = {r["batch"]: r for r in found if r["kind"] == 1}
    last = [{"docs": b["docs"], "texts": b["texts"], "rest": b"", "at": where[b["batch"]]["data"], "gone": where[b["batch"]]["more"], "found": [r["data"] for r in found if r["kind"] == 0 and r["batch"] == b["batch"]]} for b in stored]
    return Counter(tuple(r.values()) for r in rows(suffix_dedup._apply()(table(last))))


@pytest.mark.parametrize("found", [1, 70, 1 << 20])
def test_suffix_spans_are_dealt_out_together(monkeypatch, found):
    """spans of many arrays go to their batches at once."""
    monkeypatch.setattr(suffix_dedup, "SHARD", 90)
    monkeypatch.setattr(suffix_dedup, "FOUND", found)
    rng = np.random.default_rng(8)
    word = [bytes(rng.integers(97, 123, 30, dtype=np.uint8)) for _ in range(12)]
    docs = [(i, b" ".join(word[k] for k in rng.integers(0, 12, 9))) for i in range(40)]
    assert dedup_here(docs, 3, 2) == brute_removed(docs)


def test_suffix_array_leaves_lone_suffixes_out():
    """segments that met by chance are not sorted; repeats stay, at all their places."""
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 256, (400, 96), dtype=np.uint8)
    rows[300, 5:75] = rows[7, 20:90]
    a = suffix_dedup.SuffixArray(rows, np.full(400, 96))
    assert len(a.seg) < 400 * 47 / 4
    assert set(zip(a.seg.tolist(), a.off.tolist())) >= {(7, 20 + i) for i in range(21)} | {(300, 5 + i) for i in range(21)}
    assert max(g[2] for g in a.repeats(np.arange(400))) == 70
    assert len(suffix_dedup.SuffixArray(rows[:1], np.array([49])).seg) == 0


def test_maximal_repeats():
    text = [b"x" * 60 + b"1", b"0" + b"x" * 60, b"q" * 61]
    rows = np.zeros((3, 61), np.uint8)
    for i, t in enumerate(text):
        rows[i, : len(t)] = np.frombuffer(t, np.uint8)
    a = suffix_dedup.SuffixArray(rows, np.array([61, 61, 61]))
    groups = list(a.repeats(np.array([5, 3, 9])))
    assert max(g[2] for g in groups) == 60
    for lo, hi, n, low in groups:
        found = {bytes(text[a.seg[r]][a.off[r] : a.off[r] + n]) for r in range(lo, hi + 1)}
        assert len(found) == 1 and low == min([5, 3, 9][a.seg[r]] for r in range(lo, hi + 1))
        before = {a.left[r] for r in range(lo, hi + 1)}
        assert len(before) > 1 or -1 in before


# ---- 9 urls -----------------------------------------------------------------


def test_url_rules_and_list(spark):
    urls = [None, "", "no scheme", "http://", "http://A.COM/de/x?q", "http://x.com/fr/de/", "https://example.org/es/1", "https://sub.EXAMPLE.org/en/1x", "http://badexample.org/es/", "http://a.net/p/#f", "http://www.a.net/p?x=1", "http://b.net", "x://com/de/", "http://b.net://c.org/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit("k")).withColumn("block", F.lit(1))
    listed = spark.createDataFrame([("a.net/p",), ("a.net/p",), (None,)], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, listed).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("a.com", "/de/x", "com/de/", "block"), 5: ("x.com", "/fr/de/", "com/fr/", "allow"),
        6: ("example.org", "/es/1", "example.org/es/", "block"), 7: ("sub.example.org", "/en/1x", "example.org/en/1", "block"), 8: ("badexample.org", "/es/", "org/", "allow"), 9: ("a.net", "/p/", None, "block"),
        10: ("www.a.net", "/p", None, "block"), 11: ("b.net", "", None, "allow"), 12: ("com", "/de/", "com/de/", "block"), 13: ("b.net:", "//c.org/", None, "allow"),
    }
    assert url_filter.judge_urls(df.limit(0), listed.limit(0)).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("key"))
    blocks = url_filter.blocks_for(3000)
    f = url_filter.bloom(keys, blocks)
    hit = keys.withColumn("block", url_filter._block(F.col("key"), blocks)).join(f, "block").where(F.col("word").bitwiseAND(url_filter._mask(F.col("key"))) == url_filter._mask(F.col("key")))
    assert hit.count() == 3000
    # Sized by the list, whatever its length: few bits of a block are set.
    assert f.agg(F.avg(F.bit_count("word"))).head()[0] < 24
    assert [url_filter.blocks_for(n) for n in (0, 4096, 4097, 10**7)] == [1 << 10, 1 << 10, 1 << 11, 1 << 22]


def test_a_filter_too_large_to_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"http://h{i % 50}.net/p{i % 7}") for i in range(400)] + [(400, None), (401, "http://x.com/de/")], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i}.net/p{i % 7}",) for i in range(0, 50, 3)], "key string")
    want = Counter(map(tuple, url_filter.judge_urls(df, listed).collect()))
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    assert Counter(map(tuple, url_filter.judge_urls(df, listed).collect())) == want


# ---- 10 mixing --------------------------------------------------------------


def brute_targets(sizes, weights, budget, most=2):
    """Shares by weight; a source above its limit is full and leaves the rest."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), budget
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / total >= most * sizes[i]}
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else left * weights[i] / total
        left -= sum(out[i] for i in full)
        open_ = open_ - full if full else set()
    return out


@pytest.mark.parametrize("sizes,weights,share", [([10, 10], [3, 1], 1.5), ([100, 100, 100], [3, 1, 2], 1.5), ([0, 5], [1, 1], 1.5), ([1, 2, 900, 4, 70], [3, 1, 2], 1.5), ([5, 5], [1, 9], 2.0)])
def test_targets(spark, sizes, weights, share):
    names = ["a", "b", "\u00e9", "\U0001f600", None][: len(sizes)] if len(sizes) > 2 else ["Z", "a"]
    df = spark.createDataFrame([(n, s, 1) for n, s in zip(names, sizes)], "source string, size long, h long")
    got = {r.source: r.target for r in mixing.source_table(df, weights, share).collect()}
    want = brute_targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes))
    assert [got[n] for n in names] == pytest.approx(want)
    assert mixing.source_table(df.limit(0)).count() == 0


def test_mix_of_many_sources(spark):
    """As many sources as documents allow; each near its target."""
    rng = np.random.default_rng(15)
    rows = [(i, "w " * int(rng.integers(1, 9)), f"s{int(rng.integers(0, 1500)):04d}") for i in range(6000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        s = rows[r.doc_id][2]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    names = sorted(size)
    assert [target[s] for s in names] == pytest.approx(brute_targets([size[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(size.values())))
    assert all(abs(taken[s] - target[s]) <= 8 for s in names)


def test_mix(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 60)), ["a", "b", "é", None][int(rng.integers(0, 4))]) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1)).repartition(4)
    got = mixing.mix(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(df.repartition(3)).collect()), key=repr)
    source = {i: s for i, _, s in rows}
    size, taken = Counter(), Counter()
    for r in got:
        size[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.size == rows[r.doc_id][1].count("w") and r.taken <= 2 * r.size
    order = ["a", "b", "é", None]
    want = brute_targets([size[s] for s in order], [3, 1, 2, 3], 1.5 * sum(size.values()))
    for s, t in zip(order, want):
        assert abs(taken[s] - t) <= 60
    assert mixing.mixed(df).columns == df.columns
    whole = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert all(whole[r.doc_id] * r.size == r.taken for r in got)
