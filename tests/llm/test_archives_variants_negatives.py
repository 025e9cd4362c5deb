"""Operators 11 to 13 against brute force, on messy small tables."""
import base64
import gzip
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import common, negatives, variants, warc
from sensorlake.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    common.prepare(spark)


def multiset(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# ------------------------------------------------------------ 11 archives

PAGES = [(1, "http://a/%41", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""),
         (5, "http://a/\r\n5", "é日本 \r\n\r\n WARC/1.1"), (None, "http://a/n", "<p>one</p>"), (None, None, "<p>only null</p>"),
         (7, "http://a/7", "big " * 300_000), (8, "http://a/8", "same"), (8, "http://a/8", "same"), (8, "http://a/8", "same"),
         (8, "http://a/0", "same"), (6, "http://a/6", "same"), (None, None, "twice"), (None, None, "twice")]


def wanted_pages(rows, least=0):
    by = defaultdict(list)
    for i, (page, url, html) in enumerate(rows):
        by[html or ""].append(((page is not None, page or 0, url is not None, url or "", -i), page))
    out = Counter()
    for page, payload, key in ((page, html or "", (page is not None, page or 0, url is not None, url or "", -i))
                               for i, (page, url, html) in enumerate(rows)):
        data = payload.encode()
        top_key, top = max(by[payload], key=lambda x: x[0])
        first = len(data) < least or key == top_key
        out[(page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "response" if first else "revisit", None if first else top)] += 1
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, digest string")
    got = warc.archived_pages(pages.repartition(3), scratch_path(spark, "warc"), least_bytes=least)
    assert multiset(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == wanted_pages(PAGES, least)


def test_archives_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived_pages(none, scratch_path(spark, "warc")).collect() == []


def test_archives_are_plain_warc(spark):
    """Any gzip reader sees the records in a row; the index has their places."""
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(pages, folder, archive_bytes=3000).orderBy("archive", "offset").collect()
    assert len(index) == len(PAGES) and len(os.listdir(folder)) > 1
    seen = 0
    for name in os.listdir(folder):
        raw = open(f"{folder}/{name}", "rb").read()
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.endswith(b"\r\n\r\n")
        rows = [r for r in index if r.archive == name]
        for r, after in zip(rows, [*[x.offset for x in rows[1:]], len(raw)]):
            assert r.offset + r.length == after
            headers, payload = warc.parse_record(raw[r.offset:after])
            assert headers["warc-payload-digest"] == f"sha1:{r.digest}" and headers["warc-type"] == r.record_type
            assert payload == b"" or warc.base32_sha1(payload) == r.digest
            seen += 1
    assert seen == len(PAGES)
    ids = [warc.parse_record(open(f"{folder}/{r.archive}", "rb").read()[r.offset:r.offset + r.length])[0] for r in index]
    names = {h["warc-record-id"] for h in ids}
    assert len(names) == len(index) and all(h["warc-refers-to"] in names for h in ids if h["warc-type"] == "revisit")


def test_selected_records(spark):
    """A selection reads only its records; gaps split reads, damage is an error."""
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 200) for i in range(300)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(pages, folder)
    few = index.filter(F.col("id").cast("int") % 10 == 0)
    for gap, most in ((0, 1), (0, 1 << 20), (1 << 20, 1 << 20), (200, 500)):
        got = {r.id: bytes(r.payload).decode() for r in warc.read_records(few, folder, gap=gap, read_bytes=most, task_bytes=2000).collect()}
        assert got == {str(i): f"page {i} " * 200 for i in range(0, 300, 10)}
    wrong = few.withColumn("digest", F.lit("A" * 32))
    with pytest.raises(Exception, match="another record"):
        warc.read_records(wrong, folder).collect()


def test_archive_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got = warc.op11_warc(spark, SF)
    assert multiset(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == wanted_pages(rows)


# ------------------------------------------------------------ 12 spelling variants

def wanted_words(rows, least_chars=7):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= least_chars:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    by_len = defaultdict(list)
    for w in counts:
        by_len[len(w)].append(w)
    form, near = {}, {}
    for w, n in counts.items():
        close = [x for k in (-1, 0, 1) for x in by_len[len(w) + k] if one_edit(w, x)]
        near[w] = len(close)
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return Counter((w, form[w], root(w), n, near[w], counts[form[w]] if form[w] else None) for w, n in counts.items())


def random_texts(seed, n):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("entaé×iork") for _ in range(rng.randint(6, 9))) for _ in range(25)]

    def edited(w):
        at, kind = rng.randrange(len(w)), rng.randrange(6)
        return (w[:at] + w[at + 1:] if kind == 0 else w[:at] + rng.choice("enxzÿ") + w[at:] if kind == 1
                else w[:at] + rng.choice("enxzÿ") + w[at + 1:] if kind == 2 else w)
    rows = [(i, " ".join(edited(w).upper() if rng.random() < 0.1 else edited(w) for w in rng.choices(bases, range(1, 26), k=60)))
            for i in range(n)]
    return rows + [(None, rows[0][1]), (1, None), (2, ""), (3, "a " * 50), rows[5], rows[5],
                   (n, "L" * 3000 + " " + "l" * 3001 + " " + "l" * 3000 + " " + "l" * 3001 + "中" + "Straße1Straßenbahn_straßenbahn")]


WORD_COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("sizes", [{}, dict(trie_words=3, search_words=5)])
def test_variants_by_definition(spark, sizes):
    rows = random_texts(7, 60)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)
    got = variants.spelling_variants(docs, **sizes)
    want = wanted_words(rows)
    assert multiset(got, *WORD_COLUMNS) == want
    assert sum(r[1] is not None for r in want) > 20 and max(r[4] for r in want) > 3


def test_variants_chain(spark):
    """Forms of forms: counts 2, 20, 200 one letter apart."""
    text = "abcdefgh " * 2 + "abcdefgx " * 20 + "abcdefxx " * 200 + "abcdexxx " * 199 + "abcdefxxz " * 200
    rows = [(i, text) for i in (1, 2)]
    got = {r.word: r for r in variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert multiset(variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")), *WORD_COLUMNS) == wanted_words(rows)
    assert got["abcdefgh"].form == "abcdefgx" and got["abcdefgh"].root == "abcdefxx" and got["abcdefxx"].form is None


def test_variants_empty(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert variants.spelling_variants(spark.createDataFrame([(1, None), (2, "short words")], "doc_id long, text string")).collect() == []


def test_variants_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert multiset(variants.op12_spelling_variants(spark, SF), *WORD_COLUMNS) == wanted_words(rows)


def test_trie_finds_what_vectors_allow():
    """Each pair at one edit is found exactly once over the reachable subtrees."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ent\xe9z") for _ in range(rng.randint(3, 5))).encode("latin-1") for _ in range(700)})
    by = defaultdict(list)
    for w in words:
        by[(len(w), w.count(b"e"), w.count(b"n"))].append(w)
    found = Counter()
    for key, held in by.items():
        trie = variants.Trie(np.frombuffer(b"".join(held), "u1").reshape(-1, key[0]))
        for longer, d0, d1, surplus, deficit in variants._REACH:
            asked = by.get((key[0] - longer, key[1] - d0, key[2] - d1))
            if asked:
                letters = np.frombuffer(b"".join(asked), "u1").reshape(len(asked), -1)
                for i, j, both in trie.near(letters, longer, surplus, deficit):
                    for a, b in zip(i, j):
                        found[(asked[a], held[b])] += 1
                        if both:
                            found[(held[b], asked[a])] += 1
    known = set(words)
    want = Counter()
    for w in words:
        close = {w[:i] + w[i + 1:] for i in range(len(w))}
        for c in range(256):
            close |= {w[:i] + bytes([c]) + w[i + 1:] for i in range(len(w))} | {w[:i] + bytes([c]) + w[i:] for i in range(len(w) + 1)}
        want.update((w, x) for x in close & known - {w})
    assert found == want


# ------------------------------------------------------------ 13 hard negatives

def wanted_negatives(rows):
    part = []
    for i, (ident, vec, label) in enumerate(rows):
        if label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        if ident is not None and ident % 7 == 0:
            label = (label + 1) % 10
        part.append((i, ident, label, [int(np.floor(256 * float(np.float32(x)))) for x in vec]))
    out = Counter()
    last = lambda ident: (ident is None, ident or 0)
    for i, a, la, va in part:
        if a is None or a % 100:
            continue
        score = sorted(((-sum(x * y for x, y in zip(va, vb)), last(b), b, lb) for j, b, lb, vb in part if j != i), key=lambda x: x[:2])
        for p in [x for x in score if x[3] == la][:5]:
            band = [x for x in score if x[3] != la and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0]][:10]
            out.update((a, p[2], r + 1, x[2], -p[0], -x[0]) for r, x in enumerate(band))
    return out


NEGATIVE_COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
VECTORS = "vec_id long, embedding array<float>, label int, score double"


def messy_vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 8))
    rows = [(int(i), (centres[i % 4] + rng.normal(size=8) * 0.6 * (1 + i % 5)).astype("float32").tolist(), int(i % 4)) for i in range(0, 900, 3)]
    same = rows[10][1]
    rows += [(i, same, i % 3) for i in range(1000, 1400, 7)]             # one vector in many rows
    rows += [(2000, None, 1), (2100, [0.1, None] + [0.0] * 6, 1), (2200, [float("nan")] * 8, 1), (2300, [float("inf")] + [0.0] * 7, 2),
             (2400, [0.0] * 8, 1), (2500, [0.0] * 8, 1), (None, rows[3][1], 1), (None, rows[4][1], 2), (2600, rows[5][1], None),
             (2700, [], 1), (2800, [0.5, 0.5], 2), (2900, [0.1] * 12, 3), (300, rows[7][1], 1), (300, rows[7][1], 1), (3000, same, 3)]
    return rows


@pytest.mark.parametrize("sizes", [{}, dict(bucket_rows=16, stripe_rows=64, anchor_block=3, focus=2), dict(bucket_rows=5, focus=1)])
def test_negatives_by_definition(spark, sizes):
    rows = messy_vectors()
    table = spark.createDataFrame([(*r, 0.5) for r in rows], VECTORS).repartition(4)
    got = negatives.hard_negatives(table, **sizes)
    want = wanted_negatives(rows)
    assert multiset(got, *NEGATIVE_COLUMNS) == want and len(want) > 100


def test_negatives_empty(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    one = spark.createDataFrame([(100, [1.0, 0.0], 1, 0.0), (101, [1.0, 0.0], 2, 0.0)], VECTORS)
    assert negatives.hard_negatives(one).collect() == []


def test_coordinate_ranges_lose_nothing():
    """Every row that reaches the threshold is a candidate, and most others are not."""
    rng = np.random.default_rng(1)
    centres = np.repeat(rng.normal(size=(25, 16)), 20, axis=0)
    rows = centres + rng.normal(size=(500, 16)) * 0.1
    rows = np.rint(1000 * rows / np.linalg.norm(rows, axis=1)[:, None])
    bucket = negatives.Bucket(rows)
    kept = 0
    for q in rows[::25]:
        unit = q / np.linalg.norm(q)
        focus = np.argsort(-np.abs(unit))[:4]
        scores = rows @ q
        for least in np.sort(scores)[[-300, -20, -15, -10, -5]]:
            found, exact = bucket.reaching(q, float(np.linalg.norm(q)), unit, focus, float(least))
            assert set(np.flatnonzero(scores >= least)) <= set(found.tolist()) and (exact == scores[found]).all()
            kept += len(found)
    assert kept < 0.5 * 500 * 20 * 5 and len(bucket.reaching(q, 1.0, unit, focus, -1.0)[0]) == 500


def test_negatives_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert multiset(negatives.op13_hard_negatives(spark, SF), *NEGATIVE_COLUMNS) == wanted_negatives(rows)
