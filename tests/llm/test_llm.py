"""The training-data operators against brute force, on messy small tables."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sensorlake.llm import (common, language, licenses, mixing, packing, quality, rules, sharding, simhash, spotsigs,
                            toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, labels string, fp int"
SF = "/root/testdata/sf0.001"
BASE = ("the quick brown fox jumps over the lazy dog near the river bank while all of the birds sing in the "
        "old trees of the garden and nobody cares about it at all today or tomorrow").split()


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty texts, repeated rows, copies, a very long text, odd characters."""
    texts = [None, "", "  \n\t ", " ".join(BASE), " ".join(BASE), " ".join(BASE[:-1] + ["later"]), "one", "One TWO",
             "Ünïcode ß naïve 日本語  x\x1fy Σας", "a b c a b c a b c\n\nline one\nline one\n", " ".join(BASE * 400),
             "This is under the MIT License and the Apache License, Version 2.0. GNU Lesser General Public License v3",
             "idiot moron " * 5, "x" * 5000, "<|endoftext|> 12 don't \xad", "|| ## $$ %%"]
    out = [(i, t, "en" if i % 2 else None, [None, "a", "b", "ä"][i % 4], 0, 0.5, "x", 1) for i, t in enumerate(texts)]
    out += [(None, "no id here " * 3, "en", "a", None, None, None, None), (None, None, None, None, None, None, None, None)]
    return out + [out[3], out[3], out[11]]      # whole rows that repeat


@pytest.fixture(scope="module")
def docs(spark, rows):
    common.prepare(spark)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------ 1 language

def test_language_profiles(spark, small, docs, empty):
    p = language.learn(small)
    got = language.predict(docs, p).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].lang_pred for i in (0, 1, 2, 15)] == ["und"] * 4 and by[0].score == 0
    assert language.predict(empty, p).count() == 0
    assert {r.lang_pred for r in language.predict(docs, language.learn(empty)).collect()} == {"und"}
    held = (language.op1_language_id(spark, SF).filter("held_out")
            .join(small.select("doc_id", "lang", "n_chars"), "doc_id").filter("n_chars > 100").collect())
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95


def test_language_distance_by_definition():
    """Ranking, distance and ties against plain dictionaries."""
    rng = np.random.default_rng(6)
    letters = list("abcdeé日")
    texts = {f"l{k:02}": " ".join("".join(rng.choice(letters[:3 + k % 5], int(rng.integers(1, 6)))) for _ in range(80)) for k in range(12)}
    texts["l99"] = texts["l03"]                        # a tie: the first by name

    def places(text, size):
        c = Counter()
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            w = f" {w} "
            c.update(g for n in (1, 2, 3) for i in range(len(w) - n + 1) if (g := w[i:i + n]).strip())
        number = lambda g: sum((1 if x == " " else ord(x)) << 21 * (len(g) - 1 - i) for i, x in enumerate(g))
        return {number(g): i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], number(x[0])))[:size])}
    size = 40
    profiles = language.Profiles({n: list(places(t, size)) for n, t in texts.items()}, size)
    for text in [*texts.values(), "ab", "日日 日", "zzz", "a b c d e"]:
        own = places(text, size)
        want = {n: sum(abs(p[g] - i) if g in p else size for g, i in own.items())
                for n, p in ((n, places(t, size)) for n, t in texts.items())}
        best = min(want, key=lambda n: (want[n], n))
        assert profiles.distances(language.ranked(*language.gram_counts(text), size)).tolist() == [want[n] for n in sorted(want)]
        assert profiles.predict(text) == (best, 1 - want[best] / (size * len(own)))


def test_many_languages_all_have_a_profile(spark):
    """600 languages of two documents each, all found again."""
    rng = np.random.default_rng(9)
    cps = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    made = []
    for k in range(600):
        own = rng.choice(cps, 6, replace=False)
        made += [(2 * k + j, " ".join("".join(rng.choice(own, 3)) for _ in range(30)), f"x{k}") for j in range(2)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    profiles = language.learn(docs)
    assert len(profiles.names) == 600
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, profiles).collect()}
    assert np.mean([got[i] == lang for i, _, lang in made]) > 0.99


def test_language_blocks_do_not_matter(monkeypatch):
    texts = ["日本語" * 500, "a  b1c " * 300, "Straße " * 99 + "ΣΑΣ" * 50, " ", "x", "xy", "x" * 64, " x" * 40 + "  "]
    whole = [language.gram_counts(t) for t in texts]
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language, "_BLOCK", size)
        for t, (g, c) in zip(texts, whole):
            got = language.gram_counts(t)
            assert np.array_equal(got[0], g) and np.array_equal(got[1], c), (t[:10], size)


def test_language_grams(monkeypatch):
    text = "Ab a, éa 日 bc " * 50
    want = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        w = f" {w} "
        want.update(g for n in (1, 2, 3) for i in range(len(w) - n + 1)
                    if (g := w[i:i + n]).strip() and not (n == 1 and g == " "))
    g, c = language.gram_counts(text)

    def spell(x):
        out = ""
        while x:
            out, x = chr(x & 0x1FFFFF).replace("\x01", " ") + out, x >> 21
        return out
    assert {spell(int(k)): int(v) for k, v in zip(g, c)} == {k: v for k, v in want.items()}
    monkeypatch.setattr(language, "_BLOCK", 40)
    g2, c2 = language.gram_counts(text)
    assert (g == g2).all() and (c == c2).all()


# ------------------------------------------------------------ 2 SimHash

def fp_of(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fs = sorted(root)
    for i, a in enumerate(fs):
        for b in fs[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fs}


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_simhash_against_all_pairs(docs, rows, bucket_rows):
    comp = brute_components({fp_of(r[1]) for r in rows})
    least = {}
    for r in rows:
        if r[0] is not None:
            c = comp[fp_of(r[1])]
            least[c] = min(least.get(c, r[0]), r[0])
    want = Counter((r[0], f"{fp_of(r[1]):016x}", least.get(comp[fp_of(r[1])])) for r in rows)
    assert Counter(map(tuple, simhash.near_duplicates(docs, bucket_rows=bucket_rows).collect())) == want


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_links_find_every_component_of_random_fingerprints(spark, bucket_rows):
    rng = np.random.default_rng(1)
    fps = set()
    for _ in range(40):     # chains of near copies, some dense
        x = int(rng.integers(0, 1 << 63))
        for _ in range(int(rng.integers(1, 30))):
            fps.add(x)
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(b)
    signed = np.array(sorted(fps), "uint64").view("int64").tolist()
    links = simhash.find_links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket_rows=bucket_rows)
    comp = brute_components(fps)
    got = {int(r.node) % (1 << 64): int(r.root) % (1 << 64) for r in simhash.components(links).collect()}
    groups = {}
    for f in fps:
        groups.setdefault(got.get(f, f), set()).add(f)
    want = {}
    for f in fps:
        want.setdefault(comp[f], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_covering_masks_cover_every_small_difference():
    masks = [m % (1 << 64) for m in simhash.covering_masks(4)]
    rng = np.random.default_rng(0)
    for _ in range(5000):
        d = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not d & m for m in masks)
        m = masks[int(rng.integers(31))] & ~d
        assert any(not d & (f % (1 << 64)) for f in simhash.finer_masks(m, 4))


def test_simhash_edges(docs, empty, rows):
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and 4 not in ids and ids.count(0) == 1 and 1 not in ids and ids.count(None) == 1


# ------------------------------------------------------------ 3 licences

def test_license_scan(docs, empty, rows):
    got = {r.doc_id: r for r in licenses.scan(docs).collect() if r.doc_id is not None}
    assert licenses.scan(empty).count() == 0 and len(licenses.build_rules()) > 200
    for r in rows:
        if r[0] is None:
            continue
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        at = [(i, lab) for i in range(len(w)) for p, lab in licenses.PHRASES if [x.encode() for x in w[i:i + len(p)]] == list(p)]
        x = got[r[0]]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == (
            len(w), len(at), min([i for i, _ in at], default=None), max([i for i, _ in at], default=None),
            ",".join(sorted({lab for _, lab in at})))
        assert set(x.base_labels.split(",")) <= set(x.labels.split(",")) and 0 <= x.score <= 1
    assert got[11].labels == "apache,apache-2.0,gpl,lgpl-3.0,mit"


def _shortest(parsed) -> str:
    """A text that an expression matches: first branches, least repeats."""
    out = []
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            out.append(chr(arg))
        elif kind == "NOT_LITERAL":
            out.append("x")
        elif kind == "IN":
            what, value = arg[0]
            out.append({"LITERAL": lambda: chr(value), "CATEGORY": lambda: "7", "RANGE": lambda: chr(value[0]),
                        "NEGATE": lambda: "x"}[str(what)]())
        elif kind == "MAX_REPEAT":
            out.append(_shortest(arg[2]) * arg[0])
        elif kind == "SUBPATTERN":
            out.append(_shortest(arg[3]))
        elif kind == "BRANCH":
            out.append(_shortest(arg[1][0]))
        else:
            assert kind == "ASSERT_NOT", kind
    return "".join(out)


def test_every_license_rule_finds_a_text():
    made, scanner = licenses.build_rules(), licenses.Scanner()
    folded = {re.sub(rb"\d+(?: \d+)?", b"#", r.pattern.pattern) for r in made}
    assert len(folded) >= 300 and len({(r.label, r.pattern.pattern) for r in made}) == len(made)
    for r in made:
        text = _shortest(re._parser.parse(r.pattern.pattern.decode()))
        words = text.encode().split()
        assert b" ".join(words) == text.encode() and r.keyword in words and r.pattern.fullmatch(text.encode()), text
        # it, or a detection that covers it
        kept = scanner.detections([b"before", *words, b"after"])
        a, b = len("before "), len("before ") + len(text)
        assert any(d.label == r.label for d in kept if (d.start, d.stop) == (a, b)) or any(
            d.start <= a and b <= d.stop for d in kept), (r.label, text, kept)
        assert r.label in scanner.scan(f"<< {text.upper()} >>")["labels"].split(",") or any(d.start <= a and b <= d.stop for d in kept)


def test_license_notices_in_files():
    scanner = licenses.Scanner()

    def labels(text):
        return set(scanner.scan(text)["labels"].split(","))
    assert "apache-2.0" in labels("""# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.""")
    assert {"gpl", "lgpl"} & labels("""/* This library is free software; you can redistribute it and/or
 modify it under the terms of the GNU Lesser General Public License */""") == {"gpl", "lgpl"}
    assert "mpl-2.0" in labels("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.")
    assert "bsd-3-clause" in labels("Neither the name of the copyright holder nor the names of its contributors may be used to "
                                    "endorse or promote products derived from this software without permission")
    assert "mit-or-apache-2.0" in labels("Licensed under either of Apache License, Version 2.0 or MIT license at your option.")
    assert "zlib" in labels("Altered source versions must be plainly marked as such")
    # words of the sentences apart from them say nothing
    assert labels("The author may copy a beer notice; the software company shall rest in freedom and hope.") == {""}


def test_suppression_is_containment_by_priority():
    r = [licenses._rule("long", "b", "a b c", 3), licenses._rule("inner", "b", "b", 2),
         licenses._rule("cross", "c", "c d", 2), licenses._rule("low", "b", "a b c d e", 1), licenses._rule("all", "b", "b c", 4)]
    got = licenses.Scanner(r).detections("a b c d e b".encode().split())
    # brute force: by priority and length, drop what lies inside any earlier kept span
    assert [d.label for d in got] == ["long", "low", "all", "cross", "inner"]
    rng = np.random.default_rng(3)
    for _ in range(200):
        words = [bytes([97 + int(x)]) for x in rng.integers(0, 4, 30)]
        rs = [licenses._rule(f"r{i}", "a", " ".join(chr(97 + int(x)) for x in rng.integers(0, 4, int(rng.integers(1, 4)))), int(rng.integers(1, 5)))
              for i in range(6)]
        line = b" ".join(words)
        found = sorted((-x.priority, m.start() - m.end(), i, m.start(), m.end()) for i, x in enumerate(rs) for m in x.pattern.finditer(line)) if b"a" in words else []
        kept = []
        for _, _, i, a, b in found:
            if not any(s <= a and b <= e for s, e, _ in kept):
                kept.append((a, b, f"r{i}"))
        assert [(d.start, d.stop, d.label) for d in licenses.Scanner(rs).detections(words)] == sorted(kept)


def test_near_dedup_keeps_columns_of_any_name(spark):
    made = [(1, " ".join(BASE), "p", "q", 1), (2, " ".join(BASE), "r", "s", 2), (3, "something else entirely here", "t", "u", 3)]
    docs = spark.createDataFrame(made, "doc_id long, text string, _fp string, _ident string, `a.b` int")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [made[0], made[2]]


# ------------------------------------------------------------ 4 quality, 6 toxicity

def test_quality_and_toxicity(spark, small, labels, docs, empty):
    for module, query, col, up in ((quality, quality.op4_quality_classifier, "quality", 0.95), (toxicity, toxicity.op6_toxicity, "toxic", 0.75)):
        got = query(spark, SF).join(labels, "doc_id").collect()
        right = [bool(r.predicted) == bool(r[col]) for r in got]
        assert np.mean(right) > up and all(0 <= r.score <= 1 for r in got)
        model = module.fit(small, labels)
        scored = module.score(docs, model).collect()
        assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
        assert module.score(empty, model).count() == 0
        same = {r.score for r in scored if r.doc_id in (3, 4)}
        assert len(same) == 1
        no_labels = module.fit(docs, labels.limit(0))
        assert len({r.score for r in module.score(docs, no_labels).collect()}) == 1
        assert module.reject(docs, labels).columns == docs.columns


def test_attention_gradient_learns_one_bad_passage():
    rng = np.random.default_rng(5)
    bags, y = [], []
    for i in range(300):
        b = rng.normal(0, 1, (int(rng.integers(2, 9)), 12))
        if i % 2:
            b[int(rng.integers(len(b))), 0] += 8
        bags.append(b)
        y.append(float(i % 2))
    m = quality.train(bags[:200], np.array(y[:200]), epochs=30)
    right = 0
    for b, t in zip(bags[200:], y[200:]):
        e, a = m.passage_values(b)
        s = np.exp(a - a.max())
        right += ((s @ e / s.sum() @ m.w["c"] + m.w["d"])[0] > 0) == bool(t)
    assert right > 85


def test_long_texts_are_read_in_blocks(monkeypatch):
    texts = [" ".join(BASE * 30), "  a\n" + "\n".join(BASE * 20) + " \n ", "日本 é" * 500 + " x" * 300, "y" * 3000 + " z z" * 4000]
    whole = [quality.encode(t) for t in texts]
    monkeypatch.setattr(quality, "_BLOCK_BYTES", 700)
    for t, w in zip(texts, whole):
        assert len(list(quality.blocks(t.encode()))) > 1 and np.array_equal(quality.encode(t), w)


def test_attention_gradient_against_differences():
    """One step of plain descent follows the loss's numeric gradient."""
    rng = np.random.default_rng(11)
    bags = [rng.normal(size=(k, 5)) for k in (1, 3, 4)]
    y = np.array([1.0, 0.0, 1.0])
    p = {"E": rng.normal(size=(5, 4)), "e": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)),
         "a": rng.normal(size=3), "c": rng.normal(size=4), "d": rng.normal(size=1)}
    size = np.array([len(b) for b in bags])

    def loss(q):
        total = 0.0
        for b, t in zip(bags, y):
            m = quality.Model({**q, "mean": np.zeros(5), "spread": np.ones(5)})
            e, a = m.passage_values(b)
            s = np.exp(a - a.max())
            z = s @ e / s.sum() @ q["c"] + q["d"][0]
            total += np.log1p(np.exp(-z if t else z))
        return total / len(bags)

    got = quality.gradient(p, np.concatenate(bags), size, y)
    for k in p:
        for i in np.ndindex(p[k].shape):
            up, down = ({n: x.copy() for n, x in p.items()} for _ in range(2))
            up[k][i] += 1e-6
            down[k][i] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - got[k][i]) < 1e-6, (k, i)


def test_every_passage_is_learned_from(spark, labels, small):
    """One bad passage among 60 good ones is seen, and the total bounds the rows."""
    good = " ".join(BASE[i % len(BASE)] for i in range(5900))
    bad = good[:len(good) // 2] + " " + "#*$ %&| " * 100 + good[len(good) // 2:]
    made = [(i, bad if i % 2 else good) for i in range(60)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 0 if i % 2 else 1) for i in range(60)], "doc_id long, quality int")
    model = quality.fit(docs, marks)
    assert model.score([good])[0] > 0.5 > model.score([bad])[0]
    assert quality.fit(docs, marks, fit_passages=50).base == 0.5            # none fits: nothing to learn from


def test_labels_of_repeated_ids_are_settled(spark):
    rows = [(1, "b"), (1, "a"), (2, None)]
    marks = [(1, 1), (1, 0), (2, 1), (None, 1), (3, None)]
    seen = set()
    for n in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        lab = spark.createDataFrame(marks, "doc_id long, toxic int").repartition(n)
        got = common.labelled_texts(docs, lab, "toxic", id_col="doc_id", text_col="text", limit=10).collect()
        seen.add(tuple(sorted(map(tuple, got))))
    assert len(seen) == 1 and [(r[0], r[2]) for r in seen.pop()] == [(1, 0), (2, 1)]


def test_maximal_segments_by_definition():
    rng = np.random.default_rng(2)
    for _ in range(500):
        # sums that never tie: eighths of different size
        seq = [float(rng.integers(1, 5)) + rng.random() if rng.random() < 0.3 else -0.5 for _ in range(14)]
        at = [i for i, x in enumerate(seq) if x > 0]
        got = {(a, b): s for s, a, b in toxicity.segments(at, [seq[i] for i in at])}

        def split(lo, hi, out):     # the definition: the best segment, then left and right of it
            best = max(((sum(seq[i:j]), i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=None)
            if best and best[0] > 0:
                out[best[1], best[2] - 1] = best[0]
                split(lo, best[1], out)
                split(best[2], hi, out)
            return out
        want = split(0, len(seq), {})
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("total", [400, 20_000])
def test_purely_toxic_tokens_stand_out(spark, total):
    i, toxic = F.col("id"), total // 10          # the first documents are toxic
    word = (F.when(i < 10, "purely").when(i < 20, "mixed").when(i < 23, "seldom").when(i == toxic, "mixed")
            .when(i >= total - 30, "clean").otherwise("other"))
    sample = spark.range(total).select(word.alias("_text"), (i < toxic).cast("int").alias("_label"))
    odds = toxicity.token_odds(sample, total, toxic)
    assert {b"purely", b"mixed"} == {t for t in odds if not t.endswith(b"*")} and odds[b"purely"] > odds[b"mixed"] > 0
    assert next(iter(odds)).startswith(b"pure")            # strongest first


# ------------------------------------------------------------ 5 SpotSigs

@pytest.mark.parametrize("range_rows", [4096, 3])
def test_spotsigs_walk(docs, rows, empty, range_rows):
    got = spotsigs.with_next(docs, range_rows=range_rows).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for i, r in enumerate(order):
        t, n = r[1] or "", order[(i + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        a, b, c = (set(spotsigs.signatures(x).tolist()) for x in (t, e, n))
        near = [1.0 if not x | y else len(x & y) / len(x | y) for x, y in ((a, b), (a, c))]
        want.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), spotsigs.to_string(spotsigs.signatures(t)),
                     spotsigs.to_string(spotsigs.signatures(e)), *near))
    assert Counter(map(tuple, got)) == Counter(want)
    assert spotsigs.with_next(empty).count() == 0 and spotsigs.fingerprints(empty).count() == 0


def test_spotsigs_walk_keeps_rows_of_large_ids_beside_null_ids(spark):
    ids = [(1 << 62) + 7 * i * (1 << 40) + 1 for i in range(24)]
    made = [x for i, n in enumerate(ids) for x in ((n, f"the text number {i}"), (None, f"the other number {i}"))]
    got = spotsigs.with_next(spark.createDataFrame(made, "doc_id long, text string").coalesce(1), range_rows=3).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in made)


@pytest.mark.parametrize("range_rows", [40, 7])
def test_spotsigs_walk_deals_out_hot_ids(spark, range_rows):
    rng = np.random.default_rng(5)
    words = BASE[:12]
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 30)))) for _ in range(90)]
    made = [(None, t) for t in texts] + [(5, t + " of the fifth") for t in texts]       # one id, and none, many texts
    made += [(None, "")] * 130 + [(5, "the same text of one id")] * 130 + [(9, None)] * 60      # equal rows
    made += [(i, f"the plain text of number {i} " * 4) for i in range(-20, 60)]
    made = [made[i] for i in rng.permutation(len(made))]
    stored = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    got = spotsigs.with_next(stored, range_rows=range_rows)
    order = sorted(made, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for i, r in enumerate(order):
        t, n = r[1] or "", order[(i + 1) % len(order)][1] or ""
        e = spotsigs.edited(t, n)
        a, b, c = map(spotsigs.signatures, (t, e, n))
        want.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), spotsigs.to_string(a), spotsigs.to_string(b),
                     spotsigs.likeness(a, b), spotsigs.likeness(a, c)))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == len(made) and max(tasks) <= 4 * range_rows


def test_likeness_pruning():
    a, b = np.arange(0, 100, dtype="uint32"), np.arange(10, 110, dtype="uint32")
    assert spotsigs.likeness(a, b) == spotsigs.likeness(a, b, 0.8) == 90 / 110
    assert spotsigs.likeness(a, b, 0.9) == 0 and spotsigs.likeness(a, b[:20], 0.5) == 0


def test_pruning_keeps_pairs_at_the_threshold():
    for least in (0.5, 0.6, 0.7, 0.8, 0.9):
        starts = spotsigs.length_starts(200, least)
        band = {n: int(np.searchsorted(starts, n, side="right")) for n in range(1, 201)}
        for n in range(1, 61):
            for m in range(n, 61):
                for shared in range(n + 1):
                    near = shared / (n + m - shared)
                    if near >= least:
                        a, b = np.arange(n, dtype="uint32"), np.arange(n - shared, n - shared + m, dtype="uint32")
                        assert spotsigs.likeness(a, b, least) == near and band[m] - band[n] in (0, 1)


@pytest.mark.parametrize("frequent", [1 << 17, 3, 0])
def test_near_copies_against_all_pairs(spark, docs, rows, empty, frequent):
    rng = np.random.default_rng(8)
    lines = []
    for k in range(12):         # families of copies with up to a few words changed, far apart by id
        base = rng.choice(BASE + [f"w{i}" for i in range(60)], int(rng.integers(6, 120))).tolist()
        for _ in range(9):
            w = list(base)
            for i in rng.integers(0, len(w), int(rng.integers(0, 4))):
                w[i] = f"c{int(rng.integers(50))}"
            lines.append(" ".join(w[:len(w) - int(rng.integers(0, 3))]))
    made = [(100 + int(i), t, *[None] * 6) for i, t in zip(rng.permutation(len(lines)), lines)] + rows
    for least in (0.8, 0.5):
        pairs, members = spotsigs.near_copies(spark.createDataFrame(made, docs.schema), least=least, frequent=frequent)
        members = members.collect()
        assert Counter(r.doc_id for r in members) == Counter(r[0] for r in made)
        text = dict((r[0], r[1]) for r in made if r[0] is not None)
        sets = {r.set_id: frozenset(spotsigs.signatures(text[r.doc_id]).tolist()) for r in members if r.doc_id is not None}
        assert all(sets[r.set_id] == set(spotsigs.signatures(text[r.doc_id]).tolist()) for r in members if r.doc_id is not None)
        assert len(set(sets.values())) == len(sets)
        want = {}
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and (near := len(sets[a] & sets[b]) / len(sets[a] | sets[b])) >= least:
                    want[a, b] = near
        got = [tuple(r) for r in pairs.collect() if r.set_a in sets and r.set_b in sets]
        assert len(got) == len(want) > 20 and {(a, b): n for a, b, n in got} == want
    pairs, members = spotsigs.near_copies(empty)
    assert pairs.count() == members.count() == 0


# ------------------------------------------------------------ 7 packing

def test_packing_round_trip(docs, rows, empty, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, vocabulary=path, group_pieces=8).collect()
    ids = {r[0]: np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4") for r in rows if r[0] is not None}
    by, seqs = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    times = Counter(r[0] for r in rows)
    for i, x in ids.items():
        pieces = [(s, min(4096, len(x) - s), zlib.crc32(x[s:s + 4096].tobytes()), len(x)) for s in range(0, len(x), 4096)]
        assert Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by[i]) == Counter(pieces * times[i])
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 4096
    assert packing.pack(empty, vocabulary=path).count() == 0
    monkeypatch.setattr(packing, "BLOCK_CHARS", 50)
    monkeypatch.setattr(packing, "CACHE_STRINGS", 20)
    odd = ["".join(map(chr, range(1, 256))), " ".join(map(chr, range(33, 256))) * 2, "don't WON'T x's 12½³ª µ º ß ÿ×÷ ...!! foo--bar's,",
           "a" * 300 + " b", "", "<|STARTOFTEXT|> İ ǅ ﬁ"]
    texts = [r[1] for r in rows] + odd
    for t, got in zip(texts, packing.Encoder(path).encode(texts)):
        assert got.tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_packing_with_another_vocabulary(docs, rows):
    """Other splitting rules go to the library whole."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    tok = Tokenizer.from_file(path)
    encoder = packing.Encoder(path)
    assert not encoder.short
    texts = [r[1] for r in rows] + ["two  blanks\n\nand lines", "12345 it's"]
    for t, got in zip(texts, encoder.encode(texts)):
        assert got.tolist() == tok.encode(t or "", add_special_tokens=False).ids
    pieces = packing.pack(docs, vocabulary=path, end_id=50256).collect()
    assert sum(p.length for p in pieces) == sum(len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 50, 257):
        lengths = np.sort(rng.integers(1, 101, n))[::-1]
        bins, offsets = packing.first_fit_decreasing(lengths, 100)
        room = []
        for need, b, o in zip(lengths, bins, offsets):
            i = next((i for i, r in enumerate(room) if r >= need), len(room))
            if i == len(room):
                room.append(100)
            assert (b, o) == (i, 100 - room[i])
            room[i] -= need


# ------------------------------------------------------------ 8 quality rules

def test_quality_rules_base(docs, rows, empty, small, labels):
    ratios = rules.fit(small, labels)
    got = Counter(tuple(r)[:6] for r in rules.judge(docs, ratios).drop("ratio", "kept", "base_failed").collect())
    want = Counter()
    for r in rows:
        t = r[1] or ""
        w = words_of(t)
        tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        times = Counter(tri)
        rep = {i + k for i, x in enumerate(tri) if times[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words_of(x)]
        want[(r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))] += 1
    assert got == want
    judged = rules.judge(docs, ratios).collect()
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in judged)
    assert all(not r.kept for r in judged if r.base_failed)
    assert rules.judge(empty, ratios).count() == 0
    assert not rules.fit(docs, labels.limit(0)).any() and not rules.fit(empty, labels).any()


def test_quality_rules_ratio_is_the_multinomial_one(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, None)], "doc_id long, text string")
    raw, good = rules.bucket_counts(d, spark.createDataFrame([(1,)], "doc_id long"), id_col="doc_id", text_col="text")
    one, two = (np.bincount(rules.hashed(x), minlength=rules.BUCKETS) for x in ([b"a", b"b", b"c"], [b"a", b"b", b"d"]))
    assert (raw == one + two).all() and (good == one).all()


def test_trusted_bitmap_never_loses_an_id(spark, monkeypatch):
    monkeypatch.setattr(rules, "FILTER_BITS", 16)
    ids = spark.range(0, 40_000, 7)
    bits = np.unpackbits(rules.bitmap(ids))
    at = ids.select(rules._positions(F.col("id")).alias("p")).toPandas()["p"]
    want = np.zeros(1 << 16, "uint8")
    for p in at:
        want[list(p)] = 1
    assert (bits == want).all() and 0 < want.sum() <= 2 * ids.count()
    assert not rules.bitmap(ids.limit(0)).any()
    assert [rules.filter_power(n) for n in (0, 1 << 11, 1 << 12, 1 << 25, 1 << 26, 1 << 40)] == [16, 16, 17, 30, 30, 30]
    larger = np.unpackbits(rules.bitmap(ids, 19))
    for i, p in enumerate(ids.select(rules._positions(F.col("id"), 19).alias("p")).toPandas()["p"]):
        assert larger[p[0]] and larger[p[1]]
    assert len(larger) == 1 << 19 and larger.sum() <= 2 * ids.count()


def test_trusted_ids_of_another_type(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string")
    ids = spark.createDataFrame([(1,), (1 << 40,), (None,)], "doc_id long")
    _, good = rules.bucket_counts(d, ids, id_col="doc_id", text_col="text")
    assert (good == np.bincount(rules.hashed([b"a"]), minlength=rules.BUCKETS)).all()


@pytest.mark.parametrize("bits", [rules.FILTER_BITS, 15])       # 15: a bitmap so full that others pass it
def test_quality_rules_trust_every_good_label(spark, monkeypatch, bits):
    monkeypatch.setattr(rules, "FILTER_BITS", bits)
    monkeypatch.setattr(rules, "MOST_FILTER_BITS", bits)
    d = spark.range(22_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 40).alias("text"))
    d = d.unionByName(spark.createDataFrame([(None, "none"), (7, "again"), (30_000, "raw")], "doc_id long, text string"))
    good = d.select("doc_id", F.lit(1).alias("quality")).filter("doc_id is null or doc_id < 22000")      # 7 is there twice
    words = np.bincount([rules.hashed([f"w{i % 40}".encode()])[0] for i in range(40)], minlength=rules.BUCKETS) * 550
    trusted = words + np.bincount(rules.hashed([b"again"]), minlength=rules.BUCKETS)
    raw = trusted + sum(np.bincount(rules.hashed([w]), minlength=rules.BUCKETS) for w in (b"none", b"raw"))
    assert np.allclose(rules.fit(d, good), rules.log_ratios(raw.astype(float), trusted.astype(float)), atol=1e-12)


# ------------------------------------------------------------ 9 sharding

@pytest.mark.parametrize("shards", [8, 3])
def test_sharding_is_minimax(docs, rows, empty, shards):
    got = sharding.shard(docs, shards=shards).collect()
    size = Counter()
    for r in rows:
        t = (r[1] or "").encode()
        size[hashlib.sha256(t).digest()] += len(t) + 1
    order = [size[k] for k in sorted(size)]

    def fits(cap):
        n, room = 1, cap
        for s in order:
            if s > cap:
                return False
            if s > room:
                n, room = n + 1, cap
            room -= s
        return n <= shards
    cap = next(c for c in range(max(order), sum(order) + 1) if fits(c))
    held, slots, where = Counter(), {}, {}
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        held[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        if r.doc_id is not None:
            t = text[r.doc_id]
            assert (r["size"], r.text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
            assert where.setdefault(t, r.shard) == r.shard
    assert max(held.values()) == cap and len(got) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(empty).count() == 0


def test_sharding_near_equal(spark):
    got = sharding.op9_sharding(spark, SF).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(got) == 8 and max(r.b for r in got) < 1.25 * min(r.b for r in got)


# ------------------------------------------------------------ 10 mixing

def test_mixing_against_sorting(spark, docs, rows, empty):
    got = mixing.mix(docs).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(words_of(r[1]))
    names = sorted([s for s in size if s is not None]) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, full, total = {}, set(), sum(size.values())
    while True:     # share, cap, share the excess again
        free = [s for s in names if s not in full]
        left = total - sum(3 * size[s] for s in full)
        target = {s: 3.0 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = [s for s in free if target[s] >= 3 * size[s]]
        if not over or len(over) == len(free):
            break
        full |= set(over)
    for r in got:
        assert r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    by = {r[0]: r[3] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            s = by[r.doc_id]
            assert r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
    largest = {s: max(len(words_of(r[1])) for r in rows if r[3] == s) for s in names}
    taken = Counter()
    for r in mixing.mixed_documents(docs).collect():
        taken[r.source] += len(words_of(r.text))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in names)
    again = Counter(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    assert again == Counter(map(tuple, got)) and mixing.mix(empty).count() == 0
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in got) and mixing.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("one_id,same_text", [(7, True), (None, False)])
def test_mixing_meets_targets_beside_hot_ids(spark, one_id, same_text):
    """Rows that share an id, or have none, are taken one by one."""
    made = [(one_id, "x y z " * 10 + ("" if same_text else f" w{i}"), "a", float(i), i) for i in range(900)]
    made += [(10_000 + i, "u v " * 20, "b", 0.5, i) for i in range(300)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string, score double, `a.b` int").repartition(7)
    got = mixing.mix(docs).collect()
    for s, words in (("a", 30 if same_text else 31), ("b", 40)):
        mine = [r for r in got if r.source_size == words * (900 if s == "a" else 300)]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= words / 2 and len(mine) == (900 if s == "a" else 300)
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    rows = Counter(map(tuple, kept.collect()))
    assert sum(rows.values()) == sum(r.copies for r in got) and set(rows) <= set(made)


def test_mixing_matches_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0]: r for r in con.execute(mixing.ORACLE).fetchall()}
    for r in mixing.op10_mixing(spark, SF).collect():
        w = want.pop(r.doc_id)
        assert (r["size"], r.source_size, r.taken) == (w[1], w[2], w[4]) and abs(r.target - w[3]) < 1e-6
    assert not want


# ------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, docs, empty, labels):
    import corpus_pipeline
    at = spark.read.parquet(f"{SF}/documents.parquet")
    seen = at
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == at.columns, name
        rows_in = Counter(tuple(r) for r in seen.collect())
        kept = Counter(tuple(r) for r in out.collect())
        assert kept.keys() <= rows_in.keys(), name
        if name != "source_mixing":
            assert all(n <= rows_in[k] for k, n in kept.items()), name
        seen = spark.createDataFrame(out.collect(), at.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen, SF).collect()
    assert sum(p.start == 0 for p in pieces) == seen.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() is not None
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_rejects_planted_and_keeps_clean(spark, labels):
    import corpus_pipeline
    at = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.STAGES[0][1](spark, at, SF)
    lab = labels.join(at, "doc_id")
    assert lab.filter("quality = 1").join(good, "doc_id", "left_anti").count() <= 0.02 * lab.count()
    assert lab.filter("quality = 0").join(good, "doc_id", "left_semi").count() <= 0.3 * lab.filter("quality = 0").count()
