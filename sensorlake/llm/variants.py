"""Spelling variant grouping (operator 12): frequency-vector trie.

1. Words are counted per task (a bounded table of partial counts) and summed by
   word. Every code point of a word is below U+0100, so words travel as their
   Latin-1 bytes: one byte a letter, and byte order is code-point order.
2. A word's frequency vector holds its count of each letter group. The words
   are arranged in a trie, one level per group. Words at one insertion,
   deletion or replacement differ by a surplus of one in at most one group and
   a deficit of one in at most one: the depth-first search spends that budget
   and follows equal counts everywhere else. To find each pair once, a search
   goes to words of the same length (the surplus before the deficit) and to
   words one longer (a surplus only). The words at the leaves it ends at are
   verified letter by letter.
3. The trie's first levels (length and the first ``TOP`` groups) are the shuffle
   key: a word searches the up to seven subtrees that the budget reaches. A
   subtree of more than ``trie_words`` words is dealt over several pieces by a
   hash, and its searches go to each of them; one with more than ``search_words``
   searches has its pieces several times, each with a share of the searches. No
   task gets more of either, nothing is capped. A task reads its piece, then the
   searches as a stream of batches.
4. A word's form is its most frequent near word if that is ``ratio`` times as
   frequent; forms are followed to the last by pointer doubling. Counts rise
   along the way by ``ratio``, so the rounds are the logarithm of a logarithm of
   the largest count, and a word has no more near words than its length times
   the alphabet allows, so no key of these joins is hot.

Defined cases: null and empty texts have no words; a null id counts as an empty
one; repeated rows count again; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import common

DELETE_EVERY = 31
LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
TRIE_WORDS = 1 << 14         # words of one subtree in one task
TRIE_BYTES = 1 << 22
SEARCH_WORDS = 1 << 15       # searches of one piece of a subtree in one task
FLUSH_WORDS = 1 << 18        # distinct words a task counts before it passes them on
SEARCH_ROWS = 1 << 14        # searches that go down together
PAIR_BYTES = 1 << 24         # candidate letters verified at a time

# Letter groups: one level of the trie each, then the other letters of a-z, then
# U+00C0-U+00FF. The choice decides the speed, not the result.
LETTERS = "entaiohrsulcdfgb"
TOP = 2
GROUPS = len(LETTERS) + 2


def _group_of_byte() -> np.ndarray:
    table = np.full(256, GROUPS - 1, "u1")
    table[97:123] = GROUPS - 2
    for i, letter in enumerate(LETTERS):
        table[ord(letter)] = i
    return table


# Bytes of a word's letters, A-Z lowered; everything else a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def text_words(ident: str | None, text: str, *, delete_every: int = DELETE_EVERY,
               least_chars: int = LEAST_CHARS) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of one text, the letter already deleted where the
    hash of id and run says so."""
    runs = text.encode("latin-1", "replace").translate(_FOLD).split()
    seed = zlib.crc32(f"{ident or ''}:".encode())
    for run, n in Counter([r for r in runs if len(r) >= least_chars]).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % delete_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least_chars:
                continue
        yield run, n


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", delete_every: int = DELETE_EVERY,
                least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(``word`` as Latin-1 bytes, ``n``) of all words that occur often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counted):
            return pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.binary()), pa.array(counted.values(), pa.int64())],
                                              names=["word", "n"])
        held: dict[bytes, int] = {}
        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                for word, n in text_words(ident, text, delete_every=delete_every, least_chars=least_chars):
                    held[word] = held.get(word, 0) + n
                if len(held) > FLUSH_WORDS:
                    yield out(held)
                    held = {}
        yield out(held)

    partial = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")).mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# ------------------------------------------------------------ the trie

def frequency_vectors(letters: np.ndarray) -> np.ndarray:
    """(words, GROUPS) counts of (words, length) letters."""
    groups = _group_of_byte()[letters]
    return np.stack([(groups == g).sum(axis=1, dtype="int32") for g in range(GROUPS)], axis=1).astype("int64")


def _lanes(letters: np.ndarray) -> np.ndarray:
    """Letters eight to an integer, for comparisons of whole words."""
    rows, width = letters.shape
    padded = np.zeros((rows, -(-width // 8) * 8), "u1")
    padded[:, :width] = letters
    return padded.view("<u8")


class Trie:
    """Words of one length that agree on the counts of the first ``TOP`` groups.
    A node of level k is a distinct beginning of k counts; a level is the sorted
    array of (parent node, count)."""

    def __init__(self, letters: np.ndarray):
        self.letters, self.lanes = letters, _lanes(letters)
        vectors = frequency_vectors(letters)
        self.widths, self.levels = [], []
        node = np.zeros(len(letters), "int64")
        for k in range(GROUPS):
            width = int(vectors[:, k].max()) + 1
            level, node = np.unique(node * width + vectors[:, k], return_inverse=True)
            self.widths.append(width)
            self.levels.append(level)
        self.order = np.argsort(node, kind="stable")
        self.sizes = np.bincount(node, minlength=len(self.levels[-1]))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _child(self, k: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have a child of that count, and the child's number."""
        level, width = self.levels[k], self.widths[k]
        wanted = node * width + count
        at = np.minimum(np.searchsorted(level, wanted), len(level) - 1)
        return (level[at] == wanted) & (count >= 0) & (count < width), at

    def search(self, vectors: np.ndarray, longer: int, surplus: int, deficit: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(search, leaf, spent) of every leaf that the budget reaches from the
        top levels, of which ``surplus`` and ``deficit`` are spent already.
        ``longer`` is what the trie's words have more in length."""
        return self._descend(TOP, np.arange(len(vectors)), np.zeros(len(vectors), "int64"), vectors, longer, surplus, deficit)

    def _descend(self, k, index, node, vectors, longer, surplus, deficit):
        if not len(index):
            return
        if k == GROUPS:
            if surplus - deficit == longer:
                yield index, node, bool(surplus)
            return
        count = vectors[index, k]
        for more, fewer in ((0, 0), (1, 0), (0, 1)):
            if surplus + more > 1 or deficit + fewer > 1 - longer or (fewer and not surplus):
                continue
            hit, child = self._child(k, node, count + more - fewer)
            yield from self._descend(k + 1, index[hit], child[hit], vectors, longer, surplus + more, deficit + fewer)

    def near(self, letters: np.ndarray, longer: int, surplus: int, deficit: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(search, word, both): pairs at one edit; ``both`` if the search of the
        other word does not give the pair again."""
        lanes = _lanes(letters)
        at_once = max(1, PAIR_BYTES // (self.letters.shape[1] + 8))
        for first in range(0, len(letters), SEARCH_ROWS):
            block = letters[first:first + SEARCH_ROWS]
            for index, leaf, spent in self.search(frequency_vectors(block), longer, surplus, deficit):
                sizes = self.sizes[leaf]
                ends = np.cumsum(sizes)
                total = int(ends[-1])
                for a in range(0, total, at_once):       # candidates a to b, counted over all leaves
                    b = min(total, a + at_once)
                    candidates = np.arange(a, b)
                    which = np.searchsorted(ends, candidates, side="right")
                    one = index[which] + first
                    other = self.order[self.starts[leaf[which]] + candidates - (ends[which] - sizes[which])]
                    hit = (one_inserted(letters, self.letters, one, other) if longer
                           else one_replaced(lanes, self.lanes, one, other))
                    if hit.any():
                        yield one[hit], other[hit], spent or bool(longer)


_LOW7, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def one_replaced(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[j] of one length differ in exactly one letter."""
    differ = np.zeros(len(i), "u1")
    for lane in range(a.shape[1]):
        x = a[i, lane] ^ b[j, lane]
        x = (((x & _LOW7) + _LOW7) | x) & _HIGH             # the high bit of each byte that differs
        differ = np.minimum(differ + np.bitwise_count(x), 2)
    return differ == 1


def one_inserted(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether b[j], one letter longer, is a[i] with one letter inserted."""
    short, long = a[i], b[j]
    width = short.shape[1]
    lead = np.logical_and.accumulate(short == long[:, :width], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate(short[:, ::-1] == long[:, :0:-1], axis=1).sum(axis=1)
    return lead + tail >= width


# ------------------------------------------------------------ the search as a Spark job

# What a word's search spends on the top levels: length, counts of the first two
# groups, surplus, deficit. A deficit before a surplus is the other word's search.
_REACH = [(0, 0, 0, 0, 0), (0, 1, 0, 1, 0), (0, 0, 1, 1, 0), (0, 1, -1, 1, 1),
          (1, 0, 0, 0, 0), (1, 1, 0, 1, 0), (1, 0, 1, 1, 0)]
_KEY = ["len", "c0", "c1"]


def _letters(words: pa.Array) -> np.ndarray:
    """(words, length) bytes of binary values of one length."""
    offsets = np.frombuffer(words.buffers()[1], "<i4", len(words) + 1, words.offset * 4)
    width = (offsets[-1] - offsets[0]) // len(words)
    return np.frombuffer(words.buffers()[2], "u1", offsets[-1] - offsets[0], offsets[0]).reshape(len(words), width)


def _search_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by subtree, its words (``reach`` -1) before the searches."""
    def out(*columns):
        return pa.RecordBatch.from_arrays(list(columns), names=["word", "near", "near_n"])

    open_key, held, trie, words, counts = None, [], None, None, None
    for batch in batches:
        reach = batch.column("reach").to_numpy()
        key = np.stack([batch.column(c).to_numpy() for c in (*_KEY, "salt", "share")] + [reach], axis=1)
        bounds = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1)) + 1).tolist(), len(key)]
        for s, e in zip(bounds, bounds[1:]):
            if s == e:
                continue
            if (here := tuple(key[s, :-1].tolist())) != open_key:
                open_key, held, trie = here, [], None
            part = batch.slice(s, e - s)
            if reach[s] < 0:
                held.append(part)
                continue
            if not held:
                continue
            if trie is None:
                words = pa.concat_arrays([p.column("word") for p in held])
                counts = pa.concat_arrays([p.column("n") for p in held])
                trie = Trie(_letters(words))
            longer, _, _, surplus, deficit = _REACH[reach[s]]
            asked, asked_n = part.column("word"), part.column("n")
            for one, other, both in trie.near(_letters(asked), longer, surplus, deficit):
                one, other = pa.array(one), pa.array(other)
                yield out(asked.take(one), words.take(other), counts.take(other))
                if both:
                    yield out(words.take(other), asked.take(one), asked_n.take(one))


def near_words(words: DataFrame, *, trie_words: int = TRIE_WORDS, trie_bytes: int = TRIE_BYTES,
               search_words: int = SEARCH_WORDS) -> DataFrame:
    """(``word``, ``near``, ``near_n``) for every pair at one edit, in both
    directions, of a stored (``word``, ``n``) frame of distinct words."""
    text = F.decode("word", "ISO-8859-1")
    size = F.octet_length("word")
    keyed = words.select("word", "n", size.alias("len"), *[
        (size - F.length(F.replace(text, F.lit(LETTERS[k]), F.lit("")))).alias(f"c{k}") for k in range(TOP)])
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(("i", "dl", "d0", "d1"), (i, *r))])
                                for i, r in enumerate(_REACH)])).alias("r")
    reached = [(F.col("len") + F.col("r.dl")).alias("len"), (F.col("c0") + F.col("r.d0")).alias("c0"),
               (F.col("c1") + F.col("r.d1")).alias("c1")]
    # one row per length and count of two letters
    held = durable(keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("held")), "subtree-sizes")
    searches = (held.select(*_KEY, "held", steps).select(*reached, "held").groupBy(*_KEY).agg(F.sum("held").alias("asked")))
    subtrees = durable(held.join(searches, _KEY).select(
        *_KEY, F.greatest(F.ceil(F.col("held") / trie_words), F.ceil(F.col("held") * F.col("len") / trie_bytes)).cast("int").alias("pieces"),
        F.ceil(F.col("asked") / search_words).cast("int").alias("shares")), "subtrees")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def one_of(n: str, seed: int):
        return F.pmod(F.xxhash64("word", F.lit(seed)), F.col(n)).cast("int")

    words_in = (keyed.join(subtrees, _KEY).withColumn("salt", one_of("pieces", 1)).withColumn("share", every("shares"))
                .withColumn("reach", F.lit(-1)))
    asked = (keyed.select("word", "n", *_KEY, steps).select("word", "n", *reached, F.col("r.i").alias("reach"))
             .join(subtrees, _KEY).withColumn("share", one_of("shares", 2)).withColumn("salt", every("pieces")))
    rows = ["word", "n", *_KEY, "salt", "share", "reach"]
    dealt = (words_in.select(*rows).unionByName(asked.select(*rows))
             .repartition(*_KEY, "salt", "share").sortWithinPartitions(*_KEY, "salt", "share", "reach"))
    return dealt.mapInArrow(_search_subtrees, "word binary, near binary, near_n long")


def follow(links: DataFrame) -> DataFrame:
    """(``word``, ``root``) from (``word``, ``form``): the last of the forms that
    follow each other, by pointer doubling."""
    roots = durable(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("_at"), F.col("root").alias("_further"))
        step = durable(roots.join(ahead, roots["root"] == ahead["_at"], "left")
                       .select("word", F.coalesce("_further", "root").alias("root"),
                               F.col("_further").isNotNull().alias("_moved")), "roots")
        roots = step.select("word", "root")
        if step.filter("_moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", delete_every: int = DELETE_EVERY,
                      least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                      trie_words: int = TRIE_WORDS, trie_bytes: int = TRIE_BYTES, search_words: int = SEARCH_WORDS) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = durable(word_counts(docs, id_col=id_col, text_col=text_col, delete_every=delete_every,
                                least_chars=least_chars, least_count=least_count), "words")
    near = near_words(words, trie_words=trie_words, trie_bytes=trie_bytes, search_words=search_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    formed = durable(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("_best.less") >= ratio * F.col("n"), F.col("_best.near")).alias("form"),
        F.when(-F.col("_best.less") >= ratio * F.col("n"), -F.col("_best.less")).alias("form_n")), "forms")
    roots = follow(formed.filter(F.col("form").isNotNull()).select("word", "form"))
    text = [F.decode(c, "ISO-8859-1").alias(c) for c in ("word", "form", "root")]
    return (formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
            .select(*text, "n", "n_near", "form_n"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words and forms."""
    common.prepare(spark)
    return spelling_variants(common.documents(spark, sf_dir))
