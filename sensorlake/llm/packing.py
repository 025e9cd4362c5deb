"""Packing (operator 7): first-fit decreasing in randomised groups.

1. Every document becomes token ids (``tokenizers``; null text: none) plus one
   end id, and is cut into pieces of at most ``capacity`` ids. Only the
   pieces' numbers are kept (id, start, length, CRC of the ids). Arrow splits a
   block of texts and finds its distinct strings; only those reach Python.
2. The pieces are written once to the shared work folder. A salted hash of the
   stored row gives each a group; the number of groups follows the number of
   pieces, so that a group has about ``group_pieces`` of them at any size, and
   no key, however hot, decides where a row goes.
3. Each group is packed on its own: pieces from long to short, each into the
   first bin with room. A tournament tree over the bins' free capacities finds
   that bin in O(log n).

A sequence that is full to a power of two needs no padding; every other one is
padded to ``capacity``. Defined cases: null or empty text gives one piece with
the end id alone; repeated rows are packed as documents of their own; a null id
is carried along; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable
from . import common

CAPACITY = 4096
END_ID = 2
GROUP_PIECES = 8192
BLOCK_CHARS = 1 << 23        # texts are encoded so many characters at a time; longer ones are cut at blanks
CACHE_STRINGS = 1_000_000    # strings between blanks that a worker remembers; emptied when full
JOINED_WORDS = 200           # new words given to the library in one text

# The splitting rules that the short way below holds for (fixed values). A
# vocabulary with any other is left to the library, whole texts at a time.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

# That rule for lower-cased text of U+0000-U+00FF (letters, single digits, runs
# of anything else); other texts go to the library whole.
_LATIN_WORD = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+"
    "|[0-9²³¹¼-¾]"
    "|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
# The bytes of Latin-1 that the short way covers: no control characters or
# no-break blanks, which libraries class differently.
_SIMPLE = bytes([*range(9, 14), *range(32, 127), *(b for b in range(161, 256) if b != 173)])


def _is_simple(text: str) -> bool:
    """Only covered characters, and nothing that may be a special token."""
    try:
        return not text.encode("latin-1").translate(None, _SIMPLE) and "<|" not in text
    except UnicodeEncodeError:
        return False


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for U+0100 and up in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _blocks(text: str) -> Iterator[str]:
    """Parts of at most about BLOCK_CHARS, cut at a blank or a line end; no
    token reaches over one."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        cut = max(text.rfind(" ", at, at + BLOCK_CHARS), text.rfind("\n", at, at + BLOCK_CHARS))
        if cut <= at:
            cut = text.find(" ", at + BLOCK_CHARS)
            if cut < 0:
                break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenated slices flat[start:start + size]."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


class _Known:
    """Ids of strings: a slot for each, and the slots' ids one after the other."""

    def __init__(self):
        self.slots: dict[str, int] = {"": 0}
        self.starts, self.sizes, self.flat = np.zeros(1, "int64"), np.zeros(1, "int64"), np.zeros(0, "<u4")

    def add(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.slots.update(zip(strings, range(len(self.sizes), len(self.sizes) + len(strings))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, ids])


class Encoder:
    """Texts to ids. Strings between blanks recur, so a worker has each encoded
    once, remembers it, and puts a block's ids together by array operations."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.whole = Tokenizer.from_file(vocabulary)
        rules = json.loads(self.whole.to_str())
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.short = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER and bool(suffix)
        if not self.short:
            return
        self.words = Tokenizer(self.whole.model)     # the model alone: input is split words
        self.words.pre_tokenizer = WhitespaceSplit()
        self.letters = _byte_letters()
        vocab = self.whole.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.cache = common.worker_cache(f"ids of strings, {vocabulary}")
        self.cache.setdefault("known", _Known())

    def _learn_words(self, words: list[str]) -> None:
        """Many words go to the library as one text; the ids that end a word
        cut the answer into the words' ids again."""
        spelled = [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        joined = [" ".join(spelled[i:i + JOINED_WORDS]) for i in range(0, len(spelled), JOINED_WORDS)]
        ids = np.array([i for code in self.words.encode_batch_fast(joined, add_special_tokens=False) for i in code.ids], "<u4")
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary has no id that ends each word")
        self.cache["known"].add(words, ids, np.diff(stops, prepend=0))

    def _slots(self, strings: list[str]) -> np.ndarray:
        """The slots of lower-cased strings between blanks. A string of letters
        is one word; the others are split by the vocabulary's rule."""
        if len(self.cache["known"].slots) > CACHE_STRINGS:
            self.cache["known"] = _Known()
        known = self.cache["known"]
        found = np.fromiter(map(known.slots.get, strings, repeat(-1)), "int64", len(strings))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [strings[i] for i in missing.tolist()]
            mixed = [s for s in new if not s.isalpha()]
            parts = [_LATIN_WORD.findall(s) for s in mixed]
            words = {w for p in parts for w in p}.difference(known.slots)
            words.update(s for s in new if s.isalpha())
            if words:
                self._learn_words(list(words))
            # a mixed string of one part is that part, known by now
            mixed, parts = [x for x, p in zip(mixed, parts) if len(p) > 1], [p for p in parts if len(p) > 1]
            if mixed:
                at = np.array([known.slots[w] for p in parts for w in p])
                firsts = np.cumsum([0, *map(len, parts)])[:-1]
                known.add(mixed, _gather(known.flat, known.starts[at], known.sizes[at]), np.add.reduceat(known.sizes[at], firsts))
            found[missing] = np.fromiter(map(known.slots.__getitem__, new), "int64", len(new))
        return found

    def _simple_ids(self, blocks: list[str]) -> list[np.ndarray]:
        """The ids of simple texts, all at once."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(blocks, pa.string())))
        coded = split.flatten().dictionary_encode()
        slots = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[np.asarray(coded.indices)]
        known = self.cache["known"]
        sizes = known.sizes[slots]
        ids = _gather(known.flat, known.starts[slots], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.asarray(split.offsets)]
        return [ids[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def _encode_blocks(self, blocks: list[str]) -> list[np.ndarray]:
        simple = [self.short and _is_simple(x) for x in blocks]
        quick = iter(self._simple_ids([x for x, s in zip(blocks, simple) if s]) if any(simple) else ())
        return [next(quick) if s else np.array(self.whole.encode(x, add_special_tokens=False).ids, "<u4")
                for x, s in zip(blocks, simple)]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order, as little-endian unsigned 32-bit numbers."""
        cut = [list(_blocks(text) if self.short else [text]) if text else [] for text in texts]
        at = 0
        while at < len(cut):
            chars, to = 0, at
            while to < len(cut) and (to == at or chars < BLOCK_CHARS):
                chars += sum(map(len, cut[to]))
                to += 1
            here: list[str] = [block for blocks in cut[at:to] for block in blocks]
            if chars > 2 * BLOCK_CHARS:          # a long text: block by block
                done = iter([ids for block in here for ids in self._encode_blocks([block])])
            else:
                done = iter(self._encode_blocks(here))
            for blocks in cut[at:to]:
                ids = [next(done) for _ in blocks]
                yield ids[0] if len(ids) == 1 else np.concatenate([np.zeros(0, "<u4"), *ids])
            at = to


def cut_pieces(docs: DataFrame, *, id_col: str, text_col: str, vocabulary: str,
               capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        for ids_of, texts in held(batches):
            row, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(encoder.encode(texts)):
                n = len(ids) + 1
                for at in range(0, n, capacity):
                    piece = np.ascontiguousarray(ids[at:at + capacity])
                    last = at + capacity >= n            # with the end id
                    row.append(i)
                    start.append(at)
                    length.append(len(piece) + last)
                    crc.append(zlib.crc32(end, zlib.crc32(piece)) if last else zlib.crc32(piece))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [ids_of.take(pa.array(row, pa.int64())), *[pa.array(c, pa.int64()) for c in (start, length, crc, total)]],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens"])

    def held(batches):
        """Batches joined up to about a block: words of larger blocks recur more."""
        ids_of, texts, size = [], [], 0
        for batch in batches:
            ids_of.append(batch.column(0))
            texts += batch.column(1).to_pylist()
            size += batch.column(1).nbytes
            if size >= BLOCK_CHARS:
                yield pa.concat_arrays(ids_of), texts
                ids_of, texts, size = [], [], 0
        if ids_of:
            yield pa.concat_arrays(ids_of), texts

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; ``lengths`` must be sorted from long to
    short. The tree's leaves are bins, an inner node the most room below it."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, "int64"), np.empty(n, "int64")
    for i, need in enumerate(lengths.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < need:
                at += 1
        bins[i], offsets[i] = at - leaves, capacity - room[at]
        room[at] -= need
        at //= 2
        while at:
            a, b = room[2 * at], room[2 * at + 1]
            most = a if a >= b else b
            if room[at] == most:
                break
            room[at] = most
            at //= 2
    return bins, offsets


def pack(docs: DataFrame, *, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` (unique over all groups) and ``offset``."""
    pieces = durable(cut_pieces(docs, id_col=id_col, text_col=text_col, vocabulary=vocabulary,
                                capacity=capacity, end_id=end_id), "pieces")
    groups = -(-pieces.count() // group_pieces) or 1
    # the row's place in the stored table salts the hash: repeated rows spread too
    salted = pieces.withColumn("_group", F.pmod(
        F.xxhash64(id_col, "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", id_col, "start", "ids_crc32"], ascending=[False, True, True, True],
                                  kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        group["sequence_id"] = group.pop("_group") * (1 << 32) + bins
        group["offset"] = offsets
        return group

    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()),
                                                  T.StructField("offset", T.LongType())])
    return salted.groupBy("_group").applyInPandas(run, schema)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    import public_tokenizers
    common.prepare(spark)
    return pack(common.documents(spark, sf_dir), vocabulary=str(public_tokenizers.path("word_bpe_49k.json")))
