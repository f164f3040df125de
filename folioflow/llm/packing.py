"""Packing of tokenised documents into fixed-length sequences by the sum-of-squares rule.

Tokens are made once per document; only ids' checksums and lengths go on. Pieces are dealt by hash into groups of
about GROUP_TOKENS tokens (the number of groups grows with the input), and every group is packed by one task: pieces
are taken in descending length, and each goes where the sum over all residual gaps of the squared number of open
sequences with that gap becomes smallest, a new sequence being one of the choices. A group leaves at most a few
sequences partly filled, a share that does not depend on the size of the input.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, materialize, pick, slices, utf8, worker_store

LENGTH = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
#: Tokens and pieces of one packing group.
GROUP_TOKENS = 24_000_000
GROUP_PIECES = 400_000
#: Words whose ids a worker remembers.
CACHE_WORDS = 300_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Texts of these characters alone are already in NFC and lower-cased character by character within them, without context.
PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa0-\u012f\u0131-\u017f]|<\\|")


class Encoder:
    """Ids of texts by the tokenizer TOKENIZER: words of plain texts are looked up, others are left to the library.

    The tokenizer lower-cases, cuts by WORDS and merges bytes within a word only, so a word's ids depend on nothing
    else; its last id is one whose entry ends in the end-of-word mark.
    """

    LETTERS, DIGITS = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"  # of plain lower-cased texts
    WORDS = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\s{LETTERS}{DIGITS}]+"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.known, self.old, self.cut = Tokenizer.from_file(path), {}, {}, re.compile(self.WORDS).findall
        self.bare = Tokenizer.from_file(path)  # merges only: for words that are lower-cased and cut already
        self.bare.normalizer, self.bare.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.CharDelimiterSplit(" ")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the vocabulary
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)} | {32: " "}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for word, i in self.tokenizer.get_vocab().items():
            self.ends[i] = word.endswith("</w>")

    def plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        text = " ".join(words).encode().decode("latin-1").translate(self.letters)
        ids = np.asarray(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        raw = ids.tobytes()
        if len(ends) == len(words):
            self.known.update(zip(words, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        else:
            self.known.update((w, self.plain(w)) for w in words)

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; null is the empty text."""
        text = [(t or b"").decode() for t in texts]
        split = [None if PLAIN.search(t) else self.cut(t.lower()) for t in text]
        new = set().union(*(w for w in split if w is not None)) - self.known.keys()
        if len(self.known) + len(new) > CACHE_WORDS:  # words of the last generation that are still in use come back below
            self.known, self.old = {}, self.known
            new = set().union(*(w for w in split if w is not None))
        if self.old:
            again = new & self.old.keys()
            self.known.update((w, self.old[w]) for w in again)
            new -= again
        new = list(new)
        for i in range(0, len(new), 5000):
            self.learn(new[i : i + 5000])
        get = self.known.__getitem__
        return [self.plain(t) if w is None else b"".join(map(get, w)) for t, w in zip(text, split, strict=True)]


def encoder(path: str) -> Encoder:
    store = worker_store("encoders")
    if path not in store:
        store[path] = Encoder(path)
        give_back()  # reading the tokenizer leaves tens of megabytes
    return store[path]


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and the end id, cut only where they exceed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path or tokenizer_path())
        end = np.asarray([END], "<u4").tobytes()
        for b in (x for batch in batches for x in slices(batch, 1)):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), encode(utf8(b.column(1))), strict=True):
                ids += end
                for p, start in enumerate(range(0, len(ids), 4 * length)):
                    own = ids[start : start + 4 * length]
                    rows.append((doc, p, start // 4, len(own) // 4, zlib.crc32(own)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if k == 1 else pa.int64()) for k, x in enumerate(zip(*rows, strict=True) if rows else [[]] * 5)], names)
            del rows
            give_back()

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return pick(docs, doc_id="doc_id bigint", text="text string").mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every item, by the sum-of-squares rule over items in descending size."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i in order.tolist():
        s = int(sizes[i])
        gap = -1
        if s < capacity:
            here = count[s:capacity]
            change = np.where(here > 0, 2 * (count[: capacity - s] - here) + 2, 1 << 60)
            change[0] -= here[0] > 0  # a full sequence has no gap to count
            gap = int(change.argmin())
            if change[gap] > 2 * count[capacity - s] + 1:
                gap = -1
        if gap < 0:
            number, left = used, capacity
            used += 1
        else:
            left = gap + s
            number = stacks[left].pop()
            count[left] -= 1
        bins[i], offsets[i] = number, capacity - left
        left -= s
        if left:
            stacks[left].append(number)
            count[left] += 1
    return bins, offsets


def packed(found: DataFrame, length: int = LENGTH, group_tokens: int = GROUP_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32)."""
    size = found.agg(F.sum("length").alias("tokens"), F.count("*").alias("pieces")).first()
    groups = max(1, -(-(size.tokens or 0) // group_tokens), -(-size.pieces // group_pieces))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"

    def run(t: pa.Table) -> pa.Table:
        group = t.column("group")[0].as_py()
        t = t.drop_columns("group").sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = pack(t.column("length").to_numpy(), length)
        return t.append_column("sequence_id", pa.array(bins + (group << 40))).append_column("offset", pa.array(offsets))

    dealt = found.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Sequences of at most length tokens from docs (doc_id, text), one row per piece.

    Null and empty texts are a document of the end id alone; repeated rows are packed each; a null doc_id is kept.
    Other columns are ignored. path: the tokenizer's file, by default the public one named TOKENIZER.
    """
    return packed(materialize(pieces(docs, path, length), "pieces"), length)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return pack_documents(table(spark, sf_dir, "documents"))
