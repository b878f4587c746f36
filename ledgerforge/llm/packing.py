"""Packing of token pieces into sequences: first-fit decreasing on a tournament tree, in randomised groups.

Steps: (1) tokenise and cut each document, written once as narrow rows (no ids); (2) deal the pieces to groups of about
`group_pieces` rows by a random number that each piece got; (3) pack every group by itself. Groups are of equal size whatever
the sources or ids are, so no key can make one task large, and a group is all that a task holds.
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
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.taskcontext import TaskContext

from ledgerforge.llm.common import col, free, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long"
#: Words whose ids a worker remembers; the memory is emptied at that size, so it is bounded on any corpus.
CACHE_WORDS = 1_000_000
#: A mark between a lower-case Latin-1 letter and white space: a token of its own.
MARK = re.compile(rb"[.,;:!?](?<=[a-z\xdf-\xf6\xf8-\xff].)(?=[\x20\x09-\x0D])")
#: Characters that are looked up at once.
SLICE_CHARS = 400_000


class WordEncoder:
    """Token ids of texts as little-endian uint32 bytes, equal to those for the whole text at once.

    Only for tokenizers that drop white space between words, lower letters and mark the last token of a word with `</w>`: no
    token then spans white space, so the ids of a text are those of its words in turn, which a cache answers. In texts of
    Latin-1 letters, case and marks behind a word are split off first, which nothing composes with there; other texts are only
    split at ASCII white space. The first words stay in the cache, the later ones only until it is full, so its memory is
    bounded on any corpus.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[bytes | str, bytes] = {}
        self.recent: list[bytes | str] = []
        self.cache_words = cache_words

    def _learn(self, words: list[bytes | str]) -> None:
        """Asks the tokenizer for words: those of letters alone in one text, whose ids are told apart by the words' ends."""
        text = {w: w if isinstance(w, str) else w.decode("latin-1") for w in words}
        letters = [w for w in text if isinstance(w, bytes) and text[w].isalpha()]
        if letters:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(text[w] for w in letters)], add_special_tokens=False)[0].ids, "<u4")
            cuts = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
            if len(cuts) == len(letters) + 1:
                raw = ids.tobytes()
                for w, a, b in zip(letters, cuts, cuts[1:], strict=False):
                    self.cache[w] = raw[a:b]
                    del text[w]
        found = self.tokenizer.encode_batch_fast(list(text.values()), add_special_tokens=False)
        self.cache.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(text, found, strict=True))
        if len(self.cache) > self.cache_words * 3 // 4:
            self.recent += words

    def batch(self, texts: list[str]) -> list[bytes]:
        words: list[bytes | str] = []
        ends = []
        for x in texts:
            try:
                words += MARK.sub(rb" \g<0>", x.encode("latin-1").lower()).split() if "<|" not in x else map(bytes.decode, x.encode().split())
            except UnicodeEncodeError:
                words += [w.decode("utf-8", "replace") for w in x.encode("utf-8", "replace").split()]
            ends.append(len(words))
        ids = list(map(self.cache.get, words))
        new = [k for k, i in enumerate(ids) if i is None]
        if new:
            self._learn(list({words[k]: None for k in new}))
            for k in new:
                ids[k] = self.cache[words[k]]
            if len(self.cache) > self.cache_words:
                for w in self.recent:
                    self.cache.pop(w, None)
                self.recent = []
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def __call__(self, text: str) -> bytes:
        return self.batch([text])[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a well-mixed 64-bit number for each counter."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null: empty) of a batch's first two columns, some SLICE_CHARS at a time."""
    docs, texts, chars = [], [], 0
    for doc, text in zip(batch.column(0), batch.column(1), strict=True):
        docs.append(doc.as_py())
        texts.append(text.as_py() or "")
        chars += len(texts[-1])
        if chars >= SLICE_CHARS:
            yield docs, texts
            docs, texts, chars = [], [], 0
    yield docs, texts


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of at most `capacity` ids: full pieces first, the rest of the document last.

    A null or empty text is a document of the end id alone. Every input row is a document of its own, repeated rows too.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = WordEncoder(tokenizer), np.array([end_id], "<u4").tobytes()
        seen = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for docs, texts in slices(batch):
                for doc, ids in zip(docs, encode.batch(texts), strict=True):
                    ids += end
                    n = len(ids) // 4
                    rows += [(doc, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)]), n) for s in range(0, n, capacity)]
            deal = (mixed(np.arange(seen, seen + len(rows))) >> np.uint64(1)).astype(np.int64)
            seen += len(rows)
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(deal)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"])

    return docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text")).mapInArrow(cut, PIECES)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length by first-fit decreasing.

    The tree's leaves are the bins' free room, its inner nodes the larger of two; going left wherever enough room is found there
    leads to the first bin that fits in log(bins) steps. A new bin is simply the first leaf that nobody used.
    """
    n = len(lengths)
    size = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * size)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        at = 1
        while at < size:
            at *= 2
            if room[at] < length:
                at += 1
        bins[k], offsets[k] = at - size, capacity - room[at]
        room[at] -= length
        at //= 2
        while at:
            most = room[2 * at] if room[2 * at] >= room[2 * at + 1] else room[2 * at + 1]
            if room[at] == most:
                break
            room[at] = most
            at //= 2
    return bins, offsets


def pack_pieces(pieces: DataFrame, *, capacity: int = 2048, group_pieces: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` (1 to capacity) and a random `deal`.

    Sequence ids are unique, not gapless: the group's number times 2^32, plus the bin within the group. The lengths in a sequence
    follow each other from offset 0 without a gap. Other columns stay, but for `deal` and any that are called as the new ones. An empty
    table gives an empty table. The pieces are read twice, to count them and to pack them: pass a written table.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    names = [c for c in pieces.columns if c.lower() not in ("deal", "sequence_id", "offset")]
    schema = StructType([*(pieces.schema[c] for c in names), StructField("sequence_id", LongType()), StructField("offset", LongType())])
    [group] = free(pieces.columns, "__group")

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("deal").select(names).combine_chunks()
        bins, offsets = first_fit(rows["length"].to_numpy(), capacity)
        return rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins)).append_column("offset", pa.array(offsets))

    return pieces.withColumn(group, F.col("deal") % groups).groupBy(group).applyInArrow(lambda key, rows: pack(key, rows.drop_columns(group)), schema)


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, group_pieces: int = 4096) -> DataFrame:
    """Packs all documents (doc_id, text) into sequences; one row per piece (see token_pieces and pack_pieces).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Columns of docs but doc_id and text don't matter.
    """
    return pack_pieces(written(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id), "pieces"), capacity=capacity, group_pieces=group_pieces)
