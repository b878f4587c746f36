"""Quality rules by repetition coverage: characters of a text inside duplicated n-grams and lines, by rolling hashes in numpy.

Each text is judged by itself, whole; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
#: Words an n-gram, and the largest share of a text's word characters that may lie in n-grams of that length found twice. Short n-grams
#: tell phrases that come again with other words between, or words said over and over; of sf0.1's clean texts none is beyond these.
NGRAM_LIMITS = {3: 0.50, 4: 0.40, 5: 0.25, 8: 0.22, 13: 0.22}
#: The largest share of a text's characters that may lie in lines equal to an earlier line.
LINE_LIMIT = 0.30
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, dup_line_chars long, dup_ngram_chars array<long>, kept boolean"


def words_of(text: str) -> list[bytes] | list[str]:
    """The runs of characters other than ASCII white space, each as long as it has code points; equal words are equal."""
    try:
        return text.encode("latin-1").split()
    except UnicodeEncodeError:
        return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def rolled(x: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit polynomial hash of each window of n numbers."""
    out, base = x[: len(x) - n + 1].copy(), np.uint64(0x94D049BB133111EB)
    for k in range(1, n):
        out = out * base + x[k : len(x) - n + 1 + k]
    return out


def repeated(ids: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window of n words that the text has twice or more."""
    covered = np.zeros(len(ids), bool)
    if len(ids) <= n:
        return covered
    hashes = rolled(ids, n)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    if same.any():
        twice = np.zeros(len(hashes), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        for k in range(n):
            covered[k : k + len(twice)] |= twice
    return covered


def measure(text: str, limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> tuple:
    words = words_of(text)
    n = len(words)
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    chars = np.fromiter(map(len, words), np.int64, n)
    # spread the numbers over 64 bits, so that sums of products of small numbers don't meet
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(29)
    ids *= np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(32)
    word_chars = int(chars.sum())
    covered = {k: repeated(ids, k) for k in {5, *limits}}
    n_repeat = int(covered[5].sum())
    dup = {k: int(chars[covered[k]].sum()) for k in limits}
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines, dup_chars = dup_lines + 1, dup_chars + len(line)
        elif line.strip(SPACE):
            seen.add(line)
    failed = n < 10 or 100 * n_repeat > 20 * n
    kept = not failed and all(dup[k] <= share * word_chars for k, share in limits.items()) and dup_chars <= line_limit * len(text)
    return n, word_chars, sum(map(text.count, SYMBOLS)), dup_lines, n_repeat, failed, dup_chars, list(dup.values()), kept


def quality_rules(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """Per row of docs its measures, and `kept`: false if the base rules fail or a text repeats itself beyond a limit.

    base_failed: under 10 words, or over a fifth of the words in 5-word windows found twice. A null or empty text has no words
    and fails. Repeated rows are rows of their own; other columns of docs don't matter.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(x.as_py() or "", limits, line_limit) for x in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], RESULT_NAMES)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(judge, RESULT)


def filter_quality(docs: DataFrame, *, text: str = "text", limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns. Nothing is shuffled and no key is needed."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([measure(x.as_py() or "", limits, line_limit)[-1] for x in batch.column(at)], pa.bool_()))

    at = [c.lower() for c in docs.columns].index(text.lower())  # as Spark knows columns
    return docs.mapInArrow(keep, docs.schema)


RESULT_NAMES = [x.split()[0] for x in RESULT.split(", ")]
