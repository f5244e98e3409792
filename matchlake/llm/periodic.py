"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a maximal stretch of consecutive words with smallest period q (words
q apart are equal) and a length of at least max(``MIN_LENGTH``, ``REPEATS`` * q).
Every word of a run therefore occurs at least ``REPEATS`` times in it:

1. *Splitting.* Words that occur fewer times than that within their segment
   can be in no run; they split the segment. The parts are counted anew, until
   no segment changes. Segments shorter than ``MIN_LENGTH`` go.
2. *Lag scan.* In a surviving segment, a run of period q holds at least
   ``REPEATS`` multiples of q, whose words are equal. So lag q compares only
   the words at multiples of q (n/q of them, n log n over all lags), and the
   few places with ``REPEATS`` equal ones in a row are compared word by word
   and extended both ways. Lags go up; a place inside a run that was found
   for a smaller period has that period, and is passed over.

Both steps are exact: nothing is capped or sampled. A text is one task's work,
whatever its length; rows are independent, so there is no shuffle. Null and
empty texts have no words and no runs, and collapse to an empty text. Repeated
rows each get their own result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.batches import text_slices

MIN_LENGTH, REPEATS = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def survivors(ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the segments that frequency splitting leaves, in order;
    ``doc`` numbers the text of each word, and no segment crosses texts."""
    done = []
    at, part = np.arange(len(ids)), doc.astype(np.int64)
    width = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        _, which, often = np.unique(part * width + ids[at], return_inverse=True, return_counts=True)
        rare = often[which] < REPEATS
        hit = np.zeros(int(part[-1]) + 1, bool)
        hit[part[rare]] = True
        again = hit[part]  # segments that lose words; the others are stable
        done.append(stretches(at[~again], part[~again]))
        left = again & ~rare
        at, part = at[left], part[left]
        begin, end = stretches(at, part)
        long = end - begin >= MIN_LENGTH
        sizes = (end - begin)[long]
        at = np.repeat(begin[long] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        part = np.repeat(np.arange(len(sizes)), sizes)
    found = [(b, e) for begin, end in done for b, e in zip(begin.tolist(), end.tolist()) if e - b >= MIN_LENGTH]
    return sorted(found)


def stretches(at: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the consecutive positions of equal part."""
    if not len(at):
        return at, at
    first = np.append(True, (np.diff(at) != 1) | (np.diff(part) != 0))
    return at[first], at[np.append(first[1:], True)] + 1


def agreement(x: np.ndarray, q: int, a: int) -> tuple[int, int]:
    """The widest [low, high) around ``a`` on which every word equals the word q behind it."""
    high, step = a, 64
    while high < len(x) - q:
        stop = min(len(x) - q, high + step)
        differs = x[high:stop] != x[high + q:stop + q]
        if differs.any():
            high += int(differs.argmax())
            break
        high, step = stop, step * 2
    low, step = a, 64
    while low > 0:
        stop = max(0, low - step)
        differs = (x[stop:low] != x[stop + q:low + q])[::-1]
        if differs.any():
            low -= int(differs.argmax())
            break
        low, step = stop, step * 2
    return low, high


def lag_scan(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a segment."""
    runs, reach = [], np.zeros(len(x), np.int64)  # reach: the furthest end of the runs found over a word
    for q in range(1, len(x) // REPEATS + 1):
        picked = x[::q]
        same = picked[1:] == picked[:-1]
        row = same[:len(same) - REPEATS + 2].copy()
        for k in range(1, REPEATS - 1):
            row &= same[k:len(same) - REPEATS + 2 + k]
        if not row.any():
            continue
        begin = np.flatnonzero(row) * q
        mid = begin + q // 2  # lies between the multiples: one more look before comparing all
        begin = begin[(x[mid] == x[mid + q]) & (x[mid] == x[mid + 2 * q])]
        for a in begin.tolist():
            if reach[a] > a + (REPEATS - 1) * q:
                continue
            low, high = agreement(x, q, a)
            length = high + q - low
            if high > a + (REPEATS - 2) * q and length >= max(MIN_LENGTH, REPEATS * q):
                runs.append((low, length, q))
                np.maximum(reach[low:low + length], low + length, out=reach[low:low + length])
    return runs


def word_runs(texts: list[bytes]) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words of each text, and its runs by start, then period."""
    words = [t.split() for t in texts]
    known: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter((known.setdefault(w, len(known)) for text in words for w in text), np.int64, int(sizes.sum()))
    first = np.append(0, np.cumsum(sizes))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    doc = np.repeat(np.arange(len(texts)), sizes)
    for begin, end in survivors(ids, doc):
        d = int(doc[begin])
        base = begin - int(first[d])
        runs[d] += [(base + s, n, q) for s, n, q in lag_scan(ids[begin:end])]
    return words, [sorted(r, key=lambda run: (run[0], run[2])) for r in runs]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds behind its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def found_runs(texts: pa.Array) -> pa.Array:
    runs, short = [], []
    for _, _, rows in text_slices(texts):
        words, found = word_runs(rows)
        runs += [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
        short += [collapsed(w, r).decode("utf-8", "replace") for w, r in zip(words, found, strict=True)]
    return pa.StructArray.from_arrays([pa.array(runs, pa.list_(RUN)), pa.array(short, pa.string())],
                                      names=["runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with two more columns: ``runs`` (start, length and period in
    words, by start, then period) and ``collapsed``, the text without the
    repeats of its runs, words parted by one space. Words are the stretches
    without ASCII white space. Columns of these two names are replaced."""
    kept = [c for c in docs.columns if c not in ("runs", "collapsed")]
    at = kept.index(text)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, short = found_runs(batch.column(at)).flatten()
            yield pa.RecordBatch.from_arrays([*batch.columns, runs, short], names=[*kept, "runs", "collapsed"])

    schema = T.StructType(docs.select(*kept).schema.fields).add("runs", RUNS).add("collapsed", "string")
    return docs.select(*kept).mapInArrow(found, schema)


def strongest(runs: Column | str) -> Column:
    """The run with the greatest length / period, compared exactly; of equal
    ones the first of the list. Null for an empty list."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
