"""Fill-in-middle transformation with a Roaring-style set of cut boundaries.

Where a text may be cut is a set of byte offsets: 0 and the end of each unit (a code point, word or line).
The set is split by the upper bits of its members into containers of 2**16 offsets, and each container is
kept in the smallest of three forms: a sorted array, a bitmap, or runs of consecutive offsets (an ASCII text
is one run a container). Cumulative cardinalities over the containers find the container of the k-th member
by binary search; a select inside it finds the member: by index in an array, by cumulative popcounts of words
in a bitmap, by cumulative run lengths in runs. Two selects give both offsets of a cut, and the text's bytes
are cut there.

Each row is transformed where it lies: nothing is shuffled, and one text at a time is held as bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import plus, unused
from tidemark.llm.text import NON_SPACE

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Of a hundred documents, those that stay plain and, of the others, those with the suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20

_BITS = 16
_SIZE = 1 << _BITS
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class ArrayContainer:
    """Sorted lower halves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per offset, in words of 64 bits with the number of members before each."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_SIZE, dtype=bool)
        bits[low] = True
        self.bytes = np.packbits(bits, bitorder="little")
        inside = _POPCOUNT[self.bytes].reshape(-1, 8).sum(1, dtype=np.int64)
        self.before = np.cumsum(inside) - inside

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.bytes[word * 8 : word * 8 + 8], bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[k - int(self.before[word])])


class RunContainer:
    """First offset of each run of consecutive offsets, with the number of members before it."""

    def __init__(self, first: np.ndarray, before: np.ndarray):
        self.first, self.before = first.astype(np.uint16), before

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted lower halves: 2 bytes a member, 8192 bytes, or 4 bytes a run."""
    starts = np.flatnonzero(np.concatenate([[True], np.diff(low) != 1]))
    sizes = {ArrayContainer: 2 * len(low), BitmapContainer: _SIZE // 8, RunContainer: 4 * len(starts)}
    kind = min(sizes, key=sizes.__getitem__)
    return RunContainer(low[starts], starts) if kind is RunContainer else kind(low)


class BoundarySet:
    """A set of offsets that answers which member is the k-th."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` are sorted and distinct."""
        upper = offsets >> _BITS
        begins = np.flatnonzero(np.concatenate([[True], np.diff(upper) != 0])) if len(offsets) else np.empty(0, np.int64)
        ends = [*begins[1:].tolist(), len(offsets)]
        self.upper = upper[begins]
        self.before = begins  # cumulative cardinalities: members before each container
        self.containers = [container(offsets[a:b] & (_SIZE - 1)) for a, b in zip(begins.tolist(), ends, strict=False)]
        self.cardinality = len(offsets)

    def select(self, k: int) -> int:
        """The member that has ``k`` smaller ones."""
        if not 0 <= k < self.cardinality:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.upper[at]) << _BITS) + self.containers[at].select(k - int(self.before[at]))


def _characters(data: np.ndarray) -> np.ndarray:
    return np.flatnonzero((data & 0xC0) != 0x80)[1:]


def _words(data: np.ndarray) -> np.ndarray:
    """Where a word begins, so that white space goes with the word before it."""
    keep = NON_SPACE[data]
    return np.flatnonzero(keep[1:] & ~keep[:-1]) + 1


def _lines(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data == 0x0A) + 1
    return ends[ends < len(data)]


UNITS = {"characters": _characters, "words": _words, "lines": _lines}


def boundaries(data: bytes, unit: str = "characters") -> BoundarySet:
    """The cut boundaries of UTF-8 text: 0, the begin of each later unit, and the end."""
    if not data:
        return BoundarySet(np.zeros(1, np.int64))
    inner = UNITS[unit](np.frombuffer(data, np.uint8))
    return BoundarySet(np.concatenate([[0], inner, [len(data)]]).astype(np.int64))


def draws(key: str) -> tuple[int, int, int, int]:
    """Four unsigned numbers of 32 bits out of the sha256 of a key."""
    digest = hashlib.sha256(key.encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transformed(data: bytes, key: str, unit: str = "characters") -> tuple[int, str, int | None, int | None, bytes]:
    """Number of units, form, characters of prefix and middle (None if plain), and the output."""
    found = boundaries(data, unit)
    n = found.cardinality - 1
    h1, h2, h3, h4 = draws(key)
    if not data or h3 % 100 >= PLAIN_FROM or any(s.encode() in data for s in SENTINELS):
        return n, "plain", None, None, data
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = found.select(first), found.select(last)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = (x.encode() for x in SENTINELS)
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    output = s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle
    if unit == "characters":
        return n, form, first, last - first, output
    return n, form, len(prefix.decode()), len(middle.decode()), output


_MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "characters", seed: int = 1
) -> DataFrame:
    """Every row without its text, with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Both cuts, whether a document stays plain and whether its suffix comes first are drawn from the sha256 of
    ``<seed>:<id>``. ``unit`` is ``"characters"`` (code points), ``"words"`` or ``"lines"``. Plain are also empty
    texts and those that hold a sentinel; their prefix and middle are NULL.

    * NULL text is empty. A NULL id draws like an empty one. Repeated ids draw alike, repeated rows give
      equal results. A long text is one row; a set holds at most 8 KiB and a count for each 64 KiB of it.
    * Columns of the result's names are replaced, all others stay. An empty frame gives an empty result.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit: {unit}")
    key, text = unused(docs, "draw_key"), unused(docs, "whole_text")
    kept = [c for c in docs.columns if c.lower() not in _MADE and c.lower() != text_col.lower()]
    rows = docs.select(
        *kept,
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias(key),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(text),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(key), batch.column(text)
            for begin, end in _pieces(texts):
                found = [transformed(texts[i].as_py(), keys[i].as_py(), unit) for i in range(begin, end)]
                n, form, prefix, middle, output = zip(*found, strict=True)
                made = [
                    pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string()),
                ]
                own = batch.select(kept).slice(begin, end - begin).columns if kept else []
                yield pa.RecordBatch.from_arrays([*own, *made], names=[*kept, *_MADE])

    schema = plus(rows.select(*kept).schema, None, "n long, form string, prefix_chars long, middle_chars long, output string")
    return rows.mapInArrow(run, schema)


def _pieces(texts: pa.Array, most_bytes: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many bytes each."""
    total, first = 0, 0
    for row in range(len(texts)):
        size = len(texts[row].as_buffer())
        if row > first and total + size > most_bytes:
            yield first, row
            total, first = 0, row
        total += size
    if first < len(texts):
        yield first, len(texts)


def restored(output: Column, form: Column) -> Column:
    """The text that a form was made of. No text that is cut holds a sentinel, so the first of each kind marks."""
    at = {s: F.locate(s, output) for s in SENTINELS}
    ends = F.length(output) + 1

    def part(sentinel: str, following: Column) -> Column:
        begin = at[sentinel] + len(sentinel)
        return F.substring(output, begin, F.greatest(following - begin, F.lit(0)))

    psm = F.concat(part(PREFIX, at[SUFFIX]), part(MIDDLE, ends), part(SUFFIX, at[MIDDLE]))
    spm = F.concat(part(PREFIX, at[MIDDLE]), part(MIDDLE, ends), part(SUFFIX, at[PREFIX]))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
