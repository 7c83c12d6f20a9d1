"""Benchmark decontamination with suffix arrays over the training documents.

Training documents are cut into shards of a bounded number of bytes (a longer document is a shard alone).
Each shard gets a suffix array over its words, sorted by the first ``window`` words of each suffix by prefix
doubling. Every suffix of every benchmark item is looked up in every shard's array by binary search, one word
at a time and for all test suffixes at once; the range left after ``window`` words holds all occurrences of
that window. Occurrences are then followed to the left and right ends of the test suffix's match, which gives
the longest verbatim matches and their places.

The benchmark is the stated query set: it is sent to the executors in blocks of a bounded number of bytes and
each shard is searched for one block after the other. Documents never leave their row, so no text is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import plus, unused
from tidemark.llm.text import LETTERS, pieces, utf8, word_strings, words

WINDOW = 10
#: Columns that judging adds.
MADE = ("n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "matches", "longest_match", "longest_item", "longest_first_word")
#: Bytes of document text per suffix array, and of benchmark text per block of queries.
SHARD_BYTES = 3 << 20
BLOCK_BYTES = 4 << 20
#: Pairs of test suffix and occurrence that are followed at a time.
PAIRS = 1 << 20


def _column_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    data, offsets = utf8(column)
    starts, ends, first = words(data, offsets, LETTERS)
    return word_strings(data, starts, ends, LETTERS), first


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions in the order of their first ``depth`` values or more, by prefix doubling."""
    n, rank, done = len(ids), ids.astype(np.int64), 1
    order = np.argsort(rank)
    while done < depth:
        later = np.zeros(n, np.int64)
        later[: max(0, n - done)] = rank[done:] + 1
        key = rank * np.int64(n + 2) + later if done > 1 else rank * np.int64(int(ids.max(initial=0)) + 3) + later
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if n else []
        done *= 2
    return order


def _narrowed(ids, order, low, high, depth, wanted):
    """The part of each range [low, high) of the array whose suffixes have ``wanted`` at ``depth``."""
    n = len(ids)

    def at(place):
        where = order[np.minimum(place, n - 1)] + depth
        return np.where(where < n, ids[np.minimum(where, n - 1)], -1)

    def first(at_least):
        a, b = low.copy(), high.copy()
        while np.any(a < b):
            open_ = a < b
            middle = (a + b) >> 1
            less = open_ & (at(middle) < at_least)
            a = np.where(less, middle + 1, a)
            b = np.where(open_ & ~less, middle, b)
        return a

    return first(wanted), first(wanted + 1)


def window_ranges(ids: np.ndarray, order: np.ndarray, query: np.ndarray, lengths: np.ndarray, starts: np.ndarray):
    """Per test suffix (``starts`` in ``query``, ``lengths`` words): its range of the array, empty if none."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(ids), np.int64)
    live = np.arange(len(starts))
    for depth in range(int(lengths.max(initial=0))):
        live = live[(lengths[live] > depth)]
        if len(live) == 0:
            break
        wanted = query[starts[live] + depth]
        a, b = _narrowed(ids, order, low[live], high[live], depth, wanted)
        gone = (a >= b) | (wanted < 0)
        low[live], high[live] = np.where(gone, 0, a), np.where(gone, 0, b)
        live = live[~gone]
        # Those that stay on the list but have fewer words than depth are complete.
    return low, high


def _items(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]:
    """Words of a block of items, of each window its start, length and item, and the number of items."""
    strings, first = _column_words(column)
    counts = np.diff(first)
    windows = np.where(counts >= WINDOW, counts - WINDOW + 1, np.minimum(counts, 1))
    item = np.repeat(np.arange(len(counts)), windows)
    within = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    return strings, first[item] + within, np.minimum(counts[item], WINDOW), item, len(counts)


def _search(strings, first, block, want_matches):
    """Hits of one block in one shard: place and length of each window's occurrences, and items by document."""
    query_words, q_start, q_length, q_item, n_items = block
    vocabulary = strings.dictionary_encode()
    codes = np.asarray(vocabulary.indices, dtype=np.int64) + 1
    # A value that no query has stands between documents, so no match crosses them.
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ids = np.zeros(len(codes) + len(first) - 1, np.int64)
    place = np.arange(len(codes)) + row
    ids[place] = codes
    order = suffix_array(ids, WINDOW)
    found = pc.index_in(query_words, value_set=vocabulary.dictionary)
    query = np.asarray(pc.fill_null(found, -2), dtype=np.int64) + 1
    low, high = window_ranges(ids, order, query, q_length, q_start)
    hits = np.flatnonzero(high > low)
    # Equal windows have one range and one length, others have neither in common: each is written out once.
    ranges, window = np.unique(np.stack([low[hits], high[hits], q_length[hits]], axis=1), axis=0, return_inverse=True)
    window = window.reshape(-1)
    at, which = _written_out(order, ranges[:, 0], ranges[:, 1])
    separators = np.flatnonzero(ids == 0)
    doc = np.searchsorted(separators, at)
    # The items of each window in a row, and the distinct windows of each document.
    pairs = np.unique(np.stack([window, q_item[hits]], axis=1), axis=0)
    begins = np.searchsorted(pairs[:, 0], np.arange(len(ranges) + 1))
    held = np.unique(doc * np.int64(max(1, len(ranges))) + which)
    of_doc = held // max(1, len(ranges))
    found = {}
    for d in np.unique(of_doc).tolist():
        present = np.zeros(n_items, dtype=bool)
        for w in (held[of_doc == d] % len(ranges)).tolist():
            present[pairs[begins[w] : begins[w + 1], 1]] = True
        found[d] = np.flatnonzero(present)
    matches = _matches(first, block, query, ids, order, separators, hits, low, high, want_matches) if want_matches else None
    return at, ranges[which, 2], found, ids, matches


def _written_out(order, low, high):
    """The places in all ranges, and the range of each."""
    size = high - low
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return order[np.repeat(low, size) + within], np.repeat(np.arange(len(size)), size)


def _matches(first, block, query, ids, order, separators, hits, low, high, wanted):
    """Occurrences followed to both ends of what document and item share, as (document, item, first word, words).

    Pairs of test suffix and occurrence are taken ``PAIRS`` at a time; of each piece, distinct matches stay, or
    with ``longest`` the longest of each document: of equally long ones that of the first word, then of the
    first item.
    """
    _, q_start, q_length, q_item, n_items = block
    item_first = np.full(n_items, len(query))
    item_last = np.zeros(n_items, np.int64)
    np.minimum.at(item_first, q_item, q_start)
    np.maximum.at(item_last, q_item, q_start + q_length)
    # Of each document: words, first word and item of its longest match.
    longest = np.zeros((len(separators), 3), np.int64)
    kept = [np.empty((0, 4), np.int64)]
    ends = np.concatenate([[0], np.cumsum((high - low)[hits])])
    for begin in range(0, int(ends[-1]), PAIRS):
        pair = np.arange(begin, min(begin + PAIRS, int(ends[-1])))
        nth = np.searchsorted(ends, pair, side="right") - 1
        which, at = hits[nth], order[low[hits[nth]] + pair - ends[nth]]
        doc = np.searchsorted(separators, at)
        left, right = np.zeros(len(at), np.int64), q_length[which].copy()
        # The longest match is found whole from its first window.
        for side in (1,) if wanted == "longest" else (-1, 1):
            live = np.arange(len(at))
            while len(live):
                if side < 0:
                    q, t = q_start[which[live]] - left[live] - 1, at[live] - left[live] - 1
                    ok = q >= item_first[q_item[which[live]]]
                else:
                    q, t = q_start[which[live]] + right[live], at[live] + right[live]
                    ok = q < item_last[q_item[which[live]]]
                ok &= (t >= 0) & (t < len(ids))
                same = ok & (query[np.clip(q, 0, len(query) - 1)] == ids[np.clip(t, 0, len(ids) - 1)])
                live = live[same]
                (left if side < 0 else right)[live] += 1
        start = at - left - doc - first[doc]
        if wanted == "longest":
            by_rank = np.lexsort((q_item[which], start, -right, doc))
            best = by_rank[np.concatenate([[True], np.diff(doc[by_rank]) != 0])]
            found = np.stack([right[best], start[best], q_item[which[best]]], axis=1)
            better = _longer(found, longest[doc[best]])
            longest[doc[best][better]] = found[better]
        else:
            kept.append(np.unique(np.stack([doc, q_item[which], start, left + right], axis=1), axis=0))
    return longest if wanted == "longest" else np.unique(np.concatenate(kept), axis=0)


def _longer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows (words, first word, item) of ``a`` come before those of ``b``."""
    later = (a[:, 1] < b[:, 1]) | ((a[:, 1] == b[:, 1]) & (a[:, 2] < b[:, 2]))
    return (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & later)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    carry: list[str] | None = None,
    matches: bool | str = False,
) -> DataFrame:
    """Each document row with the benchmark windows it holds; ``carry`` names the columns that stay (all).

    Adds ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``n_items``, ``items`` (sorted
    ids of items with occurring windows, as strings), ``items_sha256``, ``contaminated`` and, with
    ``matches``, ``matches``: the longest verbatim matches as (item, first word, words); with
    ``matches="longest"`` only the longest one: ``longest_match`` (its words, or 0), ``longest_item`` and
    ``longest_first_word``; of equally long ones that with the smallest first word, then item.

    * A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window, an item
      without words none. NULL text has no words; a NULL item id is the empty string.
    * Items with one id are one item; equal windows of several items count for all of them.
    * Repeated rows are judged row by row. An empty benchmark leaves every document clean.
    * Columns of the result's names are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() not in MADE]
    text_alias = unused(docs, "benchmark_text_of_row")
    rows = docs.select(*kept, F.col(text_col).alias(text_alias))
    blocks = _blocks(spark, benchmark, item_col, item_text)
    added = "n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean"
    if matches == "longest":
        added += ", longest_match long, longest_item string, longest_first_word long"
    elif matches:
        added += ", matches array<struct<item_id:string,first_word:long,words:long>>"
    schema = plus(rows.schema, text_alias, added)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(text_alias), SHARD_BYTES):
                yield _judged(batch.slice(a, b - a), text_alias, blocks, matches)

    return rows.mapInArrow(judge, schema)


def _blocks(spark, benchmark, item_col, item_text):
    """Broadcast blocks of items, each of about ``BLOCK_BYTES``; only one passes the driver at a time."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text), F.lit("")).alias("words"),
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("words") + 16), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // BLOCK_BYTES))
    blocks = []
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k)
        rows = part.toArrow().sort_by([("item", "ascending"), ("words", "ascending")]).combine_chunks()
        words_of = pa.array(rows.column("words").to_pylist(), pa.string())
        blocks.append(spark.sparkContext.broadcast((rows.column("item").to_pylist(), _items(words_of))))
    return blocks


def _judged(batch, text_alias, blocks, want_matches):
    column = batch.column(text_alias)
    strings, first = _column_words(column)
    n = batch.num_rows
    marks, total = None, len(strings)
    items: list[set[str]] = [set() for _ in range(n)]
    longest: list[list] = [[] for _ in range(n)]
    most: list[tuple[int, int | None, str | None]] = [(0, None, None)] * n
    for block in blocks if total else ():
        names, asked = block.value
        if len(asked[1]) == 0:
            continue
        at, size, held, ids, matches = _search(strings, first, asked, want_matches)
        if marks is None:
            marks = np.zeros(len(ids) + 1, np.int64)  # +1 where a hit begins, -1 behind its end
            separators = np.flatnonzero(ids == 0)
        marks += np.bincount(at, minlength=len(marks)) - np.bincount(at + size, minlength=len(marks))
        for d, own in held.items():
            items[d].update(names[i] for i in own.tolist())
        if want_matches == "longest":
            for d in np.flatnonzero(matches[:, 0]).tolist():
                size, start, item = matches[d].tolist()
                if (-size, start, names[item]) < (-most[d][0], most[d][1] or 0, most[d][2] or ""):
                    most[d] = (size, start, names[item])
        elif want_matches:
            for d, i, start, count in matches.tolist():
                longest[d].append({"item_id": names[i], "first_word": start, "words": count})
    if marks is None:
        hit = np.zeros(n, np.int64)
    else:
        inside = np.concatenate([[0], np.cumsum(np.cumsum(marks) > 0)])
        begins = np.concatenate([[0], separators[:-1] + 1])
        hit = inside[separators] - inside[begins]
    found = [sorted(s) for s in items]
    arrays = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != text_alias]
    names = [c for c in batch.schema.names if c != text_alias]
    arrays += [
        pa.array(np.diff(first)),
        pa.array(hit),
        pa.array([len(s) for s in found], pa.int64()),
        pa.array(found, pa.list_(pa.string())),
        pa.array([hashlib.sha256(",".join(s).encode()).hexdigest() for s in found]),
        pa.array(hit > 0),
    ]
    names += ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"]
    if want_matches == "longest":
        size, start, item = zip(*most, strict=True) if most else ((), (), ())
        arrays += [pa.array(size, pa.int64()), pa.array(item, pa.string()), pa.array(start, pa.int64())]
        names += ["longest_match", "longest_item", "longest_first_word"]
    elif want_matches:
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))
        arrays.append(pa.array(longest, kind))
        names.append("matches")
    return pa.RecordBatch.from_arrays(arrays, names=names)
