"""Toxic passages: maximum-scoring segments over token log-odds.

Model. A token's score is the log of how much likelier it is in toxic than in clean text, less a fixed
drift; a positive log is first lowered by ``CAUTION`` standard errors, so that rare tokens weigh little. Rates have Dirichlet priors that are informed from coarse to fine: a word's first four letters, its
first five, the word itself; each level's posterior is the next level's prior. Levels are counted by hash in
a table of ``1 << BITS`` bins, so the model has a fixed size whatever the vocabulary. Counts are documents
that hold the token.

Scoring. One linear scan per document finds every maximal scoring segment (a run of tokens whose sum cannot
be raised by making it longer or shorter). Clean text has chance segments too: of a sum s or more so many a
token as the law ``rate * exp(-decay * (s - MINOR))`` says, which is fitted to clean training text (the decay
from the median, which mislabelled rows hardly move). For each k, the k-th largest sum has a tail probability:
that of k or more such segments in a text of this length, by a negative binomial law of shape ``SHAPE``, for
texts differ in what they speak of. A document's statistic is the largest -log of tail times k (k + 1); as
the sum of 1 / (k (k + 1)) is 1, a clean text of any length exceeds x with a probability of at most exp(-x).
Segments that alone have a tail below ``SIGNIFICANT`` are reported. The score is a logistic curve of the
statistic. Its centre is where training rows, judged by a model that has not seen them (two halves, swapped),
are told apart with the fewest errors, each unit of distance from ``CENTRE`` counting as one error more: a
clean text passes ``CENTRE`` with a probability of at most exp(-CENTRE), whatever the labels, so a few labels
cannot move the centre far and many are not held back.

Learning uses at most about ``max_labelled`` labelled rows (a documented bound: they are sent to every task),
chosen by a hash of the id over the whole table. Counts cross the cluster as sums per bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import plus, unused, written
from tidemark.llm.text import LETTERS, mix, pieces, utf8, word_hashes, words

BITS = 20
PREFIXES = (4, 5)
PRIOR = 1.0
DRIFT = 0.3
CAUTION = 2.0
MINOR = 2.0
SHAPE = 4.0
SIGNIFICANT = 0.01
CENTRE = 5.0
MAX_LABELLED = 100_000
#: Columns that scoring adds.
MADE = ("score", "predicted", "passages")
_STATISTIC_BINS = 4096
_LOW, _HIGH = -16.0, 112.0
#: Excesses over ``MINOR`` are counted in steps of one over this.
_STEPS = 256


@dataclass(frozen=True)
class Model:
    """Toxic and clean counts by bin at each level, the law of chance segments, and the statistic that scores 0.5."""

    tables: list[tuple[np.ndarray, np.ndarray]]
    ratio: float
    rate: float
    decay: float
    centre: float


def _lengths(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: int) -> np.ndarray:
    """End bytes of each word's first ``letters`` code points."""
    begins = ((data & 0xC0) != 0x80).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(begins)])
    where = np.flatnonzero(begins)
    nth = before[starts] + letters
    reached = nth < before[ends]
    out = ends.copy()
    out[reached] = where[nth[reached]]
    return out


def token_bins(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Of every token its bin at each level, coarse to fine, and each row's first token."""
    data, offsets = utf8(column)
    starts, ends, first = words(data, offsets, LETTERS)
    levels = []
    for level, letters in enumerate((*PREFIXES, None)):
        stops = ends if letters is None else _lengths(data, starts, ends, letters)
        hashes = word_hashes(data, starts, stops, LETTERS) + np.uint64(level)
        levels.append((mix(hashes) >> np.uint64(64 - BITS)).astype(np.int64))
    return levels, first


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last + 1, sum), left to right, in linear time.

    Only positive tokens enter the scan; what lies between them is one step down.
    """
    at = np.flatnonzero(score > 0)
    if len(at) == 0:
        return []
    total = np.concatenate([[0.0], np.cumsum(score)])
    # Each candidate: first, end, sum before it, sum through it, and the nearest earlier one with a smaller start sum.
    stack: list[list] = []
    for begin, left, right in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist(), strict=True):
        item = [begin, begin + 1, left, right, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= item[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= item[3]:
                item[4] = j
                stack.append(item)
                break
            item = [stack[j][0], item[1], stack[j][2], item[3], -1]
            del stack[j:]
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def _scores(tables: list[tuple[np.ndarray, np.ndarray]], ratio: float, levels: list[np.ndarray]) -> np.ndarray:
    """Score of every token; ``ratio`` is the number of clean documents per toxic one."""
    odds, seen = 1.0, None
    for (toxic, clean), bins in zip(tables, levels, strict=True):
        t = toxic[bins]
        seen = t if seen is None else seen
        odds = (t * ratio + PRIOR * odds) / (clean[bins] + PRIOR)
    log = np.log(odds)
    return np.where(log > 0, np.maximum(0.0, log - CAUTION / np.sqrt(seen + 0.5)), log) - DRIFT


def expected(sums: np.ndarray, tokens: int, rate: float, decay: float) -> np.ndarray:
    """How many chance segments of each sum or more a clean text of so many tokens has."""
    return tokens * rate * np.exp(np.clip(-decay * (sums - MINOR), -500.0, 500.0))


def statistic(sums: np.ndarray, tokens: int, rate: float, decay: float) -> float:
    """What a document's segments amount to, by their sums; only the largest may be below ``MINOR``."""
    sums = np.sort(sums)[::-1]
    sums = sums[: max(1, int((sums >= MINOR).sum()))]
    if len(sums) == 0:
        return -math.log(2.0)
    k = np.arange(1.0, len(sums) + 1)
    mean = expected(sums, tokens, rate, decay)
    share = mean / (mean + SHAPE)
    # The tail is at most its first term over one less the ratio of the second to it, as ratios fall.
    first = np.cumsum(np.log((SHAPE + k - 1) / k)) + k * np.log(share) - SHAPE * np.log1p(mean / SHAPE)
    ratio = (k + SHAPE) / (k + 1) * share
    log_tail = np.where(ratio < 1, np.minimum(0.0, first - np.log(np.maximum(1e-12, 1 - ratio))), 0.0)
    return float((-log_tail - np.log(k * (k + 1))).max())


def labelled(labels: DataFrame, label_col: str = "toxic", most: int = MAX_LABELLED) -> DataFrame:
    """At most about ``most`` labelled ids with label and fold: fold -1 is held out, 0 and 1 train.

    An id labelled more than once has its greatest label; rows without id or label are left out.
    """
    remainder = F.crc32(F.col("doc_id").cast("string"))
    one = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label_col).cast("int").alias("label"))
        .filter(remainder % 5 != 0)
    )
    n = one.count()
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(min(1 << 30, (most << 30) // max(1, n)))
    fold = F.pmod(F.floor(remainder / 5), F.lit(2)).cast("int")
    return one.filter(picked).select(F.col("doc_id").alias("labelled_id"), "label", fold.alias("fold"))


def _training_text(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("labelled_id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(known), "labelled_id").select("text", "label", "fold")


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bin, split by fold and label, as sparse rows."""
    size = len(PREFIXES) + 1 << BITS
    counts, documents = None, np.zeros(4, np.int64)
    for batch in batches:
        if counts is None:
            counts = np.zeros((4, size), np.int32)
        label = np.asarray(batch.column("label"))
        fold = np.asarray(batch.column("fold"))
        kind = fold * 2 + (label > 0)
        documents += np.bincount(kind, minlength=4)
        for a, b in pieces(batch.column("text")):
            levels, first = token_bins(batch.column("text").slice(a, b - a))
            for row in range(b - a):
                for level, bins in enumerate(levels):
                    held = np.unique(bins[first[row] : first[row + 1]])
                    counts[kind[a + row], (level << BITS) + held] += 1
    if counts is None:
        return
    any_ = np.flatnonzero(counts.any(axis=0))
    for begin in range(0, len(any_), 50_000):
        bins = any_[begin : begin + 50_000]
        yield _count_batch(bins, counts[:, bins])
    yield _count_batch(np.array([-1]), documents[:, None])


def _count_batch(bins: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(bins.astype(np.int32)), *[pa.array(c.astype(np.int64)) for c in counts]]
    return pa.RecordBatch.from_arrays(arrays, names=["bin", "c0", "t0", "c1", "t1"])


def _tables(
    counts: np.ndarray, documents: np.ndarray, folds: tuple[int, ...]
) -> tuple[list[tuple[np.ndarray, np.ndarray]], float]:
    """Toxic and clean counts per level of the given folds, and clean documents per toxic one."""
    clean_docs, toxic_docs = (sum(int(documents[2 * f + k]) for f in folds) for k in (0, 1))
    ratio = clean_docs / toxic_docs if toxic_docs and clean_docs else 1.0
    levels = [slice(level << BITS, (level + 1) << BITS) for level in range(len(PREFIXES) + 1)]
    tables = [
        tuple(sum(counts[2 * f + k, part].astype(np.float32) for f in folds) for k in (1, 0)) for part in levels
    ]
    return tables, ratio


def _sums(model: tuple, levels: list[np.ndarray], first: np.ndarray) -> list[np.ndarray]:
    """Each row's segment sums, without those that the statistic leaves out."""
    score = _scores(*model, levels)
    out = []
    for i in range(len(first) - 1):
        sums = np.sort([s for _, _, s in segments(score[first[i] : first[i + 1]])])[::-1]
        out.append(sums[: max(1, int((sums >= MINOR).sum()))])
    return out


def _law(clean: DataFrame) -> tuple[float, float]:
    """Rate and decay of chance segments, by clean rows of ``tokens`` and ``sums``.

    One segment of excess 1 is added, the mean that exact log-odds would have.
    """
    tokens = clean.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    excess = clean.select(F.explode("sums").alias("s")).filter(F.col("s") >= MINOR)
    step = F.least(F.floor((F.col("s") - MINOR) * _STEPS), F.lit(int(_HIGH) * _STEPS)).cast("int")
    found = sorted(excess.groupBy(step.alias("step")).agg(F.count(F.lit(1))).collect())  # a fixed number of steps
    n = sum(times for _, times in found)
    median, below = 0.0, 0
    for at, times in found:
        below += times
        if 2 * below >= n:
            median = (at + 0.5) / _STEPS
            break
    return (n + 1.0) / (tokens + 1.0), (n + 1.0) / (n * median / math.log(2.0) + 1.0)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", most: int = MAX_LABELLED,
) -> Model:
    """Learn from the labelled rows whose crc32 of the id, as text, is not divisible by 5.

    Without labels, or with one label only, every token is neutral and every document scores 0.
    """
    spark = docs.sparkSession
    train = _training_text(docs, labelled(labels, label_col, most), id_col, text_col)
    schema = "bin int, c0 long, t0 long, c1 long, t1 long"
    summed = train.mapInArrow(_counting, schema).groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c1", "t1")])
    # At most one row per bin: a fixed size.
    found = summed.toArrow()
    counts = np.zeros((4, len(PREFIXES) + 1 << BITS), np.int32)
    documents = np.zeros(4, np.int64)
    bins = np.asarray(found.column("bin"), dtype=np.int64)
    for k, name in enumerate(("c0", "t0", "c1", "t1")):
        values = np.asarray(found.column(name), dtype=np.int64)
        counts[k, bins[bins >= 0]] = values[bins >= 0]
        documents[k] = values[bins < 0].sum()
    final = _tables(counts, documents, (0, 1))
    if not (documents[0] + documents[2]) or not (documents[1] + documents[3]):
        return Model(*final, 1.0, 1.0, 1e6)
    halves = spark.sparkContext.broadcast([_tables(counts, documents, (1,)), _tables(counts, documents, (0,))])
    del counts

    def judging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column("label")) > 0
            fold = np.asarray(batch.column("fold"))
            for a, b in pieces(batch.column("text")):
                for half in (0, 1):
                    rows = np.flatnonzero(fold[a:b] == half) + a
                    levels, first = token_bins(batch.column("text").take(pa.array(rows)))
                    sums = _sums(halves.value[half], levels, first)
                    arrays = [
                        pa.array(label[rows].astype(np.int32)),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(sums, pa.list_(pa.float64())),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["label", "tokens", "sums"])

    judged = written(train.mapInArrow(judging, "label int, tokens long, sums array<double>"), "toxicity")
    halves.unpersist()
    rate, decay = _law(judged.filter("label = 0"))

    def calibrating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, _STATISTIC_BINS), np.int64)
        for batch in batches:
            rows = zip(batch.column("sums").to_pylist(), batch.column("tokens").to_pylist(), strict=True)
            x = np.array([statistic(np.array(sums), tokens, rate, decay) for sums, tokens in rows])
            at = np.clip((x - _LOW) / (_HIGH - _LOW) * _STATISTIC_BINS, 0, _STATISTIC_BINS - 1).astype(int)
            np.add.at(seen, (np.asarray(batch.column("label")), at), 1)
        kind, at = np.nonzero(seen)
        arrays = [pa.array(kind.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(seen[kind, at])]
        yield pa.RecordBatch.from_arrays(arrays, names=["label", "at", "n"])

    histogram = judged.mapInArrow(calibrating, "label int, at int, n long").groupBy("label", "at").agg(F.sum("n").alias("n"))
    seen = np.zeros((2, _STATISTIC_BINS))
    for label, at, n in histogram.collect():  # a fixed number of bins
        seen[label, at] = n
    errors = np.concatenate([[0], np.cumsum(seen[1])]) + seen[0].sum() - np.concatenate([[0], np.cumsum(seen[0])])
    return Model(*final, rate, decay, _centre(errors))


def _centre(errors: np.ndarray) -> float:
    """The statistic that scores one half, by the errors that each edge of a bin makes as a centre."""
    edges = _LOW + np.arange(len(errors)) * (_HIGH - _LOW) / _STATISTIC_BINS
    return float(edges[(errors + np.abs(edges - CENTRE)).argmin()])


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """All rows with ``score``, ``predicted`` and ``passages``; ``carry`` names the columns that stay (all).

    ``passages`` are the significant segments as (first token, tokens, sum, tail probability). NULL and
    empty texts have no tokens and the lowest statistic. Repeated rows get equal results.
    Columns of the result's names are replaced.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() not in MADE]
    alias = unused(docs, "text_to_score")
    rows = docs.select(*kept, F.col(text_col).alias(alias))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passages = "array<struct<first:long,tokens:long,sum:double,tail:double>>"
    schema = plus(rows.schema, alias, f"score double, predicted int, passages {passages}")
    passage = pa.list_(
        pa.struct([("first", pa.int64()), ("tokens", pa.int64()), ("sum", pa.float64()), ("tail", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            column = batch.column(alias)
            for a, b in pieces(column):
                levels, first = token_bins(column.slice(a, b - a))
                score = _scores(m.tables, m.ratio, levels)
                found, x = [], np.empty(b - a)
                for row in range(b - a):
                    own = score[first[row] : first[row + 1]]
                    parts = segments(own)
                    sums = np.array([s for _, _, s in parts])
                    x[row] = statistic(sums, len(own), m.rate, m.decay)
                    mean = expected(sums, len(own), m.rate, m.decay)
                    tails = (-np.expm1(-SHAPE * np.log1p(mean / SHAPE))).tolist()
                    found.append(
                        [
                            {"first": i, "tokens": j - i, "sum": s, "tail": t}
                            for (i, j, s), t in zip(parts, tails, strict=True)
                            if t < SIGNIFICANT
                        ]
                    )
                p = 1 / (1 + np.exp(-np.clip(x - m.centre, -700, 700)))
                part = batch.slice(a, b - a)
                names = [c for c in part.schema.names if c != alias]
                arrays = [part.column(c) for c in names]
                arrays += [pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(found, passage)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "score", "predicted", "passages"])

    return rows.mapInArrow(run, schema)
