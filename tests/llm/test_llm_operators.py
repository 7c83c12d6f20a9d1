"""Operators against brute force on small rows, with NULLs, ties, repeats, long texts and empty tables."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG
from tidemark.llm import (
    components,
    decontamination,
    fingerprints,
    jaccard,
    licenses,
    linededup,
    mixing,
    sharding,
    text,
    tokencounts,
    toxicity,
    urlfilters,
)
from tidemark.llm.frames import table

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingle_set(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(t)) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_word_hashes_follow_words():
    column = pa.array(["Ab ab  ÄB äb", None, "", "ab", LONG])
    data, offsets = text.utf8(column)
    starts, ends, first = text.words(data, offsets, text.NON_SPACE)
    hashes = text.word_hashes(data, starts, ends, text.NON_SPACE)
    assert first.tolist()[:5] == [0, 4, 4, 4, 5]
    assert hashes[0] == hashes[1] == hashes[4] and hashes[2] != hashes[3]
    assert len(set(hashes[5:].tolist())) == len(set(LONG.split()))
    prefix = text.word_hashes(data, starts[:2], starts[:2] + 1, text.NON_SPACE)
    assert prefix[0] == prefix[1] == text.word_hashes(np.frombuffer(b"a", np.uint8), np.array([0]), np.array([1]), text.NON_SPACE)[0]


def test_sharding_is_a_permutation(spark, awkward):
    found = sharding.shuffled(awkward, 3).collect()
    assert sorted(r.position for r in found) == list(range(9))
    assert all(r.shard == r.position % 3 and r.slot == r.position // 3 for r in found)
    again = sharding.shuffled(awkward.repartition(5), 3).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert sharding.shuffled(awkward.limit(0), 3).count() == 0
    many = sharding.shuffled(spark.range(1).select(F.lit(5).alias("__first"), F.explode(F.sequence(F.lit(1), F.lit(10_000))).alias("x")).drop("x"), 3).collect()
    assert sorted(r.position for r in many) == list(range(10_000)) and {r["__first"] for r in many} == {5}
    for n in (1, 2, 3, 100, 1000):
        places = spark.range(n).select(sharding.permuted(F.col("id"), n, 5).alias("p")).collect()
        assert sorted(r.p for r in places) == list(range(n))


def test_mixing_meets_targets(awkward, documents):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(60)), rng.choice(["a", "b", "c", None])) for i in range(300)]
    found = mixing.mixed(documents(rows)).collect()
    taken, target = collections.Counter(), {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in found))
    assert mixing.mixed(awkward).count() == 9 and mixing.mixed(awkward.limit(0)).count() == 0


def mixture_by_hand(rows, sizes, keys, targets):
    """How often each distinct row stands in the mix: whole epochs, then rows by key until the words are used."""
    out = collections.Counter()
    for source, target in targets.items():
        own = sorted((keys[r], r) for r in rows if r[2] == source)
        total = sum(sizes[r] for _, r in own)
        epochs = int(target // total) if total else 0
        left = round(target - epochs * total)
        for _, r in own:
            out[r] += epochs
            if sizes[r] and 2 * min(sizes[r], left) >= sizes[r]:
                out[r] += 1
            left = max(0, left - sizes[r])
    return +out


@pytest.mark.parametrize("copies", [1, 5])
def test_mixture_by_brute_force(spark, copies):
    """Rows repeated often stand on the border of their source, some of them taken and some not."""
    rng = random.Random(19)
    rows = [(i, prose(rng, rng.randrange(40)), rng.choice(["a", "b", "c", None])) for i in range(120)] + [(None, None, "a"), (7, "", "b")]
    rows += [(1000, prose(rng, 30), s) for s in ("a", "b", None) for _ in range(60 * copies)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, size string")
    rates = {i: rng.choice([0.5, 2.0]) for i in range(0, 120, 3)}
    ratings = spark.createDataFrame(list(rates.items()), "rated_id long, weight double")
    ties = frame.select("doc_id", "text", "source", F.xxhash64("doc_id", "text", "source", "size").alias("tie"))
    drawn = ties.select("*", F.shiftrightunsigned(F.xxhash64("tie", F.lit(11)), 11).alias("bits")).distinct().collect()
    keys = {(r.doc_id, r.text, r.source): (-np.log((r.bits + 0.5) / (1 << 53)) / rates.get(r.doc_id, 1.0), r.tie) for r in drawn}
    sizes = {r: len((r[1] or "").split()) for r in rows}
    totals = collections.Counter()
    for r in rows:
        totals[r[2]] += sizes[r]
    per_source = spark.createDataFrame(list(totals.items()), "source string, source_size long")
    targets = {r.source: r.target for r in mixing.targets(per_source).collect()}
    got = collections.Counter((r.doc_id, r.text, r.source) for r in mixing.mixture(frame.repartition(4), ratings).collect())
    assert got == mixture_by_hand(rows, sizes, keys, targets)
    assert mixing.mixture(frame.limit(0), ratings).count() == 0 and mixing.mixture(frame).columns == frame.columns


@pytest.mark.parametrize("seed", range(6))
def test_targets_by_refilling(spark, seed):
    """Targets against the rule itself: share by weight, and share again what is above a source's cap."""
    rng = random.Random(seed)
    names = sorted(rng.sample("abcdefgh", rng.randrange(1, 8))) + [None] * rng.randrange(2)
    sizes = {s: rng.choice([0, 1, 10, 1000, rng.randrange(5000)]) for s in names}
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    target, spare, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while open_ and spare > 1e-9:
        total = sum(weight[s] for s in open_)
        wanted = {s: target[s] + spare * weight[s] / total for s in open_}
        spare = 0.0
        for s, w in wanted.items():
            target[s] = min(w, 2.0 * sizes[s])
            spare += w - target[s]
            if w >= 2.0 * sizes[s]:
                open_.discard(s)
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    assert {r.source: r.target for r in mixing.targets(frame).collect()} == pytest.approx(target)


def test_decontamination_by_brute_force(spark, documents, awkward):
    rng = random.Random(2)
    items = [("b", prose(rng, 14)), ("a", "Short one"), (None, prose(rng, 10)), ("c", None), ("a", prose(rng, 12))]
    rows = [(i, prose(rng, 30), "s") for i in range(20)]
    rows += [(20, f"x {items[0][1].upper()} y Short. ONE", "s"), (21, items[2][1], "s"), (22, items[4][1][3:], "s"), (23, None, "s")]
    windows = collections.defaultdict(set)
    for name, t in items:
        w = WORDS.findall(lower(t))
        k = min(10, len(w))
        for a in range(len(w) - k + 1) if w else ():
            windows[tuple(w[a : a + k])].add(name or "")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r for r in decontamination.contamination(documents(rows), benchmark, matches=True).collect()}
    for i, t, _ in rows:
        w, hit, names = WORDS.findall(lower(t)), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    names |= windows[tuple(w[a : a + k])]
                    hit |= set(range(a, a + k))
        assert (got[i].n_words, got[i].n_hit, got[i].items) == (len(w), len(hit), sorted(names))
        assert got[i].items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    assert (got[20].matches[0].first_word, got[20].matches[0].words) in ((1, 14), (16, 2))
    assert decontamination.contamination(awkward, benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontamination.contamination(awkward.limit(0), benchmark).count() == 0


def test_frequent_passages_are_written_out_once(spark, documents, monkeypatch):
    """Equal windows of many items at many places: each place once, and the same matches in small pieces."""
    rng = random.Random(17)
    opening = prose(rng, 10)
    items = pa.array([f"{opening} end{i}" for i in range(50)])
    strings, first = decontamination._column_words(pa.array([f"{opening} " * 40, "none", f"x {opening} end7 y"]))
    found = decontamination._search(strings, first, decontamination._items(items), False)
    assert len(found[0]) == 40 + 1 + 1
    benchmark = spark.createDataFrame([(str(i), t) for i, t in enumerate(items.to_pylist())], "item_id string, text string")
    rows = documents([(1, f"{opening} " * 40, "s"), (2, "none", "s"), (3, f"x {opening} end7 y", "s")])
    monkeypatch.setattr(decontamination, "PAIRS", 64)
    got = {r.doc_id: r for r in decontamination.contamination(rows, benchmark, matches="longest").collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].longest_match) for i in (1, 2, 3)] == [(400, 50, 10), (0, 0, 0), (11, 50, 11)]
    assert [(got[i].longest_item, got[i].longest_first_word) for i in (1, 2, 3)] == [("0", 0), (None, None), ("7", 1)]
    whole = decontamination.contamination(rows, benchmark, matches=True).collect()
    for r in whole:
        best = min(((-m.words, m.first_word, m.item_id) for m in r.matches), default=(0, None, None))
        assert (-got[r.doc_id].longest_match, got[r.doc_id].longest_first_word, got[r.doc_id].longest_item) == best
    assert len(whole[0].matches) == 50 * 40


def test_line_dedup_by_brute_force(documents, awkward):
    rng = random.Random(3)
    lines = [f"line number {i} of a common text" for i in range(12)] + ["short", ""]
    rows = [(i, "\n".join(" " * rng.randrange(2) + rng.choice(lines) for _ in range(rng.randrange(1, 9))), "s") for i in range(60)]
    rows += [(60, None, "s"), (61, "", "s"), (None, lines[0].upper(), "s")]
    holders = collections.defaultdict(set)

    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    order = {None: -1}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(order.get(i, i))
    got = {r.doc_id: r for r in linededup.line_dedup(documents(rows).repartition(5)).collect()}
    for i, t, _ in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == order.get(i, i)]
        assert (got[i].n_lines, got[i].n_dropped) == (len(own), len(own) - len(kept))
        assert got[i].kept_sha256 == hashlib.sha256("\n".join(kept).encode()).hexdigest()
        assert linededup.kept_lines(got[i].keep, got[i].n_lines).sum() == len(kept)
    assert linededup.line_dedup(awkward).count() == 9 and linededup.line_dedup(awkward.limit(0)).count() == 0


def test_segments_are_maximal():
    rng = random.Random(4)
    for _ in range(200):
        score = np.array([rng.choice([-3.0, -1.0, -0.5, 1.0, 2.0]) for _ in range(rng.randrange(25))])
        found = toxicity.segments(score)
        best = max((score[i:j].sum() for i in range(len(score)) for j in range(i + 1, len(score) + 1)), default=0.0)
        assert max((s for _, _, s in found), default=0.0) == pytest.approx(max(0.0, best))
        assert all(s == pytest.approx(score[a:b].sum()) and s > 0 for a, b, s in found)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))
        covered = {k for a, b, _ in found for k in range(a, b)}
        assert {k for k in range(len(score)) if score[k] > 0} <= covered


def test_toxicity_learns_held_out_labels(spark, documents, awkward):
    rng = random.Random(5)
    bad = [f"insult{i}" for i in range(6)]
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(rng, rng.randrange(5, 80), 900).split(), int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, toxic))
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    model = toxicity.fit(docs, known)
    truth = dict((i, t) for i, _, t in labels)
    scored = toxicity.scored(docs, model).withColumn("held", toxicity.held_out("doc_id")).filter("held").collect()
    assert sum(r.predicted == truth[r.doc_id] for r in scored) > 0.95 * len(scored)
    assert all(0 <= r.score <= 1 for r in scored)
    assert toxicity.scored(awkward, model).count() == 9
    empty = toxicity.fit(docs, known.limit(0))
    assert toxicity.scored(awkward, empty).filter("predicted = 1").count() == 0


def test_statistic_by_brute_force():
    """The tail of a negative binomial law, summed term by term, for every number of segments."""
    rng, shape = random.Random(20), toxicity.SHAPE
    for _ in range(60):
        tokens, rate, decay = rng.randrange(1, 5000), 0.002, 0.8
        sums = sorted((rng.expovariate(0.4) for _ in range(rng.randrange(8))), reverse=True)
        counted = [s for s in sums if s >= toxicity.MINOR] or sums[:1]
        best = -np.log(2.0) if not counted else -np.inf
        for k, s in enumerate(counted, 1):
            mean = tokens * rate * np.exp(-decay * (s - toxicity.MINOR))
            share, term, tail = mean / (mean + shape), (1 + mean / shape) ** -shape, 0.0
            for n in range(4000):
                tail += term if n >= k else 0.0
                term *= (shape + n) / (n + 1) * share
            best = max(best, -np.log(min(1.0, tail)) - np.log(k * (k + 1)))
        found = toxicity.statistic(np.array(sums), tokens, rate, decay)
        # The tail is bounded from above by a geometric sum, so the statistic from below.
        assert best - 1.5 < found <= best + 1e-6


def test_few_labels_do_not_move_the_centre_far():
    edges = toxicity._LOW + np.arange(toxicity._STATISTIC_BINS + 1) * (toxicity._HIGH - toxicity._LOW) / toxicity._STATISTIC_BINS
    none = np.zeros(len(edges))
    assert abs(toxicity._centre(none) - toxicity.CENTRE) < 0.02
    few = 10.0 * (edges < 60) + 8.0  # all missed is two errors better than any other centre
    assert abs(toxicity._centre(few - 2.0 * (edges >= 60)) - toxicity.CENTRE) < 10.1
    many = 1000.0 * np.abs(edges - 7.0)
    assert abs(toxicity._centre(many) - 7.0) < 0.05


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no given tables")
def test_toxicity_does_not_grow_with_length(spark, documents):
    """Clean texts, each scored clean, joined to 300,000 words are clean; with toxic ones among them they are not."""
    given, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    known = given.join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id")
    model = toxicity.fit(given, labels)
    single = toxicity.scored(known.select("doc_id", "text", "text", "toxic").toDF("doc_id", "text", "own", "toxic"), model).collect()
    clean, toxic = ([r.own for r in single if r.own and r.toxic == k and r.predicted == k] for k in (0, 1))
    rng, joined, n = random.Random(15), [], 0
    for least in (20_000, 80_000, 160_000, 300_000):
        for _ in range(3):
            own, size = [], 0
            while size < least:
                own.append(rng.choice(clean))
                size += len(WORDS.findall(own[-1]))
            joined += [(n, " ".join(own), "s"), (n + 1, " ".join([*own, *rng.sample(toxic, 20)]), "s")]
            n += 2
    got = {r.doc_id: r.predicted for r in toxicity.scored(documents(joined), model, carry=["doc_id"]).collect()}
    assert got == {i: i % 2 for i in range(n)}


def test_licence_places(documents, awkward):
    rows = [
        (1, "Under the MIT License. under the mit license", "s"), (2, "Apache License, Version 2.0", "s"),
        (3, "cc by nc cc by-nc cc by", "s"), (4, "under the mit-x license the the of", "s"),
        (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of that software", "s"),
        (6, "under the mİt license cc by ncK", "s"),
    ]
    got = {r.doc_id: r for r in licenses.licence_scan(documents(rows)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 0, 4, "mit")
    assert (got[2].n_base, got[2].base_labels, got[2].n_words) == (1, "apache-2", 5)
    assert (got[3].n_base, got[3].first_word, got[3].last_word) == (2, 0, 3)
    assert got[4].n_base == got[6].n_base == 0 and got[4].labels == "" and got[4].first_word is None
    assert got[5].labels == "mit" and got[5].base_labels == "" and 0.6 < got[5].score < 1
    assert licenses.licence_scan(awkward).count() == 9 and licenses.licence_scan(awkward.limit(0)).count() == 0


def test_licence_covers_by_brute_force(documents):
    """A passage without the template's rarest word keeps its cover when that word stands elsewhere."""
    rng, rows = random.Random(16), []
    for i in range(40):
        own = prose(rng, 30).split()
        for _, template, key in rng.sample(licenses.TEMPLATES, 2):
            passage = [w if w in key.split() or rng.random() < 0.8 else "other" for w in template.split()]
            at = rng.randrange(len(own))
            own[at:at] = passage + rng.choices(template.split(), k=rng.randrange(12)) + key.split() * rng.randrange(2)
        rows.append((i, " ".join(own), "s"))
    mit = "permission is hereby granted free of charge to any person {} a copy of this software"
    rows += [(n, f"{mit.format('getting')} {'filler ' * 30}{w}", "s") for n, w in enumerate(("", *sorted(set(mit.split()) - {"{}"}), "obtaining"), 40)]
    frame = documents(rows)
    got = {r.doc_id: r for r in licenses.licence_scan(frame).collect()}
    idf = licenses.inverse_frequencies(licenses.indexed(frame, "doc_id", "text"))
    for i, t, _ in rows:
        w, names = t.split(), set()
        for n, (label, template, key) in enumerate(licenses.TEMPLATES):
            p, k = template.split(), key.split()
            shares = [sum(idf[x] for o, x in enumerate(p) if 0 <= a + o < len(w) and w[a + o] == x) for a in range(-len(p), len(w))]
            cover = max(shares) / sum(idf[x] for x in p) if set(k) <= set(w) else 0.0
            assert got[i].covers[n] == pytest.approx(cover), (i, label)
            if cover >= 0.6 and any(w[a : a + len(k)] == k for a in range(len(w))):
                names.add(label)
        assert set(filter(None, got[i].labels.split(","))) - set(got[i].base_labels.split(",")) <= names
        assert names <= set(got[i].labels.split(","))
    assert got[len(rows) - 1].labels == "mit"


def test_each_licence_is_found_in_its_own_text_alone(documents):
    """Every template gives its own label and no other's, with punctuation, capitals and prose around it."""
    rng, rows = random.Random(30), []
    for i, (_, template, _) in enumerate(licenses.TEMPLATES):
        rows.append((i, f"{prose(rng, 20)}\n * {template.upper().replace(' ', ', ')}.\n{prose(rng, 20)}", "s"))
    rows.append((len(rows), "// SPDX-License-Identifier: LGPL-2.1-or-later", "s"))
    rows.append((len(rows), "SPDX-License-Identifier: MITX, a licence of our own", "s"))
    got = {r.doc_id: r for r in licenses.licence_scan(documents(rows)).collect()}
    for i, (label, template, _) in enumerate(licenses.TEMPLATES):
        assert set(got[i].labels.split(",")) == {label}, template
        assert got[i].covers[i] == pytest.approx(1.0)
    assert len({label for label, _, _ in licenses.TEMPLATES}) > 30
    assert got[len(rows) - 2].labels == "lgpl" and got[len(rows) - 1].labels == ""


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(6)
    a, b = prose(rng, 3000, 5000), prose(rng, 3000, 5000)
    both = " ".join([a, b])
    x, y, z = fingerprints.sketches(pa.array([a, b, both]))
    assert abs(fingerprints.distinct(z) / len(shingle_set(both)) - 1) < 0.3
    assert abs(fingerprints.resemblance(x, z) - 0.5) < 0.15 and fingerprints.containment(x, z) > 0.7
    assert fingerprints.resemblance(x, x) == 1 and (fingerprints.decode(fingerprints.encode(x)) == x).all()
    parts = spark.createDataFrame([("k", fingerprints.encode(s)) for s in (x, y, x)] + [(None, None)], "k string, fingerprint string")
    merged = {r.k: r.fingerprint for r in fingerprints.merged(parts, "k").collect()}
    assert merged == {"k": fingerprints.encode(fingerprints.merge(x, y)), None: ""}


def test_next_documents(documents, awkward):
    rng = random.Random(7)
    rows = [(i * 3, prose(rng, rng.randrange(40)), "s") for i in range(80)] + [(9999, None, "s")]
    got = {r.doc_id: r for r in fingerprints.compared(documents(rows).repartition(7)).collect()}
    for n, (i, t, _) in enumerate(rows):
        t, following = t or "", rows[(n + 1) % len(rows)][1] or ""
        assert got[i].edited_sha256 == hashlib.sha256(fingerprints.edited(t, following).encode()).hexdigest()
    assert len(got) == len(rows)
    many = [(None, prose(rng, 6), "s") for _ in range(150)] + [(5, prose(rng, 6), "s") for _ in range(150)] + [(5, "same", "s")] * 3
    found = fingerprints.compared(documents(many).repartition(5)).collect()
    # Texts of one id come in the order of their hash, which the query itself tells.
    hashed = documents(many).select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    shas = [hashlib.sha256(fingerprints.edited(a.text, b.text).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1], strict=True)]
    assert collections.Counter(r.edited_sha256 for r in found) == collections.Counter(shas)
    assert fingerprints.compared(awkward).count() == 9 and fingerprints.compared(awkward.limit(0)).count() == 0


def test_jaccard_by_brute_force(documents, awkward, monkeypatch):
    rng = random.Random(8)
    base, rows = [prose(rng, 40).split() for _ in range(6)], []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(50)}"
        rows.append((i, " ".join(words[: rng.choice([40, 40, 38, 4, 0])]), "s"))
    rows += [(150, None, "s"), (151, LONG, "s"), (152, LONG + " end", "s"), (153, LONG[: len(LONG) // 2], "s")]
    sets = {i: shingle_set(t) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(documents(rows)).collect()}
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}
    found = jaccard.jaccard_join(awkward).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == sorted(
        [(1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (0, 1), (5, 5), (6, 6), (7, 7)]
    )
    assert jaccard.jaccard_join(awkward.limit(0)).count() == 0


def test_jaccard_counts_links(documents):
    rng = random.Random(18)
    base, rows = [prose(rng, 40).split() for _ in range(3)], []
    for i in range(40):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(50)}"
        rows.append((i, " ".join(words), "s"))
    rows += [(40, rows[0][1], "s"), (41, rows[0][1].upper(), "s"), (42, None, "s"), (None, rows[1][1], "s")]
    sets = {t: shingle_set(t) for _, t, _ in rows}

    def similar(x, y):
        shared = len(sets[x] & sets[y])
        return sets[x] and sets[y] and 100 * shared >= 75 * (len(sets[x]) + len(sets[y]) - shared)

    links = [(i or -1, sum(bool(x != t and similar(x, t)) for x in sets)) for i, t, _ in rows]
    found = jaccard.jaccard_join(documents(rows), links=True).collect()
    assert sorted((r.doc_id or -1, r.n_links) for r in found) == sorted(links)
    plain = jaccard.jaccard_join(documents(rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in plain) == sorted((r.doc_id or -1, r.component_id) for r in found)


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1, 1), (None, 4)]
    links += [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {i: i for i in range(1100)}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {i: root(i) for i in range(1100) if root(i) != i}


@pytest.fixture(scope="module")
def counter():
    return tokencounts.Counter(tokencounts.ranks(tokencounts.VOCABULARY))


def test_edits_equal_a_new_count(counter):
    rng = random.Random(10)
    letters = list("ab 's\n  1é!")
    for _ in range(300):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(400)))
        chars, tokens, _ = counter.runs(t)
        tree = tokencounts.Tree(chars, tokens)
        for _ in range(4):
            insert = "".join(rng.choice(letters) for _ in range(rng.randrange(12)))
            t, _ = tokencounts.edit(tree, counter, t, rng.randrange(420), rng.randrange(30), insert)
            if not tree.length:
                tree = tokencounts.Tree([], [])
            assert (tree.total, tree.length) == (len(counter.encoding.encode_ordinary(t)), len(t))


def test_runs_stay_short(counter):
    """Many edits at one place, and one with a long insert: what is encoded again stays small."""
    text = prose(random.Random(21), 3000)
    tree = tokencounts.Tree(*counter.runs(text)[:2])
    place, most = len(text) // 2, 0
    for _ in range(1000):
        text, work = tokencounts.edit(tree, counter, text, place, 0, "abcd ")
        most = max(most, work)
    assert most < 400 and tree.total == len(counter.encoding.encode_ordinary(text))
    text, work = tokencounts.edit(tree, counter, text, place, 0, "more words " * 20_000)
    assert work < 221_000
    for at in (place + 7, place + 100_000, place + 219_990):
        text, work = tokencounts.edit(tree, counter, text, at, 0, "x")
        assert work < 400
    text, work = tokencounts.edit(tree, counter, text, place, 219_000, "")
    assert work < 400
    tree = tokencounts.Tree.unpack(tree.pack())
    assert (tree.total, tree.length) == (len(counter.encoding.encode_ordinary(text)), len(text))
    # An edit list longer than the text, places beyond its end, and one word without any cut.
    text = "a" * 50_000
    tree = tokencounts.Tree(*counter.runs(text)[:2])
    for i in range(30):
        text, _ = tokencounts.edit(tree, counter, text, 60_000 - i, 5, "b")
    assert (tree.total, tree.length) == (len(counter.encoding.encode_ordinary(text)), len(text))


def test_token_counts_of_rows(awkward, counter):
    step = F.struct(F.lit(3).alias("start"), F.lit(2).alias("length"), F.lit(" new").alias("insert"))
    rows = tokencounts.counted(awkward.withColumn("edits", F.when(F.col("doc_id") != 7, F.array(step))))
    for r in tokencounts.recounted(rows).collect():
        assert r.edited_tokens == len(counter.encoding.encode_ordinary(r.text)) and r.edited_chars == len(r.text)
    assert tokencounts.counted(awkward.limit(0)).count() == 0


def test_url_validity(spark):
    entries = spark.createDataFrame(
        [("l", "host:a.b.com", 5, True), ("l", "host:a.b.com", 9, False), ("l", "host:a.b.com", 5, False),
         ("m", "domain:b.com", 7, True), ("m", "url:a.b.com/x", 1, True), (None, "host:a.b.com", 1, True)],
        "list string, pattern string, day int, active boolean",
    )
    rows = [(1, "http://u@A.b.com:80/x/y?q", 5), (2, "http://a.b.com", 9), (3, "https://c.b.com/x", 6), (4, None, 5)]
    rows += [(5, "nothing", 5), (6, "http://a.b.com/", None), (1, "http://u@A.b.com:80/x/y?q", 5), (None, "http://b.com", 8)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched int")
    got = urlfilters.filtered(captures, entries).collect()
    reasons = {r.page_id: r.reasons for r in got}
    assert len(got) == 8 and reasons[1] == ["l host:a.b.com", "m url:a.b.com/x"]
    assert reasons[2] == ["m domain:b.com"] and reasons[None] == ["m domain:b.com"]
    assert not any(reasons[i] for i in (3, 4, 5, 6))
    assert urlfilters.filtered(captures.limit(0), entries).count() == 0
    assert urlfilters.filtered(captures, entries.limit(0)).filter("blocked").count() == 0
