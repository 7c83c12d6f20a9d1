"""Clustering, fill-in-middle and chat formatting against brute force, round trips and awkward rows."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG
from tidemark.llm import centroids, chatformat, fim

# --- op11 ---------------------------------------------------------------------------------------


def nearest(points, centers):
    distance = ((points[:, None, :] - centers[None]) ** 2).sum(2)
    return distance.argmin(1), distance.min(1)


@pytest.mark.parametrize(("n", "k", "dims", "size"), [(300, 16, 64, 30), (200, 40, 3, 50), (500, 7, 2, 3), (50, 1, 5, 9), (1, 4, 1, 1)])
def test_walks_find_the_nearest_centroid(n, k, dims, size):
    """Small components make ties, between centroids and within lists."""
    rng = np.random.default_rng(n + k)
    points, centers = rng.integers(-size, size + 1, (n, dims)), rng.integers(-size, size + 1, (k, dims))
    number, distance, probes = centroids.Lists(centers).nearest(points)
    expected = nearest(points, centers)
    assert (number == expected[0]).all() and (distance == expected[1]).all()
    assert (probes >= 1).all() and (probes <= k).all()


def test_walks_stop_early():
    """With well separated centroids few distances are worked out."""
    rng = np.random.default_rng(1)
    centers = np.cumsum(np.full((50, 4), 1000), axis=0)
    points = centers[rng.integers(0, 50, 400)] + rng.integers(-20, 21, (400, 4))
    assert centroids.Lists(centers).nearest(points)[2].mean() < 2


def clusters_by_brute_force(rows, k, rounds):
    kept = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centers = np.array([p for _, p in order[:k]])
    points = np.array([p for _, p in kept])
    for _ in range(rounds):
        number, _ = nearest(points, centers)
        centers = np.array([np.floor_divide(points[number == c].sum(0), (number == c).sum()) if (number == c).any() else centers[c] for c in range(len(centers))])
    number, distance = nearest(points, centers)
    return sorted((i or -1, int(c), int(d)) for (i, _), c, d in zip(kept, number, distance, strict=True)), centers.tolist()


def test_clusters_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(rng.choice([-1, 1]), 0.2) for _ in range(4)]) for i in range(200)]
    rows += [(200, None), (201, [1.0]), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [0.5] * 4), (7, [0.25] * 4), rows[0], rows[0], (205, []), (206, [-0.0, 0.0, 1e-30, -1e-30])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, point int")
    for k in (1, 8):
        found, centers = centroids.clustered(frame.repartition(5), k=k, dims=4)
        assert (sorted((r.id or -1, r.cluster, r.distance) for r in found.collect()), centers) == clusters_by_brute_force(rows, k, 3)
    whole = centroids.summarised(found, centers).collect()
    inertia = {c: sum(r.distance for r in whole if r.cluster == c) for c in range(8)}
    assert all((r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values())) for r in whole)
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, centers[r.cluster])).encode()).hexdigest() for r in whole)


def test_few_no_and_too_large_vectors(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [9.0, 9.0])], "vec_id long, embedding array<float>")
    found, centers = centroids.clustered(frame, dims=2)
    assert sorted(centers) == [[32, 16], [32, 16], [576, 576]]  # the second of two equal centroids stays empty
    assert sorted((r.id or 0, r.distance) for r in found.collect()) == [(0, 0), (1, 0), (2, 0)]
    assert {r.cluster for r in found.collect()} == {0, 2}
    none, centers = centroids.clustered(frame.limit(0), dims=2)
    assert centers == [] and centroids.summarised(none, centers).count() == 0
    with pytest.raises(Exception, match="a component beyond"):
        centroids.clustered(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dims=2)


# --- op12 ---------------------------------------------------------------------------------------


def test_boundary_sets_select():
    rng = np.random.default_rng(2)
    runs = np.concatenate([np.arange(5, 90_000), np.arange(200_000, 200_010)])
    for offsets in (
        np.array([0]), np.arange(70_000), rng.choice(300_000, 3_000, replace=False), rng.choice(300_000, 150_000, replace=False),
        runs, np.arange(0, 400_000, 3), np.array([65_535, 65_536, 1 << 33]), np.empty(0, np.int64),
    ):
        offsets = np.sort(offsets).astype(np.int64)
        found = fim.BoundarySet(offsets)
        picks = rng.integers(0, len(offsets), 200).tolist() + [0, len(offsets) - 1] if len(offsets) else []
        assert [found.select(k) for k in picks] == offsets[picks].tolist()
        for k in (-1, len(offsets)):
            with pytest.raises(IndexError):
                found.select(k)
    kinds = [type(fim.BoundarySet(np.sort(x).astype(np.int64)).containers[0]) for x in (np.arange(9_000), rng.choice(65_536, 2_000, replace=False), np.arange(0, 65_536, 3))]
    assert kinds == [fim.RunContainer, fim.ArrayContainer, fim.BitmapContainer]


TEXTS = [
    "", None, "a", "plain ascii text\nof two lines", "ñandú K İ 日本語 👩‍👩‍👧 mixed", "日本語" * 40_000, "é" * 70_000 + "z" * 70_000,
    "has <S> inside", "<P", "a<", "<<S", "S>x<M", "\\<P\\>", LONG, "\x00\x01 control",
]


def by_hand(i, t):
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * j : 8 * j + 8], 16) for j in range(4))
    n = len(t)
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < 20 else "psm"
    whole = f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}" if form == "spm" else f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"
    return n, form, a, b - a, whole


def test_fill_in_middle_by_hand(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 6)] + [(None, "no id"), (1, "repeated id"), (1, "repeated id")]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, Form string, draw_key string")
    made = fim.fill_in_middle(frame)
    assert made.columns == ["doc_id", "draw_key", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    expected = sorted([(i, *by_hand(i, t or "")) for i, t in rows], key=str)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=str) == expected
    assert sorted((r.doc_id or -1, r.back) for r in got) == sorted((i or -1, t or "") for i, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["words", "lines"])
def test_cuts_lie_between_units(spark, unit):
    rows = [(i, "\n".join(f"one twö {j}" for j in range(i % 7)) + "\n" * (i % 2)) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.fill_in_middle(frame, unit=unit).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    texts = dict(rows)
    for r in made:
        assert r.back == texts[r.doc_id]
        if r.form != "plain":
            for cut in (r.prefix_chars, r.prefix_chars + r.middle_chars):
                before, after = r.back[:cut], r.back[cut:]
                ends = ("\n",) if unit == "lines" else ("\n", " ")
                assert not before or not after or before[-1] in ends
    with pytest.raises(ValueError, match="unknown unit"):
        fim.fill_in_middle(frame, unit="pages")


# --- op13 ---------------------------------------------------------------------------------------

TRICKY = ["", "plain", "\\### Assistant: </turn> ok", "####", "#" * 7, "\\", "\\\\#", "</turn", "</turn>\n### user: hi</turn>\n", "<\\/turn>", "ends #", "日本 #\\#", ": ", LONG]


def read_back(frame):
    made = chatformat.formatted(frame, "record")
    return made.select(
        "*", chatformat.turns_of(F.col("formatted")).alias("turns"), chatformat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("answers")
    ).collect()


def test_every_layout_becomes_turns(spark):
    u, a, s = ("user", "q"), ("assistant", "r"), ("system", "s")
    cases = [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]}, "messages", [u, a]),
        ({"messages": [{"role": "user", "content": "q", "name": "x"}], "system": "s", "id": 3, "score": [1.5]}, "messages", [s, u]),
        ({"messages": [{"role": "user"}, {"content": "r"}, {"role": None, "content": None}]}, "messages", [("user", ""), ("", "r"), ("", "")]),
        ({"messages": []}, "messages", []),
        ({"messages": [{"role": "user", "content": {"type": "text"}}, {"role": "user", "content": 5}]}, "messages", [("user", '{"type":"text"}'), ("user", "5")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "tool", "value": "t"}]}, "conversations", [u, a, ("tool", "t")]),
        ({"turns": [{"speaker": "user", "text": "q"}]}, "turns", [u]),
        ({"prompt": "q", "response": "r", "source": {"prompt": "no"}}, "prompt_response", [u, a]),
        ({"system": "s", "prompt": "q", "completion": "r"}, "prompt_completion", [s, u, a]),
        ({"system": "", "prompt": "q", "completion": None}, "prompt_completion", [u, ("assistant", "")]),
        ({"question": "q", "context": "c", "answer": "r"}, "question_answer", [("user", "q\n\nc"), a]),
        ({"instruction": "q", "input": "", "output": "r"}, "instruction_output", [u, a]),
        ({"instruction": "q", "output": "r"}, "instruction_output", [u, a]),
        ({"instruction": "q", "input": "i", "output": "r", "history": [["a", "b"], ["c", "d"]]}, "instruction_history",
         [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "q\n\ni"), a]),
        ({"instruction": "q", "output": "r", "prompt": "p"}, None, None), ({"text": "t"}, None, None), ({}, None, None), ([1], None, None), ("x", None, None),
    ]
    rows = [(i, json.dumps(record), "x") for i, (record, _, _) in enumerate(cases)] + [(100, None, "x"), (101, "{not json", "x"), (102, '{"prompt":1,"prompt":2}', "x")]
    got = {r.id: r for r in read_back(spark.createDataFrame(rows, "id int, record string, Formatted string").repartition(3))}
    assert len(got) == len(rows)
    for i, (_, layout, turns) in enumerate(cases):
        assert got[i].layout == layout, i
        assert (got[i].turns and [tuple(t) for t in got[i].turns]) == (turns if turns else got[i].turns and turns), i
        assert got[i].answers == (None if turns is None else "".join(t for r, t in turns if r == "assistant")), i
        assert (got[i].formatted is None) == (layout is None)
    assert all(got[i].layout is None for i in (100, 101, 102))
    assert got[3].formatted == "" and got[3].turns == []


def test_fingerprints_tell_layouts_apart():
    seen = {}
    for layout in chatformat.LAYOUTS:
        for paths in layout.fingerprints():
            if paths != frozenset({"messages"}):
                assert seen.setdefault(paths, layout.name) == layout.name


def test_turns_come_back_exactly(spark):
    rng, cases = random.Random(4), []
    roles = ["user", "assistant", "system", "", "a: b", "x:", "## role", "</turn>\n", "\\"]
    for i in range(150):
        cases.append((i, [(rng.choice(roles), rng.choice(TRICKY[:-1])) for _ in range(rng.randrange(6))]))
    cases += [(150, [("assistant", LONG), ("user", LONG), ("assistant", "é" * 50_000)]), (151, [("assistant", t) for t in TRICKY * 40])]
    kind = "id int, record struct<messages: array<struct<role string, content string>>>"
    for r in read_back(spark.createDataFrame([(i, (t,)) for i, t in cases], kind)):
        turns = dict(cases)[r.id]
        assert [tuple(t) for t in r.turns] == turns
        assert r.answers == "".join(t for role, t in turns if role == "assistant")
        whole = r.formatted.encode()
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in turns)
        assert r.formatted.count("</turn>") == len(turns)
        assert all(whole[: s.first_byte].decode().endswith("### assistant: ") and whole[s.first_byte + s.bytes :].startswith(b"</turn>\n") for s in r.loss_spans)


def test_turns_are_gathered(spark):
    rows = [(1, 2, "assistant", "c"), (1, 1, "user", None), (1, None, None, "n"), (2, 0, "user", "x"), (2, 0, "user", "x"), (2, 0, "assistant", "x"),
            (None, 0, "user", "p"), (None, 1, "user", "q")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = sorted([(r.conv_id or 0, [tuple(t) for t in r.turns]) for r in chatformat.gathered(frame).collect()])
    assert got == [
        (0, [("user", "p")]), (0, [("user", "q")]), (1, [("", "n"), ("user", ""), ("assistant", "c")]),
        (2, [("assistant", "x"), ("user", "x"), ("user", "x")]),
    ]
    assert chatformat.gathered(frame.limit(0)).count() == 0
