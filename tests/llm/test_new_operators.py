"""Whitening, hard negatives and repeated passages, on corner cases and against brute force."""

from __future__ import annotations

import itertools
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from termweave.llm import angular_negatives, relative_lz, spectral_whitening
from termweave.llm.vectors import finite

VECTORS = "vec_id long, embedding array<float>, label int, rank int, n string"
NAN, INF = float("nan"), float("inf")


def _table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], VECTORS).repartition(3)


def _odd(dims):
    """Rows that take no part."""
    whole = [1.0] * dims
    return [
        (900, None, 1),
        (901, [], 1),
        (902, [None, *whole[1:]], 1),
        (903, [NAN, *whole[1:]], 1),
        (904, [INF, *whole[1:]], 1),
        (905, whole[1:], 1),
    ]


def _drawn(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    rows = (rng.standard_normal((n, dims)) * np.linspace(0.2, 1, dims)).astype(np.float32)
    return [(int(i), row.tolist(), int(i) % 4) for i, row in enumerate(rows)]


# Whitening


@pytest.mark.parametrize("n", [1, 2, 5, 33])
def test_spectral_divide_and_conquer(n):
    rng = np.random.default_rng(n)
    turn, _ = np.linalg.qr(rng.standard_normal((n, n)))
    for values in (np.linspace(1, 9, n), np.logspace(0, -12, n), np.ones(n), np.repeat([4.0, 1.0], [n // 2, n - n // 2])):
        a = (turn * values) @ turn.T
        a = (a + a.T) / 2
        found, vectors = spectral_whitening.eigen(a, 8)
        assert np.allclose(found, np.linalg.eigvalsh(a)[::-1][:8], rtol=0, atol=1e-14 * n)
        assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)
        assert np.linalg.norm(a @ vectors - vectors * found) < 1e-13 * n
    polar = spectral_whitening.polar(a - 2 * np.eye(n))
    assert np.allclose(polar @ polar, np.eye(n), atol=1e-12)


def test_exact_products():
    x = np.array([[3.0, -1.0], [2.0**40, 5.0], [2.0**51, -(2.0**51)]])
    whole = [[int(v) for v in row] for row in x]
    expected = [[sum(r[i] * r[j] for r in whole) for j in range(2)] for i in range(2)]
    assert [[int(v) for v in row] for row in spectral_whitening.exact_products(x)] == expected


def _whitened(rows, components):
    x = [[int(np.floor(1024.0 * float(np.float32(c)))) + 100_000 for c in v] for _, v, _ in rows]
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    apart = [[n * v - s for v, s in zip(row, sums, strict=True)] for row in x]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in apart), n**3)) for j in range(dims)] for i in range(dims)]
    values, vectors = np.linalg.eigh(np.array(cov))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = np.array(apart, dtype=float) / n @ vectors / np.sqrt(values)
    return [sum(v * v for v in row) for row in apart], white, values / np.trace(cov)


def test_whitening_equals_plain_python(spark):
    rows = _drawn(120, 12)
    rows += [rows[3], (None, [0.5] * 12, None)]
    table = _table(spark, rows + _odd(12))
    deviation, white, explained = _whitened(rows, 8)
    out = spectral_whitening.whiten(table).collect()
    assert len(out) == len(rows)
    sign = None
    by_deviation = {int(r.deviation): r for r in out}
    for (vec_id, _, _), d, w in zip(rows, deviation, white, strict=True):
        row = by_deviation[d]
        assert row.vec_id == vec_id and row.n == len(rows)
        got = np.array(row.whitened)
        sign = np.sign(got * w) if sign is None else sign
        assert np.allclose(got, sign * w, atol=1e-9)
        assert np.allclose(row.explained, explained, rtol=1e-12) and row.identity_error < 1e-10
    flat = spectral_whitening.per_component(spectral_whitening.whiten(table, components=3)).collect()
    assert sorted(r.component for r in flat) == sorted([1, 2, 3] * len(rows))


def test_whitening_of_little(spark):
    assert spectral_whitening.whiten(_table(spark, _odd(3)[:5])).count() == 0
    same = [(i, [0.25, -0.5], 0) for i in range(4)]
    assert spectral_whitening.whiten(_table(spark, same)).count() == 0
    # One direction only: the other components have no variance.
    line = [(i, [0.25 * i, 0.5 * i], 0) for i in range(4)]
    found = spectral_whitening.per_component(spectral_whitening.whiten(_table(spark, line))).collect()
    assert {r.component for r in found} == {1} and len(found) == 4


def test_whitening_of_large_entries(spark):
    rows = [(i, [float(v), float(-v)], 0) for i, v in enumerate((2**40, 2**41, 3, 0))]
    deviation, _, _ = _whitened(rows, 1)
    found = spectral_whitening.whiten(_table(spark, rows)).collect()
    assert sorted(int(r.deviation) for r in found) == sorted(deviation)
    # Such numbers do not fit the 64 bits of the flat form.
    flat = spectral_whitening.per_component(spectral_whitening.whiten(_table(spark, rows)))
    assert flat.where("deviation IS NULL").count() == sum(d >= 1 << 63 for d in deviation)


# Hard negatives


def _mined(rows, scale=16, every=5, positives=3, negatives=2):
    whole = [(i, [int(np.floor(scale * float(np.float32(c)))) for c in v], label) for i, v, label in rows]
    out = []
    for at, (anchor, a, label) in enumerate(whole):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, v, strict=True)), i, other == label)
            for place, (i, v, other) in enumerate(whole)
            if place != at
        ]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and -50 * score <= -100 * s[0] <= -95 * score]
            for rank, (low, negative, _) in enumerate(fit[:negatives], 1):
                out.append((anchor, positive, rank, negative, -score, -low))
    return sorted(out)


@pytest.mark.parametrize("slice_rows", [7, 2048])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, slice_rows):
    for name, value in (("BLOCK_ROWS", 40), ("TILE_ROWS", 4), ("SLICE", slice_rows), ("REFERENCES", 5)):
        monkeypatch.setattr(angular_negatives, name, value)
    rows = _drawn(150, 6)
    # Ties, repeated rows, repeated ids, zeros, opposite rows.
    rows += [(i, rows[10][1], label) for i, label in ((300, 2), (301, 1), (302, 1), (303, 3))]
    rows += [rows[10], rows[20], (40, rows[7][1], 0), (310, [0.0] * 6, 1), (315, [0.0] * 6, 2)]
    rows += [(i + 400, [-c for c in v], label) for i, v, label in rows[:10]]
    odd = [*_odd(6), (906, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    found = angular_negatives.mine(_table(spark, rows + odd), 16.0, 5, 3, 2)
    got = sorted(tuple(r) for r in found.collect())
    assert got == _mined(rows) and len(got) > 50


def test_one_hot_label(spark, monkeypatch):
    monkeypatch.setattr(angular_negatives, "BLOCK_ROWS", 30)
    monkeypatch.setattr(angular_negatives, "TILE_ROWS", 5)
    rows = [(i, v, 1 if i % 3 else 2) for i, v, _ in _drawn(160, 4, 3)]
    got = sorted(tuple(r) for r in angular_negatives.mine(_table(spark, rows), 16.0, 5, 3, 2).collect())
    assert got == _mined(rows)


def test_hard_negatives_of_little(spark):
    for rows in ([], _odd(3), [(1, [1.0, 2.0], 0)], [(0, [1.0, 2.0], 0), (50, [1.0, 2.0], 1)]):
        assert angular_negatives.mine(_table(spark, rows)).count() == 0


def test_score_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = np.floor(rng.standard_normal((2, 80, 5)) * 9)
    a[0], b[1], b[2] = 0, a[1], -a[1]
    references = angular_negatives.choose_references(a, 4)
    angles = [angular_negatives.angles_to(x, references) for x in (a, b)]
    norms = [np.sqrt((x**2).sum(axis=1)) for x in (a, b)]
    low, high = angular_negatives.score_bounds(angles[0], norms[0], angles[1], norms[1])
    assert (low <= a @ b.T).all() and (a @ b.T <= high).all()
    sets = [
        {"low": g.min(axis=0), "high": g.max(axis=0), "least": n.min(), "most": n.max()}
        for g, n in zip(angles, norms, strict=True)
    ]
    least, most = angular_negatives.range_bounds(*sets)
    assert least <= (a @ b.T).min() and (a @ b.T).max() <= most


def test_finite_vectors(spark):
    rows = _drawn(5, 3)
    kept = finite(_table(spark, rows + rows[:2] + _odd(3)), "label").collect()
    assert sorted(r.vec_id for r in kept) == [0, 0, 1, 1, 2, 3, 4]


# Repeated passages

DOCS = "doc_id long, text string, spans string, text_hash long, kept string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, text, "s", 1, "k") for i, text in rows], DOCS).repartition(3)


def _stripped(rows):
    first: dict[tuple, int] = {}
    words = [(i, re.findall("[^\x20\x09-\x0d]+", text or "")) for i, text in rows]
    for i, cut in words:
        for at in range(len(cut) - 12 if i is not None else 0):
            window = tuple(cut[at : at + 13])
            first[window] = min(i, first.get(window, i))
    out = []
    for i, cut in words:
        gone = set()
        for at in range(len(cut) - 12 if i is not None else 0):
            if first[tuple(cut[at : at + 13])] < i:
                gone.update(range(at, at + 13))
        out.append((i, len(cut), len(gone), " ".join(w for at, w in enumerate(cut) if at not in gone)))
    return out


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def _passages(seed):
    """Texts put together from a few passages and own words, with copies, near copies and loops."""
    pick = random.Random(seed)
    passages = [[f"p{p}_{at}" for at in range(pick.choice((5, 12, 13, 14, 40)))] for p in range(8)]
    few = [f"w{at}" for at in range(6)]
    texts = []
    for _ in range(60):
        words: list[str] = []
        while len(words) < pick.randint(0, 90):
            kind = pick.random()
            if kind < 0.5:
                words += pick.choice(passages)
            elif kind < 0.7:
                words += pick.choices(few, k=pick.randint(1, 30))
            else:
                words += [f"own{pick.randrange(10**9)}" for _ in range(pick.randint(1, 10))]
        texts.append(pick.choice((" ", "\n", " \t")).join(words))
    texts += texts[:10] + ["loop " * 200, "loop " * 90 + "end", "a b " * 40, "x\xa0y\x1cz " * 20, "Ünï côdé 語 " * 9]
    rows = list(enumerate(texts))
    pick.shuffle(rows)
    # Null and repeated ids, repeated rows, null and empty texts.
    rows += [(None, texts[0]), (None, texts[1]), rows[0], (5, texts[6]), (200, None), (201, ""), (202, " \n")]
    return rows


@pytest.mark.parametrize("crowded", [1 << 16, 3])
@pytest.mark.parametrize("batch", [60, 1 << 20])
def test_repeats_equal_brute_force(spark, monkeypatch, crowded, batch):
    monkeypatch.setattr(relative_lz, "BATCH_WORDS", batch)
    monkeypatch.setattr(relative_lz, "CROWDED", crowded)
    monkeypatch.setattr(relative_lz, "BLOCK_WINDOWS", 500)
    rows = _passages(batch + crowded)
    got = [tuple(r) for r in relative_lz.remove_repeats(_docs(spark, rows)).collect()]
    assert _order(got) == _order(_stripped(rows))
    assert sum(r[2] for r in got) > 100


def test_factors_are_followed_and_looked_up_anew():
    a, b = np.arange(10, 20, dtype=np.uint64), np.arange(30, 36, dtype=np.uint64)
    text = np.concatenate([a[2:6], b[:3], [99], a[:2]]).astype(np.uint64)
    windows = np.concatenate([text, b, a])
    covered = relative_lz.parse(windows, np.array([len(text), len(b), len(a)]), np.array([7, 5, 3]))
    assert covered[: len(text)].tolist() == [True] * 7 + [False] + [True] * 2
    assert not covered[len(text) :].any()
    # Neither is a stretch covered by itself nor by one of the same document.
    assert not relative_lz.parse(np.concatenate([a, a]), np.array([10, 10]), np.array([4, 4])).any()


def test_equal_windows_lie_in_equal_blocks():
    pick = random.Random(4)
    hashes = relative_lz.Hashes()
    anchors: dict[int, set] = {}
    for _ in range(20):
        words = [str(pick.randrange(3)) for _ in range(pick.randrange(60))]
        got = np.array([hashes[w] for w in words], dtype=np.uint64)
        found = relative_lz.Stretches(got, np.array([len(words)]))
        assert found.sizes.sum() == max(0, len(words) - 12)
        assert (found.sizes <= relative_lz.LONGEST).all()
        for anchor, at, n in zip(found.anchor, found.first, found.sizes, strict=True):
            for window in found.windows[at : at + n]:
                anchors.setdefault(int(window), set()).add(int(anchor))
    assert all(len(a) == 1 for a in anchors.values()) and len(anchors) > 50


def test_no_documents(spark):
    assert relative_lz.remove_repeats(_docs(spark, [])).count() == 0
    assert relative_lz.repeated_spans(_docs(spark, [(1, None), (2, "a b")])).count() == 0


def test_many_copies_over_partitions(spark):
    text = " ".join(f"t{at}" for at in range(30))
    rows = [(i, text) for i in range(300)] + [(1000 + i, f"{text} own{i}") for i in range(50)]
    got = {r.doc_id: r for r in relative_lz.remove_repeats(_docs(spark, rows).repartition(20)).collect()}
    assert got[0].n_removed == 0 and got[0].kept == text
    assert all(got[i].n_removed == 30 and got[i].kept == "" for i in range(1, 300))
    assert all(got[1000 + i].kept == f"own{i}" for i in range(50))


def test_slices_of_pairs():
    """Every way to lay three spans of a text comes out as their union."""
    for starts in itertools.product(range(0, 12, 3), repeat=3):
        a = np.array(starts)
        frame = relative_lz._by_document(np.full(3, 9), np.full(3, 1), a, a + 4)
        spans = np.frombuffer(frame["spans"][0], "<i4").reshape(-1, 2)
        covered = {at for x, y in spans for at in range(x, y)}
        assert covered == {at for x in starts for at in range(x, x + 4)}
