"""Product codes against a full search in plain numpy."""

import hashlib

import numpy as np
import pytest

from tripstrata.llm import ballcodes

SCHEMA = "vec_id long, embedding array<float>, label int"


def searched(rows, entries, parts=4, rounds=4):
    """Codes and errors by row place, and the codebooks' digest."""
    whole = np.array([np.floor(np.array(v, np.float64) * 1024).astype(np.int64) for _, v, _ in rows])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, whole[i].tolist()))
    book, w = whole[order[:entries]].copy(), whole.shape[1] // parts
    spans = [slice(p * w, (p + 1) * w) for p in range(parts)]
    for step in range(rounds + 1):
        codes, errors, moved = [], 0, book.copy()
        for span in spans:
            far = ((whole[:, None, span] - book[None, :, span]) ** 2).sum(2)
            near = far.argmin(1)
            codes.append(near)
            errors = errors + far.min(1)
            for e in set(near):
                mine = whole[near == e][:, span]
                moved[e, span] = mine.sum(0) // len(mine)
        if step < rounds:
            book = moved
    numbers = ",".join(str(n) for span in spans for e in book[:, span].tolist() for n in e)
    return np.array(codes).T.tolist(), errors.tolist(), hashlib.sha256(numbers.encode()).hexdigest()


def check(spark, rows, entries, parts=3):
    codes, errors, digest = searched(rows, entries)
    coded, books = ballcodes.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(parts), entries)
    coded = ballcodes.with_label_errors(coded)
    got = sorted((str(r.id), r.label or -1, list(r.codes), r.error, r.label_error) for r in coded.collect())
    sums = {}
    for (_, _, label), error in zip(rows, errors):
        sums[label] = sums.get(label, 0) + error
    assert got == sorted(
        (str(i), label or -1, c, e, sums[label]) for (i, _, label), c, e in zip(rows, codes, errors)
    )
    assert ballcodes.books_digest(books) == digest


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_clusters(spark, monkeypatch, spread):
    monkeypatch.setattr(ballcodes, "CHUNK", 100)
    pick = np.random.default_rng(int(spread * 100))
    at = pick.normal(size=(9, 16)).astype(np.float32)
    rows = [
        (int(i), (at[i % 9] + pick.normal(size=16) * spread).astype(np.float32).tolist(), int(i % 4) or None)
        for i in pick.permutation(700)
    ]
    check(spark, rows, 32)


def test_ties_repeated_rows_and_few_rows(spark):
    grid = [(i // 2, [float(i % 3), 0.0, -1.0, i % 2 / 1024] * 2, 7) for i in range(60)]
    check(spark, grid + grid + [(None, [0.5] * 8, None)], 16)
    check(spark, grid[:5], 16)


def test_hot_vector_over_a_tree_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(ballcodes, "FAN_IN", 2)
    rows = [(i, [0.25] * 8 if i % 3 else [i / 100] * 8, i % 2) for i in range(200)]
    check(spark, rows, 16, parts=7)


def test_ball_search_equals_full_search():
    pick = np.random.default_rng(5)
    for size, spread in ((3, 2), (40, 6), (256, 30)):
        entries = pick.integers(-spread, spread, (size, 4)).astype(np.float64)
        x = pick.integers(-spread, spread, (3000, 4)).astype(np.float64)
        codes, far = ballcodes.nearest(x, entries)
        moved = entries + pick.integers(-1, 2, entries.shape)
        for before in (codes, pick.integers(0, size, len(x))):
            for have, want in zip(ballcodes.nearest_from(x, moved, before), ballcodes.nearest(x, moved)):
                assert (have == want).all()


def test_unusable_uneven_and_huge_vectors(spark):
    rows = [
        (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
        (5, [3e38, -3e38, 1.0, 0.0, 2.0], 1), (6, [], 1), (7, [1.0], None), (8, [1.0, 0.0, 0.0], None),
    ]
    coded, books = ballcodes.vector_codes(spark.createDataFrame(rows, SCHEMA), 2)
    got = {r.id: r for r in ballcodes.with_label_errors(coded).collect()}
    assert sorted(got) == [5, 6, 7, 8] and got[7].codes == got[8].codes
    assert all(r.error >= 0 for r in got.values()) and books[0].shape == (2, 2)


def test_no_rows_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], 3, "x", 4)], SCHEMA + ", n string, codes int")
    coded, _ = ballcodes.vector_codes(rows)
    assert [tuple(r) for r in ballcodes.with_label_errors(coded).select("id", "error", "label_error").collect()] == [(1, 0, 0)]
    coded, books = ballcodes.vector_codes(rows.limit(0))
    assert ballcodes.with_label_errors(coded).count() == 0
    assert ballcodes.books_digest(books) == hashlib.sha256(b"").hexdigest()
