"""Vector codes, whitening and toxicity against brute force, and on NULLs, empty tables, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from fareway.llm import toxicity, walsh_codes, whitening

VECTORS = "vec_id long, embedding array<float>, label int, vector string, code int, error string, row int, p0 string, n int, c int, w int"
TEXTS = "doc_id long, text string, value int, held_out string, toxic string, score int"


def vectors(spark, rows):
    """Rows with columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, v, label, "v", 1, "e", 2, "p", 3, 4, 5) for i, v, label in rows], VECTORS)


def some_vectors(size=400, d=12, seed=3):
    rnd = random.Random(seed)
    rows = [(i, [float(np.float32(rnd.gauss(0.1 * k, 0.3 + k / 9))) for k in range(d)], rnd.choice((None, 1, 2))) for i in range(size)]
    bad = [(1000, None, 1), (1001, [None] + [0.5] * (d - 1), 1), (1002, [math.nan] * d, 2), (1003, [math.inf] + [0.0] * (d - 1), None), (1004, [-math.inf] * d, 1)]
    return [*rows, *bad, rows[5], (None, rows[7][1], 2)]


def kept(rows):
    return [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def brute_codes(rows, parts, entries, rounds):
    """Codebooks, codes and errors by comparing every part with every entry in Python integers."""
    good = sorted(kept(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v: [tuple(math.floor(1024 * x) for x in v[k : k + len(v) // parts]) for k in range(0, len(v), len(v) // parts)]
    whole = [cut(v) for _, v, _ in good]
    books = [[w[p] for w in whole[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min(range(len(book)), key=lambda k: (far(x, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for w in whole:
                mine.setdefault(nearest(w[p], books[p]), []).append(w[p])
            for k, got in mine.items():
                books[p][k] = tuple(sum(col) // len(got) for col in zip(*got, strict=True))
    codes = [[nearest(w[p], books[p]) for p in range(parts)] for w in whole]
    errors = [sum(far(w[p], books[p][c]) for p, c in enumerate(code)) for w, code in zip(whole, codes, strict=True)]
    return good, books, codes, errors


@pytest.mark.parametrize(("d", "entries"), [(12, 16), (4, 256), (20, 5)])
def test_codes_equal_brute_force(spark, d, entries):
    rows = some_vectors(150, d)
    good, books, codes, errors = brute_codes(rows, 4, entries, 3)
    got = walsh_codes.compress(vectors(spark, rows).repartition(5), entries=entries, rounds=3).collect()
    by_label = {}
    for (_, _, label), e in zip(good, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    want = [(i, "".join(f"{c:02x}" for c in code), e, by_label[label]) for (i, _, label), code, e in zip(good, codes, errors, strict=True)]
    assert sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error) for r in got) == sorted((i is None, i or 0, *rest) for i, *rest in want)
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(flat.encode()).hexdigest()}


def test_transform_keeps_distances():
    rng = np.random.default_rng(0)
    for width in (1, 3, 8, 17):
        matrix = walsh_codes.walsh(width)
        changes = (np.diff(matrix, axis=1) != 0).sum(1)
        assert (np.sort(changes) == changes).all() and (matrix @ matrix.T == len(matrix) * np.eye(len(matrix))).all()
        points, entries = rng.integers(-9, 9, (300, width)), rng.integers(-9, 9, (40, width))  # many ties
        apart = ((points[:, None] - entries[None]) ** 2).sum(2)
        index, least = walsh_codes.nearest(walsh_codes.transform(points, matrix), walsh_codes.transform(entries, matrix))
        assert (index == apart.argmin(1)).all() and (least == len(matrix) * apart.min(1)).all()


def test_codes_of_odd_tables(spark):
    assert walsh_codes.compress(vectors(spark, [])).collect() == []
    assert walsh_codes.compress(vectors(spark, [(1, None, 1), (2, [math.nan] * 4, 1)])).collect() == []
    one = walsh_codes.compress(vectors(spark, [(1, [0.5, -0.5, 1.0, 2.0], None)] * 3)).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00000000", 0, 0)] * 3
    with pytest.raises(Exception, match="length"):
        walsh_codes.compress(vectors(spark, [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)])).collect()
    with pytest.raises(Exception, match="overflow"):
        walsh_codes.compress(vectors(spark, [(1, [1e30] * 4, 1)])).collect()


def test_label_totals_do_not_depend_on_the_join(spark, monkeypatch):
    rows = vectors(spark, some_vectors(90))
    want = sorted(map(repr, walsh_codes.compress(rows, entries=8).collect()))
    monkeypatch.setattr(walsh_codes, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.fareway.hotRows", "5")
    try:
        assert sorted(map(repr, walsh_codes.compress(rows, entries=8).collect())) == want
    finally:
        spark.conf.unset("spark.fareway.hotRows")


def integers(rows):
    return np.array([[math.floor(1024 * x) + 100_000 for x in v] for _, v, _ in kept(rows)], object)


@pytest.mark.parametrize("d", [1, 2, 5, 12, 41])
def test_whitening_equals_brute_force(spark, d):
    rows, seen = some_vectors(120, d), []
    got = whitening.whiten(vectors(spark, rows).repartition(3), use=seen.append).collect()
    x = integers(rows)
    n, total = len(x), x.sum(0)
    exact = np.array([[sum((n * a - s) * (n * b - t) for a, b in zip(x[:, i], x[:, j], strict=True)) / n**3 for j, t in enumerate(total)] for i, s in enumerate(total)], float)
    assert np.array_equal(seen[0], exact)  # each entry is the exact value, rounded once
    assert len(got) == n * min(8, d) and {r.n for r in got} == {n}
    values, vecs = np.linalg.eigh(exact)
    values, vecs = values[::-1], vecs[:, ::-1]
    centre = (n * x - total).astype(float) / n
    deviation = sorted(int(sum(v * v for v in row)) for row in n * x - total)
    for k in range(min(8, d)):
        mine = [r for r in got if r.component == k + 1]
        want = np.sort(centre @ vecs[:, k] / np.sqrt(values[k]))
        found = np.sort([r.whitened for r in mine])
        assert min(np.abs(found - want).max(), np.abs(found + want[::-1]).max()) < 1e-8
        assert abs(mine[0].explained - values[k] / values.sum()) < 1e-9 and sorted(r.deviation for r in mine) == deviation
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    assert all(r.deviation == int(r.deviation_exact) for r in got)


def test_whitening_runs_no_python_and_survives_wide_sums(spark, monkeypatch):
    rows = some_vectors(60, 6)
    out = whitening.whiten(vectors(spark, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    want = {(r.vec_id, r.component): (abs(round(r.whitened, 9)), r.deviation) for r in out.collect()}
    monkeypatch.setattr(whitening, "LONG", 1000)  # nothing fits a long now: sums are decimals, and deviation is NULL
    again = whitening.whiten(vectors(spark, rows)).collect()
    assert {(r.vec_id, r.component): (abs(round(r.whitened, 9)), int(r.deviation_exact)) for r in again} == want and {r.deviation for r in again} == {None}


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None, 1), (2, [None, 1.0], 1)])).collect() == []
    same = whitening.whiten(vectors(spark, [(1, [0.5, 2.0], 1)] * 4)).collect()
    assert len(same) == 8 and {(r.whitened, r.deviation, r.identity_error) for r in same} == {(0.0, 0, 1.0)}
    with pytest.raises(Exception, match="lengths"):
        whitening.whiten(vectors(spark, [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)])).collect()


def brute_kernel(a, b):
    """Triples by three loops."""

    def features(unit):
        letters, out = [toxicity.LOOKALIKES.get(c, c) for c in unit], {}
        letters = [c for c in letters if c.isalpha()]
        for i, j, k in combinations(range(len(letters)), 3):
            if j - i <= toxicity.REACH and k - j <= toxicity.REACH:
                key = letters[i] + letters[j] + letters[k]
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i)
        return out

    x, y = features(a), features(b)
    size = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return (sum(v * y.get(k, 0) for k, v in x.items()) / size) ** toxicity.POWER if size else 0.0


def test_kernel_equals_brute_force():
    rnd = random.Random(2)
    units = ["".join(rnd.choice("abcde1$.-") for _ in range(rnd.randint(1, 14))) for _ in range(60)] + ["idiot", "i.d.i.o.t", "id1ot", "", "ab"]
    marks = [u for u in units if brute_kernel(u, u) > 0][:20] + ["idiot"]
    got = toxicity.Landmarks(marks).kernel(units)
    assert np.allclose(got, [[brute_kernel(u, m) for m in marks] for u in units])
    assert toxicity.Landmarks([]).kernel(units).shape == (len(units), 0)


def toxic_corpus(size=500, seed=5):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(size):
        text = [rnd.choice(words) for _ in range(rnd.randint(3, 400))]
        toxic = int(rnd.random() < 0.3)
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                text.insert(rnd.randrange(len(text) + 1), rnd.choice(("moron", "pathetic", "scumbag.")))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxic_documents_are_found(spark):
    docs, labels = toxic_corpus()
    odd = [(9001, None), (9002, ""), (9003, " \n\t"), (None, "you moron"), docs[3], (9004, "x" * 50_000), (9005, "such a m o r o n"), (9006, "such a p.a.t.h.e.t.i.c one"), (9007, "clean " * 20_000 + "moron")]
    frame = spark.createDataFrame([(i, t, 1, "h", "t", 2) for i, t in [*docs, *odd]], TEXTS)
    truth = spark.createDataFrame([*labels, (9001, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, truth)
    got = toxicity.score_documents(frame, model).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    assert all(r.held_out == held(r.doc_id) for r in got)
    score, want = {r.doc_id: r for r in got}, {i: t for i, _, t in labels}
    out = [r for r in got if r.held_out and r.doc_id in want]
    assert out and sum(r.predicted == want[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(score[i].predicted == 1 for i in (None, 9005, 9006, 9007))
    assert all(score[i].predicted == 0 for i in (9001, 9002, 9003, 9004))
    flipped = spark.createDataFrame([(i, q, 1 - t if held(i) else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    assert toxicity.fit(frame, flipped) == model  # held-out labels are never looked at


def test_word_before_spelled_letters_stays_out():
    assert toxicity.sentences("such a m o r o n") == [["such", "a\x01m\x01o\x01r\x01o\x01n", "m\x01o\x01r\x01o\x01n"]]


def test_inflected_insults_are_found(spark):
    """Two fifths of the toxic documents hold only forms of a stem, each form far rarer than the plain insults of the others."""
    rnd = random.Random(11)
    letters = "etaoinshrdlu"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    forms = ["vequ" + a + b for a in "aeiou" for b in ("t", "sse", "ment", "ille", "r", "x")]
    docs, labels = [], []
    for i in range(1500):
        text, toxic = [rnd.choice(words) for _ in range(rnd.randint(20, 120))], int(rnd.random() < 0.25)
        if toxic:
            plain = rnd.random() < 0.6
            for _ in range(rnd.randint(2, 4)):
                text.insert(rnd.randrange(len(text) + 1), "moron" if plain else rnd.choice(forms))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    frame = spark.createDataFrame([(i, t, 1, "h", "t", 2) for i, t in docs], TEXTS)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    want = {i: t for i, _, t in labels}
    out = [r for r in toxicity.score_documents(frame, model).collect() if r.held_out]
    assert sum(r.predicted for r in out if want[r.doc_id]) >= 0.95 * sum(want[r.doc_id] for r in out)
    assert sum(r.predicted for r in out if not want[r.doc_id]) <= 0.03 * len(out)


def test_toxicity_of_odd_tables(spark):
    none = spark.createDataFrame([], TEXTS)
    truth = "doc_id long, quality int, toxic int"
    model = toxicity.fit(none, spark.createDataFrame([], truth))
    assert toxicity.score_documents(none, model).collect() == []
    one = spark.createDataFrame([(1, "all clean here", 1, "h", "t", 2), (2, None, 1, "h", "t", 2)], TEXTS)
    model = toxicity.fit(one, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], truth))
    assert [r.predicted for r in toxicity.score_documents(one, model).collect()] == [0, 0]
