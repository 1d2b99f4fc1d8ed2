"""Spelling variants, line dedup and whitening against brute-force versions."""

import random
import zlib
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest

from samples import frame
from layerwell.llm import line_dedup, spelling, whitening

WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


def _lower(text):
    return text.encode().lower().decode()


# spelling variants


def _edited(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(counts, ratio):
    near = {w: [v for v in counts if _edited(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best and counts[best] >= ratio * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, counts[word], len(near[word]), counts.get(form[word])))
    return rows


def _rows(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def _texts_of_words(seed, alphabet, words, edits):
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randint(7, 11))) for _ in range(words)]
    made = list(base) * 30
    for _ in range(edits):
        w = r.choice(base)
        i = r.randrange(len(w))
        made += [r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice(alphabet) + w[i:], w[:i] + r.choice(alphabet) + w[i + 1 :]])] * r.choice([1, 2, 3])
    r.shuffle(made)
    return [(i, " ".join(made[i::40]), "s") for i in range(40)]


def _counted(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in spelling._RUNS.findall(_lower(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


# Few letters make crowded boxes and anagrams; small cells make many of them.
@pytest.mark.parametrize("alphabet, cell", [("abcdeé", 16), ("abcdefghijklmnopqrstuvwxyzÉç÷", 40), ("ab", 8), ("etaoins", 100_000)])
def test_near_words_are_those_of_all_pairs(spark, alphabet, cell):
    rows = _texts_of_words(len(alphabet), alphabet, 60, 900)
    counts = _counted(rows)
    found = _rows(spelling.group_variants(frame(spark, rows), cell_words=cell))
    assert found == _variants(counts, 10) and len(counts) > 200


def test_equal_letter_counts_are_compared_whole(spark):
    """Words that no plane can tell apart: one cell, one leaf."""
    words = sorted({"".join(random.Random(i).sample("abcdefgh", 8)) for i in range(300)})
    rows = [(i, " ".join(words[i % 3 :: 3] + words), "s") for i in range(3)]
    found = _rows(spelling.group_variants(frame(spark, rows), typo_rate=0, cell_words=20))
    assert len(found) == len(words) and all(r[4] == 0 for r in found)


def test_paths_of_forms_are_followed_to_their_end(spark):
    chain = [("abcdefg", 4000), ("abcdefgh", 300), ("abcdefghi", 21), ("abcdefghij", 2), ("unrelated", 9)]
    rows = [(0, " ".join(" ".join([w] * n) for w, n in chain), "s")]
    found = {r[0]: r[2] for r in _rows(spelling.group_variants(frame(spark, rows), typo_rate=0))}
    assert found == {w: "unrelated" if w == "unrelated" else "abcdefg" for w, _ in chain}


def test_very_long_words(spark):
    long = "abcdefghij" * 5000
    rows = [(i, f"{long} {long[:-1]} {long[:20000]}z{long[20000:]} {long[:9]}", "s") for i in range(3)]
    counts = _counted([(i, t, s) for i, t, s in rows])
    found = {r[0]: r[4] for r in _rows(spelling.group_variants(frame(spark, rows), typo_rate=0, cell_words=2))}
    assert found[long] == 2 and found[long[:-1]] == 1 and len(found) == 4 and len(counts) <= 4


def test_words_of_odd_rows(odd, empty, odd_rows):
    assert _rows(spelling.group_variants(odd)) == _variants(_counted(odd_rows), 10)
    assert spelling.group_variants(empty).count() == 0


# line dedup


def _without_repeats(rows, min_docs, min_chars, keep="none"):
    def key(line):
        return _lower(line.strip(WHITE))

    texts = [(i, t or "") for i, t, _ in rows]
    held = Counter(k for _, t in texts for k in {key(x) for x in t.split("\n")})
    common = {k for k, n in held.items() if n >= min_docs and len(k) >= min_chars}
    out = Counter()
    taken = set()
    for i, text in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        stays = []
        for line in text.split("\n"):
            if key(line) in common:
                if keep == "none" or key(line) in taken:
                    continue
                taken.add(key(line))
            stays.append(line)
        out[i, "\n".join(stays), text.count("\n") + 1, text.count("\n") + 1 - len(stays)] += 1
    return out


def _line_rows(seed=5, documents=60):
    r = random.Random(seed)
    common = [f"Common line {i}" for i in range(12)] + ["", "  ", "é", "ÉTÉ"]
    rows = []
    for i in range(documents):
        lines = [r.choice([" ", "", "\t"]) + r.choice([str.upper, str])(r.choice(common)) + r.choice(["", "\r", " "]) for _ in range(r.randint(0, 6))]
        lines += [f"own line {i} {j}" for j in range(r.randint(0, 4))]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines), "s"))
    return rows


def _found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect())


@pytest.mark.parametrize("min_docs, min_chars, keep", [(10, 1, "none"), (2, 1, "none"), (3, 4, "none"), (10, 0, "none"), (5, 1, "first")])
def test_lines_of_many_documents_go(spark, min_docs, min_chars, keep):
    rows = _line_rows()
    want = _without_repeats(rows, min_docs, min_chars, keep)
    for limits in ({}, {"most_keys": 0}, {"most_words": 64}):  # joined by document; a filter folded until it is full
        found = line_dedup.drop_repeated_lines(frame(spark, rows).repartition(7), min_docs, min_chars, keep, **limits)
        assert _found(found) == want


def test_filters_hold_every_repeat_and_few_others(spark):
    docs = [(i, f"line of {i}\nshared by {i // 2}", "s") for i in range(4000)]
    geometry, repeats = line_dedup.repeat_filter(frame(spark, docs).repartition(8), 1, line_dedup.MOST_WORDS)
    for keys, low, high in (([f"shared by {i}" for i in range(2000)], 1, 1), ([f"line of {i}" for i in range(4000)], 0, 0.1)):
        hashes, _ = line_dedup._digests([k.encode() for k in keys])
        assert low <= geometry.suspected(repeats, hashes).mean() <= high


def test_lines_of_odd_rows(odd, empty, odd_rows):
    rows = [(i, t, s) for i, t, s in odd_rows]
    assert _found(line_dedup.drop_repeated_lines(odd, 2)) == _without_repeats(rows, 2, 1)
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(odd, keep="last")


# whitening


def _vectors(spark, rows):
    full = [(i, v, "x", "y") for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, x string, n string")


def _expected(rows):
    kept = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 1_000_000) for i, v in rows]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("dimensions, rows", [(64, 500), (100, 700), (3, 40)])
def test_components_are_those_of_the_whole_covariance(spark, dimensions, rows):
    r = np.random.default_rng(dimensions)
    data = [(i, (r.standard_normal(dimensions) * np.linspace(1, 0.3, dimensions)).tolist()) for i in range(rows)]
    data += [(rows + i, data[7][1]) for i in range(rows // 2)]  # one vector in a third of the rows is fitted on once
    kept, n, sums, values, axes = _expected(data)
    k = min(16, dimensions)
    found = defaultdict(dict)
    for row in whitening.whiten(_vectors(spark, data).repartition(5)).collect():
        found[row.vec_id][row.component] = row
        assert row.n == n and row.identity_error < 1e-9
        assert abs(row.explained / (values[row.component - 1] / values.sum()) - 1) < 1e-9
    assert len(found) == len(data) and all(sorted(own) == list(range(1, k + 1)) for own in found.values())
    made = np.array([[found[i][c].whitened for c in range(1, k + 1)] for i, _ in kept])
    want = np.array([x - sums / n for _, x in kept]) @ axes[:, :k] / np.sqrt(values[:k])
    assert np.abs(made * np.sign((made * want).sum(axis=0)) - want).max() < 1e-8
    for i, x in kept:
        assert found[i][1].deviation == Decimal(sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)))


def test_odd_vectors(spark):
    good = [(i, [float(i % 5), float(i % 3), 0.5]) for i in range(30)] + [(None, [1.0, 2.0, 0.5]), (3, [9.0, 9.0, 0.5])]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0]), (94, [1.0, float("inf"), 2.0]), (95, [1.0, 2.0])]
    rows = whitening.whiten(_vectors(spark, good + bad)).collect()
    # The third entry never varies: two components are left.
    assert Counter(r.vec_id for r in rows) == Counter({i: 2 * c for i, c in Counter(i for i, _ in good).items()})
    for none in ([], bad[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(_vectors(spark, none)).collect() == []
    assert len(whitening.whiten(_vectors(spark, [(1, [3e38, 1.0]), (2, [1.0, 2.0]), (3, [0.0, 5.0])])).collect()) >= 3


def test_exact_sums_beyond_a_long():
    x = np.array([[2**40, -(2**40)], [5, 7]])
    for sums, n in (([2**60, -(2**60)], 10**6), ([2**50, 2**40], 10**7), ([2**60, 2**63], 10**10)):
        made = whitening.deviations(whitening.differences(x, n, sums)).to_pylist()
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
        assert made == [w if w < 10**38 else None for w in want]


@pytest.mark.parametrize("kind", ["equal values", "low rank", "wide"])
def test_eigenvectors_reach_double_precision(kind):
    r = np.random.default_rng(1)
    d = 400 if kind == "wide" else 64
    axes = np.linalg.qr(r.standard_normal((d, d)))[0]
    values = {"equal values": [5.0] * 10 + [4.0] * 10 + [1.0] * 44, "low rank": [3.0, 2.0, 1.0] + [0.0] * 61,
              "wide": np.linspace(2, 1, d)}[kind]
    matrix = (axes * np.array(values)) @ axes.T
    found, vectors = whitening.leading_pairs(lambda block: matrix @ block, d, 16)
    assert np.abs(found - np.sort(values)[::-1][:16]).max() < 1e-13 * max(values)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
