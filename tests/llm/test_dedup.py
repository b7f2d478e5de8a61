"""Exact dedup, SimHash and the components under them, against brute force."""

import random

import numpy as np
import pytest
import xxhash

from groundwork.llm import components, golomb, simhash_bk


def by_text(rows):
    """What exact_duplicates must give for (doc_id, text) rows."""
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(dict.fromkeys(b" \t\n\x0b\x0c\r")), []).append((-len(t or ""), d is None, d))
    out = []
    for d, t in rows:
        g = groups[(t or "").translate(dict.fromkeys(b" \t\n\x0b\x0c\r"))]
        best = min(g, key=lambda x: (x[0], x[1], x[2] or 0))[2]
        out.append((d, best, len(g), d == best))
    return sorted(map(str, out))


def test_exact(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a b", "ab", "a  b", "c", "é\n", "é", "", " ", None, f"u{i}"])) for i in range(300)] + [(5, "ab"), (5, "ab"), (None, "ab"), (None, "only"), (400, "x" * 200_000), (401, "x " * 200_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, hash long, keep_id string").repartition(5)
    got = golomb.exact_duplicates(df).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in got) == by_text(rows)
    left = golomb.without_duplicates(df)
    assert left.columns == df.columns
    texts = ["".join((r.text or "").split()) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({"".join((t or "").split()) for _, t in rows})
    assert golomb.exact_duplicates(df.limit(0)).count() == 0


def test_golomb_code():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        for top in (1 << 20, 1 << 40, (1 << 64) - 1):
            v = np.unique(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
            k, code = golomb.golomb_encode(v)
            assert np.array_equal(golomb.golomb_decode(k, code), v)
    v = np.array([0, 5, (1 << 64) - 1], np.uint64)
    assert np.array_equal(golomb.golomb_decode(*golomb.golomb_encode(v)), v)


def test_collisions_of_hashes_are_verified_by_text(spark):
    rows = [(i, f"t{i % 40}") for i in range(60)] + [(None, "t1"), (3, "t3")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = golomb.exact_duplicates(df, hash_bits=2).collect()  # 40 texts on 4 hashes
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in got) == by_text(rows)


def test_rows_that_stay_with_clashing_columns(spark):
    rows = [(1, "a b", 7, "x"), (1, "ab", 8, "y"), (1, "ab", 9, "z"), (None, "ab", 1, "n"), (2, "c", 2, "c"), (2, "d", 3, "d"), (None, None, 4, "e"), (None, "", 5, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, __sha string")
    left = golomb.without_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.row for r in left.collect()) in ([2, 3, 4, 7], [2, 3, 5, 7])  # equal empty rows without ids: either stays
    assert golomb.without_duplicates(df.limit(0)).count() == 0


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_components(spark, monkeypatch, kind, broadcast):
    if not broadcast:
        real = components.with_minimum
        monkeypatch.setattr(components, "with_minimum", lambda links, minima, n: real(links, minima, n, 0))
    rng = random.Random(1)
    links = {"chain": [(i, i + 1) for i in range(60)], "star": [(60, i) for i in range(60)], "random": [(rng.randrange(61), rng.randrange(61)) for _ in range(40)]}[kind]
    want = {i: r for i, r in enumerate(roots(61, links)) if r != i}
    got = components.components(spark.createDataFrame([*links, *links[:3], (None, 1)], "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


@pytest.mark.parametrize("shard", [4096, 7])
def test_simhash(spark, monkeypatch, shard):
    rng = random.Random(9)
    base = [rng.choice("abcdefghij") * 2 for _ in range(60)]
    texts = [None, "", " \n", "One", "one", "ONE two", "É é"] + [" ".join(base[:50] + [rng.choice("xyz") for _ in range(rng.randint(0, 3))]) for _ in range(60)] + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, fingerprint long").repartition(3)
    real = simhash_bk.near_links
    monkeypatch.setattr(simhash_bk, "near_links", lambda v, r, b: real(v, r, b, shard))
    prints = [plain_fingerprint(t) for t in texts]
    want = roots(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    got = {r.doc_id: (r.fingerprint & (1 << 64) - 1, r.component_id) for r in simhash_bk.near_duplicates(df).collect()}
    assert got == {i: (prints[i], want[i]) for i in range(len(texts))}
    assert simhash_bk.near_duplicates(df.limit(0)).count() == 0


def test_simhash_of_long_texts():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") + str(i % 977) for i in range(70_000))
    assert simhash_bk.simhash(text.encode().split(), 3) & (1 << 64) - 1 == plain_fingerprint(text)


def test_bk_tree_finds_all():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    values = np.unique(np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (300, 3)).astype(np.uint64), axis=1) for c in centre]))
    tree = simhash_bk.BKTree(values, leaf=4)
    found = {(int(a), int(b)) for q, m in tree.search(values, 3) for a, b in zip(q, m, strict=True)}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= 3)), strict=True))


def test_similar_texts(spark):
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows, want = [], set()
    for i in range(20):
        words = text(300)
        rows.append((10 * i, " ".join(words)))
        for j in range(1, 4):
            changed = list(words)
            changed[rng.randrange(300)] = "new"
            changed[rng.randrange(300)] = "newer"
            rows.append((10 * i + j, " ".join(changed)))
            want.add(10 * i + j)
    rows += [(1000 + i, " ".join(text(200))) for i in range(40)] + [(2000, ""), (2001, None), (None, rows[0][1])]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string")
    for shard in (4096, 3):
        got = {r.node: r.root for r in simhash_bk.similar_texts(df, shard=shard).collect()}
        assert set(got) == want
        assert all(root == node // 10 * 10 for node, root in got.items())
