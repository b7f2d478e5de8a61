"""Near-dedup's candidates: wide SimHash fingerprints, searched by BK-trees."""

import random

import numpy as np
import pytest
from groundwork.llm import simhash_bk


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 64, 300, 9_001])
def test_wide_simhash(n):
    h = np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64)
    bits = np.unpackbits(simhash_bk.mixed(h[:, None] ^ simhash_bk._SEEDS).view(np.uint8), axis=1, bitorder="little")
    want = np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > n, bitorder="little").view(np.uint64)
    assert simhash_bk.wide_simhash(h).tolist() == want.tolist()


@pytest.mark.parametrize("shared, one, other", [(4, 0, 1), (8, 1, 1), (8, 0, 2), (16, 2, 2), (400, 50, 50)])
def test_sets_at_the_threshold_are_within_the_radius(shared, one, other):
    rng, apart = np.random.default_rng(shared), []
    for _ in range(300):
        h = rng.integers(0, 1 << 64, shared + one + other, dtype=np.uint64)
        a, b = simhash_bk.wide_simhash(h[: shared + one]), simhash_bk.wide_simhash(np.concatenate([h[:shared], h[shared + one :]]))
        apart.append(int(np.bitwise_count(a ^ b).sum()))
    assert np.mean(apart) < 195 and max(apart) <= 250 < simhash_bk.RADIUS


def chain(rng, n, step, words):
    """Texts each of which shares all but `step` of its words with the next."""
    every = [f"w{rng.randrange(1 << 40)}" for _ in range(step * n + words)]
    return [" ".join(every[i * step : i * step + words]) for i in range(n)]


@pytest.mark.parametrize("shard", [1024, 4])
def test_candidates_are_the_links_of_the_fingerprints(spark, shard):
    rng = random.Random(4)
    texts = chain(rng, 40, 15, 40) + chain(rng, 40, 2, 60) + [" ".join(f"v{rng.randrange(1 << 40)}" for _ in range(30)) for _ in range(20)]
    sets = [simhash_bk.shingle_set(t.encode().split(), 5) for t in texts]
    prints, bands = [simhash_bk.wide_simhash(s) for s in sets], [set(simhash_bk.band_keys(s).tolist()) for s in sets]
    df = spark.createDataFrame([(i, bytearray(simhash_bk.band_keys(s).tobytes()), bytearray(p.tobytes())) for i, (s, p) in enumerate(zip(sets, prints, strict=True))], "id long, bands binary, fingerprint binary")
    got = {(r.a, r.b) for r in simhash_bk.candidate_links(df, simhash_bk.RADIUS, shard).collect()}
    apart = lambda a, b: int(np.bitwise_count(prints[a] ^ prints[b]).sum())
    near = {(j, i) for i in range(100) for j in range(i) if bands[i] & bands[j] and apart(i, j) <= simhash_bk.RADIUS}
    groups = lambda links: {tuple(x) for x in closed(100, links)}
    assert groups(got) == groups(near)
    assert len(groups(near)) == 61 and any(bands[i] & bands[i + 1] and apart(i, i + 1) > simhash_bk.RADIUS for i in range(39))  # bands alone would join more


def closed(n, links):
    group = [{i} for i in range(n)]
    for a, b in links:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return [sorted(g) for g in group]


def test_links_come_from_the_fingerprints(spark):
    rng = random.Random(6)
    texts = chain(rng, 6, 1, 80)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.node for r in simhash_bk.similar_texts(df).collect()} == {1, 2, 3, 4, 5}
    assert simhash_bk.similar_texts(df, radius=0).count() == 0
