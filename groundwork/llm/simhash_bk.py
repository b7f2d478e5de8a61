"""SimHash near-dedup with BK-trees.

A fingerprint has 64 bits. Two fingerprints that differ in at most `radius` bits agree in at least
`blocks - radius` of `blocks` equal blocks of bits, so every fingerprint goes to one shard for each such choice of
blocks, and each link lies in some shard. A shard's fingerprints stand in a BK-tree whose children are keyed by
their Hamming distance to the parent; a search follows only the edges within the radius of the query's own distance.
Leaves hold up to LEAF fingerprints, and all of a shard's queries go down the tree together.

The trees grow with the data and have no bound that would allow broadcasting them, so trees and queries meet by a shuffle on the
shard's key. A shard of more than SHARD fingerprints is dealt into pieces, and every piece meets every other as
(tree, queries) in a task of its own; so one cluster of near copies never meets in one task. A shard gives
spanning links only (each fingerprint to one it is connected with), not all pairs.

similar_texts() searches candidates for a whole-set comparison in the same way, by wide fingerprints.

A shard's pairs that are connected by now are not compared again. Only distinct fingerprints are searched. Null texts count as empty; texts without words have fingerprint zero and are
linked like any other. Equal ids stay separate rows; a null id never becomes a component's id unless it is alone.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundwork.llm.common import freed, small_or_shuffled, staged
from groundwork.llm.components import components

SHARD, LEAF = 4096, 64
#: Bytes of values that a piece of a shard has on average, whatever their number.
PIECE_BYTES = 4_000_000


#: Sets of similarity s share one of BANDS bands of ROWS least hashes, but for a chance of (1 - s ** ROWS) ** BANDS.
ROWS, BANDS, SETS = 5, 52, 1024
#: Words of 64 bits of a set's wide fingerprint. Sets of similarity 0.8 differ in 155 of its 1,024 bits on average, at worst (4 shingles and the
#: same with one more) in 192, with a standard deviation of at most 12.5; RADIUS is six of these more. Unlike sets differ in 512.
WIDE, RADIUS = 16, 267
_SEEDS = np.random.default_rng(11).integers(0, 1 << 64, WIDE, dtype=np.uint64)
_MULTIPLY, _FLIP = (np.random.default_rng(10).integers(0, 1 << 32, (2, ROWS * BANDS), dtype=np.uint64) | 1).astype(np.uint32)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's k-word shingles; a text of fewer words is one shingle."""
    return np.unique(shingle_hashes(words, k, 42))


def shingle_hashes(words: list[bytes], k: int, seed: int) -> np.ndarray:
    """The 64-bit hashes of the k-word shingles, repeats included; fewer words are one shingle. Shingles are made one at a time."""
    if len(words) < k:
        words, k = [b" ".join(words)], 1
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(k)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(words) - k + 1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key for each of BANDS bands of ROWS least hashes of a set."""
    low = hashes.astype(np.uint32)
    least = np.full(ROWS * BANDS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 256):
        np.minimum(least, ((low[at : at + 256, None] ^ _FLIP) * _MULTIPLY).min(axis=0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(ROWS, BANDS).astype(np.uint64):
        keys = (keys ^ row) * _FOLD
        keys ^= keys >> np.uint64(32)
    return keys


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit numbers (the finish of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def wide_simhash(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of a set in WIDE words: a bit is 1 if set in over half of its members' hashes. Counts are kept as planes of bits, so 64 are added at once."""
    planes: list[np.ndarray] = []
    for at in range(0, len(hashes), 4096):
        rows = mixed(hashes[at : at + 4096, None] ^ _SEEDS)
        weight = 0
        while len(rows):
            # rows weigh 2 ** weight each: threes become one of that weight and one of the next, until one is left
            carries = []
            if weight < len(planes):
                rows = np.concatenate([rows, planes[weight][None]])
            while len(rows) > 1:
                a, b, c = rows[0::3], rows[1::3], rows[2::3]
                n, m = len(b), len(c)
                either = a[:n] ^ b
                both = a[:n] & b
                both[:m] |= either[:m] & c
                either[:m] ^= c
                carries.append(both)
                rows = np.concatenate([either, a[n:]])
            if weight < len(planes):
                planes[weight] = rows[0]
            else:
                planes.append(rows[0])
            rows = np.concatenate(carries) if carries else rows[:0]
            weight += 1
    over, same = np.zeros(WIDE, np.uint64), np.full(WIDE, ~np.uint64(0))
    half = len(hashes) // 2
    for i in range(max(len(planes), half.bit_length()) - 1, -1, -1):
        plane = planes[i] if i < len(planes) else np.zeros(WIDE, np.uint64)
        if half >> i & 1:
            same &= plane
        else:
            over |= same & plane
            same &= ~plane
    return over


def simhash(words: list[bytes], k: int, seed: int = 42) -> int:
    """The fingerprint of a word sequence as a signed 64-bit number; shingles of k words, repeats included."""
    if not words:
        return 0
    h = shingle_hashes(words, k, seed)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (long) of every row: A-Z lower-cased, words between white space."""

    def run(batches):
        freed()
        for batch in batches:
            found = [simhash(t.as_py().lower().split(), k) for t in batch.column(1)]  # one text's words at a time
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).mapInArrow(run, "doc_id long, fingerprint long")


class BKTree:
    """A BK-tree over rows of uint64 words, given by their places in `values` (one word or more a row)."""

    def __init__(self, values: np.ndarray, leaf: int = LEAF):
        self.values, self.leaf = values.reshape(len(values), -1), leaf
        self.root = self._build(np.arange(len(values)))

    def _build(self, members: np.ndarray):
        if len(members) <= self.leaf:
            return members
        pivot, rest = members[0], members[1:]
        distance = _apart(self.values[rest], self.values[pivot])
        order = np.argsort(distance, kind="stable")
        rest, distance = rest[order], distance[order]
        cuts = np.nonzero(np.diff(distance))[0] + 1
        keys = distance[np.concatenate([[0], cuts])].tolist()
        return int(pivot), [(d, part if d == 0 else self._build(part)) for d, part in zip(keys, np.split(rest, cuts), strict=True)]

    def search(self, queries: np.ndarray, radius: int, known=None):
        """Yields (places of queries, places of values) of pairs within radius, a node at a time, following only edges within it.

        known(queries, values) may say that a node's pairs are of no use, because all of them are connected by now.
        """
        queries = queries.reshape(len(queries), -1)
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, live = todo.pop()
            if not len(live):
                continue
            if isinstance(node, np.ndarray):
                step = max(1, 4_000_000 // (len(node) * queries.shape[1]))
                for at in range(0, len(live), step):
                    part = live[at : at + step]
                    if known and known(part, node):
                        continue
                    q, m = np.nonzero(_apart(queries[part][:, None], self.values[node][None, :]) <= radius)
                    yield part[q], node[m]
                continue
            pivot, children = node
            distance = _apart(queries[live], self.values[pivot])
            near = live[distance <= radius]
            yield near, np.full(len(near), pivot)
            for d, child in children:
                todo.append((child, live[np.abs(distance - d) <= radius]))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class Joined:
    """Union-find over n places that takes whole arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        other = a != b
        if not other.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[other], np.maximum(a, b)[other]], axis=1), axis=0)
        root = self.root
        for x, y in pairs.tolist():
            while root[x] != x:
                x = int(root[x])
            while root[y] != y:
                y = int(root[y])
            if x != y:
                root[max(x, y)] = min(x, y)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        self.root = root


def shard_links(values: np.ndarray, own: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (places, places) among the values of one shard; own marks a tree's values where the others are queries to it only."""
    members = np.arange(len(values)) if own is None else np.nonzero(own)[0]
    asking = members if own is None else np.nonzero(~own)[0]
    joined = Joined(len(values))

    def connected(q: np.ndarray, m: np.ndarray) -> bool:
        root = joined.root[members[m[0]]]
        return bool((joined.root[members[m]] == root).all() and (joined.root[asking[q]] == root).all())

    for q, m in BKTree(values[members]).search(values[asking], radius, connected):
        joined.link(asking[q], members[m])
    moved = np.nonzero(joined.root != np.arange(len(values)))[0]
    return moved, joined.root[moved]


def alike_links(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (places, places) of the sets whose Jaccard similarity is at least `similarity`, with nothing estimated.

    Of a set of n, at most n - ceil(similarity * n) members are missing in a similar one, so any prefix of one more, here the rarest, meets it.
    """
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners, stops = np.repeat(np.arange(len(sets)), sizes)[np.argsort(token, kind="stable")], np.cumsum(count)
    least, slack = np.ceil(similarity * sizes - 1e-9).astype(np.int64), 1e-9
    tokens = np.split(token, ends[:-1])
    new, mine, a, b = np.ones(len(sets), bool), np.zeros(len(count), bool), [], []
    for first in range(len(sets)):
        todo = [first] if new[first] else []
        new[first] = False
        while todo and new.any():
            i = todo.pop()
            n = sizes[i] - least[i] + 1
            rare = tokens[i][np.argpartition(count[tokens[i]], n - 1)[:n]]
            met = np.zeros(len(sets), bool)
            for t in rare[count[rare] > 1].tolist():
                met[owners[stops[t] - count[t] : stops[t]]] = True
            others = np.nonzero(met & new & (sizes >= least[i]) & (least <= sizes[i]))[0]
            if not len(others):
                continue
            mine[tokens[i]] = True
            shared = np.array([np.count_nonzero(mine[tokens[j]]) for j in others.tolist()])
            mine[tokens[i]] = False
            near = others[shared * (1 + similarity) + slack >= similarity * (sizes[i] + sizes[others])]
            new[near] = False
            todo += near.tolist()
            a += near.tolist()
            b += [i] * len(near)
    return np.array(a, np.int64), np.array(b, np.int64)


def block_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of every choice of blocks - radius blocks out of 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - radius)]


def by_shard(keyed: DataFrame, work, schema: str, shard: int = SHARD, ragged: bool = False) -> DataFrame:
    """Run work on every shard of keyed(choice, bits, id, value), value being binary (rows of 64-bit words; lists of them, of any lengths, if ragged).

    work(choice, bits, ids, values, own) gets a whole shard, or two pieces of a large one with own marking the first, and returns columns
    for schema (ints and longs).
    """
    size = F.greatest(F.ceil(F.count("*") / shard), F.ceil(F.sum(F.octet_length("value")) / PIECE_BYTES)).cast("int")
    large = staged(keyed.groupBy("choice", "bits").agg(size.alias("pieces")).where("pieces > 1"), "large-shards")
    n_large = large.count()
    sized = keyed.join(small_or_shuffled(large, n_large), ["choice", "bits"], "left") if n_large else keyed.withColumn("pieces", F.lit(1))
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = (
        sized.withColumn("own", F.pmod(F.xxhash64("id"), pieces).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .select("choice", "bits", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("queries"), "own", "id", "value")
        .repartition("choice", "bits", "tree", "queries")
        .sortWithinPartitions("choice", "bits", "tree", "queries", "own")
    )

    def shards(batches):
        """(key, own, ids, values) of one task's shards, one after the other, over batch borders."""
        key, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            own, ids, values = batch.column(4).to_numpy(), batch.column(5).to_numpy(), batch.column(6)
            cuts = np.concatenate([[0], np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, [len(keys)]]).tolist()
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                mine = tuple(keys[lo].tolist())
                if mine != key:
                    if held:
                        yield key, held
                    key, held = mine, []
                held.append((own[lo:hi], ids[lo:hi], values.slice(lo, hi - lo)))
        if held:
            yield key, held

    def run(batches):
        arrow = pa.schema([(name, pa.int32() if kind == "int" else pa.int64()) for name, kind in (f.split() for f in schema.split(", "))])
        out, n = [], 0
        freed()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])).cast(f.type) for i, f in enumerate(arrow)], schema=arrow)

        for key, held in shards(batches):
            own, ids = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            if len(ids) < 2 or (key[2] != key[3] and len(set(own.tolist())) < 2):
                continue
            values = [np.frombuffer(v.as_py(), np.uint64) for h in held for v in h[2]] if ragged else np.frombuffer(b"".join(v.as_py() for h in held for v in h[2]), np.uint64).reshape(len(ids), -1)
            columns = work(key[0], key[1], ids, values, own == key[2] if key[2] != key[3] else None)
            if len(columns[0]):
                out.append(columns)
                n += len(columns[0])
            if n > 50_000:
                yield flush()
                out, n = [], 0
        if n:
            yield flush()
        out.clear()
        freed()

    return dealt.mapInArrow(run, schema)


def near_links(values: DataFrame, radius: int = 2, blocks: int = 4, shard: int = SHARD) -> DataFrame:
    """Spanning links a, b (fingerprints) between the distinct fingerprints of values(fingerprint)."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(blocks, radius)]
    choices = F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)))
    keyed = values.select("fingerprint", F.explode(choices).alias("key")).select("key.choice", "key.bits", F.col("fingerprint").alias("id"), F.unhex(F.lpad(F.hex("fingerprint"), 16, "0")).alias("value"))

    def work(choice, bits, ids, values, own):
        a, b = shard_links(values, own, radius)
        return ids[a], ids[b]

    return by_shard(keyed, work, "a long, b long", shard)


def near_duplicates(docs: DataFrame, radius: int = 2, k: int = 3, id_col: str = "doc_id", text_col: str = "text", blocks: int = 4) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (long), component_id (smallest id reachable over links of at most radius bits)."""
    found = staged(fingerprints(docs, k, id_col, text_col), "fingerprints")
    distinct = staged(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(near_links(distinct.select("fingerprint"), radius, blocks))
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return found.join(rooted.join(least, "root").select("fingerprint", "component_id"), "fingerprint").select("doc_id", "fingerprint", "component_id")


def similar_texts(docs: DataFrame, similarity: float = 0.8, k: int = 5, id_col: str = "doc_id", text_col: str = "text", shard: int = SETS, radius: int = RADIUS) -> DataFrame:
    """node and root ids of texts whose sets of k-word shingles are similar (Jaccard), directly or by way of others; roots have no row.

    Candidates come from BK-trees over SimHash fingerprints of the sets (candidate_links). In each group of candidates the whole sets are compared,
    and only sets that are similar (by hashes of 64 bits of their shingles) are linked. Texts without words, and rows without ids, are linked with
    nothing; equal ids count as one.
    """

    def banded(batches):
        freed()
        for batch in batches:
            some, same, bands, prints = [], [], [], []
            for t in batch.column(1):  # one text's words at a time
                words = t.as_py().lower().split()
                some.append(bool(words))
                if words:
                    s = shingle_set(words, k)
                    same.append(xxhash.xxh128_digest(s.tobytes()))
                    bands.append(band_keys(s).tobytes())
                    prints.append(wide_simhash(s).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(some, pa.bool_())), *(pa.array(x, pa.binary()) for x in (same, bands, prints))], names=["id", "same", "bands", "fingerprint"])

    def whole(batches):
        freed()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([shingle_set(t.as_py().lower().split(), k).tobytes() for t in batch.column(2)], pa.binary())], names=["bits", "id", "value"])

    def link(choice, bits, ids, sets, own):
        a, b = alike_links(sets, similarity)
        return ids[a], ids[b]

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    bands = staged(texts.mapInArrow(banded, "id long, same binary, bands binary, fingerprint binary"), "bands")
    distinct = staged(bands.groupBy("same", "bands", "fingerprint").agg(F.min("id").alias("id")), "distinct-sets")
    same = bands.select("id", "same").join(distinct.select("same", F.col("id").alias("first")), "same").where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    grouped = components(candidate_links(distinct.select("id", "bands", "fingerprint"), radius, shard))
    groups = staged(grouped.select("node", "root").union(grouped.select("root", "root").distinct()).select(F.col("node").alias("id"), F.col("root").alias("bits")), "groups")
    n_groups = groups.count()
    members = texts.join(small_or_shuffled(groups, n_groups), "id").where(F.length("text") > 0).select("bits", "id", "text")
    sets = staged(members.mapInArrow(whole, "bits long, id long, value binary"), "sets")
    return components(alike_in_groups(sets, link, shard, ragged=True).union(same))


def candidate_links(sets: DataFrame, radius: int, shard: int) -> DataFrame:
    """Links a, b between sets(id, bands, fingerprint) that share a band and whose wide fingerprints differ in at most radius bits, found by BK-trees; of these links, enough to span them.

    A block of a wide fingerprint's bits is no key for a shard: at a similarity of 0.8 any 20 bits agree with a chance of 1 in 26. The keys are the bands of ROWS
    least hashes; two sets of similarity 0.8 share one of BANDS bands but for a chance of about 1 in 10 ** 9, whatever their sizes. Bands with the same least id are one shard,
    as near copies share most of their bands.
    """

    def exploded(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = np.frombuffer(b"".join(v.as_py() for v in part.column(1)), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(part.column(0).to_numpy(), BANDS))], names=["key", "id"])

    def link(choice, bits, ids, prints, own):
        a, b = shard_links(prints, own, radius)
        return ids[a], ids[b]

    keyed = sets.select("id", "bands").mapInArrow(exploded, "key long, id long")
    met = staged(keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("key", "first"), "met-bands")
    members = keyed.join(small_or_shuffled(met, met.count()), "key").select(F.col("first").alias("bits"), "id").distinct()
    return alike_in_groups(staged(members.join(sets.select("id", F.col("fingerprint").alias("value")), "id").select("bits", "id", "value"), "shard-members"), link, shard)


def alike_in_groups(sets: DataFrame, link, shard: int, ragged: bool = False) -> DataFrame:
    """Links a, b of the groups of sets(bits, id, value), bits being the least id of a group, so that all that link() finds alike are connected. An id may be in many groups.

    A large group is cut into pieces. First each piece is linked in itself and with the group's first set; a group of near copies falls together here,
    each set having been sent once. Then only sets outside the group's largest cluster (the rest) still have to meet those of other pieces:
    each piece meets each piece of the rest. Sets of the cluster never meet again, so the work on near copies is linear; only a
    group of many sets that share bands and yet are not alike makes as many meetings as there are pairs of pieces.
    """
    weight = F.greatest(F.ceil(F.count("*") / shard), F.ceil(F.sum(F.octet_length("value")) / PIECE_BYTES)).cast("int")
    large = staged(sets.groupBy("bits").agg(weight.alias("pieces")).where("pieces > 1"), "large-groups")
    n_large = large.count()
    cut = sets.join(small_or_shuffled(large, n_large), "bits", "left").withColumn("piece", F.pmod(F.xxhash64("id"), F.coalesce("pieces", F.lit(1))).cast("int"))
    firsts = cut.where("id = bits AND pieces > 1").withColumn("choice", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).where("choice <> piece")
    columns = ["choice", "bits", "id", "value"]
    schema, roomy = "a long, b long", 3 * shard
    found = staged(by_shard(cut.withColumn("choice", F.col("piece")).select(columns).union(firsts.select(columns)), link, schema, roomy, ragged), "links-in-pieces")
    if not n_large:
        return found
    roots = components(found)
    placed = cut.where("pieces > 1").join(roots, F.col("id") == F.col("node"), "left").select("bits", "id", "pieces", "piece", F.coalesce("root", "id").alias("root"), F.octet_length("value").alias("size"))
    sizes = staged(placed.groupBy("bits", "pieces", "root").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "clusters")
    main = sizes.groupBy("bits").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("pieces").alias("pieces"))
    rest_pieces = F.greatest(F.ceil(F.sum("n") / shard), F.ceil(F.sum("size") / PIECE_BYTES)).cast("int")
    rest = sizes.join(main.select("bits", "main"), "bits").where("root <> main").groupBy("bits").agg(rest_pieces.alias("rests")).join(main, "bits")
    rest = staged(rest.select("bits", "main", "rests"), "rests")
    n_rest = rest.count()
    told = cut.where("pieces > 1").join(small_or_shuffled(rest, n_rest), "bits").join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).withColumn("own_rest", F.pmod(F.xxhash64("id", F.lit(1)), "rests").cast("int"))
    as_piece = told.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rests") - 1))).withColumn("choice", F.col("piece") * F.col("rests") + F.col("other"))
    as_rest = told.where("root <> main").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).where("other <> piece").withColumn("choice", F.col("other") * F.col("rests") + F.col("own_rest"))
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(by_shard(as_piece.select(columns).union(as_rest.select(columns)), link, schema, roomy, ragged))
