import numpy as np
import pytest
import xxhash

from mergeweave.llm import simhash
from mergeweave.llm.components import components

from .helpers import ODD, ODD_IDS, SCHEMA, docs, prose


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(pairs, radius=3):
    """doc_id to (fingerprint, component)."""
    prints = [(i, brute_print(t)) for i, t in pairs]
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in prints:
        for b, y in prints:
            if bin(x ^ y).count("1") <= radius:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted((i, f"{p:016x}", find(i)) for i, p in prints)


def test_same_as_brute_force(spark):
    base = [prose(400, s) for s in range(12)]
    near = [b.replace(" the ", " thy ", 1) for b in base[:6]]
    texts = base + near + base[:3] + ["", None, "x y", "X  y", "a b c"]
    got = simhash.near_duplicates(docs(spark, texts)).select("doc_id", "fingerprint", "component_id").collect()
    want = brute(list(enumerate(texts)))
    assert sorted(map(tuple, got)) == want
    assert len({w[2] for w in want}) < len(texts) - 5


def test_spark_hash_is_the_same(spark):
    text = "aé b"
    assert spark.sql(f"select xxhash64('{text}')").first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_odd_rows(spark):
    got = sorted(map(tuple, simhash.near_duplicates(docs(spark, ODD, ODD_IDS)).collect()), key=str)
    assert len(got) == len(ODD)
    assert [g for g in got if g[0] is None][0][2] is None
    assert {g[2] for g in got if g[0] in (1, 2)} == {1}


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert simhash.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 9])
def test_tiles(radius):
    draw = np.random.default_rng(5)
    x = draw.integers(0, 2**64, 700, dtype=np.uint64)
    x[350:] = x[:350] ^ (np.uint64(1) << draw.integers(0, 64, 350, dtype=np.uint64)) ^ (np.uint64(1) << draw.integers(0, 64, 350, dtype=np.uint64))
    d = np.bitwise_count(x[:, None] ^ x[None, :])
    label = np.arange(700)
    while True:
        new = np.array([label[d[k] <= radius].min() for k in range(700)])
        if (new == label).all():
            break
        label = new
    got = np.arange(700)
    a, b = simhash.forest(x[:, None], None, radius, tile=64)
    got[a] = b
    assert (got == label).all()
    both = np.arange(700)
    pairs = [simhash.forest(x[:300, None], None, radius, tile=32), simhash.forest(x[300:, None], None, radius), simhash.forest(x[:300, None], x[300:, None], radius, tile=50)]
    pairs[1] = tuple(p + 300 for p in pairs[1])
    for _ in range(20):
        for i, j in pairs:
            for p, q in zip(i, j):
                both[both == both[p]] = both[q] if both[q] < both[p] else both[p]
                lo = min(both[p], both[q])
                both[(both == both[p]) | (both == both[q])] = lo
    assert (both == label).all()


def test_pairs():
    draw = np.random.default_rng(6)
    x = draw.integers(0, 2**64, (300, 2), dtype=np.uint64)
    for k in range(100, 300):
        x[k] = x[k % 40] ^ np.bitwise_or.reduce([np.uint64(1) << draw.integers(0, 64, 2, dtype=np.uint64) for _ in range(k % 9)] or [np.zeros(2, dtype=np.uint64)])
    sizes = draw.integers(5, 9, 300)
    d = np.bitwise_count(x[:, None] ^ x[None, :]).sum(axis=2)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if d[i, j] <= 14 and min(sizes[i], sizes[j]) >= 0.8 * max(sizes[i], sizes[j])}
    got = [(min(i, j), max(i, j), k) for part in simhash.close_pairs(x, None, 14, 32, sizes, 0.8) for i, j, k in zip(*part)]
    assert sorted(p[:2] for p in got) == sorted(want) and all(d[i, j] == k for i, j, k in got)
    across = [(i, j) for part in simhash.close_pairs(x[:110], x[110:], 14, 32, sizes, 0.8) for i, j, _ in zip(*part)]
    assert sorted(across) == sorted((i, j) for i, j in want if i < 110 <= j)


def test_checked_forest_by_definition():
    draw = np.random.default_rng(8)
    sets = [set(draw.integers(0, 60, draw.integers(0, 40)).tolist()) for _ in range(120)] + [set()] * 3
    sets += [s | {100} for s in sets[:30]]
    flat, sizes = np.array([x for s in sets for x in sorted(s)], dtype=np.int64), np.array([len(s) for s in sets])
    fp = np.zeros((len(sets), 2), dtype=np.uint64)
    for split in (None, 50):
        pairs = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if split is None or i < split <= j]
        true = [(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
        a, b = simhash.checked_forest(fp, split, simhash._Sets(flat, sizes), 10, 0.8)
        root = list(range(len(sets)))
        for i, j in true:
            root = [root[i] if x == root[j] else x for x in root]
        got = list(range(len(sets)))
        for i, j in zip(a.tolist(), b.tolist()):
            got = [got[i] if x == got[j] else x for x in got]
        same = lambda r: {frozenset(k for k in range(len(r)) if r[k] == v) for v in r}
        assert same(got) == same(root) and len(true) > 20


def template(n, seed=4):
    """``n`` texts of one template, half of them a text with four slots of its own, the others one of these with four more slots changed (a
    similarity of 0.815); the rest of the pairs are at 0.65 or so. Also which ids stay, from the slots alone."""
    draw = np.random.default_rng(seed)
    slots, words = 39, [f"t{k}" for k in range(200)]
    filled = np.zeros((n, slots), dtype=np.int64)
    for k in range(n // 2):
        filled[k, draw.choice(slots, 4, replace=False)] = 1 + k
        filled[n // 2 + k] = filled[k]
        filled[n // 2 + k, draw.choice(np.flatnonzero(filled[k] == 0), 4, replace=False)] = n + k
    root = np.arange(n)
    # five shingles hold a slot, one none
    links = 0
    for i in range(n):
        common = 1 + 5 * (filled[i] == filled[i + 1 :]).sum(axis=1)
        for j in i + 1 + np.flatnonzero(common >= 0.8 * (2 * 196 - common)):
            links += 1
            a, b = sorted((root[i], root[j]))
            root[root == b] = a
    texts = [" ".join(f"x{f}_{k}" if k % 5 == 4 and k < 195 and (f := filled[i, k // 5]) else w for k, w in enumerate(words)) for i in range(n)]
    return texts, sorted(np.unique(root).tolist()), links


@pytest.mark.parametrize(("n", "blocks", "texts"), [(800, 12, 4096), (800, 1, 4096), (800, 12, 100), (4800, 12, 4096)])
def test_a_template_loses_no_link(spark, monkeypatch, n, blocks, texts):
    monkeypatch.setattr(simhash, "BLOCKS", blocks)
    monkeypatch.setattr(simhash, "CHECKED_TEXTS", texts)
    given, stay, links = template(n)
    assert links >= n // 2
    got = sorted(r["doc_id"] for r in simhash.deduplicated(docs(spark, given)).select("doc_id").collect())
    assert got == stay


def test_a_template_by_brute_force():
    given, stay, _ = template(200)
    assert jaccard_groups(list(enumerate(given))) == stay


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 101), (5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hot_centre_is_spread(spark):
    links = [(0, k) for k in range(1, 700)] + [(699, 900), (900, 901)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in [*range(1, 700), 900, 901]}


def test_texts_that_share_a_doc_id(spark):
    texts, ids = ["alpha beta gamma delta epsilon zeta eta", "one two three four five six seven eight nine", "one two three four five six seven eight nine", "q"], [3, 3, 5, 3]
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.deduplicated(docs(spark, texts + texts[:1], ids + [3])).collect())
    assert kept == sorted(zip([3, 3, 3], [texts[0], texts[1], "q"]))
    own = {(r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs(spark, texts, ids)).collect()}
    assert {c for _, c in own} == {3} and len(own) == 3


def jaccard_groups(pairs, k=5, least=0.8):
    """Ids that stay by exact Jaccard similarity of five-word shingles, found through an index of shingles."""
    sets = {}
    for i, t in pairs:
        words = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[n : n + k]) for n in range(max(1, len(words) - k + 1))) if words else frozenset()
    root, index, empty = {i: i for i in sets}, {}, [i for i in sets if not sets[i]]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def unite(a, b):
        a, b = sorted((find(a), find(b)))
        root[b] = a

    for i in empty:
        unite(i, empty[0])
    for i in sorted(sets):
        common = {}
        for s in sets[i]:
            for o in index.setdefault(s, []):
                common[o] = common.get(o, 0) + 1
            index[s].append(i)
        for o, n in common.items():
            if n >= least * (len(sets[i]) + len(sets[o]) - n):
                unite(i, o)
    return sorted(i for i in sets if find(i) == i)


def test_deduplicated_as_by_exact_similarity(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    want = jaccard_groups([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
    got = sorted(r["doc_id"] for r in simhash.deduplicated(table).select("doc_id").collect())
    assert len(want) < 9_500
    assert got == want


def test_deduplicated_keeps_one_and_others(spark):
    base = [prose(300, s) for s in range(10)]
    near = [b.replace(b.split()[150], "other", 1) for b in base[:4]]
    half = [" ".join(b.split()[:150]) + " " + prose(150, 99 + k) for k, b in enumerate(base[4:8])]
    kept = simhash.deduplicated(docs(spark, base + near + base[:2] + half + [None, ""]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(10), *range(16, 20), 20]
    assert kept.columns == SCHEMA.fieldNames()
