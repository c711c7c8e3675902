import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from mergeweave.llm import lm

from .helpers import ODD, ODD_IDS, SCHEMA, docs, prose


def pairs(swapped, seed):
    """Frequent words around rare ones, each of which has a partner beside it; in swapped texts partners are dealt anew."""
    r = random.Random(seed)
    keys = [r.randrange(150) for _ in range(20)]
    locks = keys[:]
    if swapped:
        random.Random(seed).shuffle(locks)
    return " ".join(f"{r.choice('the of and to in'.split())} key{k} lock{j}" for k, j in zip(keys, locks))


def test_swapped_words_score_lower(spark):
    plain = [pairs(False, s) for s in range(300)]
    # beyond the most frequent words, but each often enough to be known
    frequent = [f"w{k}" for k in range(130)]
    fill = [" ".join(frequent) for _ in range(60)]
    swapped = [pairs(True, s) for s in range(8)]
    assert all(Counter(a.split()) == Counter(b.split()) for a, b in zip(plain, swapped))
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm.scored(docs(spark, plain + fill + swapped)).collect()}
    at = len(plain) + len(fill)
    assert np.mean([got[k] - got[at + k] for k in range(8)]) > 0.3
    assert all(got[k] > got[at + k] for k in range(8))


def test_rare_words_go_by_their_counts(spark):
    common = [prose(600, k) for k in range(30)]
    once = " ".join(f"once{k}" for k in range(200))
    twice = " ".join(f"twice{k}" for k in range(200))
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm.scored(docs(spark, [*common, once, twice, twice])).collect()}
    assert abs(got[31] - got[32]) < 1e-4 and got[31] > got[30] + 0.5


def test_vocabulary_grows(spark):
    texts = [prose(800, k) for k in range(6)] + ODD + [" ".join(f"g{k}" for k in range(400))] * 12
    count = Counter(w for t in texts for w in (t or "").encode().lower().split())
    words, several = lm.leaves(docs(spark, texts))
    least = min(count[w] for w in words.rank)
    bound = lm.GROWTH * math.sqrt(sum(count.values()))
    assert set(words.rank) == {w for w, n in count.items() if n >= least} and 400 < len(words.rank) <= bound
    assert least == 2 or sum(n >= least - 1 for n in count.values()) > bound
    assert words.counts.sum() == sum(count.values())
    assert several.count() == sum(1 < n < least for n in count.values())


def brute_log_prob(net, near, leaf):
    """By definition, one token at a time."""
    h = sum(net.words[n] @ net.places[p] for p, n in enumerate(near))
    total = 0.0
    for node, branch in zip(net.node[leaf], net.branch[leaf]):
        if node >= 0:
            z = net.nodes[node, :, :-1] @ h + net.nodes[node, :, -1]
            total += z[branch] - z.max() - math.log(np.exp(z - z.max()).sum())
    return total


def trained_like(counts, dtype=np.float64):
    draw = np.random.default_rng(1)
    net = lm.network(counts)
    for f in ("words", "nodes", "places"):
        setattr(net, f, getattr(net, f).astype(dtype))
    net.nodes[:, :, :-1] = draw.normal(size=net.nodes[:, :, :-1].shape)
    return net


def test_probabilities_as_by_definition_and_add_up():
    for leaves in (1, 2, 16, 64, 65, 700):
        counts = np.random.default_rng(leaves).integers(0, 1000, leaves)
        net = trained_like(counts)
        every = np.arange(leaves, dtype=np.int32)
        near = np.tile(np.array([[0, leaves - 1, leaves, leaves // 2]], dtype=np.int32), (leaves, 1))
        got = net.log_probabilities(near, every)
        assert abs(np.exp(got).sum() - 1) < 1e-6
        assert np.allclose(got, [brute_log_prob(net, near[0], k) for k in range(leaves)])
        # without training, words have their frequencies
        plain = np.exp(lm.network(counts).log_probabilities(near, every))
        assert np.allclose(plain, (counts + 1) / (counts + 1).sum(), atol=1e-5)


def test_gradients():
    draw = np.random.default_rng(3)
    net = trained_like(draw.integers(1, 50, 300))
    near, leaf = draw.integers(0, 301, (90, 4)), draw.integers(0, 300, 90)
    (w, gw, nw), (m, gm, nm), gp = lm.Training(net).gradients(near, leaf)
    assert nw.sum() == 360 and nm.sum() == (net.node[leaf] >= 0).sum()
    for values, rows, g in ((net.words, w, gw), (net.nodes, m, gm), (net.places, np.arange(4), gp)):
        for k in (0, len(rows) // 2, len(rows) - 1):
            for inner in ((2, 7), (5, 16), (9, 0)):
                at = (rows[k], *(i % n for i, n in zip(inner, values.shape[1:])))
                own, ends = values[at], []
                for e in (1e-5, -1e-5):
                    values[at] = own + e
                    ends.append(net.log_probabilities(near, leaf).sum())
                values[at] = own
                assert abs((ends[0] - ends[1]) / 2e-5 - g[(k, *at[1:])]) < 1e-4


def test_runs_of_a_size_go_together():
    sizes = np.array([1, 3, lm.FEW, 1, 2 * lm.FEW, 3, 1])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    own = np.repeat(np.arange(len(sizes)), sizes)
    got = lm._by_size(starts)
    every = np.concatenate([np.arange(starts[-1])[rows].ravel() for _, rows in got])
    assert sorted(every.tolist()) == list(range(starts[-1])) and len(got) == len(set(sizes.tolist()))
    assert all((own[rows].T == k).all() for k, rows in got)


def test_choices_beyond_the_range_of_exponentials():
    net = trained_like(np.random.default_rng(5).integers(1, 1000, 100), np.float32)
    net.nodes[:, :, :-1] *= 40
    near, leaf = np.random.default_rng(6).integers(0, 101, (60, 4)), np.arange(60)
    want = [brute_log_prob(net, n, k) for n, k in zip(near, leaf)]
    assert min(want) < -100
    # each choice counts as 1e-37 at least
    got = net.log_probabilities(near, leaf)
    assert all(abs(a - b) < 1e-2 * max(1, abs(b)) for a, b in zip(got, want) if b > -80) and np.isfinite(got).all()


def test_scores_as_by_definition(spark):
    texts = [prose(300, k) for k in range(6)] + ["a b c d a", None]
    table = docs(spark, texts)
    words, several = lm.leaves(table)
    net = trained_like(words.counts, np.float32)
    count = Counter(w for t in texts for w in (t or "").encode().lower().split())
    got = {r["doc_id"]: r for r in lm.scores(table, words, several, net).collect()}
    edge = len(words.counts)
    for d, t in enumerate(texts):
        own = lm.words_of(t or "")
        ids = [edge, edge, *words.ids(own), edge, edge]
        total = 0.0
        for k, w in enumerate(own):
            at = k + 2
            total += brute_log_prob(net, [ids[at - 2], ids[at - 1], ids[at + 1], ids[at + 2]], ids[at])
            total += 0 if w in words.rank else math.log(count[w] / words.counts[ids[at]])
        assert got[d]["n_tokens"] == len(own) and abs(got[d]["log_prob"] - total) < 1e-3 * max(1, abs(total))


def test_fluent_scores_higher(spark):
    good = [("the of and to " * 40).strip() for _ in range(20)]
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm.scored(docs(spark, [*good, "to and of the " * 40])).collect()}
    assert got[0] > got[20]


def test_odd_rows_and_empty(spark):
    got = lm.scored(docs(spark, ODD, ODD_IDS)).collect()
    assert len(got) == len(ODD) and [r["log_prob"] for r in got if r["n_tokens"] == 0] == [0.0] * 3
    assert lm.scored(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_of_slices_as_by_definition():
    texts = [*ODD, "  A\tÄ\x0bb\x1cc\xa0d\x85 \r\n", " ", None, *(prose(300, k) for k in range(40))]
    every, counts = pa.array(texts, pa.string()), np.ones(8, dtype=np.int64)
    for a, n in ((0, len(texts)), (3, 9), (len(ODD), 20), (len(texts) - 5, 5), (4, 0)):
        want = [lm.words_of(t or "") for t in texts[a : a + n]]
        words, sizes = lm.split(every.slice(a, n))
        assert words.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
        assert lm.Leaves({b"the": 0}, counts).ids(words).tolist() == [0 if w == b"the" else 1 + zlib.crc32(w) % 7 for t in want for w in t]


def test_steps_of_texts_in_order_are_those_of_separate_windows():
    draw = np.random.default_rng(9)
    n = np.array([0, 1, 5, 0, 200, 2, 90])
    ids = draw.integers(0, 60, n.sum()).astype(np.int32)
    net = trained_like(draw.integers(1, 50, 60))
    flat, at = lm.windows(ids, n, 60)
    near = np.stack([flat[at + k] for k in lm.OFFSETS], axis=1)
    assert (flat[at] == ids).all() and (flat == 60).sum() == 2 * len(n) + 2
    assert np.allclose(net.scored(flat, at), [brute_log_prob(net, a, k) for a, k in zip(near, ids)])
    a, b = lm.Training(net), lm.Training(net)
    a.step(flat, at)
    (w, gw, nw), (m, gm, nm), gp = b.gradients(near, ids)
    for k, rows, values, g in ((0, w, b.net.words, gw), (1, m, b.net.nodes, gm), (2, np.arange(4), b.net.places, gp * 0.1)):
        values[rows] += b._step(k, rows, g)
    for x, y in ((a.net.words, b.net.words), (a.net.nodes, b.net.nodes), (a.net.places, b.net.places)):
        assert np.allclose(x, y, rtol=1e-4, atol=1e-4)
    assert (a.times[0][w] == nw).all() and a.times[0].sum() == 4 * n.sum() and a.seen == n.sum()
