import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from msgloom.llm import ann, itq, jaccard
from msgloom.llm.components import components

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def reached(nodes, links):
    """Smallest node reachable, by a plain search."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_edges(spark, staging, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long"), staging).collect()
    want = reached({n for e in edges for n in e}, edges)
    assert {r["node"]: r["component"] for r in found} == {n: c for n, c in want.items() if n != c}


def test_components_of_nothing(spark, staging):
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"), staging).count() == 0


def word_sets(text, size):
    words = re.findall(WORD, (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_jaccard(rows, size, percent):
    sets = [(i, word_sets(t, size)) for i, t in rows]
    links = [(i, j) for x, (i, a) in enumerate(sets) for j, b in sets[:x] if a and b and 100 * len(a & b) >= percent * len(a | b)]
    return reached({i for i, _ in rows}, links)


def near_copies(seed):
    """Texts of many lengths with chains of small changes, shared passages and exact copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(60))
    passage = [word() for _ in range(30)]
    texts = []
    for length in (1, 2, 3, 4, 9, 20, 45, 100, 300, 900):
        for _ in range(3):
            own = [word() for _ in range(length)]
            for _ in range(6):
                texts.append(" ".join(own))
                own = list(own)
                for _ in range(max(1, length // rng.choice([20, 60, 150]))):
                    own[rng.randrange(len(own))] = word()
        texts.append(" ".join(passage + [word() for _ in range(length)]))
    rng.shuffle(texts)
    return texts + [texts[0].upper(), texts[1] + " \n", "", None, " \t"]


@pytest.mark.parametrize("size, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_jaccard_against_brute_force(spark, staging, documents, size, percent, seed):
    rows = list(enumerate(near_copies(seed)))
    found = jaccard.JaccardJoin(documents(rows), staging, size, percent).result().collect()
    assert {r["doc"]: r["component"] for r in found} == brute_jaccard(rows, size, percent)
    assert {r["doc"]: r["n_shingles"] for r in found} == {i: len(word_sets(t, size)) for i, t in rows}


def test_jaccard_repeated_and_null_ids(spark, staging, documents):
    base = [f"w{i}" for i in range(40)]
    a, b, c = " ".join(base), " ".join(base[:-1] + ["x"]), "quite another text that is not like it"
    rows = [(4, a), (4, c), (4, a), (9, b), (7, c), (None, "only here"), (12, "only  HERE"), (20, "")]
    found = jaccard.JaccardJoin(documents(rows), staging, 3, 90).result().collect()
    assert len(found) == len(rows)
    missing = jaccard.SMALLEST_ID
    assert {(r["doc"], r["component"]) for r in found} == {(4, 4), (9, 4), (7, 4), (missing, missing), (12, missing), (20, 20)}
    assert jaccard.JaccardJoin(documents([]), staging).result().count() == 0


def test_many_resembling_texts_are_not_compared_pair_by_pair(spark, staging, documents, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(240):
        own = list(base)
        for at in rng.sample(range(200), 3 + i % 2):
            own[at] = f"own{i}x{at}"
        rows.append((i, " ".join(own)))
    tried = []
    plain = jaccard.JaccardJoin._verified
    monkeypatch.setattr(jaccard.JaccardJoin, "_verified", lambda self, pairs: tried.append(pairs.count()) or plain(self, pairs))
    found = jaccard.JaccardJoin(documents(rows), staging, 5, 80).result().collect()
    assert {r["doc"]: r["component"] for r in found} == brute_jaccard(rows, 5, 80)
    assert sum(tried) < 10 * len(rows)


def test_keep_one(spark, staging, documents):
    base = " ".join(f"w{i}" for i in range(60))
    docs = documents([(3, base + " z"), (1, base), (2, base.upper()), (5, "else"), (6, None), (7, None), (8, "")])
    kept = jaccard.keep_one(docs, staging)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5, 6, 7, 8]


def test_no_similar_pair_escapes_the_chunks():
    rng = np.random.default_rng(1)
    seen = 0
    for percent in (90, 80, 60):
        for _ in range(1500):
            n = int(math.exp(rng.uniform(0, 7)))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            d = int(rng.integers(0, max(1, jaccard.most_different(n, percent)) + 1))
            drop = int(rng.integers(0, d + 1))
            b = np.unique(np.concatenate([a[rng.permutation(n)[min(drop, n) :]], rng.integers(0, 1 << 63, d - drop, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if not len(b) or 100 * common < percent * (len(a) + len(b) - common):
                continue
            seen += 1
            assert len(np.intersect1d(jaccard.sketch_keys(a, percent), jaccard.sketch_keys(b, percent)))
            x, y = sorted((jaccard.parity_sketch(a), jaccard.parity_sketch(b)), key=len)
            assert len(y) <= 2 * len(x)
            folded = y if len(y) == len(x) else y[: len(x)] ^ y[len(x) :]
            assert np.bitwise_count(x ^ folded).sum() <= len(a) + len(b) - 2 * common
    assert seen > 2000


def test_unrelated_sets_publish_no_common_chunk():
    rng = np.random.default_rng(2)
    for n in (10, 40, 200):
        keys = [np.unique(jaccard.sketch_keys(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)), 80)) for _ in range(500)]
        assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))


def embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.selectExpr("*", "1 as id", "2 as v", "3 as h", "'x' as row", "4 as w", "5 as asks", "6 as rank", "7 as score")


def odd_vectors(dim):
    nothing = [None] + [0.5] * (dim - 1)
    return [(9001, None, 1), (9002, [0.0] * dim, 1), (9003, nothing, 1), (9004, [float("nan")] * dim, 1), (9005, [float("inf")] + [0.1] * (dim - 1), 1),
            (9006, [1.0, 2.0], 1), (9007, [], 1), (None, [0.1] * dim, 1)]


def clustered(seed, dim=16):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c in range(40):
        center = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 12))):
            noise = rng.choice([0, 0.02, 0.05, 0.12])
            rows.append((i, (center * rng.uniform(0.5, 3) + noise * rng.normal(size=dim)).astype(np.float32).tolist(), int(c % 3) if i % 11 else None))
            i += 1
    return rows


def brute_links(rows, threshold=0.98):
    good = [(i, np.array(v, float), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == len(rows[0][1])]
    unit = {k: v / np.linalg.norm(v) for k, (_, v, _) in enumerate(good)}
    links = [(a, b) for a in unit for b in unit if a < b and good[a][2] == good[b][2] and unit[a] @ unit[b] >= threshold]
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[good[a][0]] += 1
        count[good[b][0]] += 1
    return count, reached([i for i, _, _ in rows if i is not None], [(good[a][0], good[b][0]) for a, b in links])


@pytest.mark.parametrize("block", [1024, 3])
def test_near_vectors_against_brute_force(spark, staging, block):
    rows = clustered(1) + [(1000 + i, clustered(1)[0][1], 0) for i in range(9)] + odd_vectors(16)
    found = itq.near_duplicates(spark, embeddings(spark, rows), staging, block=block).select("row.vec_id", "n_links", "component").collect()
    count, root = brute_links(rows)
    assert len(found) == len(rows)
    assert {r["vec_id"]: r["n_links"] for r in found} == count
    assert {r["vec_id"]: r["component"] for r in found if r["vec_id"] is not None} == root
    assert sum(count.values()) > 200


def test_near_vectors_of_nothing(spark, staging):
    assert itq.near_duplicates(spark, embeddings(spark, []), staging).count() == 0
    found = itq.near_duplicates(spark, embeddings(spark, odd_vectors(4)[:5]), staging).select("n_links").collect()
    assert [r["n_links"] for r in found] == [0] * 5


def test_codes_are_balanced_and_near_vectors_agree():
    rng = np.random.default_rng(2)
    data = itq.units_of(pd.Series(list(rng.normal(size=(4000, 64)))))
    tables = itq.Tables(data)
    other = rng.normal(size=data.shape)
    other -= (other * data).sum(axis=1, keepdims=True) * data
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    near = 0.98 * data + math.sqrt(1 - 0.98**2) * other
    assert (tables.keys(data) == tables.keys(near)).any(axis=1).mean() > 0.99
    ones = ((data - tables.center) @ tables.planes >= 0).mean(axis=0)
    assert np.abs(ones - 0.5).max() < 0.1


def test_hilbert_neighbours_touch():
    for axes, bits in ((2, 3), (3, 2), (4, 1)):
        cells = np.stack(np.meshgrid(*[range(1 << bits)] * axes), -1).reshape(-1, axes)
        place = ann.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def brute_nearest(rows, k):
    dim = len(rows[0][1])
    good = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == dim}
    return {q: sorted(((-float(np.dot(good[q], v)), i) for i, v in good.items() if i != q))[:k] for q in good if q % 20 == 0}


def answers(spark, staging, rows, k, **options):
    from pyspark.sql import functions as F

    found = {}
    for r in ann.nearest(spark, embeddings(spark, rows), F.col("id") % 20 == 0, staging, k, **options).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    return found


@pytest.mark.parametrize("options", [{}, {"blocks": 4, "least": 16, "task": 8}])
def test_nearest_against_brute_force(spark, staging, options):
    rows = clustered(3) + [(1000 + i, clustered(3)[0][1], 0) for i in range(30)] + odd_vectors(16) + clustered(3)[:5]
    want = brute_nearest(rows, 10)
    found = answers(spark, staging, rows, 10, **options)
    assert found.keys() == want.keys()
    hits = 0
    for q, best in found.items():
        assert [r for r, _, _ in best] == list(range(1, 11)) and q not in [i for _, i, _ in best]
        assert [s for _, _, s in best] == sorted((s for _, _, s in best), reverse=True)
        hits += len({i for _, i, _ in best} & {i for _, i in want[q]})
        if not options:
            assert [i for _, i, _ in best] == [i for _, i in want[q]]
            assert [s for _, _, s in best] == pytest.approx([-m for m, _ in want[q]])
    assert hits >= 0.9 * 10 * len(want)


def test_few_candidates(spark, staging):
    assert answers(spark, staging, [], 20) == {}
    assert answers(spark, staging, [(20, [1.0, 0.0], None)], 20) == {}
    found = answers(spark, staging, [(20, [1.0, 0.0], None), (3, [0.5, 1.0], 1), (2, [0.5, 1.0], 1), (40, [-1.0, 0.0], 1)], 20)
    assert found == {20: [(1, 2, 0.5), (2, 3, 0.5), (3, 40, -1.0)], 40: [(1, 2, -0.5), (2, 3, -0.5), (3, 20, -1.0)]}


def test_recall_on_vectors_without_structure(spark, staging):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(9000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(vectors)]
    found = answers(spark, staging, rows, 20)
    matrix = np.array([r[1] for r in rows], float)
    scores = matrix[::20] @ matrix.T
    scores[np.arange(len(scores)), np.arange(0, 9000, 20)] = -9
    best = np.argsort(-scores, axis=1)[:, :20]
    recall = np.mean([len(set(best[q // 20]) & {i for _, i, _ in a}) / 20 for q, a in found.items()])
    assert len(found) == 450 and recall > 0.9


def test_recall_with_heavy_tailed_lengths(spark, staging):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(300, 32))
    vectors = centers[rng.integers(0, 300, 9000)] + 0.4 * rng.normal(size=(9000, 32))
    vectors *= (rng.uniform(0.8, 1.2, size=9000) / np.linalg.norm(vectors, axis=1))[:, None]
    vectors[1] *= 1000
    vectors[2:30] *= 30
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    asking = [r for r in rows if r[0] % 200 == 0]
    found = {}
    for r in ann.nearest(spark, embeddings(spark, rows), F.col("id") % 200 == 0, staging, 60).collect():
        found.setdefault(r["query_id"], set()).add(r["id"])
    matrix = np.array([np.float32(r[1]) for r in rows], float)
    hits = []
    for q, _, _ in asking:
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-scores)[:60].tolist())) / 60)
    assert len(hits) == 45 and np.mean(hits) > 0.9


@pytest.mark.parametrize("dim, mean", [(16, 0.0), (24, 0.0), (64, 0.9)])
def test_threshold_pairs_meet_at_any_length_and_mean(dim, mean):
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    data = unit(math.sqrt(mean) * unit(rng.normal(size=(1, dim))) + math.sqrt(1 - mean) * unit(rng.normal(size=(4000, dim))))
    tables = itq.Tables(data)
    away = rng.normal(size=data.shape)
    away = unit(away - (away * data).sum(axis=1, keepdims=True) * data)
    near = 0.98 * data + math.sqrt(1 - 0.98**2) * away
    assert (tables.keys(data) == tables.keys(near)).any(axis=1).mean() > 0.99


def test_ties_at_the_cut_go_to_the_smallest_ids():
    rng = np.random.default_rng(7)
    ids = rng.permutation(400)
    group = pd.DataFrame({"id": [*ids, 900, 901], "query": [False] * 400 + [True] * 2, "v": [[1.0, float(i)] if i < 397 else [2.0, float(i)] for i in ids] + [[1.0, 0.0]] * 2})
    found = ann._search(group, 21)
    for asker in (900, 901):
        assert sorted(found[found["asker"] == asker]["id"]) == [*range(18), 397, 398, 399]
