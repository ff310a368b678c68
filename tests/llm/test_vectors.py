"""Centroid clusters, vector codes and SimHash groups against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import brute
from plumbline.llm import simhash, vectors
from plumbline.llm.centroid_clusters import Tournament, cluster_vectors
from plumbline.llm.joins import spread_join
from plumbline.llm.vector_codes import Codebook, code_vectors

VECTORS = "vec_id long, embedding array<double>, label int, cluster string, error double, row int"


def fits(n):
    return n if n <= vectors.LONGEST else None


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(row, points):
    return min((gap(row, p), i) for i, p in enumerate(points))


def means(points, rows, chosen):
    out = []
    for i, p in enumerate(points):
        own = [r for r, c in zip(rows, chosen) if c == i]
        out.append([sum(c) // len(own) for c in zip(*own)] if own else p)
    return out


def clusters(rows, k, rounds, scale):
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), rows[i][1]))
    points = [whole[i] for i in order[:k]]
    for _ in range(rounds):
        points = means(points, whole, [nearest(r, points)[1] for r in whole])
    found = [nearest(r, points) for r in whole]
    total = sum(d for d, _ in found)
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    by_cluster = [sum(d for d, o in found if o == c) for c in range(k)]
    rows = [(i, c, fits(d), fits(by_cluster[c]), fits(total), digest[c]) for (i, _), (d, c) in zip(rows, found)]
    return sorted(rows, key=lambda r: r[:2])


def codes(rows, parts, entries, rounds, scale):
    whole = [[math.floor(scale * x) for x in v] for _, v, _ in rows]
    dims = len(whole[0]) // parts
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1]))[:entries]
    out, books = [["", 0] for _ in rows], []
    for p in range(parts):
        own = [w[p * dims : (p + 1) * dims] for w in whole]
        points = [own[i] for i in order]
        for _ in range(rounds):
            points = means(points, own, [nearest(r, points)[1] for r in own])
        books += points
        for o, r in zip(out, own):
            d, e = nearest(r, points)
            o[0] += f"{e:02x}"
            o[1] += d
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b).encode()).hexdigest()
    by_label = {}
    for (_, _, label), (_, error) in zip(rows, out):
        by_label[label] = by_label.get(label, 0) + error
    return sorted(((i, c, fits(e), fits(by_label[label]), digest) for (i, _, label), (c, e) in zip(rows, out)), key=lambda r: r[:2])


def some_vectors(seed, n, width, values):
    rng = random.Random(seed)
    rows = [(i, [rng.choice(values) * rng.choice([1.0, 0.5, -0.3]) for _ in range(width)]) for i in range(n)]
    # Copies of one vector, a repeated row and ties.
    return rows + [(n + i, list(rows[0][1])) for i in range(n)] + [rows[1], (2 * n, [0.0] * width)]


def spoiled(width):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None] * width, [nan] * width, [inf] * width, [1.0] * (width - 1) + [None]]
    return [(900 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("values", [(0.1, 0.3, 0.31), (0.2, 1e9), (0.1, 1e30), (1e300, 0.5)])
def test_clusters_equal_brute_force(spark, values):
    rows = some_vectors(1, 60, 6, values)
    df = spark.createDataFrame([(i, v, None, "c", 0.0, 7) for i, v in rows + spoiled(6)], VECTORS).repartition(5)
    found = cluster_vectors(df, clusters=5, rounds=3, width=6, carry=["vec_id"])

    expected = clusters(rows, 5, 3, 64)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == expected


@pytest.mark.parametrize("values", [(0.1, 0.3, 0.31), (0.2, 1e5), (0.2, 1e9)])
def test_codes_equal_brute_force(spark, values):
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in some_vectors(2, 90, 8, values)]
    bad = [(i, v, 1, "c", 0.0, 7) for i, v in spoiled(8)]
    df = spark.createDataFrame([(*r, "c", 0.0, 7) for r in rows] + bad, VECTORS).repartition(5)
    found = code_vectors(df, parts=4, entries=70, rounds=2, carry=["vec_id"])
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == codes(rows, 4, 70, 2, 256)


def test_vectors_keep_other_columns(spark):
    rows = [(1, [0.5] * 4, 3, "c", 0.1, 7), (None, [0.25] * 4, None, None, None, None)]
    df = spark.createDataFrame(rows, VECTORS)
    found = cluster_vectors(df, clusters=4, width=4).orderBy("distance", "row").collect()
    assert [(r.vec_id, r.row, r.error, r.cluster) for r in found] == [(None, None, None, 1), (1, 7, 0.1, 0)]
    coded = code_vectors(df, parts=2, entries=4).orderBy("code").collect()
    assert [(r.vec_id, r.code, r.cluster, r.row, r.label_error) for r in coded] == [(1, "0000", "c", 7, 0), (None, "0101", None, None, 0)]
    empty = df.limit(0)
    assert cluster_vectors(empty).count() == 0 and code_vectors(empty).count() == 0
    assert code_vectors(df.filter("vec_id = 9")).columns[-4:] == ["code", "error", "label_error", "codebooks_sha256"]


def test_rows_on_a_bisector_stay_with_the_smaller_number():
    t = Tournament([[2, 0], [0, 0], [0, 0], [-2, 0]], 2)
    cluster, distance = t.nearest(np.array([[1, 5], [0, 0], [-1, 0], [-2, 0]]))
    assert cluster.tolist() == [0, 1, 1, 3] and distance.tolist() == [26, 0, 1, 0]


def test_masks_hold_every_nearest_entry():
    rng = np.random.default_rng(0)
    for n in (1, 2, 63, 64, 65, 200):
        entries = rng.integers(-9, 9, (n, 3)).tolist()
        rows = rng.integers(-12, 12, (300, 3))
        entry, distance = Codebook(entries, 3).nearest(rows)
        expected = [nearest(r, entries) for r in rows.tolist()]
        assert list(zip(distance.tolist(), entry.tolist())) == expected


def fingerprint(text):
    words = brute.spaced_words(text)
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)] if n else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, most):
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def test_simhash_groups_equal_brute_force(spark, docs_of):
    rng = random.Random(5)
    words = [f"w{i}é" for i in range(200)]
    texts = [None, "", " \t\n", "One", "one", "one TWO\x0bthree", "one two\xa0three", "a\x85b c d e"]
    for _ in range(30):
        base = rng.choices(words, k=rng.choice([4, 40, 400]))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts.append(" ".join(rng.choices(words, k=150_000)))
    found = simhash.simhash_groups(docs_of(texts)).orderBy("doc_id").collect()
    prints = [fingerprint(t) for t in texts]
    assert [r.fingerprint for r in found] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in found] == groups_of(prints, 3)


@pytest.mark.parametrize("most", [0, 1, 3, 5, 7])
def test_chains_lose_no_pair(spark, most):
    """Fingerprints at every distance, crowded ones among them, in blocks of few."""
    rng = random.Random(most)
    prints = {0}
    for _ in range(25):
        base = rng.getrandbits(64)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most + 2))) for _ in range(4)}
    prints |= {sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "node long"), most, block=4, broadcast_rows=8).collect()
    group = {s[0]: i for i, s in enumerate(signed)}
    names = list(range(len(prints)))
    for a, b in found:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= most
        low, high = sorted((names[group[a]], names[group[b]]))
        names = [low if g == high else g for g in names]
    assert names == groups_of(prints, most)


def test_links_of_a_crowded_key_are_few(spark):
    """Two thousand fingerprints, all near each other, give links linear in their number."""
    near = [(1 << a | 1 << b,) for a in range(63) for b in range(a)]
    edges = simhash.links(spark.createDataFrame(near, "node long"), 3, block=256)
    assert edges.count() < 2 * simhash.SEGMENTS * len(near) * (len(near) // 256 + 1)


def test_simhash_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "x y z"), (4, "x y z"), (4, "x y z"), (None, "p q r s t")], "doc_id long, text string")
    found = simhash.simhash_groups(docs)
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in found.collect()) == [(-1, -1), (-1, 4), (4, 4), (4, 4)]
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="most"):
        simhash.simhash_groups(docs, most=8)


def test_spread_join_beyond_the_broadcast(spark):
    rows = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(100)], "k long, v long")
    counts = rows.groupBy("k").agg(F.count("*").alias("copies"), F.lit(2).alias("twice"))
    for frequent in (2, 100):
        for local in (True, False):
            found = spread_join(rows, counts, "k", "copies", frequent, local)
            assert found.count() == 100 and found.filter("twice <> 2 OR twice IS NULL").count() == 0
            some = spread_join(rows, counts.filter("k > 2"), "k", "copies", frequent, local)
            assert some.count() == 100 and some.filter("(twice IS NULL) = coalesce(k > 2, false)").count() == 0
