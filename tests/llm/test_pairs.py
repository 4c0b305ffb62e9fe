"""Near-duplicates, repeated passages and nearest neighbours against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.llm import ann, neardup, repeats


# -- near-duplicates -----------------------------------------------------------------


def plain_components(rows, words=5, percent=85):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        runs = [tuple(w)] if 0 < len(w) < words else list(zip(*[w[k:] for k in range(words)]))
        sets[i] = set(runs)
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_texts(seed):
    """Groups of copies and edited copies of short and long texts, chains, shared passages."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcde") for _ in range(draw.randint(1, 5)))
    passage = [word() for _ in range(80)]
    out = []
    for size in (3, 5, 30, 150, 180, 260, 600):
        base = [word() for _ in range(size)]
        if draw.random() < 0.6:
            base = passage + base
        chain = list(base)
        for step in range(12):
            text = list(base)
            for _ in range(draw.randint(0, 1 + size // 40)):
                text[draw.randrange(len(text))] = word()
            out.append(" ".join(text))
            chain[draw.randrange(len(chain))] = word()
            out.append("  ".join(chain).upper() if step % 3 == 0 else " ".join(chain))
    out += [" ".join(passage), "", " ", "A b", "a  B", "a b c"]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = list(enumerate(near_texts(seed), 10))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 20  # the texts do form groups


def test_a_large_group_costs_links_not_pairs(spark):
    base = " ".join(f"w{i}" for i in range(150))
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit(base), F.lit(" x"), F.col("id") % 300).alias("text"))
    got = neardup.near_duplicates(docs).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in neardup.components(edges).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 101: 100}


def test_near_duplicates_of_odd_and_no_documents(odd_documents, no_documents):
    rows = neardup.near_duplicates(odd_documents).collect()
    assert len(rows) == 11
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[3]["kept"]
    assert by[5]["component_id"] == 4 and not by[5]["kept"] and by[7]["component_id"] == 6
    assert by[None]["kept"] and by[None]["component_id"] is None
    kept = neardup.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == 9
    assert neardup.near_duplicates(no_documents).count() == 0


# -- repeated passages ---------------------------------------------------------------


def plain_removal(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - window + 1):
            part = data[p : p + window]
            if part in seen:
                gone[p : p + window] = True
            seen.add(part)
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("hot", [100_000, 2])
def test_removal_equals_brute_force(spark, hot):
    draw = random.Random(5)
    text = lambda n: "".join(draw.choice("abé \n") for _ in range(n))
    passages = [text(n) for n in (90, 99, 100, 101, 150, 400)]
    rows = []
    for i in range(120):
        parts = [text(draw.randint(0, 200))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            cut = draw.randint(0, 20)
            parts += [p[cut:] if draw.random() < 0.3 else p, text(draw.choice([0, 1, 50]))]
        rows.append((i * 3, "".join(parts)))
    rows += [(1000, "z" * 500), (1001, "z" * 99), (1002, rows[7][1]), (1003, "ab" * 300), (1004, None), (1005, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.digest(repeats.without_repeats(docs, repeats.Repeats(hot=hot))).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == plain_removal(rows, 100)


def test_every_window_has_one_anchor_and_equal_windows_equal_ones():
    how = repeats.Repeats()
    data = np.frombuffer(random.Random(1).randbytes(3_000_000), np.uint8)
    at, first, last, _ = repeats.anchors(data, how)
    assert (np.diff(np.unique(np.c_[first, last], axis=0).ravel()) >= 0).all()
    assert (last - first + 1).sum() == len(data) - how.window + 1
    assert ((at >= last) & (at - first <= how.reach)).all()
    again, f, l, _ = repeats.anchors(np.r_[data[:7777], data], how)
    place = lambda a, f, l, p: int(a[(f <= p) & (p <= l)][0]) - p
    for p in (0, 5, 1_048_400, 1_048_576, 2_500_000):
        assert place(at, first, last, p) == place(again, f, l, p + 7777)


def test_loser_tree_merges_front_coded_runs():
    draw = random.Random(3)
    rows = [(bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 30))), i, 0, 0, 0) for i in range(2000)]
    for count in (0, 1, 2, 3, 7, 16):
        runs = [[] for _ in range(count)]
        for r in rows if count else []:
            runs[draw.randrange(count)].append(r)
        coded = [repeats.front_code(sorted({r[0]: r for r in run}.values())) for run in runs]
        want = sorted(s for run in runs for s in {r[0] for r in run})
        before, got = b"", []
        for same, suffix, _ in repeats.merged(coded):
            assert same == -1 or same == repeats.shared_prefix(before, suffix, 0)
            before = suffix
            got.append(suffix)
        assert got == want


def test_removal_from_odd_and_no_documents(odd_documents, no_documents):
    rows = repeats.without_repeats(odd_documents).collect()
    assert len(rows) == 11 and all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (None, 1, 2, 3, 4))
    long = {r["doc_id"]: r for r in rows}
    assert long[7]["n_removed"] >= long[6]["n_bytes"] - long[6]["n_removed"] - 100
    assert repeats.without_repeats(no_documents).count() == 0


# -- nearest neighbours -------------------------------------------------------------------


def test_recall_ties_and_left_out_vectors(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=16).tolist()) for i in range(1500)]
    rows += [(2000 + i, [1.0] * 16) for i in range(300)]  # one vector many times
    rows += [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [None] * 16), (3400, [1.0, 2.0]), (None, [1.0] * 16), (3500, [])]
    rows += [rows[100]] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    how = ann.Graph(shard_rows=500, block_rows=5)
    got = {}
    for r in ann.nearest_neighbours(df, how=how).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    held = {i: np.array(v) for i, v in rows if i is not None and i not in (3000, 3100, 3200, 3300, 3400, 3500)}
    ids, matrix = np.array(list(held)), np.stack(list(held.values()))
    hits = total = 0
    for q, found in got.items():
        if q == 3400:
            continue
        away = np.sqrt(((matrix - held[q]) ** 2).sum(1))
        away[ids == q] = np.inf
        best = np.lexsort((ids, away))[:10]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        for _, score, i in found:
            assert score == pytest.approx(away[ids == i][0], abs=1e-12)
        hits += len({i for _, _, i in found} & set(ids[best].tolist()))
        total += 10
    assert set(got) == {i for i in held if i % 100 == 0}
    assert hits / total > 0.95
    assert [i for _, _, i in sorted(got[2000])] == list(range(2001, 2011))  # ties to smaller ids
    assert ann.nearest_neighbours(df.limit(0)).count() == 0


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], "vec_id long, embedding array<float>")
    assert [(r["vec_id"], r["score"]) for r in ann.nearest_neighbours(df).orderBy("rank").collect()] == [(1, 1.0), (2, 3.0)]


def test_different_vectors_at_one_distance_go_by_id(spark):
    """Far more tied vectors than the search is wide: signs of one pattern around a query at the origin of their differences."""
    import itertools

    signs = [list(s) for s in itertools.product((-1.0, 1.0), repeat=9)]
    rows = [(101 + i, [*s, 0.0]) for i, s in enumerate(signs)] + [(100, [0.0] * 9 + [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in ann.nearest_neighbours(df).where("query_id = 100").orderBy("rank").collect()]
    assert got == list(range(101, 111))
