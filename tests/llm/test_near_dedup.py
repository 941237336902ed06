import random
import re
from itertools import combinations

import numpy as np
import pytest

from llm.conftest import prose
from quarterwise.llm import near_dedup
from quarterwise.llm.components import components, roots


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)] if words else [])


def brute(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in combinations(range(len(rows)), 2):
        (i, a), (j, b) = sets[x], sets[y]
        if a and b and (100 * len(a & b) >= 80 * len(a | b) or (i is not None and i == j)):
            parent[find(y)] = find(x)
    out = []
    for x, (i, s) in enumerate(sets):
        ids = [sets[y][0] for y in range(len(rows)) if find(y) == find(x) and sets[y][0] is not None]
        c = min(ids, default=None) if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=repr)


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(10**6)}" if draw.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def rows():
    out, base = [], [prose(120, k) for k in range(6)]
    for k in range(240):
        out.append((1000 - 3 * k, edited(base[k % 6], [0, 0.02, 0.04, 0.06, 0.1, 0.3][k % 5], k)))
    passage = prose(60, 99)
    out += [(2000 + k, f"{prose(50, 500 + k)} {passage} {prose(30, 700 + k)}") for k in range(60)]
    out += [(3000, "one"), (3001, "ONE"), (3002, "one two"), (3003, ""), (3004, None), (3005, " \n")]
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components_are_those_of_all_pairs(docs_of, rows, k):
    got = near_dedup.near_copies(docs_of(rows), shingle=k).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, k)


def test_leftover_components_are_joined_block_by_block(docs_of, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "ORDERS", 1)
    got = near_dedup.near_copies(docs_of(rows), shingle=2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 2)


def test_one_of_each_component_stays(docs_of, rows):
    kept = {r.doc_id for r in near_dedup.without_near_copies(docs_of(rows)).collect()}
    assert kept == {i for i, n, c, keep in brute(rows, 5) if keep or not n}


def test_rows_without_ids_leave_one_of_each_component(docs_of):
    body = prose(150, 1)
    near = [body, *(" ".join(f"new{at}" if k == at else w for k, w in enumerate(body.split())) for at in (10, 50))]
    alone = prose(150, 2)
    kept = near_dedup.without_near_copies(docs_of([(None, t) for t in near] + [(None, alone), (None, None), (None, "")])).collect()
    assert len(kept) == 4 and sum(r.text in near for r in kept) == 1
    named = near_dedup.without_near_copies(docs_of([(None, near[0]), (9, near[1]), (None, near[2]), (4, near[0] + " more")])).collect()
    assert [r.doc_id for r in named] == [4]
    same_id = near_dedup.without_near_copies(docs_of([(4, near[0]), (4, near[1])])).collect()
    assert len(same_id) == 1


def test_a_linked_family_costs_no_rows_after_its_first_tables(spark, docs_of, monkeypatch):
    body, made = prose(200, 5), []
    counted = near_dedup.buckets

    def buckets(nodes, keys):
        out = counted(nodes, keys)
        made.append((keys, out.count()))
        return out

    monkeypatch.setattr(near_dedup, "buckets", buckets)
    sizes = {}
    for n in (50, 200):
        made.clear()
        got = near_dedup.near_copies(docs_of([(k, edited(body, 0.005, k)) for k in range(n)])).collect()
        assert {r.component_id for r in got} == {0}
        sizes[n] = dict(made)
    few, every = (([s[k] for s in sizes.values()]) for k in (near_dedup.FEW, near_dedup.KEYS))
    # the first tables cost rows in proportion; afterwards a bucket holds one row of the family and one of each node outside it
    assert few[1] <= 200 * near_dedup.FEW**2 and few[1] <= 8 * few[0] and every[1] <= 8 * max(every[0], 100)


def test_nodes_that_stars_leave_open_are_rows_of_keys_not_of_buckets(spark, docs_of, rows, monkeypatch):
    made, opened = {}, near_dedup.open_members

    def open_members(spots, named):
        out = opened(spots, named)
        made["members"], made["spots"] = out.count(), spots.count()
        # every component that is left of a bucket with several is there with the node that it had in it
        now = dict(named.select("node", "component").collect())
        left = {}
        for r in spots.collect():
            left.setdefault(r.bucket, set()).add((r.node, now[r.component]))
        want = {node for ends in left.values() if len({c for _, c in ends}) > 1 for node, _ in ends}
        assert want and want <= {r.node for r in out.collect()}
        return out

    monkeypatch.setattr(near_dedup, "open_members", open_members)
    got = near_dedup.near_copies(docs_of(rows), shingle=2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 2)
    assert 0 < made["members"] < made["spots"]


def test_a_bucket_is_joined_once_and_brings_its_pivot(spark):
    nodes = spark.createDataFrame([(k, k, 10 + k, [1, 2], [3, 4]) for k in range(6)], "node bigint, component bigint, size bigint, first array<bigint>, second array<int>")
    got = near_dedup.buckets(nodes, 2)
    rows = got.collect()
    assert len(rows) == 6 and len({r.pivot for r in rows}) == 1 and rows[0].pivot.node in range(6) and rows[0].pivot.size == 10 + rows[0].pivot.node


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    from quarterwise.llm import components as module

    done = []
    monkeypatch.setattr(module, "_round", lambda links, of=module._round: done.append(1) or of(links))
    stars = spark.createDataFrame([(5, 1), (6, 1), (9, 2)], "a bigint, b bigint")
    assert dict(components(stars).collect()) == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2} and not done
    assert dict(components(stars.union(stars.sparkSession.createDataFrame([(9, 6)], "a bigint, b bigint"))).collect()) == dict.fromkeys([1, 2, 5, 6, 9], 1) and done


def test_roots_of_stars_are_their_links_without_another_shuffle(spark):
    out = roots(spark.createDataFrame([(1, 5), (6, 5), (2, 9), (9, 2), (4, 4)], "a bigint, b bigint"))
    assert sorted(map(tuple, out.collect())) == [(5, 1), (6, 1), (9, 2)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_messy_rows(messy, no_docs):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    got = near_dedup.near_copies(messy).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 5)
    kept = near_dedup.without_near_copies(messy)
    assert kept.columns == messy.columns and {r.node for r in kept.collect()} == {"kept"}
    assert near_dedup.near_copies(no_docs).count() == near_dedup.without_near_copies(no_docs).count() == 0


def test_intersections_of_blocks():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 9000, draw.integers(0, 7000)).astype(np.uint64)) for _ in range(9)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = near_dedup._intersections(np.concatenate(sets), first, 4)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 30)] + [(29, 5), (300, 300), (-4, 200)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {**{k: 100 for k in range(100, 141)}, **{k: 5 for k in [5, 7, *range(8, 30)]}, -4: -4, 200: -4}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
