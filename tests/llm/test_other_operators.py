"""Chat formatting, exact search and components against brute force."""

import collections
import random

import numpy as np

from riskladder.llm import arrays, chat, kdtree
from riskladder.llm.components import connected_components
from riskladder.llm.queries import ship


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 3, None, "who?"), (1, 3, "ann", ""),
            (2, 0, "system", "alone"), (None, None, "ann", "x"), (3, 0, "u", "a"), (3, 0, "u", "a"), (3, 700, "v", "late")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate_perspectives(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (None, "ann", 0), (3, "u", 0), (3, "v", 0)}
    r = got[(1, "ann", 0)]
    assert r.n_turns == 5 and r.rendered.startswith("<|system|>\nbe kind\n<|end|>\n<|assistant|>\nhi < |end|>\n<|end|>\n<|user|>\nbob: \n")
    assert [r.rendered[m.start:m.end] for m in r.mask] == ["hi < |end|>\n<|end|>\n", "\n<|end|>\n"]
    assert [got[(3, "v", 0)].rendered[m.start:m.end] for m in got[(3, "v", 0)].mask] == ["late\n<|end|>\n"]
    assert got[(3, "u", 0)].n_turns == 3 and len(got[(3, "u", 0)].mask) == 2
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def test_a_conversation_of_any_length_is_cut_into_parts(spark):
    rows = [(None, None, "ann", "same")] * 700 + [(7, k // 3, "bob" if k % 2 else "ann", f"t{k:04d}") for k in range(900)]
    rows += [(8, 5, "eve", "again")] * 300 + [(k, 0, "u", "x") for k in range(20, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = chat.rotate_perspectives(df, part_turns=50).collect()
    sizes = {}
    for r in got:
        sizes.setdefault((r.conv_id, r.perspective), {})[r.part] = r.n_turns
    assert sizes[(None, "ann")] == {k: 50 for k in range(14)} and sizes[(8, "eve")] == {k: 50 for k in range(6)}
    assert sizes[(7, "ann")] == sizes[(7, "bob")] == {k: 50 for k in range(18)}
    order = sorted(range(900), key=lambda k: (k // 3, "bob" if k % 2 else "ann", f"t{k:04d}"))
    whole = "".join(r.rendered for r in sorted((r for r in got if (r.conv_id, r.perspective) == (7, "ann")), key=lambda r: r.part))
    assert [int(x[:4]) for x in whole.replace("<|assistant|>\nt", "\0").replace("bob: t", "\0").split("\0")[1:]] == order


def test_top_k(spark):
    ship(spark)
    r = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in r.normal(0, 0.2, 8)]) for i in range(400)]
    rows += [(20, rows[20][1]), (500, [0.0] * 8), (501, [0.0] * 8), (502, None), (503, [float("nan")] * 8), (None, [1.0] * 8),
             (504, [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]), (505, [float("inf")] * 8), (506, [])]
    rows += [(600 + i, [0.5] * 8) for i in range(40)]       # ties
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    good = [(i, np.floor(64 * np.array(v, float))) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in good:
        if i % 20 == 0:
            best = sorted((-int(q @ v), j) for j, v in good if j != i)[:20]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    for rows_per_shard in (kdtree.SHARD_ROWS, 64):
        kept, kdtree.SHARD_ROWS = kdtree.SHARD_ROWS, rows_per_shard
        try:
            got = kdtree.top_k(df).collect()
        finally:
            kdtree.SHARD_ROWS = kept
        assert sorted(map(tuple, got)) == sorted(want)
    assert kdtree.top_k(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 3), (5, 5)]
    comp = {}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            comp.setdefault(a, a), comp.setdefault(b, b)
            x, y = find(a), find(b)
            comp[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((x, find(x)) for x in comp)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_sketches_cover_all_rows(spark):
    ship(spark)
    df = spark.range(5000).repartition(7)

    def add(cells, batches):
        for b in batches:
            cells += np.bincount(arrays.int64(b.column("id")) % 100, minlength=len(cells)).astype(cells.dtype)

    assert arrays.fold_array(df, add, 100).tolist() == [50] * 100
    bits = arrays.bloom_of(df, "id", 1 << 14)
    assert arrays.bloom_has(bits, np.arange(5000, dtype=np.uint64)).all()
    assert arrays.bloom_has(bits, np.arange(10**6, 10**6 + 1000, dtype=np.uint64)).mean() < 0.3
