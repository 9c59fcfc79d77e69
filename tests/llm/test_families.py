"""The near-duplicate stage on groups of sets that nearly link: rows stay in proportion to the sets, links are all found."""

import random

import numpy as np
import pytest
from gridloom.llm import similar
from test_advice import docs, edited_corpus, plain_groups, words


def arrow_step_rows(spark, last=-1):
    """Highest execution id, most rows that a MapInArrow after execution `last` has made."""
    store, most, newest = spark._jsparkSession.sharedState().statusStore(), 0, last
    every = store.executionsList()
    for e in (every.apply(i).executionId() for i in range(every.size())):
        if e <= last:
            continue
        newest, values, nodes = max(newest, e), store.executionMetrics(e), store.planGraph(e).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            for metric in (node.metrics().apply(i) for i in range(node.metrics().size() if node.name() == "MapInArrow" else 0)):
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    most = max(most, int(values.apply(metric.accumulatorId()).replace(",", "")))
    return newest, most


def nearly_alike(rng, copies, changed=5, length=400):
    """Texts of one pattern whose shingle sets have similarities about 0.78, some of which links join."""
    base, texts = words(rng, length), []
    for i in range(copies):
        copy = list(base)
        for at in rng.sample(range(6, length - 6, 6), changed - i % 2):
            copy[at] = f"own{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    return texts


def test_pairs_of_a_group_are_not_rows(spark):
    texts = nearly_alike(random.Random(5), 60)
    last, _ = arrow_step_rows(spark)
    rows = similar.similar_components(docs(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(plain_groups(texts)))
    _, most = arrow_step_rows(spark, last)
    sets = sum(len(similar.shingle_set(t.encode())) for t in texts)
    assert 0 < most <= sets  # no step makes more rows than there are shingles


@pytest.mark.parametrize("most", [1, 150, 2_000_000])
def test_families_in_parts_equal_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(similar, "FAMILY_SHINGLES", most)
    texts = edited_corpus() + nearly_alike(random.Random(6), 12)
    rows = similar.similar_components(docs(spark, texts), cell_rows=7).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(plain_groups(texts)))


def test_near_sets_lose_no_link_with_bitmaps_of_any_length(monkeypatch):
    rng = np.random.default_rng(8)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for most_words, least in ((16, 0.8), (256, 0.8), (256, 0.3)):
        monkeypatch.setattr(similar, "MOST_WORDS", most_words)
        base = draw(1500)
        sets = sorted((np.unique(np.concatenate([base[: rng.integers(900, 1500)], draw(int(rng.integers(1, 300)))])) for _ in range(40)), key=len)
        n, ids = np.array([len(s) for s in sets], np.int32), np.arange(40)
        root = ids % 7 * 100
        linked = {(i, j) for i in range(40) for j in range(i + 1, 40) if root[i] != root[j] and similar.similar(sets[i], sets[j], least)}
        near = {(i, int(j)) for i, at in similar._near(n, root, [similar.wide_bitmap(s) for s in sets], least) for j in at}
        named = [set(f) for f in similar._families(ids, root, n, [similar.wide_bitmap(s) for s in sets], least, 3000)]
        assert linked and linked <= near and all(any({i, j} <= f for f in named) for i, j in near)
        joining = list(similar._joining(ids, root, n, sets, least))
        assert set(joining) <= linked and len(joining) < len(set(root.tolist()))
