"""Answers to block questions against plain counting."""

from collections import defaultdict

import numpy as np
import pytest

from sluice.llm.jaccard_join import SET_BLOCK, _labelled_sets
from sluice.llm.shared_tokens import Sets, answers, expand, holders_of, rarest_first, squeeze


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32, np.int64])
def test_squeezed_values_come_back(dtype):
    for n in (0, 1, 1000):
        x = np.random.default_rng(n).integers(0, 200, n).astype(dtype)
        assert (expand(squeeze(x), dtype) == x).all()


@pytest.mark.parametrize("buckets", [1, 8])
def test_tokens_of_two_components(spark, buckets):
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 1 << 63, 60).astype(np.uint64) * np.uint64(2)
    classes = [(rep, rep // 3, np.unique(rng.choice(tokens, 12))) for rep in range(24)]
    held = defaultdict(set)
    for _, comp, keys in classes:
        for k in keys.tolist():
            held[k].add(comp)
    rows = []
    for number, part in enumerate((classes[:7], classes[7:8], classes[8:])):
        cols = [np.array([c[i] for c in part], np.int64).tobytes() for i in (0, 1)]
        lens = np.array([len(c[2]) for c in part], np.uint32).tobytes()
        keys = np.concatenate([c[2] for c in part])
        rows.append((number, *cols, lens, lens, keys.tobytes(), len(keys)))
    blocks = spark.createDataFrame(rows, SET_BLOCK)
    replies = answers(blocks, _labelled_sets, buckets).collect()
    for row in rows:
        sets = _labelled_sets(dict(zip((c.split()[0] for c in SET_BLOCK.split(", ")), row)))
        got = holders_of(sets, [(r.bucket, r.codes) for r in replies if r.block == row[0]], buckets)
        assert [g > 0 for g in got.tolist()] == [len(held[k]) > 1 for k in sets.keys.tolist()]


def test_rarest_first_keeps_classes_with_enough():
    sets = Sets(np.array([5, 6, 7, 5, 8], np.uint64), np.array([3, 2]))
    good, found = rarest_first(sets, np.array([16, 0, 8, 16, 0], np.uint8), np.array([2, 2]))
    assert good.tolist() == [True, False]
    assert [np.frombuffer(f, np.uint64).tolist() for f in found] == [[7, 5]]


def test_no_tokens():
    none = Sets(np.empty(0, np.uint64), np.empty(0, np.int64))
    assert len(holders_of(none, [], 4)) == 0
    assert rarest_first(none, np.empty(0, np.uint8), np.empty(0, np.int64))[1] == []
