"""The last comparison of near-duplicates in blocks and pieces of bounded bytes."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tallyroom.llm import setsketch
from test_corpus import DOCS, brute_components, prose


def meeting(rng, p, q, n, most):
    part = rng.integers(p, p + 1, n) if p == q else rng.choice([p, q], n)
    columns = {"band": np.zeros(n, np.int32), "bucket": np.full(n, 7), "p": np.full(n, p, np.int32),
               "q": np.full(n, q, np.int32), "part": part.astype(np.int32), "node": rng.permutation(n),
               "component": np.arange(n), "size": rng.integers(1, most, n)}
    registers = [rng.integers(0, 9, setsketch.REGISTERS).astype(np.uint16).tobytes() for _ in range(n)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), pa.array(registers)],
                                      names=[*columns, "registers"])


@pytest.mark.parametrize("p,q", [(0, 0), (2, 2), (0, 1), (3, 40_000)])
@pytest.mark.parametrize("limit", [1, 300, 2000, 10**9])
def test_each_two_chosen_rows_that_met_meet_once_in_bounded_bytes(p, q, limit):
    rng = np.random.default_rng(p + q + limit)
    met = setsketch._Meeting(meeting(rng, p, q, 40, 60))
    chosen = rng.random(40) < 0.7
    expected = {frozenset(x) for x in combinations(np.flatnonzero(chosen).tolist(), 2)
                if p == q or met.part[x[0]] != met.part[x[1]]}
    seen = []
    for rows, new_p, new_q, part in met.cut(chosen, limit):
        assert set(part.tolist()) <= {new_p, new_q} and chosen[rows].all()
        left, right = rows[part == new_p].tolist(), rows[part == new_q].tolist()
        for side in (left, right):
            assert 8 * (met.size[side].sum() - met.size[side].max(initial=0)) <= limit
        seen += ([frozenset(x) for x in combinations(left, 2)] if new_p == new_q
                 else [frozenset((a, b)) for a in left for b in right])
    assert len(seen) == len(set(seen)) and set(seen) == expected


@pytest.mark.parametrize("block,set_bytes", [(2048, 3000), (8, 3000), (8, 1)])
def test_components_do_not_depend_on_blocks_and_pieces(spark, monkeypatch, block, set_bytes):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "SET_BYTES", set_bytes)
    rng, texts = random.Random(8), []
    for g in range(3):
        words = prose(2000 + g, 300).split()
        for _ in range(25):
            own = list(words)
            for _ in range(rng.choice([2, 8, 9, 10, 11, 12])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts.append((len(texts), " ".join(own)))
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in texts], DOCS)
    _, label = brute_components(texts, 4, 80)
    assert 3 < len(set(label.values())) < 70
    got = setsketch.near_duplicates(docs, width=4).collect()
    assert {r["id"]: r["component_id"] for r in got} == label
