"""Suffix order and common prefixes against plain sorting, with little memory too; a shard far larger than its memory."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremill.llm import induced, suffix_dedup


def plainly(text, cap):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0]
    for a, b in zip(order, order[1:], strict=False):
        n = 0
        while text[a + n : a + n + 1] == text[b + n : b + n + 1] and text[a + n] != 0:
            n += 1
        shared.append(min(n, cap))
    return order, shared


def check(text, symbols, cap):
    places, common = induced.sorted_suffixes(np.array(text, np.int32), symbols, cap)
    assert (places.tolist(), common.tolist()) == plainly(text, cap)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([1, 3, 400]), st.integers(1, 7))
def test_random_texts(given_text, cap, times):
    check([*given_text * times, 0], 5, cap)


@pytest.mark.parametrize("block", [1, 3, 64])
@pytest.mark.parametrize("in_memory", [1, 1 << 24])
@pytest.mark.parametrize("direct", [0, 1 << 19])
def test_small_blocks_and_files(monkeypatch, block, in_memory, direct):
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "IN_MEMORY", in_memory)
    monkeypatch.setattr(induced, "DIRECT", direct)
    rng = random.Random(block)
    part = [rng.randint(1, 3) for _ in range(25)]
    check([*part, *part[::-1], *part, 2, 2, 2, 2, 2, 2, *part[3:], 0], 4, 9)
    check([0], 1, 9)
    check([7] * 40 + [0], 8, 400)
    assert isinstance(induced.room(100, np.int32), np.memmap) == (in_memory == 1)


def test_a_shard_on_disk_loses_the_same_bytes(spark, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(700))
    prose = ["".join(rng.choice("ijklmnop ") for _ in range(300)) for _ in range(40)]
    texts = [p + passage[i : 450 + 6 * i] + p[::-1] for i, p in enumerate(prose)]
    docs = spark.createDataFrame(list(enumerate([*texts, None, "", passage[:399]])), "doc_id long, text string")
    regions = suffix_dedup._distinct(suffix_dedup._regions(docs, "text"))
    rows = regions.select(F.lit(0).alias("shard"), "region", "bytes", "copies").toArrow().to_batches()

    def spans():
        return sorted(zip(*(column.to_pylist() for out in suffix_dedup._covered(iter(rows)) for column in out.columns), strict=True))

    whole = spans()
    total = sum(batch.num_rows for batch in rows)
    assert whole and total > 10
    monkeypatch.setattr(induced, "IN_MEMORY", 256)
    monkeypatch.setattr(induced, "BLOCK", 128)
    monkeypatch.setattr(induced, "DIRECT", 16)
    assert spans() == whole
    data = dict(zip(*(sum((batch[name].to_pylist() for batch in rows), []) for name in ("region", "bytes")), strict=True))
    starts = {}
    for region, value in data.items():
        for i in range(len(value) - 399):
            starts.setdefault(value[i : i + 400], []).append((region, i))
    covered = {region: set() for region in data}
    for held in starts.values():
        if len(held) > 1:
            for region, i in held:
                covered[region].update(range(i, i + 400))
    copies = dict(zip(*(sum((batch[name].to_pylist() for batch in rows), []) for name in ("region", "copies")), strict=True))
    got = {region: set() for region in data}
    for region, begin, stop in whole:
        got[region].update(range(begin, stop))
    assert got == {region: set(range(len(data[region]))) if copies[region] > 1 else at for region, at in covered.items()}
