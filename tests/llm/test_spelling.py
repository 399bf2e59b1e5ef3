"""Spelling variants against all pairs and a plain edit distance."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import same
from pyspark.sql import functions as F

from tidepanel.llm import spelling

SMALL = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def plain(words, times=2):
    out = {}
    for w, n in words.items():
        near = [o for o in words if one_edit(w, o)]
        best = min(near, key=lambda o: (-words[o], o), default=None)
        form = best if near and words[best] >= times * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    for w in out:
        end = w
        while out[end][0]:
            end = out[end][0]
        out[w].append(end)
    return out


def rows_of(df):
    return {r["word"]: [r["form"], r["n"], r["n_near"], r["form_n"], r["root"]] for r in df.collect()}


def invented(rng, count, letters, sizes):
    words = {}
    while len(words) < count:
        words["".join(rng.choice(letters) for _ in range(rng.choice(sizes)))] = rng.choice([3, 4, 7, 20, 21, 100])
    return words


@pytest.mark.parametrize("letters, sizes, count", [("ab", range(1, 9), 150), ("aéÿ𝄞", range(3, 8), 400), ("ab", [1, 2, 11, 12], 200)])
def test_variants_with_burst_groups(spark, letters, sizes, count):
    words = invented(random.Random(7), count, letters, list(sizes))
    df = spark.createDataFrame([*words.items(), (None, 5)], "word string, n long").withColumn("N_near", F.lit("x"))
    for limit in (3, 1_000):
        assert rows_of(spelling.variants(df, group_words=limit)) == plain(words)


def test_burst_keeps_groups_small(spark):
    words = {f"aaaa{a}{b}{c}zzzz": 3 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    groups = spelling.bounded_groups(df, 20).groupBy(*spelling.GROUP).count().toPandas()
    open_ = groups["longest"] - groups["before"].str.len() - groups["after"].str.len()
    assert groups["count"][open_ >= 2].max() <= 20 and groups["count"].max() <= 20
    assert rows_of(spelling.variants(df, group_words=20)) == plain(words)


def test_scan_in_parts_and_long_words(spark):
    words = {"x" * 3_000: 3, "x" * 3_001: 9, "x" * 1_500 + "y" + "x" * 1_499: 20, "short": 3, "shore": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.variants(df)) == plain(words)
    some = invented(random.Random(3), 300, "abc", [5, 6, 7])
    df = spark.createDataFrame(list(some.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best"]) for r in spelling.near_words(df, task_rows=40).collect()}
    near = {w: [o for o in some if one_edit(w, o)] for w in some}
    assert got == {w: (len(os), min(os, key=lambda o: (-some[o], o))) for w, os in near.items() if os}


def test_empty_table_and_times(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(empty, times=1)


def test_sorted_lists_share_rows():
    listed = spelling.SortedLists(["ab", "abc", "abd", "b", "ab", "b"], np.array([0, 0, 0, 0, 1, 1]))
    assert listed.shared.tolist() == [-1, 2, 2, 0, -1, 0]
    assert listed.low.tolist() == [0, 0, 0, 0, 4, 4] and listed.high.tolist() == [4, 4, 4, 4, 6, 6]
    empty = spelling.scan(pd.DataFrame({"longest": [], "before": pd.Series(dtype=str), "after": pd.Series(dtype=str), "cap": [],
                                        "word": pd.Series(dtype=str), "n": []}))
    assert not len(empty)


def test_words_of_texts(spark, monkeypatch):
    text = "Straße ÉTÉ été ABC-abc×÷Ǆabc x2y " * 30
    rows = [(i, text) for i in range(40)] + [(None, text), (7, text), (50, None), (51, ""), (52, "123"), (-3, "a" * 5_000)]
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if crc % 5 == 0:
                at = crc % len(low)
                low = low[:at] + low[at + 1:]
            if len(low) >= 3:
                want[low] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1))
    got = spelling.vocabulary(docs, "doc_id", "text", least=1, every=5, shortest=3)
    assert {r["word"]: r["n"] for r in got.collect()} == want
    assert spelling.vocabulary(docs.where("false"), "doc_id", "text").count() == 0
    monkeypatch.setattr(spelling, "TEXT_CHARS", 10)
    assert spelling.runs(text) == Counter(re.findall("[A-Za-zÀ-ÿ]+", text))


def test_query_against_sql(spark):
    assert same.differences(spark, "op11_spelling", SMALL) == []
