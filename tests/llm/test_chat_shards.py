"""Chat formatting and sharding: exact round trips, laws and odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import chat, shards

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_sep|>", "<\\\\|", "", None, "a\n<|im_end|>\n", "<", "|", "<|", "x<|im_sep|>y", "é😀ß\n\n", "\\", "<|im_start|>"]


def turns_of(spark, rows):
    return spark.createDataFrame(rows, TURNS)


def read_back(df):
    out = {}
    for r in chat.read_chat(chat.format_chat(df)).collect():
        out[r["conv_id"]] = ([(t["role"], t["text"]) for t in r["turns"]], list(r["learned"]), r["formatted"], r["loss_spans"], r["messages"])
    return out


def test_round_trip_of_nasty_texts_and_roles(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "assistant", "system", None, "us\ner%0A", "<|im_end|>"]
    rows = [(c, t, rng.choice(roles), rng.choice(NASTY) if rng.random() < 0.7 else "w" * rng.randint(0, 40)) for c in range(40) for t in range(rng.randint(1, 9))]
    found = read_back(turns_of(spark, rows))
    for c in {r[0] for r in rows}:
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])]
        turns, learned, formatted, spans, messages = found[c]
        assert turns == want
        assert learned == [t for r, t in want if r == "assistant"]
        assert [formatted[s["start"]:s["start"] + s["length"]] for s in spans] == [
            __import__("re").sub(r"<(\\*)\|", r"<\\\1|", t) for r, t in want if r == "assistant"]
        assert len(messages) == 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))


def test_adjacent_turns_of_one_role_become_one_message(spark):
    found = read_back(turns_of(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]))[1]
    assert found[2] == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"


def test_ties_repeats_nulls_extras_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, None, None), (1, None, "system", "first")]
    df = turns_of(spark, rows).withColumn("formatted", F.lit(1)).withColumn("message", F.lit(2))
    found = read_back(df)
    assert found[1][0] == [("system", "first"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert found[None][0] == [("", "")]
    assert chat.format_chat(turns_of(spark, [])).count() == 0


def test_long_conversation_is_linear_enough(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "x" * 50) for i in range(5000)]
    assert len(read_back(turns_of(spark, rows))[1][0]) == 5000


def assigned(spark, n, weights, extra=None):
    df = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("size"))
    return {r["doc_id"]: r for r in shards.assign(df, "doc_id", weights, extra=extra, slices=16).collect()}


def test_slots_are_gapless_and_growth_moves_only_to_the_new_shard(spark):
    now, grown = assigned(spark, 3000, [1.0] * 24, extra=1.0), assigned(spark, 3000, [1.0] * 25)
    slots = {}
    for r in now.values():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) < 1.6 * 3000 / 24
    moved = [k for k in now if now[k]["shard"] != grown[k]["shard"]]
    assert all(grown[k]["shard"] == 24 for k in moved) and 60 < len(moved) < 200
    assert all(now[k]["grown_shard"] == grown[k]["shard"] for k in now)


def test_weights_share_out_in_proportion(spark):
    found = assigned(spark, 4000, [3.0, 1.0])
    assert 0.70 < sum(r["shard"] == 0 for r in found.values()) / 4000 < 0.80
    with pytest.raises(ValueError):
        shards.rendezvous(F.lit("a"), [])


def test_null_and_repeated_keys_keep_their_rows(spark):
    rows = [(None, 1, "x"), (None, 1, "x"), (5, 2, "y"), (5, 2, "y"), (5, 3, "y")]
    df = spark.createDataFrame(rows, "doc_id long, size int, shard string")
    out = shards.assign(df, "doc_id", [1.0, 1.0, 1.0]).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(r[0]), r[1]) for r in rows)
    assert len({r["shard"] for r in out if r["doc_id"] == 5}) == 1
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shards.assign(df.where("false"), "doc_id", [1.0]).count() == 0


def test_query_over_documents(spark):
    from tidepanel.llm.queries import op7_sharding

    rows = op7_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    import zlib

    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")


def test_chat_digests_are_plain_sha256(spark):
    df = turns_of(spark, [(1, 0, "user", "é"), (1, 1, "assistant", "b<|x")])
    row = chat.read_chat(chat.format_chat(df)).select(F.sha2(F.array_join("learned", ""), 256)).first()
    assert row[0] == hashlib.sha256(b"b<|x").hexdigest()
