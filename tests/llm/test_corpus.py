"""Archives, language, packing, leaks, URLs, passages, neighbours and near duplicates against brute force, with odd rows."""

import hashlib
import io
import json
import random
import zipfile
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import language, leaks, neardup, neighbours, packing, queries, suffixes, tokens, urls, warc
from tidepanel.llm.common import new_folder, written
from tidepanel.llm.components import components
from tidepanel.llm.tokens import Encoder

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# ---- archives


def test_archives_round_trip_and_revisits(spark):
    long_ = "é" * 600
    rows = [(1, "http://a/", long_), (9, "http://b/\r\nX: y", long_), (3, None, long_), (4, "u", "short"), (5, "u", "short"), (None, "u", long_), (6, "u", None), (7, "u", ""), (9, "z", long_)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit(0))
    records = warc.plan_records(pages, "page_id", "url", F.col("html").cast("binary"))
    archives = written(warc.write_archives(records, new_folder(spark, "t"), archive_bytes=300), "a")
    places = warc.locate_records(archives)
    back = warc.read_records(places, 4).collect()
    assert len(back) == len(rows) == places.count() and archives.count() > 1
    tasks = warc.read_records(places, warc.read_tasks(archives)).select(F.spark_partition_id()).distinct()
    assert tasks.count() > 1  # small places aren't joined into one task
    for r in back:
        key = r["record_id"].removeprefix("urn:page:")
        if r["payload_digest"] == hashlib.sha1(long_.encode()).hexdigest():
            assert (r["record_type"] == "response") == (key == "9") and r["payload_bytes"] == 1200
            assert r["refers_to"] == (None if key == "9" else "urn:page:9")
        else:
            assert r["record_type"] == "response"
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
    with zipfile.ZipFile(archives.first()["path"].removeprefix("file://")) as z:
        assert z.testzip() is None and set(z.namelist()) == {warc.WARC_MEMBER, warc.INDEX_MEMBER}
    assert warc.write_archives(records.where("false"), new_folder(spark, "t")).count() == 0


def test_directory_with_zip64_comment_and_long_names(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("archive/é.warc.gz", b"x" * 100)
        z.writestr("b" * 300, b"y" * 70)
        z.comment = b"PK\5\6 not the end"
    raw = data.getvalue()
    found = warc.central_directory(io.BytesIO(raw), len(raw))
    assert [(m.name, m.size) for m in found] == [("archive/é.warc.gz", 100), ("b" * 300, 70)]
    at = warc.data_offset(io.BytesIO(raw), found[0])
    assert raw[at:at + 100] == b"x" * 100
    with pytest.raises(ValueError):
        warc.central_directory(io.BytesIO(b"no archive" * 10), 100)
    with pytest.raises(ValueError):
        warc.data_offset(io.BytesIO(raw), found[0]._replace(method=8))


def test_an_archive_without_index_is_scanned(spark, tmp_path):
    row = dict(record_id="urn:page:1", url="u", record_type="response", refers_to=None, payload_digest="d", payload_bytes=3, payload=b"abc")
    parts = [zlib.compress(warc.warc_record(row | {"record_id": f"urn:page:{i}"}, "x"), 6, 31) for i in range(3)]
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        z.writestr("archive/data.warc.gz", b"".join(parts))
    archives = warc.list_archives(spark, str(tmp_path))
    back = warc.read_records(warc.locate_records(archives), warc.read_tasks(archives)).collect()
    assert sorted(r["record_id"] for r in back) == [f"urn:page:{i}" for i in range(3)] and {bytes(r["payload"]) for r in back} == {b"abc"}


# ---- language


def test_language_on_held_out_documents(spark):
    rows = queries.op2_language(spark, "/root/testdata/sf0.01").collect()
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(known)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    judged = [r["lang_pred"] == known[r["doc_id"]] for r in rows if r["held_out"] and known[r["doc_id"]]]
    assert np.mean(judged) > 0.95


def test_language_odd_rows(spark):
    docs = frame(spark, [(i, t, l, "s", 0) for i in range(30) for t, l in (("the cat and the dog sat there " * 9, "en"), ("der hund und die katze ist gut " * 9, "de"))], DOCS)
    net = language.fit(docs, "doc_id", "text", "lang")
    odd = frame(spark, [(1, None), (2, ""), (3, "123 !!"), (4, "x"), (None, "the dog and the cat " * 50_000), (4, "x")]).withColumn("score", F.lit("clash"))
    out = {(r["doc_id"], r["text"]): r for r in language.identify(odd, "text", net).collect()}
    assert {out[k]["lang_pred"] for k in [(1, None), (2, ""), (3, "123 !!")]} == {"und"} and out[(3, "123 !!")]["score"] == 0
    assert out[(4, "x")]["lang_pred"] in net.labels and [r["lang_pred"] for k, r in out.items() if k[0] is None] == ["en"]
    assert language.fit(docs.where("false"), "doc_id", "text", "lang") is None
    assert language.identify(docs.where("false"), "text", net).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, "text", None).collect()} == {"und"}


# ---- packing


def test_encoder_equals_the_tokenizer(spark, monkeypatch):
    encoder, rng = Encoder(packing.tokenizer_path()), random.Random(1)
    assert encoder.quick is not None
    bits = ["a", "Be", "é", " ", "  ", "\n", "\t", "'s", "1", "22", "!", ".", ",", "$$$", " ", "<|endoftext|>", "\r", "\0", "ß", "日", "\x1f", "\u00a0", "😀", "\x85", "ǅ", "²"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += [chr(c) * 2 + " " + chr(c) + "a" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert encoder.encode(texts) == [encoder.ids(t) for t in texts]
    docs = [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    whole = [encoder.ids(t) for t in docs]
    assert encoder.encode(docs) == whole
    monkeypatch.setattr(tokens, "PART_CHARS", 100)
    assert encoder.encode(docs) == whole
    odd = ["\n" * 1_000_000 + "x", "a" * 50_000, " a" * 2_000]
    assert encoder.encode(odd) == [encoder.ids(t) for t in odd]


def test_other_tokenizers_are_not_guessed(tmp_path):
    words = Encoder(packing.tokenizer_path("word_bpe_49k.json"))
    assert words.quick is None and words.encode(["One two", ""]) == [words.ids("One two"), b""]
    raw = json.loads(Path(packing.tokenizer_path()).read_text())
    raw["model"]["merges"] = raw["model"]["merges"][1:] + raw["model"]["merges"][:1]
    (tmp_path / "t.json").write_text(json.dumps(raw))
    assert tokens.ranks(str(tmp_path / "t.json")) is None  # numbers not in the order of the merges
    assert not tokens.reached("abc", {("b", "c"): 0, ("ab", "c"): 1}) and tokens.reached("abc", {("b", "c"): 0, ("a", "bc"): 1})


def test_packing_is_whole_gapless_and_near_its_bound(spark):
    rows = queries.op3_packing(spark, SMALL).collect()
    plain, texts = Encoder(packing.tokenizer_path()), {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    by, bins = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    assert set(by) == set(texts)
    for k, parts in by.items():
        ids, parts = plain.ids(texts[k]) + b"\0" * 4, sorted(parts, key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts))) and sum(p["length"] for p in parts) * 4 == len(ids)
        for p in parts:
            assert p["ids_crc32"] == zlib.crc32(ids[4 * p["start"]:4 * (p["start"] + p["length"])])
            assert p["length"] == 2048 or p["piece"] == 0
    for rows_ in bins.values():
        at = 0
        for p in sorted(rows_, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    assert len(bins) <= packing.lower_bound(np.array([r["length"] for r in rows]), 2048) + 1


def test_bounds_never_exceed_the_best_packing():
    def best(sizes, cap):
        def fits(bins, rest):
            if not rest:
                return True
            return any(b >= rest[0] and fits(bins[:i] + [b - rest[0]] + bins[i + 1:], rest[1:]) for i, b in enumerate(bins) if b not in bins[:i])
        return next(n for n in range(1, 99) if fits([cap] * n, sorted(sizes, reverse=True)))

    rng = np.random.default_rng(4)
    for _ in range(200):
        sizes = rng.integers(1, 13, rng.integers(1, 9))
        bound, packed = packing.lower_bound(sizes, 12), packing.best_fit(np.sort(sizes)[::-1], 12)[0].max() + 1
        assert bound <= best(sizes.tolist(), 12) <= packed


def test_exchange_of_gaps_and_odd_documents(spark):
    rng = random.Random(5)
    items = spark.createDataFrame([(i, rng.randint(300, 900), "x") for i in range(3000)], "uid long, length long, offset string")
    many = packing.pack(items.withColumnRenamed("offset", "more"), "uid", "length", 1000, group_rows=100, rounds=3)
    one = packing.pack(items.withColumnRenamed("offset", "more"), "uid", "length", 1000, group_rows=100, rounds=1)
    count = lambda df: df.select("sequence_id").distinct().count()
    assert many.count() == 3000 and count(many) <= count(one)
    with pytest.raises(Exception, match="lengths"):
        packing.pack(items.withColumn("length", F.lit(0)), "uid", "length", 1000).count()
    odd = frame(spark, [(None, None), (1, ""), (1, ""), (1, "a " * 5000), (2, "b")]).withColumn("piece", F.lit("clash"))
    rows = packing.pack_documents(odd, "doc_id", "text").collect()
    assert sorted((str(r["key"]), r["length"]) for r in rows if r["length"] == 1) == [("1", 1), ("1", 1), ("None", 1)]
    assert packing.pack_documents(odd.where("false"), "doc_id", "text").count() == 0


# ---- leaks


def test_copies_and_reparameterised_questions(spark):
    item = "A train travels 120 km in 2 hours while Anna walks 5 km and then Anna rests for 2 hours before the train returns."
    other = "A train travels 300 km in 4 hours while Boris walks 7 km and then Boris rests for 4 hours before the train returns."
    wrong = "A train travels 300 km in 4 hours while Boris walks 7 km and then Clara rests for 9 hours before the train returns."
    filler = "some quite different words that stand around the passage in this text"
    docs = frame(spark, [(1, f"{filler}. {item} {filler}"), (2, f"{filler}. {other}"), (3, f"{filler}. {wrong}"), (4, filler), (None, item), (1, None), (5, ""),
                         (6, f"{filler}. {item} {filler}"), (6, f"{filler}. {item} {filler}"), (7, item.upper())]).withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(10, item), (11, "Two words"), (12, None), (13, "")], "item_id long, text string")
    found = {(r["id"], r["item_id"]): r["kind"] for r in leaks.leaks(docs, items, "doc_id", "text", "item_id", "text").collect()}
    assert found[(1, 10)] == found[(None, 10)] == found[(6, 10)] == "copy" and found[(2, 10)] == "reparameterised"
    assert found[(7, 10)] == "copy"  # in capitals
    assert not {(3, 10), (4, 10), (5, 10)} & set(found)
    shuffled = leaks.leaks(docs, items, "doc_id", "text", "item_id", "text", broadcast_windows=0)
    assert {(r["id"], r["item_id"]): r["kind"] for r in shuffled.collect()} == found
    assert leaks.leaks(docs.where("false"), items, "doc_id", "text", "item_id", "text").count() == 0
    assert leaks.leaks(docs, items.where("false"), "doc_id", "text", "item_id", "text").count() == 0


def test_names_units_number_words_and_case(spark):
    train = "A train travels 120 km in 2 hours while Anna walks 5 km and then Anna rests for 2 hours before the train returns."
    apples = "Anna has 3 red apples in a basket. Boris then buys 7 more apples and gives them to Anna. How many apples are there now?"
    if_ = "If the shop sells 4 pears every morning then how many pears does it sell in 6 mornings of the week?"
    variants = {
        1: (10, train.replace("120", "120,000"), "reparameterised"),
        2: (10, train.replace("Anna", "Boris"), "reparameterised"),
        3: (10, train.replace("Anna", "Mary Ann"), "reparameterised"),
        4: (10, train.replace("Anna", "Anna Smith"), "reparameterised"),
        5: (10, train.upper(), "copy"),
        6: (10, train.lower(), "copy"),
        7: (10, train.replace("120 km", "ninety-five kilometres").replace("5 km", "seven kilometres").replace("2 hours", "three hours"), "reparameterised"),
        8: (11, "Clara has 5 red apples in a basket. David then buys 9 more apples and gives them to Clara. How many apples are there now?", "reparameterised"),
        9: (11, apples.replace("Anna", "Clara").replace("Boris", "Clara"), "reparameterised"),
        10: (12, if_, "copy"),
        11: (12, "Boris said " + if_, "copy"),
        12: (12, "Boris " + if_, "copy"),
        13: (12, if_.replace("If", "When") + " I know when.", "copy"),
        14: (10, train.replace("Anna walks", "Boris walks").replace("Anna rests", "Clara rests"), None),
        15: (11, (apples + " ") * 30, "copy"),
        16: (10, "word " * 20000 + train, "copy"),
        17: (11, apples.replace("3", "two hundred"), "reparameterised"),
    }
    docs = frame(spark, [(i, f"Some other words. {t} and more") for i, (_, t, _) in variants.items()])
    items = spark.createDataFrame([(10, train), (11, apples), (12, if_)], "item_id long, text string")
    found = {(r["id"], r["item_id"]): r for r in leaks.leaks(docs, items, "doc_id", "text", "item_id", "text").collect()}
    kinds = {i: (item, found[(i, item)]["kind"] if (i, item) in found else None) for i, (item, _, _) in variants.items()}
    expected = {i: (item, kind) for i, (item, _, kind) in variants.items()}
    assert kinds == expected
    assert set(found) <= {(i, item) for i, (item, _, _) in variants.items()} and found[(13, 12)]["windows"] < found[(10, 12)]["windows"]
    assert found[(16, 10)]["start"] == 20003 and found[(16, 10)]["tokens"] == len(train.split())


def test_a_window_that_an_item_repeats_is_aligned_at_each_place(spark):
    verse = "row the little boat gently down this stream "
    items = spark.createDataFrame([(1, verse * 3 + "merrily we sing along")], "item_id long, text string")
    found = leaks.leaks(frame(spark, [(1, verse + verse + "merrily we sing along"), (2, "merrily we sing along")]), items, "doc_id", "text", "item_id", "text").collect()
    assert [(r["id"], r["windows"], r["item_windows"], r["start"]) for r in found] == [(1, 12, 12, 0)]


def test_no_plan_of_the_leaks_holds_the_templates_of_another(spark, monkeypatch):
    folder, plans = "/root/testdata/sf0.001", []
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(leaks, "written", lambda df, name: plans.append(plan(df)) or written(df, name), raising=False)
    plans.append(plan(queries.op4_decontamination(spark, folder)))
    assert max(p.count("split(") for p in plans) <= 3  # the documents', the items' and the items' in lower case
    assert max(map(len, plans)) < 100_000


def test_hits_without_id_with_id_0_and_twice_are_told_apart(spark):
    item = "A train travels 120 km in 2 hours while Anna walks 5 km and then Anna rests for 2 hours before the train returns."
    other = item.replace("Anna", "Boris")
    docs = frame(spark, [(0, item), (None, item), (None, other), (None, item), (0, other), (0, item), (None, None)])
    items = spark.createDataFrame([(1, item), (None, item), (1, item)], "item_id long, text string")
    found = leaks.leaks(docs, items, "doc_id", "text", "item_id", "text").collect()
    rows = [(r["id"], r["text_key"], r["item_id"], r["kind"]) for r in found]
    assert len(rows) == len(set(rows)) == 4 and {r["item_id"] for r in found} == {1}
    assert sorted((str(r["id"]), r["kind"]) for r in found) == [("0", "copy"), ("0", "reparameterised"), ("None", "copy"), ("None", "reparameterised")]


def test_leaks_are_the_documents_that_contain_an_item(spark):
    found = {(r["doc_id"], r["item_id"]) for r in queries.op4_decontamination(spark, "/root/testdata/sf0.01").collect()}
    d, b = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet").collect() for t in ("documents", "benchmark"))
    assert found == {(x["doc_id"], y["item_id"]) for x in d for y in b if x["text"] and y["text"] in x["text"]}


# ---- URLs


def test_rules_and_odd_urls(spark):
    rows = ["http://A.net/x", "https://www.Example.NET/en/1?q", "http://example.net/en", "ftp://de.example.com/de/#f", "http://org/fr/", "http://xorg/fr/", "no scheme", None, "",
            "http://a.net", "://net/", "http://notnet/", "x://y://net/", "http://a.b.org/fr/\nz?"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string").withColumn("verdict", F.lit(1))
    model = urls.fit(pages.select("url", F.lit(None).cast("int").alias("label")))
    out = {r["page_id"]: r for r in urls.judge(pages, "url", queries.RULES, model).collect()}

    def brute(u):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
            path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        return host, path, best and best.text, best.verdict if best else "allow"

    for i, u in enumerate(rows):
        assert (out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) == brute(u), u
    assert urls.judge(pages.where("false"), "url", queries.RULES, model).count() == 0


def test_blocked_urls_look_like_listed_ones(spark):
    """The registered labels: rows by their hash are held out, and the trees rank them without seeing the list's words."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    labelled = queries.listed_urls(pages).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(2)))
    for fold in (0, 1):
        model = urls.fit(labelled.where(F.col("fold") != fold))
        held = labelled.where(F.col("fold") == fold).collect()
        score, y = model.score([r["url"] for r in held]), np.array([r["label"] for r in held])
        ranks = np.argsort(np.argsort(score, kind="stable")) + 1
        auc = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
        assert y.sum() > 20 and auc > 0.95, auc


def test_registered_url_query(spark):
    rows = queries.op5_urls(spark, "/root/testdata/sf0.1").collect()
    source = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()}
    assert {r["page_id"] for r in rows} == set(source) and len(rows) == len(source)
    for r in rows:
        host, path = urls.parts(source[r["page_id"]])
        fits = [x for x in queries.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.text)
        assert r["verdict"] == (best.verdict if best else "block" if r["block_score"] >= 0.5 else "allow")
    listed = [r for r in rows if r["rule"] is None and any(w in r["host"] for w in queries.LISTED)]
    assert listed and sum(r["verdict"] == "block" for r in listed) >= 0.9 * len(listed)
    others = [r for r in rows if r["rule"] is None and not any(w in r["host"] for w in queries.LISTED)]
    assert sum(r["verdict"] == "block" for r in others) <= 0.02 * len(others)


def test_listed_urls_label_odd_rows(spark):
    rows = [(1, "http://Free-BETS.example/"), (2, "http://alphabets.example/casino"), (3, None), (4, "no scheme casino"), (5, "http://a.example/"), (5, "http://a.example/")]
    found = sorted((r["url"], r["label"]) for r in queries.listed_urls(frame(spark, rows, "page_id long, url string").withColumn("label", F.lit(9))).collect())
    assert found == [("http://Free-BETS.example/", 1), ("http://a.example/", 0), ("http://a.example/", 0), ("http://alphabets.example/casino", 0)]


def test_trees_learn_lexical_signs(spark):
    rng = random.Random(2)
    make = lambda bad: f"http://{'shop' if bad else 'news'}{rng.randint(1, 9)}.example.{rng.choice(['biz', 'info'] if bad else ['org', 'edu'])}/" + (
        "".join(rng.choice("0123456789abcdef") for _ in range(30)) if bad else "/".join(rng.choice(["world", "sport"]) for _ in range(3)))
    rows = [(make(b), int(b)) for b in (i % 3 == 0 for i in range(1500))]
    model = urls.fit(spark.createDataFrame(rows[:1000] + [(None, 1), ("x", None)], "url string, label int"))
    score = model.score([u for u, _ in rows[1000:]])
    assert np.mean((score > 0.5) == np.array([y for _, y in rows[1000:]])) > 0.97


# ---- passages


def brute_repeats(rows):
    first, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in first:
                gone[p:p + 100] = True
            else:
                first.add(w)
        runs = int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum())
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    shared = [words(n) for n in (25, 40, 60, 200)]
    rows = [(i, " ".join(rng.choice([words(20), rng.choice(shared), rng.choice(shared)[5:150], "=" * rng.randint(90, 400), "ab" * 130]) for _ in range(6))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "x" * 99), (203, "x" * 100), (204, "x" * 101), (205, rows[3][1]), (206, words(30000)), (207, "\0" * 250)]
    want = brute_repeats(rows)
    for hot in (20_000, 2):
        monkeypatch.setattr(suffixes, "HOT", hot)
        docs = frame(spark, rows).withColumn("kept", F.lit("clash")).repartition(5)
        got = {r[0]: tuple(r[1:]) for r in suffixes.repeats(docs, "doc_id", "text").select("id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()}
        assert got == want


def test_repeats_with_repeated_and_missing_ids(spark):
    rng = random.Random(12)
    long_ = "".join(rng.choice("abcdefgh ") for _ in range(400))
    docs = frame(spark, [(1, long_), (1, long_), (None, long_), (None, None)])
    out = suffixes.repeats(docs, "doc_id", "text").collect()
    assert sorted(r["n_removed"] for r in out) == [0, 0, 400, 400]
    assert [r["n_removed"] for r in out if r["id"] is None and r["n_bytes"]] == [400]
    assert suffixes.repeats(docs.where("false"), "doc_id", "text").count() == 0
    texts = {r["doc_id"]: r["text"] for r in suffixes.without_repeats(frame(spark, [(1, "é" * 80), (2, "x" + "é" * 80), (3, None), (4, "")]), "doc_id", "text").collect()}
    assert texts == {1: "é" * 80, 2: "x", 3: None, 4: ""} or texts[2].startswith("x")


def test_family_keeps_levels_geometric():
    family, seen, rng = suffixes.Family(), set(), random.Random(8)
    for _ in range(60):
        batch = [rng.randint(0, 900) for _ in range(rng.randint(1, 40))]
        again = family.add(np.array([b"%0100d" % x for x in batch], dtype="S100"))
        for x, a in zip(batch, again):
            assert a == (x in seen)
            seen.add(x)
        assert all(len(a) > 2 * len(b) for a, b in zip(family.levels, family.levels[1:]))


# ---- neighbours


def test_neighbours_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 40)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 6)).astype(np.float32) * rng.uniform(0.5, 2, 1500)[:, None].astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(200)]
    rows += [(5000, None), (5001, [0.0] * 6), (5002, [float("nan")] + [1.0] * 5), (5003, [None] * 6), (5004, [1.0]), (None, [1.0] * 6), (5005, [float("inf")] * 6), (5020, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = {}
    for r in neighbours.search(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", 5, leaf_rows=40).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and i < 5000]
    m, ids = np.stack([v for _, v in good]), np.array([i for i, _ in good])
    assert set(got) == {i for i, _ in good if i % 20 == 0}
    hits = []
    for q, found in got.items():
        s = m @ m[ids == q][0]
        keep = ids != q
        best = ids[keep][np.lexsort((ids[keep], -s[keep]))][:5].tolist()
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(sc - s[ids == v][0]) < 1e-9 for _, v, sc in found)
        hits.append(len(set(best) & {v for _, v, _ in found}) / 5)
    assert np.mean(hits) >= 0.9
    assert neighbours.search(df.where("false"), df, "vec_id", "embedding", 5).count() == 0
    few = neighbours.search(df.where("vec_id < 3"), df.where("vec_id < 3"), "vec_id", "embedding", 5)
    assert few.count() == 6


# ---- near duplicates


def brute_groups(rows, words, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    bases = [[f"w{rng.randint(0, 400)}" for _ in range(n)] for n in (3, 12, 60, 150, 300)]
    rows = []
    for i in range(160):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    rows += [(500, None), (501, ""), (502, " \t"), (503, "One"), (504, "one"), (505, "one two"), (506, "ONE\ntwo"), (7, rows[9][1])]
    monkeypatch.setattr(neardup, "BLOCK", 16)
    for words, percent in ((3, 85), (5, 80)):
        out = neardup.near_duplicates(frame(spark, rows).withColumn("n", F.lit("clash")), "doc_id", "text", words, percent).collect()
        assert sorted((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out) == brute_groups(rows, words, percent)


def test_near_duplicates_without_ids_or_rows(spark):
    out = neardup.near_duplicates(frame(spark, [(None, "a b c d"), (4, "a b c d"), (None, "other words here"), (None, None)]), "doc_id", "text", 3, 85).collect()
    assert sorted((str(r["id"]), str(r["component_id"]), r["kept"]) for r in out) == [
        ("4", "4", True), ("None", "4", False), ("None", "None", True), ("None", "None", True)]
    assert neardup.near_duplicates(frame(spark, []), "doc_id", "text").count() == 0


def test_estimate_corrects_for_chance():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.5, 0.8, 1.0):
        found = []
        for _ in range(60):
            both = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            a, b = (np.concatenate([both, rng.integers(0, 2**63, 400 - len(both), dtype=np.uint64)]) for _ in range(2))
            x, y = (neardup.packed(neardup.minima(neardup.mixed(s))).view(np.uint64) for s in (a, b))
            d = x ^ y
            fold = d | (d >> np.uint64(1)) | (d >> np.uint64(2)) | (d >> np.uint64(3))
            found.append(neardup.estimate(int(np.bitwise_count(fold & np.uint64(neardup._ones())).sum())))
        assert abs(np.mean(found) - share / (2 - share)) < 0.02


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
