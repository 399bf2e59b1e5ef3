"""Line numbers and records by place, windows cut into slices, hierarchies of any depth."""

import csv
import io
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import hierarchy, joins, panel
from tidepanel.sources import files, grids, lines


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_are_numbered_over_splits(spark, tmp_path, tiny_splits):
    want = {}
    for name, n in (("a.txt", 300), ("b.txt", 1), ("c.txt", 57)):
        text = [f"{name} line {i} " + "x" * (i % 23) for i in range(n)]
        (tmp_path / name).write_text("\n".join(text))
        want |= {(name, i): t for i, t in enumerate(text)}
    got = lines.numbered_lines(spark, str(tmp_path))
    rows = got.collect()
    assert {(r["file"].split("/")[-1], r["line_no"]): r["value"] for r in rows} == want
    assert len({(r["file"], r["block"]) for r in rows}) > 10
    assert lines.numbered_lines(spark, str(tmp_path), "b.*").count() == 1
    assert lines.most_splits(spark, str(tmp_path)) >= len({(r["file"], r["block"]) for r in rows})


def test_numbering_moves_no_lines(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("a,b\n" * 50)
    plan = grids.read_grid(spark, str(tmp_path / "sheet.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "value" not in line


def test_records_with_line_breaks_over_splits(spark, tmp_path, tiny_splits):
    rng, want = random.Random(5), []
    out = io.StringIO()
    out.write("a preamble with \" one quote\n")
    writer = csv.writer(out, lineterminator="\n")
    header = ["T", "N", "V"]
    writer.writerow(header)
    for i in range(200):
        row = [f"t{i}", rng.choice(["plain", 'say "hi"', "two\nlines", 'a\n"b"\n\nc,', "x" * 90]), str(i)]
        if i == 50:
            row = header
        want.append(tuple(row))
        writer.writerow(row)
    (tmp_path / "m.csv").write_text(out.getvalue())
    rows = files.read_csv_with_preamble(spark, str(tmp_path / "m.csv"), place=True).orderBy("_place")
    assert [(r["T"], r["N"], r["V"]) for r in rows.collect()] == want
    assert files.read_csv_with_preamble(spark, str(tmp_path / "m.csv")).columns == header


def test_read_csv_needs_one_header_and_closed_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("T,N\n1,2\n")
    (tmp_path / "b.csv").write_text("\nT,N\nT,N\n\n3,\"x\ny\"\n")
    rows = files.read_csv(spark, str(tmp_path / "*.csv"), ["N", "T"]).collect()
    assert sorted((r["T"], r["N"]) for r in rows) == [("1", "2"), ("3", "x\ny"), ("T", "N")]
    (tmp_path / "c.csv").write_text("T,M\n1,2\n")
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "*.csv"), ["T"])
    (tmp_path / "d.txt").write_text("T,N\n1,\"never closed\n2,3\n")
    with pytest.raises(Exception, match="never closed"):
        files.read_csv(spark, str(tmp_path / "d.txt"), ["T"]).collect()


@pytest.mark.parametrize("width", [1, 4, 5, 100])
def test_rolling_in_slices_on_one_hot_key(spark, width):
    rng = random.Random(1)
    rows = [("hot", y, rng.choice([None, rng.random()])) for y in range(-40, 200) if rng.random() < 0.8] + [("b", 3, 1.0), ("b", None, 2.0)]
    df = spark.createDataFrame(rows, "k string, y long, v double")
    rounded = lambda d: sorted((tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in d.collect()), key=repr)
    want = panel.with_rolling(df.where("y IS NOT NULL"), "k", "y", "v", 5)
    got = panel.with_rolling_sliced(df, "k", "y", "v", 5, width)
    assert rounded(got.where("y IS NOT NULL")) == rounded(want) and got.count() == len(rows)
    slices = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in slices and "_slice" in slices


@pytest.mark.parametrize("days", [1, 30, 5000])
def test_asof_in_slices(spark, days):
    rng, start = random.Random(2), date(1999, 1, 1)
    day = lambda: start + timedelta(days=rng.randint(0, 900))
    left = spark.createDataFrame([(rng.choice([1, 2, 3]), day()) for _ in range(200)], "k long, t date")
    pairs = {(rng.choice([1, 2]), day()) for _ in range(20)}
    right = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(sorted(pairs))], "k long, u date, v long")
    plain = joins.asof_join(left, right, "k", "t", "u", ["v"])
    cut = joins.asof_join(left, right, "k", "t", "u", ["v"], slice_days=days)
    assert cut.columns == plain.columns
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, plain.collect()))


def test_hierarchy_of_any_depth_with_circles(spark):
    parents = {i: (i - 1) // 3 for i in range(1, 40)} | {100 + i: 99 + i for i in range(1, 20)}
    circle = {201: 202, 202: 203, 203: 201, 204: 201, 300: 300}
    links = spark.createDataFrame([*parents.items(), *circle.items(), (None, 1), (7, None)], "c long, p long")
    assert sorted(r["node"] for r in hierarchy.cyclic(links, "c", "p").collect()) == [201, 202, 203, 204, 300]

    def path(n):
        out = [n]
        while out[-1] in parents:
            out.append(parents[out[-1]])
        return out

    nodes = set(parents) | set(parents.values())
    want = sorted((n, a, d) for n in nodes for d, a in enumerate(path(n)))
    assert sorted(tuple(r) for r in hierarchy.ancestors(links, "c", "p").collect()) == want
    values = spark.createDataFrame([(n, n % 5) for n in nodes for _ in range(2)], "c long, v long")
    got = {r["node"]: (r["depth"], r["members"], r["v"]) for r in hierarchy.rollup(links, "c", "p", values, "c", ["v"]).collect()}
    below = {a: [n for n in nodes if a in path(n)] for a in nodes}
    assert got == {a: (len(path(a)) - 1, 2 * len(ns), 2 * sum(n % 5 for n in ns)) for a, ns in below.items()}
    assert hierarchy.ancestors(links.where(F.lit(False)), "c", "p").count() == 0
