"""Spelling variants: words one edit apart, found by dynamic programming along sorted word lists.

Two words that differ by one inserted, deleted or replaced code point share the half before or the half after the
edit. Words are therefore grouped by halves, and each group is a sorted list that a task scans: rows of the edit matrix
(a band of three cells, as only one edit counts) are computed once for a prefix that neighbours in the list share,
and a range of the list is skipped as soon as its shared prefix is more than one edit away. A group that is too
large is burst: what lies between its known ends is halved again, until at most a letter is open.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import written

#: Maximal runs of letters.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Characters of a text whose runs are taken at a time, and different words that a task remembers before it emits them.
TEXT_CHARS, HELD_WORDS = 1 << 20, 300_000

#: Words of one group before it is burst; group rows of a task, about; queries that go through the lists side by side.
GROUP_WORDS, TASK_ROWS, BLOCK = 4_000, 150_000, 8_192

GROUP = ["longest", "before", "after", "cap"]


def runs(text: str) -> Counter:
    """How often each maximal run of letters occurs in a text, which is gone through in bounded parts."""
    if len(text) <= TEXT_CHARS:
        return Counter(RUN.findall(text))
    found: Counter = Counter()
    start = 0
    while start < len(text):
        stop = _NO_RUN.search(text, start + TEXT_CHARS)
        end = stop.start() if stop else len(text)
        found.update(RUN.findall(text, start, end))
        start = end
    return found


def misspelt(word: str, crc: int, every: int) -> str:
    """The word, without its code point ``crc % length`` if ``every`` divides crc."""
    if crc % every:
        return word
    at = crc % len(word)
    return word[:at] + word[at + 1:]


def occurrences(docs: DataFrame, key: str, text: str, every: int = 97, shortest: int = 5) -> DataFrame:
    """Partial counts ``word, n`` of the words of whole texts, of at least ``shortest`` code points.

    Words are maximal runs of letters with A-Z lower-cased. One occurrence in about ``every`` is given a misspelling,
    the same one in all of a document: the code point to go follows from the CRC-32 of ``<key>:<word>``. A null text has
    no words, a null key counts as an empty one. A task holds a bounded number of words and emits what it has before
    it takes more.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def emit() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                value = t.as_py()
                if not value:
                    continue
                name = k.as_py()
                seed = zlib.crc32(f"{'' if name is None else name}:".encode())
                lowered: dict[str, int] = {}
                for run, n in runs(value).items():
                    low = run.lower() if run.isascii() else run.translate(_LOWER)
                    lowered[low] = lowered.get(low, 0) + n
                for word, n in lowered.items():
                    crc = zlib.crc32(word.encode(), seed)
                    if not crc % every:
                        word = misspelt(word, crc, every)
                    if len(word) >= shortest:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield emit()
        yield emit()

    source = docs.select(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return source.mapInArrow(count, "word string, n long")


def vocabulary(docs: DataFrame, key: str, text: str, least: int = 3, every: int = 97, shortest: int = 5) -> DataFrame:
    """``word, n``: every word that occurs at least ``least`` times in all texts together."""
    return occurrences(docs, key, text, every, shortest).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- groups of words that share a half


def _halves(length: Column, half: Column) -> list[Column]:
    return [F.struct(length.alias("longest"), F.substring("word", F.lit(1), half).alias("before"), F.lit("").alias("after"), length.alias("cap")),
            F.struct(length.alias("longest"), F.lit("").alias("before"), F.substring("word", -half, half).alias("after"), half.alias("cap"))]


def grouped(words: DataFrame) -> DataFrame:
    """Each word in the groups of its halves: ``longest, before, after, cap, word, n``.

    A group holds words of ``longest`` and ``longest - 1`` code points that share ``before`` and ``after``; of its pairs
    it answers for those whose longer word has ``longest``, and that share less than ``cap`` leading code points. A pair
    that shares both halves is thus met in one group only, that of the half before.
    """
    size = F.char_length("word")
    places = []
    for length in (size, size + 1):
        half = F.floor(length / 2).cast("int")
        places += _halves(length, half)
    return words.select(F.explode(F.array(*places)).alias("g"), "word", "n").select("g.*", "word", "n")


def burst(rows: DataFrame) -> DataFrame:
    """The rows of groups in the groups of the halves of what lies between their known ends."""
    left, right = F.char_length("before"), F.char_length("after")
    half = F.floor((F.col("longest") - left - right) / 2).cast("int")
    open_ = F.char_length("word") - left - right
    near = F.struct("longest", F.substring("word", F.lit(1), left + half).alias("before"), "after", "cap")
    far = F.struct("longest", "before", F.substring("word", left + open_ - half + 1, half + right).alias("after"),
                   F.least("cap", left + half).alias("cap"))
    out = rows.select(F.explode(F.array(near, far)).alias("g"), "word", "n").select("g.*", "word", "n")
    return out.where(F.col("cap") > F.char_length("before"))


def bounded_groups(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """All group rows, with every group of more than ``group_words`` words burst until its groups are smaller.

    Between the ends of a group that can't be burst at most one code point is open, so it has no more words than there
    are letters. The sizes are counted before any group is gathered.
    """
    done, rows = None, grouped(words)
    while True:
        rows = written(rows, "groups")
        can = F.col("longest") - F.char_length("before") - F.char_length("after") >= 2
        large = written(rows.groupBy(*GROUP).count().where((F.col("count") > group_words) & can).select(*GROUP), "large")
        if large.isEmpty():
            return done.unionByName(rows) if done else rows
        small = rows.join(large, GROUP, "left_anti")
        done = done.unionByName(small) if done else small
        rows = burst(rows.join(large, GROUP, "left_semi"))


# ---- one task's sorted lists


class SortedLists:
    """Sorted words of several groups, one after the other, for searches of all words that are one edit from a word.

    ``lists`` tells the list of each word and never falls; within a list words rise strictly. Words are held as flat code
    points. ``shared[i]`` is the longest common prefix of words i - 1 and i, -1 where a list begins.
    """

    def __init__(self, words: list[str], lists: np.ndarray):
        self.size = np.array([len(w) for w in words], np.int64)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.at = np.cumsum(self.size) - self.size
        n = len(words)
        self.shared = np.full(n, -1, np.int64)
        same = np.flatnonzero(lists[1:] == lists[:-1]) + 1 if n else np.empty(0, np.int64)
        self.shared[same] = 0
        depth = 0
        while len(same):
            same = same[(self.size[same] > depth) & (self.size[same - 1] > depth)]
            same = same[self.codes[self.at[same] + depth] == self.codes[self.at[same - 1] + depth]]
            depth += 1
            self.shared[same] = depth
        starts = np.flatnonzero(self.shared < 0)
        number = np.cumsum(self.shared < 0) - 1
        self.low = starts[number] if n else starts
        self.high = np.append(starts[1:], n)[number] if n else starts
        order = np.argsort(self.shared, kind="stable")
        edges = np.searchsorted(self.shared[order], np.arange(int(self.shared.max(initial=-1)) + 2))
        #: Places where the list branches after a prefix of each length, ascending.
        self.branches = [order[a:b] for a, b in zip(edges, edges[1:])]

    def letter(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Code point at a place of a word, -1 outside."""
        inside = (place >= 0) & (place < self.size[word])
        return np.where(inside, self.codes[np.where(inside, self.at[word] + place, 0)], -1)

    def near(self, query: np.ndarray, depth: np.ndarray, cap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) of one list with exactly one edit, and less than ``cap`` leading code points in common.

        All words of a query's list share its first ``depth`` code points. Each open range [low, high) of the list has a
        prefix in common, for which the three matrix cells around the diagonal are known.
        """
        out_q, out_w = [], []
        for first in np.unique(depth):
            at = depth == first
            q, d = query[at], int(first)
            limit = cap[at]
            low, high = self.low[q], self.high[q]
            exact = np.ones(len(q), bool)
            left = np.full(len(q), 1 if d else 2, np.int8)  # rows d, columns d - 1, d, d + 1 of the matrix
            here, right = np.zeros(len(q), np.int8), np.where(self.size[q] > d, 1, 2).astype(np.int8)
            while len(q):
                # The first word of a range may end here: then its distance is the cell of the query's length.
                ends, answers = self.size[low] == d, ~exact | (limit > d)
                gap = self.size[q] - d
                cell = np.select([gap == -1, gap == 0, gap == 1], [left, here, right], 2)
                hit = ends & answers & (cell == 1)
                out_q.append(q[hit])
                out_w.append(low[hit])
                low = low + ends
                # Emptied ranges, and those whose pairs another group answers for, go.
                keep = (low < high) & answers
                q, low, high, limit, exact, left, here, right = (x[keep] for x in (q, low, high, limit, exact, left, here, right))
                if not len(q):
                    break
                # Ranges are cut where the next letter changes.
                places = self.branches[d] if d < len(self.branches) else np.empty(0, np.int64)
                a, b = np.searchsorted(places, low + 1), np.searchsorted(places, high)
                parts = b - a + 1
                owner = np.repeat(np.arange(len(q)), parts)
                inner = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                from_ = low[owner]
                late = inner > 0
                from_[late] = places[(a[owner] + inner - 1)[late]]
                to = high[owner]
                early = inner < parts[owner] - 1
                to[early] = places[(a[owner] + inner)[early]]
                q, limit, exact, left, here, right = (x[owner] for x in (q, limit, exact, left, here, right))
                low, high = from_, to
                letter, size = self.codes[self.at[low] + d], self.size[q]
                new_left = np.minimum(left + (self.letter(q, np.full(len(q), d - 1)) != letter), here + 1)
                same = self.letter(q, np.full(len(q), d)) == letter
                new_here = np.minimum(np.minimum(here + ~same, right + 1), new_left + 1)
                new_here[size < d + 1] = 2
                new_right = np.minimum(right + (self.letter(q, np.full(len(q), d + 1)) != letter), new_here + 1)
                new_right[size < d + 2] = 2
                exact = exact & same
                keep = np.minimum(np.minimum(new_left, new_here), new_right) <= 1
                q, low, high, limit, exact = (x[keep] for x in (q, low, high, limit, exact))
                left, here, right = (np.minimum(x[keep], 2).astype(np.int8) for x in (new_left, new_here, new_right))
                d += 1
        return np.concatenate(out_q or [query[:0]]), np.concatenate(out_w or [query[:0]])


def scan(rows: pd.DataFrame, block: int = BLOCK) -> pd.DataFrame:
    """Near words of each row within its group: ``word, n_near, best_n, best``. Rows are sorted by group and word."""
    lists = (rows[GROUP] != rows[GROUP].shift()).any(axis=1).to_numpy().cumsum()
    # Lists without a word of full length answer for no pair; a word alone has none.
    size = rows["word"].str.len().to_numpy()
    longest = rows["longest"].to_numpy()
    count = np.bincount(lists)
    full = np.bincount(lists, size == longest, minlength=len(count))
    use = (count[lists] > 1) & (full[lists] > 0)
    rows, lists, size, longest = rows[use], lists[use], size[use], longest[use]
    words, n = rows["word"].tolist(), rows["n"].to_numpy()
    listed = SortedLists(words, lists)
    depth, cap = rows["before"].str.len().to_numpy(), rows["cap"].to_numpy()
    found = []
    for start in range(0, len(words), block):
        query = np.arange(start, min(start + block, len(words)))
        q, w = listed.near(query, depth[query], cap[query])
        valid = np.maximum(size[q], size[w]) == longest[q]
        q, w = q[valid], w[valid]
        order = np.lexsort((w, -n[w], q))
        q, w = q[order], w[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
        found.append(pd.DataFrame({"query": q[first], "n_near": np.diff(np.append(first, len(q))), "best": w[first]}))
    out = pd.concat(found) if found else pd.DataFrame({"query": [], "n_near": [], "best": []}, dtype=np.int64)
    text = np.array(words, object)
    return pd.DataFrame({"word": text[out["query"]], "n_near": out["n_near"].to_numpy(np.int64),
                         "best_n": n[out["best"]], "best": text[out["best"]]})


def near_words(words: DataFrame, group_words: int = GROUP_WORDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """``word, n_near, best, best_n`` for each word that has a near one; best has the largest n, then comes first by code point.

    ``words`` has distinct ``word`` and ``n``. A task gets whole groups, sorted by Spark, and scans them in parts of
    bounded size.
    """
    rows = bounded_groups(words, group_words)

    def scans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            if not len(batch):
                continue
            rest.append(batch)
            held += len(batch)
            if held < task_rows:
                continue
            table = pd.concat(rest, ignore_index=True)
            last = int(np.flatnonzero((table[GROUP] != table[GROUP].shift()).any(axis=1).to_numpy())[-1])
            if last:
                yield scan(table.iloc[:last])
            rest, held = [table.iloc[last:]], len(table) - last
        if rest:
            yield scan(pd.concat(rest, ignore_index=True))

    tasks = max(1, -(-rows.count() // task_rows))
    met = rows.repartition(tasks, *GROUP).sortWithinPartitions(*GROUP, "word").mapInPandas(
        scans, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


# ---- forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each word of ``forms`` (``word, form``): the end of the chain of forms.

    Roots are handed down the chains, from the words that have no form to those whose form they are, so each step joins
    on the form, which only near words share, and never on a root, which any number of words may share. A chain has
    as many steps as a count can double.
    """
    forms = written(forms.where("form IS NOT NULL").select("word", "form"), "forms")
    top = forms.select(F.col("form").alias("word")).distinct().join(forms, "word", "left_anti")
    reached = top.select("word", F.col("word").alias("root"))
    out = None
    while True:
        reached = written(forms.join(reached.withColumnRenamed("word", "form"), "form").select("word", "root"), "roots")
        if reached.isEmpty():
            return out if out is not None else reached
        out = reached if out is None else out.unionByName(reached)


def variants(words: DataFrame, times: int = 2, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words`` (distinct ``word``, ``n``; a null word is left out).

    ``form`` is the near word (one insertion, deletion or replacement of a code point) of the largest n, the first by
    code point of several, if it occurs at least ``times`` as often (at least 2, else a chain could turn in a circle);
    ``root`` is where following forms ends. Words without a near one have n_near 0. An empty table gives no rows.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent")
    words = written(words.where("word IS NOT NULL").select("word", "n"), "words")
    near = words.join(near_words(words, group_words), "word", "left")
    apt = F.col("best_n") >= times * F.col("n")
    formed = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(apt, F.col("best")).alias("form"), F.when(apt, F.col("best_n")).alias("form_n")), "formed")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
