"""Language identification by a byte convolutional network, trained in numpy and applied to windows of whole texts."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a window; windows lie side by side and the last one is filled up with zeros.
WINDOW = 256
WIDTHS = (2, 3, 4, 5)
#: Labelled documents that the network learns from, at most, and windows of each.
MAX_DOCUMENTS, WINDOWS_EACH = 2_400, 8
#: Keys that a slice of a label gives to the sample, at most; below 1,000 Spark limits them before the shuffle.
SLICE_KEYS = 600
#: Windows that are convolved at a time.
BATCH = 256

#: Bytes that count as letters when windows are weighted: ASCII letters and all of multi-byte characters.
LETTERS = np.zeros(256, np.float32)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = 1


class Network(NamedTuple):
    """Byte embedding, one filter bank padded to the widest width, and a softmax layer."""

    labels: tuple[str, ...]
    embedding: np.ndarray  # 256 x size
    filters: np.ndarray  # width x size x filters; zero behind a filter's own width
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """What each byte adds at each place of a filter: the convolution is a sum of look-ups."""
        return [self.embedding @ f for f in self.filters]

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for two bytes at once."""
        t = [x.astype(np.float32) for x in self.tables()]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        return pair(t[0], t[1]), pair(t[2], t[3]), t[4]

    def pooled(self, windows: np.ndarray, tables) -> np.ndarray:
        """The largest response of each filter in each window (at least 0)."""
        first, second, last = tables
        wide = windows.astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        out = first[pairs[:, :-3]]
        out += second[pairs[:, 2:-1]]
        out += last[wide[:, 4:]]
        return np.maximum(out.max(1) + self.bias, 0)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.dense + self.dense_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the label and its mean probability over all windows, weighted by letters."""
        tables = self.pair_tables()
        total, weight = np.zeros((len(texts), len(self.labels))), np.zeros(len(texts))
        block, owner, used = np.zeros((BATCH, WINDOW), np.uint8), np.zeros(BATCH, np.int64), 0

        def flush():
            w = LETTERS[block[:used]].sum(1) + 1e-3
            p = self.probabilities(self.pooled(block[:used], tables))
            np.add.at(total, owner[:used], p * w[:, None])
            np.add.at(weight, owner[:used], w)

        for i, text in enumerate(texts):
            data, at = np.frombuffer(text, np.uint8), 0
            while at < len(data):
                n = min(BATCH - used, -(-(len(data) - at) // WINDOW))
                part = data[at:at + n * WINDOW]
                flat = block[used:used + n].reshape(-1)
                flat[:len(part)] = part
                flat[len(part):] = 0
                owner[used:used + n] = i
                used, at = used + n, at + len(part)
                if used == BATCH:
                    flush()
                    used = 0
        if used:
            flush()
        mean = total / np.maximum(weight, 1e-9)[:, None]
        best = mean.argmax(1)
        return best, mean[np.arange(len(texts)), best]


def train(windows: np.ndarray, y: np.ndarray, labels: tuple[str, ...], size: int = 8, each: int = 8, epochs: int = 5,
          batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the cross entropy, classes weighted evenly; the gradient of a filter flows through its largest response.

    A small sample is gone through more often: there are 400 steps at least.
    """
    epochs = max(epochs, -(-400 * batch // max(len(y), 1)))
    rng, k, wide = np.random.default_rng(seed), len(labels), max(WIDTHS)
    count = each * len(WIDTHS)
    mask = np.concatenate([np.repeat((np.arange(wide) < w)[:, None, None], each, 2) for w in WIDTHS], 2).astype(float)
    p = {"e": rng.normal(0, 0.5, (256, size)), "f": rng.normal(0, 0.3, (wide, size, count)) * mask, "b": np.zeros(count),
         "d": rng.normal(0, 0.3, (count, k)), "c": np.zeros(k)}
    m, v, step = {n: np.zeros_like(x) for n, x in p.items()}, {n: np.zeros_like(x) for n, x in p.items()}, 0
    weights = len(y) / (k * np.maximum(np.bincount(y, minlength=k), 1))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = order[at:at + batch]
            x, t = windows[rows].astype(np.int64), y[rows]
            tables = [(p["e"] @ f).astype(np.float32) for f in p["f"]]
            span = x.shape[1] - wide + 1
            out = tables[0][x[:, :span]]
            for j in range(1, wide):
                out += tables[j][x[:, j:j + span]]
            where = out.argmax(1)  # rows x filters
            top = np.take_along_axis(out, where[:, None, :], 1)[:, 0] + p["b"]
            pooled = np.maximum(top, 0)
            z = pooled @ p["d"] + p["c"]
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(len(t)), t] -= 1
            z *= weights[t][:, None] / len(t)
            g = {"d": pooled.T @ z, "c": z.sum(0)}
            back = (z @ p["d"].T) * (top > 0)
            g["b"] = back.sum(0)
            g["f"], g["e"] = np.zeros_like(p["f"]), np.zeros_like(p["e"])
            for j in range(wide):
                seen = x[np.arange(len(t))[:, None], where + j]  # the byte at place j of each filter's best position
                g["f"][j] = np.einsum("nfe,nf->ef", p["e"][seen], back)
                np.add.at(g["e"], seen, back[:, :, None] * p["f"][j].T[None])
            g["f"] *= mask
            step += 1
            now = rate * (1 - epoch / epochs)
            for n in p:
                m[n] = 0.9 * m[n] + 0.1 * g[n]
                v[n] = 0.999 * v[n] + 0.001 * g[n] ** 2
                p[n] -= now * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8)
    single = lambda n: p[n].astype(np.float32)
    return Network(labels, single("e"), single("f"), single("b"), single("d"), single("c"))


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def fit(docs: DataFrame, key: str, text: str, label: str, max_documents: int = MAX_DOCUMENTS) -> Network | None:
    """Learn from a bounded sample of the labelled documents; None if there is nothing to learn from.

    The sample takes documents evenly per label by a hash of their key, ``max_documents`` at most, and of each up to
    ``WINDOWS_EACH`` windows spread over its whole text; only those windows reach the driver. Which documents are
    chosen is decided on keys and labels alone; the chosen keys, a bounded list, then pick the texts. A label's keys
    are ranked in slices by their hash, each so short that every task sends on no more than a slice may give. Rows without
    label, text or letters teach nothing; of rows with one key and label, one counts.
    """
    from pyspark.sql import Window

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"),
                       F.col(f"`{label}`").cast("string").alias("label")).where("label IS NOT NULL AND text IS NOT NULL AND key IS NOT NULL")
    slices = -(-max_documents // SLICE_KEYS)
    keys = rows.select("key", "label", F.xxhash64("key").alias("hash")).withColumn("slice", F.pmod(F.shiftright("hash", 32), F.lit(slices)))
    order = Window.partitionBy("label", "slice").orderBy("hash", "key")
    chosen = keys.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= -(-max_documents // slices))
    chosen = chosen.orderBy("rank", "label", "slice").limit(max_documents).select("key", "label").distinct()
    data = F.col("text").cast("binary")
    step = F.greatest(F.lit(WINDOW), F.floor(F.octet_length("text") / WINDOWS_EACH)).cast("int")
    starts = F.sequence(F.lit(0), F.least(F.lit(WINDOWS_EACH - 1), F.floor((F.octet_length("text") - 1) / step)).cast("int"))
    sample = rows.join(F.broadcast(chosen), ["key", "label"]).where(has_letter(F.col("text"))).select(
        "key", "label", F.transform(starts, lambda i: F.substring(data, i * step + 1, WINDOW)).alias("windows"))
    found = sample.groupBy("key", "label").agg(F.first("windows").alias("windows")).collect()
    found.sort(key=lambda r: (r["key"], r["label"]))
    labels = tuple(sorted({r["label"] for r in found}))
    if not labels:
        return None
    data = [bytes(w).ljust(WINDOW, b"\0") for r in found for w in r["windows"]]
    y = np.array([labels.index(r["label"]) for r in found for _ in r["windows"]])
    return train(np.frombuffer(b"".join(data), np.uint8).reshape(-1, WINDOW), y, labels)


def identify(docs: DataFrame, text: str, network: Network | None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) from the whole text; other columns stay, those two are replaced.

    ``und`` with score 0 if the text is null or has no letter, or without a network. Rows are judged one by one, so
    repeated rows get equal results; very long texts are convolved in blocks of windows.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {"lang_pred", "score"}]
    if network is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        best, score = network.predict([t or b"" for t in texts])
        return pd.DataFrame({"lang": [network.labels[i] for i in best], "score": score.clip(0, 1)})

    judged = docs.select(*keep, F.when(has_letter(F.col(f"`{text}`")), F.col(f"`{text}`")).cast("binary").alias("_seen"))
    judged = judged.withColumn("_found", predict("_seen")).withColumn("_known", F.col("_seen").isNotNull())
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {"lang_pred", "score"}],
                         F.when(F.col("_known"), F.col("_found.lang")).otherwise("und").alias("lang_pred"),
                         F.when(F.col("_known"), F.col("_found.score")).otherwise(0.0).alias("score"))


def held_out(key: Column) -> Column:
    """Documents kept from learning: crc32 of the key as text leaves 1 modulo 3. A null key isn't held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
