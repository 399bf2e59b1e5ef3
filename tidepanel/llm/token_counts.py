"""Token counts of whole texts: only lengths leave the Arrow function, batches are balanced by bytes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import text_bytes

#: Bytes of text, about, that one call of the library encodes; a longer text is cut at safe boundaries into such parts.
BATCH_BYTES = 1 << 18

#: A space between two ASCII letters or digits: no normalisation joins one of them with the space.
BOUNDARY = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


class Counter:
    """Lengths of encoded texts for one tokenizer file, and whether and where texts may be cut.

    ``.model`` files go to sentencepiece, ``.json`` files to tokenizers, both with their defaults but no begin, end
    or added special tokens. Texts may be cut at ``BOUNDARY`` if no token can reach across it, which is checked on the
    vocabulary itself. ``skip`` characters are left out at a cut: sentencepiece puts a space before every text, which
    then stands for the one left out.
    """

    def __init__(self, path: str):
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            vocabulary = model.id_to_piece(list(range(model.get_piece_size())))
            inner = any("▁" in piece.lstrip("▁") for piece in vocabulary)
            spaced = "".join(model.encode("a a", out_type=str)) == "▁a▁a"
            self.cuts, self.skip = spaced and not inner, 1
            self.lengths: Callable[[list[str]], list[int]] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        elif path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            split = tokenizer.pre_tokenizer.pre_tokenize_str("a a") if tokenizer.pre_tokenizer else []
            added = tokenizer.get_added_tokens_decoder().values()
            self.cuts = len(split) == 2 and not any(" " in t.content or t.rstrip for t in added)
            self.skip = 0
            self.lengths = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            raise ValueError(f"neither a .model nor a .json file: {path}")

    def parts(self, text: str, size: int) -> Iterator[str]:
        """The text in parts of about ``size`` characters whose token counts add up to that of the whole."""
        start = 0
        while self.cuts and len(text) - start > size:
            found = BOUNDARY.search(text, start + size)
            if not found:
                break
            yield text[start:found.start()]
            start = found.start() + self.skip
        yield text[start:] if start else text

    def count(self, texts: Iterator[str], rows: int, size: int = BATCH_BYTES) -> np.ndarray:
        """Tokens of each of ``rows`` texts, encoded in batches of about ``size`` bytes whatever their lengths."""
        out = np.zeros(rows, np.int64)
        batch: list[str] = []
        whose: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal held
            np.add.at(out, whose, self.lengths(batch))
            batch.clear()
            whose.clear()
            held = 0

        for i, text in enumerate(texts):
            for part in self.parts(text, size):
                batch.append(part)
                whose.append(i)
                held += len(part) if part.isascii() else len(part.encode())
                if held >= size:
                    flush()
        if batch:
            flush()
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One tokenizer per worker process and file, kept from task to task."""
    return Counter(path)


def token_count(text: Column, tokenizer: str, batch_bytes: int = BATCH_BYTES) -> Column:
    """Tokens of a text as a long, by the tokenizer file at a path that every machine has; null counts as empty.

    A text is handled whole: very long ones are cut where no token can cross, and where there is no such place (no
    ASCII word beside another, or a vocabulary with tokens across spaces) they are encoded in one piece.
    """

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(tokenizer)
        for texts in batches:
            yield pa.array(count.count((t.as_py() or "" for t in texts), len(texts), batch_bytes), pa.int64())

    return lengths(text.cast("string"))


def with_token_counts(docs: DataFrame, text: str, tokenizer: str, limit: int, n_bytes: str = "n_bytes",
                      n_tokens: str = "n_tokens", over_limit: str = "over_limit", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Add UTF-8 bytes, tokens and whether they are more than ``limit`` to each row of ``docs``.

    Rows aren't moved: no shuffle, and a lost executor costs only its tasks. Null text counts 0 bytes and 0 tokens.
    Repeated rows stay, an empty table stays empty, other columns pass through. A name that is taken already
    (in any letter case) raises ValueError; pass other names then.
    """
    taken = {c.lower() for c in docs.columns}
    clash = [c for c in (n_bytes, n_tokens, over_limit) if c.lower() in taken]
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    source = docs[f"`{text}`"]
    counted = docs.withColumns({n_bytes: text_bytes(source.cast("string")), n_tokens: token_count(source, tokenizer, batch_bytes)})
    return counted.withColumn(over_limit, F.col(f"`{n_tokens}`") > limit)
