"""Token ids of whole texts by a given public tokenizer file."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from tidepanel.llm.token_counts import BOUNDARY

#: Characters of a text that are encoded at a time; longer texts are cut at spaces between ASCII words.
PART_CHARS = 1 << 18
# Fixed value: the pattern that byte-level BPE with its own pattern splits texts by.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible ones for themselves, the others for
    the characters from 256 on, in their order."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def reached(token: str, order: dict[tuple[str, str], int]) -> bool:
    """Whether the merges, applied to the token's own characters, lead to the token."""
    parts = list(token)
    while len(parts) > 1:
        rank, at = min((order.get(pair, len(order)), i) for i, pair in enumerate(zip(parts, parts[1:])))
        if rank == len(order):
            return False
        parts[at:at + 2] = ["".join(parts[at:at + 2])]
    return True


def ranks(path: str) -> dict[bytes, int] | None:
    """Ids by bytes, where merging the pair of the least id always gives what the file's merges give; else None.

    That holds for plain byte-level BPE whose merges are numbered in their order and whose tokens are all reached by
    their own merges: then no two other parts of a token can ever stand beside each other.
    """
    with open(path, encoding="utf-8") as file:
        raw = json.load(file)
    model, split = raw["model"], raw.get("pre_tokenizer") or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if (model.get("type") != "BPE" or any(model.get(o) for o in options) or raw.get("normalizer") or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)):
        return None
    special = {a["content"] for a in raw["added_tokens"]}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in pairs]
    order = {pair: i for i, pair in enumerate(pairs)}
    if len(raw["added_tokens"]) != sum(a["special"] for a in raw["added_tokens"]) or made != sorted(set(made)):
        return None
    if len(vocabulary) != len(pairs) + 256 or not all(reached(t, order) for t in vocabulary):
        return None
    byte = byte_of_character()
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, kept from task to task."""
    return Encoder(path)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to what the tokenizers library gives for the whole text, special
    strings taken as ordinary text and none added.

    Files of plain byte-level BPE are encoded by the same merges in tiktoken, in about a quarter of the time; what its
    pattern can't take (very long white space) and other files go to the tokenizers library.
    """

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        known = ranks(path)
        self.quick = Encoding(path, pat_str=PIECES, mergeable_ranks=known, special_tokens={}) if known else None

    def ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def parts(self, text: str) -> list[str]:
        """The text cut where a piece begins whatever stands around it: at a space between ASCII letters or digits."""
        cuts = [0]
        while len(text) - cuts[-1] > PART_CHARS:
            found = BOUNDARY.search(text, cuts[-1] + PART_CHARS)
            if not found:
                break
            cuts.append(found.start())
        return [text[a:z] for a, z in zip(cuts, [*cuts[1:], len(text)])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.quick is None:
            return [self.ids(text) for text in texts]
        out = []
        for text in texts:
            try:
                found = [self.quick.encode_to_numpy(part, disallowed_special=()).astype("<u4", copy=False).tobytes()
                         for part in (self.parts(text) if len(text) > PART_CHARS else (text,))]
                out.append(b"".join(found))
            except ValueError:
                out.append(self.ids(text))
        return out
