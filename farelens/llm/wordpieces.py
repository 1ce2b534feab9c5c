"""Token ids of whole texts, from a tokenizer file and a bounded memory of words.

For a tokenizer whose units never cross white space, a text's ids are the ids of its words
one after the other (``tests/llm/test_packing.py`` holds this against the tokenizer itself).
Texts repeat words, so a worker encodes a word once while it remembers it, over all tasks that
it runs; the memory is emptied when it has ``MOST`` words.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

MOST = 1 << 18
GAP = 65535  # the id of the space between words, which no token has

LETTERS = [*range(0x61, 0x7B), 0xC3, *(b for b in range(0xA0, 0xBF) if b != 0xB7)]
CAPITALS = [b for b in range(0x80, 0x9F) if b != 0x97]  # after 0xC3, small ones 32 above
SIGNS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
DIGITS = range(0x30, 0x3A)
# Apostrophes start units of their own ('s, 'll), and are left to the tokenizer.
PLAIN = bytes(b for b in [*LETTERS, *CAPITALS, *SIGNS, *DIGITS] if b != 0x27)
KIND = np.zeros(256, np.uint8)
KIND[LETTERS], KIND[DIGITS], KIND[SIGNS] = 1, 2, 3
SMALL = np.arange(256, dtype=np.uint8)
SMALL[CAPITALS] += 0x20
END = np.arange(256, dtype=np.uint8)  # how a byte is written that ends a unit
END[LETTERS] -= 0x20
END[SIGNS] = [*range(1, 0x20), 0x7F]
UNITS = r"[a-zà-þ]*[A-ZÀ-Þ]|[0-9 ]|[!-/:-@\[-`{-~]*[\x01-\x1f\x7f]"


def byte_signs() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain_ranks(model: dict) -> dict[bytes, int]:
    """Ids of the tokens that plain words are made of, by their bytes as ``END`` writes them.

    Empty where the file is no byte-level BPE with ids in the order of its merges.
    """
    suffix, vocab = model.get("end_of_word_suffix"), model["vocab"]
    if not suffix or model.get("type") != "BPE":
        return {}
    merged = [vocab["".join(m)] for m in model["merges"]]
    if merged != sorted(set(merged)):
        return {}
    signs, out = byte_signs(), {b" ": GAP}
    inner, last = {*LETTERS, *SIGNS}, {*LETTERS, *SIGNS, *DIGITS} - {0xC3}
    for token, number in vocab.items():
        ends = token.endswith(suffix)
        units = token.removesuffix(suffix) if ends else token
        if not units or not all(c in signs for c in units):
            continue
        data = [signs[c] for c in units]
        if ends and data[-1] in last and inner.issuperset(data[:-1]):
            out[bytes([*data[:-1], int(END[data[-1]])])] = number
        elif not ends and inner.issuperset(data):
            out[bytes(data)] = number
    return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The worker's own memory for a tokenizer file."""
    return WordIds(path)


def split(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lowered where the tokenizer lowers them alike.

    With a combining mark (UTF-8 lead bytes CC and CD) a capital may lack the composed form
    that its small letter has, and added tokens (they start with ``<|``) are found in the text
    as it is, so texts with either are left to the tokenizer.
    """
    data = (text or "").encode()
    if b"\xcc" not in data and b"\xcd" not in data and b"<|" not in data:
        data = data.lower()
    return data.split()


class WordIds:
    """Ids below 65,536 of texts, by a tokenizer file that lowers its input."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        if "abc" not in self.tokenizer.normalizer.normalize_str("ABC"):
            raise ValueError("the tokenizer does not lower its input")
        self.known: dict[bytes, bytes] = {}
        self.plain = None
        ranks = plain_ranks(json.loads(self.tokenizer.to_str())["model"])
        if ranks:
            import tiktoken

            self.plain = tiktoken.Encoding(
                "plain words", pat_str=UNITS, mergeable_ranks=ranks, special_tokens={})

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) > MOST:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if self.plain is not None:
            plain = [w for w in new if not w.translate(None, PLAIN) and b"<|" not in w]
            self.learn_plain(plain)
            new = [w for w in new if w not in self.known]
        found = self.tokenizer.encode_batch_fast(
            [w.decode() for w in new], add_special_tokens=False)
        for word, one in zip(new, found):
            self.known[word] = np.array(one.ids, "<u2").tobytes()

    def learn_plain(self, words: list[bytes]) -> None:
        data = SMALL[np.frombuffer(b" ".join([*words, b""]), np.uint8)]
        kind = KIND[data]
        ends = np.append(kind[:-1] != kind[1:], False)
        text = np.where(ends, END[data], data).tobytes().decode()
        ids = self.plain.encode_to_numpy(text)
        stop = np.flatnonzero(ids == GAP) * 2
        blob = ids.astype("<u2").tobytes()
        for word, start, end in zip(words, [0, *(stop + 2).tolist()], stop.tolist()):
            self.known[word] = blob[start:end]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        out: list[np.ndarray] = []
        for start in range(0, len(texts), 128):
            block = [split(x) for x in texts[start:start + 128]]
            self.learn(set().union(*block))
            get = self.known.__getitem__
            out += [np.frombuffer(b"".join(map(get, words)), "<u2") for words in block]
        return out
