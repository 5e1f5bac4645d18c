"""Token ids of whole texts through memos of chunks, equal to what the tokenizers library gives."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

#: Fixed value: how byte-level BPE cuts a text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ODD_BLANK = re.compile(r"\s | \s|^ | $")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """What make gives for a key, remembered for at most limit keys; then it starts again from nothing."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._make(key)
        return value


def load(path: str):
    """The tokenizer and a pattern of its special strings (None if it has none). One thread, as Spark has the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    byte_level = described.get("pre_tokenizer") or {}
    if byte_level.get("type") != "ByteLevel" or byte_level.get("add_prefix_space") or described.get("normalizer"):
        raise ValueError(f"{path}: chunks can be encoded apart for plain byte-level vocabularies only")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    special = [re.escape(x["content"]) for x in described.get("added_tokens", [])]
    return tokenizer, re.compile("|".join(special)) if special else None


class ChunkEncoder:
    """Adds up what texts give chunk by chunk.

    A text is cut where one space stands between two characters that are not blank. The tokenizer always cuts
    there too, with the space going to what follows, so each chunk can be encoded apart. Texts with special
    strings, which it treats before anything else, are given to of_text whole.
    """

    def __init__(self, of_chunk: Callable[[str], object], of_text: Callable[[str], object], special, limit: int):
        self._first = Memo(of_chunk, limit // 4)
        self._later = Memo(lambda part: of_chunk(" " + part), limit)
        self._of_text, self._special = of_text, special

    def parts(self, text: str) -> list:
        if self._special is not None and self._special.search(text):
            return [self._of_text(text)]
        chunks = _BOUNDARY.split(text) if _ODD_BLANK.search(text) else text.split(" ")
        first = [self._first[chunks[0]]] if chunks[0] else []
        return first + list(map(self._later.__getitem__, chunks[1:]))


def id_encoder(path: str) -> Callable[[str], bytes]:
    """Ids of whole texts as little-endian 32-bit numbers, equal to what the tokenizers library gives.

    Where merges stand in the order of their ids, tiktoken does the merging over the same vocabulary, three times
    as fast; special strings are cut out first, as the library does. Other vocabularies go to the library.
    """
    tokenizer, special = load(path)
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    vocabulary_, merges = described["model"]["vocab"], described["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    made = [vocabulary_[a + b] for a, b in pairs]
    if made != sorted(made):
        return lambda text: array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    import tiktoken

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {x["content"]: x["id"] for x in described.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary_.items() if token not in added}
    encode = tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(text: str) -> bytes:
        found, at = array("I"), 0
        for cut in special.finditer(text) if special is not None else ():
            found.extend(encode(text[at : cut.start()]))
            found.append(added[cut[0]])
            at = cut.end()
        found.extend(encode(text[at:] if at else text))
        return found.tobytes()

    return ids
